"""Secret scans with a recursive decoding worklist.

A text is the first layer of a worklist.  Every layer is scanned for the three
kinds of secrets, then unwrapped: lines with percent escapes, lines with
character escapes (\\uXXXX, \\xXX, numeric character references and UTF-16
runs), base64 runs (plain and URL-safe alphabet, wrapped lines, all four
alignments, as a run may be glued to what stands before it) and compressed
streams (gzip, zlib, bzip2, xz, zstd).  What comes out are layers of their own,
until nothing unwraps any more.  A layer that was already met at the same place
of the text is a cycle and is not entered again.

A layer keeps how its bytes map to its parent's, so a span found anywhere is
followed back to code points of the text: a percent or character escape maps
character by character, base64 by its groups of six bits, a compressed stream
as a whole.

Each text is worked on by itself in a narrow pass.  Memory is bounded by a text
and one layer; a stream that grows beyond 16 MB is cut into layers at control
characters, which no secret and no escape holds (a further stream nested bare
in it is then followed inside one such part only).

Defined cases: null text is empty; texts are scanned whole, whatever their
length; repeated rows get rows of their own; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import text_of

# Fixed values of the contract: kinds in their order, patterns, least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}

_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_PERCENT = re.compile(rb"%([0-9A-Fa-f]{2})")
_ESCAPE = re.compile(rb"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
                     rb"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_WIDE = re.compile(rb"(?:[\x20-\x7e]\x00){8,}|(?:\x00[\x20-\x7e]){8,}")
_READABLE = re.compile(rb"[\x20-\x7e]{8}|(?:[\x20-\x7e]\x00){8}|(?:\x00[\x20-\x7e]){8}")
_STREAM = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]")
_BASE64 = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
_PLAIN = bytes.maketrans(b"-_", b"+/")
_RUN = 16                       # characters of a base64 run
LAYER_BYTES = 16 << 20          # a compressed stream is cut into layers beyond this
_INPUT = 1 << 14                # compressed bytes handed to a decoder at once
_CONTROL = re.compile(rb"[\x00-\x1f]")

_ZLIB = type(zlib.decompressobj())

Back = Callable[[int, int], tuple[int, int]]


def _runs(data: bytes, table: bytes, least: int) -> Iterator[tuple[int, int]]:
    """Maximal runs of at least ``least`` bytes that ``table`` maps to 1."""
    marks = data.translate(table)
    one, a = b"\x01" * least, 0
    while (a := marks.find(one, a)) >= 0:
        b = marks.find(b"\x00", a)
        b = len(data) if b < 0 else b
        yield a, b
        a = b


def _marks(of: bytes) -> bytes:
    return bytes(int(b in of) for b in range(256))


_HEX_MARKS, _BASE64_MARKS = _marks(b"0123456789abcdef"), _marks(_BASE64)


def scan(data: bytes) -> list[tuple[str, int, int]]:
    """Secrets of one layer: (kind, start, end) in bytes."""
    out = []
    small = data.lower()
    if any(k in small for k in _KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(data) if len(m[1]) >= LEAST["assign"]]
    if b"AKIA" in data:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(data) if len(m[0]) >= LEAST["access"]]
    out += [("hex", a, b) for a, b in _runs(data, _HEX_MARKS, LEAST["hex"])]
    return out


def _spliced(pieces: list[tuple[int, int, int, bool]]) -> Back:
    """Map of a layer made of pieces (start here, start and end in the parent,
    whether copied byte by byte)."""
    starts = [p[0] for p in pieces]

    def back(a: int, b: int) -> tuple[int, int]:
        p, q = pieces[bisect_right(starts, a) - 1], pieces[bisect_right(starts, b - 1) - 1]
        return (p[1] + (a - p[0] if p[3] else 0), q[1] + b - q[0] if q[3] else q[2])
    return back


def _decoded_lines(data: bytes, pattern: re.Pattern, value: Callable[[re.Match], bytes]) -> Iterator[tuple[bytes, Back]]:
    """Each line that holds an escape, with all its escapes decoded."""
    m = pattern.search(data)
    while m:
        start = data.rfind(b"\n", 0, m.start()) + 1
        end = data.find(b"\n", m.end())
        end = len(data) if end < 0 else end
        out, pieces, at = bytearray(), [], start
        for m in pattern.finditer(data, start, end):
            if m.start() > at:
                pieces.append((len(out), at, m.start(), True))
                out += data[at:m.start()]
            v = value(m)
            if v:
                pieces.append((len(out), m.start(), m.end(), False))
                out += v
            at = m.end()
        if at < end:
            pieces.append((len(out), at, end, True))
            out += data[at:end]
        if out:
            yield bytes(out), _spliced(pieces)
        m = pattern.search(data, end)


def _character(m: re.Match) -> bytes:
    if m[4]:
        return bytes([int(m[4], 16)])
    n = int(m[6]) if m[6] else int(next(g for g in (m[1], m[2], m[3], m[5]) if g), 16)
    if n > 0x10FFFF:
        return b""
    if 0xD800 <= n < 0xE000:            # half of a pair; no secret holds one
        return b"\xef\xbf\xbd"
    return chr(n).encode()


def _base64_layers(data: bytes) -> Iterator[tuple[bytes, Back]]:
    runs = list(_runs(data, _BASE64_MARKS, _RUN))
    k = 0
    while k < len(runs):
        a, b = runs[k]
        at: range | np.ndarray = range(a, b)
        # Wrapped lines: further runs as long as the first, then a last one.
        width, end = b - a, b
        if width >= 60 and width % 4 == 0:
            while True:
                gap = 2 if data[end:end + 2] == b"\r\n" else 1 if data[end:end + 1] == b"\n" else 0
                if not gap:
                    break
                x, y = end + gap, end + gap
                while y < len(data) and y - x < width and _BASE64_MARKS[data[y]]:
                    y += 1
                if y == x or (y - x == width and y < len(data) and _BASE64_MARKS[data[y]]):
                    break
                at, end = np.concatenate([at, np.arange(x, y)]), y
                if y - x < width:
                    break
        while k < len(runs) and runs[k][0] < end:
            k += 1
        text = (data[a:b] if len(at) == b - a else bytes(np.frombuffer(data, np.uint8)[at])).translate(_PLAIN)
        for shift in range(4):
            part = text[shift:]
            part = part[:len(part) - (len(part) % 4 == 1)]
            out = binascii.a2b_base64(part + b"=" * (-len(part) % 4))
            if _READABLE.search(out) or _STREAM.match(out):
                def back(x, y, at=at, shift=shift):
                    return int(at[shift + x * 8 // 6]), int(at[min(shift + (y * 8 + 5) // 6, len(at)) - 1]) + 1
                yield out, back


def _wide_layers(data: bytes) -> Iterator[tuple[bytes, Back]]:
    for m in _WIDE.finditer(data):
        a = m.start()
        yield m[0].replace(b"\x00", b""), lambda x, y, a=a: (a + 2 * x, a + 2 * y)


def _decoder(magic: bytes):
    if magic[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if magic[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if magic[:1] == b"\xfd":
        return lzma.LZMADecompressor()
    if magic[:1] == b"\x28":
        import zstandard
        return zstandard.ZstdDecompressor().decompressobj()
    return zlib.decompressobj()


def _output(decoder, data: bytes) -> Iterator[bytes]:
    """Decompressed parts; ends where the stream ends or breaks."""
    limited = isinstance(decoder, (bz2.BZ2Decompressor, lzma.LZMADecompressor))
    try:
        for i in range(0, len(data), _INPUT):
            part = data[i:i + _INPUT]
            while True:
                if limited:
                    out = decoder.decompress(part, LAYER_BYTES)
                    part = b""
                    more = not decoder.eof and not decoder.needs_input
                elif isinstance(decoder, _ZLIB):
                    out = decoder.decompress(part, LAYER_BYTES)
                    part = decoder.unconsumed_tail
                    more = bool(part)
                else:
                    out, more = decoder.decompress(part), False
                if out:
                    yield out
                if not more:
                    break
            if decoder.eof:
                return
    except Exception:  # noqa: BLE001 -- not a stream, or a broken one: what came out so far counts
        return


def _streams(data: bytes) -> Iterator[tuple[bytes, Back]]:
    m = _STREAM.search(data)
    while m:
        a = m.start()
        decoder, held, parts = _decoder(m[0]), bytearray(), []
        for out in _output(decoder, data[a:]):
            held += out
            if len(held) > LAYER_BYTES:
                cut = max((x.end() for x in _CONTROL.finditer(held, len(held) - len(out))), default=0)
                if cut:
                    parts.append(bytes(held[:cut]))
                    del held[:cut]
        if held:
            parts.append(bytes(held))
        end = len(data) - (len(decoder.unused_data) if decoder.eof else 0)
        for part in parts:
            yield part, lambda x, y, a=a, end=end: (a, end)
        m = _STREAM.search(data, max(end if parts and decoder.eof else 0, m.start() + 1))


def unwrapped(data: bytes, first: bool) -> Iterator[tuple[str, bytes, Back]]:
    """What a layer unwraps to: (codec, bytes, map to this layer's bytes).  The
    text itself holds no compressed bytes, being valid UTF-8."""
    if b"%" in data:
        for out, back in _decoded_lines(data, _PERCENT, lambda m: bytes([int(m[1], 16)])):
            yield "url", out, back
    if b"\\" in data or b"&#" in data:
        for out, back in _decoded_lines(data, _ESCAPE, _character):
            yield "unicode", out, back
    for out, back in _base64_layers(data):
        yield "base64", out, back
    if not first:
        for out, back in _wide_layers(data):
            yield "unicode", out, back
        for out, back in _streams(data):
            yield "compressed", out, back


def find_in(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, str]]]:
    """Secrets of a text in code points: those of the text itself, and all,
    with the codecs under which each was found ('' for the text itself)."""
    data = text.encode()
    if len(data) == len(text):
        places = None
    else:
        begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
        places = np.concatenate([[0], np.cumsum(begins)])

    def top(a: int, b: int) -> tuple[int, int]:
        # A span that begins or ends inside a character's bytes holds the character.
        if places is None:
            return a, b
        return int(places[a]) - (a < len(data) and not begins[a]), int(places[b])

    base = [(k, *top(a, b)) for k, a, b in scan(data)]
    found = {x: "" for x in base}
    seen = set()
    work: deque[tuple[str, bytes, list[Back]]] = deque([("", data, [top])])
    while work:
        path, layer, back = work.popleft()
        for codec, out, up in unwrapped(layer, not path):
            maps = [*back, up]

            def place(a, b, maps=maps):
                for f in reversed(maps):
                    a, b = f(a, b)
                return a, b

            key = (hashlib.blake2b(out, digest_size=16).digest(), place(0, len(out)))
            if key in seen:
                continue
            seen.add(key)
            name = f"{path}>{codec}" if path else codec
            for k, a, b in scan(out):
                found.setdefault((k, *place(a, b)), name)
            work.append((name, out, maps))
    by = {k: i for i, k in enumerate(KINDS)}
    order = lambda x: (x[1], by[x[0]], x[2])
    return sorted(base, key=order), [(*x, found[x]) for x in sorted(found, key=order)]


_SPAN = "struct<kind:string,start:bigint,end:bigint>"
_PATH = "struct<kind:string,start:bigint,end:bigint,layers:string>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans) for each row: the text's own secrets, and all with
    the codecs that hid them."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("q_text"))
    src = src.select("doc_id", text_of("q_text").alias("q_text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    span = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
    types = [pa.list_(pa.struct(span)), pa.list_(pa.struct([*span, ("layers", pa.string())]))]
    names = [x for x, _ in span]

    def run(batches):
        for b in batches:
            found = [find_in(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0),
                 pa.array([[dict(zip(names, x, strict=True)) for x in f[0]] for f in found], types[0]),
                 pa.array([[dict(zip([*names, "layers"], x, strict=True)) for x in f[1]] for f in found], types[1])],
                names=["doc_id", "base", "spans"])

    return src.mapInArrow(run, f"doc_id {id_type}, base array<{_SPAN}>, spans array<{_PATH}>")


def secret_digests(found: DataFrame) -> DataFrame:
    """Counts of the text's own secrets by kind, the digest of their spans, and
    all spans, as "kind:start:end" joined by commas."""
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    of_kind = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", *[of_kind(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
        F.size(F.filter("spans", lambda x: x["layers"] != "")).cast("long").alias("n_decoded"),
        F.array_join(F.array_distinct(F.transform(F.filter("spans", lambda x: x["layers"] != ""),
                                                  lambda x: x["layers"])), ",").alias("layers"))
