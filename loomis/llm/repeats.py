"""Repeated passages across documents by an enhanced suffix array.

Documents are read as UTF-8 bytes.  Every window of ``span`` bytes has a
canonical anchor: the K-gram in it with the smallest hash (the leftmost of
equals).  Equal windows have equal anchors, so all windows of an anchor can be
compared in one place, and anchors that occur once in the corpus need not be
looked at.  The steps:

1. texts are packed into chunks, a table bucketed by chunk, so that later joins
   on the chunk move only the other side;
2. chunks send their anchors' hashes (32 bits, dealt to buckets, of which there
   are as many as partitions or one for BUCKET_CHUNKS chunks) and get back
   two bits for each: found elsewhere or not, and crowded (more than CROWD
   occurrences in the corpus) or not;
3. chunks send the pieces of text around the anchors that were found (the
   windows an anchor stands for), each different piece once; a crowded anchor's
   windows are sent one by one, dealt by their own bytes;
4. a bucket builds the suffix array of its pieces' window starts with their
   common-prefix lengths, scans it with a stack for the intervals of common
   prefixes, keeps those whose members differ to the left (maximal repeats) and
   reports each with all its occurrences;
5. a chunk gets the spans to remove and cuts them out.

Hot passages cost one piece a chunk (one for each window if they are crowded):
a chunk folds its equal pieces and settles all but the smallest document's
itself.  Pieces at a passage's edge differ with what surrounds it; there the
windows of a crowded anchor spread over the buckets, so no suffix array holds
more than CROWD pieces of an anchor.  A repeat longer than an anchor's
windows is reported piecewise; the pieces overlap, so their union is whole.

Defined cases: null and empty texts, and texts shorter than ``span``, have
nothing removed; rows with equal doc_id never remove from each other; a null id
counts as larger than all others; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import scratch_path, text_of

SPAN = 50
GRAM = 32
CHUNK_BYTES = 4 << 20
BLOCK_BYTES = 1 << 19
CROWD = 1 << 14  # occurrences of an anchor that meet in one suffix array, at most
BUCKET_CHUNKS = 2  # chunks' anchors that meet in one bucket, on average
GROUP = 1 << 14    # pieces of a bucket that are held as bytes at once (all of one anchor are)
SEND_BYTES = 4 << 20
NULL_ID = np.iinfo(np.int64).max
_U = np.uint64
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) from each position on."""
    h, width, mult = data.astype(_U) + _U(1), 1, _MIX[0]
    while width < gram:
        h = h[:-width] * _U(mult) + h[width:]
        mult = mult * mult % (1 << 64)
        width *= 2
    h ^= h >> _U(29)
    h *= _U(_MIX[1])
    return h ^ (h >> _U(32))


def _slide_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (width - done)], x[width - done:]) if done < width else x


def anchors(data: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM):
    """(hash, first window, last window) for each anchor; windows are runs of
    starts in ``data`` that lie within one text and share the anchor."""
    out = []
    lengths = np.diff(offsets)
    for a in range(0, max(0, len(data) - span + 1), BLOCK_BYTES):
        part = data[a:a + BLOCK_BYTES + span - 1]
        if len(part) < span:
            break
        h = gram_hashes(part, gram)
        key = ((h >> _U(32)) << _U(32)) | np.arange(len(h), dtype=_U)
        at = (_slide_min(key, span - gram + 1) & _U(0xFFFFFFFF)).astype(np.int64)
        ok = np.zeros(len(at) + 1, dtype=np.int64)
        has = lengths >= span
        begin = np.clip(offsets[:-1][has] - a, 0, len(at))
        end = np.clip(offsets[1:][has] - span + 1 - a, 0, len(at))
        np.add.at(ok, begin, 1)
        np.add.at(ok, end, -1)
        start = np.flatnonzero(np.cumsum(ok[:-1]) > 0)
        if len(start):
            pos = at[start]
            cut = np.flatnonzero(np.concatenate(([True], (pos[1:] != pos[:-1]) | (start[1:] != start[:-1] + 1))))
            last = np.concatenate((cut[1:], [len(start)])) - 1
            out.append((h[pos[cut]], start[cut] + a, start[last] + a))
    if not out:
        return np.empty(0, _U), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _dealt(h: np.ndarray, buckets: int):
    """Bucket and 32-bit remainder of the hashes."""
    return (h % _U(buckets)).astype(np.int64), ((h // _U(buckets)) & _U(0xFFFFFFFF)).astype(np.uint32)


def _listed(h: np.ndarray, buckets: int):
    """Distinct (bucket, remainder) in order, where each starts, and how often."""
    b, r = _dealt(h, buckets)
    return np.unique((b.astype(_U) << _U(32)) | r, return_inverse=True, return_counts=True)


def spread(data: np.ndarray, h: np.ndarray, j0: np.ndarray, j1: np.ndarray, crowded: np.ndarray, span: int = SPAN):
    """Anchors (hash, first window, last window) with each crowded one replaced
    by its windows, which get the hash of their own bytes."""
    n = (j1 - j0 + 1)[crowded]
    at = np.repeat(j0[crowded], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    own = np.zeros(len(at), _U)
    for i in range(span):
        own = own * _U(_MIX[0]) + data[at + i] + _U(1)
    own ^= own >> _U(29)
    own *= _U(_MIX[1])
    own ^= own >> _U(32)
    rest = ~crowded
    return np.concatenate((h[rest], own)), np.concatenate((j0[rest], at)), np.concatenate((j1[rest], at))


# -- suffix array of pieces ---------------------------------------------------

def lcp_intervals(lcp: list[int], least: int) -> list[tuple[int, int, int]]:
    """Stack scan of common-prefix lengths (``lcp[i]``: of ranks i-1 and i):
    (length, first rank, last rank) of every interval of at least ``least``."""
    out, stack = [], [(0, 0)]
    for i in range(1, len(lcp) + 1):
        left, now = i - 1, lcp[i] if i < len(lcp) else 0
        while stack[-1][0] > now:
            length, left = stack.pop()
            if length >= least:
                out.append((length, left, i - 1))
        if stack[-1][0] < now:
            stack.append((now, left))
    return out


def maximal_repeats(pieces: list[bytes], starts: list[int], span: int = SPAN):
    """Maximal repeats of at least ``span`` bytes among the suffixes of the
    pieces: yields (length, [(piece, offset)]).  ``starts``: a piece's number
    of window starts.  A suffix at a piece's start has no left context here, so
    nothing that begins there is taken as part of a longer repeat."""
    pid = np.repeat(np.arange(len(pieces)), starts)
    off = np.concatenate([np.arange(n) for n in starts])
    width = max(len(p) for p in pieces)
    table = np.zeros((len(pieces), 2 * width), np.uint8)  # zero-padded; real lengths are kept beside
    for i, p in enumerate(pieces):
        table[i, :len(p)] = np.frombuffer(p, np.uint8)
    size = np.array([len(p) for p in pieces])[pid] - off
    suffix = np.lib.stride_tricks.sliding_window_view(table, width, axis=1)[pid, off]
    order = np.argsort(np.ascontiguousarray(suffix).view(f"V{width}").ravel(), kind="stable")
    suffix, pid, off, size = suffix[order], pid[order], off[order], size[order]
    differ = suffix[1:] != suffix[:-1]
    lcp = np.where(differ.any(1), differ.argmax(1), width)
    lcp = np.minimum(lcp, np.minimum(size[1:], size[:-1]))
    before = np.where(off > 0, table[pid, np.maximum(off - 1, 0)].astype(np.int64), -1 - np.arange(len(off)))
    for length, lo, hi in lcp_intervals([0, *lcp.tolist()], span):
        left = before[lo:hi + 1]
        if (left != left[0]).any():  # not all preceded by the same byte
            yield length, list(zip(pid[lo:hi + 1].tolist(), off[lo:hi + 1].tolist()))


def fold(rem, docs, pieces):
    """Group equal pieces of equal anchors.  Returns the indexes of the kept
    ones (all of the smallest document) and of the settled ones."""
    best: dict = {}
    more: dict[int, list[int]] = {}  # further pieces of a kept one's document
    gone = []
    for i, k in enumerate(zip(rem, pieces)):
        j = best.setdefault(k, i)
        if i == j:
            continue
        if docs[i] > docs[j]:
            gone.append(i)
        elif docs[i] == docs[j]:
            more.setdefault(j, []).append(i)
        else:
            gone += [j, *more.pop(j, [])]
            best[k] = i
    return sorted([*best.values(), *(i for own in more.values() for i in own)]), sorted(gone)


def repeated(keys: np.ndarray):
    """Indexes of the keys that occur more than once, by key, in ranges of
    about GROUP; a key's indexes (in order) lie in one range."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    order = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
    if not len(order):
        return
    first = np.flatnonzero(np.concatenate(([True], keys[order[1:]] != keys[order[:-1]])))
    edge = np.unique(first[np.searchsorted(first, np.arange(0, first[-1] + 1, GROUP))]).tolist()
    for a, e in zip(edge, [*edge[1:], len(order)]):
        yield order[a:e]


def settle(rem, docs, places, pieces, starts, span: int = SPAN):
    """Spans (chunk, start, end) to remove in one bucket."""
    keep, gone = fold(rem, docs, pieces)
    spans = [(places[i][0], places[i][1], places[i][1] + len(pieces[i])) for i in gone]
    by: dict[int, list[int]] = {}
    for i in keep:
        by.setdefault(rem[i], []).append(i)
    for own in by.values():
        if len(own) < 2 or len({docs[i] for i in own}) < 2:
            continue
        for length, found in maximal_repeats([pieces[i] for i in own], [starts[i] for i in own], span):
            least = min(docs[own[p]] for p, _ in found)
            for p, o in found:
                i = own[p]
                if docs[i] > least:
                    spans.append((places[i][0], places[i][1] + o, places[i][1] + o + length))
    return spans


# -- Spark jobs ---------------------------------------------------------------

def squeezed(text: bytes) -> bytes:
    """Pieces as they travel."""
    return pa.Codec("zstd", compression_level=1).compress(text, asbytes=True)


def resolve(t: pa.Table, span: int = SPAN) -> pa.Table:
    """Spans (chunk, spans) of one bucket's pieces.  They stay in their rows'
    texts; only GROUP of those that may repeat are taken out at once."""
    chunk = t["chunk"].to_pylist()

    def column(name, kind):
        each = [np.frombuffer(x.as_buffer(), kind) for x in t[name]]
        return np.concatenate(each), [len(x) for x in each]
    (rem, n), (docs_, _), (start, _), (starts, _) = (
        column(*x) for x in (("rem", "<u4"), ("doc", "<i8"), ("start", "<i4"), ("starts", "u1")))
    row = np.repeat(np.arange(len(n), dtype=np.int32), n)
    # Where each piece ends in its row's text.
    end = np.cumsum(starts.astype(np.int64) + (span - 1))
    edge = np.concatenate(([0], end))[np.cumsum([0, *n])]
    end -= np.repeat(edge[:-1], n)
    text = [memoryview(pa.decompress(x.as_buffer(), size, "zstd")) for x, size in zip(t["text"], np.diff(edge).tolist())]
    out: dict[int, list[bytes]] = {}
    for c, x in zip(chunk, t["done"].to_pylist()):
        if x:
            out.setdefault(c, []).append(x)
    for own in repeated(rem):
        r, k = row[own].tolist(), starts[own].tolist()
        pieces = [bytes(text[x][e - m - span + 1:e]) for x, e, m in zip(r, end[own].tolist(), k)]
        places = list(zip(r, start[own].tolist()))
        found = settle(rem[own].tolist(), docs_[own].tolist(), places, pieces, k, span)
        if found:
            found = np.array(found, "<i4")
            found = found[np.argsort(found[:, 0], kind="stable")]
            at = np.flatnonzero(np.concatenate(([True], found[1:, 0] != found[:-1, 0]))).tolist()
            for a, e in zip(at, [*at[1:], len(found)]):
                out.setdefault(chunk[found[a, 0]], []).append(found[a:e, 1:].tobytes())
    rows = [(c, b"".join(v)) for c, v in out.items()]
    return pa.table({"chunk": pa.array([c for c, _ in rows], pa.int64()),
                     "spans": pa.array([v for _, v in rows], pa.binary())})


def pack(docs: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """Chunk table (chunk, ids, nulls, sizes, data), bucketed by chunk."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("q_text"))

    def run(batches):
        seq, ids, texts, total = 0, [], [], 0
        base = TaskContext.get().partitionId() << 32

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([base + seq], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([b"".join(texts)], pa.binary())],
                names=["chunk", "ids", "sizes", "data"])
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                if texts and total + len(t) > CHUNK_BYTES:
                    yield row()
                    seq, ids, texts, total = seq + 1, [], [], 0
                ids.append(d)
                texts.append(t)
                total += len(t)
        if texts:
            yield row()

    name = f"loomis_chunks_{uuid.uuid4().hex}"
    src.mapInArrow(run, "chunk bigint, ids array<bigint>, sizes array<bigint>, data binary") \
        .write.bucketBy(buckets, "chunk").option("compression", "zstd") \
        .option("path", scratch_path(spark, "llm", name)).saveAsTable(name)
    return spark.table(name)


def bucket_count(chunks: DataFrame) -> int:
    """A bucket is held by one Python worker, so there are more the larger the corpus."""
    return max(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), chunks.count() // BUCKET_CHUNKS)


def _rows(batches):
    """The rows as dicts, one at a time: a batch may hold 64 MB of chunks."""
    for b in batches:
        for j in range(b.num_rows):
            yield b.slice(j, 1).to_pylist()[0]


def _load(r) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(r["data"], np.uint8)
    return data, np.concatenate(([0], np.cumsum(np.array(r["sizes"], np.int64)))).astype(np.int64)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
                   gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256) per row: every
    byte covered by a ``span``-byte string that also starts in a document with
    a smaller id is removed; ``spans`` are the removed runs (start, end)."""
    if not gram <= span or gram & (gram - 1):
        raise ValueError("gram must be a power of two, not above span")
    spark = docs.sparkSession
    chunks = pack(docs, id_col, text_col, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = bucket_count(chunks)

    def send_hashes(batches):
        for r in _rows(batches):
            keys, _, n = _listed(anchors(*_load(r), span, gram)[0], buckets)
            where = np.searchsorted(keys >> _U(32), np.arange(buckets + 1, dtype=_U))
            rows = [(k, r["chunk"], (keys[x:y] & _U(0xFFFFFFFF)).astype("<u4").tobytes(),
                     zlib.compress(np.minimum(n[x:y], 65535).astype("<u2").tobytes(), 1))
                    for k, (x, y) in enumerate(zip(where[:-1].tolist(), where[1:].tolist())) if y > x]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v[0] for v in rows], pa.int32()), pa.array([v[1] for v in rows], pa.int64()),
                 pa.array([v[2] for v in rows], pa.binary()), pa.array([v[3] for v in rows], pa.binary())],
                names=["bucket", "chunk", "hashes", "counts"])

    def found_bits(t: pa.Table) -> pa.Table:
        each = [np.frombuffer(x, "<u4") for x in t["hashes"].to_pylist()]
        times = np.concatenate([np.frombuffer(zlib.decompress(x), "<u2") for x in t["counts"].to_pylist()])
        _, inverse = np.unique(np.concatenate(each), return_inverse=True)
        n = np.bincount(inverse, times)[inverse]
        ends = np.cumsum([len(e) for e in each])
        bits, crowds = ([np.packbits(v[e - len(x):e]).tobytes() if v[e - len(x):e].any() else b""
                         for e, x in zip(ends.tolist(), each)] for v in (n > 1, n > crowd))
        return pa.table({"bucket": t["bucket"], "chunk": t["chunk"], "bits": pa.array(bits, pa.binary()),
                         "crowds": pa.array(crowds, pa.binary())})

    bits = chunks.select("chunk", "sizes", "data").mapInArrow(
        send_hashes, "bucket int, chunk bigint, hashes binary, counts binary") \
        .groupBy("bucket").applyInArrow(found_bits, "bucket int, chunk bigint, bits binary, crowds binary") \
        .groupBy(F.col("chunk").alias("b_chunk")).agg(F.collect_list(F.struct("bucket", "bits", "crowds")).alias("bits"))

    def send_pieces(batches):
        for r in _rows(batches):
            data, offsets = _load(r)
            h, j0, j1 = anchors(data, offsets, span, gram)
            keys, inverse, _ = _listed(h, buckets)
            where = np.searchsorted(keys >> _U(32), np.arange(buckets + 1, dtype=_U))
            hot, crowded = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
            for x in r["bits"]:
                a, e = where[x["bucket"]], where[x["bucket"] + 1]
                for mark, got in ((hot, x["bits"]), (crowded, x["crowds"])):
                    if got:
                        mark[a:e] = np.unpackbits(np.frombuffer(got, np.uint8))[:e - a] > 0
            pick = np.flatnonzero(hot[inverse])
            h, j0, j1 = spread(data, h[pick], j0[pick], j1[pick], crowded[inverse[pick]], span)
            ids = np.array([NULL_ID if d is None else d for d in r["ids"]], np.int64)
            doc = ids[np.searchsorted(offsets, j0, side="right") - 1]
            raw, stop, kept, done = r["data"], j1 + span, np.ones(len(h), bool), []
            for own in repeated(h):
                texts = (raw[x:y] for x, y in zip(j0[own].tolist(), stop[own].tolist()))
                gone = own[fold(h[own].tolist(), doc[own].tolist(), texts)[1]]
                kept[gone] = False
                done.append(np.stack([j0[gone], stop[gone]], axis=1).astype("<i4").tobytes())
            done = b"".join(done)
            bucket, rem = _dealt(h, buckets)
            keep = np.flatnonzero(kept)
            keep = keep[np.argsort(bucket[keep], kind="stable")]
            edge = np.searchsorted(bucket[keep], np.arange(buckets + 1))
            home = int(r["chunk"] % buckets)
            cols, size = {c: [] for c in ("bucket", "chunk", "rem", "doc", "start", "starts", "text", "done")}, 0
            for k, (x, y) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())):
                own = keep[x:y]
                if y == x and not (k == home and done):
                    continue
                text = squeezed(b"".join([raw[x:y] for x, y in zip(j0[own].tolist(), stop[own].tolist())]))
                for c, v in (("bucket", k), ("chunk", r["chunk"]), ("rem", rem[own].astype("<u4").tobytes()),
                             ("doc", doc[own].astype("<i8").tobytes()),
                             ("start", j0[own].astype("<i4").tobytes()),
                             ("starts", (j1 - j0 + 1)[own].astype("u1").tobytes()),
                             ("text", text), ("done", done if k == home else b"")):
                    cols[c].append(v)
                size += len(text)
                if size > SEND_BYTES:
                    yield piece_rows(cols)
                    cols, size = {c: [] for c in cols}, 0
            if cols["bucket"]:
                yield piece_rows(cols)

    def piece_rows(cols):
        return pa.RecordBatch.from_arrays(
            [pa.array(cols["bucket"], pa.int32()), pa.array(cols["chunk"], pa.int64()),
             *[pa.array(cols[c], pa.binary()) for c in list(cols)[2:]]], names=list(cols))

    pieces = chunks.join(bits, F.col("chunk") == F.col("b_chunk"), "left") \
        .select("chunk", "ids", "sizes", "data", F.coalesce("bits", F.expr("array()")).alias("bits")) \
        .mapInArrow(send_pieces, "bucket int, chunk bigint, rem binary, doc binary, start binary, starts binary, "
                                 "text binary, done binary")

    spans = pieces.groupBy("bucket").applyInArrow(lambda t: resolve(t, span), "chunk bigint, spans binary") \
        .groupBy(F.col("chunk").alias("s_chunk")).agg(F.collect_list("spans").alias("spans"))

    def cut_out(batches):
        for r in _rows(batches):
            data, offsets = _load(r)
            mark = np.zeros(len(data) + 1, np.int32)
            for s in r["spans"]:
                x = np.frombuffer(s, "<i4").reshape(-1, 2)
                np.add.at(mark, x[:, 0], 1)
                np.add.at(mark, x[:, 1], -1)
            gone = np.cumsum(mark[:-1], dtype=np.int32) > 0
            n_removed, n_spans, runs, sha = [], [], [], []
            for a, e in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                g = gone[a:e]
                if not g.any():
                    n_removed.append(0)
                    n_spans.append(0)
                    runs.append([])
                    sha.append(hashlib.sha256(data[a:e].tobytes()).hexdigest())
                    continue
                edge = np.flatnonzero(np.diff(np.concatenate(([False], g, [False])))).reshape(-1, 2)
                n_removed.append(int(g.sum()))
                n_spans.append(len(edge))
                runs.append(edge.tolist())
                sha.append(hashlib.sha256(data[a:e][~g].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["ids"], pa.int64()), pa.array(r["sizes"], pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(runs, pa.list_(pa.list_(pa.int32()))), pa.array(sha)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])

    return chunks.join(spans, F.col("chunk") == F.col("s_chunk"), "left") \
        .select("chunk", "ids", "sizes", "data", F.coalesce("spans", F.expr("array()")).alias("spans")) \
        .mapInArrow(cut_out, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                             "spans array<array<int>>, kept_sha256 string")
