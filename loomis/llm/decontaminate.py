"""Benchmark decontamination with an Aho-Corasick automaton.

Item texts and documents are normalised alike (ASCII letters lower-cased, words
kept, everything else one space), and every window of consecutive item words is
a pattern " w1 w2 ... ".  One automaton over all windows scans a document's
normalised text once; a match's end is mapped back to word numbers and, for the
spans, to the original text.

The windows are the only thing broadcast.  They are written to the shared
folder with their sizes; as long as they fit ``SHARD_BYTES`` there is one
automaton, beyond that they are dealt to several of at most that size and the
documents pass each in turn (the same results, more passes).

Defined cases: null texts and texts without words have no windows and no hits;
an item whose id is null marks words but is not named; repeated documents or
items are harmless (an item is named once); empty tables give no rows or no
hits; other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut, text_of

WINDOW = 10
SHARD_BYTES = 4 << 20
# Word bytes keep their value (A-Z lower-cased); the others become a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if (48 <= b <= 57 or 97 <= b <= 122 or b >= 128) else 32
               for b in range(256))
_AUTOMATA: dict[object, object] = {}


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct (win, items, n): the pattern, its items' ids as strings and its words."""
    src = benchmark.select(F.col(id_col).cast("string").alias("item"), text_of(text_col).cast("binary").alias("q_text"))

    def run(batches):
        for b in batches:
            win, item, n = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words_of(t)
                k = min(size, len(w))
                for j in range(len(w) - k + 1 if w else 0):
                    win.append(b" " + b" ".join(w[j:j + k]) + b" ")
                    item.append(i)
                    n.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(win, pa.binary()), pa.array(item, pa.string()),
                                              pa.array(n, pa.int32())], names=["win", "item", "n"])

    return src.mapInArrow(run, "win binary, item string, n int").groupBy("win") \
        .agg(F.array_sort(F.collect_set("item")).alias("items"), F.max("n").alias("n"))


def _automaton(key: str, shared):
    """The worker's automaton of one broadcast shard."""
    if key not in _AUTOMATA:
        import ahocorasick
        _AUTOMATA.clear()
        a = ahocorasick.Automaton()
        for win, items, n in shared.value:
            a.add_word(win.decode("latin-1"), (n, items))
        a.make_automaton()
        _AUTOMATA[key] = a
    return _AUTOMATA[key]


def merge_ranges(ranges: list[list[int]]) -> list[list[int]]:
    """Half-open ranges joined where they touch or overlap."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def scan(automaton, text: bytes) -> tuple[int, list[list[int]], set]:
    """(words, hit word ranges, items) of one document."""
    w = words_of(text)
    if not w:
        return 0, [], set()
    norm = b" " + b" ".join(w) + b" "
    ranges, items, gaps = [], set(), None
    for end, (n, ids) in automaton.iter(norm.decode("latin-1")):
        if gaps is None:
            gaps = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
        last = int(np.searchsorted(gaps, end))
        ranges.append([last - n, last])
        items.update(ids)
    return len(w), merge_ranges(ranges), items


def char_spans(text: str, ranges: list[list[int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of word ranges."""
    return byte_text_spans(text.encode(), ranges)


def byte_text_spans(raw: bytes, ranges: list[list[int]]) -> list[tuple[int, int]]:
    """``char_spans`` of a text given as UTF-8."""
    if not ranges:
        return []
    flags = np.frombuffer(raw.translate(_TABLE), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [(int(chars[begin[a]]), int(chars[end[b - 1]])) for a, b in ranges]


_OUT = "n_words bigint, ranges array<array<int>>, items array<string>"


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", size: int = WINDOW,
                  shard_bytes: int = SHARD_BYTES, spans: bool = False) -> DataFrame:
    """(doc_id, n_words, ranges, items): hit word ranges and items per row;
    with ``spans`` also their (start, end) in the original text, in characters."""
    spark = docs.sparkSession
    wins = cut(item_windows(benchmark, item_col, item_text, size), "windows")
    total = wins.agg(F.coalesce(F.sum(F.length("win")), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("q_text"))
    id_type = d.schema["doc_id"].dataType.simpleString()
    d = d.select("doc_id", text_of("q_text").cast("binary").alias("q_text"), F.lit(0).cast("bigint").alias("n_words"),
                 F.expr("cast(array() as array<array<int>>)").alias("ranges"),
                 F.expr("cast(array() as array<string>)").alias("items"))
    for k in range(shards):
        part = wins.where(F.pmod(F.xxhash64("win"), F.lit(shards)) == k) if shards > 1 else wins
        shared = spark.sparkContext.broadcast([(bytes(r.win), list(r.items), r.n) for r in part.collect()])
        last = k == shards - 1

        def run(batches, key=uuid.uuid4().hex, shared=shared, last=last):
            a = _automaton(key, shared)
            for b in batches:
                n, ranges, items = [], [], []
                for t, r0, i0 in zip(b.column(1), b.column(3).to_pylist(), b.column(4).to_pylist()):
                    c, r, i = scan(a, t.as_py()) if len(a) else (len(words_of(t.as_py())), [], set())
                    n.append(c)
                    ranges.append(merge_ranges(r0 + r) if r0 else r)
                    items.append(sorted({*i0, *i}))
                out = [b.column(0), pa.array(n, pa.int64()), pa.array(ranges, pa.list_(pa.list_(pa.int32()))),
                       pa.array(items, pa.list_(pa.string()))]
                names = ["doc_id", "n_words", "ranges", "items"]
                if last and spans:
                    found = [byte_text_spans(t.as_py(), r) for t, r in zip(b.column(1), out[2].to_pylist())]
                    out.append(pa.array(found, pa.list_(pa.list_(pa.int64()))))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(out if last else [out[0], b.column(1), *out[1:]],
                                                 names=names if last else [names[0], "q_text", *names[1:]])

        more = ", spans array<array<bigint>>" if last and spans else ""
        d = d.mapInArrow(run, f"doc_id {id_type}, {'' if last else 'q_text binary, '}{_OUT}{more}")
    return d


def verdicts(found: DataFrame) -> DataFrame:
    """Digest of ``decontaminate``'s rows."""
    n_hit = F.aggregate("ranges", F.lit(0).cast("bigint"), lambda a, r: a + F.get(r, 1) - F.get(r, 0))
    places = [F.array_join(F.transform("spans", lambda x: F.concat_ws(":", F.get(x, 0).cast("string"), F.get(x, 1).cast("string"))),
                           ",").alias("leaks")] if "spans" in found.columns else []
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"), *places)
