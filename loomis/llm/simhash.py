"""SimHash near-duplicates with a pigeonring filter.

Fingerprints of 64 bits are cut into a ring of segments.  If two fingerprints
differ in at most ``d`` bits, then from some segment on every chain of ``l``
consecutive segments differs in at most ``l * d / m`` bits (the proportional
budget).  With the production parameters (d = 4, m = 5) the budgets are 0, 1,
2, 3, 4 bits: the first segment of the chain agrees and the second differs in
one bit at most.  So each distinct fingerprint is indexed under its pairs of
neighbouring segments and also sent to the keys with one bit of the second
segment flipped; the rows that meet under a key pass the chain test for every
length before the full Hamming check.  Keys are 25 or 26 bits wide.

Copies are folded to distinct fingerprints before anything is indexed.  A key's
rows are read in sorted order and reduced to a spanning forest of its links, so
no task emits pairs; a dense group stops as soon as it is connected.

Defined cases: null and empty texts have fingerprint zero, linked like any
other; repeated rows get equal results; a null id takes part, but a component's
id is its smallest non-null id (null if there is none); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import LOWER_ASCII, cut, text_of
from .components import components

SEED = 42
SHINGLE = 4
MAX_BITS = 4
SEGMENTS = 5


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """64-bit SimHash of the lower-cased word shingles of one UTF-8 text."""
    words = text.translate(LOWER_ASCII).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - k + 1)
    last = ends[k - 1:] if len(words) >= k else ends[-1:]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, dtype=np.int64)
    for a in range(0, n, 1 << 15):
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[a:n][:1 << 15].tolist(),
                                                                   last[a:][:1 << 15].tolist())), np.uint64)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) with the fingerprint's bits in a signed long."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("q_text"))
    src = src.select("doc_id", text_of("q_text").cast("binary").alias("q_text"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py(), k) for x in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return src.mapInArrow(run, f"doc_id {id_type}, fp bigint")


def segments_of(m: int) -> list[tuple[int, int]]:
    """(shift, width) of the m ring segments, widths as equal as can be."""
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _key(fps: np.ndarray, i: int, seg: list[tuple[int, int]]) -> np.ndarray:
    (s0, w0), (s1, w1) = seg[i], seg[(i + 1) % len(seg)]
    one = np.uint64(1)
    first = (fps >> np.uint64(s0)) & ((one << np.uint64(w0)) - one)
    second = (fps >> np.uint64(s1)) & ((one << np.uint64(w1)) - one)
    return (np.uint64(i) << np.uint64(56)) | (first << np.uint64(w1)) | second


def index_rows(fps: np.ndarray, m: int = SEGMENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, probe, fp) rows: each fingerprint once under each of its chains'
    keys (probe 0) and once for each flipped bit of the second segment."""
    seg = segments_of(m)
    keys, probe, who = [], [], []
    for i in range(m):
        base = _key(fps, i, seg)
        for flip in [None, *range(seg[(i + 1) % m][1])]:
            keys.append(base if flip is None else base ^ (np.uint64(1) << np.uint64(flip)))
            probe.append(np.full(len(fps), flip is not None))
            who.append(fps)
    return np.concatenate(keys), np.concatenate(probe), np.concatenate(who)


def chain_ok(x: np.ndarray, i: int, m: int, d: int) -> np.ndarray:
    """Pigeonring test of the differences ``x``: every chain from segment ``i``
    stays within its proportional budget."""
    seg = segments_of(m)
    total = np.zeros(x.shape, dtype=np.int64)
    ok = np.ones(x.shape, dtype=bool)
    for length in range(1, m + 1):
        s, w = seg[(i + length - 1) % m]
        total += np.bitwise_count((x >> np.uint64(s)) & np.uint64((1 << w) - 1))
        ok &= total <= length * d // m
    return ok


def forest(index: np.ndarray, probes: np.ndarray, i: int, m: int, d: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between index rows and all rows of one key.
    Each index row is tried against all rows until one component is left; rows
    that fail the chain test here are met under another key if they link."""
    nodes = np.unique(np.concatenate([index, probes]))
    label = np.arange(len(nodes))
    out: list[tuple[int, int]] = []
    parts = len(nodes)
    for p in np.unique(index):
        if parts == 1:
            break
        x = nodes ^ p
        near = chain_ok(x, i, m, d)
        near[near] = np.bitwise_count(x[near]) <= d
        groups = np.unique(label[near])
        if len(groups) > 1:
            out += [(int(nodes[groups[0]]), int(nodes[g])) for g in groups[1:]]
            label[np.isin(label, groups)] = groups[0]
            parts -= len(groups) - 1
    return out


def _links(batches, m: int, d: int):
    """Read (key, probe, fp) rows sorted by key and yield forests' edges."""
    rest = [np.empty(0, np.uint64), np.empty(0, bool), np.empty(0, np.uint64)]

    def edges(key, probe, fp):
        found: list[tuple[int, int]] = []
        if len(key):
            start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            end = np.concatenate((start[1:], [len(key)]))
            has = np.add.reduceat(~probe, start) > 0
            for a, b in zip(start[has & (end - start > 1)].tolist(), end[has & (end - start > 1)].tolist()):
                own = fp[a:b]
                ix = own[~probe[a:b]]
                found += forest(ix, own[probe[a:b]], int(key[a] >> np.uint64(56)), m, d)
        e = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(e[:, 0].copy()), pa.array(e[:, 1].copy())], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64),
                batch.column(1).to_numpy(zero_copy_only=False),
                batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)]
        cols = [np.concatenate(x) for x in zip(rest, cols)]
        whole = np.searchsorted(cols[0].view(np.int64), cols[0].view(np.int64)[-1], side="left")  # the last key may go on
        rest = [c[whole:] for c in cols]
        yield edges(*[c[:whole] for c in cols])
    yield edges(*rest)


def near_links(fps: DataFrame, m: int = SEGMENTS, d: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints within ``d`` bits whose
    transitive closure is that of all such pairs.  ``fps``: distinct ``fp``."""
    if m <= d:
        raise ValueError("the ring needs more segments than differing bits")

    def rows(batches):
        for b in batches:
            f = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for a in range(0, len(f), 4096):
                k, p, w = index_rows(f[a:a + 4096], m)
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(p), pa.array(w.view(np.int64))],
                                                 names=["key", "probe", "fp"])

    ix = fps.select("fp").mapInArrow(rows, "key bigint, probe boolean, fp bigint")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ix = ix.repartition(n, "key").sortWithinPartitions("key")
    return ix.mapInArrow(lambda it: _links(it, m, d), "a bigint, b bigint")


def simhash_groups(docs: DataFrame, k: int = SHINGLE, d: int = MAX_BITS, m: int = SEGMENTS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row."""
    fp = cut(fingerprints(docs, k=k), "simhash")
    distinct = fp.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = components(near_links(distinct, m, d)).select(F.col("node").alias("fp"), "root")
    known = distinct.join(roots, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    best = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = known.join(best, "root").select("fp", "component_id")
    return fp.join(of, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
