"""Repeated passages against brute force."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from test_small_ops import docs_of, sample_texts

from loomis.llm import repeats
from loomis.llm.repeats import maximal_repeats, remove_repeats


def brute(rows, span=50):
    """rows: (doc_id, text) -> sorted digests."""
    data = [(d if d is not None else 1 << 62, (t or "").encode()) for d, t in rows]
    least: dict[bytes, int] = {}
    for d, b in data:
        for i in range(len(b) - span + 1):
            s = b[i:i + span]
            least[s] = min(d, least.get(s, d))
    out = []
    for (d0, _), (d, b) in zip(rows, data):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1):
            if least[b[i:i + span]] < d:
                gone[i:i + span] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((d0, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()], key=str)


def passages(seed):
    rng = random.Random(seed)
    v = ["alpha ", "beta ", "é", "gamma\n", "x", "yz ", "\x00", "delta, "]
    word = lambda n: "".join(rng.choice(v) for _ in range(n))
    shared = [word(rng.randrange(8, 60)) for _ in range(6)]
    texts = sample_texts(seed, 30) + ["a" * 49, "a" * 50, "a" * 51, "a" * 120, "ab" * 60, "b" + "ab" * 30]
    for _ in range(50):
        t = word(rng.randrange(20))
        for _ in range(rng.randrange(4)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            t += rng.choice([s, s[a:], s[:a]]) + word(rng.randrange(9))
        texts.append(t)
    rng.shuffle(texts)
    return texts


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 700)
    for seed in (1, 2):
        texts = passages(seed)
        assert got(remove_repeats(docs_of(spark, texts))) == brute(list(enumerate(texts)))


def test_null_and_repeated_ids(spark):
    p = "a passage of more than fifty bytes that is found in several documents. "
    rows = [(5, p), (5, p + "tail"), (None, "x" + p), (None, p), (7, None), (9, p * 2), (2, "short")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(remove_repeats(d)) == brute(rows)
    assert remove_repeats(d.where("false")).collect() == []


def test_long_text(spark):
    long = "".join(chr(97 + x) for x in np.random.default_rng(1).integers(0, 26, 300_000))
    rows = [(1, long), (2, "z" + long[1000:200_000]), (3, "clean text")]
    r = {x.doc_id: x for x in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert r[2].spans == [[1, 199_001]] and r[1].n_removed == 0 and r[3].n_removed == 0


def test_maximal_repeats_have_all_occurrences():
    pieces = [b"xabcdefgh", b"yabcdefgh", b"zabcdefqq"]
    found = {(n, tuple(sorted(o))) for n, o in maximal_repeats(pieces, [2, 2, 2], span=5)}
    assert found == {(8, ((0, 1), (1, 1))), (6, ((0, 1), (1, 1), (2, 1)))}
    same_left = [b"xabcdef1", b"xabcdef2"]
    found = list(maximal_repeats(same_left, [2, 2], span=5))
    assert [n for n, _ in found] == [7]  # "abcdef" extends to the left: not maximal


def licensed(n):
    rng = np.random.default_rng(9)
    line = "".join(chr(97 + x) for x in rng.integers(0, 26, 60))
    sides = rng.integers(0, 26, (n, 2, 40)) + 97
    return [bytes(a.tolist()).decode() + line + bytes(b.tolist()).decode() for a, b in sides]


def test_crowded_anchors(spark):
    # A 60-byte line between unique bytes, in more documents than may meet in one suffix array.
    texts = licensed(3000) + passages(3)
    assert got(remove_repeats(docs_of(spark, texts), crowd=50)) == brute(list(enumerate(texts)))


def test_edge_pieces_of_a_crowded_anchor_spread():
    texts = [t.encode() for t in licensed(3000)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    h, j0, j1 = repeats.anchors(data, np.arange(len(texts) + 1) * 140)
    key, inverse, n = np.unique(h, return_inverse=True, return_counts=True)
    assert len({data[a:b + 50].tobytes() for a, b in zip(j0[h == key[n.argmax()]], j1[h == key[n.argmax()]])}) > 1000
    h, j0, j1 = repeats.spread(data, h, j0, j1, (n > 100)[inverse])
    groups = {}
    for k, a, b in zip(h.tolist(), j0.tolist(), j1.tolist()):
        groups.setdefault(k, set()).add(data[a:b + 50].tobytes())
    assert max(map(len, groups.values())) <= 100


def test_buckets_follow_the_corpus(spark):
    texts = passages(4) * 2
    docs = docs_of(spark, texts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        dealt = docs.repartition("doc_id").localCheckpoint()
        n = len({r[0] for r in dealt.select(F.spark_partition_id()).collect()})
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert repeats.bucket_count(repeats.pack(dealt, "doc_id", "text", 3)) == n // repeats.BUCKET_CHUNKS > 3
        assert got(remove_repeats(dealt)) == brute(list(enumerate(texts)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranges_hold_whole_keys(monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", 20)
    for seed in range(20):
        keys = np.random.default_rng(seed).integers(0, 60, seed * 9).astype(np.uint32)
        _, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
        parts = list(repeats.repeated(keys))
        assert sorted(np.concatenate([[], *parts]).tolist()) == np.flatnonzero(n[inverse] > 1).tolist()
        for i, p in enumerate(parts):
            assert len(p) <= 20 + n.max() and (np.diff(keys[p].astype(int)) >= 0).all()
            assert not {*keys[p]} & {int(k) for q in parts[:i] for k in keys[q]}


def test_bucket_memory_and_spans():
    # 200,000 pieces of one window, each twice: the larger document's go.
    rng, n = np.random.default_rng(6), 100_000
    rem = rng.permutation(n).astype("<u4")
    text = repeats.squeezed(rng.integers(0, 256, (n, 50)).astype(np.uint8).tobytes())
    row = [rem.tobytes(), None, (np.arange(n) * 9).astype("<i4").tobytes(), np.ones(n, "u1").tobytes(), text, b""]
    rows = [[0, c, *row[:1], np.full(n, d, "<i8").tobytes(), *row[2:]] for c, d in ((7, 3), (8, 1))]
    names = ["bucket", "chunk", "rem", "doc", "start", "starts", "text", "done"]
    t = pa.table({c: [r[i] for r in rows] for i, c in enumerate(names)})
    tracemalloc.start()
    out = repeats.resolve(t)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6, peak
    spans = {r["chunk"]: np.frombuffer(r["spans"], "<i4").reshape(-1, 2) for r in out.to_pylist()}
    assert list(spans) == [7] and sorted(spans[7].tolist()) == [[9 * i, 9 * i + 50] for i in range(n)]
