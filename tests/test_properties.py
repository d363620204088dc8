"""Properties: determinism under repartitioning, skew-safe numbering equals
the plain window, metric invariants, and LSH near-duplicates against a
brute-force Jaccard on a small fixture."""

import itertools

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomis.operators import curate as cu
from loomis.operators import evaluate as ev
from loomis.operators import itemic as it
from loomis.plans import bindings as b
from loomis.plans.q_evaluate import matched_candidates
from loomis.plans.sequence import cumulative_within, dense_index, sequence_within


def test_sequence_within_equals_window(spark, sf):
    ev_ = b.table(spark, sf, "events")
    plain = ev_.withColumn("seq", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    buck = sequence_within(ev_.repartition(7), "user_id", ["ts", "event_id"], bucket=F.to_date("ts"))
    a = sorted(plain.select("event_id", "seq").collect())
    bb = sorted(buck.select("event_id", "seq").collect())
    assert a == bb
    cum = cumulative_within(ev_, "user_id", ["ts", "event_id"], F.lit(1).cast("long"), F.to_date("ts"), "c")
    assert sorted(cum.select("event_id", "c").collect()) == a


def test_dense_index_contiguous_and_stable(spark, sf):
    d = b.table(spark, sf, "documents").select("doc_id")
    x = dense_index(d.repartition(5), [F.desc("doc_id")], name="pos", checkpoint=True)
    rows = sorted((r["pos"], r["doc_id"]) for r in x.collect())
    assert [p for p, _ in rows] == list(range(d.count()))
    assert [i for _, i in rows] == sorted((r[0] for r in d.collect()), reverse=True)


def test_shuffle_and_perturb_deterministic(spark, sf):
    d = b.table(spark, sf, "documents").select("doc_id")
    a = sorted(cu.seeded_shuffle(d, "doc_id").select("doc_id", "position").collect())
    c = sorted(cu.seeded_shuffle(d.repartition(1), "doc_id").select("doc_id", "position").collect())
    assert a == c


def test_metric_invariants(spark, sf):
    m = matched_candidates(spark, sf).cache()
    p = ev.pass_at_k(m, ks=(1, 8, 32, 64)).collect()
    by = {}
    for r in p:
        by.setdefault(r["domain"], []).append((r["k"], r["pass_at_k"]))
    for vals in by.values():
        seq = [v for _, v in sorted(vals)]
        assert seq == sorted(seq)  # monotone in k
    for r in ev.mode_comparison(m).collect():
        assert r["pass_mixed"] >= max(r["pass_thinking"], r["pass_non_thinking"])
    q = b.qa(spark, sf)
    f = ev.f1_per_sample(q, ev.extract_options("response"), ev.letters_array("gold"))
    assert f.filter((F.col("f1") < 0) | (F.col("f1") > 1)).count() == 0
    m.unpersist()


def test_codebook_approx_close_to_exact(spark, sf):
    items = b.items(spark, sf)
    ex = {(r["domain"], r["level"]): r["n_distinct"] for r in it.codebook_coverage(items).collect()}
    ap = {(r["domain"], r["level"]): r["n_distinct"] for r in it.codebook_coverage(items, approx=True).collect()}
    for k, v in ex.items():
        assert abs(ap[k] - v) <= max(2, 0.1 * v)


def _jaccard(a, b_):
    return len(a & b_) / len(a | b_) if a | b_ else 1.0


def test_near_duplicates_against_brute_force(spark):
    base = ("the quick brown fox jumps over the lazy dog while the cat sleeps on the warm mat near the door "
            "and birds sing in the tall green trees behind the old house")
    texts = [(1, base), (2, base + " today"), (3, base.replace("lazy", "sleepy")),
             (4, "completely different words about spark joins shuffles partitions and skew handling in clusters"),
             (5, "completely different words about spark joins shuffles partitions and skew handling in clusters now"),
             (6, "short text")]
    df = spark.createDataFrame(texts, "k long, text string")
    got = {r["k"]: r for r in cu.near_duplicates(df, "k", "text", num_perm=64, bands=16, threshold=0.8).collect()}
    sh = {r["k"]: set(r["sh"]) for r in cu.with_word_shingles(df, "text", 5, "sh").collect()}
    for i, j in itertools.combinations(sorted(sh), 2):
        if _jaccard(sh[i], sh[j]) >= 0.8:
            assert got[i]["cluster_id"] == got[j]["cluster_id"], (i, j)
    assert got[4]["cluster_id"] != got[1]["cluster_id"]
    for k, r in got.items():
        assert abs(r["jaccard"] - _jaccard(sh[k], sh[r["cluster_id"]])) < 1e-6


def test_sequence_within_hot_key(spark):
    """One key with ~90% of the rows: the bucketed numbering still equals the
    plain window, and the hot key is split over one bucket per day."""
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = [(0 if i % 10 else 1 + i % 7, base + dt.timedelta(hours=i % 500), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "user long, ts timestamp, id long")
    plain = df.withColumn("seq", F.row_number().over(Window.partitionBy("user").orderBy("ts", "id")))
    buck = sequence_within(df.repartition(6), "user", ["ts", "id"], bucket=F.to_date("ts"))
    assert sorted(plain.select("id", "seq").collect()) == sorted(buck.select("id", "seq").collect())
    days = df.filter("user = 0").select(F.to_date("ts")).distinct().count()
    assert days > 10
