"""Radix select, token budgets, smoothing as a scan, interval join, metric
registry and stored sketches against plain versions."""

import random
import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomis.functions.text import seeded_key
from loomis.operators import curate as cu
from loomis.operators import intervals as iv
from loomis.operators import metrics as mt
from loomis.operators import runs as ru
from loomis.operators import sketches as sk
from loomis.operators import tokens as tk
from loomis.session import scratch_path


# ------------------------------------------------------------ D2
def plain_balance(df, target, seed=42):
    n = df.groupBy(F.col("c").alias("c2")).agg(F.count(F.lit(1)).alias("n"))
    rep = df.join(n, F.col("c").eqNullSafe(F.col("c2"))).select("c", "k", F.explode(F.sequence(
        F.lit(1), F.greatest(F.lit(1), F.ceil(F.lit(target) / F.col("n")).cast("int")))).alias("copy"))
    w = Window.partitionBy("c").orderBy("copy", seeded_key("k", seed))
    return rep.withColumn("r", F.row_number().over(w)).where(F.col("r") <= target)


@pytest.mark.parametrize("target", [1, 7, 300, 5000])
def test_radix_select_equals_the_sorted_form(spark, target):
    rows = [("hot", i) for i in range(6000)] + [("small", i) for i in range(11)] + [("one", 1), (None, 5), (None, 6)]
    df = spark.createDataFrame(rows, "c string, k long").repartition(5)
    got = cu.balance_categories(df, "c", "k", target)
    as_counter = lambda d: Counter((r.c, r.k, r.copy) for r in d.collect())
    assert as_counter(got) == as_counter(plain_balance(df, target))
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The one window over rows takes those of equal hash together, not a category.
    spec = re.findall(r"row_number\(\) windowspecdefinition\(c#\d+, (\w+)#", plan)
    assert spec and set(spec) == {"_h"}


def test_radix_select_with_equal_keys(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [("a", 2)] * 4, "c string, k long")
    for target in range(1, 12):
        got = cu.balance_categories(df, "c", "k", target).collect()
        assert len(got) == target
    assert cu.balance_categories(df.limit(0), "c", "k", 3).count() == 0


# ------------------------------------------------------------ X5 / A18
def test_no_batch_is_above_the_budget(spark):
    rng = random.Random(0)
    sizes = [rng.choice([0, 1, 5, 63, 64, 65, 100, 500, 2048, 9000]) for _ in range(500)] + [128] * 700
    rows = [(i, [7] * n) for i, n in enumerate(sizes)] + [(9999, None)]
    d = tk.budget_batches(spark.createDataFrame(rows, "k long, ids array<int>").repartition(6), "k", "ids", 4096, 64).cache()
    assert d.count() == len(rows)
    batches = {}
    for r in d.collect():
        assert 0 <= r.n_pad < 64 and r.n_real == len(dict(rows)[r.k] or [])
        batches.setdefault((r.length_class, r.batch), []).append(r)
    for members in batches.values():
        size = len(members) * max(m.n_real for m in members)
        assert size <= 4096 or (len(members) == 1 and members[0].over_budget)
    report = {r.length_class: r for r in tk.budget_report(d, 4096).collect()}
    assert report[9024].n_over_budget == sizes.count(9000) == report[9024].n_batches
    assert report[128].largest_batch == 4096 and sum(r.n_samples for r in report.values()) == len(rows)
    # Every batch of a class but its last one is as full as the class allows.
    full = Counter(c for c, b in batches if len(batches[c, b]) == max(1, 4096 // c))
    assert all(full[c] >= report[c].n_batches - 1 for c in report)


# ------------------------------------------------------------ A17
@pytest.mark.parametrize("alpha", [0.01, 0.1, 0.9])
def test_smoothing_as_a_scan(spark, alpha):
    rng = random.Random(4)
    runs = {1: 3000, 2: 256, 3: 257, 4: 1}
    rows = [(r, t, rng.uniform(0, 5)) for r, n in runs.items() for t in range(1, n + 1)]
    want = {}
    for r, t, x in rows:
        s, best = want.get((r, t - 1), (x, x))
        want[r, t] = ((1 - alpha) * s + alpha * x if t > 1 else x, min(best, x))
    df = spark.createDataFrame(rows, "run long, step long, loss double").repartition(7)
    got = {(r.run, r.step): (r.smoothed, r.best) for r in ru.smoothed_series(df, alpha).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)


def test_smoothing_rejects_other_weights(spark):
    with pytest.raises(ValueError):
        ru.smoothed_series(spark.createDataFrame([], "run long, step long, loss double"), 1.0)


# ------------------------------------------------------------ J6
def test_interval_join_equals_the_nested_loop(spark):
    rng = random.Random(9)
    phases = [(i, s, s + rng.choice([-1, 0, 1, 2, 7, 100, 5000, 60_000])) for i, s in
              ((i, rng.randrange(-50_000, 50_000)) for i in range(10_000))] + [(10_000, None, 5), (10_001, 1, None)]
    points = [(i, rng.randrange(-60_000, 120_000)) for i in range(300)] + [(300, None), (301, 0), (302, 10 ** 12)]
    p = spark.createDataFrame(points, "p long, at long").repartition(3)
    v = spark.createDataFrame(phases, "v long, s long, e long").repartition(3)
    want = Counter((i, j) for i, x in points if x is not None for j, s, e in phases if s is not None and e is not None and s <= x <= e)
    got = iv.interval_join(p, F.col("at"), v, F.col("s"), F.col("e"))
    assert Counter((r.p, r.v) for r in got.select("p", "v").collect()) == want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    left = iv.interval_join(p, F.col("at"), v, F.col("s"), F.col("e"), "left")
    hit = {i for i, _ in want}
    assert Counter((r.p, r.v) for r in left.select("p", "v").collect()) == want + Counter(
        (i, None) for i, _ in points if i not in hit)
    assert iv.interval_join(p, F.col("at"), v.limit(0), F.col("s"), F.col("e")).count() == 0
    assert iv.interval_join(p, F.col("at"), v.limit(0), F.col("s"), F.col("e"), "left").count() == len(points)


# ------------------------------------------------------------ metric registry / A11
def test_a_users_metric_needs_no_change_here(spark):
    df = spark.createDataFrame([("a", "x", True, 3), ("a", "y", False, 1), (None, "x", True, 2)],
                               "domain string, mode string, hit boolean, attempt long")
    mt.register_metric("mean_attempt", "round(avg(attempt), 2)", replace=True)
    mt.register_metric("spread", lambda: F.max("attempt") - F.min("attempt"), replace=True)
    got = {(r.domain, r.mode, r.gid): (r.hit_rate, r.mean_attempt, r.spread) for r in mt.scoreboard(
        df, ["hit_rate", "mean_attempt", "spread"], [("domain", "mode"), ("domain",), ()]).collect()}
    assert got == {("a", "x", 0): (1.0, 3.0, 0), ("a", "y", 0): (0.0, 1.0, 0), (None, "x", 0): (1.0, 2.0, 0),
                   ("a", None, 1): (0.5, 2.0, 2), (None, None, 1): (1.0, 2.0, 0), (None, None, 3): (0.666667, 2.0, 2)}
    assert mt.scoreboard(df, ["n_candidates"], [()]).first().n_candidates == 3
    with pytest.raises(ValueError):
        mt.register_metric("hit_rate", "1")
    with pytest.raises(KeyError):
        mt.metric("nothing")


# ------------------------------------------------------------ A14 / A17
def test_merged_sketches_estimate_the_whole(spark):
    rows = [(d, i % 3, (i * 7919) % 20_000, float(i % 1000)) for d in range(4) for i in range(d * 5000, d * 5000 + 9000)]
    df = spark.createDataFrame(rows, "day int, g int, item long, x double").repartition(6)
    path = scratch_path(spark, "sketches", uuid.uuid4().hex)
    sk.write_sketches(df.where("day = 3").limit(10), path, "day", ["g"], ["item"], ["x"])
    sk.write_sketches(df, path, "day", ["g"], ["item"], ["x"])         # a part written again is replaced
    for parts in (None, [0, 2]):
        some = df if parts is None else df.where(F.col("day").isin(parts))
        got = {r.g: r for r in sk.merged(spark, path, ["g"], (0.1, 0.5, 0.99), parts, "day").collect()}
        for r in some.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("item").alias("items"),
                                       F.sort_array(F.collect_list("x")).alias("xs")).collect():
            m = got[r.g]
            assert m.n == r.n and abs(m.distinct_item - r["items"]) <= 0.06 * r["items"]
            for q, v in ((0.1, m.q10_x), (0.5, m.q50_x), (0.99, m.q99_x)):
                below = sum(x < v for x in r.xs) / r.n
                assert abs(below - q) <= 0.02
