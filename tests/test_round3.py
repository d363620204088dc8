"""Findings of round 3: whole jobs, linear window counts, batched stream state,
let-bound option heads, tasks sized by the input."""

import datetime as dt
import random
import tempfile
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loomis.operators import intervals as iv
from loomis.operators import records as rc
from loomis.plans import bindings, sequence
from loomis.plans.registry import load_all
from loomis.streaming import streams as st

QUERIES, ORACLE = load_all()
DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def shop(spark):
    """Customer 2 has no order, customer 3 an order without lines, customer 4
    no urgent order."""
    base = tempfile.mkdtemp(prefix="shop-", dir="/tmp")
    tables = {
        "customer": ([(i, f"c{i}") for i in range(1, 5)], "c_custkey long, c_name string"),
        "orders": ([(10, 1, DAY, "1-URGENT"), (11, 3, DAY, "1-URGENT"), (12, 4, DAY, "5-LOW")],
                   "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string"),
        "lineitem": ([(10, 7, 1), (12, 8, 1)], "l_orderkey long, l_partkey long, l_linenumber int")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/{name}.parquet")
    return base


def test_missing_generations_reads_the_whole_history(spark, shop):
    assert sorted(r.c_custkey for r in QUERIES["missing_generations"](spark, shop).collect()) == [2, 3]
    assert "lineitem" in ORACLE["missing_generations"] and "URGENT" not in ORACLE["missing_generations"]


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_option_heads_are_split_once(spark):
    df = spark.createDataFrame([(1, "Which? A.x B.y C.z\nJ.u U.S. v /no_think"), (2, "none"), (3, None)], "k long, q string")
    out = rc.choice_options(df, "k", "q")
    assert [(r.k, r.letter, r.text, r.n_options) for r in out.collect()] == [
        (1, "A", "x", 4), (1, "B", "y", 4), (1, "C", "z", 4), (1, "J", "u U.S. v", 4)]
    assert _plan(out).count("split(") == 1


def test_covered_prompts_reads_the_whole_history(spark, shop):
    assert sorted(r.c_custkey for r in QUERIES["covered_prompts"](spark, shop).collect()) == [1, 4]
    assert "lineitem" in ORACLE["covered_prompts"] and "URGENT" not in ORACLE["covered_prompts"]


def test_quota_settles_many_teams_in_a_call(spark, monkeypatch):
    """Two micro-batches of a day: ranks go on, per team; at most one state
    record for a group of teams."""
    monkeypatch.setattr(st, "QUOTA_GROUPS", 2)
    base = tempfile.mkdtemp(prefix="quota-", dir="/tmp")
    rnd, t0 = random.Random(5), dt.datetime(2024, 1, 1, 8)
    rows = [(rnd.choice([None, *range(40)]), i, t0 + dt.timedelta(seconds=rnd.randrange(2000) + 4000 * (i > 150))) for i in range(300)]
    schema = "team long, id long, ts timestamp"
    for part in (rows[:151], rows[151:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        st.run_to_completion(st.stream_daily_quota(st.file_stream(spark, f"{base}/in", schema)), f"{base}/out", f"{base}/ckpt", n_state=2)
    want, order = [], defaultdict(int)
    for team, i, _ in sorted(rows, key=lambda r: (r[2], r[1])):
        order[team] += 1
        if order[team] <= 3:
            want.append((team, "2024-01-01", i, order[team]))
    got = [tuple(r) for r in spark.read.parquet(f"{base}/out").select("team", "day", "id", "rank").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert spark.read.format("statestore").load(f"{base}/ckpt").count() == 3


def test_interval_counts_equal_the_counted_join(spark):
    rnd = random.Random(7)
    points = [(rnd.choice([None, *range(200)]), rnd.choice([None, "a", "b", "c", "d"])) for _ in range(300)]
    spans = [(rnd.randrange(60), rnd.choice([None, 1, 2]), s, s + rnd.choice([-1, 0, 3, 10, 50])) for s in
             (rnd.randrange(-20, 220) for _ in range(80))]
    spans += spans[:20] + [(900, None, None, 5), (901, 1, 5, None), (902, 1, -50, 400), (902, 1, -50, 400)]
    p = spark.createDataFrame(points, "at long, v string")
    v = spark.createDataFrame(spans, "k long, g long, s long, e long")
    args = (F.col("s"), F.col("e"))
    got = iv.interval_counts(p, F.col("at"), F.col("v"), v, *args, ["k", "g"])
    want = iv.interval_join(p, F.col("at"), v, *args).groupBy("k", "g").agg(F.count(F.lit(1)), F.count_distinct("v"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_windows_of_repeated_submissions(spark):
    """Against the pairs, with ids that come twice, at one time and at two, and no join of submissions by block."""
    base = tempfile.mkdtemp(prefix="events-", dir="/tmp")
    rnd, t0 = random.Random(3), dt.datetime(2024, 1, 1, 8)
    rows = [(rnd.randrange(100), rnd.choice([None, *range(6)]), t0 + dt.timedelta(seconds=rnd.randrange(9000), microseconds=7), 1.0)
            for _ in range(120)]
    rows += rows[:30] + [(500, 1, None, 1.0), (None, 2, t0, 1.0)]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, value double").coalesce(1) \
        .write.parquet(f"{base}/events.parquet")
    out = QUERIES["submissions_in_windows"](spark, base)
    want = defaultdict(list)
    sec = [(i, u, t and int((t - t0).total_seconds())) for i, u, t, _ in rows]
    for i, u, s in sec:
        if i is not None and s is not None:
            want[i, u] += [v for _, v, x in sec if x is not None and s <= x <= s + 60 * (i % 30)]
    got = {(r.window_id, r.window_team): (r.n_submissions, r.n_teams) for r in out.collect()}
    assert got == {k: (len(v), len({x for x in v if x is not None})) for k, v in want.items()}


def test_history_tasks_grow_with_the_lines(spark, shop, monkeypatch):
    monkeypatch.setattr(sequence, "ROWS_PER_TASK", 1)
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    big = spark.range(own + 3)
    assert sequence.tasks_for(big, big.count()) == own + 3 and sequence.tasks_for(big, 1) == own
    monkeypatch.setattr(bindings, "tasks_for", lambda df, n: 7)
    for out in (bindings.history(spark, shop), QUERIES["perturb_history"](spark, shop)):
        assert out.rdd.getNumPartitions() == 7
        assert sorted((r.user_id, r.seq, r.item) for r in out.collect()) == [(1, 1, 7), (4, 1, 8)]
