"""Bindings of the operators to the driver tables.

The driver ships star-schema tables plus documents / conversations / events.
These functions derive, with plain DataFrame operations, the inputs the
evaluation and history operators expect:

* ``history``     H: per-user ordered item history (orders join lineitem)
* ``targets``     last item per user
* ``items``       item catalogue with itemic codes (from part)
* ``candidates``  64 generations per prompt, 32 thinking + 32 non-thinking
* ``qa``          option-set answers (labels join documents)
* ``submissions`` team submissions (events)
* ``run_metrics_table`` per-run training log (events)
* ``logits``      next-token score table (lineitem)

Every binding reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomis.operators.itemic import itemic_token
from loomis.plans.sequence import sequence_within, tasks_for
from loomis.schemas import CANDIDATES_PER_MODE, CANDIDATES_TOTAL, ITEMIC_DOMAINS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def history_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Partitions for the history's rows (a count from the files' footers)."""
    lines = table(spark, sf_dir, "lineitem")
    return tasks_for(lines, lines.count())


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item, ts, seq): every purchased part of a customer, numbered
    in time order with a full tie-break (line numbers repeat within an order).
    Numbering is bucketed by order day so one heavy customer spreads over
    many tasks (see ``sequence_within``), and tasks are as many as the lines ask for."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    tasks = history_tasks(spark, sf_dir)
    joined = orders.repartition(tasks, "o_orderkey").join(lines.repartition(tasks, "l_orderkey"),
                                                          orders.o_orderkey == lines.l_orderkey)
    numbered = sequence_within(
        joined, "o_custkey",
        ["o_orderdate", "o_orderkey", "l_linenumber", "l_partkey"],
        bucket=F.col("o_orderdate"), tasks=tasks)
    return numbered.select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item"),
                           F.col("o_orderdate").alias("ts"), "seq")


def targets(h: DataFrame) -> DataFrame:
    """Last item per user: an aggregate (``max_by``), partially combined before
    the shuffle, instead of a per-user window."""
    return h.groupBy("user_id").agg(F.max_by("item", "seq").alias("target"),
                                    F.max("seq").alias("n_events"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item catalogue: (item, description, domain, a, b, c, token)."""
    part = table(spark, sf_dir, "part")
    dom = F.element_at(F.array(*[F.lit(d) for d in ITEMIC_DOMAINS]),
                       (F.col("p_partkey") % len(ITEMIC_DOMAINS) + 1).cast("int"))
    out = part.select(
        F.col("p_partkey").alias("item"), F.col("p_name").alias("description"),
        dom.alias("domain"),
        (F.col("p_partkey") * 7919 % 8192).cast("int").alias("a"),
        (F.col("p_partkey") * 104729 % 8192).cast("int").alias("b"),
        (F.col("p_partkey") * 1299709 % 8192).cast("int").alias("c"))
    return out.withColumn("token", itemic_token(F.col("domain"), F.col("a"), F.col("b"), F.col("c")))


def candidates(spark: SparkSession, sf_dir: str, h: DataFrame | None = None) -> DataFrame:
    """(prompt_id, attempt, mode, response, target, domain): attempts are
    generated by ``explode(sequence(1, 64))`` (no join), the catalogue size is
    a scalar subquery."""
    h = h if h is not None else history(spark, sf_dir)
    n_items = table(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()
    t = targets(h)
    att = F.col("attempt")
    off = F.when(att <= CANDIDATES_PER_MODE, (F.col("user_id") + 7 * att) % 60) \
           .otherwise((F.col("user_id") + att * att) % 60)
    cand = (t.select("user_id", "target", F.explode(F.sequence(F.lit(1), F.lit(CANDIDATES_TOTAL))).alias("attempt"))
             .select(F.col("user_id").alias("prompt_id"), F.col("attempt").cast("long").alias("attempt"),
                     F.when(att <= CANDIDATES_PER_MODE, F.lit("thinking")).otherwise(F.lit("non_thinking")).alias("mode"),
                     ((F.col("target") + off) % n_items).alias("response"), "target"))
    dom = F.element_at(F.array(*[F.lit(d) for d in ITEMIC_DOMAINS]),
                       (F.col("target") % len(ITEMIC_DOMAINS) + 1).cast("int"))
    return cand.withColumn("domain", dom)


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, gold, response): gold option letters from the labels, a textual
    answer in the usual "正确答案是 X" form built from document facts."""
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    j = labels.join(docs, "doc_id")
    gold = F.concat_ws("", F.when(F.col("quality") == 1, F.lit("A")), F.when(F.col("toxic") == 1, F.lit("B")))
    pred = F.concat_ws("、", F.when(F.col("n_chars") > 500, F.lit("A")), F.when(F.col("lang") != "en", F.lit("B")))
    return j.select("doc_id", gold.alias("gold"), F.concat(F.lit("正确答案是 "), pred).alias("response"))


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("team"), F.col("event_id").alias("id"),
                     F.col("ts"), F.col("value").alias("score"))


def ntile_of(rank, n, buckets: int):
    """``ntile(buckets)`` from a 1-based rank and the group size: the first
    ``n % buckets`` tiles hold one extra row (same rule as the SQL function)."""
    q = F.floor(n / buckets)
    rem = n % buckets
    big = rem * (q + 1)
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1) \
            .otherwise(rem + F.floor((rank - big - 1) / F.greatest(q, F.lit(1))) + 1).cast("long")


def run_metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, step, ts, loss, epoch): events as a training log; pseudo-epoch is
    ``ntile(5)`` of the run's steps.  Steps are numbered with the day-bucketed
    ``sequence_within`` and the tile is computed from the run's step count (an
    aggregate), so no window holds a whole run."""
    ev = table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), "ts", "event_id",
                                               F.col("value").alias("loss"))
    seq = sequence_within(ev, "run", ["ts", "event_id"], bucket=F.to_date("ts"), name="step")
    n = ev.groupBy("run").agg(F.count(F.lit(1)).alias("_n"))
    return seq.join(n, "run").select("run", "step", "ts", "loss",
                                     ntile_of(F.col("step"), F.col("_n"), 5).alias("epoch"))


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(prompt_id, token, logit), dealt by prompt to as many tasks as the lines
    ask for, so that windows and groups by prompt need no other exchange and
    their sorts take the same memory however many lines there are."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    return (li.repartition(history_tasks(spark, sf_dir), "l_orderkey")
              .groupBy(F.col("l_orderkey").alias("prompt_id"), F.col("l_partkey").alias("token"))
              .agg((F.sum("l_extendedprice") / 10000).alias("logit")))
