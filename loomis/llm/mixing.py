"""Mixing sources to target weights by entropy balancing.

Document ``i`` of source ``s`` with ``n_i`` words gets a rate ``r_i`` as close
to 1 as possible (relative entropy, 0 <= r_i <= cap) under the token
constraint ``sum n_i r_i = T_s``.  The convex dual has one multiplier per
source and the rates are exponentially tilted: ``r_i = min(cap, exp(l_s x_i))``
with ``x_i = n_i / (n_i + c_s)``, the bounded form of the document's size
(``c_s``: the source's mean size), which keeps the few longest documents from
taking the whole tilt.  Newton iterations, with bisection as safeguard, solve
the dual.  A document enters only through (source, size), so each iteration is
one aggregation over the counts of sizes, in whole numbers, which makes reruns
agree whatever the order of the sums.

Rates become copies by error diffusion: longest first, the rounding error in
words is carried on to the next document.  Documents with over 1/1000 of their
source's words (fewer than 1000 in any source) are rounded together; the dual
is then solved again for the rest under the words still missing, and the rest is
dealt by a hash into buckets of bounded size, each of which ends within about
its shortest documents' size of its share.

Defined cases: null text has size 0; null source is a source of its own and
ranks last; documents without words get one copy and take no words; a source
without words has target 0; repeated rows are documents of their own (equal
rows may differ in copies); an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import WORD_RE, cut, text_of

WEIGHTS = (5, 2, 1)
TOTAL_PERCENT = 150
CAP = 2
BUCKET_ROWS = 20_000
HEAVY = 1000  # documents above 1/HEAVY of their source's words are rounded together
UNIT = 1 << 20  # rates are summed in these parts of a word


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size) per row."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("q_source"), F.col(text_col).alias("q_text"))
    return d.select("doc_id", F.col("q_source").alias("source"),
                    F.regexp_count(text_of("q_text"), F.lit(WORD_RE)).cast("long").alias("size"))


def targets(cells: DataFrame, weights=WEIGHTS, percent: int = TOTAL_PERCENT, cap: int = CAP) -> DataFrame:
    """(source, rank, weight, n_docs, source_size, target): the water level mu
    with sum(min(cap * size, weight * mu)) = total.  One row per source, so the
    windows run over the mixture's configuration, not over documents."""
    s = cells.groupBy("source").agg(F.sum("n").alias("n_docs"), F.sum(F.col("n") * F.col("size")).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = s.withColumn("rank", rank).withColumn("weight", w)
    s = s.withColumn("room", (cap * F.col("source_size")).cast("double"))
    # Fill sources in the order in which they run full; the level holds from
    # the first source that does not.
    order = Window.orderBy(F.col("room") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({"all_words": F.sum("source_size").over(Window.partitionBy()),
                       "all_weight": F.sum("weight").over(Window.partitionBy()),
                       "full": F.coalesce(F.sum("room").over(before), F.lit(0.0)),
                       "full_weight": F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    mu = (F.col("all_words") * (percent / 100.0) - F.col("full")) / (F.col("all_weight") - F.col("full_weight"))
    s = s.withColumn("mu", mu)
    level = F.max(F.when(F.col("weight") * F.col("mu") <= F.col("room"), F.col("mu"))).over(Window.partitionBy())
    return s.withColumn("level", level).select(
        "source", "rank", "weight", "n_docs", F.col("source_size").cast("long").alias("source_size"),
        F.when(F.col("level").isNull(), F.col("room")).otherwise(F.least("room", F.col("weight") * F.col("level")))
        .alias("target"))


def _feature(size: Column, n_docs: Column, source_size: Column) -> Column:
    """Bounded size: n / (n + mean)."""
    mean = source_size / n_docs
    return F.when(size > 0, size / (size + mean)).otherwise(F.lit(0.0))


def _rate(lam: Column, x: Column, cap: int) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(lam * x, F.lit(math.log(cap) + 1))))


def balance(cells: DataFrame, goal: DataFrame, cap: int = CAP, rounds: int = 40, tol: float = 1e-7) -> DataFrame:
    """Newton iterations on the dual: (source, lam), lam null where every rate
    is 0 (no words wanted) or ``cap`` (all that may be taken is wanted).
    ``cells``: (source, x, words), the words of documents with feature x;
    ``goal``: (source, target).  A round is one map-side combined aggregation
    with one output row per source; the multipliers stay in a table."""
    open_ = cells.groupBy(F.col("source").alias("o_source")).agg(F.sum("words").alias("all_words")) \
        .join(goal, F.col("o_source").eqNullSafe(F.col("source"))) \
        .where((F.col("target") > 0) & (F.col("target") < cap * F.col("all_words"))).select("o_source", "target")
    c = cells.join(open_, F.col("source").eqNullSafe(F.col("o_source"))).select("source", "x", "words", "target") \
        .checkpoint()
    # Beyond these bounds every rate is 0 or at the cap.
    lam = open_.select(F.col("o_source").alias("source"), F.lit(0.0).alias("lam"), F.lit(-1e4).alias("lo"),
                       F.lit(1e4).alias("hi"))
    for _ in range(rounds):
        l2 = lam.select(F.col("source").alias("l_source"), "lam", "lo", "hi")
        r = _rate(F.col("lam"), F.col("x"), cap)
        taken = F.col("words") * r * UNIT
        state = c.join(l2, F.col("source").eqNullSafe(F.col("l_source"))) \
            .groupBy("source", "lam", "lo", "hi", "target") \
            .agg(F.sum(taken.cast("decimal(38,0)")).alias("g"),
                 F.sum(F.when(r < cap, taken * F.col("x")).otherwise(0.0).cast("decimal(38,0)")).alias("h"))
        state = state.withColumn("gap", F.col("g").cast("double") / UNIT - F.col("target")) \
            .withColumn("h", F.col("h").cast("double") / UNIT)
        state = state.withColumn("lo", F.when(F.col("gap") < 0, F.col("lam")).otherwise(F.col("lo"))) \
            .withColumn("hi", F.when(F.col("gap") > 0, F.col("lam")).otherwise(F.col("hi")))
        step = F.col("lam") - F.try_divide(F.col("gap"), F.col("h"))
        inside = F.coalesce((step > F.col("lo")) & (step < F.col("hi")), F.lit(False))
        done = F.abs(F.col("gap")) <= tol * F.greatest(F.col("target"), F.lit(1.0))
        nxt = F.when(done, F.col("lam")).when(inside, step).otherwise((F.col("lo") + F.col("hi")) / 2)
        lam = state.select("source", nxt.alias("lam"), "lo", "hi", done.alias("done")).checkpoint()
        if lam.where("not done").isEmpty():
            break
    return lam.select("source", "lam")


def rates(d: DataFrame, goal: DataFrame, cap: int = CAP) -> DataFrame:
    """``d`` (with source, size, x) plus ``rate`` under ``goal``."""
    cells = d.where("size > 0").groupBy("source", "size", "x").agg(F.count(F.lit(1)).alias("n")) \
        .select("source", "x", (F.col("n") * F.col("size")).alias("words")).checkpoint()
    lam = balance(cells, goal, cap)
    per = goal.join(lam.select(F.col("source").alias("l_source"), "lam"),
                    F.col("source").eqNullSafe(F.col("l_source")), "left") \
        .select(F.col("source").alias("p_source"), "lam", (F.col("target") > 0).alias("wanted"))
    rate = F.when(F.col("lam").isNotNull(), _rate(F.col("lam"), F.col("x"), cap)) \
        .when(F.col("wanted"), F.lit(float(cap))).otherwise(F.lit(0.0))
    return d.join(per, F.col("source").eqNullSafe(F.col("p_source")), "left") \
        .withColumn("rate", F.round(rate, 9)).drop("p_source", "lam", "wanted")


def _diffuse(t: pa.Table, cap: int) -> pa.Table:
    """Copies of one bucket's documents, longest first, carrying the error."""
    t = t.take(pc.sort_indices(t, [("size", "descending"), ("tie", "ascending"), ("doc_id", "ascending")]))
    copies = np.ones(t.num_rows, dtype=np.int64)  # a document without words: one copy
    carry = 0.0
    for i, (n, r) in enumerate(zip(t["size"].to_pylist(), t["rate"].to_pylist())):
        if n:
            copies[i] = min(cap, max(0, math.floor(r + carry / n + 0.5)))
            carry += n * (r - int(copies[i]))
    return t.select(["doc_id", "source", "size", "rate"]).append_column("copies", pa.array(copies))


def _rounded(d: DataFrame, bucket: Column, cap: int) -> DataFrame:
    cols = d.select("doc_id", "source", "size", "rate", F.xxhash64("doc_id", "size").alias("tie"), bucket.alias("bucket"))
    out = ", ".join(f"{c} {cols.schema[c].dataType.simpleString()}" for c in ("doc_id", "source", "size", "rate"))
    return cols.groupBy("source", "bucket").applyInArrow(lambda t: _diffuse(t, cap), f"{out}, copies bigint")


def mix(docs: DataFrame, weights=WEIGHTS, percent: int = TOTAL_PERCENT, cap: int = CAP,
        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies) per row."""
    d = cut(sizes(docs), "sizes")
    goal = targets(d.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), weights, percent, cap).checkpoint()
    g = goal.select(F.col("source").alias("g_source"), "n_docs", "source_size")
    d = d.join(g, F.col("source").eqNullSafe(F.col("g_source")), "left").drop("g_source") \
        .withColumn("x", _feature(F.col("size"), F.col("n_docs"), F.col("source_size")))
    heavy = F.col("size") * HEAVY > F.col("source_size")
    first = _rounded(rates(d, goal, cap).where(heavy), F.lit(0), cap).checkpoint()
    got = first.groupBy(F.col("source").alias("f_source")).agg(F.sum(F.col("size") * F.col("copies")).alias("got"))
    left = goal.join(got, F.col("source").eqNullSafe(F.col("f_source")), "left") \
        .select("source", (F.col("target") - F.coalesce("got", F.lit(0))).alias("target"))
    rest = rates(d.where(~heavy), left, cap)
    second = _rounded(rest, F.pmod(F.xxhash64("size", "doc_id"), F.ceil(F.col("n_docs") / bucket_rows)), cap)
    t = goal.select(F.col("source").alias("t_source"), "source_size", "target")
    return first.union(second).join(t, F.col("source").eqNullSafe(F.col("t_source")), "left").drop("t_source")
