"""Interval join for many intervals (J6): points against overlapping intervals
without a nested loop.

Time is cut into blocks of 2**level units, for every level.  An interval is
kept at the level of its own length, where it touches two blocks at most; a
point looks into its one block of each level that intervals have (64 at most,
a handful in practice).  The equi-join on (level, block) finds every candidate
pair once, and one comparison settles it.  Long intervals cost no more rows than
short ones, and no interval or point list is gathered anywhere; Spark splits a
hot block like any skewed join key.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _level(length: Column) -> Column:
    """Smallest level whose blocks are at least as long (0 for points)."""
    return F.length(F.bin(F.greatest(length - 1, F.lit(0)))) * (length > 1).cast("int")


def interval_join(points: DataFrame, at: Column, intervals: DataFrame, start: Column, end: Column,
                  how: str = "inner") -> DataFrame:
    """All pairs with start <= at <= end (whole numbers, e.g. epoch seconds or
    day numbers), columns of both sides; ``how`` is inner or left.

    Defined cases: a null point or bound meets nothing, an interval that ends
    before it starts holds nothing; equal intervals are pairs of their own.  The
    column names of the two sides must differ."""
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    iv = intervals.withColumns({"_start": start.cast("long"), "_end": end.cast("long")}).where("_start <= _end")
    iv = iv.withColumn("_level", _level(F.col("_end") - F.col("_start") + 1))
    block = lambda c: F.call_function("shiftright", c, F.col("_level"))
    iv = iv.withColumn("_block", F.explode(F.sequence(block(F.col("_start")), block(F.col("_end")))))
    # At most 64 rows, of one number each.
    levels = sorted(r[0] for r in iv.select("_level").distinct().collect())
    pt = points.withColumn("_at", at.cast("long"))
    keys = F.array(*[F.lit(x).cast("int") for x in levels]) if levels else F.array().cast("array<int>")
    if how == "left":
        # Written before use: the ids of the points must not change.
        pt = pt.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    pk = pt.withColumn("_level", F.explode(keys))
    pk = pk.withColumn("_block", F.call_function("shiftright", F.col("_at"), F.col("_level")))
    hit = pk.join(iv, ["_level", "_block"]).where((F.col("_start") <= F.col("_at")) & (F.col("_at") <= F.col("_end")))
    hit = hit.drop("_level", "_block", "_start", "_end")
    if how == "inner":
        return hit.drop("_at")
    lone = pt.join(hit.select(F.col("_id").alias("_hit")).distinct(), F.col("_id") == F.col("_hit"), "left_anti")
    return hit.unionByName(lone, allowMissingColumns=True).drop("_at", "_id")


_BLOCK = 1 << 12


def _running(steps: DataFrame) -> DataFrame:
    """Running sums of ``n`` and ``m`` per ``span`` in the order of ``at``, steps
    before the looks at the same unit; numbered by blocks of time, so that no
    window holds more than a block."""
    d = steps.withColumn("_b", F.floor(F.col("at") / _BLOCK))
    sums = d.groupBy("span", "_b").agg(F.sum("n").alias("bn"), F.sum("m").alias("bm"))
    before = Window.partitionBy("span").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = sums.select("span", "_b", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("bn", "bm")])
    inside = Window.partitionBy("span", "_b").orderBy("at", F.col("sign").isNotNull()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    return d.join(first, ["span", "_b"]).select("span", "sign", "s", "e", (F.sum("n").over(inside) + F.col("bn")).alias("n"),
                                                (F.sum("m").over(inside) + F.col("bm")).alias("m"))


def interval_counts(points: DataFrame, at: Column, of: Column, intervals: DataFrame, start: Column, end: Column,
                    keys: list[str]) -> DataFrame:
    """(keys, n, n_of): the pairs of ``interval_join`` counted by the intervals'
    ``keys`` (keys without a pair are left out), and the distinct values of ``of``
    in them (null is none), without making the pairs.

    Pairs are running counts at both ends of an interval.  Distinct values are
    the running count of distinct (value, unit), less every neighbouring pair of
    a value's units that lies whole in the interval: an interval of length L holds
    (p, t) if it starts in [t - L, p], so each length of intervals has one running
    count.  Rows grow with the points and the distinct intervals, and with the
    lengths at least as long as a neighbouring pair.  Keys of several different
    intervals, whose values may overlap, are joined and counted."""
    iv = intervals.select(*keys, start.cast("long").alias("s"), end.cast("long").alias("e")).where("s <= e")
    per_key = iv.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"), F.min("s").alias("s"), F.max("s").alias("_s"),
                                    F.min("e").alias("e"), F.max("e").alias("_e"))
    one = (F.col("s") == F.col("_s")) & (F.col("e") == F.col("_e"))
    single = per_key.where(one).select(*keys, "_c", "s", "e")
    spans = single.select("s", "e").distinct().withColumn("span", F.col("e") - F.col("s"))

    pt = points.select(at.cast("long").alias("at"), of.alias("v")).where("at is not null")
    units = pt.where("v is not null").distinct()
    none = [F.lit(None).cast(t).alias(c) for c, t in (("sign", "int"), ("s", "long"), ("e", "long"))]
    zero = F.lit(0).cast("long")
    # Span -1: the running counts of points (n) and of distinct values' units (m).
    moves = pt.groupBy("at").agg(F.count(F.lit(1)).alias("n")).withColumn("m", zero) \
        .unionByName(units.groupBy("at").agg(zero.alias("n"), F.count(F.lit(1)).alias("m"))) \
        .select(F.lit(-1).cast("long").alias("span"), "at", "n", "m", *none)
    ends = spans.select(F.lit(-1).cast("long").alias("span"), F.inline(F.array(
        F.struct(F.col("e").alias("at"), F.lit(1).alias("sign")), F.struct((F.col("s") - 1).alias("at"), F.lit(-1).alias("sign")))),
        "s", "e")
    # One number for each length of intervals.
    lengths = [r[0] for r in spans.select("span").distinct().orderBy("span").collect()]
    longest = (lengths or [0])[-1]
    # Neighbours are looked for as far back as the longest interval reaches: in
    # the unit's own block of time and, from its first unit there, in the one before.
    block = F.floor(F.col("at") / F.lit(max(longest, 1)))
    u = units.withColumn("_b", block)
    seeds = u.groupBy("v", "_b").agg(F.max("at").alias("at")).select("at", "v", (F.col("_b") + 1).alias("_b"), F.lit(True).alias("_seed"))
    u = u.withColumn("_seed", F.lit(False)).unionByName(seeds)
    pairs = u.withColumn("p", F.lag("at").over(Window.partitionBy("v", "_b").orderBy("at"))).where("not _seed and p is not null") \
        .where(F.col("at") - F.col("p") <= longest).groupBy("p", F.col("at").alias("t")).agg(F.count(F.lit(1)).alias("c"))
    fits = F.filter(F.array(*[F.lit(x) for x in lengths]).cast("array<bigint>"), lambda x: x >= F.col("t") - F.col("p"))
    held = pairs.select("p", "t", "c", F.explode(fits).alias("span")).select("span", F.inline(F.array(
        F.struct((F.col("t") - F.col("span")).alias("at"), (-F.col("c")).alias("m")),
        F.struct((F.col("p") + 1).alias("at"), F.col("c").alias("m"))))) \
        .groupBy("span", "at").agg(zero.alias("n"), F.sum("m").alias("m")).select("span", "at", "n", "m", *none)
    starts = spans.select("span", F.col("s").alias("at"), F.lit(1).alias("sign"), "s", "e")
    looks = ends.unionByName(starts).select("span", "at", zero.alias("n"), zero.alias("m"), "sign", "s", "e")
    seen = _running(moves.unionByName(held).unionByName(looks)).where("sign is not null").groupBy("s", "e").agg(
        F.sum(F.when(F.col("span") == -1, F.col("sign") * F.col("n")).otherwise(0)).alias("n"),
        F.sum(F.col("sign") * F.col("m")).alias("n_of"))
    counted = single.join(seen, ["s", "e"]).where("n > 0").select(*keys, (F.col("n") * F.col("_c")).alias("n"), "n_of")

    several = per_key.where(~one).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    rest = iv.join(several, reduce(and_, same), "left_semi")
    pairs_of = interval_join(pt, F.col("at"), rest, F.col("s"), F.col("e"))
    joined = pairs_of.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("v").alias("n_of"))
    return counted.unionByName(joined)
