"""Connected components of an edge table by alternating large-star and
small-star steps (each a map-side combined minimum and a join).  Only edges
move; each round is checkpointed, so lost executors cost one round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _mins(e: DataFrame) -> DataFrame:
    return e.groupBy("u").agg(F.min("v").alias("m0")).select(F.col("u").alias("k"), F.least("u", "m0").alias("m"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): root is the smallest node reachable, for every node that
    has an edge to another one."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct().checkpoint()
    seen = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = _mins(both)
        large = both.where("v > u").join(m, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).checkpoint()
        m = _mins(down)
        linked = down.join(m, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = m.select(F.col("k").alias("u"), F.col("m").alias("v"))
        e = linked.union(own).where("u <> v").distinct().checkpoint()
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                .union(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        seen = now
