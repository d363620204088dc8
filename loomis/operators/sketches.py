"""Stored mergeable sketches (A14, A17): distinct counts and quantiles of any
number of runs or days without reading their rows again.

``write_sketches`` writes one partition for each part (a run, a day): HLL
sketches of distinct values and KLL sketches of distributions per group, a few
kilobytes each; writing a part again replaces it.  ``merged`` reads the sketches
of any parts and merges them per group, map-side first.  The estimates are those
of one sketch over all the rows, within the sketches' error: 1.04 / sqrt(2 **
lg) of the count for HLL, about 1.65 / k of the ranks for KLL.

Defined cases: nulls are not counted; a group that a part lacks adds nothing; a
group of nulls alone has no quantile and a distinct count of 0; an empty frame
writes no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LG_CONFIG = 12      # HLL: 1.6 % standard error, 4 KB at most
KLL_K = 400         # KLL: ranks to about 0.4 %


def write_sketches(df: DataFrame, path: str, part: str, keys: Sequence[str], distinct: Sequence[str] = (),
                   quantile: Sequence[str] = ()) -> str:
    """One row per part and group: n, hll_<column>, kll_<column>."""
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.hll_sketch_agg(c, F.lit(LG_CONFIG)).alias(f"hll_{c}") for c in distinct]
    aggs += [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_K)).alias(f"kll_{c}") for c in quantile]
    df.groupBy(part, *keys).agg(*aggs).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(part).parquet(path)
    return path


def merged(spark: SparkSession, path: str, keys: Sequence[str], ranks: Sequence[float] = (0.5,),
           parts: Sequence | None = None, part: str | None = None) -> DataFrame:
    """Per group over the stored parts (all, or those of ``part`` in ``parts``):
    n, distinct_<column> and q<percent>_<column>."""
    d = spark.read.parquet(path)
    if parts is not None:
        d = d.where(F.col(part).isin(list(parts)))
    hll = [c for c in d.columns if c.startswith("hll_")]
    kll = [c for c in d.columns if c.startswith("kll_")]
    g = d.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.hll_union_agg(c).alias(c) for c in hll],
                             *[F.kll_merge_agg_double(c).alias(c) for c in kll])
    out = [F.hll_sketch_estimate(c).alias(f"distinct_{c[4:]}") for c in hll]
    for c in kll:
        some = F.kll_sketch_get_n_double(c) > 0
        out += [F.when(some, F.kll_sketch_get_quantile_double(c, F.lit(float(r)))).alias(f"q{round(r * 100)}_{c[4:]}") for r in ranks]
    return g.select(*keys, "n", *out)
