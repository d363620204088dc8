"""Skew-safe ordered numbering within a key.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` sends every row of a key
to one task.  When one key (a user, a run) may hold a third of all rows that
task becomes the whole job.  ``sequence_within`` splits each key into buckets
of a coarse, order-preserving prefix of the sort key (e.g. the day of the
timestamp), numbers rows inside ``(key, bucket)`` and adds the running count of
the key's earlier buckets.  The bucket counts are a partially aggregated
``groupBy`` (one row per key and bucket), so a hot key is spread over as many
tasks as it has buckets and the result equals the plain window exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


ROWS_PER_TASK = 1 << 19


def tasks_for(df: DataFrame, n_rows: int) -> int:
    """Partitions that keep a task to ``ROWS_PER_TASK`` of ``n_rows`` rows, the
    session's number at least: a task's sorts then take the same memory however
    large the input is."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // ROWS_PER_TASK))


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to the session's partitions by its columns: a file's row
    group is read by one task, and all of the work on its texts would stay there."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *df.columns)


def sequence_within(df: DataFrame, key: str | list[str], order: list[Column | str],
                    bucket: Column | None = None, name: str = "seq", tasks: int | None = None) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if bucket is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols)).cast("long"))

    with_bucket = df.withColumn("_bkt", bucket)
    if tasks is not None:
        with_bucket = with_bucket.repartition(tasks, *keys, "_bkt")
    counts = with_bucket.groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    if tasks is not None:
        counts = counts.repartition(tasks, *keys)
    offsets = counts.select(*keys, "_bkt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    if tasks is not None:
        offsets = offsets.repartition(tasks, *keys, "_bkt")
    inner = Window.partitionBy(*keys, "_bkt").orderBy(*order_cols)
    return (with_bucket.join(offsets, [*keys, "_bkt"])
            .withColumn(name, (F.row_number().over(inner) + F.col("_off")).cast("long"))
            .drop("_bkt", "_off"))


def dense_index(df: DataFrame, order: list[Column | str], name: str = "id", start: int = 0,
                checkpoint: bool = True) -> DataFrame:
    """Contiguous 0-based index in a total ``order`` without a single-partition
    window: range-partition and sort, tag rows with
    ``monotonically_increasing_id`` (partition id in the upper bits, position
    in the lower 33), count rows per partition (one row per partition, a
    proven-small table that is broadcast) and add the running offset.

    The tagged frame is checkpointed (reliably, into ``spark.checkpoint.dir``)
    so both uses see the same ids even if a task is retried elsewhere."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    tagged = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols) \
               .withColumn("_mid", F.monotonically_increasing_id())
    if checkpoint:
        tagged = tagged.checkpoint(eager=True)
    pid = F.shiftrightunsigned(F.col("_mid"), 33)
    counts = tagged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (tagged.join(F.broadcast(offsets), pid == F.col("_pid"))
            .withColumn(name, (F.lit(start) + F.col("_off") + local).cast("long"))
            .drop("_mid", "_pid", "_off"))


def cumulative_within(df: DataFrame, key: str | list[str], order: list[Column | str], value: Column,
                      bucket: Column, name: str) -> DataFrame:
    """Running ``sum(value)`` per key in ``order`` (rows up to and including
    the current one), split by an order-preserving ``bucket`` exactly like
    ``sequence_within`` so a hot key is not one task."""
    keys = [key] if isinstance(key, str) else list(key)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    d = df.withColumn("_bkt", bucket).withColumn("_v", value)
    sums = d.groupBy(*keys, "_bkt").agg(F.sum("_v").alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_bkt", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(*keys, "_bkt").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    return (d.join(offsets, [*keys, "_bkt"])
            .withColumn(name, F.sum("_v").over(inner) + F.col("_off"))
            .drop("_bkt", "_off", "_v"))
