"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomis.session import ensure_checkpoint_dir, scratch_path, ship_package

# Fixed value: the word of the contracts is a run of characters other than
# space, tab, line feed, vertical tab, form feed and carriage return.
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_BYTES = SPACE_CHARS.encode()

# bytes.translate table: A-Z become a-z, every other byte stays.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder, workers' package and UTC for one query."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read
    it back: a lineage cut that survives lost executors and costs one
    compressed, columnar copy."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(col: str = "text") -> Column:
    """The text column with null read as the empty string."""
    return F.coalesce(F.col(col), F.lit(""))


def size_batches(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Half-open row ranges whose sizes add up to at most ``limit`` each; a row
    above the limit gets a range of its own."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
