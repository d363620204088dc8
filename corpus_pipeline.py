"""The corpus pipeline: quality rules, SimHash near-duplicates, benchmark
decontamination, mixing to target weights, token-id output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of ``documents``.  Every row is decided on its own, by a key made of
all its columns (null and repeated ids are no exception); rows with one key are
equal in every column, so it does not matter which of them stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomis.llm.base import prepare, table
from loomis.llm.decontaminate import decontaminate
from loomis.llm.mixing import mix
from loomis.llm.quality import quality_rules
from loomis.llm.queries import token_files
from loomis.llm.simhash import simhash_groups
from loomis.session import scratch_path


KEY = "k_row"


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key for each row: in the order of doc_id (null last),
    then two hashes of all columns.  Depends on the row only, not on the run."""
    cols = [F.col(c) for c in docs.columns] + [F.col(c).isNull() for c in docs.columns]
    return docs.withColumn(KEY, F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
        F.xxhash64(*cols).alias("h"), F.xxhash64(F.lit(1), *cols).alias("h2")))


def _by_key(keyed: DataFrame) -> DataFrame:
    """The rows with their key as doc_id."""
    return keyed.withColumn("doc_id", F.col(KEY)).drop(KEY)


def _with_keys(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is the doc_id of a row of ``keys``."""
    return keyed.join(keys.select(F.col("doc_id").alias("k_key")), F.col(KEY).eqNullSafe(F.col("k_key")), "left_semi")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    prepare(spark)
    keyed = _keyed(docs)
    return _with_keys(keyed, quality_rules(_by_key(keyed)).where("kept")).drop(KEY)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id (then hash) of each group of
    near-duplicates stays."""
    prepare(spark)
    keyed = _keyed(docs)
    first = simhash_groups(_by_key(keyed)).where("doc_id = component_id")
    return _with_keys(keyed, first).dropDuplicates([KEY]).drop(KEY)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark windows go."""
    prepare(spark)
    keyed = _keyed(docs)
    found = decontaminate(_by_key(keyed), table(spark, sf_dir, "benchmark"))
    return _with_keys(keyed, found.where(F.size("ranges") == 0)).drop(KEY)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target mixture takes it; equal rows
    together as often as it takes all of them."""
    prepare(spark)
    keyed = _keyed(docs).withColumn(KEY, F.to_json(KEY))
    copies = mix(_by_key(keyed)).where("copies > 0").groupBy(F.col("doc_id").alias("k_key")) \
        .agg(F.sum("copies").alias("k_copies"))
    return keyed.dropDuplicates([KEY]).join(copies, F.col(KEY) == F.col("k_key")) \
        .withColumn("k_copy", F.explode(F.sequence(F.lit(1), F.col("k_copies").cast("int")))).select(*docs.columns)


def token_output_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document in the token files."""
    prepare(spark)
    return token_files(spark, docs)


STAGES = [("quality rules", quality_stage), ("SimHash near-dedup", near_duplicate_stage),
          ("benchmark decontamination", decontamination_stage), ("mixing to target weights", mixing_stage),
          ("token-ID output", token_output_stage)]

# SimHash (XXH64), entropy balancing and the tokenizer are beyond SQL; the
# pipeline is tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, "pipeline", f"{i}-{uuid.uuid4().hex}")
            out.write.parquet(path)
            out = spark.read.schema(out.schema).parquet(path)
        docs = out
    return docs
