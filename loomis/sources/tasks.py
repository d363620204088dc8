"""Sources and sinks of SFT data.

* ``read_sectioned_tasks`` / ``parse_sections`` (S1): task files cut at the
  four dimension headings, each section one JSON object of tasks; by the data
  source in ``sectioned``, or whole through Spark for other paths.
* ``read_sft_records`` / ``parse_sft_lines`` (S2): three-field JSONL / CSV
  uploads with PERMISSIVE parsing and a corrupt-record column.
* ``write_training_set`` (S4): versioned dataset partitioned by version and
  category, dynamic partition overwrite.
* ``store_generations`` (S5): generation results, one replaceable partition per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomis.functions.text import strip_ws
from loomis.schemas import SECTION_COLONS, SECTION_HEADINGS
from loomis.sources import sectioned

HEADING_ALT = "(" + "|".join(h for _, h in SECTION_HEADINGS) + ")" + SECTION_COLONS
THREE_FIELD_DDL = "system string, prompt string, response string"


def json_quote(c: Column) -> Column:
    """A string as a JSON string literal (quotes and escapes by ``to_json``)."""
    return F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1)


# ---------------------------------------------------------------- S1
def parse_sections(files: DataFrame, text: str = "value", file: str = "file") -> DataFrame:
    """(file, category, section_status, task, body_text, body).

    A section runs from the end of its heading to the next heading of any
    kind (a repeated heading included); only the first occurrence of each
    heading is read.  ``section_status`` is ok / missing / empty / bad_json;
    the section object is read as ``map<string,string>`` so duplicate task
    keys keep the last value and nested bodies keep their raw JSON text."""
    pieces = files.select(file, F.posexplode(F.split(F.col(text), f"(?={HEADING_ALT})")).alias("pos", "piece"))
    head = F.regexp_extract("piece", f"^{HEADING_ALT}", 1)
    cat = F.lit(None).cast("string")
    for c, h in SECTION_HEADINGS:
        cat = F.when(head == h, F.lit(c)).otherwise(cat)
    found = pieces.withColumn("category", cat).filter(F.col("category").isNotNull()) \
        .groupBy(file, "category").agg(F.min_by("piece", "pos").alias("piece"))
    found = found.select(file, "category", F.regexp_replace("piece", f"^{HEADING_ALT}", "").alias("section"))
    expected = files.select(file, F.explode(F.array(*[F.lit(c) for c, _ in SECTION_HEADINGS])).alias("category"))
    return tasks_of_sections(expected.join(found, [file, "category"], "left"), file)


def tasks_of_sections(sections: DataFrame, file: str = "file") -> DataFrame:
    """(file, category, section_status, task, body_text, body) from the
    sections' texts (null: heading missing), in one pass over them."""
    section = strip_ws("section")
    # exactly one object: text behind it, or a second one, makes a section bad
    objs = F.from_json(F.concat(F.lit("["), section, F.lit("]")), "array<map<string,string>>")
    d = sections.select(file, "category", section.alias("section"), F.when(F.size(objs) == 1, F.get(objs, 0)).alias("tasks"))
    status = (F.when(F.col("section").isNull(), F.lit("missing")).when(F.col("section") == "", F.lit("empty"))
              .when(F.col("tasks").isNull(), F.lit("bad_json")).otherwise(F.lit("ok")))
    entries = d.select(file, "category", status.alias("section_status"), F.posexplode_outer("tasks").alias("_tpos", "task", "body_text"))
    entries = entries.where((F.col("section_status") != "ok") | F.col("_tpos").isNotNull())
    entries = entries.withColumns({c: F.when(F.col("section_status") == "ok", F.col(c)) for c in ("_tpos", "task", "body_text")})
    # a task key repeated inside one section object: the last one wins
    out = entries.groupBy(file, "category", "section_status", "task").agg(F.max_by("body_text", "_tpos").alias("body_text"))
    return out.withColumn("body", F.try_parse_json("body_text"))


def read_sectioned_tasks(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Read task files and parse their sections: by the ``sectioned`` data
    source where it opens the path, else whole files through Spark."""
    if isinstance(path, str) and sectioned.readable(path):
        return tasks_of_sections(sectioned.sections(spark, path))
    return read_whole_files(spark, path)


def read_whole_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Read task files whole (one row per file), from any path that Spark
    reads, and parse their sections."""
    paths = [path] if isinstance(path, str) else list(path)
    files = spark.read.option("recursiveFileLookup", "true").text(paths, wholetext=True) \
                 .select("value", F.col("_metadata.file_path").alias("file"))
    return parse_sections(files)


# ---------------------------------------------------------------- S2
def parse_sft_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Three-field JSON lines → (system, prompt, response, _corrupt); a line
    that is not a JSON object keeps its text in ``_corrupt``."""
    parsed = F.from_json(F.col(line), THREE_FIELD_DDL + ", _corrupt string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return df.select("*", parsed.alias("_p")).select("*", "_p.*").drop("_p")


def read_sft_records(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """JSONL or CSV uploads with the fixed three-field schema, PERMISSIVE
    mode and a ``_corrupt`` column (CSV fields may hold newlines, quotes and
    commas: multiLine + RFC-4180 quote escaping)."""
    r = spark.read.schema(THREE_FIELD_DDL + ", _corrupt string").option("mode", "PERMISSIVE") \
             .option("columnNameOfCorruptRecord", "_corrupt")
    if fmt == "json":
        return r.json(path)
    if fmt == "csv":
        return r.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    raise ValueError(f"unknown format {fmt}")


def sft_reject_reason() -> Column:
    """Upload check: unparseable line, then missing / blank prompt or response."""
    blank = lambda c: F.col(c).isNull() | (strip_ws(c) == "")
    return (F.when(F.col("_corrupt").isNotNull(), F.lit("corrupt"))
            .when(blank("prompt"), F.lit("missing_prompt"))
            .when(blank("response"), F.lit("missing_response")))


# ---------------------------------------------------------------- S4
def write_training_set(df: DataFrame, path: str, version: str, partition_by: Sequence[str] = ("version", "category"),
                       fmt: str = "parquet") -> str:
    """Write a dataset version; only the partitions present in ``df`` are
    replaced (dynamic partition overwrite), older versions stay."""
    (df.withColumn("version", F.lit(version)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).format(fmt).save(path))
    return path


# ---------------------------------------------------------------- S5
def store_generations(df: DataFrame, path: str, run: str) -> str:
    """Store the generation results of one run: its partition is replaced, so
    that a run stored again is not doubled; other runs stay."""
    df.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("run").parquet(path)
    return path
