"""Merkle fixity audit of WARC replicas (native DataFrame functions).

Pages become WARC records; a record's place is its file and its byte offset in
that file.  Every record is hashed; the hashes of an offset range make a leaf,
64 ranges a node, up to a file's root, and 256 files a node, up to the root of
the archive.  An audit builds the tree of each replica, compares from the root
down and goes on below mismatching nodes only; the records of the mismatching
ranges are compared last and give the corrupt places.

All groups are bounded: a leaf by its offset range, a node by its fan-out.  A
file may hold 64**2 ranges (4 GB at the production range), the archive 256**3
files.

Defined cases: null url or html are empty strings; records with equal place are
hashed together, in the order of their hashes; an empty replica has no root,
and its records are missing (or, the other way round, extra).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import cut, text_of

FILE_RECORDS = 256
RANGE_BYTES = 1 << 20
FAN_RANGES, RANGE_LEVELS = 64, 2
FAN_FILES, FILE_LEVELS = 256, 3


def warc_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 file_records: int = FILE_RECORDS) -> DataFrame:
    """(warc, offset, page_id, record): response records in files of
    ``file_records`` consecutive ids; offsets count bytes."""
    html = text_of("q_html")
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), text_of("q_url"),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("q_url"), F.col(html_col).alias("q_html")) \
        .select("page_id", record.alias("record"))
    p = p.withColumn("warc", F.coalesce(F.floor(F.col("page_id") / file_records), F.lit(-1)).cast("long"))
    before = Window.partitionBy("warc").orderBy("page_id", F.sha2("record", 256)) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return p.withColumn("offset", F.coalesce(F.sum(F.octet_length("record")).over(before), F.lit(0)).cast("long")) \
        .select("warc", "offset", "page_id", "record")


def record_hashes(records: DataFrame) -> DataFrame:
    """(warc, offset, n_bytes, hash) of a replica's records."""
    return records.select("warc", "offset", F.octet_length("record").cast("long").alias("n_bytes"),
                          F.sha2("record", 256).alias("hash"))


def _digest(place: Column, value: Column) -> Column:
    """SHA-256 of "place:hash" parts in the order of place."""
    parts = F.array_sort(F.collect_list(F.struct(place.cast("long").alias("p"), value.alias("h"))))
    return F.sha2(F.array_join(F.transform(parts, lambda x: F.concat_ws(":", x["p"].cast("string"), x["h"])), ","), 256)


def merkle_levels(hashes: DataFrame, range_bytes: int = RANGE_BYTES) -> list[DataFrame]:
    """Tree levels from the leaves to the root: (warc, node, hash).  On file
    levels ``warc`` is the node's number and ``node`` is 0."""
    node = F.floor(F.col("offset") / range_bytes)
    level = cut(hashes.groupBy("warc", node.alias("node")).agg(_digest(F.col("offset"), F.col("hash")).alias("hash")),
                "merkle")
    levels = [level]
    for _ in range(RANGE_LEVELS):
        up = F.floor(F.col("node") / FAN_RANGES)
        level = level.groupBy("warc", up.alias("up")).agg(_digest(F.col("node"), F.col("hash")).alias("hash")) \
            .select("warc", F.col("up").alias("node"), "hash")
        levels.append(level)
    for _ in range(FILE_LEVELS):
        up = F.floor(F.col("warc") / FAN_FILES)
        level = level.groupBy(up.alias("up")).agg(_digest(F.col("warc"), F.col("hash")).alias("hash")) \
            .select(F.col("up").alias("warc"), F.lit(0).cast("long").alias("node"), "hash")
        levels.append(level)
    return levels


def _mismatches(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes whose hashes differ or that one side lacks."""
    x = a.select("warc", "node", F.col("hash").alias("ha"))
    y = b.select("warc", "node", F.col("hash").alias("hb"))
    return x.join(y, ["warc", "node"], "full").where(~F.col("ha").eqNullSafe(F.col("hb"))).select("warc", "node")


def _below(level: DataFrame, bad: DataFrame, fan: int, files: bool) -> DataFrame:
    """Nodes of ``level`` whose parent is among ``bad``."""
    b = bad.select(F.col("warc").alias("bw"), F.col("node").alias("bn"))
    parent = [F.floor(F.col("warc") / fan) == F.col("bw"), F.col("bn") == 0] if files else \
        [F.col("warc") == F.col("bw"), F.floor(F.col("node") / fan) == F.col("bn")]
    return level.join(b, parent[0] & parent[1], "left_semi")


def audit(primary: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Compare two replicas' record hashes.  Returns the corrupt records (warc,
    offset, status: changed, missing or extra) and the files' roots (warc,
    root_primary, root_replica)."""
    la, lb = merkle_levels(primary, range_bytes), merkle_levels(replica, range_bytes)
    # Few nodes differ; each level's are cut, as the next one reads them twice.
    bad = _mismatches(la[-1], lb[-1]).checkpoint()
    for i in range(len(la) - 2, -1, -1):
        files = i >= RANGE_LEVELS
        fan = FAN_FILES if files else FAN_RANGES
        bad = _mismatches(_below(la[i], bad, fan, files), _below(lb[i], bad, fan, files)).checkpoint()
    bad = bad.select(F.col("warc").alias("bw"), F.col("node").alias("bn"))
    inside = (F.col("warc") == F.col("bw")) & (F.floor(F.col("offset") / range_bytes) == F.col("bn"))
    x = primary.join(bad, inside, "left_semi").groupBy("warc", "offset") \
        .agg(F.array_sort(F.collect_list("hash")).alias("ha"))
    y = replica.join(bad, inside, "left_semi").groupBy("warc", "offset") \
        .agg(F.array_sort(F.collect_list("hash")).alias("hb"))
    found = x.join(y, ["warc", "offset"], "full").where(~F.col("ha").eqNullSafe(F.col("hb"))).select(
        "warc", "offset", F.when(F.col("hb").isNull(), "missing").when(F.col("ha").isNull(), "extra")
        .otherwise("changed").alias("status"))
    top = RANGE_LEVELS
    roots = la[top].select("warc", F.col("hash").alias("root_primary")).join(
        lb[top].select("warc", F.col("hash").alias("root_replica")), "warc", "full")
    return found, roots


def aged_replica(records: DataFrame) -> DataFrame:
    """A second copy with the faults of a long-kept one, chosen by page_id:
    records with a changed character, cut records, lost ones and stray ones."""
    h = F.crc32(F.col("page_id").cast("string"))
    r = F.col("record")
    aged = F.when(h % 97 == 1, F.concat(F.lit("w"), F.substring(r, 2, 1 << 30))) \
        .when(h % 89 == 2, F.substring(r, 1, 40)).otherwise(r)
    kept = records.where(F.coalesce(h % 101 != 3, F.lit(True))).select("warc", "offset", aged.alias("record"))
    stray = records.where(h % 103 == 4).select("warc", (F.col("offset") + 7).alias("offset"), r.alias("record"))
    return kept.union(stray)


def audit_files(pages: DataFrame) -> DataFrame:
    """One row per WARC file of the pages and its aged replica: size, roots and
    the corrupt places, as "offset:status" in ascending order."""
    records = warc_records(pages)
    a = cut(record_hashes(records), "warc-a")
    b = cut(record_hashes(aged_replica(records)), "warc-b")
    found, roots = audit(a, b)
    places = found.groupBy("warc").agg(
        F.count(F.lit(1)).alias("n_corrupt"),
        *[F.count(F.when(F.col("status") == s, 1)).alias(f"n_{s}") for s in ("changed", "missing", "extra")],
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "status"))),
                                 lambda x: F.concat_ws(":", x["offset"].cast("string"), x["status"])), ",")
        .alias("places"))
    size = a.groupBy("warc").agg(F.count(F.lit(1)).alias("n_records"), F.sum("n_bytes").alias("n_bytes"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_corrupt", "n_changed", "n_missing", "n_extra")]
    return size.join(roots, "warc", "left").join(places, "warc", "left").select(
        "warc", "n_records", "n_bytes", "root_primary", "root_replica",
        F.col("root_primary").eqNullSafe(F.col("root_replica")).alias("intact"), *zero,
        F.coalesce("places", F.lit("")).alias("places"))
