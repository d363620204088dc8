"""Merkle manifest of a dataset and its audit by a recursive query.

Every row is a leaf.  Leaves of a language, in the order of their ids, are
hashed in runs of eight up to the language's subroot; the subroots, in the
order of the languages, likewise up to the root.  The levels are stored as
parent-linked node rows: a node holds its children's digests, the id of its
parent and its place there.  A recursive query (``WITH RECURSIVE``) starts from
all leaves, some of them tampered with, and goes from parent to parent: each step
puts the digest folded so far into its place among the node's children, hashes
them, and appends a row with the siblings it met.  The rows of a leaf, in the
order of the steps, are its proof.

No step has a hot key, although every climb ends at one root: nodes above a
block of 512 leaves are stored once for each block below them, and a step joins
on block and node, so at most 512 rows share a key on any level.  That adds a
row for each block and level.  Positions come from a range sort with offsets
by partition, not from a window over a language.

Defined cases: a null column hashes as ``-``; null language comes first, null
ids first in their language, equal ids in the order of their leaf digests;
equal rows are leaves of their own; a null id is not tampered with; a lone
leaf is its subroot, a lone subroot the root (no steps, empty proof); an empty
table gives no rows; texts are hashed whole in the JVM, whatever their length;
other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomis.plans.sequence import dense_index

from .base import cut

FAN = 8
BLOCK_LEVEL = 3                    # a block holds FAN ** 3 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_CHUNK = 4096
_TOP = -1                          # number of the tree over the subroots


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def _digest(c: Column) -> Column:
    return F.unhex(F.sha2(c, 256))


def _text(c: Column) -> Column:
    """Digests as lowercase hex text."""
    return F.lower(F.hex(c))


def leaf_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, h, th): every row's digest, untampered and as found."""
    d = docs.select(*[F.col(f).alias(f"q_{f}") for f in FIELDS])
    cols = {f: F.col(f"q_{f}") for f in FIELDS}
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hit = F.coalesce(F.crc32(cols["doc_id"].cast("string").cast("binary")) % 3 == 0, F.lit(False))
    h = _digest(F.concat(*[_field(cols[f]) for f in FIELDS]))
    cols["text"] = F.translate(cols["text"], upper, lower)
    th = F.when(hit, _digest(F.concat(*[_field(cols[f]) for f in FIELDS]))).otherwise(h)
    return d.select(F.col("q_doc_id").alias("doc_id"), F.col("q_lang").alias("lang"), h.alias("h"), th.alias("th"))


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves: the octal digits of
    the last leaf's number.  Short, as plans hold it many times."""
    return F.when(n > 1, F.length(F.conv(n - 1, 10, FAN))).otherwise(0)


def _levels(leaves: DataFrame, most: int) -> DataFrame | None:
    """All node rows above the leaves: (g, n, level, i, kids, h); n is the
    number of the tree's leaves, ``most`` the largest n.  One pass gathers blocks
    of 512 digests and builds three levels of them."""
    def build(base):
        def run(batches):
            for b in batches:
                rows = []
                for g, n, up, digests in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    for s in range(1, BLOCK_LEVEL + 1):
                        # A tree whose level below is one node has ended there.
                        if n <= FAN ** (base + s - 1):
                            break
                        kids = [b"".join(digests[j:j + FAN]) for j in range(0, len(digests), FAN)]
                        digests = [hashlib.sha256(k.hex().encode()).digest() for k in kids]
                        first = up * FAN ** (BLOCK_LEVEL - s)
                        rows += [(g, n, base + s, first + j, k, h) for j, (k, h) in enumerate(zip(kids, digests, strict=True))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                     names=["g", "n", "level", "i", "kids", "h"])
        return run

    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    out, level, base = None, leaves.select("g", "n", "i", "h"), 0
    while FAN ** base < most:
        block = level.where(F.col("n") > FAN ** base).groupBy("g", "n", F.floor(F.col("i") / FAN ** BLOCK_LEVEL).alias("up")) \
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "h"))), lambda x: x["h"]).alias("digests"))
        built = cut(block.mapInArrow(build(base), "g bigint, n bigint, level int, i bigint, kids binary, h binary"),
                    "manifest-levels")
        out = built if out is None else out.union(built)
        base += BLOCK_LEVEL
        level = built.where(F.col("level") == base)
    return out


def _linked(i: Column, level: Column, g: Column, n: Column, trees: Column) -> list[Column]:
    """Parent (pg, pl, pi) of a node and its place there: in its own tree, for
    a subroot in the tree over the subroots, for the root none."""
    inside, above = level < _height(n), (g != _TOP) & (trees > 1)
    place = F.when(inside, i).when(above, g)
    return [F.when(inside, g).when(above, F.lit(_TOP)).cast("long").alias("pg"),
            F.when(inside, level + 1).when(above, F.lit(1)).cast("int").alias("pl"),
            F.floor(place / FAN).alias("pi"), (place % FAN).cast("int").alias("pos")]


def _blocks(nodes: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Each node once for every block from ``lo`` to ``hi``; in two steps, so
    that the root's blocks are written by many tasks."""
    d = nodes.withColumn("lo", lo).withColumn("hi", hi)
    d = d.withColumn("c", F.explode(F.sequence(F.floor(F.col("lo") / _CHUNK), F.floor(F.col("hi") / _CHUNK))))
    d = d.repartition("bg", "nl", "ni", "c")
    return d.withColumn("block", F.explode(F.sequence(
        F.greatest(F.col("lo"), F.col("c") * _CHUNK), F.least(F.col("hi"), F.col("c") * _CHUNK + (_CHUNK - 1))))) \
        .drop("lo", "hi", "c")


def build(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, str | None]:
    """Leaves with their first link, node rows, subroots by tree, and the root
    (None for an empty table)."""
    raw = cut(leaf_rows(docs), "manifest-leaves")
    ranked = dense_index(raw, ["lang", "doc_id", "h"], name="at")
    langs = ranked.groupBy("lang").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    langs = cut(dense_index(langs, ["lang"], name="g"), "manifest-langs")
    of = langs.agg(F.count(F.lit(1)).alias("trees"), F.max("n").alias("most")).first()
    trees, most = of["trees"], of["most"] or 0
    keyed = langs.select(F.col("lang").alias("k_lang"), "first", "n", "g")
    leaves = ranked.join(keyed, F.col("lang").eqNullSafe(F.col("k_lang"))) \
        .select("doc_id", "g", "n", (F.col("at") - F.col("first")).alias("i"), "h", "th")
    leaves = leaves.select("*", *_linked(F.col("i"), F.lit(0), F.col("g"), F.col("n"), F.lit(trees)))
    leaves = cut(leaves, "manifest-ranked")
    inner = _levels(leaves, most)
    # Subroots: the one node of each tree's highest level.
    subroots = leaves.where("n = 1").select("g", "h")
    if inner is not None:
        subroots = subroots.union(inner.where(F.col("level") == _height(F.col("n"))).select("g", "h"))
    subroots = cut(subroots, "manifest-subroots")
    crown = _levels(subroots.select(F.lit(_TOP).cast("long").alias("g"), F.lit(trees).cast("long").alias("n"),
                                    F.col("g").alias("i"), "h"), trees)
    last = subroots if crown is None else crown.where(F.col("level") == _height(F.lit(trees)))
    top = last.select(_text(F.col("h")).alias("h")).first()
    nodes = _nodes(inner, crown, langs, trees)
    return leaves, cut(nodes, "manifest-nodes"), subroots, top["h"] if top else None


def _nodes(inner: DataFrame | None, crown: DataFrame | None, langs: DataFrame, trees: int) -> DataFrame:
    """Parent-linked node rows: (bg, block) the block of leaves they serve, (ng,
    nl, ni) the node, its children, its parent and its place there."""
    def linked(d):
        return _linked(F.col("i"), F.col("level"), F.col("g"), F.col("n"), F.lit(trees))
    cols = ["bg", "block", "ng", "nl", "ni", "kids", "pg", "pl", "pi", "pos"]
    own = [F.col("g").alias("ng"), F.col("level").alias("nl"), F.col("i").alias("ni"), "kids"]
    low, high = None, None
    if inner is not None:
        d = inner.select(F.col("g").alias("bg"), *own, *linked(inner), F.col("n").alias("bn"))
        wide = lambda k: F.pow(F.lit(float(FAN)), F.abs(F.col("nl") - BLOCK_LEVEL)).cast("long") * k
        low = d.where(F.col("nl") <= BLOCK_LEVEL).withColumn("block", F.floor(F.col("ni") / wide(1))).select(*cols)
        high = d.where(F.col("nl") > BLOCK_LEVEL).withColumn("lo", F.col("ni") * wide(1)) \
            .withColumn("hi", (F.col("ni") + 1) * wide(1) - 1)
    if crown is not None:
        # The tree over the subroots lies above every block of its languages.
        under = langs.select(F.col("g").alias("bg"), F.col("n").alias("bn"))
        up = crown.withColumn("wide", F.pow(F.lit(float(FAN)), F.col("level")).cast("long")) \
            .withColumn("child", F.explode(F.sequence(F.col("i") * F.col("wide"), F.least((F.col("i") + 1) * F.col("wide"), F.col("n")) - 1)))
        up = up.join(under, F.col("child") == F.col("bg")).select("bg", *own, *linked(crown), "bn") \
            .withColumn("lo", F.lit(0).cast("long")).withColumn("hi", F.lit(1 << 62))
        high = up if high is None else high.unionByName(up)
    if high is not None:
        ends = F.floor((F.col("bn") - 1) / FAN ** BLOCK_LEVEL)
        high = _blocks(high, F.col("lo"), F.least("hi", ends)).select(*cols)
    some = [x for x in (low, high) if x is not None]
    if not some:
        return langs.sparkSession.createDataFrame([], "bg long, block long, ng long, nl int, ni long, kids binary, pg long, "
                                                      "pl int, pi long, pos int")
    return some[0] if len(some) == 1 else some[0].unionByName(some[1])


# One step: the digest folded so far goes into its place among the node's
# children, the others are the siblings met.
_STEP = """{link}, unhex(sha2(lower(hex(concat(substring(n.kids, 1, 32 * c.pos), c.{fold}, substring(n.kids, 32 * c.pos + 33)))), 256)),
         concat(substring(n.kids, 1, 32 * c.pos), substring(n.kids, 32 * c.pos + 33))"""
_MEETS = "n.bg = c.g AND n.block = c.i div {block} AND n.ng = c.pg AND n.nl = c.pl AND n.ni = c.pi"
CLIMB = f"""
WITH RECURSIVE climb(doc_id, leaf, g, i, step, pg, pl, pi, pos, fold, found) AS (
  SELECT c.doc_id, c.h, c.g, c.i, 1, {_STEP.format(link="n.pg, n.pl, n.pi, n.pos", fold="th")}
  FROM {{leaves}} c JOIN {{nodes}} n ON {_MEETS}
  UNION ALL
  SELECT CAST(NULL AS {{id}}), CAST(NULL AS BINARY), c.g, c.i, c.step + 1, {_STEP.format(link="n.pg, n.pl, n.pi, n.pos", fold="fold")}
  FROM climb c JOIN (SELECT * FROM {{nodes}} WHERE nl > 1 OR ng = {_TOP}) n ON {_MEETS}
)
SELECT doc_id, leaf, g, i, step, CASE WHEN pl IS NULL THEN fold END AS fold, found FROM climb
UNION ALL
SELECT doc_id, h, g, i, 0, th, CAST(NULL AS BINARY) FROM {{leaves}} WHERE pl IS NULL"""


def climb(spark: SparkSession, leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """The recursive query: for every leaf a row for each parent (``found``:
    the siblings met there).  The first row has the id and the leaf's own
    digest, the last one ``fold``, the recomputed root; a leaf that is the root
    has a row for step 0 only.  The anchor takes the first step, from the leaves
    into their runs, so that the recursion, which reads the node rows anew for
    every step, reads no runs of leaves.  The recursion's row limit is lifted: it
    counts the rows of all leaves."""
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    mark = uuid.uuid4().hex
    leaves.createOrReplaceTempView(f"manifest_leaves_{mark}")
    nodes.createOrReplaceTempView(f"manifest_nodes_{mark}")
    out = spark.sql(CLIMB.format(leaves=f"manifest_leaves_{mark}", nodes=f"manifest_nodes_{mark}",
                                 block=FAN ** BLOCK_LEVEL, id=leaves.schema["doc_id"].dataType.simpleString()))
    for name in ("leaves", "nodes"):
        spark.catalog.dropTempView(f"manifest_{name}_{mark}")
    return out


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    leaves, nodes, subroots, root = build(docs)
    rows = climb(docs.sparkSession, leaves, nodes)
    parts = F.array_sort(F.collect_list(F.when(F.col("step") > 0, F.struct("step", "found"))))
    proof = F.sha2(F.array_join(F.transform(parts, lambda x: _text(x["found"])), ""), 256)
    own = rows.groupBy("g", "i").agg(F.max("doc_id").alias("doc_id"), F.max("leaf").alias("leaf"),
                                     proof.alias("proof_sha256"), F.max("fold").alias("folded_root"))
    # One row per language: Spark sizes the join.
    subs = subroots.select(F.col("g").alias("s_g"), F.col("h").alias("subroot"))
    return own.join(subs, F.col("g") == F.col("s_g")).select(
        "doc_id", _text(F.col("leaf")).alias("leaf"), _text(F.col("subroot")).alias("subroot"),
        F.lit(root).cast("string").alias("root"), "proof_sha256", _text(F.col("folded_root")).alias("folded_root"),
        (_text(F.col("folded_root")) == F.lit(root)).alias("verified"))
