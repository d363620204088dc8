"""Token-id output: documents in ascending id order, as checksummed,
independently decodable blocks of a context-mixing range coder.

Files are Parquet tables written by Spark (so any store that Spark reaches will
do); a row is one block: its part and place, the ids and token counts of its
documents, and the coded ids.  A document is never split over blocks.  Parts
are ranges of doc_id taken from quantiles of that column alone, so the texts
are tokenized where they are read and only their ids are shuffled.

Defined cases: a null or empty text is the end id alone; null ids sort first;
documents with equal doc_id lie next to each other in an order fixed by their
ids; an empty table writes no block; other columns are ignored.  A damaged
block raises an error when it is read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  -- used as pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import size_batches, text_of
from .idcoder import decode_block, encode_block
from .subword import piece_tokenizer

END_ID = 2
BLOCK_IDS = 1 << 20
PART_BYTES = 64 << 20


def id_parts(docs: DataFrame, part_bytes: int = PART_BYTES) -> list:
    """Upper bounds of doc_id ranges with about ``part_bytes`` of text each."""
    total = docs.agg(F.sum(F.length(F.col("q_text").cast("binary")))).first()[0] or 0
    n = int(min(4096, total // part_bytes + 1))
    if n < 2:
        return []
    q = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)).first()[0]
    return sorted(set(q or []))


def encode_documents(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(part, doc_id, ids): little-endian 16 or 32 bit ids with the end id."""
    bounds = id_parts(docs)
    part = F.lit(0)
    if bounds:
        edges = F.array(*[F.lit(b) for b in bounds])
        part = F.when(F.col("doc_id").isNull(), 0).otherwise(
            F.size(F.filter(edges, lambda e: e < F.col("doc_id"))))
    src = docs.select(part.cast("int").alias("part"), "doc_id", text_of("q_text").alias("q_text"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tk = piece_tokenizer(path)
        end = np.array([end_id], tk.kind).tobytes()
        for b in batches:
            size = pa.compute.binary_length(b.column(2)).to_pylist()
            for x, y in size_batches(size, 8 << 20):
                c = b.slice(x, y - x)
                ids = [raw + end for raw in tk.encode(c.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([c.column(0), c.column(1), pa.array(ids, pa.binary())],
                                                 names=["part", "doc_id", "ids"])

    return src.mapInArrow(run, f"part int, doc_id {id_type}, ids binary")


def _blocks(batches, path: str, block_ids: int, id_type):
    """Rows sorted by part and doc_id become blocks."""
    vocab = piece_tokenizer(path).vocab
    width = 2 if vocab <= 1 << 16 else 4
    part, seq, total, held, sizes, ids = None, 0, 0, [], [], []

    def close():
        nonlocal seq, held, sizes, ids
        row = [[part], [seq], [held], [sizes], [sum(sizes)],
               [encode_block(np.frombuffer(b"".join(ids), f"<u{width}").astype(np.int64), vocab)]]
        kinds = [pa.int32(), pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.int64(), pa.binary()]
        seq, held, sizes, ids = seq + 1, [], [], []
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)],
                                          names=["part", "seq", "doc_ids", "sizes", "n_ids", "payload"])

    for b in batches:
        for p, d, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            raw = raw.as_py()
            n = len(raw) // width
            if held and (p != part or total + n > block_ids):
                yield close()
            if p != part:
                part, seq = p, 0
            total = (total if held else 0) + n
            held.append(d)
            sizes.append(n)
            ids.append(raw)
    if held:
        yield close()


def write_token_files(docs: DataFrame, path: str, out: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Write the block files of all documents to ``out``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("q_text"))
    enc = encode_documents(src, path, end_id)
    kind = enc.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    arrow = to_arrow_type(kind)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    enc = enc.repartition(n, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "ids")
    blocks = enc.mapInArrow(lambda it: _blocks(it, path, block_ids, arrow),
                            f"part int, seq bigint, doc_ids array<{kind.simpleString()}>, sizes array<bigint>, "
                            "n_ids bigint, payload binary")
    blocks.write.option("compression", "none").option("parquet.block.size", 16 << 20).parquet(out)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Decode the block files: (doc_id, start, n_tokens, ids_crc32) and, if
    wanted, ids as little-endian unsigned 32-bit integers."""
    blocks = spark.read.parquet(path)
    # Where each block starts: sums over blocks, then over the few parts.
    per = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    per = per.select(F.col("part").alias("b_part"), F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select("part", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("block_start"))
    base = base.join(per, F.col("part") == F.col("b_part")).select(
        F.col("part").alias("b_part"), F.col("seq").alias("b_seq"),
        (F.col("part_start") + F.col("block_start")).cast("long").alias("base"))
    kind = blocks.schema["doc_ids"].dataType.elementType

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = decode_block(r["payload"])
                if len(ids) != sum(r["sizes"]):
                    raise ValueError(f"damaged token block {r['part']}/{r['seq']}: its documents' sizes differ")
                ends = np.cumsum(r["sizes"])
                raw = ids.astype("<u4")
                each = [raw[e - n:e].tobytes() for e, n in zip(ends.tolist(), r["sizes"])]
                for x, y in size_batches([len(v) for v in each], 8 << 20):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["part"]] * (y - x), pa.int32()), pa.array([r["seq"]] * (y - x), pa.int64()),
                         pa.array(r["doc_ids"][x:y], b.schema.field("doc_ids").type.value_type),
                         pa.array((ends - np.array(r["sizes"]))[x:y]), pa.array(r["sizes"][x:y], pa.int64()),
                         pa.array([zlib.crc32(v) for v in each[x:y]], pa.int64()), pa.array(each[x:y] if with_ids else [None] * (y - x), pa.binary())],
                        names=["part", "seq", "doc_id", "inner", "n_tokens", "ids_crc32", "ids"])

    docs = blocks.select("part", "seq", "doc_ids", "sizes", "payload").mapInArrow(
        run, f"part int, seq bigint, doc_id {kind.simpleString()}, inner bigint, n_tokens bigint, ids_crc32 bigint, "
             "ids binary")
    return docs.join(base, (F.col("part") == F.col("b_part")) & (F.col("seq") == F.col("b_seq"))) \
        .select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32",
                *(["ids"] if with_ids else []))
