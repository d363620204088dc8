"""Interaction audit of five document filters by truth-table survival words.

A document's failures are a mask f of five bits.  The document survives a
subset S of the filters if f & S is 0, so all it can tell about the 32 subsets
is one 32-bit word whose bit S says whether it survives S.  A positional
popcount of the words gives the survivors of every subset at once: carry-save
adders compress the words of an Arrow batch, three of one weight to one of that
weight and one of the next, until one bit plane is left for each weight; the
planes of the batches are added by the same adders.  The counts are taken per
part and label (all, quality = 1, toxic = 1) and added up by Spark, 32 numbers
for each task, part and label.  Any order of the filters is a chain of subsets,
so all 120 orders are read off those numbers.

Texts are read in one narrow pass; after it only a key, a mask and the part
move.  A copy is found without gathering the copies: each distinct text gives
its smallest id (combined map-side), and a document whose text and id are not
those of such a first one fails E.  The join is on text hash and id, so no
group of copies is a key.

Defined cases: null text is empty (no word, no character, equal to other empty
texts); null source is the part ''; a null id is neither first nor a copy;
repeated rows of one id are not copies of each other; several labels of one id
count once, by their largest values; an empty table gives no rows; extra
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import cut, text_of

# Fixed values of the contract.
FILTERS = "ABCDE"
MIN_WORDS = 200
SYMBOLS = b"#$%&*|"
_UPPER = bytes(range(65, 91))
_NO_CHAR = bytes(range(0x80, 0xC0))     # UTF-8 bytes that do not begin a character

SUBSETS = 1 << len(FILTERS)
LABELS = ("all", "good", "toxic")
_COPY = 1 << FILTERS.index("E")
_MAX_PARTS = 4096                       # parts whose planes a task holds before it hands them on


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()                # bytes.split cuts at the six ASCII white spaces
    n = len(words)
    chars = len(text) - _count(text, _NO_CHAR)
    return ((n < MIN_WORDS) | (100 * len(set(words)) < 50 * n) << 1 | (100 * _count(text, _UPPER) > 2 * chars) << 2
            | (_count(text, SYMBOLS) > 0) << 3)


def _count(text: bytes, which: bytes) -> int:
    return len(text) - len(text.translate(None, which))


def survival_words() -> np.ndarray:
    """For each of the 32 failure masks the word of the subsets survived."""
    f, s = np.arange(SUBSETS)[:, None], np.arange(SUBSETS)[None, :]
    return (((f & s) == 0) << s).sum(axis=1).astype(np.uint32)


class Planes:
    """Bit planes of 32 counters: bit S of plane k is bit k of counter S."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def add(self, words: np.ndarray, weight: int = 0) -> None:
        """Add words of weight 2**weight by carry-save adders."""
        while len(words):
            while len(self.levels) <= weight:
                self.levels.append(np.zeros(0, np.uint32))
            have = np.concatenate([self.levels[weight], words])
            carries = []
            while len(have) > 1:
                # A half adder is a full adder with nothing third.
                n = -(-len(have) // 3)
                pad = np.zeros(3 * n, np.uint32)
                pad[:len(have)] = have
                a, b, c = pad[:n], pad[n:2 * n], pad[2 * n:]
                x = a ^ b
                carries.append((a & b) | (x & c))
                have = x ^ c
            self.levels[weight] = have
            words = np.concatenate(carries) if carries else np.zeros(0, np.uint32)
            words = words[words != 0]
            weight += 1

    def counts(self) -> np.ndarray:
        out = np.zeros(32, np.int64)
        for k, level in enumerate(self.levels):
            for w in level:
                out += ((int(w) >> np.arange(32)) & 1) << k
        return out


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, key): a narrow pass over the texts; ``key`` is the
    SHA-256 of the text, by which equal texts are known."""
    src = docs.select(F.col("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                      text_of("text").cast("binary").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = (x.as_py() for x in b.column(2))
            found = [(text_mask(t), hashlib.sha256(t).digest()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([m for m, _ in found], pa.int32()),
                 pa.array([k for _, k in found], pa.binary())], names=["doc_id", "part", "mask", "key"])

    return src.mapInArrow(run, f"doc_id {id_type}, part string, mask int, key binary")


def with_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with the bit of E added to the masks of copies."""
    first = rows.groupBy("key").agg(F.min("doc_id").alias("first")).where("first is not null") \
        .select(F.col("key").alias("f_key"), "first")
    j = rows.join(first, (F.col("key") == F.col("f_key")) & (F.col("doc_id") == F.col("first")), "left")
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return j.select("doc_id", "part", (F.col("mask") + F.when(copy, _COPY).otherwise(0)).alias("mask"))


def survivors(rows: DataFrame) -> DataFrame:
    """(part, label, counts): survivors of every subset, by part and label.
    ``rows`` has part, mask, good and toxic."""
    def run(batches):
        words, held = survival_words(), {}

        def out():
            keys = sorted(held)
            batch = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([held[k].counts().tolist() for k in keys], pa.list_(pa.int64()))],
                names=["part", "label", "counts"])
            held.clear()
            return batch

        for b in batches:
            part = b.column(0).dictionary_encode()
            names, code = part.dictionary.to_pylist(), part.indices.to_numpy(zero_copy_only=False)
            word = words[b.column(1).to_numpy(zero_copy_only=False)]
            labels = [np.ones(len(word), bool), *(b.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))]
            order = np.argsort(code, kind="stable")
            cuts = np.searchsorted(code[order], np.arange(len(names) + 1))
            for k, name in enumerate(names):
                at = order[cuts[k]:cuts[k + 1]]
                for label, has in zip(LABELS, labels, strict=True):
                    held.setdefault((name, label), Planes()).add(word[at[has[at]]])
                if len(held) >= _MAX_PARTS:
                    yield out()
        if held:
            yield out()

    each = rows.select("part", "mask", "good", "toxic").mapInArrow(run, "part string, label string, counts array<bigint>")
    return each.groupBy("part", "label").agg(F.array(*[
        F.sum(F.col("counts")[s]) for s in range(SUBSETS)]).alias("counts"))


def _mask_of(order: Column, first: Column) -> Column:
    """Subset made of the first so many filters of an order."""
    bit = lambda i: F.call_function("shiftleft", F.lit(1), F.ascii(F.substring(order, i, F.lit(1))) - ord(FILTERS[0]))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(FILTERS))), F.lit(0),
                       lambda a, i: a.bitwiseOR(F.when(i <= first, bit(i)).otherwise(0)))


def interaction_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: kept, removed,
    redundant, unique_fails, good_lost, toxic_lost and shapley."""
    marks = labels.groupBy(F.col("doc_id").alias("l_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("l_good"), F.max((F.col("toxic") == 1).cast("int")).alias("l_toxic"))
    rows = with_copies(cut(failures(docs), "interaction"))
    rows = rows.join(marks, F.col("doc_id") == F.col("l_id"), "left").select(
        "part", "mask", *[F.coalesce(F.col(f"l_{x}") == 1, F.lit(False)).alias(x) for x in ("good", "toxic")])
    # One row per part from here on.
    by = survivors(rows).groupBy("part").agg(*[F.max(F.when(F.col("label") == x, F.col("counts"))).alias(x) for x in LABELS])
    by = cut(by, "interaction")
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    d = by.withColumn("filter_order", F.explode(orders)) \
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    d = d.withColumn("before", _mask_of(F.col("filter_order"), F.col("step") - 1)) \
        .withColumn("after", _mask_of(F.col("filter_order"), F.col("step")))
    own = F.col("after") - F.col("before")
    lost = lambda x: F.col(x)[F.col("before")] - F.col(x)[F.col("after")]
    everything = F.lit(SUBSETS - 1)
    alls = F.col("all")
    d = d.select("part", "filter_order", "step", own.alias("own"), alls[F.col("after")].alias("kept"),
                 lost("all").alias("removed"), (alls[0] - alls[own] - lost("all")).alias("redundant"),
                 (alls[everything - own] - alls[everything]).alias("unique_fails"),
                 lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"))
    # 120 rows for each part and filter.
    return d.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own"))).drop("own")
