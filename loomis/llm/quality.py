"""Quality rules with adaptive thresholds (native DataFrame functions only).

Every document gets integer measures.  Per language and source, each measure's
distribution is kept as a mergeable quantile sketch: counts over buckets whose
width grows with the value, so a value is known to 1/32 and two sketches are
merged by adding counts (that is how Spark combines the partial sketches of
its tasks, and how small sources fall back to the merged sketch of their
language).  Thresholds come from the sketches' quantiles and are joined back.

Defined cases: null text has no words (base rule fails it); null language or
source form groups of their own; repeated rows each get their own row; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomis.functions.plan import pin_columns

from .base import SPACE_CHARS, SPACE_RE, text_of

SYMBOLS = "#*$%&|<>"  # fixed value of the contract
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """One adaptive rule.  ``upper``: reject above median + spread * max(median
    - q10, floor); ``lower``: reject below median - spread * max(q90 - median,
    floor).  Floors are in the measure's own unit, so that a group of identical
    documents does not reject a slightly different one."""
    measure: str
    side: str
    floor: int
    spread: int = 5


# Production parameters.  Shares are per thousand, word length is in tenths.
RULES = (
    Rule("symbol_share", "upper", 40),      # symbols per 1000 words
    Rule("bang_share", "upper", 40),        # exclamation/question marks per 1000 words
    Rule("dup_line_share", "upper", 120),   # repeated lines per 1000 lines
    Rule("repeat_share", "upper", 60),      # words in repeated windows per 1000
    Rule("word_length", "upper", 12),
    Rule("word_length", "lower", 6),
)
MIN_ROWS = 50  # a source with fewer documents uses its language's merged sketch


def base_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Per row: id, keys, n_words, word_chars, n_symbols, n_bangs, n_lines,
    n_dup_lines, n_repeat_words.  One narrow pass, no shuffle."""
    t = text_of("q_text")
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("q_text"),
                    *[F.col(k).alias(f"q_{k}") for k in keys])
    d = d.select(
        "doc_id", *[f"q_{k}" for k in keys],
        F.array_remove(F.split(t, SPACE_RE), "").alias("w"),
        F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0).alias("lines"),
        F.length(F.translate(t, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(t) - F.length(F.translate(t, "!?", ""))).cast("long").alias("n_bangs"))
    d = pin_columns(d)
    starts = F.when(F.size("w") > WINDOW, F.sequence(F.lit(1), F.size("w") - (WINDOW - 1)))
    d = d.select(
        "doc_id", *[f"q_{k}" for k in keys], "word_chars", "n_symbols", "n_bangs",
        F.size("w").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(starts, lambda i: F.xxhash64(F.slice("w", i, WINDOW))).alias("wh"))
    d = pin_columns(d)
    # Windows found twice: sort (hash, position) and compare neighbours; only
    # texts that repeat something get that far.
    repeated = F.size("wh") > F.size(F.array_distinct("wh"))
    d = d.withColumn("s", F.when(repeated, F.array_sort(F.transform(
        "wh", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    d = pin_columns(d.drop("wh"))
    d = d.withColumn("p", F.array_sort(F.transform(
        F.filter("s", lambda x, j: ((j > 0) & (F.get("s", j - 1)["h"] == x["h"]))
                 | F.coalesce(F.get("s", j + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))
    d = pin_columns(d.drop("s"))
    covered = F.aggregate(
        F.transform("p", lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get("p", j + 1) - i, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("p")


def with_shares(d: DataFrame) -> DataFrame:
    """Integer measures the rules look at (0 for a text without words)."""
    def per(num: str, den: str, unit: int) -> Column:
        return F.when(F.col(den) > 0, F.expr(f"({num} * {unit}) div {den}")).otherwise(F.lit(0)).cast("long")
    return d.withColumns({
        "symbol_share": per("n_symbols", "n_words", 1000), "bang_share": per("n_bangs", "n_words", 1000),
        "dup_line_share": per("n_dup_lines", "n_lines", 1000), "repeat_share": per("n_repeat_words", "n_words", 1000),
        "word_length": per("word_chars", "n_words", 10)})


def bucket_of(v: str) -> Column:
    """Lower bound of the sketch bucket of a non-negative integer: exact below
    64, then 32 buckets for each doubling."""
    e = f"greatest(length(bin({v})) - 6, 0)"
    return F.expr(f"shiftleft(shiftright({v}, {e}), {e})")


def sketch(d: DataFrame, keys: tuple[str, ...], measures: tuple[str, ...]) -> DataFrame:
    """Mergeable quantile sketches: one row (keys, measure, bucket, n).  Spark
    adds them up map-side, so a hot source shuffles its few buckets only."""
    long = d.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), bucket_of(m).alias("bucket")) for m in measures])).alias("e"))
    return long.groupBy(*keys, F.col("e.measure").alias("measure"), F.col("e.bucket").alias("bucket")) \
        .agg(F.count(F.lit(1)).alias("n"))


def merge(sk: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Merge sketches to coarser keys by adding counts."""
    return sk.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sk: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, measure, q_rows, q10, q50, q90) read off the sketches."""
    by = Window.partitionBy(*keys, "measure")
    run = sk.select("*", F.sum("n").over(by).alias("total"),
                    F.sum("n").over(by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))

    def q(tenths: int) -> Column:  # first bucket with at least that share of the rows at or below it
        return F.min(F.when(F.col("upto") * 10 >= F.col("total") * tenths, F.col("bucket")))
    return run.groupBy(*keys, "measure").agg(F.max("total").alias("q_rows"), q(1).alias("q10"),
                                             q(5).alias("q50"), q(9).alias("q90"))


def thresholds(d: DataFrame, rules=RULES, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per (lang, source): an ``lo_``/``hi_`` threshold for each rule."""
    measures = tuple(dict.fromkeys(r.measure for r in rules))
    fine = sketch(d, ("q_lang", "q_source"), measures)
    coarse = quantiles(merge(fine, ("q_lang",)), ("q_lang",))
    coarse = coarse.select(F.col("q_lang").alias("c_lang"), F.col("measure").alias("c_measure"),
                           *[F.col(q).alias(f"c_{q}") for q in ("q10", "q50", "q90")])
    own = quantiles(fine, ("q_lang", "q_source"))
    both = own.join(coarse, F.col("q_lang").eqNullSafe(F.col("c_lang")) & (F.col("measure") == F.col("c_measure")))
    enough = F.col("q_rows") >= min_rows
    for q in ("q10", "q50", "q90"):
        both = both.withColumn(q, F.when(enough, F.col(q)).otherwise(F.col(f"c_{q}")))
    aggs = []
    for r in rules:
        if r.side == "upper":
            v = F.col("q50") + r.spread * F.greatest(F.col("q50") - F.col("q10"), F.lit(r.floor))
            name = f"hi_{r.measure}"
        else:
            v = F.col("q50") - r.spread * F.greatest(F.col("q90") - F.col("q50"), F.lit(r.floor))
            name = f"lo_{r.measure}"
        aggs.append(F.max(F.when(F.col("measure") == r.measure, v)).alias(name))
    return both.groupBy("q_lang", "q_source").agg(*aggs)


def quality_rules(docs: DataFrame, rules=RULES, min_rows: int = MIN_ROWS) -> DataFrame:
    """Verdict for each document: base measures, base_failed, the adaptive
    measures and kept.  The measures are computed once and cut (a few integers
    a row); sketches and the joined filter read that table.  The thresholds
    table has one row per (language, source); Spark sizes the join."""
    from .base import cut

    d = cut(with_shares(base_measures(docs)), "quality")
    th = thresholds(d, rules, min_rows).select(F.col("q_lang").alias("t_lang"), F.col("q_source").alias("t_source"),
                                               *[c for c in dict.fromkeys(
                                                   f"{'hi' if r.side == 'upper' else 'lo'}_{r.measure}"
                                                   for r in rules)])
    j = d.join(th, d.q_lang.eqNullSafe(th.t_lang) & d.q_source.eqNullSafe(th.t_source), "left")
    ok = F.lit(True)
    for r in rules:
        ok = ok & ((F.col(r.measure) <= F.col(f"hi_{r.measure}")) if r.side == "upper"
                   else (F.col(r.measure) >= F.col(f"lo_{r.measure}")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & ok).alias("kept"),
                    *dict.fromkeys(r.measure for r in rules))
