"""Token arrays: vocabulary, encode/decode, label masking, truncation,
padded batches and the length reports built on them.

Counting runs as ``regexp_extract_all`` inside the JVM.  Ids come from a
vocabulary table: in one narrow pass by a shipped trie while the vocabulary is
below a byte limit (``encode_corpus``, ``decode_corpus``; see ``tokenizer``);
beyond it the most frequent tokens are shipped and the rare ones of each row
joined.  ``encode`` and ``decode`` join every token (AQE splits hot ones such as
"the").
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomis.functions.plan import pin_columns
from loomis.functions.text import TOKEN_PATTERN, token_count, tokens, word_count
from loomis.operators import tokenizer
from loomis.plans.sequence import dense_index
from loomis.schemas import ENDOFTEXT, IGNORE_INDEX, IM_END, SPECIAL_TOKENS
from loomis.session import scratch_path



def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- A6
def build_vocab(corpus: DataFrame, text: str = "text", specials: Sequence[str] = SPECIAL_TOKENS,
                checkpoint: bool = True) -> DataFrame:
    """(token, freq, id): special tokens first in their fixed order, then all
    other tokens by descending frequency, ties by token.  Counting is a
    partially aggregated ``groupBy``; ids come from ``dense_index`` (range sort,
    no single-partition window)."""
    spark = corpus.sparkSession
    counts = corpus.select(F.explode(tokens(text)).alias("token")).groupBy("token") \
                   .agg(F.count(F.lit(1)).alias("freq"))
    if checkpoint:
        # the range partitioning below samples its input in a separate job;
        # write the (small) counts once instead of tokenizing the corpus twice
        counts = counts.checkpoint(eager=True)
    sp = spark.createDataFrame([(t, i) for i, t in enumerate(specials)], "token string, id long")
    special_rows = F.broadcast(sp).join(counts, "token", "left") \
        .select("token", F.coalesce("freq", F.lit(0)).cast("long").alias("freq"), "id")
    rest = counts.join(F.broadcast(sp), "token", "left_anti")
    ranked = dense_index(rest, [F.desc("freq"), F.asc("token")], name="id", start=len(specials))
    vocab = special_rows.unionByName(ranked.select("token", "freq", "id"))
    # The vocabulary is a dimension read by every later join and id lookup:
    # write it once (reliable checkpoint in spark.checkpoint.dir) so lookups do
    # not re-tokenize the corpus and ids stay fixed if an executor is lost.
    return vocab.checkpoint(eager=True) if checkpoint else vocab


# ---------------------------------------------------------------- X1
def encode(df: DataFrame, key: str, text: str, vocab: DataFrame, out: str = "ids",
           keep: Sequence[str] = (), unknown_id: int = -1) -> DataFrame:
    """(key, ids, *keep): text → ``array<long>`` of vocabulary ids (unknown
    tokens → ``unknown_id``), for a vocabulary of any size.

    Shuffles (key, pos, id) rows: explode → vocabulary join (Spark sizes it;
    AQE splits hot tokens) → regroup by key.  The text itself is never
    shuffled; small ``keep`` columns ride along via ``first``."""
    v = vocab.select("token", "id")
    exploded = df.select(key, *keep, F.posexplode_outer(tokens(text)).alias("pos", "token"))
    j = exploded.join(v, "token", "left")
    grouped = j.groupBy(key).agg(F.array_sort(F.collect_list(
        F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("id", F.lit(unknown_id)).alias("id"))))).alias("_p"),
        *[F.first(c).alias(c) for c in keep])
    return grouped.select(key, F.transform("_p", lambda x: x["id"]).cast("array<bigint>").alias(out), *keep)


def encode_corpus(df: DataFrame, key: str, text: str, vocab: DataFrame, out: str = "ids",
                  unknown_id: int = -1, limit: int = tokenizer.LIMIT_BYTES) -> DataFrame:
    """``df`` with the ids of its text: narrow by the vocabulary's trie if that
    is within ``limit`` bytes.  Of a larger vocabulary the head is shipped (the
    smallest ids, the most frequent tokens): a first pass takes the ids it has,
    and only the distinct other tokens of a row are joined with the vocabulary.
    Keys may repeat or be null; if no head fits, the join form on ``key``
    (unique) does the work."""
    trie = tokenizer.tokenizer_for(vocab, limit, unknown_id)
    if trie is not None:
        return tokenizer.encode_with(df, text, trie, out)
    end = tokenizer.head_end(vocab, limit)
    mark = min(0, unknown_id, vocab.agg(F.min("id")).first()[0] or 0) - 1
    # A trie may take more slots than bytes: a smaller head then.
    part, share = None, limit
    while end is not None and part is None:
        part = tokenizer.tokenizer_for(vocab.where(F.col("id") < end), limit, mark)
        if part is None:
            share //= 2
            end = tokenizer.head_end(vocab, share)
    if part is None:
        return df.join(encode(df, key, text, vocab, out, unknown_id=unknown_id), key)
    found = _written(tokenizer.encode_head(df, text, part, mark, out, "_rest"))
    tail = vocab.where((F.col("id") >= end) & F.col("token").isNotNull()).groupBy("token").agg(F.min("id").alias("_id"))
    rest = found.select("_row", F.posexplode("_rest").alias("_j", "token")).join(tail, "token", "left")
    fill = rest.groupBy("_row").agg(F.array_sort(F.collect_list(
        F.struct("_j", F.coalesce("_id", F.lit(unknown_id)).alias("id")))).alias("_p")) \
        .select("_row", F.transform("_p", lambda x: x["id"]).cast("array<bigint>").alias("_fill"))
    ids = F.when(F.col("_fill").isNull(), F.col(out)).otherwise(F.transform(
        out, lambda x: F.when(x <= mark, F.get("_fill", (F.lit(mark) - x).cast("int"))).otherwise(x)))
    return found.join(fill, "_row", "left").withColumn(out, ids).drop("_row", "_rest", "_fill")


def _written(df: DataFrame) -> DataFrame:
    """``df`` with a number for each row, written once as Parquet, so that both
    sides of a join by that number see the same ones."""
    path = scratch_path(df.sparkSession, "tokens", uuid.uuid4().hex)
    df = df.withColumn("_row", F.monotonically_increasing_id())
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- X2
def decode(df: DataFrame, key: str, ids: str, vocab: DataFrame, out: str = "decoded",
           skip_special: bool = False, sep: str = "", keep: Sequence[str] = ()) -> DataFrame:
    """(key, decoded, *keep): ids → text, tokens joined by ``sep``; optionally
    drop special tokens; an id that the vocabulary lacks becomes
    ``UNKNOWN_TEXT``.  Same one-shuffle shape as ``encode``."""
    voc = vocab.where("token is not null").select(F.col("id").alias("_id"), F.col("token"),
                                                  (_is_special() & F.lit(skip_special)).alias("_gone"))
    exploded = df.select(key, *keep, F.posexplode_outer(ids).alias("pos", "_id"))
    j = exploded.join(voc, "_id", "left").withColumn("token", F.coalesce("token", F.lit(tokenizer.UNKNOWN_TEXT)))
    grouped = j.groupBy(key).agg(F.array_sort(F.collect_list(
        F.when(F.col("pos").isNotNull() & ~F.coalesce("_gone", F.lit(False)), F.struct("pos", "token")))).alias("_p"),
        *[F.first(c).alias(c) for c in keep])
    return grouped.select(key, F.array_join(F.transform("_p", lambda x: x["token"]), sep).alias(out), *keep)


def _is_special() -> Column:
    return F.col("token").isin(list(SPECIAL_TOKENS)) | F.col("token").rlike(r"^<\|[a-z_]+\|>$")


def decode_corpus(df: DataFrame, key: str, ids: str, vocab: DataFrame, out: str = "decoded",
                  skip_special: bool = False, sep: str = "", limit: int = tokenizer.LIMIT_BYTES) -> DataFrame:
    """``df`` with the text of its ids: narrow while the vocabulary is within
    ``limit`` bytes.  Of a larger one the head is shipped, and only the distinct
    other ids of a row are joined with the vocabulary.  Keys may repeat or be
    null; if no head fits, the join form on ``key`` (unique) does the work."""
    skip = _is_special() if skip_special else None
    narrow = tokenizer.decode_with(df, ids, vocab, out, skip, sep, limit)
    if narrow is not None:
        return narrow
    end = tokenizer.head_end(vocab, limit)
    if end is None:
        return df.join(decode(df, key, ids, vocab, out, skip_special, sep), key)
    have = _written(df)
    gone = F.coalesce(skip, F.lit(False)) if skip is not None else F.lit(False)
    tail = vocab.where((F.col("id") >= end) & F.col("token").isNotNull()).select(
        F.col("id").alias("_id"), F.when(~gone, F.col("token")).alias("token"))
    rest = have.select("_row", F.explode(F.array_distinct(F.filter(ids, lambda x: x >= end))).alias("_id")).join(tail, "_id")
    other = rest.groupBy("_row").agg(F.collect_list(F.struct(F.col("_id").alias("id"), "token")).alias("_more"))
    both = have.join(other, "_row", "left")
    return tokenizer.decode_with(both, ids, vocab.where(F.col("id") < end), out, skip, sep, limit, "_more").drop("_row", "_more")


def token_id(vocab: DataFrame, token: str) -> Column:
    """Scalar subquery: the id of one token (null when absent)."""
    return vocab.filter(F.col("token") == token).select(F.min("id")).scalar()


# ---------------------------------------------------------------- X3
def marker_starts(ids, marker: Column, m: int) -> Column:
    """1-based start positions of the ``m``-long ``marker`` array inside
    ``ids`` (O(n·m)); guarded for ids shorter than the marker and empty ids."""
    ids = _c(ids)
    n = F.size(ids)
    return F.when(n >= m, F.filter(F.sequence(F.lit(1), F.greatest(n - m + 1, F.lit(1))),
                                   lambda i: F.slice(ids, i, m) == marker)).otherwise(F.array().cast("array<int>"))


def _marker_col(marker: Sequence[Column | int]) -> Column:
    return F.array(*[x if isinstance(x, Column) else F.lit(x) for x in marker]).cast("array<bigint>")


def mask_labels(df: DataFrame, ids: str, marker: Sequence[Column | int], end_id: Column | int | None = None,
                mode: str = "first", out: str = "labels") -> DataFrame:
    """Labels = ids with ``-100`` on ignored positions.

    ``first``: everything up to the end of the first assistant marker is
    ignored (no marker → all ignored).  ``assistant_only``: only tokens after
    an assistant marker up to and including the next ``end_id`` are kept.
    The labels are put together from slices, in time that grows with the tokens
    plus the square of the markers.  Marker ids may be scalar subqueries; they
    are attached as columns first (higher-order functions cannot hold them)."""
    m = len(marker)
    d = pin_columns(df.withColumn("_mk", _marker_col(marker)))
    d = pin_columns(d.withColumn("_st", marker_starts(ids, F.col("_mk"), m)))
    n = F.size(ids)
    ignored = lambda k: F.array_repeat(F.lit(IGNORE_INDEX).cast("bigint"), k.cast("int"))
    if mode == "first":
        d = pin_columns(d.withColumn("_first", F.coalesce(F.array_min("_st") + (m - 1), n)))
        lab = F.concat(ignored(F.col("_first")), F.slice(ids, F.col("_first") + 1, F.greatest(n, F.lit(0))))
    elif mode == "assistant_only":
        d = pin_columns(d.withColumn("_end", (end_id if isinstance(end_id, Column) else F.lit(end_id)).cast("bigint")))
        d = pin_columns(d.withColumn("_en", F.filter(F.transform(ids, lambda x, i: F.when(x == F.col("_end"), i + 1)),
                                                     lambda p: p.isNotNull())))
        # The span of a marker runs from behind it to the next end (or the last token).
        spans = F.transform("_st", lambda st: F.struct((st + m).alias("a"), F.greatest(F.coalesce(F.array_min(
            F.filter("_en", lambda en: en > st)), n), st + (m - 1)).alias("b")))
        d = pin_columns(d.withColumn("_sp", spans))
        # Markers with the same end are one span, the first one's.
        d = pin_columns(d.withColumn("_sp", F.filter("_sp", lambda x, i: (i == 0) | (F.get("_sp", i - 1)["b"] != x["b"]))))
        before = lambda i: F.coalesce(F.get("_sp", i - 1)["b"], F.lit(0))
        pieces = F.transform("_sp", lambda x, i: F.concat(
            ignored(x["a"] - 1 - before(i)), F.slice(ids, x["a"], F.greatest(x["b"] - x["a"] + 1, F.lit(0)))))
        last = F.coalesce(F.get("_sp", F.size("_sp") - 1)["b"], F.lit(0))
        lab = F.concat(F.flatten(pieces), ignored(n - last))
    else:
        raise ValueError(f"unknown mode {mode}")
    return d.withColumn(out, lab.cast("array<bigint>")).drop("_mk", "_st", "_en", "_end", "_first", "_sp")


def first_marker(df: DataFrame, ids: str, marker: Sequence[Column | int], out: str) -> DataFrame:
    """1-based position of the first marker occurrence (null when absent)."""
    d = pin_columns(df.withColumn("_mk", _marker_col(marker)))
    return d.withColumn(out, F.array_min(marker_starts(ids, F.col("_mk"), len(marker))).cast("long")).drop("_mk")


def supervised_count(labels) -> Column:
    return F.size(F.filter(_c(labels), lambda x: x != IGNORE_INDEX))


# ---------------------------------------------------------------- X4
def truncate_tokens(df: DataFrame, cols: Sequence[str], max_len: int, n_col: str = "n_tokens") -> DataFrame:
    """Right-side truncation of each array column to ``max_len``; reports the
    original length and the number of cut tokens."""
    first = cols[0]
    out = df.withColumn(n_col, F.size(first).cast("long")) \
            .withColumn("n_cut", F.greatest(F.size(first) - max_len, F.lit(0)).cast("long"))
    for c in cols:
        out = out.withColumn(c, F.slice(c, 1, max_len))
    return out


# ---------------------------------------------------------------- X5
def pad_id_rule(vocab: DataFrame) -> Column:
    """The tokenizer's own pad token (end-of-text); end-of-message only if absent."""
    return F.coalesce(token_id(vocab, ENDOFTEXT), token_id(vocab, IM_END))


def pad_batches(df: DataFrame, key: str, ids: str, batch_size: int, pad_id: Column | int,
                side: str = "left", bucket: Sequence[Column] | None = None) -> DataFrame:
    """Deterministic micro-batches: rows are grouped into buckets (default:
    length class × 64 hash shards, so no bucket holds everything), sorted by
    length inside a bucket and cut into batches of ``batch_size``; each row is
    padded to its batch's longest row with an attention mask."""
    n = F.size(ids)
    bkt = list(bucket) if bucket is not None else [F.floor(n / 128).cast("long"),
                                                   F.pmod(F.xxhash64(key), F.lit(64))]
    d = df.withColumn("_n", n).withColumn("bucket", F.concat_ws(":", *[b.cast("string") for b in bkt]))
    w = Window.partitionBy("bucket").orderBy("_n", key)
    d = d.withColumn("batch", F.floor((F.row_number().over(w) - 1) / batch_size).cast("long"))
    d = d.withColumn("batch_len", F.max("_n").over(Window.partitionBy("bucket", "batch")).cast("long"))
    pid = pad_id if isinstance(pad_id, Column) else F.lit(pad_id)
    pads = F.array_repeat(pid.cast("bigint"), (F.col("batch_len") - F.col("_n")).cast("int"))
    zeros = F.array_repeat(F.lit(0), (F.col("batch_len") - F.col("_n")).cast("int"))
    ones = F.array_repeat(F.lit(1), F.col("_n"))
    if side == "left":
        d = d.withColumn("input_ids", F.concat(pads, F.col(ids))).withColumn("attention_mask", F.concat(zeros, ones))
    else:
        d = d.withColumn("input_ids", F.concat(F.col(ids), pads)).withColumn("attention_mask", F.concat(ones, zeros))
    return d.withColumn("n_pad", (F.col("batch_len") - F.col("_n")).cast("long")) \
            .withColumn("n_real", F.col("_n").cast("long")).drop("_n")


def budget_batches(df: DataFrame, key: str, ids: str, budget: int, step: int = 64) -> DataFrame:
    """Batches of at most ``budget`` padded tokens, packed by length.

    Rows are range-sorted by length (ties by ``key``) and numbered by counts
    carried across partitions.  Lengths are rounded up to ``step``; a class of
    length L is cut after every ``budget div L`` rows, so no batch, padded to its
    longest row, exceeds the budget and no row is padded by ``step`` or more
    tokens.  There is no window and no shard count: a class of any size is split
    by row numbers.  A row longer than the budget is a batch of its own, marked
    ``over_budget``; rows without tokens form classes of length ``step``.

    Adds length_class, batch, batch_len, n_real, n_pad, over_budget."""
    n = F.coalesce(F.greatest(F.size(ids), F.lit(0)), F.lit(0)).cast("long")
    d = df.withColumn("n_real", n)
    d = d.withColumn("length_class", F.greatest(F.ceil(F.col("n_real") / step), F.lit(1)).cast("long") * step)
    d = dense_index(d, ["n_real", key], name="_at")
    # One row per length class: the longest row's length / step at most.
    starts = d.groupBy(F.col("length_class").alias("_c")).agg(F.min("_at").alias("_first"))
    d = d.join(starts, F.col("length_class") == F.col("_c")).drop("_c")
    room = F.greatest(F.floor(F.lit(budget) / F.least(F.col("length_class"), F.lit(budget))), F.lit(1))
    d = d.withColumn("batch", F.floor((F.col("_at") - F.col("_first")) / F.when(F.col("n_real") > budget, 1).otherwise(room)))
    d = d.withColumn("over_budget", F.col("n_real") > budget).drop("_at", "_first")
    longest = d.groupBy(F.col("length_class").alias("_c"), F.col("batch").alias("_b")).agg(F.max("n_real").alias("batch_len"))
    d = d.join(longest, (F.col("length_class") == F.col("_c")) & (F.col("batch") == F.col("_b"))).drop("_c", "_b")
    return d.withColumn("n_pad", F.col("batch_len") - F.col("n_real"))


def budget_report(batches: DataFrame, budget: int) -> DataFrame:
    """Per length class: rows, batches, real and padded tokens, waste, the
    fullest batch and the rows that no budget of this size can hold."""
    each = batches.groupBy("length_class", "batch").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("n_real").alias("_real"), F.sum("n_pad").alias("_pad"),
        F.sum("batch_len").alias("_size"), F.max(F.col("over_budget").cast("int")).alias("_over"))
    return each.groupBy("length_class").agg(
        F.sum("_n").alias("n_samples"), F.count(F.lit(1)).alias("n_batches"), F.sum("_real").alias("real_tokens"),
        F.sum("_pad").alias("pad_tokens"), F.max(F.when(F.col("_over") == 0, F.col("_size"))).alias("largest_batch"),
        F.sum("_over").cast("long").alias("n_over_budget"),
        F.round(F.try_divide(F.sum("_pad"), F.sum("_size")), 6).alias("waste"))


# ---------------------------------------------------------------- A18
def padding_stats(padded: DataFrame) -> DataFrame:
    return padded.groupBy("bucket", "batch").agg(
        F.count(F.lit(1)).alias("n_samples"), F.sum("n_real").alias("real_tokens"),
        F.sum("n_pad").alias("pad_tokens"), F.sum(F.size("input_ids")).cast("long").alias("total_tokens")) \
        .withColumn("waste", F.round(F.col("pad_tokens") / F.col("total_tokens"), 6))


# ---------------------------------------------------------------- A3
def supervised_lengths(df: DataFrame, text: str, marker: Sequence[str], max_len: int) -> DataFrame:
    """``df`` with n_tokens and n_sup: tokens of the text, and those behind its
    first marker that remain after truncation (0 without a marker).  Counts
    need no ids: no vocabulary, no exchange."""
    d = pin_columns(df.withColumn("_t", F.coalesce(tokens(text), F.array().cast("array<string>"))))
    d = pin_columns(d.withColumn("_s", F.array_min(marker_starts("_t", F.array(*[F.lit(x) for x in marker]), len(marker)))))
    n = F.size("_t").cast("long")
    sup = F.greatest(F.least(n, F.lit(max_len)) - (F.col("_s") + len(marker) - 1), F.lit(0))
    return d.withColumn("n_tokens", n).withColumn("n_sup", F.coalesce(sup, F.lit(0)).cast("long")).drop("_t", "_s")


def token_length_stats(df: DataFrame, n_tokens: str, n_supervised: str, max_len: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_samples"), F.min(n_tokens).cast("long").alias("min_tokens"),
                  F.max(n_tokens).cast("long").alias("max_tokens"),
                  (F.sum(n_tokens).cast("long") / F.count(F.lit(1))).cast("long").alias("avg_tokens"),
                  F.count_if(F.col(n_tokens) > max_len).alias("n_over_max_len"),
                  F.count_if(F.col(n_supervised) == 0).alias("n_zero_supervised"))


# ---------------------------------------------------------------- A4
def length_by_task(df: DataFrame, category: str, task: str, n_tokens: str, limit: int = 2048) -> DataFrame:
    out = df.groupBy(category, task).agg(F.count(F.lit(1)).alias("n_samples"),
                                         F.max(n_tokens).cast("long").alias("max_tokens"),
                                         F.floor(F.avg(n_tokens)).cast("long").alias("avg_tokens"))
    return out.withColumn("bar", F.repeat(F.lit("█"), F.least(F.floor(F.col("max_tokens") / 100), F.lit(50)).cast("int"))) \
              .withColumn("over_limit", F.col("max_tokens") > limit)


# ---------------------------------------------------------------- A5
def token_efficiency(df: DataFrame, group: str, text: str) -> DataFrame:
    d = df.select(group, token_count(text).alias("_t"), F.length(text).alias("_c"), word_count(text).alias("_w"))
    agg = d.groupBy(group).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("_t").cast("long").alias("n_tokens"),
                               F.sum("_c").cast("long").alias("n_chars"), F.sum("_w").cast("long").alias("n_words"))
    return agg.withColumn("tokens_per_char", F.round(F.col("n_tokens") / F.col("n_chars"), 6)) \
              .withColumn("tokens_per_word", F.round(F.col("n_tokens") / F.col("n_words"), 6))


# ---------------------------------------------------------------- T3
def longest_samples(df: DataFrame, key: str, length: str, k: int = 10) -> DataFrame:
    """Top-k by length, ties by key (TakeOrderedAndProject: per-task top-k,
    merged; only k rows ever leave a task)."""
    top = df.orderBy(F.desc(length), F.asc(key)).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(length), F.asc(key))).cast("long"))


# ---------------------------------------------------------------- D6
def length_filter(df: DataFrame, n_tokens: str, max_len: int) -> DataFrame:
    """Route samples: ``keep`` within ``max_len``, ``long`` for those that
    need another budget (one pass; split the sinks with ``split_routes``)."""
    return df.withColumn("route", F.when(F.col(n_tokens) <= max_len, F.lit("keep")).otherwise(F.lit("long")))


def split_routes(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, long) views of a routed frame; persist ``routed`` first when
    both sinks are written."""
    return routed.filter(F.col("route") == "keep"), routed.filter(F.col("route") == "long")


__all__ = ["TOKEN_PATTERN", "build_vocab", "encode", "encode_corpus", "decode", "decode_corpus", "mask_labels", "truncate_tokens",
           "pad_batches", "budget_batches", "budget_report", "padding_stats", "token_length_stats", "length_by_task", "token_efficiency",
           "longest_samples", "length_filter", "split_routes", "supervised_count", "pad_id_rule", "token_id", "marker_starts",
           "first_marker"]
