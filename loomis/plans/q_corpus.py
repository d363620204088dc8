"""Token-array queries: vocabulary, encode/decode, masking, truncation,
padding and the length reports, over the documents and the rendered
conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomis.functions.text import token_count
from loomis.operators import chatml as cm
from loomis.operators import tokens as tk
from loomis.plans import bindings as b
from loomis.plans import sqlparts as s
from loomis.plans.registry import register
from loomis.plans.sequence import spread
from loomis.schemas import DEFAULT_MAX_LEN

MAX_LEN = DEFAULT_MAX_LEN
BATCH = 4          # micro-batch size (2–4 recommended for an 8 GB card)
LIMIT = 2048       # max_len flag of the length report


def _docs(spark, sf):
    return b.table(spark, sf, "documents")


def rendered_conversations(spark, sf):
    return cm.render_training_text(cm.assemble_conversations(b.table(spark, sf, "conversations")))


def encoded_conversations(spark, sf):
    r = rendered_conversations(spark, sf).select("conv_id", "text")
    voc = tk.build_vocab(r, "text")
    enc = tk.encode_corpus(r, "conv_id", "text", voc).select("conv_id", "ids")
    return enc, voc


def masked_conversations(spark, sf):
    enc, voc = encoded_conversations(spark, sf)
    marker = [tk.token_id(voc, "<|im_start|>"), tk.token_id(voc, "assistant")]
    end = tk.token_id(voc, "<|im_end|>")
    m = tk.mask_labels(enc, "ids", marker, mode="first", out="labels_first")
    m = tk.mask_labels(m, "ids", marker, end_id=end, mode="assistant_only", out="labels_assistant_only")
    return tk.first_marker(m, "ids", marker, "assistant_start"), voc


def _ids_str(c):
    return F.array_join(F.col(c).cast("array<string>"), " ")


def _sql_ids(c):
    return f"array_to_string({c}, ' ')"


DOC_VOCAB = s.vocab("DV", "documents")
CONV_VOCAB = [s.CRENDER, *s.vocab("CV", "CRENDER")]
CONV_ENC = [*CONV_VOCAB, s.encoded("CENC", "CRENDER", "conv_id", "CV"), """MK AS (
  SELECT (SELECT id FROM CV WHERE token = '<|im_start|>') AS ms, (SELECT id FROM CV WHERE token = 'assistant') AS ma,
         (SELECT id FROM CV WHERE token = '<|im_end|>') AS me)""", """ST AS (
  SELECT conv_id, ids, list_filter(range(1, len(ids)), lambda i: ids[i] = MK.ms AND ids[i + 1] = MK.ma) AS st,
         list_filter(range(1, len(ids) + 1), lambda i: ids[i] = MK.me) AS en
  FROM CENC, MK)""", """MASKED AS (
  SELECT conv_id, ids, list_min(st) AS assistant_start,
         list_transform(ids, lambda x, i: CASE WHEN list_min(st) IS NOT NULL AND i >= list_min(st) + 2
                                               THEN x ELSE -100 END) AS labels_first,
         list_transform(ids, lambda x, i: CASE WHEN list_max(list_filter(st, lambda q: q + 2 <= i)) IS NOT NULL
              AND (list_max(list_filter(en, lambda q: q < i)) IS NULL
                   OR list_max(list_filter(en, lambda q: q < i)) < list_max(list_filter(st, lambda q: q + 2 <= i)))
              THEN x ELSE -100 END) AS labels_assistant_only
  FROM ST)"""]


# ---------------------------------------------------------------- A6
@register("build_vocab", s.q(*DOC_VOCAB, "SELECT token, freq, id FROM DV"))
def build_vocab(spark, sf):
    return tk.build_vocab(_docs(spark, sf), "text")


# ---------------------------------------------------------------- X1
@register("tokenize_corpus", s.q(*DOC_VOCAB, s.encoded("DENC", "documents", "doc_id", "DV"), f"""
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_tokens, {_sql_ids('ids')} AS ids FROM DENC"""))
def tokenize_corpus(spark, sf):
    d = spread(_docs(spark, sf).select("doc_id", "text"))
    enc = tk.encode_corpus(d, "doc_id", "text", tk.build_vocab(d, "text"))
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), _ids_str("ids").alias("ids"))


# ---------------------------------------------------------------- X2
@register("decode_tokens", f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{s.PAT}')) AS BIGINT) AS n_tokens,
       CAST(length(array_to_string(regexp_extract_all(text, '{s.PAT}'), '')) AS BIGINT) AS decoded_chars,
       array_to_string(regexp_extract_all(text, '{s.PAT}'), '')
         = regexp_replace(text, '[\\s\\x{{0b}}]', '', 'g') AS roundtrip_ok
FROM documents""")
def decode_tokens(spark, sf):
    d = spread(_docs(spark, sf).select("doc_id", "text"))
    voc = tk.build_vocab(d, "text")
    enc = tk.encode_corpus(d, "doc_id", "text", voc)
    # The text stays in its row, so the comparison needs no join.
    dec = tk.decode_corpus(enc, "doc_id", "ids", voc)
    return dec.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.length("decoded").cast("long").alias("decoded_chars"),
                      (F.col("decoded") == F.regexp_replace("text", r"[\s\x{0b}]", "")).alias("roundtrip_ok"))


# ---------------------------------------------------------------- X3
@register("mask_labels", s.q(*CONV_ENC, f"""
SELECT conv_id, CAST(len(ids) AS BIGINT) AS n_tokens, CAST(assistant_start AS BIGINT) AS assistant_start,
       CAST(len(list_filter(labels_first, lambda x: x <> -100)) AS BIGINT) AS n_supervised_first,
       CAST(len(list_filter(labels_assistant_only, lambda x: x <> -100)) AS BIGINT) AS n_supervised_assistant_only,
       {_sql_ids('labels_first')} AS labels_first, {_sql_ids('labels_assistant_only')} AS labels_assistant_only
FROM MASKED"""))
def mask_labels(spark, sf):
    m, _ = masked_conversations(spark, sf)
    return m.select("conv_id", F.size("ids").cast("long").alias("n_tokens"), "assistant_start",
                    tk.supervised_count("labels_first").cast("long").alias("n_supervised_first"),
                    tk.supervised_count("labels_assistant_only").cast("long").alias("n_supervised_assistant_only"),
                    _ids_str("labels_first").alias("labels_first"),
                    _ids_str("labels_assistant_only").alias("labels_assistant_only"))


# ---------------------------------------------------------------- X4
@register("truncate_tokens", s.q(*CONV_ENC, f"""
SELECT conv_id, CAST(len(ids) AS BIGINT) AS n_tokens, CAST(greatest(len(ids) - {MAX_LEN}, 0) AS BIGINT) AS n_cut,
       CAST(least(len(ids), {MAX_LEN}) AS BIGINT) AS n_kept,
       CAST(len(list_filter(labels_first[1:{MAX_LEN}], lambda x: x <> -100)) AS BIGINT) AS n_supervised_kept,
       {_sql_ids(f'ids[1:{MAX_LEN}]')} AS ids
FROM MASKED"""))
def truncate_tokens(spark, sf):
    m, _ = masked_conversations(spark, sf)
    t = tk.truncate_tokens(m, ["ids", "labels_first"], MAX_LEN)
    return t.select("conv_id", "n_tokens", "n_cut", F.size("ids").cast("long").alias("n_kept"),
                    tk.supervised_count("labels_first").cast("long").alias("n_supervised_kept"),
                    _ids_str("ids").alias("ids"))


# ---------------------------------------------------------------- A3
@register("token_length_stats", s.q(*CONV_ENC, f"""
SELECT count(*) AS n_samples, CAST(min(len(ids)) AS BIGINT) AS min_tokens, CAST(max(len(ids)) AS BIGINT) AS max_tokens,
       CAST(sum(len(ids)) // count(*) AS BIGINT) AS avg_tokens,
       count(*) FILTER (WHERE len(ids) > {MAX_LEN}) AS n_over_max_len,
       count(*) FILTER (WHERE len(list_filter(labels_first[1:{MAX_LEN}], lambda x: x <> -100)) = 0) AS n_zero_supervised
FROM MASKED"""))
def token_length_stats(spark, sf):
    t = tk.supervised_lengths(rendered_conversations(spark, sf), "text", ["<|im_start|>", "assistant"], MAX_LEN)
    return tk.token_length_stats(t, "n_tokens", "n_sup", MAX_LEN)


def _padded(spark, sf):
    enc, voc = encoded_conversations(spark, sf)
    return tk.pad_batches(enc, "conv_id", "ids", BATCH, tk.pad_id_rule(voc), side="left",
                          bucket=[F.floor(F.size("ids") / 128).cast("long"), F.col("conv_id") % 8])


PADDED = [*CONV_VOCAB, s.encoded("CENC", "CRENDER", "conv_id", "CV"), f"""PB AS (
  SELECT conv_id, ids, (len(ids) // 128) || ':' || (conv_id % 8) AS bucket,
         CAST((row_number() OVER (PARTITION BY (len(ids) // 128) || ':' || (conv_id % 8)
                                  ORDER BY len(ids), conv_id) - 1) // {BATCH} AS BIGINT) AS batch
  FROM CENC)""", """PADDED AS (
  SELECT *, CAST(max(len(ids)) OVER (PARTITION BY bucket, batch) AS BIGINT) AS batch_len,
         coalesce((SELECT id FROM CV WHERE token = '<|endoftext|>'), (SELECT id FROM CV WHERE token = '<|im_end|>')) AS pad
  FROM PB)"""]


# ---------------------------------------------------------------- X5
@register("pad_batches", s.q(*PADDED, """
SELECT conv_id, bucket, batch, batch_len, CAST(batch_len - len(ids) AS BIGINT) AS n_pad,
       CAST(len(ids) AS BIGINT) AS n_real,
       array_to_string(list_concat(list_transform(range(batch_len - len(ids)), lambda x: pad), ids), ' ') AS input_ids,
       array_to_string(list_concat(list_transform(range(batch_len - len(ids)), lambda x: 0),
                                   list_transform(range(len(ids)), lambda x: 1)), ' ') AS attention_mask
FROM PADDED"""))
def pad_batches(spark, sf):
    p = _padded(spark, sf)
    return p.select("conv_id", "bucket", "batch", "batch_len", "n_pad", "n_real",
                    _ids_str("input_ids").alias("input_ids"), _ids_str("attention_mask").alias("attention_mask"))


# ---------------------------------------------------------------- A18
@register("padding_stats", s.q(*PADDED, """
SELECT bucket, batch, count(*) AS n_samples, CAST(sum(len(ids)) AS BIGINT) AS real_tokens,
       CAST(sum(batch_len - len(ids)) AS BIGINT) AS pad_tokens, CAST(sum(batch_len) AS BIGINT) AS total_tokens,
       round(sum(batch_len - len(ids)) / sum(batch_len), 6) AS waste
FROM PADDED GROUP BY bucket, batch"""))
def padding_stats(spark, sf):
    return tk.padding_stats(_padded(spark, sf))


BUDGET = 8192      # padded tokens of a batch
STEP = 64
BUDGETED = [*CONV_VOCAB, s.encoded("CENC", "CRENDER", "conv_id", "CV"), f"""BC AS (
  SELECT conv_id, CAST(len(ids) AS BIGINT) AS n_real,
         CAST(greatest(ceil(len(ids) / {STEP}), 1) AS BIGINT) * {STEP} AS length_class FROM CENC)""", f"""BB AS (
  SELECT *, n_real > {BUDGET} AS over_budget,
         CAST((row_number() OVER (PARTITION BY length_class ORDER BY n_real, conv_id) - 1)
              // (CASE WHEN n_real > {BUDGET} THEN 1 ELSE greatest({BUDGET} // least(length_class, {BUDGET}), 1) END)
              AS BIGINT) AS batch FROM BC)""", """BL AS (
  SELECT *, max(n_real) OVER (PARTITION BY length_class, batch) AS batch_len FROM BB)"""]


def _budgeted(spark, sf):
    enc, _ = encoded_conversations(spark, sf)
    return tk.budget_batches(enc, "conv_id", "ids", BUDGET, STEP)


@register("budget_batches", s.q(*BUDGETED, """
SELECT conv_id, length_class, batch, batch_len, n_real, batch_len - n_real AS n_pad, over_budget FROM BL"""))
def budget_batches(spark, sf):
    """Conversations packed by length into batches of 8,192 padded tokens."""
    return _budgeted(spark, sf).select("conv_id", "length_class", "batch", "batch_len", "n_real", "n_pad", "over_budget")


@register("budget_report", s.q(*BUDGETED, """
SELECT length_class, CAST(sum(n) AS BIGINT) AS n_samples, count(*) AS n_batches, CAST(sum(r) AS BIGINT) AS real_tokens,
       CAST(sum(z - r) AS BIGINT) AS pad_tokens, max(CASE WHEN NOT o THEN z END) AS largest_batch,
       CAST(sum(CASE WHEN o THEN 1 ELSE 0 END) AS BIGINT) AS n_over_budget, round(sum(z - r) / nullif(sum(z), 0), 6) AS waste
FROM (SELECT length_class, batch, count(*) AS n, sum(n_real) AS r, CAST(sum(batch_len) AS BIGINT) AS z, bool_or(over_budget) AS o
      FROM BL GROUP BY length_class, batch)
GROUP BY length_class"""))
def budget_report(spark, sf):
    return tk.budget_report(_budgeted(spark, sf), BUDGET)


# ---------------------------------------------------------------- A4
@register("length_by_task", f"""
SELECT lang AS category, source AS task, count(*) AS n_samples,
       CAST(max(n) AS BIGINT) AS max_tokens, CAST(floor(avg(n)) AS BIGINT) AS avg_tokens,
       repeat('█', CAST(least(max(n) // 100, 50) AS INTEGER)) AS bar, max(n) > {LIMIT} AS over_limit
FROM (SELECT lang, source, len(regexp_extract_all(text, '{s.PAT}')) AS n FROM documents)
GROUP BY lang, source""")
def length_by_task(spark, sf):
    d = _docs(spark, sf).select(F.col("lang").alias("category"), F.col("source").alias("task"),
                                token_count("text").alias("n"))
    return tk.length_by_task(d, "category", "task", "n", LIMIT)


# ---------------------------------------------------------------- A5
@register("token_efficiency", f"""
SELECT lang, count(*) AS n_docs, CAST(sum(t) AS BIGINT) AS n_tokens, CAST(sum(c) AS BIGINT) AS n_chars,
       CAST(sum(w) AS BIGINT) AS n_words,
       round(sum(t) / sum(c), 6) AS tokens_per_char, round(sum(t) / sum(w), 6) AS tokens_per_word
FROM (SELECT lang, len(regexp_extract_all(text, '{s.PAT}')) AS t, length(text) AS c,
             len(regexp_extract_all(text, '[^\\s\\x{{0b}}]+')) AS w FROM documents)
GROUP BY lang""")
def token_efficiency(spark, sf):
    return tk.token_efficiency(_docs(spark, sf), "lang", "text")


# ---------------------------------------------------------------- T3
@register("longest_samples", f"""
SELECT doc_id, n_tokens, row_number() OVER (ORDER BY n_tokens DESC, doc_id) AS rank FROM (
  SELECT doc_id, CAST(len(regexp_extract_all(text, '{s.PAT}')) AS BIGINT) AS n_tokens FROM documents)
ORDER BY n_tokens DESC, doc_id LIMIT 10""")
def longest_samples(spark, sf):
    d = _docs(spark, sf).select("doc_id", token_count("text").cast("long").alias("n_tokens"))
    return tk.longest_samples(d, "doc_id", "n_tokens", 10)


# ---------------------------------------------------------------- D6
@register("length_filter", f"""
SELECT doc_id, n_tokens, CASE WHEN n_tokens <= {LIMIT} THEN 'keep' ELSE 'long' END AS route FROM (
  SELECT doc_id, CAST(len(regexp_extract_all(text, '{s.PAT}')) AS BIGINT) AS n_tokens FROM documents)""")
def length_filter(spark, sf):
    d = _docs(spark, sf).select("doc_id", token_count("text").cast("long").alias("n_tokens"))
    return tk.length_filter(d, "n_tokens", LIMIT)
