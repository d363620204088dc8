"""Raw-ingestion queries: raw records with polymorphic JSON (derived from the
conversations), sectioned task files, three-field uploads and the dataset /
generation sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from loomis.operators import chatml as cm
from loomis.operators import evaluate as ev
from loomis.operators import records as rc
from loomis.plans import bindings as b
from loomis.plans import sqlparts as s
from loomis.plans.q_records import CTX, IDS, LA
from loomis.plans.registry import register
from loomis.schemas import SECTION_HEADINGS
from loomis.session import scratch_path
from loomis.sources import tasks as src

CATEGORIES = [c for c, _ in SECTION_HEADINGS]
CONVS_PER_FILE = 50


def raw_records(spark, sf):
    """One raw task record per conversation, JSON text + VARIANT, with every
    polymorphic form of the task format chosen deterministically by id:
    messages as list / JSON string / absent / broken string / number, content
    as string or text+image block list, metadata as dict / JSON string / bare
    string / nested answer / JSON list (bad) / absent."""
    t = b.table(spark, sf, "conversations")
    q = src.json_quote
    cid = F.col("conv_id")
    content = F.when(cid % 2 == 1, F.concat(F.lit('[{"type":"text","text":'), q(F.col("text")),
                                            F.lit('},{"type":"image","url":"u"}]'))).otherwise(q(F.col("text")))
    msg = F.concat(F.lit('{"role":'), q(F.col("role")), F.lit(',"content":'), content, F.lit("}"))
    is_a = F.col("role") == "assistant"
    g = t.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", msg.alias("m")))).alias("_ms"),
        F.max_by(F.when(is_a, F.col("text")), F.when(is_a, F.col("turn"))).alias("ans"),
        F.count(F.lit(1)).alias("n_turns"))
    msgs = F.concat(F.lit("["), F.array_join(F.transform("_ms", lambda x: x["m"]), ","), F.lit("]"))
    mpart = (F.when(cid % 7 == 5, F.lit(None))
             .when(cid % 11 == 7, F.concat(F.lit('"messages":'), q(F.lit('[{"role": "user"'))))
             .when(cid % 13 == 3, F.lit('"messages":42'))
             .when(cid % 3 == 0, F.concat(F.lit('"messages":'), q(msgs)))
             .otherwise(F.concat(F.lit('"messages":'), msgs)))
    ans = F.col("ans")
    dpart = (F.when(ans.isNull(), F.lit(None))
             .when(cid % 17 == 4, F.concat(F.lit('"metadata":'), q(F.lit("[1, 2]"))))
             .when(cid % 4 == 0, F.concat(F.lit('"metadata":{"answer":'), q(ans), F.lit("}")))
             .when(cid % 4 == 1, F.concat(F.lit('"metadata":'), q(F.concat(F.lit('{"answer":'), q(ans), F.lit("}")))))
             .when(cid % 4 == 2, F.concat(F.lit('"metadata":'), q(ans)))
             .otherwise(F.concat(F.lit('"metadata":{"answer":{"n":'), F.col("n_turns").cast("string"),
                                 F.lit(',"len":'), F.length(ans).cast("string"), F.lit("}}"))))
    body_text = F.concat(F.lit("{"), F.concat_ws(",", mpart, dpart), F.lit("}"))
    cat = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (cid % 4 + 1).cast("int"))
    return g.select("conv_id", cat.alias("category"), F.concat(F.lit("task_"), cid.cast("string")).alias("task"),
                    body_text.alias("body_text")).withColumn("body", F.try_parse_json("body_text"))


def _parsed(df):
    return rc.extract_answers(rc.normalize_messages(df, "body"), "body", "body_text") \
             .withColumn("section_status", F.lit("ok"))


_MT = ("CASE WHEN conv_id % 7 = 5 THEN 'absent' WHEN conv_id % 11 = 7 THEN 'bad_json' "
       "WHEN conv_id % 13 = 3 THEN 'other' WHEN conv_id % 3 = 0 THEN 'json_string' ELSE 'list' END")
RAW = f"""R AS (
  SELECT conv_id, {_MT} AS mt, count(*) AS n_turns,
         string_agg(role || ': ' || text, {s.NL} ORDER BY turn) AS transcript,
         arg_max(text, turn) FILTER (WHERE role = 'assistant') AS ans
  FROM conversations GROUP BY conv_id)""", """A AS (
  SELECT *, CASE WHEN ans IS NULL THEN 'absent' WHEN conv_id % 17 = 4 THEN 'bad_metadata'
                 WHEN conv_id % 4 IN (0, 1) THEN 'string' WHEN conv_id % 4 = 2 THEN 'bare' ELSE 'nested' END AS atype,
            CASE WHEN ans IS NULL THEN '' WHEN conv_id % 17 = 4 THEN NULL
                 WHEN conv_id % 4 = 3 THEN '{"n":' || n_turns || ',"len":' || length(ans) || '}' ELSE ans END AS answer
  FROM R)"""


# ---------------------------------------------------------------- P1
@register("normalize_messages", s.q(*RAW, """
SELECT conv_id, mt AS messages_type,
       CASE WHEN mt IN ('list', 'json_string') THEN CASE WHEN conv_id % 2 = 1 THEN 'blocks' ELSE 'string' END END
         AS content_type,
       CASE WHEN mt IN ('list', 'json_string') THEN n_turns END AS n_turns,
       CASE WHEN mt IN ('list', 'json_string') THEN transcript END AS transcript
FROM A"""))
def normalize_messages(spark, sf):
    n = rc.normalize_messages(raw_records(spark, sf), "body")
    return n.select("conv_id", "messages_type", "content_type", F.size("messages").cast("long").alias("n_turns"),
                    F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])),
                                 "\n").alias("transcript"))


# ---------------------------------------------------------------- P2
@register("extract_answers", s.q(*RAW, "SELECT conv_id, atype AS answer_type, answer FROM A"))
def extract_answers(spark, sf):
    a = rc.extract_answers(raw_records(spark, sf), "body", "body_text")
    return a.select("conv_id", "answer_type", "answer")


# ---------------------------------------------------------------- P3
@register("quarantine_rejects", s.q(*RAW, """
SELECT conv_id, reason FROM (
  SELECT conv_id, CASE WHEN mt = 'absent' THEN 'no_messages' WHEN mt = 'bad_json' THEN 'bad_messages_json'
                       WHEN mt = 'other' THEN 'bad_messages_type' WHEN atype = 'bad_metadata' THEN 'bad_metadata'
                       WHEN coalesce(answer, '') = '' THEN 'no_answer' END AS reason FROM A)
WHERE reason IS NOT NULL"""))
def quarantine_rejects(spark, sf):
    p = _parsed(raw_records(spark, sf))
    _, rejected = rc.quarantine_rejects(p, rc.reject_reason(p))
    return rejected.select("conv_id", "reason")


# ---------------------------------------------------------------- S1
_REASON = """CASE WHEN mt = 'absent' THEN 'no_messages' WHEN mt = 'bad_json' THEN 'bad_messages_json'
                       WHEN mt = 'other' THEN 'bad_messages_type' WHEN atype = 'bad_metadata' THEN 'bad_metadata'
                       WHEN coalesce(answer, '') = '' THEN 'no_answer' END"""
_CATS = "['" + "','".join(CATEGORIES) + "']"


@register("read_sectioned_tasks", s.q(*RAW, f"""F AS (
  SELECT DISTINCT conv_id // {CONVS_PER_FILE} AS file_id, unnest({_CATS}) AS category FROM R)""", f"""
SELECT CAST(F.file_id AS BIGINT) AS file_id, F.category, CASE WHEN conv_id IS NULL THEN NULL ELSE 'task_' || conv_id END AS task,
       CASE WHEN conv_id IS NULL THEN 'missing' ELSE 'ok' END AS section_status, coalesce(mt, 'absent') AS messages_type,
       coalesce(atype, 'absent') AS answer_type,
       CASE WHEN conv_id IS NULL THEN 'missing_section' ELSE {_REASON} END AS reason
FROM F LEFT JOIN A ON conv_id // {CONVS_PER_FILE} = F.file_id AND {_CATS}[conv_id % 4 + 1] = F.category"""))
def read_sectioned_tasks(spark, sf):
    """Raw records grouped into task files of 50 conversations (heading per
    category, full-width or ASCII colon, a preamble line), written as text
    files to the shared scratch folder and read back by the data source."""
    r = raw_records(spark, sf).withColumn("file_id", (F.col("conv_id") / CONVS_PER_FILE).cast("long"))
    entry = F.concat(src.json_quote(F.col("task")), F.lit(":"), F.col("body_text"))
    sec = r.groupBy("file_id", "category").agg(
        F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(entry)), ","), F.lit("}")).alias("obj"))
    colon = F.when(F.col("file_id") % 2 == 0, F.lit("：")).otherwise(F.lit(":"))
    heads = {c: h for c, h in SECTION_HEADINGS}
    head = F.lit(None).cast("string")
    for c in CATEGORIES:
        head = F.when(F.col("category") == c, F.lit(heads[c])).otherwise(head)
    sec = sec.withColumn("part", F.concat(head, colon, F.lit("\n"), F.col("obj"), F.lit("\n")))
    order = F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), F.col("category"))
    files = sec.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "part"))).alias("_p")) \
               .select("file_id", F.concat(F.lit("示例数据说明\n"),
                                           F.array_join(F.transform("_p", lambda x: x["part"]), "")).alias("value"))
    path = scratch_path(spark, "task_files", uuid.uuid4().hex)
    files.write.mode("overwrite").partitionBy("file_id").text(path)
    parsed = src.read_sectioned_tasks(spark, path)
    p = rc.extract_answers(rc.normalize_messages(parsed, "body"), "body", "body_text")
    p = p.withColumn("reason", rc.reject_reason(p))
    return p.select(F.regexp_extract("file", r"file_id=([0-9]+)", 1).cast("long").alias("file_id"),
                    "category", "task", "section_status", "messages_type", "answer_type", "reason")


# ---------------------------------------------------------------- S2
@register("ingest_sft_records", s.q(LA, CTX, IDS, f"""T3 AS (
  SELECT i.conv_id,
         coalesce((SELECT arg_min(text, turn) FROM conversations x WHERE x.conv_id = i.conv_id
                   AND x.role = 'system'), '') AS system,
         coalesce((SELECT string_agg(text, {s.NL} ORDER BY turn) FROM CTX WHERE CTX.conv_id = i.conv_id
                   AND CTX.role <> 'system'), '') AS prompt,
         LA.ans AS response
  FROM IDS i JOIN LA USING (conv_id))""", """
SELECT conv_id,
       CASE WHEN conv_id % 10 = 9 THEN NULL ELSE system END AS system,
       CASE WHEN conv_id % 10 = 9 THEN NULL ELSE prompt END AS prompt,
       CASE WHEN conv_id % 10 = 9 THEN NULL ELSE response END AS response,
       CASE WHEN conv_id % 10 = 9 THEN 'corrupt'
            WHEN prompt IS NULL OR regexp_replace(prompt, '^\\s+|\\s+$', '', 'g') = '' THEN 'missing_prompt'
            WHEN response IS NULL OR regexp_replace(response, '^\\s+|\\s+$', '', 'g') = '' THEN 'missing_response'
       END AS reason
FROM T3"""))
def ingest_sft_records(spark, sf):
    """Three-field JSON lines (every tenth line garbled) → PERMISSIVE parse →
    upload check."""
    tf = cm.to_three_field(cm.assemble_conversations(b.table(spark, sf, "conversations")))
    line = F.when(F.col("conv_id") % 10 == 9, F.concat(F.lit("not json "), F.col("conv_id").cast("string"))) \
            .otherwise(F.to_json(F.struct("system", "prompt", "response")))
    lines = tf.select("conv_id", line.alias("value"))
    p = src.parse_sft_lines(lines, "value")
    return p.select("conv_id", "system", "prompt", "response", src.sft_reject_reason().alias("reason"))


@register("read_sft_uploads", s.q(LA, CTX, IDS, f"""T3 AS (
  SELECT i.conv_id,
         coalesce((SELECT arg_min(text, turn) FROM conversations x WHERE x.conv_id = i.conv_id AND x.role = 'system'), '') AS system,
         coalesce((SELECT string_agg(text, {s.NL} ORDER BY turn) FROM CTX WHERE CTX.conv_id = i.conv_id
                   AND CTX.role <> 'system'), '') AS prompt,
         LA.ans AS response
  FROM IDS i JOIN LA USING (conv_id))""", """
SELECT f.format, sha256(concat_ws('|', system, prompt, coalesce(response, 'none'))) AS record, count(*) AS n
FROM T3 CROSS JOIN (VALUES ('csv'), ('json')) f(format) GROUP BY ALL
UNION ALL SELECT 'json', 'corrupt', count(*) FROM IDS"""))
def read_sft_uploads(spark, sf):
    """Uploads written as JSON lines (each followed by a garbled line) and as CSV
    with newlines, quotes and commas inside fields, read by ``read_sft_records``."""
    tf = cm.to_three_field(cm.assemble_conversations(b.table(spark, sf, "conversations"))).select("system", "prompt", "response")
    base = scratch_path(spark, "uploads", uuid.uuid4().hex)
    lines = tf.select(F.explode(F.array(F.to_json(F.struct("system", "prompt", "response")), F.lit("not json"))).alias("value"))
    lines.write.text(f"{base}/json")
    tf.write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false") \
        .option("ignoreTrailingWhiteSpace", "false").csv(f"{base}/csv")
    both = None
    for fmt in ("json", "csv"):
        r = src.read_sft_records(spark, f"{base}/{fmt}", fmt)
        body = F.sha2(F.concat_ws("|", F.coalesce("system", F.lit("")), F.coalesce("prompt", F.lit("")),
                                  F.coalesce("response", F.lit("none"))), 256)
        r = r.select(F.lit(fmt).alias("format"), F.when(F.col("_corrupt").isNotNull(), F.lit("corrupt")).otherwise(body).alias("record"))
        both = r if both is None else both.unionByName(r)
    return both.groupBy("format", "record").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- S4
@register("write_training_set", f"""
WITH LA AS (SELECT conv_id, max(turn) FILTER (WHERE role = 'assistant') AS la,
                   arg_max(text, turn) FILTER (WHERE role = 'assistant') AS ans FROM conversations GROUP BY conv_id)
SELECT v.version, ['{"','".join(CATEGORIES)}'][c.conv_id % 4 + 1] AS category, c.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS content
FROM conversations c JOIN LA USING (conv_id) CROSS JOIN (VALUES ('v1'), ('v2')) v(version)
WHERE LA.la IS NOT NULL AND length(LA.ans) > 0 AND c.turn <= LA.la AND (v.version = 'v1' OR c.conv_id % 4 <> 1)
GROUP BY v.version, c.conv_id""")
def write_training_set(spark, sf):
    """Two versions of a dataset as JSON lines, the second without a category;
    the first is written twice, which replaces it.  Contents are read back."""
    sp = cm.split_answer(cm.assemble_conversations(b.table(spark, sf, "conversations")))
    rec = cm.append_answer_turn(sp.drop("messages"), "context", "answer", out="messages")
    cat = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (F.col("conv_id") % 4 + 1).cast("int"))
    rec = rec.select("conv_id", cat.alias("category"), "messages")
    path = scratch_path(spark, "datasets", uuid.uuid4().hex)
    for version, part in (("v1", rec.limit(5)), ("v1", rec), ("v2", rec.where("conv_id % 4 <> 1"))):
        src.write_training_set(part, path, version, fmt="json")
    schema = "version string, category string, conv_id long, messages array<struct<role:string,content:string>>"
    back = spark.read.schema(schema).json(path)
    text = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")
    return back.select("version", "category", "conv_id", F.size("messages").cast("long").alias("n_turns"),
                       F.sha2(text, 256).alias("content"))


# ---------------------------------------------------------------- S5
@register("store_generations", s.q(*s.CAND_BASE[:5], """
SELECT 'r1' AS run, prompt_id, attempt, mode, response FROM CAPPED"""))
def store_generations(spark, sf):
    capped = ev.cap_candidates(b.candidates(spark, sf)).select("prompt_id", "attempt", "mode", "response")
    path = src.store_generations(capped, scratch_path(spark, "generations", uuid.uuid4().hex), "r1")
    return spark.read.parquet(path).select("run", "prompt_id", "attempt", "mode", "response")
