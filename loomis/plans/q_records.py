"""Chat-record queries over the conversations table (and documents / part
for the catalogue and report operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomis.operators import chatml as cm
from loomis.operators import records as rc
from loomis.plans import bindings as b
from loomis.plans import sqlparts as s
from loomis.plans.registry import register

NL = s.NL
STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _strip(x: str) -> str:
    return STRIP.format(x=x)


def conv(spark, sf):
    return cm.assemble_conversations(b.table(spark, sf, "conversations"))


def _transcript(col="messages"):
    return F.array_join(F.transform(col, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")


# Last assistant turn (the answer) and the context before it, per conversation.
LA = """LA AS (
  SELECT conv_id, max(turn) FILTER (WHERE role = 'assistant') AS la,
         arg_max(text, turn) FILTER (WHERE role = 'assistant') AS ans
  FROM conversations GROUP BY conv_id)"""
CTX = """CTX AS (
  SELECT c.* FROM conversations c JOIN LA USING (conv_id) WHERE LA.la IS NULL OR c.turn < LA.la)"""
IDS = """IDS AS (SELECT DISTINCT conv_id FROM conversations)"""


# ---------------------------------------------------------------- S3
@register("assemble_conversations", f"""
SELECT conv_id, count(*) AS n_turns, string_agg(role || ': ' || text, {NL} ORDER BY turn) AS transcript
FROM conversations GROUP BY conv_id""")
def assemble_conversations(spark, sf):
    c = conv(spark, sf)
    return c.select("conv_id", F.size("messages").cast("long").alias("n_turns"), _transcript().alias("transcript"))


# ---------------------------------------------------------------- P4
@register("append_answer_turn", s.q(LA, f"""
SELECT c.conv_id, count(*) AS n_turns, 'assistant' AS last_role,
       string_agg(role || ': ' || text, {NL} ORDER BY turn) AS transcript
FROM conversations c JOIN LA USING (conv_id)
WHERE LA.la IS NOT NULL AND length(LA.ans) > 0 AND c.turn <= LA.la
GROUP BY c.conv_id"""))
def append_answer_turn(spark, sf):
    sp = cm.split_answer(conv(spark, sf))
    out = cm.append_answer_turn(sp.drop("messages"), "context", "answer", out="messages")
    return out.select("conv_id", F.size("messages").cast("long").alias("n_turns"),
                      F.element_at("messages", -1)["role"].alias("last_role"), _transcript().alias("transcript"))


# ---------------------------------------------------------------- P5
@register("render_training_text", s.q(s.CRENDER, """
SELECT conv_id, text, CAST(length(text) AS BIGINT) AS n_chars FROM CRENDER"""))
def render_training_text(spark, sf):
    r = cm.render_training_text(conv(spark, sf))
    return r.select("conv_id", "text", F.length("text").cast("long").alias("n_chars"))


# ---------------------------------------------------------------- P6
@register("render_prompts", s.q(LA, CTX, IDS, f"""P AS (
  SELECT conv_id,
         string_agg('<|im_start|>' || role || {NL} || text || '<|im_end|>' || {NL}, '' ORDER BY turn) AS chat,
         string_agg(CASE role WHEN 'user' THEN '用户：' || text WHEN 'assistant' THEN '回答：' || text ELSE text END,
                    {NL} ORDER BY turn) AS plain
  FROM CTX GROUP BY conv_id)""", f"""
SELECT conv_id, coalesce(chat, '') || '<|im_start|>assistant' || {NL} AS prompt,
       coalesce(chat, '') || '<|im_start|>assistant' || {NL} || '<think>' || {NL} || {NL} || '</think>' || {NL} || {NL}
         AS prompt_no_think,
       concat_ws({NL}, plain, '回答：') AS prompt_plain
FROM IDS LEFT JOIN P USING (conv_id)"""))
def render_prompts(spark, sf):
    sp = cm.split_answer(conv(spark, sf))
    return cm.render_prompts(sp, "context", template_present=True).select("conv_id", "prompt", "prompt_no_think",
                                                                          "prompt_plain")


# ---------------------------------------------------------------- P7
THREE_FIELD_SQL = s.q(LA, CTX, IDS, f"""
SELECT i.conv_id,
       coalesce((SELECT arg_min(text, turn) FROM conversations x WHERE x.conv_id = i.conv_id AND x.role = 'system'), '')
         AS system,
       coalesce((SELECT string_agg(text, {NL} ORDER BY turn) FROM CTX WHERE CTX.conv_id = i.conv_id
                   AND CTX.role <> 'system'), '') AS prompt,
       LA.ans AS response
FROM IDS i JOIN LA USING (conv_id)""")


@register("to_three_field", THREE_FIELD_SQL)
def to_three_field(spark, sf):
    return cm.to_three_field(conv(spark, sf)).select("conv_id", "system", "prompt", "response")


# ---------------------------------------------------------------- P8
@register("thinking_control", f"""
SELECT conv_id, CASE WHEN conv_id % 2 = 0 THEN 'thinking' ELSE 'non_thinking' END AS mode,
       count(*) AS n_turns,
       arg_max(text, turn) FILTER (WHERE role = 'user')
         || CASE WHEN conv_id % 2 = 0 THEN ' /think' ELSE ' /no_think' END AS last_user
FROM conversations GROUP BY conv_id""")
def thinking_control(spark, sf):
    c = conv(spark, sf).withColumn("mode", F.when(F.col("conv_id") % 2 == 0, F.lit("thinking"))
                                   .otherwise(F.lit("non_thinking")))
    t = cm.thinking_control(c, "messages", "mode")
    idx = cm.last_role_index("messages", "user")
    return t.select("conv_id", "mode", F.size("messages").cast("long").alias("n_turns"),
                    F.when(idx > 0, F.element_at("messages", idx)["content"]).alias("last_user"))


# ---------------------------------------------------------------- P9
def _derived_responses_spark(spark, sf):
    t = b.table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    x = F.col("text")
    r = (F.when(F.col("turn") % 4 == 0, F.concat(F.lit("<think>\n"), x, F.lit("\n</think>\n\n"), x))
         .when(F.col("turn") % 4 == 1, F.concat(F.lit("<think>\n\n</think>\n\n"), x))
         .when(F.col("turn") % 4 == 2, x)
         .otherwise(F.concat(F.lit("<think>"), x)))
    return t.select("conv_id", "turn", r.alias("response"))


RESP = f"""RESP AS (
  SELECT conv_id, turn, CASE turn % 4
    WHEN 0 THEN '<think>' || {NL} || text || {NL} || '</think>' || {NL} || {NL} || text
    WHEN 1 THEN '<think>' || {NL} || {NL} || '</think>' || {NL} || {NL} || text
    WHEN 2 THEN text
    ELSE '<think>' || text END AS response
  FROM conversations WHERE role = 'assistant')"""


@register("split_thinking", s.q(RESP, f"""F AS (
  SELECT conv_id, turn, response,
         regexp_matches(response, '(?s)<think>(.*?)</think>') AS closed,
         strpos(response, '<think>') > 0 AND NOT regexp_matches(response, '(?s)<think>(.*?)</think>') AS unclosed
  FROM RESP)""", f"""G AS (
  SELECT conv_id, turn, closed, unclosed,
         CASE WHEN closed THEN {_strip("regexp_extract(response, '(?s)<think>(.*?)</think>', 1)")}
              WHEN unclosed THEN {_strip("string_split(response, '<think>')[-1]")} ELSE '' END AS think_text,
         CASE WHEN unclosed THEN '' ELSE {_strip("regexp_replace(response, '(?s)<think>(.*?)</think>', '', 'g')")} END
           AS final_text
  FROM F)""", """
SELECT conv_id, turn,
       CASE WHEN (closed AND think_text <> '') OR unclosed THEN 'thinking' ELSE 'non_thinking' END AS mode,
       think_text, final_text
FROM G"""))
def split_thinking(spark, sf):
    return cm.split_thinking(_derived_responses_spark(spark, sf)).select(
        "conv_id", "turn", "mode", "think_text", "final_text")


# ---------------------------------------------------------------- P10
@register("validate_records", s.q(s.CRENDER, f"""T AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos,
         lag(role) OVER (PARTITION BY conv_id, role = 'system' ORDER BY turn) AS prev_ns
  FROM conversations)""", f"""PC AS (
  SELECT T.conv_id,
         bool_or(coalesce({_strip('T.text')}, '') = '') AS blank_content,
         bool_or(coalesce(role, '') NOT IN ('system', 'user', 'assistant')) AS bad_role,
         bool_or(role = 'system' AND pos > 1) AS system_not_first,
         bool_or(role <> 'system' AND prev_ns = role) AS role_order,
         arg_max(role, turn) <> 'assistant' AS no_assistant_end,
         any_value(len(regexp_extract_all(CRENDER.text, '{s.PAT}'))) > 2048 AS too_long
  FROM T JOIN CRENDER USING (conv_id) GROUP BY T.conv_id)""", """
SELECT rule, count(*) AS n_checked, count(*) FILTER (WHERE failed) AS n_failed FROM (
  SELECT 'blank_content' AS rule, blank_content AS failed FROM PC UNION ALL
  SELECT 'bad_role', bad_role FROM PC UNION ALL
  SELECT 'system_not_first', system_not_first FROM PC UNION ALL
  SELECT 'role_order', role_order FROM PC UNION ALL
  SELECT 'no_assistant_end', no_assistant_end FROM PC UNION ALL
  SELECT 'too_long', too_long FROM PC)
GROUP BY rule"""))
def validate_records(spark, sf):
    return rc.validate_records(conv(spark, sf), "messages", 2048)


# ---------------------------------------------------------------- P11
@register("profile_records", s.q(LA, f"""
SELECT conv_id, 'list' AS messages_type, 'string' AS content_type, count(*) AS n_turns,
       replace(left(any_value(LA.ans), 80), {NL}, '\\n')
         || CASE WHEN length(any_value(LA.ans)) > 80 THEN '...' ELSE '' END AS answer_preview
FROM conversations JOIN LA USING (conv_id) GROUP BY conv_id"""))
def profile_records(spark, sf):
    sp = cm.split_answer(conv(spark, sf))
    p = rc.profile_records(sp, F.to_variant_object("messages"), F.col("answer"))
    return p.select("conv_id", "messages_type", "content_type", "n_turns", "answer_preview")


# ---------------------------------------------------------------- P12
@register("clean_responses", f"""
SELECT conv_id, turn,
       left(split_part({_strip("regexp_replace(text, '" + cm.SPECIAL_RE + "', '', 'g')")}, {NL}, 1), 80) AS cleaned
FROM conversations WHERE role = 'assistant'""")
def clean_responses(spark, sf):
    t = b.table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    return t.select("conv_id", "turn", cm.clean_response("text", 80).alias("cleaned"))


# ---------------------------------------------------------------- P13
@register("select_tasks", """
SELECT task, min(conv_id) AS conv_id, arg_min(n_turns, conv_id) AS n_turns FROM (
  SELECT conv_id, arg_min(role, turn) AS task, count(*) AS n_turns FROM conversations GROUP BY conv_id)
WHERE task IN ('system', 'user') GROUP BY task""")
def select_tasks(spark, sf):
    c = conv(spark, sf).select("conv_id", F.element_at("messages", 1)["role"].alias("task"),
                               F.size("messages").cast("long").alias("n_turns"))
    return rc.select_tasks(c, "task", ["system", "user"], "conv_id")


# ---------------------------------------------------------------- P14
@register("material_prompts", f"""
SELECT p_partkey AS item, '{rc.MATERIAL_SYSTEM_PROMPT.replace(chr(10), "' || chr(10) || '")}' AS system,
       '{rc.MATERIAL_USER_PREFIX}' || {NL} || '视频标题: ' || p_name || {NL} || '视频描述: ' || lower(p_type)
         || {NL} || '视频标签: #' || p_brand || ' #' || lower(p_type) || {NL} || '视频长度: ' || p_size || '分钟' || {NL}
         AS prompt
FROM part""")
def material_prompts(spark, sf):
    part = b.table(spark, sf, "part").withColumn("desc", F.lower("p_type"))
    m = rc.material_prompts(part, "p_name", "desc", F.array(F.col("p_brand"), F.lower("p_type")),
                            F.concat(F.col("p_size").cast("string"), F.lit("分钟")))
    return m.select(F.col("p_partkey").alias("item"), "system", "prompt")


# ---------------------------------------------------------------- P15
@register("choice_options", """
SELECT p_partkey AS prompt_id, o.letter, o.text, CAST(4 AS BIGINT) AS n_options FROM (
  SELECT p_partkey, unnest([{'letter': 'A', 'text': p_type}, {'letter': 'B', 'text': p_brand},
                            {'letter': 'C', 'text': CAST(p_size AS VARCHAR)}, {'letter': 'J', 'text': p_name}]) AS o
  FROM part)""")
def choice_options(spark, sf):
    part = b.table(spark, sf, "part")
    q = F.concat(F.col("p_name"), F.lit("属于哪一类？A."), F.col("p_type"), F.lit(" B."), F.col("p_brand"),
                 F.lit(" C."), F.col("p_size").cast("string"), F.lit("\nJ."), F.col("p_name"), F.lit(" /no_think"))
    return rc.choice_options(part.select(F.col("p_partkey").alias("prompt_id"), q.alias("q")), "prompt_id", "q")


# ---------------------------------------------------------------- A1
CATEGORY_DIM = ["de", "en", "es", "fr", "zh"]  # expected languages; "zh" has no documents here


@register("category_counts", f"""
SELECT d.category, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM (VALUES {", ".join(f"('{c}')" for c in CATEGORY_DIM)}) d(category)
LEFT JOIN (SELECT lang AS category, count(*) AS n FROM documents GROUP BY lang) c USING (category)""")
def category_counts(spark, sf):
    dim = spark.createDataFrame([(c,) for c in CATEGORY_DIM], "category string")
    docs = b.table(spark, sf, "documents").select(F.col("lang").alias("category"))
    return rc.category_counts(docs, "category", F.broadcast(dim))


# ---------------------------------------------------------------- A2
@register("task_catalog", """
SELECT source AS task, count(DISTINCT lang) AS n_categories, count(*) AS n_samples FROM documents GROUP BY source""")
def task_catalog(spark, sf):
    d = b.table(spark, sf, "documents").select(F.col("lang").alias("category"), F.col("source").alias("task"))
    return rc.task_catalog(d, "category", "task")


# ---------------------------------------------------------------- W2
@register("context_length", f"""
SELECT conv_id, turn, role, CAST(tt AS BIGINT) AS turn_tokens,
       CAST(sum(tt) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS context_tokens
FROM (SELECT conv_id, turn, role,
             len(regexp_extract_all('<|im_start|>' || role || {NL} || text || '<|im_end|>' || {NL}, '{s.PAT}')) AS tt
      FROM conversations)""")
def context_length(spark, sf):
    return cm.context_length(b.table(spark, sf, "conversations")).select(
        "conv_id", "turn", "role", "turn_tokens", "context_tokens")


# ---------------------------------------------------------------- W3
def _with_clear(spark, sf):
    t = b.table(spark, sf, "conversations")
    return t.withColumn("text", F.when((F.col("turn") == 4) & (F.col("role") == "user"), F.lit("/clear"))
                        .otherwise(F.col("text")))


@register("context_segments", f"""
WITH T AS (
  SELECT conv_id, turn, role, CASE WHEN turn = 4 AND role = 'user' THEN '/clear' ELSE text END AS text
  FROM conversations),
S AS (
  SELECT *, CASE WHEN {_strip('text')} = '/clear' THEN 1 ELSE 0 END AS clr,
         sum(CASE WHEN {_strip('text')} = '/clear' THEN 1 ELSE 0 END)
           OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS segment,
         len(regexp_extract_all('<|im_start|>' || role || {NL} || text || '<|im_end|>' || {NL}, '{s.PAT}')) AS tt
  FROM T),
SYS AS (SELECT conv_id, arg_min(text, turn) AS sys FROM T WHERE role = 'system' GROUP BY conv_id),
SEG AS (SELECT conv_id, segment, count(*) AS n, sum(tt) AS tok FROM S WHERE clr = 0 AND role <> 'system'
        GROUP BY conv_id, segment)
SELECT conv_id, CAST(segment AS BIGINT) AS segment,
       CAST(n + CASE WHEN sys IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS n_turns,
       sys IS NOT NULL AS has_system,
       CAST(tok + coalesce(len(regexp_extract_all('<|im_start|>system' || {NL} || sys || '<|im_end|>' || {NL},
                                                  '{s.PAT}')), 0) AS BIGINT) AS context_tokens
FROM SEG LEFT JOIN SYS USING (conv_id)""")
def context_segments(spark, sf):
    return cm.context_segments(_with_clear(spark, sf))

