"""Curation queries over documents, benchmark and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomis.operators import chatml as cm
from loomis.operators import curate as cu
from loomis.operators import similarity as sm
from loomis.plans import bindings as b
from loomis.plans import sqlparts as s
from loomis.plans.registry import register
from loomis.schemas import SECTION_HEADINGS

SEED = 42
BALANCE_TARGET = 300
CATEGORIES = [c for c, _ in SECTION_HEADINGS]

# FIXED VALUES: system prompts of the four evaluation dimensions and the
# default assistant prompt (template 1 = dimension prompt, template 2 = default).
SYSTEM_TEMPLATES = [
    ("物料", 1, "你是一个精准的视频语义解析器，能够将抽象的视频token转化为通俗易懂的视频内容。"),
    ("物料", 2, "你是一个推荐系统助手。"),
    ("用户", 1, "你是一位用户行为分析专家，擅长洞察用户兴趣演化。"),
    ("用户", 2, "你是一个推荐系统助手。"),
    ("推荐", 1, "你是一位推荐系统专家，根据用户偏好推荐合适的内容。"),
    ("推荐", 2, "你是一个推荐系统助手。"),
    ("世界", 1, "你是一个知识问答助手。"),
    ("世界", 2, "你是一个推荐系统助手。"),
]
# Target language mixture of the corpus (our choice for the report).
MIXTURE_TARGETS = [("en", 0.4), ("fr", 0.2), ("de", 0.2), ("es", 0.2)]


def _docs(spark, sf):
    return b.table(spark, sf, "documents")


def _category_col():
    return F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (F.col("conv_id") % 4 + 1).cast("int"))


CAT_SQL = "['" + "','".join(CATEGORIES) + "'][conv_id % 4 + 1]"


# ---------------------------------------------------------------- D1
@register("dedup_samples", """
SELECT text_hash, min(doc_id) AS doc_id, count(*) AS n_copies
FROM (SELECT doc_id, sha256(text) AS text_hash FROM documents) GROUP BY text_hash""")
def dedup_samples(spark, sf):
    return cu.exact_duplicates(_docs(spark, sf), "doc_id", "text")


@register("near_duplicates", r"""
WITH RECURSIVE W AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
S AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM W WHERE len(w) > 0)),
N AS (SELECT doc_id, count(*) AS n FROM S GROUP BY doc_id),
L AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM S x JOIN S y ON x.g = y.g AND x.doc_id <> y.doc_id
                    GROUP BY ALL) JOIN N p ON p.doc_id = a JOIN N q ON q.doc_id = b
  WHERE 9 * c >= 4 * (p.n + q.n)),
R AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT b, root FROM R JOIN L ON a = doc_id),
C AS (SELECT doc_id, min(root) AS cluster_id FROM R GROUP BY doc_id)
SELECT doc_id, cluster_id, count(*) OVER (PARTITION BY cluster_id) AS n_members, doc_id <> cluster_id AS is_duplicate FROM C""")
def near_duplicates(spark, sf):
    """Clusters of near-duplicates: five words, similarity of 0.8 and more,
    exact (copies are members, not pairs)."""
    out = sm.near_groups(_docs(spark, sf), "doc_id", "text")
    return out.withColumn("is_duplicate", F.col("doc_id") != F.col("cluster_id"))


# ---------------------------------------------------------------- D2
@register("balance_categories", f"""
WITH C AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
R AS (SELECT lang, doc_id, unnest(range(1, greatest(1, CAST(ceil({BALANCE_TARGET} / n) AS BIGINT)) + 1)) AS copy
      FROM documents JOIN C USING (lang))
SELECT category, doc_id, copy FROM (
  SELECT lang AS category, doc_id, CAST(copy AS BIGINT) AS copy,
         row_number() OVER (PARTITION BY lang ORDER BY copy, md5(doc_id || ':{SEED}')) AS r FROM R)
WHERE r <= {BALANCE_TARGET}""")
def balance_categories(spark, sf):
    d = _docs(spark, sf).select(F.col("lang").alias("category"), "doc_id")
    return cu.balance_categories(d, "category", "doc_id", BALANCE_TARGET, SEED).select("category", "doc_id", "copy")


# ---------------------------------------------------------------- D3
SPLIT_SQL = f"""S AS (
  SELECT doc_id, text, CASE WHEN substr(md5(doc_id || ':{SEED}'), 1, 4) < '1999' THEN 'validation' ELSE 'train' END
    AS split FROM documents)"""


@register("train_val_split", s.q(SPLIT_SQL, "SELECT doc_id, split FROM S"))
def train_val_split(spark, sf):
    return cu.train_val_split(_docs(spark, sf).select("doc_id"), "doc_id", 0.1, SEED)


# ---------------------------------------------------------------- U4
@register("common_samples", s.q(SPLIT_SQL, """
SELECT doc_id, sha256(text) AS text_hash FROM S
WHERE split = 'validation' AND sha256(text) IN (SELECT sha256(text) FROM S WHERE split = 'train')"""))
def common_samples(spark, sf):
    sp = cu.train_val_split(_docs(spark, sf).select("doc_id", "text"), "doc_id", 0.1, SEED)
    val = sp.filter(F.col("split") == "validation")
    train = sp.filter(F.col("split") == "train")
    return cu.common_samples(val, train, "text").select("doc_id", "text_hash")


# ---------------------------------------------------------------- D4
TEMPLATE_VALUES = ", ".join(f"('{c}', {i}, '{t}')" for c, i, t in SYSTEM_TEMPLATES)


@register("paraphrase_system", f"""
WITH T(category, template_id, system) AS (VALUES {TEMPLATE_VALUES}),
C AS (SELECT conv_id, {CAT_SQL} AS category, count(*) FILTER (WHERE role <> 'system') AS n_ns
      FROM conversations GROUP BY conv_id)
SELECT conv_id, CAST(template_id AS BIGINT) AS template_id, system, n_ns + 1 AS n_turns
FROM C JOIN T USING (category)""")
def paraphrase_system(spark, sf):
    c = cm.assemble_conversations(b.table(spark, sf, "conversations")).withColumn("category", _category_col())
    t = spark.createDataFrame(SYSTEM_TEMPLATES, "category string, template_id long, system string")
    p = cu.paraphrase_system(c, t)
    return p.select("conv_id", "template_id", F.element_at("messages", 1)["content"].alias("system"),
                    F.size("messages").cast("long").alias("n_turns"))


# ---------------------------------------------------------------- D5
@register("thinking_pairs", f"""
WITH LA AS (
  SELECT conv_id, max(turn) FILTER (WHERE role = 'assistant') AS la,
         arg_max(text, turn) FILTER (WHERE role = 'assistant') AS ans FROM conversations GROUP BY conv_id),
U AS (
  SELECT c.conv_id, arg_max(c.text, c.turn) FILTER (WHERE c.role = 'user' AND c.turn < LA.la) AS lu
  FROM conversations c JOIN LA USING (conv_id) GROUP BY c.conv_id),
SM AS (SELECT conv_id, ans, lu, CASE WHEN conv_id % 3 = 0 THEN lu END AS trace
       FROM LA JOIN U USING (conv_id) WHERE la IS NOT NULL AND length(ans) > 0)
SELECT conv_id, 'non_thinking' AS mode, lu || ' /no_think' AS last_user,
       '<think>' || {s.NL} || {s.NL} || '</think>' || {s.NL} || {s.NL} || ans AS response FROM SM
UNION ALL
SELECT conv_id, 'thinking', lu || ' /think',
       '<think>' || {s.NL} || trace || {s.NL} || '</think>' || {s.NL} || {s.NL} || ans FROM SM WHERE trace IS NOT NULL""")
def thinking_pairs(spark, sf):
    sp = cm.split_answer(cm.assemble_conversations(b.table(spark, sf, "conversations")))
    samples = sp.filter(F.col("answer").isNotNull() & (F.length("answer") > 0))
    # supplied traces (every third sample): the whole question the answer resolves
    idx = cm.last_role_index("context", "user")
    traces = samples.filter(F.col("conv_id") % 3 == 0).select(
        "conv_id", F.when(idx > 0, F.element_at("context", idx)["content"]).alias("trace"))
    t = cu.thinking_pairs(samples, traces, "conv_id")
    idx = cm.last_role_index("context", "user")
    return t.select("conv_id", "mode", F.when(idx > 0, F.element_at("context", idx)["content"]).alias("last_user"),
                    "response")


# ---------------------------------------------------------------- U1
@register("mix_datasets", """
SELECT 'documents' AS source, doc_id AS id, CAST(1 AS BIGINT) AS copy FROM documents
UNION ALL
SELECT 'benchmark', item_id, CAST(unnest(range(1, 4)) AS BIGINT) FROM benchmark""")
def mix_datasets(spark, sf):
    docs = _docs(spark, sf).select(F.col("doc_id").alias("id"))
    bench = b.table(spark, sf, "benchmark").select(F.col("item_id").alias("id"))
    return cu.mix_datasets([("documents", docs, 1), ("benchmark", bench, 3)]).select("source", "id", "copy")


# ---------------------------------------------------------------- U3
def _versions(spark, sf):
    d = _docs(spark, sf).select("doc_id", "text")
    old = d.filter(F.col("doc_id") % 5 != 4)
    new = d.filter(F.col("doc_id") % 5 != 0).withColumn(
        "text", F.when(F.col("doc_id") % 10 == 3, F.concat("text", F.lit(" (rev)"))).otherwise(F.col("text")))
    return old, new


@register("diff_versions", """
WITH O AS (SELECT doc_id, text FROM documents WHERE doc_id % 5 <> 4),
N AS (SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN text || ' (rev)' ELSE text END AS text
      FROM documents WHERE doc_id % 5 <> 0)
SELECT coalesce(O.doc_id, N.doc_id) AS doc_id,
       CASE WHEN O.doc_id IS NULL THEN 'added' WHEN N.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM O FULL OUTER JOIN N ON O.doc_id = N.doc_id
WHERE O.doc_id IS NULL OR N.doc_id IS NULL OR O.text <> N.text""")
def diff_versions(spark, sf):
    old, new = _versions(spark, sf)
    return cu.diff_versions(old, new, "doc_id", ["text"])


# ---------------------------------------------------------------- A19
@register("mixture_report", f"""
WITH T(category, target_share) AS (VALUES {", ".join(f"('{c}', {v})" for c, v in MIXTURE_TARGETS)}),
C AS (SELECT lang AS category, count(*) AS n FROM documents GROUP BY lang),
J AS (SELECT coalesce(C.category, T.category) AS category, coalesce(n, 0) AS n, coalesce(target_share, 0.0) AS ts
      FROM C FULL OUTER JOIN T ON C.category = T.category)
SELECT category, CAST(n AS BIGINT) AS n, round(n / (SELECT count(*) FROM documents), 6) AS actual_share,
       round(ts, 6) AS target_share, round(n / (SELECT count(*) FROM documents) - ts, 6) AS gap FROM J""")
def mixture_report(spark, sf):
    d = _docs(spark, sf).select(F.col("lang").alias("category"))
    t = spark.createDataFrame(MIXTURE_TARGETS, "category string, target_share double")
    return cu.mixture_report(d, "category", t)


# ---------------------------------------------------------------- T1
@register("seeded_shuffle", f"""
SELECT doc_id, md5(doc_id || ':{SEED}') AS shuffle_key,
       row_number() OVER (ORDER BY md5(doc_id || ':{SEED}'), doc_id) - 1 AS position
FROM documents""")
def seeded_shuffle(spark, sf):
    return cu.seeded_shuffle(_docs(spark, sf).select("doc_id"), "doc_id", SEED).select("doc_id", "shuffle_key",
                                                                                       "position")
