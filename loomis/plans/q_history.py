"""History and itemic-token queries over the behaviour history H (orders ⨝
lineitem), the embeddings table, the item catalogue (part) and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomis.operators import history as hi
from loomis.operators import itemic as it
from loomis.plans import bindings as b
from loomis.plans import sqlparts as s
from loomis.plans.registry import register

N_HISTORY = 16
SEED = 42


# ---------------------------------------------------------------- W4
@register("truncate_history", s.q(s.H, f"""
SELECT user_id, seq, item FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS r FROM H) WHERE r <= {N_HISTORY}"""))
def truncate_history(spark, sf):
    return hi.truncate_history(b.history(spark, sf), N_HISTORY).select("user_id", "seq", "item")


# ---------------------------------------------------------------- W5
@register("perturb_history", s.q(s.H, f"""
SELECT user_id, seq, item,
       row_number() OVER (PARTITION BY user_id ORDER BY md5(user_id || ':' || seq || ':' || '{SEED}')) AS new_pos
FROM H"""))
def perturb_history(spark, sf):
    return hi.perturb_history(b.history(spark, sf), SEED, tasks=b.history_tasks(spark, sf)).select("user_id", "seq", "item", "new_pos")


# ---------------------------------------------------------------- W6
@register("next_item_split", s.q(s.H, """
SELECT user_id, seq, item, lead(item) OVER (PARTITION BY user_id ORDER BY seq) AS next_item,
       CASE WHEN lead(item) OVER (PARTITION BY user_id ORDER BY seq) IS NULL THEN 'target' ELSE 'input' END AS role
FROM H"""))
def next_item_split(spark, sf):
    return hi.next_item_split(b.history(spark, sf)).select("user_id", "seq", "item", "next_item", "role")


# ---------------------------------------------------------------- W7
ISLANDS = """E AS (
  SELECT user_id, event_type AS topic, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq
  FROM events)""", """C AS (
  SELECT *, CASE WHEN lag(topic) OVER (PARTITION BY user_id ORDER BY seq) IS NOT DISTINCT FROM topic
                 THEN 0 ELSE 1 END AS chg FROM E)""", """I AS (
  SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS island FROM C)""", """ISL AS (
  SELECT user_id, CAST(island AS BIGINT) AS island, any_value(topic) AS topic, min(seq) AS start_seq,
         count(*) AS n_events FROM I GROUP BY user_id, island)"""


def _islands(spark, sf):
    ev = b.table(spark, sf, "events").withColumnRenamed("event_type", "topic")
    return hi.interest_islands(ev, "user_id", "topic", ["ts", "event_id"], F.to_date("ts"))


@register("interest_evolution", s.q(*ISLANDS, "SELECT * FROM ISL"))
def interest_evolution(spark, sf):
    return _islands(spark, sf).select("user_id", "island", "topic", "start_seq", "n_events")


@register("interest_transitions", s.q(*ISLANDS, """
SELECT a.topic AS from_topic, n.topic AS to_topic, count(*) AS n
FROM ISL a JOIN ISL n ON a.user_id = n.user_id AND n.island = a.island + 1 GROUP BY 1, 2"""))
def interest_transitions(spark, sf):
    ev = b.table(spark, sf, "events").withColumnRenamed("event_type", "topic")
    return hi.interest_transitions(ev, "user_id", "topic", ["ts", "event_id"], F.to_date("ts"))


# ---------------------------------------------------------------- J2
def _emb_count(spark, sf):
    return b.table(spark, sf, "embeddings").select(F.count(F.lit(1))).scalar()


@register("embedding_lookup", s.q(s.H, """
SELECT H.user_id, H.seq, e.vec_id, e.label,
       round(sqrt(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm
FROM H JOIN embeddings e ON e.vec_id = H.item % (SELECT count(*) FROM embeddings)"""))
def embedding_lookup(spark, sf):
    j = hi.embedding_lookup(b.history(spark, sf), b.table(spark, sf, "embeddings"), modulo=_emb_count(spark, sf))
    return j.select("user_id", "seq", "vec_id", "label", F.round(hi.vector_norm("vec"), 6).alias("norm"))


# ---------------------------------------------------------------- X8
@register("itemic_history_prompts", s.q(s.H, s.TARGET, s.ITEM, f"""HP AS (
  SELECT user_id, count(*) AS n_items, count(*) FILTER (WHERE token IS NULL) AS n_unresolved,
         coalesce(string_agg(token, '' ORDER BY seq), '') AS prompt FROM (
    SELECT H.user_id, H.seq, ITEM.token,
           row_number() OVER (PARTITION BY H.user_id ORDER BY H.seq DESC) AS r
    FROM H JOIN TARGET USING (user_id) LEFT JOIN ITEM ON H.item = ITEM.item
    WHERE H.seq < TARGET.n_events)
  WHERE r <= {N_HISTORY} GROUP BY user_id)""", """
SELECT HP.user_id, HP.n_items, HP.n_unresolved, HP.prompt, ITEM.token AS target_token
FROM HP JOIN TARGET USING (user_id) LEFT JOIN ITEM ON TARGET.target = ITEM.item"""))
def itemic_history_prompts(spark, sf):
    """Newest events of every user against the whole catalogue."""
    return it.itemic_history_prompts(b.history(spark, sf), b.items(spark, sf), N_HISTORY).select(
        "user_id", "n_items", "n_unresolved", "prompt", "target_token")


# ---------------------------------------------------------------- X6
@register("itemic_occurrences", s.q(s.H, s.ITEM, f"""DAYS AS (
  SELECT user_id, CAST(ts AS DATE) AS day, string_agg(token, '' ORDER BY seq) AS prompt
  FROM H JOIN ITEM USING (item) GROUP BY user_id, CAST(ts AS DATE))""", f"""
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, CAST(pos AS BIGINT) AS pos,
       regexp_extract(t, '{it.ITEMIC_RE}', 1) AS domain,
       CAST(regexp_extract(t, '{it.ITEMIC_RE}', 2) AS BIGINT) AS a,
       CAST(regexp_extract(t, '{it.ITEMIC_RE}', 3) AS BIGINT) AS b,
       CAST(regexp_extract(t, '{it.ITEMIC_RE}', 4) AS BIGINT) AS c
FROM (SELECT user_id, day, unnest(toks) AS t, generate_subscripts(toks, 1) AS pos
      FROM (SELECT user_id, day, regexp_extract_all(prompt, '{it.ITEMIC_RE}') AS toks FROM DAYS))"""))
def itemic_occurrences(spark, sf):
    """Every event of the whole history, one text per user and day."""
    h = b.history(spark, sf).join(b.items(spark, sf).select("item", "token"), "item")
    parts = F.array_sort(F.collect_list(F.struct("seq", "token")))
    days = h.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.array_join(F.transform(parts, lambda x: x["token"]), "").alias("prompt"))
    occ = it.itemic_occurrences(days.withColumn("_k", F.struct("user_id", "day")), "_k", "prompt")
    return occ.select("_k.user_id", "_k.day", *[c for c in occ.columns if c != "_k"])


# ---------------------------------------------------------------- X7 / J8 corpus
# Catalogue text with deterministic defects: every 13th item an unknown domain,
# every 7th an out-of-range level-a code, every 11th a missing level c.
CORRUPT = (s.ITEM, """CORPUS AS (
  SELECT ITEM.item, p_brand AS source,
         p_name || ' ' || CASE WHEN ITEM.item % 13 = 0 THEN '<|music_begin|>' ELSE '<|' || domain || '_begin|>' END
           || '<s_a_' || CASE WHEN ITEM.item % 7 = 0 THEN a + 8192 ELSE a END || '><s_b_' || b || '>'
           || CASE WHEN ITEM.item % 11 = 0 THEN '' ELSE '<s_c_' || c || '>' END AS text
  FROM ITEM JOIN part ON ITEM.item = part.p_partkey)""")


def _corpus(spark, sf):
    items = b.items(spark, sf)
    part = b.table(spark, sf, "part").select(F.col("p_partkey").alias("item"), "p_brand", "p_name")
    j = items.join(part, "item")
    dom = F.when(F.col("item") % 13 == 0, F.lit("<|music_begin|>")) \
           .otherwise(F.concat(F.lit("<|"), F.col("domain"), F.lit("_begin|>")))
    a = F.when(F.col("item") % 7 == 0, F.col("a") + 8192).otherwise(F.col("a"))
    cpart = F.when(F.col("item") % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("<s_c_"), F.col("c").cast("string"), F.lit(">")))
    text = F.concat(F.col("p_name"), F.lit(" "), dom, F.lit("<s_a_"), a.cast("string"), F.lit("><s_b_"),
                    F.col("b").cast("string"), F.lit(">"), cpart)
    return j.select("item", F.col("p_brand").alias("source"), text.alias("text")), items


@register("itemic_validate", s.q(*CORRUPT, f"""
SELECT source, count(*) AS n_tokens,
       count(*) FILTER (WHERE array_to_string(regexp_extract_all(subs, '{it.SUB_RE}', 1), ',') <> 'a,b,c') AS n_malformed,
       count(*) FILTER (WHERE len(list_filter(regexp_extract_all(subs, '{it.SUB_RE}', 2),
                                              lambda x: CAST(x AS BIGINT) >= 8192 OR CAST(x AS BIGINT) < 0)) > 0)
         AS n_out_of_range,
       count(*) FILTER (WHERE dom NOT IN ('video', 'prod', 'ad', 'living', 'sid')) AS n_unknown_domain
FROM (SELECT source, unnest(regexp_extract_all(text, '{it.LOOSE_RE}', 1)) AS dom,
             unnest(regexp_extract_all(text, '{it.LOOSE_RE}', 2)) AS subs FROM CORPUS)
GROUP BY source"""))
def itemic_validate(spark, sf):
    corpus, _ = _corpus(spark, sf)
    return it.itemic_validate(corpus, "text", ["source"])


@register("itemic_catalog_join", s.q(*CORRUPT, f"""O AS (
  SELECT regexp_extract(t, '{it.ITEMIC_RE}', 1) AS domain,
         CAST(regexp_extract(t, '{it.ITEMIC_RE}', 2) AS BIGINT) AS a,
         CAST(regexp_extract(t, '{it.ITEMIC_RE}', 3) AS BIGINT) AS b,
         CAST(regexp_extract(t, '{it.ITEMIC_RE}', 4) AS BIGINT) AS c
  FROM (SELECT unnest(regexp_extract_all(text, '{it.ITEMIC_RE}')) AS t FROM CORPUS))""", """
SELECT O.domain, count(*) AS n_occurrences, count(ITEM.item) AS n_resolved,
       round(1 - count(ITEM.item) / count(*), 6) AS unresolved_rate
FROM O LEFT JOIN ITEM ON O.domain = ITEM.domain AND O.a = ITEM.a AND O.b = ITEM.b AND O.c = ITEM.c
GROUP BY O.domain"""))
def itemic_catalog_join(spark, sf):
    corpus, items = _corpus(spark, sf)
    occ = it.itemic_occurrences(corpus, "item", "text")
    return it.unresolved_rate(it.resolve_occurrences(occ.drop("item"), items))


@register("itemic_catalog_reverse", s.q(s.ITEM, """
SELECT description, count(*) AS n_items, arg_min(token, item) AS token FROM ITEM GROUP BY description"""))
def itemic_catalog_reverse(spark, sf):
    return it.description_to_token(b.items(spark, sf))


# ---------------------------------------------------------------- A14
@register("codebook_coverage", s.q(s.ITEM, """
SELECT domain, level, count(DISTINCT CASE WHEN code >= 0 AND code < 8192 THEN code END) AS n_distinct,
       count(*) FILTER (WHERE code < 0 OR code >= 8192) AS n_out_of_range,
       round(count(DISTINCT CASE WHEN code >= 0 AND code < 8192 THEN code END) / 8192, 6) AS coverage
FROM (SELECT domain, 'a' AS level, a AS code FROM ITEM UNION ALL SELECT domain, 'b', b FROM ITEM
      UNION ALL SELECT domain, 'c', c FROM ITEM)
GROUP BY domain, level"""))
def codebook_coverage(spark, sf):
    return it.codebook_coverage(b.items(spark, sf))


@register("codebook_coverage_approx")
def codebook_coverage_approx(spark, sf):
    """HyperLogLog form (no SQL oracle: sketches differ between engines);
    tests compare it to the exact counts within the sketch error."""
    return it.codebook_coverage(b.items(spark, sf), approx=True)
