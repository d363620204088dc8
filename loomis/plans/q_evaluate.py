"""Evaluation queries over the candidate / QA / judge bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomis.operators import evaluate as ev
from loomis.operators import metrics as mt
from loomis.operators import records as rc
from loomis.plans import bindings as b
from loomis.plans import sqlparts as s
from loomis.plans.registry import register
from loomis.schemas import LAYERS


def matched_candidates(spark, sf):
    """H → targets → CAND → W1 cap → J3 exact itemic-token match.

    Candidate rows carry their prompt's target item, so the ground truth is
    the catalogue keyed by that item: both token lookups are joins with the
    item catalogue and the history is derived only once."""
    cand = ev.cap_candidates(b.candidates(spark, sf))
    item = b.items(spark, sf).select("item", "token")
    truth = item.select(F.col("item").alias("target"), F.col("token").alias("expected"))
    with_tok = cand.join(item, F.col("response") == F.col("item"), "left") \
        .withColumnRenamed("token", "response_token").drop("item")
    return ev.match_candidates(with_tok, truth, key="target", response="response_token")


@register("pass_at_k", s.q(*s.CAND_BASE, """P AS (
  SELECT prompt_id, domain, min(CASE WHEN hit THEN rnk END) AS first_hit
  FROM (SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY attempt) AS rnk FROM MATCHED)
  GROUP BY prompt_id, domain)""", """
SELECT domain, CAST(k AS BIGINT) AS k, count(*) AS n_prompts,
       round(avg(CASE WHEN first_hit <= k THEN 1.0 ELSE 0.0 END), 6) AS pass_at_k
FROM P CROSS JOIN (VALUES (1), (8), (32), (64)) ks(k)
GROUP BY domain, k"""))
def pass_at_k(spark, sf):
    return ev.pass_at_k(matched_candidates(spark, sf))


@register("cap_candidates", s.q(*s.CAND_BASE[:5], """
SELECT prompt_id, attempt, mode, response FROM CAPPED"""))
def cap_candidates(spark, sf):
    cand = b.candidates(spark, sf)
    return ev.cap_candidates(cand).select("prompt_id", "attempt", "mode", "response")


@register("match_candidates", s.q(*s.CAND_BASE, """
SELECT prompt_id, attempt, mode, response_token, expected, hit FROM MATCHED"""))
def match_candidates(spark, sf):
    return matched_candidates(spark, sf).select("prompt_id", "attempt", "mode", "response_token",
                                                "expected", "hit")


@register("mode_comparison", s.q(*s.CAND_BASE, """P AS (
  SELECT prompt_id, domain,
         max(CASE WHEN hit AND mode = 'thinking' THEN 1 ELSE 0 END) AS a,
         max(CASE WHEN hit AND mode = 'non_thinking' THEN 1 ELSE 0 END) AS b,
         max(CASE WHEN hit THEN 1 ELSE 0 END) AS m
  FROM MATCHED GROUP BY prompt_id, domain)""", """
SELECT domain, count(*) AS n_prompts, round(avg(a), 6) AS pass_thinking,
       round(avg(b), 6) AS pass_non_thinking, round(avg(m), 6) AS pass_mixed,
       round(round(avg(m), 6) - greatest(round(avg(a), 6), round(avg(b), 6)), 6) AS mixing_gain
FROM P GROUP BY domain"""))
def mode_comparison(spark, sf):
    return ev.mode_comparison(matched_candidates(spark, sf))


_OPT = r"list_sort(list_distinct(regexp_extract_all(regexp_replace({t}, '[A-Za-z]*[I-Za-z][A-Za-z]*', ' ', 'g'), '[A-H]')))"
_GOLD = r"list_sort(list_distinct(regexp_extract_all({t}, '[A-Z]')))"


@register("accuracy_exact", s.q(s.QA, f"""
SELECT count(*) AS n_samples,
       CAST(sum(CASE WHEN array_to_string({_OPT.format(t='response')}, ',')
                      = array_to_string({_GOLD.format(t='gold')}, ',') THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       round(avg(CASE WHEN array_to_string({_OPT.format(t='response')}, ',')
                      = array_to_string({_GOLD.format(t='gold')}, ',') THEN 1 ELSE 0 END), 6) AS accuracy
FROM QA"""))
def accuracy_exact(spark, sf):
    q = b.qa(spark, sf)
    return ev.accuracy_exact(q, ev.extract_options("response"), ev.letters_array("gold"))


# Answers to the questions of choice_options, by key: options right, wrong,
# incomplete, behind words, and one that was not offered (K).
CHOICE_CASES = [("正确答案是 A", "A", "A"), ("正确答案是 A、J", "A", "AJ"), ("JSON says: I think it is J.", "J", "J"),
                ("答案: BC", "BC", "BC"), ("A、K", "A", "AK"), ("CJ", "CJ", "CJ"), ("no idea", "B", "")]


@register("choice_accuracy", f"""
SELECT gold, count(*) AS n_samples, CAST(sum(CASE WHEN picked = gold THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       round(avg(CASE WHEN picked = gold THEN 1 ELSE 0 END), 6) AS accuracy
FROM part JOIN (VALUES {", ".join(f"({i}, '{g}', '{p}')" for i, (_, g, p) in enumerate(CHOICE_CASES))}) c(i, gold, picked)
  ON p_partkey % {len(CHOICE_CASES)} = i
GROUP BY gold""")
def choice_accuracy(spark, sf):
    """Answers checked against the letters that each question offers."""
    part = b.table(spark, sf, "part")
    q = F.concat(F.col("p_name"), F.lit("？A."), F.col("p_type"), F.lit(" B."), F.col("p_brand"), F.lit(" C."),
                 F.col("p_size").cast("string"), F.lit("\nJ."), F.col("p_name"))
    case = F.element_at(F.array(*[F.struct(F.lit(t).alias("response"), F.lit(g).alias("gold")) for t, g, _ in CHOICE_CASES]),
                        (F.col("p_partkey") % len(CHOICE_CASES) + 1).cast("int"))
    answers = part.select(F.col("p_partkey").alias("prompt_id"), q.alias("q"), case.alias("c")).select("prompt_id", "q", "c.*")
    offered = rc.choice_options(answers, "prompt_id", "q").groupBy("prompt_id").agg(F.collect_set("letter").alias("offered"))
    d = answers.join(offered, "prompt_id", "left")
    return ev.accuracy_exact(d, ev.extract_options("response", F.col("offered")), ev.letters_array("gold"), ["gold"])


@register("f1_score", s.q(s.QA, f"""S AS (
  SELECT {_OPT.format(t='response')} AS p, {_GOLD.format(t='gold')} AS g FROM QA)""", """T AS (
  SELECT len(list_intersect(p, g)) AS tp, len(p) AS np, len(g) AS ng FROM S)""", """
SELECT count(*) AS n_samples,
       round(avg(CASE WHEN np + ng = 0 THEN 1.0 ELSE 2.0 * tp / (np + ng) END), 6) AS macro_f1,
       round(CASE WHEN sum(np) > 0 THEN sum(tp) / sum(np) ELSE 1.0 END, 6) AS micro_precision,
       round(CASE WHEN sum(ng) > 0 THEN sum(tp) / sum(ng) ELSE 1.0 END, 6) AS micro_recall,
       round(CASE WHEN sum(np) + sum(ng) > 0 THEN 2.0 * sum(tp) / (sum(np) + sum(ng)) ELSE 1.0 END, 6) AS micro_f1
FROM T"""))
def f1_score(spark, sf):
    q = b.qa(spark, sf)
    return ev.f1_score(q, ev.extract_options("response"), ev.letters_array("gold"))


@register("judge_scores", s.q("""V AS (
  SELECT d.lang, l.doc_id AS item, j.judge, CASE j.judge WHEN 'quality' THEN quality ELSE toxic END AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
  CROSS JOIN (VALUES ('quality'), ('toxic')) j(judge))""", """ST AS (
  SELECT lang, judge, count(*) AS n_items, round(avg(score), 6) AS mean_score,
         round(stddev_samp(score), 6) AS std_score FROM V GROUP BY lang, judge)""", """MO AS (
  SELECT lang, judge, score AS mode_score FROM (
    SELECT lang, judge, score, row_number() OVER (PARTITION BY lang, judge ORDER BY count(*) DESC, score) AS rn
    FROM V GROUP BY lang, judge, score) WHERE rn = 1)""", """AG AS (
  SELECT lang, round(avg(agree), 6) AS agreement FROM (
    SELECT lang, item, CASE WHEN min(score) = max(score) THEN 1 ELSE 0 END AS agree
    FROM V GROUP BY lang, item) GROUP BY lang)""", """
SELECT ST.lang, ST.judge, n_items, mean_score, std_score, mode_score, agreement
FROM ST JOIN MO USING (lang, judge) JOIN AG USING (lang)"""))
def judge_scores(spark, sf):
    labels = b.table(spark, sf, "labels")
    docs = b.table(spark, sf, "documents").select("doc_id", "lang")
    j = labels.join(docs, "doc_id")
    verdicts = j.select("lang", F.col("doc_id").alias("item"), F.inline(F.array(
        F.struct(F.lit("quality").alias("judge"), F.col("quality").alias("score")),
        F.struct(F.lit("toxic").alias("judge"), F.col("toxic").alias("score")))))
    return ev.judge_scores(verdicts, group=("lang",))


@register("layered_scoreboard", s.q(*s.CAND_BASE, """
SELECT domain, mode, CAST(grouping_id(domain, mode) AS BIGINT) AS gid, count(*) AS n_candidates,
       CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS n_hits,
       round(avg(CASE WHEN hit THEN 1 ELSE 0 END), 6) AS hit_rate
FROM MATCHED GROUP BY ROLLUP (domain, mode)"""))
def layered_scoreboard(spark, sf):
    return ev.layered_scoreboard(matched_candidates(spark, sf))


# Evaluation layers and dimensions; prompts are dealt to them by their number.
_LAYER_OF = [(layer, dimension) for layer, dimension, _ in LAYERS]


@register("layer_scoreboard", s.q(*s.CAND_BASE, f"""LM AS (
  SELECT m.*, l.layer, l.dimension FROM MATCHED m
  JOIN (VALUES {", ".join(f"({i}, '{a}', '{d}')" for i, (a, d) in enumerate(_LAYER_OF))}) l(i, layer, dimension)
    ON m.prompt_id % {len(_LAYER_OF)} = l.i)""", """
SELECT layer, dimension, domain, mode, CAST(grouping_id(layer, dimension, domain, mode) AS BIGINT) AS gid,
       count(*) AS n_candidates, count(DISTINCT prompt_id) AS n_prompts,
       CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS n_hits,
       round(avg(CASE WHEN hit THEN 1 ELSE 0 END), 6) AS hit_rate, min(CASE WHEN hit THEN attempt END) AS first_hit
FROM LM GROUP BY GROUPING SETS ((layer, dimension, domain, mode), (layer, dimension, domain), (layer, dimension), (layer), (mode), ())"""))
def layer_scoreboard(spark, sf):
    """Registered metrics by layer, dimension, domain and mode with subtotals."""
    pick = lambda k: F.element_at(F.array(*[F.lit(x[k]) for x in _LAYER_OF]),
                                  (F.col("prompt_id") % len(_LAYER_OF) + 1).cast("int"))
    m = matched_candidates(spark, sf).withColumn("layer", pick(0)).withColumn("dimension", pick(1))
    full = ("layer", "dimension", "domain", "mode")
    return mt.scoreboard(m, ["n_candidates", "n_prompts", "n_hits", "hit_rate", "first_hit"],
                         [full, full[:3], full[:2], full[:1], ("mode",), ()])


def _mode_domain_scores(spark, sf):
    m = matched_candidates(spark, sf)
    per = m.groupBy("prompt_id", "domain", "mode").agg(F.max(F.col("hit").cast("int")).alias("_h"))
    return per.groupBy(F.col("mode").alias("model"), "domain").agg(F.round(F.avg("_h"), 6).alias("score"))


@register("model_domain_pivot", s.q(*s.CAND_BASE, """SC AS (
  SELECT mode AS model, domain, round(avg(h), 6) AS score FROM (
    SELECT prompt_id, domain, mode, max(CASE WHEN hit THEN 1 ELSE 0 END) AS h
    FROM MATCHED GROUP BY prompt_id, domain, mode) GROUP BY mode, domain)""", """RK AS (
  SELECT *, rank() OVER (PARTITION BY domain ORDER BY score DESC) AS rk FROM SC)""", """
SELECT model,
       first(score) FILTER (WHERE domain = 'video') AS video,
       first(score) FILTER (WHERE domain = 'prod') AS prod,
       first(score) FILTER (WHERE domain = 'ad') AS ad,
       first(score) FILTER (WHERE domain = 'living') AS living,
       first(score) FILTER (WHERE domain = 'sid') AS sid,
       coalesce(string_agg(CASE WHEN rk = 1 THEN domain END, ',' ORDER BY CASE WHEN rk = 1 THEN domain END), '') AS best_in
FROM RK GROUP BY model"""))
def model_domain_pivot(spark, sf):
    return ev.model_domain_pivot(_mode_domain_scores(spark, sf))


@register("candidate_diversity", s.q(*s.CAND_BASE[:5], """
SELECT prompt_id, mode, count(*) AS n_candidates, count(DISTINCT response) AS n_distinct,
       count(*) - count(DISTINCT response) AS n_duplicates,
       round(count(DISTINCT response) / count(*), 6) AS distinct_share
FROM CAPPED GROUP BY prompt_id, mode"""))
def candidate_diversity(spark, sf):
    return ev.candidate_diversity(ev.cap_candidates(b.candidates(spark, sf)))


@register("json_format_rate", """
SELECT event_type, count(*) AS n,
       CAST(sum(CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT' THEN 1 ELSE 0 END) AS BIGINT) AS n_json,
       CAST(sum(CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT'
                      AND list_has_all(json_keys(props), ['k']) THEN 1 ELSE 0 END) AS BIGINT) AS n_complete,
       round(avg(CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT' THEN 1 ELSE 0 END), 6) AS json_rate,
       round(avg(CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT'
                      AND list_has_all(json_keys(props), ['k']) THEN 1 ELSE 0 END), 6) AS complete_rate
FROM events GROUP BY event_type""")
def json_format_rate(spark, sf):
    return ev.json_format_rate(b.table(spark, sf, "events"), "props", ["k"], group=("event_type",))


@register("compare_models", s.q(*s.CAND_BASE[:5], """
SELECT category, prompt_id, slot, base_response, tuned_response, tuned_response IS DISTINCT FROM base_response AS changed
FROM (
  SELECT domain AS category, prompt_id, CASE WHEN mode = 'thinking' THEN attempt ELSE attempt - 32 END AS slot,
         max(response) FILTER (WHERE mode = 'thinking') AS base_response,
         max(response) FILTER (WHERE mode = 'non_thinking') AS tuned_response,
         count(*) FILTER (WHERE mode = 'thinking') AS n_base
  FROM CAPPED GROUP BY ALL)
WHERE n_base > 0"""))
def compare_models(spark, sf):
    # Both models read the candidates: derived once, written, read twice.
    capped = ev.cap_candidates(b.candidates(spark, sf)).withColumnRenamed("domain", "category") \
        .select("category", "prompt_id", "attempt", "mode", "response").checkpoint()
    base = capped.filter(F.col("mode") == "thinking").withColumnRenamed("attempt", "slot")
    tuned = capped.filter(F.col("mode") == "non_thinking").withColumn("slot", F.col("attempt") - 32)
    return ev.compare_models(base, tuned, ["category", "prompt_id", "slot"])


@register("missing_generations", s.q(s.H, """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM H)"""))
def missing_generations(spark, sf):
    """Prompts (customers) without any result in the whole history."""
    cust = b.table(spark, sf, "customer").select("c_custkey", "c_name")
    h = b.history(spark, sf).select(F.col("user_id").alias("c_custkey"))
    return ev.missing_generations(cust, h, "c_custkey")


@register("covered_prompts", s.q(s.H, """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM H)"""))
def covered_prompts(spark, sf):
    """Prompts (customers) with a result anywhere in the whole history."""
    cust = b.table(spark, sf, "customer").select("c_custkey", "c_name")
    h = b.history(spark, sf).select(F.col("user_id").alias("c_custkey"))
    return ev.covered_prompts(cust, h, "c_custkey")


@register("merge_candidate_pools", s.q(*s.CAND_BASE[:5], """V AS (
  SELECT prompt_id, response, count(*) AS votes, min(attempt) AS first_attempt FROM (
    SELECT prompt_id, attempt, response FROM CAPPED WHERE mode = 'thinking'
    UNION ALL SELECT prompt_id, attempt, response FROM CAPPED WHERE mode = 'non_thinking')
  GROUP BY prompt_id, response)""", """
SELECT * FROM (
  SELECT prompt_id, response, votes, first_attempt,
         row_number() OVER (PARTITION BY prompt_id ORDER BY votes DESC, first_attempt, response) AS rank
  FROM V) WHERE rank <= 64"""))
def merge_candidate_pools(spark, sf):
    capped = ev.cap_candidates(b.candidates(spark, sf)).select("prompt_id", "attempt", "mode", "response").checkpoint()
    pools = [capped.filter(F.col("mode") == m).drop("mode") for m in ("thinking", "non_thinking")]
    return ev.merge_candidate_pools(pools)
