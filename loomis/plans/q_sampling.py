"""Score-table and decoding queries over LOGIT (lineitem scores) and the
conversation prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomis.operators import chatml as cm
from loomis.operators import sampling as sa
from loomis.plans import bindings as b
from loomis.plans import sqlparts as s
from loomis.plans.q_records import CTX, IDS, LA
from loomis.plans.registry import register

T = 0.7
TOP_K = 5
TOP_P = 0.95
DRAWS = 4
SEED = 42
PENALTY = 1.3

PROBS_T1 = """PR AS (
  SELECT prompt_id, token, logit, exp(z) / sum(exp(z)) OVER (PARTITION BY prompt_id) AS prob FROM (
    SELECT prompt_id, token, logit, logit - max(logit) OVER (PARTITION BY prompt_id) AS z FROM LOGIT))"""
RANKED = """RK AS (
  SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY logit DESC, token) AS rank FROM PR)"""


def _logits(spark, sf):
    return b.logits(spark, sf)


# ---------------------------------------------------------------- G1
@register("apply_temperature", s.q(s.LOGIT, f"""
SELECT prompt_id, token, round(exp(z) / sum(exp(z)) OVER (PARTITION BY prompt_id), 6) AS prob FROM (
  SELECT prompt_id, token, logit / {T} - max(logit / {T}) OVER (PARTITION BY prompt_id) AS z FROM LOGIT)"""))
def apply_temperature(spark, sf):
    p = sa.apply_temperature(_logits(spark, sf), T)
    return p.select("prompt_id", "token", F.round("prob", 6).alias("prob"))


# ---------------------------------------------------------------- G2
@register("filter_top_k", s.q(s.LOGIT, PROBS_T1, RANKED, f"""
SELECT prompt_id, token, rank, round(prob / sum(prob) OVER (PARTITION BY prompt_id), 6) AS prob
FROM RK WHERE rank <= {TOP_K}"""))
def filter_top_k(spark, sf):
    p = sa.filter_top_k(sa.apply_temperature(_logits(spark, sf), 1.0), TOP_K)
    return p.select("prompt_id", "token", "rank", F.round("prob", 6).alias("prob"))


# ---------------------------------------------------------------- G3
@register("filter_top_p", s.q(s.LOGIT, PROBS_T1, RANKED, f"""C AS (
  SELECT *, sum(prob) OVER (PARTITION BY prompt_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS cum FROM RK)""", f"""
SELECT prompt_id, token, rank, round(prob / sum(prob) OVER (PARTITION BY prompt_id), 6) AS prob
FROM C WHERE cum - prob < {TOP_P}"""))
def filter_top_p(spark, sf):
    p = sa.filter_top_p(sa.apply_temperature(_logits(spark, sf), 1.0), TOP_P)
    return p.select("prompt_id", "token", "rank", F.round("prob", 6).alias("prob"))


# ---------------------------------------------------------------- G4
@register("greedy_tokens", s.q(s.LOGIT, """
SELECT prompt_id, token FROM (
  SELECT prompt_id, token, row_number() OVER (PARTITION BY prompt_id ORDER BY logit DESC, token) AS r FROM LOGIT)
WHERE r = 1"""))
def greedy_tokens(spark, sf):
    return sa.greedy_tokens(_logits(spark, sf))


@register("sample_tokens", s.q(s.LOGIT, f"""D AS (
  SELECT prompt_id, token, logit, CAST(draw AS BIGINT) AS draw FROM LOGIT, range(1, {DRAWS + 1}) r(draw))""", f"""U AS (
  SELECT *, (CAST(('0x' || substr(md5(prompt_id || ':' || token || ':' || draw || ':' || '{SEED}'), 1, 13)) AS BIGINT)
             + 0.5) / 4503599627370496.0 AS u FROM D)""", """
SELECT prompt_id, draw, token FROM (
  SELECT prompt_id, draw, token,
         row_number() OVER (PARTITION BY prompt_id, draw ORDER BY logit - ln(-ln(u)) DESC, token) AS r FROM U)
WHERE r = 1"""))
def sample_tokens(spark, sf):
    return sa.sample_tokens(_logits(spark, sf), DRAWS, 1.0, SEED).select("prompt_id", "draw", "token")


# ---------------------------------------------------------------- G5
@register("repetition_penalty", s.q(s.LOGIT, f"""P AS (
  SELECT prompt_id, token FROM (
    SELECT prompt_id, token, row_number() OVER (PARTITION BY prompt_id ORDER BY logit DESC, token) AS r FROM LOGIT)
  WHERE r <= 2)""", f"""
SELECT l.prompt_id, l.token,
       round(CASE WHEN p.token IS NULL THEN logit WHEN logit > 0 THEN logit / {PENALTY} ELSE logit * {PENALTY} END, 6)
         AS logit
FROM LOGIT l LEFT JOIN P p ON l.prompt_id = p.prompt_id AND l.token = p.token"""))
def repetition_penalty(spark, sf):
    lg = _logits(spark, sf)
    produced = sa.filter_top_k(sa.apply_temperature(lg, 1.0), 2).select("prompt_id", "token")
    r = sa.repetition_penalty(lg, produced, PENALTY)
    return r.select("prompt_id", "token", F.round("logit", 6).alias("logit"))


# ---------------------------------------------------------------- T2
@register("next_token_topk", s.q(s.LOGIT, PROBS_T1, RANKED, f"""
SELECT prompt_id, token, rank, round(prob, 6) AS prob FROM RK WHERE rank <= {TOP_K}"""))
def next_token_topk(spark, sf):
    p = sa.next_token_topk(_logits(spark, sf), TOP_K, 1.0)
    return p.select("prompt_id", "token", "rank", F.round("prob", 6).alias("prob"))


# ---------------------------------------------------------------- J5
_STRAT_VALUES = ", ".join(
    f"('{n}', {str(ds).lower()}, {t if t is not None else 'NULL'}, {tp if tp is not None else 'NULL'})"
    for n, ds, t, tp in sa.DECODING_STRATEGIES)


@register("strategy_grid", f"""
SELECT conv_id, strategy, do_sample, CAST(temperature AS DOUBLE) AS temperature, CAST(top_p AS DOUBLE) AS top_p
FROM (SELECT DISTINCT conv_id FROM conversations)
CROSS JOIN (VALUES {_STRAT_VALUES}) st(strategy, do_sample, temperature, top_p)""")
def strategy_grid(spark, sf):
    ids = b.table(spark, sf, "conversations").select("conv_id").distinct()
    return sa.strategy_grid(ids)


# ---------------------------------------------------------------- G6
@register("batch_generate", s.q(LA, CTX, IDS, f"""P AS (
  SELECT i.conv_id, LA.ans,
         coalesce((SELECT string_agg('<|im_start|>' || role || {s.NL} || text || '<|im_end|>' || {s.NL}, '' ORDER BY turn)
                   FROM CTX WHERE CTX.conv_id = i.conv_id), '') || '<|im_start|>assistant' || {s.NL} AS prompt
  FROM IDS i JOIN LA USING (conv_id))""", f"""G AS (
  SELECT conv_id, strategy, ans, CAST(length(prompt) AS BIGINT) AS n
  FROM P CROSS JOIN (VALUES {_STRAT_VALUES}) st(strategy, do_sample, temperature, top_p))""", """N AS (
  SELECT *, CAST((row_number() OVER (ORDER BY n, conv_id, strategy) - 1) // 4 AS BIGINT) AS micro_batch FROM G)""", """
SELECT conv_id AS prompt_id, strategy, ans AS response, micro_batch, n AS n_prompt_chars,
       max(n) OVER (PARTITION BY micro_batch) - n AS n_pad_chars FROM N"""))
def batch_generate(spark, sf):
    """Prompts (P6) × strategies (J5), the recorded last assistant turns as the
    model's answers, whole."""
    conv = cm.split_answer(cm.assemble_conversations(b.table(spark, sf, "conversations")))
    prompts = cm.render_prompts(conv, "context").select(F.col("conv_id").alias("prompt_id"), "prompt", "answer")
    grid = sa.strategy_grid(prompts).select("prompt_id", "prompt", "strategy", F.col("answer").alias("recorded"))
    return sa.batch_generate(grid, sa.recorded_generator, batch_size=4, carry=["recorded"])
