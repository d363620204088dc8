"""Evaluation operators: candidate capping and matching, Pass@k, exact-match
accuracy, F1, judge tables, layered scoreboards, pivots, diversity, JSON
format rate, model comparison and candidate-pool merging.

Every metric is a two-level aggregation: first per prompt (bounded groups of
at most a few dozen candidates, partially aggregated map-side), then per
reporting dimension.  No metric needs a global window or a driver collect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomis.schemas import CANDIDATES_PER_MODE, ITEMIC_DOMAINS


def _r(c: Column, n: int = 6) -> Column:
    return F.round(c, n)


# ---------------------------------------------------------------- W1
def cap_candidates(cand: DataFrame, per_mode: int = CANDIDATES_PER_MODE, key: str = "prompt_id",
                   mode: str = "mode", order: str = "attempt") -> DataFrame:
    """Keep the first ``per_mode`` candidates of every (prompt, mode).

    ``row_number() <= k`` lets Catalyst insert a map-side WindowGroupLimit, so
    each task forwards at most k rows per group to the shuffle."""
    w = Window.partitionBy(key, mode).orderBy(order)
    return cand.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= per_mode).drop("_rn")


# ---------------------------------------------------------------- J3
def match_candidates(cand: DataFrame, truth: DataFrame, key: str = "prompt_id",
                     response: str = "response", expected: str = "expected") -> DataFrame:
    """Left-join candidates to ground truth; ``hit`` is a null-safe exact match
    (a prompt without truth never hits)."""
    j = cand.join(truth.select(key, expected), key, "left")
    return j.withColumn("hit", F.coalesce(F.col(response).eqNullSafe(F.col(expected)) & F.col(expected).isNotNull(),
                                          F.lit(False)))


# ---------------------------------------------------------------- A7
def first_hit_rank(matched: DataFrame, key: str = "prompt_id", order: str = "attempt",
                   group: Sequence[str] = ("domain",)) -> DataFrame:
    """Per prompt: rank (1-based, by ``order``) of the first hit, null when none."""
    w = Window.partitionBy(key).orderBy(order)
    ranked = matched.withColumn("_rank", F.row_number().over(w))
    return ranked.groupBy(key, *group).agg(
        F.min(F.when(F.col("hit"), F.col("_rank"))).alias("first_hit"))


def pass_at_k(matched: DataFrame, ks: Sequence[int] = (1, 8, 32, 64), key: str = "prompt_id",
              order: str = "attempt", group: Sequence[str] = ("domain",)) -> DataFrame:
    """Share of prompts with at least one hit among their first k candidates."""
    per_prompt = first_hit_rank(matched, key, order, group)
    exploded = per_prompt.withColumn("k", F.explode(F.array(*[F.lit(int(k)).cast("long") for k in ks])))
    return exploded.groupBy(*group, "k").agg(
        F.count(F.lit(1)).alias("n_prompts"),
        _r(F.avg(F.when(F.col("first_hit") <= F.col("k"), 1.0).otherwise(0.0))).alias("pass_at_k"))


# ---------------------------------------------------------------- A13
def mode_comparison(matched: DataFrame, key: str = "prompt_id", group: Sequence[str] = ("domain",),
                    modes: tuple[str, str] = ("thinking", "non_thinking")) -> DataFrame:
    a, b = modes
    per = matched.groupBy(key, *group).agg(
        F.max(F.when(F.col("hit") & (F.col("mode") == a), 1).otherwise(0)).alias("_a"),
        F.max(F.when(F.col("hit") & (F.col("mode") == b), 1).otherwise(0)).alias("_b"),
        F.max(F.when(F.col("hit"), 1).otherwise(0)).alias("_m"))
    out = per.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_prompts"),
        _r(F.avg("_a")).alias(f"pass_{a}"), _r(F.avg("_b")).alias(f"pass_{b}"),
        _r(F.avg("_m")).alias("pass_mixed"))
    return out.withColumn("mixing_gain", _r(F.col("pass_mixed") - F.greatest(f"pass_{a}", f"pass_{b}")))


# ---------------------------------------------------------------- A8
# ASCII words that are no options: words with a small letter, and the pronoun.
OPTION_NOISE = r"[A-Za-z]*[a-z][A-Za-z]*|(?<![A-Za-z])I(?=['’]|\s+[a-z])"
_CAPITALS = r"(?<![A-Za-z])[A-Z]+(?![A-Za-z])"


def extract_options(text, offered: Column | None = None) -> Column:
    """Sorted distinct option letters A to Z in an answer such as "正确答案是 J"
    or "A、C".  A capital that stands alone always counts, offered or not (an
    option that was not offered makes an answer wrong).  A run of capitals is a
    list of options only if all its letters are offered (``offered``: array of
    letters; A to H where it is not given), so that "AB" counts and "JSON"
    contributes nothing."""
    t = F.col(text) if isinstance(text, str) else text
    runs = F.regexp_extract_all(F.regexp_replace(t, OPTION_NOISE, " "), F.lit(_CAPITALS), 0)
    given = F.coalesce(offered, F.array()) if offered is not None else F.array(*[F.lit(x) for x in "ABCDEFGH"])
    letters = lambda r: F.split(r, "")
    kept = F.filter(runs, lambda r: (F.length(r) == 1) | (F.size(F.array_except(letters(r), given)) == 0))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(kept, letters))))


def letters_array(text) -> Column:
    """Gold option string such as "AB" → sorted distinct letter array."""
    t = F.col(text) if isinstance(text, str) else text
    return F.array_sort(F.array_distinct(F.regexp_extract_all(t, F.lit("[A-Z]"), 0)))


def accuracy_exact(df: DataFrame, pred: Column, gold: Column, group: Sequence[str] = ()) -> DataFrame:
    """Exact set match: all options right or the sample scores 0."""
    scored = df.withColumn("_ok", (F.array_join(pred, ",") == F.array_join(gold, ",")).cast("int"))
    return scored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_samples"), F.sum("_ok").cast("long").alias("n_correct"),
        _r(F.avg("_ok")).alias("accuracy"))


# ---------------------------------------------------------------- A9
def f1_per_sample(df: DataFrame, pred: Column, gold: Column) -> DataFrame:
    tp = F.size(F.array_intersect(pred, gold))
    np_, ng = F.size(pred), F.size(gold)
    return df.select(
        "*", tp.alias("tp"), np_.alias("n_pred"), ng.alias("n_gold"),
        F.when((np_ + ng) == 0, 1.0).otherwise(2.0 * tp / (np_ + ng)).alias("f1"))


def f1_score(df: DataFrame, pred: Column, gold: Column, group: Sequence[str] = ()) -> DataFrame:
    """Macro (mean of per-sample F1; both sets empty → 1) and micro F1."""
    per = f1_per_sample(df, pred, gold)
    agg = per.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_samples"), _r(F.avg("f1")).alias("macro_f1"),
        F.sum("tp").alias("_tp"), F.sum("n_pred").alias("_np"), F.sum("n_gold").alias("_ng"))
    prec = F.when(F.col("_np") > 0, F.col("_tp") / F.col("_np")).otherwise(1.0)
    rec = F.when(F.col("_ng") > 0, F.col("_tp") / F.col("_ng")).otherwise(1.0)
    micro = F.when((F.col("_np") + F.col("_ng")) > 0,
                   2.0 * F.col("_tp") / (F.col("_np") + F.col("_ng"))).otherwise(1.0)
    return agg.select(*group, "n_samples", "macro_f1", _r(prec).alias("micro_precision"),
                      _r(rec).alias("micro_recall"), _r(micro).alias("micro_f1"))


# ---------------------------------------------------------------- A10
def judge_scores(verdicts: DataFrame, item: str = "item", judge: str = "judge", score: str = "score",
                 group: Sequence[str] = ()) -> DataFrame:
    """Per (group, judge): count, mean, sample stddev, modal verdict (ties →
    smallest), plus per-group agreement = share of items on which all judges
    gave the same verdict."""
    if not group:
        verdicts, group = verdicts.withColumn("_all", F.lit(1)), ("_all",)
        return judge_scores(verdicts, item, judge, score, group).drop("_all")
    stats = verdicts.groupBy(*group, judge).agg(
        F.count(F.lit(1)).alias("n_items"), _r(F.avg(score)).alias("mean_score"),
        _r(F.stddev_samp(score)).alias("std_score"))
    counts = verdicts.groupBy(*group, judge, score).agg(F.count(F.lit(1)).alias("_c"))
    mode = counts.groupBy(*group, judge).agg(
        F.max_by(F.col(score), F.struct(F.col("_c"), -F.col(score))).alias("mode_score"))
    per_item = verdicts.groupBy(*group, item).agg(
        (F.min(score) == F.max(score)).cast("int").alias("_agree"))
    agree = per_item.groupBy(*group).agg(_r(F.avg("_agree")).alias("agreement"))
    return stats.join(mode, [*group, judge]).join(agree, list(group))


# ---------------------------------------------------------------- A11
def layered_scoreboard(matched: DataFrame, dims: Sequence[str] = ("domain", "mode")) -> DataFrame:
    """Hit counts with subtotals: ``rollup`` over the dimensions, ``gid`` is
    the grouping id (0 = leaf, all bits set = grand total)."""
    return matched.rollup(*dims).agg(
        F.grouping_id().cast("long").alias("gid"), F.count(F.lit(1)).alias("n_candidates"),
        F.sum(F.col("hit").cast("int")).cast("long").alias("n_hits"),
        _r(F.avg(F.col("hit").cast("int"))).alias("hit_rate"))


# ---------------------------------------------------------------- A12
def model_domain_pivot(scores: DataFrame, model: str = "model", domain: str = "domain",
                       score: str = "score", domains: Sequence[str] = ITEMIC_DOMAINS) -> DataFrame:
    """Models × domains matrix with explicit pivot values; ``best_in`` lists the
    domains in which the model ranks first (rank computed before the pivot)."""
    ranked = scores.withColumn("_rk", F.rank().over(Window.partitionBy(domain).orderBy(F.desc(score))))
    piv = ranked.groupBy(model).pivot(domain, list(domains)).agg(F.first(score).alias("s"), F.first("_rk").alias("r"))
    best = F.concat_ws(",", *[F.when(F.col(f"{d}_r") == 1, F.lit(d)) for d in sorted(domains)])
    return piv.select(model, *[F.col(f"{d}_s").alias(d) for d in domains], best.alias("best_in"))


# ---------------------------------------------------------------- A15
def candidate_diversity(cand: DataFrame, key: str = "prompt_id", strategy: str = "mode",
                        response: str = "response") -> DataFrame:
    return cand.groupBy(key, strategy).agg(
        F.count(F.lit(1)).alias("n_candidates"), F.count_distinct(response).alias("n_distinct")) \
        .withColumn("n_duplicates", F.col("n_candidates") - F.col("n_distinct")) \
        .withColumn("distinct_share", _r(F.col("n_distinct") / F.col("n_candidates")))


# ---------------------------------------------------------------- A20
def json_format_rate(df: DataFrame, text: str, required: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Share of responses that are a JSON object, and that hold every required key."""
    keys = F.json_object_keys(F.col(text))
    is_obj = keys.isNotNull()
    complete = is_obj & (F.size(F.array_except(F.array(*[F.lit(k) for k in required]), keys)) == 0)
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(is_obj.cast("int")).cast("long").alias("n_json"),
        F.sum(F.coalesce(complete, F.lit(False)).cast("int")).cast("long").alias("n_complete"),
        _r(F.avg(is_obj.cast("int"))).alias("json_rate"),
        _r(F.avg(F.coalesce(complete, F.lit(False)).cast("int"))).alias("complete_rate"))


# ---------------------------------------------------------------- J1
def compare_models(base: DataFrame, tuned: DataFrame, keys: Sequence[str],
                   response: str = "response") -> DataFrame:
    """Base results left-joined to tuned results on the keys; ``changed`` is
    true when the tuned answer differs or is missing."""
    b = base.select(*keys, F.col(response).alias("base_response"))
    t = tuned.select(*keys, F.col(response).alias("tuned_response"))
    return b.join(t, list(keys), "left").withColumn(
        "changed", ~F.col("base_response").eqNullSafe(F.col("tuned_response")))


# ---------------------------------------------------------------- J4
def missing_generations(prompts: DataFrame, results: DataFrame, key: str) -> DataFrame:
    return prompts.join(results.select(key).distinct(), key, "left_anti")


def covered_prompts(prompts: DataFrame, results: DataFrame, key: str) -> DataFrame:
    return prompts.join(results.select(key), key, "left_semi")


# ---------------------------------------------------------------- U2
def merge_candidate_pools(pools: Sequence[DataFrame], key: str = "prompt_id", response: str = "response",
                          order: str = "attempt", cap: int = 64) -> DataFrame:
    """Union pools, dedupe responses, rank by votes then first attempt, keep ``cap``."""
    union = pools[0]
    for p in pools[1:]:
        union = union.unionByName(p)
    voted = union.groupBy(key, response).agg(F.count(F.lit(1)).alias("votes"),
                                             F.min(order).alias("first_attempt"))
    w = Window.partitionBy(key).orderBy(F.desc("votes"), "first_attempt", response)
    return voted.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= cap)
