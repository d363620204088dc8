"""Score tables and decoding: temperature softmax, top-k / top-p filters,
greedy and seeded sampling, repetition penalty, next-token top-k, the
decoding-strategy grid and batch generation through a caller-supplied
generator.

Score tables are long ``(prompt_id, token, logit)``; every per-prompt step is
a window partitioned by prompt (a prompt holds at most its vocabulary) or an
aggregate.  Sampling draws use ``md5`` uniforms, so results do not depend on
partitioning or retries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomis.plans.sequence import dense_index
from loomis.schemas import DECODING_STRATEGIES, ITEMIC_DOMAINS


def _w(key: str) -> Window:
    return Window.partitionBy(key)


# ---------------------------------------------------------------- G1
def apply_temperature(logits: DataFrame, temperature: float = 1.0, key: str = "prompt_id",
                      logit: str = "logit", out: str = "prob") -> DataFrame:
    """softmax(logit / T) per prompt, overflow-safe (max subtracted first)."""
    z = F.col(logit) / F.lit(float(temperature))
    d = logits.withColumn("_z", z - F.max(z).over(_w(key)))
    return d.withColumn(out, F.exp("_z") / F.sum(F.exp("_z")).over(_w(key))).drop("_z")


def _ranked(probs: DataFrame, key: str, logit: str, token: str) -> DataFrame:
    return probs.withColumn("rank", F.row_number().over(
        Window.partitionBy(key).orderBy(F.desc(logit), F.asc(token))).cast("long"))


# ---------------------------------------------------------------- G2
def filter_top_k(probs: DataFrame, k: int, key: str = "prompt_id", logit: str = "logit", token: str = "token",
                 prob: str = "prob") -> DataFrame:
    """The k most probable tokens per prompt (ties by token), renormalized."""
    r = _ranked(probs, key, logit, token).filter(F.col("rank") <= k)
    return r.withColumn(prob, F.col(prob) / F.sum(prob).over(_w(key)))


# ---------------------------------------------------------------- G3
def filter_top_p(probs: DataFrame, p: float, key: str = "prompt_id", logit: str = "logit", token: str = "token",
                 prob: str = "prob") -> DataFrame:
    """Nucleus: the smallest most-probable prefix whose cumulative probability
    reaches ``p`` (always at least one token), renormalized."""
    r = _ranked(probs, key, logit, token)
    cum = F.sum(prob).over(Window.partitionBy(key).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    kept = r.withColumn("_cum", cum).filter(F.col("_cum") - F.col(prob) < F.lit(p)).drop("_cum")
    return kept.withColumn(prob, F.col(prob) / F.sum(prob).over(_w(key)))


# ---------------------------------------------------------------- G4
def greedy_tokens(logits: DataFrame, key: str = "prompt_id", logit: str = "logit", token: str = "token") -> DataFrame:
    """argmax per prompt, ties to the smallest token (an aggregate)."""
    return logits.groupBy(key).agg(F.max_by(F.col(token), F.struct(F.col(logit), -F.col(token))).alias(token))


def md5_uniform_expr(*parts: Column) -> Column:
    """Uniform in (0, 1) from the first 13 hex digits of md5 of the parts."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 13), 16, 10)
    return (h.cast("double") + 0.5) / F.lit(float(16 ** 13))


def sample_tokens(logits: DataFrame, n: int, temperature: float = 1.0, seed: int = 42, key: str = "prompt_id",
                  logit: str = "logit", token: str = "token") -> DataFrame:
    """``n`` seeded draws per prompt by the Gumbel-max trick:
    argmax(logit/T + Gumbel(u)), u = md5(prompt:token:draw:seed)."""
    d = logits.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(n)).cast("array<bigint>")))
    u = md5_uniform_expr(F.col(key), F.col(token), F.col("draw"), F.lit(seed))
    d = d.withColumn("_s", F.col(logit) / F.lit(float(temperature)) - F.log(-F.log(u)))
    return d.groupBy(key, "draw").agg(F.max_by(F.col(token), F.struct(F.col("_s"), -F.col(token))).alias(token))


# ---------------------------------------------------------------- G5
def repetition_penalty(logits: DataFrame, produced: DataFrame, penalty: float, key: str = "prompt_id",
                       token: str = "token", logit: str = "logit") -> DataFrame:
    """Tokens already produced for the prompt: positive logits ÷ penalty,
    negative × penalty (CTRL-style)."""
    p = produced.select(key, token).distinct().withColumn("_seen", F.lit(True))
    j = logits.join(p, [key, token], "left")
    pen = F.when(F.col("_seen").isNull(), F.col(logit)) \
           .when(F.col(logit) > 0, F.col(logit) / F.lit(penalty)).otherwise(F.col(logit) * F.lit(penalty))
    return j.withColumn(logit, pen).drop("_seen")


# ---------------------------------------------------------------- T2
def next_token_topk(logits: DataFrame, k: int = 5, temperature: float = 1.0, key: str = "prompt_id",
                    token: str = "token", logit: str = "logit") -> DataFrame:
    """Softmax over the whole score row, then the k most probable tokens."""
    p = apply_temperature(logits, temperature, key, logit)
    return _ranked(p, key, logit, token).filter(F.col("rank") <= k)


# ---------------------------------------------------------------- J5
def strategy_grid(prompts: DataFrame, strategies: Sequence[tuple] = DECODING_STRATEGIES) -> DataFrame:
    """Prompts × decoding strategies; the strategy list is a literal array
    exploded per row (a generator, not a join)."""
    arr = F.array(*[F.struct(F.lit(n).alias("strategy"), F.lit(ds).alias("do_sample"),
                             F.lit(t).cast("double").alias("temperature"), F.lit(tp).cast("double").alias("top_p"))
                    for n, ds, t, tp in strategies])
    return prompts.select("*", F.inline(arr))


# ---------------------------------------------------------------- G6
Generator = Callable[[pd.DataFrame], pd.Series]


def itemic_echo_generator(batch: pd.DataFrame) -> pd.Series:
    """Deterministic stand-in for a model: one itemic token per prompt and
    strategy, derived from md5 of both (lets the pipeline run end to end)."""
    import hashlib

    out = []
    for prompt, strategy in zip(batch["prompt"], batch["strategy"]):
        h = hashlib.md5(f"{strategy}:{prompt}".encode()).hexdigest()
        dom = ITEMIC_DOMAINS[int(h[:2], 16) % len(ITEMIC_DOMAINS)]
        a, b, c = (int(h[i:i + 4], 16) % 8192 for i in (2, 6, 10))
        out.append(f"<|{dom}_begin|><s_a_{a}><s_b_{b}><s_c_{c}>")
    return pd.Series(out, index=batch.index)


def recorded_generator(batch: pd.DataFrame) -> pd.Series:
    """Answers recorded for the prompts (column ``recorded``, joined by Spark
    beforehand): replays a run of a model instead of calling one."""
    return batch["recorded"]


def batch_generate(prompts: DataFrame, generator: Generator = itemic_echo_generator, batch_size: int = 4,
                   key: str = "prompt_id", prompt: str = "prompt", strategy: str = "strategy",
                   carry: Sequence[str] = ()) -> DataFrame:
    """Run ``generator`` over micro-batches of ``batch_size`` prompts.

    The micro-batches follow the length of the prompts over all rows (a range
    sort numbered across partitions, ties by key and strategy), so they and their
    padding do not depend on the partitioning; a batch is one call of the
    generator with the prompts, the ``carry`` columns and nothing else in memory.
    Output: key, strategy, response, micro_batch, n_prompt_chars, and the padding
    that a left-padded batch would carry."""
    src = prompts.select(F.col(key).cast("long").alias(key), prompt, strategy, *carry) \
        .withColumn("n_prompt_chars", F.coalesce(F.length(prompt), F.lit(0)).cast("long"))
    src = dense_index(src, ["n_prompt_chars", key, strategy], name="_at")
    src = src.withColumn("micro_batch", F.floor(F.col("_at") / batch_size)).drop("_at")
    schema = (f"{key} long, {strategy} string, response string, micro_batch long, "
              f"n_prompt_chars long, n_pad_chars long")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_prompt_chars", key, strategy]).reset_index(drop=True)
        return pd.DataFrame({key: pdf[key], strategy: pdf[strategy], "response": generator(pdf),
                             "micro_batch": pdf["micro_batch"], "n_prompt_chars": pdf["n_prompt_chars"],
                             "n_pad_chars": pdf["n_prompt_chars"].max() - pdf["n_prompt_chars"]})

    return src.groupBy("micro_batch").applyInPandas(run, schema)
