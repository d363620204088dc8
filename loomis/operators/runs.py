"""Run, submission and scoreboard tables: training plans, run metrics, best
configuration, daily submission quota, checkpoint retention, leaderboard and
competition phases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomis.plans.sequence import dense_index
from loomis.schemas import DAILY_SUBMISSION_QUOTA, DEFAULT_BATCH_SIZE, WARMUP_RATIO


# ---------------------------------------------------------------- A16
def training_plan(stats: DataFrame, ranks: Sequence[int], lrs: Sequence[float], epochs: Sequence[int],
                  accums: Sequence[int], n: str = "n_samples", batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """Dataset size × hyper-parameter grid → effective batch, optimizer steps
    (``n·epochs div (batch·accum)``) and warm-up steps (ceil of 5 %).  The grid
    is exploded from literal arrays on the one-row stats (no join)."""
    d = stats.select(n)
    for name, vals, typ in (("r", ranks, "bigint"), ("lr", lrs, "double"), ("epochs", epochs, "bigint"),
                            ("grad_accum", accums, "bigint")):
        d = d.withColumn(name, F.explode(F.array(*[F.lit(v) for v in vals]).cast(f"array<{typ}>")))
    steps = F.floor(F.col(n) * F.col("epochs") / (F.lit(batch_size) * F.col("grad_accum"))).cast("long")
    return d.select("r", (F.col("r") * 2).alias("alpha"), "lr", "epochs", "grad_accum",
                    (F.col("grad_accum") * batch_size).cast("long").alias("effective_batch"),
                    steps.alias("total_steps"), F.ceil(steps * F.lit(WARMUP_RATIO)).cast("long").alias("warmup_steps"))


# ---------------------------------------------------------------- A17
def run_metrics(metric: DataFrame, run: str = "run", step: str = "step", loss: str = "loss",
                smooth: int = 5) -> DataFrame:
    """Per run: steps, last loss, min loss and the mean of the last ``smooth``
    losses -- aggregates plus a join with the per-run step count (no window
    over a whole run)."""
    last = metric.groupBy(run).agg(F.max(step).alias("n_steps"), F.max_by(loss, step).alias("last_loss"),
                                   F.min(loss).alias("min_loss"))
    tail = metric.join(last.select(run, "n_steps"), run).filter(F.col(step) > F.col("n_steps") - smooth) \
                 .groupBy(run).agg(F.avg(loss).alias("smoothed_loss"))
    return last.join(tail, run).select(run, F.col("n_steps").cast("long").alias("n_steps"),
                                       F.round("last_loss", 6).alias("last_loss"),
                                       F.round("min_loss", 6).alias("min_loss"),
                                       F.round("smoothed_loss", 6).alias("smoothed_loss"))


SMOOTH_BLOCK = 256


def smoothed_series(metric: DataFrame, alpha: float = 0.1, run: str = "run", step: str = "step",
                    loss: str = "loss") -> DataFrame:
    """(run, step, loss, smoothed, best): exponential smoothing of every run,
    ``s_1 = x_1, s_t = (1 - alpha) s_(t-1) + alpha x_t``, and the smallest loss so
    far; steps are numbered from 1.  Runs overlay on ``step``.

    A step is an affine map of the smoothed value, and maps compose: the 256
    steps of a block make one map, whose offset is a partially aggregated sum.
    The maps of a run's blocks are composed in order (a row for each 256 steps),
    which gives the value at every block's start; inside a block the values are
    a running sum in powers of ``1 - alpha``.  No window holds more than a block
    or a run's blocks.  ``alpha`` in (0, 0.9]: (1 - alpha) ** -256 must be a
    double."""
    if not 0 < alpha <= 0.9:
        raise ValueError("alpha must be in (0, 0.9]")
    keep = 1.0 - alpha
    d = metric.select(F.col(run).alias("run"), F.col(step).cast("long").alias("step"), F.col(loss).cast("double").alias("loss"))
    d = d.withColumn("block", F.floor((F.col("step") - 1) / SMOOTH_BLOCK))
    # The first value is taken whole.
    weight = F.when(F.col("step") == 1, 1.0).otherwise(alpha)
    end = (F.col("block") + 1) * SMOOTH_BLOCK
    maps = d.groupBy("run", "block").agg(F.sum(weight * F.col("loss") * F.pow(F.lit(keep), end - F.col("step"))).alias("offset"),
                                         F.min("loss").alias("low"))
    before = Window.partitionBy("run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # All blocks before the last are full, so every map has the slope keep ** 256.
    slope = keep ** SMOOTH_BLOCK
    runs = Window.partitionBy("run").orderBy("block")
    earlier = F.collect_list("offset").over(runs.rowsBetween(-_reach(slope), -1))
    start = F.aggregate(earlier, F.lit(0.0), lambda a, x: a * slope + x)
    maps = maps.select(F.col("run").alias("m_run"), F.col("block").alias("m_block"), start.alias("start"),
                       F.min("low").over(before).alias("low"))
    j = d.join(maps, (F.col("run") == F.col("m_run")) & (F.col("block") == F.col("m_block")))
    place = (F.col("step") - F.col("block") * SMOOTH_BLOCK).cast("double")
    inside = Window.partitionBy("run", "block").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(weight * F.col("loss") * F.pow(F.lit(keep), -place)).over(inside)
    best = F.least(F.col("low"), F.min("loss").over(inside))
    return j.select("run", "step", "loss", (F.pow(F.lit(keep), place) * (F.col("start") + total)).alias("smoothed"), best.alias("best"))


def _reach(slope: float) -> int:
    """Blocks back beyond which a block's share is below a double's precision."""
    reach, share = 1, slope
    while share > 1e-18:
        reach, share = reach + 1, share * slope
    return reach


# ---------------------------------------------------------------- T4
def best_config(df: DataFrame, group: str, config: str, score: str) -> DataFrame:
    """argmax of the score per group, ties to the smallest config id."""
    return df.groupBy(group).agg(F.max_by(F.col(config), F.struct(F.col(score), -F.col(config))).alias(f"best_{config}"),
                                 F.max(score).alias(f"best_{score}"))


# ---------------------------------------------------------------- W8
def daily_quota(sub: DataFrame, quota: int = DAILY_SUBMISSION_QUOTA, team: str = "team", ts: str = "ts",
                id_: str = "id") -> DataFrame:
    """First ``quota`` submissions per team and day (map-side group limit)."""
    d = sub.withColumn("day", F.to_date(ts).cast("string"))
    w = Window.partitionBy(team, "day").orderBy(ts, id_)
    return d.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= quota)


# ---------------------------------------------------------------- W9
def retain_checkpoints(metric: DataFrame, keep: int = 2, run: str = "run", epoch: str = "epoch",
                       step: str = "step") -> DataFrame:
    """One checkpoint per epoch (its last step); the newest ``keep`` per run."""
    ck = metric.groupBy(run, epoch).agg(F.max(step).alias(step))
    w = Window.partitionBy(run).orderBy(F.desc(epoch))
    return ck.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= keep).drop("_r")


# ---------------------------------------------------------------- W10
def leaderboard(accepted: DataFrame, k: int | None = None, team: str = "team", score: str = "score") -> DataFrame:
    """Best accepted score per team with its dense rank, all teams or, with
    ``k``, those of the first k ranks (ties kept).  The distinct scores are
    numbered by a range sort and joined back -- no window over all teams."""
    best = accepted.groupBy(team).agg(F.max(score).alias("best_score"))
    levels = dense_index(best.select("best_score").distinct(), [F.desc("best_score")], name="rank", start=1)
    if k is not None:
        levels = levels.filter(F.col("rank") <= k)
    return best.join(levels, "best_score").select(team, "best_score", "rank")


# ---------------------------------------------------------------- J6
def submissions_by_phase(sub: DataFrame, phases: DataFrame, ts: str = "ts") -> DataFrame:
    """Range join: the phase whose [start, end] day range holds the
    submission day (inclusive), ``none`` outside every phase.  The phase
    calendar is a handful of rows, which Spark broadcasts by its size."""
    d = sub.withColumn("_day", F.to_date(ts))
    j = d.join(phases, (F.col("_day") >= F.col("start")) & (F.col("_day") <= F.col("end")), "left")
    return j.withColumn("phase", F.coalesce("phase", F.lit("none"))).drop("_day", "start", "end")
