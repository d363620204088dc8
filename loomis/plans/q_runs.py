"""Run / submission queries over SUB and METRIC (events) and the chat corpus
size."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from loomis.operators import chatml as cm
from loomis.operators import intervals as iv
from loomis.operators import runs as ru
from loomis.operators import sketches as sk
from loomis.plans import bindings as b
from loomis.plans import sqlparts as s
from loomis.plans.registry import register
from loomis.session import scratch_path

RANKS, LRS, EPOCHS, ACCUMS = [8, 16, 32], [5e-5, 1e-4], [5], [8]

# The event log covers January 2024, so the competition calendar (registration,
# preliminary, semifinal, code review; see schemas.COMPETITION_PHASES) is laid
# onto that month with the same shape: four phases, a one-day gap before the
# review and an open last day.
PHASES = [("registration", dt.date(2024, 1, 1), dt.date(2024, 1, 5)),
          ("preliminary", dt.date(2024, 1, 6), dt.date(2024, 1, 15)),
          ("semifinal", dt.date(2024, 1, 16), dt.date(2024, 1, 25)),
          ("review", dt.date(2024, 1, 27), dt.date(2024, 1, 30))]


# ---------------------------------------------------------------- A16
@register("training_plan", f"""
WITH LA AS (SELECT conv_id, arg_max(text, turn) FILTER (WHERE role = 'assistant') AS ans
            FROM conversations GROUP BY conv_id),
S AS (SELECT count(*) AS n FROM LA WHERE ans IS NOT NULL AND length(ans) > 0),
G AS (SELECT CAST(r AS BIGINT) AS r, CAST(lr AS DOUBLE) AS lr, CAST(e AS BIGINT) AS epochs,
             CAST(a AS BIGINT) AS grad_accum
      FROM (VALUES {", ".join(f"({r})" for r in RANKS)}) rr(r), (VALUES {", ".join(f"({x})" for x in LRS)}) ll(lr),
           (VALUES {", ".join(f"({x})" for x in EPOCHS)}) ee(e), (VALUES {", ".join(f"({x})" for x in ACCUMS)}) aa(a))
SELECT r, r * 2 AS alpha, lr, epochs, grad_accum, grad_accum * 1 AS effective_batch,
       CAST(floor(n * epochs / (1 * grad_accum)) AS BIGINT) AS total_steps,
       CAST(ceil(floor(n * epochs / (1 * grad_accum)) * 0.05) AS BIGINT) AS warmup_steps
FROM S, G""")
def training_plan(spark, sf):
    sp = cm.split_answer(cm.assemble_conversations(b.table(spark, sf, "conversations")))
    stats = sp.filter(F.col("answer").isNotNull() & (F.length("answer") > 0)).agg(F.count(F.lit(1)).alias("n_samples"))
    return ru.training_plan(stats, RANKS, LRS, EPOCHS, ACCUMS)


# ---------------------------------------------------------------- A17
@register("run_metrics", s.q(s.METRIC, """N AS (SELECT *, max(step) OVER (PARTITION BY run) AS n FROM METRIC)""", """
SELECT run, CAST(max(step) AS BIGINT) AS n_steps, round(arg_max(loss, step), 6) AS last_loss,
       round(min(loss), 6) AS min_loss, round(avg(loss) FILTER (WHERE step > n - 5), 6) AS smoothed_loss
FROM N GROUP BY run"""))
def run_metrics(spark, sf):
    return ru.run_metrics(b.run_metrics_table(spark, sf))


ALPHA = 0.1


@register("smoothed_series", "WITH RECURSIVE " + s.METRIC + f""", S AS (
  SELECT run, step, loss, CAST(loss AS DOUBLE) AS smoothed, loss AS best FROM METRIC WHERE step = 1
  UNION ALL
  SELECT m.run, m.step, m.loss, {1 - ALPHA} * S.smoothed + {ALPHA} * m.loss, least(S.best, m.loss)
  FROM S JOIN METRIC m ON m.run = S.run AND m.step = S.step + 1)
SELECT run, CAST(step AS BIGINT) AS step, round(loss, 6) AS loss, round(smoothed, 6) AS smoothed, round(best, 6) AS best FROM S""")
def smoothed_series(spark, sf):
    """Smoothed loss of every step of every run, ready to be laid over one another."""
    out = ru.smoothed_series(b.run_metrics_table(spark, sf), ALPHA)
    return out.select("run", "step", *[F.round(c, 6).alias(c) for c in ("loss", "smoothed", "best")])


# ---------------------------------------------------------------- T4
@register("best_config", s.q(s.SUB, """
SELECT team, id AS best_id, score AS best_score FROM (
  SELECT *, row_number() OVER (PARTITION BY team ORDER BY score DESC, id) AS r FROM SUB) WHERE r = 1"""))
def best_config(spark, sf):
    return ru.best_config(b.submissions(spark, sf), "team", "id", "score")


# ---------------------------------------------------------------- W8
QUOTA = """Q AS (
  SELECT * FROM (
    SELECT team, id, score, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
           row_number() OVER (PARTITION BY team, CAST(ts AS DATE) ORDER BY ts, id) AS rank FROM SUB)
  WHERE rank <= 3)"""


@register("daily_quota", s.q(s.SUB, QUOTA, "SELECT team, day, id, rank FROM Q"))
def daily_quota(spark, sf):
    return ru.daily_quota(b.submissions(spark, sf)).select("team", "day", "id", "rank")


# ---------------------------------------------------------------- W9
@register("retain_checkpoints", s.q(s.METRIC, """
SELECT run, CAST(epoch AS BIGINT) AS epoch, step FROM (
  SELECT run, epoch, max(step) AS step, row_number() OVER (PARTITION BY run ORDER BY epoch DESC) AS r
  FROM METRIC GROUP BY run, epoch) WHERE r <= 2"""))
def retain_checkpoints(spark, sf):
    return ru.retain_checkpoints(b.run_metrics_table(spark, sf)).select("run", "epoch", "step")


# ---------------------------------------------------------------- W10
@register("leaderboard", s.q(s.SUB, QUOTA, """
SELECT CAST(dense_rank() OVER (ORDER BY best_score DESC) AS BIGINT) AS rank, team, best_score FROM (
  SELECT team, max(score) AS best_score FROM Q GROUP BY team)"""))
def leaderboard(spark, sf):
    accepted = ru.daily_quota(b.submissions(spark, sf))
    return ru.leaderboard(accepted).select("rank", "team", "best_score")


# ---------------------------------------------------------------- J6
_PH = ", ".join(f"('{n}', DATE '{a}', DATE '{e}')" for n, a, e in PHASES)


@register("submissions_by_phase", s.q(s.SUB, f"""
SELECT id, team, coalesce(P.phase, 'none') AS phase
FROM SUB LEFT JOIN (VALUES {_PH}) P(phase, start_day, end_day)
  ON CAST(ts AS DATE) BETWEEN P.start_day AND P.end_day"""))
def submissions_by_phase(spark, sf):
    phases = spark.createDataFrame(PHASES, "phase string, start date, end date")
    return ru.submissions_by_phase(b.submissions(spark, sf), phases).select("id", "team", "phase")


@register("submissions_in_windows", s.q(s.SUB, """
SELECT w.id AS window_id, w.team AS window_team, count(p.id) AS n_submissions, count(DISTINCT p.team) AS n_teams
FROM SUB w JOIN SUB p ON epoch_us(p.ts) // 1000000 >= epoch_us(w.ts) // 1000000
  AND epoch_us(p.ts) // 1000000 <= epoch_us(w.ts) // 1000000 + 60 * (w.id % 30)
GROUP BY w.id, w.team"""))
def submissions_in_windows(spark, sf):
    """Every submission opens a window of up to half an hour; submissions of all
    teams inside each (many overlapping intervals)."""
    sub = b.submissions(spark, sf).withColumn("sec", F.unix_timestamp(F.col("ts").cast("timestamp")))
    windows = sub.select(F.col("id").alias("window_id"), F.col("team").alias("window_team"), F.col("sec").alias("opens"),
                         (F.col("sec") + 60 * (F.col("id") % 30)).alias("shuts"))
    out = iv.interval_counts(sub, F.col("sec"), F.col("team"), windows, F.col("opens"), F.col("shuts"),
                             ["window_id", "window_team"])
    return out.select("window_id", "window_team", F.col("n").alias("n_submissions"), F.col("n_of").alias("n_teams"))


@register("stored_sketches", """
SELECT user_id AS run, count(*) AS n, true AS distinct_ok, true AS median_ok FROM events GROUP BY user_id""")
def stored_sketches(spark, sf):
    """Sketches of every day's events, stored by day and merged per run without
    the events; the estimates are held against the exact figures (distinct events
    within 5 %, the rank of the median within 2 %)."""
    ev = b.table(spark, sf, "events").select(F.col("user_id").alias("run"), "event_id", F.col("value").alias("loss"),
                                             F.to_date("ts").alias("day"))
    path = sk.write_sketches(ev, scratch_path(spark, "sketches", uuid.uuid4().hex), "day", ["run"], ["event_id"], ["loss"])
    est = sk.merged(spark, path, ["run"])
    exact = ev.groupBy("run").agg(F.count_distinct("event_id").alias("events"))
    rank = ev.join(est.select("run", "q50_loss"), "run").groupBy("run").agg(
        F.avg((F.col("loss") < F.col("q50_loss")).cast("int")).alias("below"),
        F.avg((F.col("loss") <= F.col("q50_loss")).cast("int")).alias("upto"))
    j = est.join(exact, "run").join(rank, "run")
    return j.select("run", "n", (F.abs(F.col("distinct_event_id") - F.col("events")) <= 0.05 * F.col("events") + 1).alias("distinct_ok"),
                    ((F.col("below") <= 0.52) & (F.col("upto") >= 0.48)).alias("median_ok"))
