"""Structured Streaming forms: chat state per conversation (R1), validated
ingestion with a quarantine sink (R2), the daily submission quota (R3) and
windowed run metrics (R4).

Stateful logic uses ``transformWithStateInPandas`` (R1, with timers) and
``applyInPandasWithState`` (R3), keyed by conversation or by day and group of teams; state
is one small record per key (running counts), never the key's rows.  Rows of a
key inside one micro-batch arrive unordered, so each state function sorts them
first.  Everything that can run in the JVM
(tokenizing, parsing, validation) is done before the state operator.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomis.functions.text import chatml_turn, strip_ws, token_count
from loomis.schemas import CLEAR_COMMAND, DAILY_SUBMISSION_QUOTA, LEN_COMMAND, QUIT_WORDS
from loomis.sources.tasks import parse_sft_lines, sft_reject_reason


@contextlib.contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Start a stateful query with ``n`` state partitions (default: the
    cluster's parallelism); the count is fixed when the checkpoint is created,
    so it is sized to the cluster instead of a batch-sized shuffle setting."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def run_to_completion(stream_df: DataFrame, sink_path: str, checkpoint: str, mode: str = "append",
                      by_batch: bool = False, n_state: int | None = None, rocksdb: bool = True) -> None:
    """Process everything available now and stop (``availableNow``).

    With ``by_batch`` (update mode) each micro-batch writes its changed rows to
    a folder of its own, which a retry overwrites; append results go to a
    parquet file sink (exactly-once with the checkpoint).  A stateful query fixes its number of state partitions when
    its checkpoint is created; it is sized here to ``n_state``
    (default: the cluster's parallelism) rather than inheriting a batch-sized
    ``spark.sql.shuffle.partitions``.  State is kept in RocksDB
    (``rocksdb=False``: in the session's state store)."""
    spark = stream_df.sparkSession
    provider = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(provider, None)
    with state_partitions(spark, n_state):
        if rocksdb:
            spark.conf.set(provider, ROCKSDB)
        if by_batch:
            def write(batch: DataFrame, epoch: int) -> None:
                batch.write.mode("overwrite").parquet(f"{sink_path}/batch={epoch}")
            q = stream_df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
        else:
            q = stream_df.writeStream.outputMode(mode).format("parquet").option("path", sink_path) \
                         .option("checkpointLocation", checkpoint)
        try:
            started = q.trigger(availableNow=True).start()
        finally:
            if rocksdb:
                spark.conf.set(provider, old) if old else spark.conf.unset(provider)
        started.awaitTermination()


# ---------------------------------------------------------------- R1
CHAT_OUT = "conv_id long, turn long, role string, event string, turn_tokens long, context_tokens long"
CHAT_STATE = "system_tokens long, context_tokens long, closed boolean"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class ChatContext(StatefulProcessor):
    """Context of one conversation: a value state of three numbers and one
    event-time timer, moved with every batch that brings turns."""

    def __init__(self, idle_ms: int | None, report_expiry: bool):
        self.idle_ms, self.report_expiry = idle_ms, report_expiry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.context = handle.getValueState("context", CHAT_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        d = pd.concat(list(rows))
        system, start, closed = self.context.get() if self.context.exists() else (0, 0, False)
        last = int(d["ts"].max())
        d = d[~d["blank"]].sort_values("turn", kind="stable")
        user = (d["role"] == "user").to_numpy()
        quits = user & d["command"].isin(QUIT_WORDS).to_numpy()
        n = 0 if closed else int(quits.argmax()) + 1 if quits.any() else len(d)
        d, user, quits = d.iloc[:n], user[:n], quits[:n]
        clear = user & ~quits & (d["exact"] == CLEAR_COMMAND).to_numpy()
        asked = user & ~quits & (d["exact"] == LEN_COMMAND).to_numpy()
        event = np.select([quits, clear, asked], ["closed", "cleared", "len"], "turn")
        tokens = np.where(event == "turn", d["turn_tokens"].to_numpy(np.int64), 0)
        # The first system turn stays through every /clear.
        first = np.flatnonzero((event == "turn") & (d["role"] == "system").to_numpy() & (tokens > 0))
        at = np.arange(n)
        kept = np.full(n, system, np.int64)
        if not system and len(first):
            kept[at >= first[0]] = tokens[first[0]]
        # Running sum that starts again from the system turn at each /clear.
        total = np.cumsum(tokens)
        cut = np.maximum.accumulate(np.where(clear, at, -1)) if n else at
        context = np.where(cut < 0, start + total, kept[cut] + total - total[cut]) if n else total
        if n:
            system, start, closed = int(kept[-1]), int(context[-1]), closed or bool(quits.any())
        self.context.update((system, start, closed))
        if self.idle_ms is not None:
            for t in list(self.handle.listTimers()):
                last = max(last, t - self.idle_ms)
                self.handle.deleteTimer(t)
            self.handle.registerTimer(last + self.idle_ms)
        yield pd.DataFrame({"conv_id": np.full(n, key[0], np.int64), "turn": d["turn"].to_numpy(np.int64), "role": d["role"],
                            "event": event, "turn_tokens": tokens, "context_tokens": context})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, context, closed = self.context.get() if self.context.exists() else (0, 0, False)
        self.context.clear()
        n = int(self.report_expiry and not closed)
        yield pd.DataFrame({"conv_id": np.full(n, key[0], np.int64), "turn": np.full(n, -1, np.int64), "role": [None] * n,
                            "event": ["expired"] * n, "turn_tokens": np.zeros(n, np.int64),
                            "context_tokens": np.full(n, context, np.int64)})

    def close(self) -> None:
        pass


def stream_chat_state(turns: DataFrame, idle: str = "1 day", watermark: str = "1 hour",
                      report_expiry: bool = False) -> DataFrame:
    """Per conversation: each turn extends the context (running ChatML token
    count), ``/clear`` keeps only the system turn, ``/len`` reports the count
    (both exact), quit words in any case close the conversation, blank input
    is ignored; a turn without a number is read as turn -1.  Token counts are
    computed in the JVM before the state operator.  With an event time ``ts``
    in ``turns`` the state is timed; without it conversations never leave.

    A conversation leaves the state once the watermark is ``idle`` behind its
    last turn (with ``report_expiry`` an open one says so, with its last count).
    A turn that comes after that begins a new context, without the old system
    turn and even if the old one was closed; a turn behind the watermark is
    dropped.  Needs the RocksDB state store (``run_to_completion`` sets it)."""
    spark, timed = turns.sparkSession, "ts" in turns.columns
    idle_ms = int(spark.sql(f"SELECT timestamp'1970-01-01 00:00:00Z' + interval {idle} AS t").select(
        F.unix_millis("t")).first()[0])
    d = turns.select(F.col("conv_id").cast("long"), F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), "role",
                     (F.col("ts") if timed else F.lit(0)).cast("timestamp").alias("event_time"),
                     (F.coalesce(strip_ws("text"), F.lit("")) == "").alias("blank"),
                     F.lower(strip_ws("text")).alias("command"), strip_ws("text").alias("exact"),
                     F.coalesce(token_count(chatml_turn("role", "text")), F.lit(0)).cast("long").alias("turn_tokens"))
    if timed:
        d = d.withWatermark("event_time", watermark)
    return d.withColumn("ts", F.unix_millis("event_time")).groupBy("conv_id").transformWithStateInPandas(
        ChatContext(idle_ms if timed else None, report_expiry), CHAT_OUT, "append", "eventtime" if timed else "none")


# ---------------------------------------------------------------- R2
def stream_ingest(lines: DataFrame, good_path: str, bad_path: str, checkpoint: str, id_: str = "conv_id",
                  watermark: str = "1 hour") -> None:
    """Parse and validate arriving three-field lines.  The same record sent
    again within the watermark (same id and same line) is dropped; the state
    keeps the line's hash, not the line.  Good rows go to the dataset sink, bad
    rows with their reason to the quarantine sink, each into a folder of its
    micro-batch that a retry overwrites."""
    p = parse_sft_lines(lines, "value").withColumn("reason", sft_reject_reason())
    p = p.withColumn("_sha", F.sha2(F.coalesce("value", F.lit("")), 256)) \
         .withWatermark("ts", watermark).dropDuplicatesWithinWatermark([id_, "_sha"]).drop("_sha")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        batch.filter(F.col("reason").isNull()).drop("reason").write.mode("overwrite").parquet(f"{good_path}/batch={epoch}")
        batch.filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(f"{bad_path}/batch={epoch}")
        batch.unpersist()
    with state_partitions(lines.sparkSession):
        p.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
         .trigger(availableNow=True).start().awaitTermination()


# ---------------------------------------------------------------- R3
QUOTA_OUT = "team long, day string, id long, rank long"
# Teams of the group with submissions that day, and how many so far (the quota at most).
QUOTA_STATE = "teams array<long>, taken array<int>"
QUOTA_GROUPS = 512      # groups of teams in a day
DAY_MS = 86_400_000


def _make_quota(quota: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        teams, taken = state.get if state.exists else ([], [])
        so_far = dict(zip(teams, taken, strict=True))
        # Of the batch only the earliest rows of a team that may still be accepted are held.
        best = None
        for pdf in pdfs:
            best = pdf if best is None else pd.concat([best, pdf])
            best = best.sort_values(["ts", "id"], kind="stable")
            best = best[best.groupby("team", dropna=False).cumcount() < quota]
        team = [None if pd.isna(t) else int(t) for t in best["team"]]
        rank = best.groupby("team", dropna=False).cumcount().to_numpy(np.int64) + 1 \
            + np.array([so_far.get(t, 0) for t in team], np.int64)
        accepted = rank <= quota
        for t, r in zip(team, rank.tolist(), strict=True):
            so_far[t] = max(so_far.get(t, 0), min(r, quota))
        state.update((list(so_far), list(so_far.values())))
        # The day's counts go once the watermark has passed the day.
        end = (int(key[0]) + 1) * DAY_MS
        state.setTimeoutTimestamp(max(end, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"team": best["team"], "day": best["day"], "id": best["id"], "rank": rank})[accepted]
    return fn


def stream_daily_quota(sub: DataFrame, quota: int = DAILY_SUBMISSION_QUOTA, watermark: str = "1 day") -> DataFrame:
    """Accept the first ``quota`` submissions per team and day in event order.
    A call settles a group of teams on a day, so its cost is shared by them; the
    state is a count for each of these teams, dropped once the watermark has passed
    the day.  A busy team is spread over its days, and a busy day streams through
    its calls, which hold one Arrow batch and the earliest ``quota`` rows of a team."""
    team = F.col("team").cast("long")
    # Submissions without a team are a group of their own.
    group = F.when(team.isNull(), -1).otherwise(F.pmod(F.xxhash64(team), F.lit(QUOTA_GROUPS)).cast("int"))
    d = sub.select(team.alias("team"), F.col("id").cast("long"), F.col("ts").cast("timestamp").alias("ts"),
                   F.to_date("ts").cast("string").alias("day"),
                   F.unix_date(F.to_date("ts")).alias("day_number"), group.alias("team_group")).withWatermark("ts", watermark)
    return d.groupBy("day_number", "team_group").applyInPandasWithState(_make_quota(quota), QUOTA_OUT, QUOTA_STATE, "append",
                                                                        GroupStateTimeout.EventTimeTimeout)


# ---------------------------------------------------------------- R4
def stream_run_metrics(metric: DataFrame, window: str = "1 day", slide: str | None = None,
                       session_gap: str | None = None, watermark: str = "2 days") -> DataFrame:
    """Per run and event-time window: mean / min loss and count.  Tumbling by
    default; sliding with ``slide``; session windows with ``session_gap``.
    In append mode rows later than the watermark are dropped."""
    d = metric.select("run", F.col("ts").cast("timestamp").alias("ts"), "loss").withWatermark("ts", watermark)
    w: Column
    if session_gap:
        w = F.session_window("ts", session_gap)
    elif slide:
        w = F.window("ts", window, slide)
    else:
        w = F.window("ts", window)
    return d.groupBy(w.alias("w"), "run").agg(F.avg("loss").alias("mean_loss"), F.min("loss").alias("min_loss"),
                                               F.count(F.lit(1)).alias("n"))


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """A file-source stream reading the oldest files first; all that have
    arrived since the last run in one micro-batch, or ``files_per_batch``."""
    r = spark.readStream.format(fmt).schema(schema).option("latestFirst", "false")
    return (r.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else r).load(path)
