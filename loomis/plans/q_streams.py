"""Streaming queries.  Each replays a driver table as a file stream (files
written oldest-first into the shared scratch folder, one chunk per micro-batch),
runs the streaming operator to completion (``availableNow``) and returns the
sink contents.  Their results equal the batch operators, so the batch SQL is
their oracle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomis.operators import chatml as cm
from loomis.plans import bindings as b
from loomis.plans import sqlparts as s
from loomis.plans.q_records import CTX, IDS, LA
from loomis.plans.q_runs import QUOTA
from loomis.plans.registry import register
from loomis.session import scratch_path
from loomis.streaming import streams as st


def _replay(spark: SparkSession, df: DataFrame, chunk: str, path: str, run) -> None:
    """Let ``df`` arrive chunk by chunk (null first): write a chunk's rows in
    parallel, process all that is there (``run``, an ``availableNow`` query
    whose checkpoint carries the state), go on with the next.  A short driver
    loop over the chunk numbers; the rows never pass the driver or one task."""
    chunks = [r[0] for r in df.select(chunk).distinct().orderBy(F.col(chunk).asc_nulls_first()).collect()]
    for c in chunks or [None]:
        df.filter(F.col(chunk).eqNullSafe(F.lit(c))).drop(chunk).write.mode("append").parquet(path)
        run()


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


# ---------------------------------------------------------------- R1
@register("stream_chat_state", f"""
SELECT conv_id, turn, role, 'turn' AS event, CAST(tt AS BIGINT) AS turn_tokens,
       CAST(sum(tt) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS context_tokens
FROM (SELECT conv_id, turn, role,
             len(regexp_extract_all('<|im_start|>' || role || {s.NL} || text || '<|im_end|>' || {s.NL}, '{s.PAT}')) AS tt
      FROM conversations)""")
def stream_chat_state(spark, sf):
    base = scratch_path(spark, "streams", uuid.uuid4().hex)
    # five turn levels arrive together; state still spans several micro-batches
    turns = b.table(spark, sf, "conversations").withColumn("_chunk", (F.col("turn") / 5).cast("int"))
    # a turn a minute: five turn levels lie within the watermark's hour
    turns = turns.withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + 60 * F.col("turn")))
    _replay(spark, turns, "_chunk", f"{base}/in", lambda: st.run_to_completion(
        st.stream_chat_state(st.file_stream(spark, f"{base}/in", _schema(turns.drop("_chunk")))),
        f"{base}/out", f"{base}/ckpt"))
    return spark.read.parquet(f"{base}/out")


# ---------------------------------------------------------------- R2
@register("stream_ingest", s.q(LA, CTX, IDS, f"""T3 AS (
  SELECT i.conv_id,
         coalesce((SELECT string_agg(text, {s.NL} ORDER BY turn) FROM CTX WHERE CTX.conv_id = i.conv_id
                   AND CTX.role <> 'system'), '') AS prompt,
         LA.ans AS response
  FROM IDS i JOIN LA USING (conv_id))""", """
SELECT conv_id,
       CASE WHEN reason IS NULL THEN 'dataset' ELSE 'quarantine' END AS sink, reason FROM (
  SELECT conv_id,
         CASE WHEN conv_id % 10 = 9 THEN 'corrupt'
              WHEN prompt IS NULL OR regexp_replace(prompt, '^\\s+|\\s+$', '', 'g') = '' THEN 'missing_prompt'
              WHEN response IS NULL OR regexp_replace(response, '^\\s+|\\s+$', '', 'g') = '' THEN 'missing_response'
         END AS reason
  FROM T3)"""))
def stream_ingest(spark, sf):
    base = scratch_path(spark, "streams", uuid.uuid4().hex)
    tf = cm.to_three_field(cm.assemble_conversations(b.table(spark, sf, "conversations")))
    line = F.when(F.col("conv_id") % 10 == 9, F.concat(F.lit("not json "), F.col("conv_id").cast("string"))) \
            .otherwise(F.to_json(F.struct("system", "prompt", "response")))
    # all lines arrive within the watermark's hour
    ts = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("conv_id") % 3000)
    lines = tf.select("conv_id", ts.alias("ts"), line.alias("value"))
    # every fifth line is sent twice (in a later file) to exercise de-duplication
    dup = lines.filter(F.col("conv_id") % 5 == 0).withColumn("_chunk", F.lit(1))
    src_df = lines.withColumn("_chunk", F.lit(0)).unionByName(dup)
    _replay(spark, src_df, "_chunk", f"{base}/in", lambda: st.stream_ingest(
        st.file_stream(spark, f"{base}/in", _schema(src_df.drop("_chunk"))), f"{base}/good", f"{base}/bad",
        f"{base}/ckpt"))
    good = spark.read.schema("conv_id long").parquet(f"{base}/good").select("conv_id", F.lit("dataset").alias("sink"),
                                                                            F.lit(None).cast("string").alias("reason"))
    bad = spark.read.schema("conv_id long, reason string").parquet(f"{base}/bad") \
               .select("conv_id", F.lit("quarantine").alias("sink"), "reason")
    return good.unionByName(bad)


# ---------------------------------------------------------------- R3
@register("stream_daily_quota", s.q(s.SUB, QUOTA, "SELECT team, day, id, rank FROM Q"))
def stream_daily_quota(spark, sf):
    base = scratch_path(spark, "streams", uuid.uuid4().hex)
    sub = b.submissions(spark, sf)
    t0 = sub.select(F.min(F.unix_timestamp(F.col("ts").cast("timestamp")))).scalar()
    # ten-day files whose boundaries fall at noon, so a day's state spans two micro-batches
    chunk = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp")) - t0 + 43200) / 864000).cast("int")
    _replay(spark, sub.withColumn("_chunk", chunk), "_chunk", f"{base}/in", lambda: st.run_to_completion(
        st.stream_daily_quota(st.file_stream(spark, f"{base}/in", _schema(sub))), f"{base}/out", f"{base}/ckpt"))
    return spark.read.parquet(f"{base}/out")


# ---------------------------------------------------------------- R4
@register("stream_run_metrics", """
SELECT user_id AS run, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       round(avg(value), 6) AS mean_loss, round(min(value), 6) AS min_loss, count(*) AS n
FROM events GROUP BY user_id, date_trunc('day', ts)""")
def stream_run_metrics(spark, sf):
    base = scratch_path(spark, "streams", uuid.uuid4().hex)
    ev = b.table(spark, sf, "events").select(F.col("user_id").alias("run"), "ts", F.col("value").alias("loss"))
    t0 = ev.select(F.min(F.unix_timestamp(F.col("ts").cast("timestamp")))).scalar()
    # ten-day files in event order, so that no row is behind the watermark
    chunk = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp")) - t0) / 864000).cast("int")
    _replay(spark, ev.withColumn("_chunk", chunk), "_chunk", f"{base}/in", lambda: st.run_to_completion(
        st.stream_run_metrics(st.file_stream(spark, f"{base}/in", _schema(ev))), f"{base}/out", f"{base}/ckpt",
        mode="update", by_batch=True))
    # a window may be updated by several micro-batches: its last state counts
    last = spark.read.parquet(f"{base}/out").groupBy("w", "run").agg(
        F.max_by(F.struct("mean_loss", "min_loss", "n"), "batch").alias("m"))
    out = last.select("w", "run", "m.*")
    return out.select("run", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      F.round("mean_loss", 6).alias("mean_loss"), F.round("min_loss", 6).alias("min_loss"), "n")
