"""Behaviour-history operators: truncation, seeded perturbation, next-item
split, interest-evolution islands and embedding lookup.

Per-user ordering work avoids one-task-per-user windows where a user can be
arbitrarily large: neighbours are found with an equi-join on
``(user, seq ± 1)`` and running counts use ``cumulative_within`` /
``sequence_within`` (bucketed by day or hash prefix).  Windows remain only
where a row limit bounds them (``row_number() <= N`` gets a map-side group
limit).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomis.functions.text import seeded_key
from loomis.plans.sequence import cumulative_within, sequence_within

# ---------------------------------------------------------------- W4
def truncate_history(h: DataFrame, n: int, key: str = "user_id", order: str = "seq") -> DataFrame:
    """Newest ``n`` events per user (``row_number() <= n`` → map-side limit)."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return h.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


# ---------------------------------------------------------------- W5
def perturb_history(h: DataFrame, seed: int | str, key: str = "user_id", seq: str = "seq",
                    out: str = "new_pos", tasks: int | None = None) -> DataFrame:
    """Seeded reorder within each user: position by ``md5(user:seq:seed)``,
    numbered in 256 hash-prefix buckets so a heavy user is split, in ``tasks``
    partitions (default: the session's)."""
    k = seeded_key(F.concat_ws(":", F.col(key).cast("string"), F.col(seq).cast("string")), seed)
    d = h.withColumn("_k", k)
    return sequence_within(d, key, ["_k"], bucket=F.substring("_k", 1, 2), name=out, tasks=tasks).drop("_k")


# ---------------------------------------------------------------- W6
def next_item_split(h: DataFrame, key: str = "user_id", seq: str = "seq", item: str = "item") -> DataFrame:
    """Every event with its successor (``next_item``) via an equi-join on
    ``(user, seq + 1)``; the last event of a user is the ``target``, all
    earlier ones are ``input``."""
    nxt = h.select(F.col(key).alias("_k"), (F.col(seq) - 1).alias("_s"), F.col(item).alias("next_item"))
    j = h.join(nxt, (h[key] == nxt["_k"]) & (h[seq] == nxt["_s"]), "left")
    return j.withColumn("role", F.when(F.col("_s").isNull(), F.lit("target")).otherwise(F.lit("input"))) \
            .drop("_k", "_s")


# ---------------------------------------------------------------- W7
def topic_changes(events: DataFrame, key: str, topic: str, order: list[str], day: Column) -> DataFrame:
    """Events numbered per user (bucketed by day) with the previous event's
    topic (``_prev``, from an equi-join on ``seq - 1``)."""
    e = sequence_within(events.withColumn("_day", day), key, order, bucket=F.col("_day"), name="seq")
    prev = e.select(F.col(key).alias("_k"), (F.col("seq") + 1).alias("_s"), F.col(topic).alias("_prev"))
    return e.join(prev, (e[key] == prev["_k"]) & (e["seq"] == prev["_s"]), "left").drop("_k", "_s")


def interest_islands(events: DataFrame, key: str, topic: str, order: list[str], day: Column) -> DataFrame:
    """Collapse runs of equal topic per user: (user, island, topic, start_seq,
    n_events).  Island ids are bucketed running counts of topic changes."""
    j = topic_changes(events, key, topic, order, day)
    chg = (~F.col("_prev").eqNullSafe(F.col(topic))).cast("long")
    isl = cumulative_within(j, key, ["seq"], chg, bucket=F.col("_day"), name="island")
    return isl.groupBy(key, "island").agg(F.first(topic).alias(topic), F.min("seq").alias("start_seq"),
                                          F.count(F.lit(1)).alias("n_events"))


def interest_transitions(events: DataFrame, key: str, topic: str, order: list[str], day: Column) -> DataFrame:
    """Counts of topic changes over all users: every event whose previous
    event has another topic starts a new island, so the (previous, current)
    pairs at those events are exactly the island-to-island transitions."""
    j = topic_changes(events, key, topic, order, day)
    ch = j.filter(F.col("_prev").isNotNull() & (F.col("_prev") != F.col(topic)))
    return ch.groupBy(F.col("_prev").alias("from_topic"), F.col(topic).alias("to_topic")) \
             .agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- J2
def embedding_lookup(h: DataFrame, emb: DataFrame, item: str = "item", emb_id: str = "vec_id",
                     vector: str = "embedding", modulo: Column | None = None) -> DataFrame:
    """History rows joined to their vectors, position kept; an event without a
    vector stays, with a null one.  The join strategy is Spark's, by bytes.  ``modulo`` maps
    item ids into the embedding id range (a scalar column, e.g. the table size)."""
    key = (F.col(item) % modulo) if modulo is not None else F.col(item)
    e = emb.select(F.col(emb_id).alias("_vid"), F.col(vector).alias("vec"), *[
        c for c in emb.columns if c not in (emb_id, vector)])
    return h.withColumn("_vid", key).join(e, "_vid", "left").withColumnRenamed("_vid", emb_id)


def vector_norm(v) -> Column:
    c = F.col(v) if isinstance(v, str) else v
    return F.sqrt(F.aggregate(F.transform(c, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0),
                              lambda acc, x: acc + x))
