"""Timed chat state: commands, idle conversations, late turns; the daily quota."""

import datetime as dt
import tempfile
import uuid

import pytest

from loomis.operators import chatml as cm
from loomis.streaming import streams as st

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "conv_id long, turn long, role string, text string, ts timestamp"


@pytest.fixture()
def feed(spark):
    base = f"{tempfile.mkdtemp(prefix='chat-', dir='/tmp')}/{uuid.uuid4().hex}"

    def push(rows, **options):
        data = [(c, t, r, x, T0 + dt.timedelta(minutes=m)) for c, t, r, x, m in rows]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        st.run_to_completion(st.stream_chat_state(st.file_stream(spark, f"{base}/in", SCHEMA), **options),
                             f"{base}/out", f"{base}/ckpt", n_state=2)
        return sorted((r.conv_id, r.turn, r.event, r.turn_tokens, r.context_tokens)
                      for r in spark.read.parquet(f"{base}/out").collect())
    push.base = base
    return push


def size(spark, role, text):
    return cm.context_length(spark.createDataFrame([(1, 1, role, text)], "conv_id long, turn long, role string, text string")) \
        .first().context_tokens


def test_commands_in_one_and_in_several_batches(spark, feed):
    s, u = size(spark, "system", "be brief"), size(spark, "user", "hi there")
    turns = [(1, 1, "system", "be brief", 1), (1, 2, "user", "hi there", 2), (1, 3, "user", "  ", 3), (1, 4, "user", "/len", 4),
             (1, 5, "assistant", "/clear", 5), (1, 6, "user", " /clear ", 6), (1, 7, "user", "hi there", 7), (1, 8, "user", "/clear", 8),
             (1, 9, "user", "QUIT", 9), (1, 10, "user", "ignored", 10)]
    a = size(spark, "assistant", "/clear")
    want = [(1, 1, "turn", s, s), (1, 2, "turn", u, s + u), (1, 4, "len", 0, s + u), (1, 5, "turn", a, s + u + a),
            (1, 6, "cleared", 0, s), (1, 7, "turn", u, s + u), (1, 8, "cleared", 0, s), (1, 9, "closed", 0, s)]
    other = [(2, t, r, x, m) for _, t, r, x, m in turns]
    assert [x for x in feed(turns + other[:3]) if x[0] == 1] == want
    for k in range(3, len(other)):
        got = feed(other[k:k + 1])
    assert [(1, *x[1:]) for x in got if x[0] == 2] == want


def test_idle_conversations_leave_and_late_turns_are_dropped(spark, feed):
    u = size(spark, "user", "hi there")
    options = {"idle": "30 minutes", "watermark": "10 minutes", "report_expiry": True}
    feed([(1, 1, "user", "hi there", 0), (2, 1, "user", "hi there", 5)], **options)
    # Conversation 2 goes on; the watermark passes the idle end of conversation 1 only.
    feed([(2, 2, "user", "hi there", 42)], **options)
    got = feed([(3, 1, "user", "hi there", 43)], **options)
    assert (1, -1, "expired", 0, u) in got and not any(x[0] == 2 and x[2] == "expired" for x in got)
    state = spark.read.format("statestore").option("stateVarName", "context").load(f"{feed.base}/ckpt")
    assert sorted(r.key.conv_id for r in state.collect()) == [2, 3]
    # A late turn (behind the watermark) is dropped, a new one after the idle time begins anew.
    got = feed([(1, 2, "user", "hi there", 1), (1, 3, "user", "hi there", 44)], **options)
    assert not any(x[:2] == (1, 2) for x in got) and (1, 3, "turn", u, u) in got
    assert (2, 2, "turn", u, 2 * u) in got


def test_quota_of_a_hot_day_in_pieces(spark):
    base = tempfile.mkdtemp(prefix="quota-", dir="/tmp")
    rows = [(1 + (i % 50 == 0), i, T0 + dt.timedelta(seconds=i)) for i in range(3000)] + [(1, 9000, T0 + dt.timedelta(days=1)), (1, 8999, T0 + dt.timedelta(days=1))]
    schema = "team long, id long, ts timestamp"
    for part in (rows[:2], rows[2:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        st.run_to_completion(st.stream_daily_quota(st.file_stream(spark, f"{base}/in", schema)), f"{base}/out", f"{base}/ckpt", n_state=2)
    got = sorted((r.team, r.day, r.rank, r.id) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [(1, "2024-01-01", 1, 1), (1, "2024-01-01", 2, 2), (1, "2024-01-01", 3, 3), (1, "2024-01-02", 1, 8999),
                   (1, "2024-01-02", 2, 9000), (2, "2024-01-01", 1, 0), (2, "2024-01-01", 2, 50), (2, "2024-01-01", 3, 100)]
