"""Edge rows that once gave wrong or missing results."""

import uuid

from pyspark.sql import functions as F

from loomis.operators import chatml as cm
from loomis.operators import curate as cu
from loomis.operators import evaluate as ev
from loomis.operators import history as hi
from loomis.operators import itemic as it
from loomis.operators import records as rc
from loomis.operators import runs as ru
from loomis.plans import q_streams
from loomis.session import scratch_path
from loomis.sources import tasks
from loomis.streaming import streams as st


def test_option_text_keeps_capitals(spark):
    df = spark.createDataFrame([(1, "哪个？A.Beijing B.Chengdu C.paris 钝角 /no_think"), (2, "D.rome I.oslo Z.A Big One"),
                                (3, "no options"), (4, None)], "k long, q string")
    got = {(r.k, r.letter): (r.text, r.n_options) for r in rc.choice_options(df, "k", "q").collect()}
    assert got == {(1, "A"): ("Beijing", 3), (1, "B"): ("Chengdu", 3), (1, "C"): ("paris 钝角", 3),
                   (2, "D"): ("rome", 3), (2, "I"): ("oslo", 3), (2, "Z"): ("A Big One", 3)}


def test_unresolved_target_is_not_replaced(spark):
    h = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (1, 3, 99), (2, 1, 99), (2, 2, 10)], "user_id long, seq long, item long")
    cat = spark.createDataFrame([(10, "T10"), (11, "T11")], "item long, token string")
    got = {r.user_id: tuple(r)[1:] for r in it.itemic_history_prompts(h, cat, 5).collect()}
    assert got == {1: (2, 0, "T10T11", None), 2: (1, 1, "", "T10")}


def test_null_item_is_not_a_target(spark):
    h = spark.createDataFrame([(1, 1, 10), (1, 2, None)], "user_id long, seq long, item long")
    assert {r.seq: r.role for r in hi.next_item_split(h).collect()} == {1: "input", 2: "target"}


def test_events_without_vector_stay(spark):
    h = spark.createDataFrame([(1, 5), (2, 6)], "user_id long, item long")
    e = spark.createDataFrame([(5, [1.0])], "vec_id long, embedding array<double>")
    assert {r.user_id: r.vec for r in hi.embedding_lookup(h, e).collect()} == {1: [1.0], 2: None}


def test_leaderboard_has_every_team(spark):
    acc = spark.range(40).select(F.col("id").alias("team"), (F.col("id") % 12).cast("double").alias("score"))
    rows = ru.leaderboard(acc).collect()
    assert len(rows) == 40 and all(r.rank == 12 - r.best_score for r in rows)


def test_wordless_texts_are_clusters_of_their_own(spark):
    df = spark.createDataFrame([(1, "a b c d e f g"), (2, "  "), (3, "x y z u v w t")], "k long, text string")
    got = {r.k: (r.cluster_id, r.is_duplicate) for r in cu.near_duplicates(df, "k", "text").collect()}
    assert got == {1: (1, False), 2: (2, False), 3: (3, False)}


def test_section_with_text_behind_the_object_is_bad(spark):
    heading = tasks.SECTION_HEADINGS[0][1] + "："
    rows = [("f1", heading + '\n{"t": "x"}'), ("f2", heading + '\n{"t": "x"} trailing note'),
            ("f3", heading + '\n{"t": "x"}{"u": "y"}')]
    out = tasks.parse_sections(spark.createDataFrame(rows, "file string, value string"))
    got = {r.file: r.section_status for r in out.where(F.col("category") == tasks.SECTION_HEADINGS[0][0]).collect()}
    assert got == {"f1": "ok", "f2": "bad_json", "f3": "bad_json"}


def test_replay_keeps_null_and_negative_chunks(spark):
    base = scratch_path(spark, "streams", uuid.uuid4().hex)
    df = spark.createDataFrame([(1, 0), (2, None), (3, -1), (4, 1)], "id long, c int")
    runs = []
    q_streams._replay(spark, df, "c", base, lambda: runs.append(spark.read.parquet(base).count()))
    assert runs == [1, 2, 3, 4]
    assert sorted(r.id for r in spark.read.parquet(base).collect()) == [1, 2, 3, 4]


def test_ingest_keeps_distinct_records_with_equal_text(spark):
    base = scratch_path(spark, "streams", uuid.uuid4().hex)
    line = '{"system": "s", "prompt": "p", "response": "r"}'
    df = spark.createDataFrame([(i, "2024-01-01 00:00:00", line) for i in (1, 2, 3, 3)], "conv_id long, ts string, value string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(f"{base}/in")
    st.stream_ingest(st.file_stream(spark, f"{base}/in", "conv_id long, ts timestamp, value string"),
                     f"{base}/good", f"{base}/bad", f"{base}/ckpt")
    assert sorted(r.conv_id for r in spark.read.parquet(f"{base}/good").collect()) == [1, 2, 3]


def test_clear_is_exact(spark):
    base = scratch_path(spark, "streams", uuid.uuid4().hex)
    spark.createDataFrame([(1, 0, "user", "hello there"), (1, 1, "user", "/CLEAR"), (1, 2, "user", "/clear")],
                          "conv_id long, turn long, role string, text string").write.parquet(f"{base}/in")
    stream = st.file_stream(spark, f"{base}/in", "conv_id long, turn long, role string, text string")
    st.run_to_completion(st.stream_chat_state(stream), f"{base}/out", f"{base}/ckpt")
    assert [r.event for r in spark.read.parquet(f"{base}/out").orderBy("turn").collect()] == ["turn", "turn", "cleared"]


def test_run_metrics_of_two_months(spark, tmp_path):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1, 9)
    rows = [(i % 3, t0 + dt.timedelta(hours=6 * i), float(i)) for i in range(4 * 60)]
    spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, value double").write.parquet(f"{tmp_path}/events.parquet")
    want = {}
    for u, t, v in rows:
        want.setdefault((u, f"{t:%Y-%m-%d} 00:00:00"), []).append(v)
    got = {(r.run, r.window_start): (r.n, r.min_loss, r.mean_loss)
           for r in q_streams.stream_run_metrics(spark, str(tmp_path)).collect()}
    assert got == {k: (len(v), min(v), round(sum(v) / len(v), 6)) for k, v in want.items()}


def test_option_heads_come_in_order(spark):
    rows = [(1, "A.the U.S. army B.J. Smith"), (2, "Who leads the U.S.? A.x B.the U.N. C.D.C. office"), (3, "A.one of the U.S. states"),
            (4, "B.x C.y B.z"), (5, "A."), (6, "A.x\nJ.y"), (7, "")]
    df = spark.createDataFrame(rows, "k long, q string")
    got = {}
    for r in rc.choice_options(df, "k", "q").collect():
        got.setdefault(r.k, {})[r.letter] = r.text
        assert r.n_options >= 1
    assert got == {1: {"A": "the U.S. army", "B": "J. Smith"}, 2: {"A": "x", "B": "the U.N.", "C": "D.C. office"},
                   3: {"A": "one of the U.S. states"}, 4: {"B": "x", "C": "y B.z"}, 5: {"A": ""}, 6: {"A": "x", "J": "y"}}


def test_answers_beyond_h_and_not_offered(spark):
    rows = [("正确答案是 J", ["A", "J"], ["J"]), ("A、K", ["A", "B"], ["A", "K"]), ("AJ", ["A", "J"], ["A", "J"]),
            ("AJ", None, []), ("AB", None, ["A", "B"]), ("Based on JSON: B", ["A", "B"], ["B"]), ("I think B", ["B", "I"], ["B"]),
            ("I", ["H", "I"], ["I"]), ("", ["A"], []), (None, ["A"], None)]
    df = spark.createDataFrame([(i, t, o) for i, (t, o, _) in enumerate(rows)], "k long, t string, o array<string>")
    for r in df.select("k", ev.extract_options("t", F.col("o")).alias("x")).collect():
        assert r.x == rows[r.k][2] or rows[r.k][1] is None
    for r in df.where("o is null").select("k", ev.extract_options("t").alias("x")).collect():
        assert r.x == rows[r.k][2]


def test_only_the_user_clears(spark):
    turns = [(1, 1, "system", "s"), (1, 2, "user", "hi"), (1, 3, "assistant", "/clear"), (1, 4, "user", " /clear "), (1, 5, "user", "new")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.segment: r.n_turns for r in cm.context_segments(df).collect()}
    assert got == {0: 3, 1: 2}


def test_a_generation_run_is_replaced(spark):
    path = scratch_path(spark, "generations", uuid.uuid4().hex)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "prompt_id long, response string")
    tasks.store_generations(rows, path, "r1")
    tasks.store_generations(rows, path, "r2")
    tasks.store_generations(rows.limit(1), path, "r1")
    assert sorted(r.run for r in spark.read.parquet(path).collect()) == ["r1", "r2", "r2"]
