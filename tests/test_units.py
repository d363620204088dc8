"""Operator unit tests on small literals: uploads, chat commands, token
arrays, score tables, phases, and the itemic token parser."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from loomis.operators import chatml as cm
from loomis.operators import itemic as it
from loomis.operators import runs as ru
from loomis.operators import sampling as sa
from loomis.operators import tokens as tk
from loomis.session import scratch_path
from loomis.sources import tasks as src
from loomis.streaming import streams as st


# ---------------------------------------------------------------- S2
def test_jsonl_and_csv_uploads(spark):
    base = scratch_path(spark, "test_ingest", uuid.uuid4().hex)
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/a.jsonl", "w") as f:
        f.write('{"system": "s", "prompt": "line1\\nline2, \\"q\\"", "response": "r"}\n')
        f.write('{"system": "s", "prompt": "p"}\n')
        f.write('this is not json\n')
    with open(f"{base}/b.csv", "w") as f:
        f.write('system,prompt,response\n')
        f.write('s,"multi\nline, with ""quotes""",r\n')
        f.write('s,p,\n')
    j = src.read_sft_records(spark, f"{base}/a.jsonl", "json").withColumn("reason", src.sft_reject_reason()).collect()
    assert j[0]["prompt"] == 'line1\nline2, "q"' and j[0]["reason"] is None
    assert j[1]["reason"] == "missing_response"
    assert j[2]["reason"] == "corrupt"
    c = src.read_sft_records(spark, f"{base}/b.csv", "csv").withColumn("reason", src.sft_reject_reason()).collect()
    assert c[0]["prompt"] == 'multi\nline, with "quotes"' and c[0]["reason"] is None
    assert c[1]["reason"] == "missing_response"


# ---------------------------------------------------------------- R1
def test_chat_commands_stream(spark):
    rows = [(1, 0, "system", "你是一个推荐系统助手。"), (1, 1, "user", "  "), (1, 2, "user", "/len"),
            (1, 3, "user", "hello there"), (1, 4, "assistant", "hi"), (1, 5, "user", "/clear"),
            (1, 6, "user", "/clear"), (1, 7, "user", "again"), (1, 8, "user", "QUIT"), (1, 9, "user", "ignored")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    base = scratch_path(spark, "test_chat", uuid.uuid4().hex)
    df.coalesce(1).write.parquet(f"{base}/in")  # one file: arrival order is the turn order
    stream = st.file_stream(spark, f"{base}/in", "conv_id long, turn long, role string, text string")
    st.run_to_completion(st.stream_chat_state(stream), f"{base}/out", f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/out").orderBy("turn").collect()
    ev = [(r["turn"], r["event"]) for r in out]
    assert ev == [(0, "turn"), (2, "len"), (3, "turn"), (4, "turn"), (5, "cleared"), (6, "cleared"), (7, "turn"),
                  (8, "closed")]
    by = {r["turn"]: r for r in out}
    assert by[2]["context_tokens"] == by[0]["context_tokens"]          # /len before any user turn
    assert by[5]["context_tokens"] == by[0]["turn_tokens"]             # /clear keeps the system turn
    assert by[7]["context_tokens"] == by[0]["turn_tokens"] + by[7]["turn_tokens"]


# ---------------------------------------------------------------- X3 / X4 / X5
def test_mask_labels_cases(spark):
    M = [7, 8]
    cases = [([], "empty"), ([7], "shorter"), ([1, 2, 3], "absent"), ([7, 8, 5, 6], "start"),
             ([1, 2, 7, 8], "end"), ([1, 7, 8, 5, 9, 7, 8, 6, 9], "twice")]
    df = spark.createDataFrame([(n, ids) for ids, n in cases], "name string, ids array<bigint>")
    first = {r["name"]: r["labels"] for r in tk.mask_labels(df, "ids", M, mode="first").collect()}
    assert first["empty"] == [] and first["shorter"] == [-100]
    assert first["absent"] == [-100] * 3
    assert first["start"] == [-100, -100, 5, 6]
    assert first["end"] == [-100] * 4
    assert first["twice"] == [-100, -100, -100, 5, 9, 7, 8, 6, 9]       # first marker only (reference rule)
    only = {r["name"]: r["labels"] for r in tk.mask_labels(df, "ids", M, end_id=9, mode="assistant_only").collect()}
    assert only["twice"] == [-100, -100, -100, 5, 9, -100, -100, 6, 9]


def test_truncate_and_pad(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4, 5]), (2, [6]), (3, [])], "k long, ids array<bigint>")
    t = {r["k"]: r for r in tk.truncate_tokens(df, ["ids"], 3).collect()}
    assert t[1]["ids"] == [1, 2, 3] and t[1]["n_cut"] == 2 and t[2]["n_cut"] == 0
    p = tk.pad_batches(df, "k", "ids", 2, 0, side="left", bucket=[F.lit(0)]).collect()
    for r in p:
        assert len(r["input_ids"]) == len(r["attention_mask"]) == r["batch_len"]
        assert r["n_pad"] + r["n_real"] == r["batch_len"]
        assert sum(r["attention_mask"]) == r["n_real"]
    right = {r["k"]: r for r in tk.pad_batches(df, "k", "ids", 3, 0, side="right", bucket=[F.lit(0)]).collect()}
    assert right[2]["input_ids"] == [6, 0, 0, 0, 0] and right[2]["attention_mask"] == [1, 0, 0, 0, 0]


def test_encode_decode_roundtrip(spark):
    texts = [(1, "推荐 a<|im_start|>user\nHello, world! <|video_begin|><s_a_1><s_b_2><s_c_3>"), (2, ""), (3, "Étion ß")]
    df = spark.createDataFrame(texts, "k long, text string")
    voc = tk.build_vocab(df, "text")
    assert [r["token"] for r in voc.filter("id < 5").orderBy("id").collect()] == tk.SPECIAL_TOKENS
    enc = tk.encode(df, "k", "text", voc)
    dec = {r["k"]: r["decoded"] for r in tk.decode(enc, "k", "ids", voc).collect()}
    assert dec[1] == "推荐a<|im_start|>userHello,world!<|video_begin|><s_a_1><s_b_2><s_c_3>"
    assert dec[2] == "" and dec[3] == "Étionß"
    dec2 = {r["k"]: r["decoded"] for r in tk.decode(enc, "k", "ids", voc, skip_special=True).collect()}
    assert "<|im_start|>" not in dec2[1]


# ---------------------------------------------------------------- G1-G4, T2
def test_score_tables(spark):
    rows = [(1, 10, 1000.0), (1, 11, 1000.0), (1, 12, -1000.0), (2, 20, 5.0), (3, 30, 50.0), (3, 31, 1.0)]
    lg = spark.createDataFrame(rows, "prompt_id long, token long, logit double")
    p = {(r["prompt_id"], r["token"]): r["prob"] for r in sa.apply_temperature(lg, 0.7).collect()}
    assert abs(p[(1, 10)] - 0.5) < 1e-12 and p[(1, 12)] == 0.0 and p[(2, 20)] == 1.0   # overflow-safe
    k = sa.filter_top_k(sa.apply_temperature(lg, 1.0), 1).collect()
    assert {(r["prompt_id"], r["token"]) for r in k} == {(1, 10), (2, 20), (3, 30)}   # ties → smaller token
    tp = sa.filter_top_p(sa.apply_temperature(lg, 1.0), 0.9).collect()
    assert {(r["prompt_id"], r["token"]) for r in tp} == {(1, 10), (1, 11), (2, 20), (3, 30)}
    g = {r["prompt_id"]: r["token"] for r in sa.greedy_tokens(lg).collect()}
    assert g == {1: 10, 2: 20, 3: 30}
    s1 = sorted(tuple(r) for r in sa.sample_tokens(lg, 8, 1.0, 7).collect())
    s2 = sorted(tuple(r) for r in sa.sample_tokens(lg.repartition(3), 8, 1.0, 7).collect())
    assert s1 == s2 and len(s1) == 24


# ---------------------------------------------------------------- J6
def test_phase_boundaries(spark):
    phases = spark.createDataFrame([("p1", dt.date(2024, 1, 1), dt.date(2024, 1, 2)),
                                    ("p2", dt.date(2024, 1, 4), dt.date(2024, 1, 5))],
                                   "phase string, start date, end date")
    sub = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 23, 59)), (2, dt.datetime(2024, 1, 3, 12)),
                                 (3, dt.datetime(2024, 1, 4, 0, 0)), (4, dt.datetime(2024, 1, 9))],
                                "id long, ts timestamp")
    got = {r["id"]: r["phase"] for r in ru.submissions_by_phase(sub, phases).collect()}
    assert got == {1: "p1", 2: "none", 3: "p2", 4: "none"}


# ---------------------------------------------------------------- X6 / X7
def test_itemic_parse_and_validate(spark):
    text = ("<|video_begin|><s_a_0><s_b_8191><s_c_5>x<|ad_begin|><s_a_8192><s_b_1><s_c_2>"
            "<|music_begin|><s_a_1><s_b_1><s_c_1><|prod_begin|><s_a_1><s_b_2><|sid_begin|><s_a_1><s_b_2><s_c_3>")
    df = spark.createDataFrame([(1, "src", text), (2, "src", "no tokens")], "k long, source string, text string")
    occ = it.itemic_occurrences(df, "k", "text").orderBy("pos").collect()
    assert [(r["domain"], r["a"]) for r in occ] == [("video", 0), ("ad", 8192), ("music", 1), ("sid", 1)]
    v = it.itemic_validate(df, "text", ["source"]).collect()[0]
    assert (v["n_tokens"], v["n_malformed"], v["n_out_of_range"], v["n_unknown_domain"]) == (5, 1, 1, 1)


def test_split_thinking(spark):
    rs = [(1, "<think>\nreason\n</think>\n\nanswer"), (2, "<think>\n\n</think>\n\nanswer"), (3, "answer"),
          (4, "<think>cut off")]
    df = spark.createDataFrame(rs, "k long, response string")
    got = {r["k"]: (r["mode"], r["think_text"], r["final_text"]) for r in cm.split_thinking(df).collect()}
    assert got == {1: ("thinking", "reason", "answer"), 2: ("non_thinking", "", "answer"),
                   3: ("non_thinking", "", "answer"), 4: ("thinking", "cut off", "")}


def test_batch_generate_generator_contract(spark):
    df = spark.createDataFrame([(i, "p" * i, "greedy") for i in range(1, 9)], "prompt_id long, prompt string, strategy string")
    out = sa.batch_generate(df, batch_size=3).toPandas()
    assert len(out) == 8 and out["response"].str.match(r"^<\|[a-z]+_begin\|>").all()
    assert (out["n_pad_chars"] >= 0).all()
