"""Sectioned task files (S1) and the raw-record chain (P1, P2, P3) on literal
fixtures shaped after the task-file parser's rules."""

import json

from pyspark.sql import functions as F

from loomis.operators import records as rc
from loomis.sources.tasks import parse_sections


def _msgs(text):
    return [{"role": "system", "content": "sys"}, {"role": "user", "content": text}]


def _task(text, answer="ok", as_string=False):
    m = _msgs(text)
    return {"messages": json.dumps(m, ensure_ascii=False) if as_string else m,
            "metadata": {"answer": answer}}


SAMPLE = "".join([
    "这是一个样例文件，标题前的文字会被忽略。\n",
    "物料数据示例：", json.dumps({k: _task(k) for k in ["video_itemic_pattern", "video", "live", "product", "Ad"]},
                              ensure_ascii=False), "\n",
    "用户数据示例:", json.dumps({"Topic": _task("t"), "Logic": {"messages": _msgs("l"), "metadata": json.dumps(
        {"answer": {"chain": ["a", "b"], "check": True}}, ensure_ascii=False)}}, ensure_ascii=False), "\n",
    "推荐数据示例：", json.dumps({k: _task(k, as_string=True) for k in ["video", "live", "Product", "Ad"]},
                              ensure_ascii=False), "\n",
    "世界知识数据示例：", json.dumps({"single": _task("q", "B"), "multi": _task("q", "A、C")}, ensure_ascii=False),
])

REPEAT = "物料数据示例：" + json.dumps({"a": _task("x")}) + "\n物料数据示例：" + json.dumps({"b": _task("y")})
BROKEN = ("用户数据示例：" + json.dumps({"u": _task("u")}) + "\n推荐数据示例：\n世界知识数据示例：{\"single\": {\"messages\": [")
DUPKEY = '世界知识数据示例：{"x": {"messages": [{"role": "user", "content": "1"}], "metadata": {"answer": "first"}}, ' \
         '"x": {"messages": [{"role": "user", "content": "2"}], "metadata": {"answer": "last"}}}'


def _parse(spark, text):
    df = spark.createDataFrame([("f", text)], "file string, value string")
    return parse_sections(df)


def test_sample_counts(spark):
    p = _parse(spark, SAMPLE)
    ok = p.filter("section_status = 'ok'")
    counts = {r["category"]: r["n"] for r in ok.groupBy("category").agg(F.count("*").alias("n")).collect()}
    assert counts == {"物料": 5, "用户": 2, "推荐": 4, "世界": 2}
    assert ok.select("task").distinct().count() == 10
    assert ok.select("category", "task").distinct().count() == 13
    names = {r[0] for r in ok.select("task").collect()}
    assert "product" in names and "Product" in names


def test_messages_and_answers(spark):
    p = rc.extract_answers(rc.normalize_messages(_parse(spark, SAMPLE).filter("section_status = 'ok'")))
    rows = {(r["category"], r["task"]): r for r in p.collect()}
    assert rows[("推荐", "video")]["messages_type"] == "json_string"
    assert rows[("物料", "video")]["messages_type"] == "list"
    assert rows[("推荐", "video")]["messages"][1]["content"] == "video"
    logic = rows[("用户", "Logic")]
    assert logic["answer_type"] == "nested"
    assert logic["answer"] == '{"chain":["a","b"],"check":true}'  # key order kept, compact
    assert rows[("世界", "multi")]["answer"] == "A、C"


def test_repeated_heading_reads_first_section_only(spark):
    ok = _parse(spark, REPEAT).filter("section_status = 'ok'")
    assert [r["task"] for r in ok.collect()] == ["a"]


def test_missing_empty_and_broken_sections(spark):
    st = {r["category"]: r["section_status"] for r in _parse(spark, BROKEN).select("category", "section_status")
          .distinct().collect()}
    assert st == {"物料": "missing", "用户": "ok", "推荐": "empty", "世界": "bad_json"}


def test_duplicate_task_key_keeps_last(spark):
    p = rc.extract_answers(rc.normalize_messages(_parse(spark, DUPKEY).filter("section_status = 'ok'")))
    r = p.collect()
    assert len(r) == 1 and r[0]["answer"] == "last"


def test_reject_reasons_in_rule_order(spark):
    bodies = [
        ("no_msgs", {"metadata": {"answer": "a"}}),
        ("bad_json", {"messages": "[{\"role\": ", "metadata": {"answer": "a"}}),
        ("number", {"messages": 42, "metadata": {"answer": "a"}}),
        ("bad_meta", {"messages": [{"role": "user", "content": "x"}], "metadata": "[1, 2]"}),
        ("no_answer", {"messages": [{"role": "user", "content": "x"}], "metadata": {"answer": ""}}),
        ("zero", {"messages": [{"role": "user", "content": "x"}], "metadata": {"answer": 0}}),
        ("string_zero", {"messages": [{"role": "user", "content": "x"}], "metadata": {"answer": "0"}}),
        ("bare", {"messages": [{"role": "user", "content": "x"}], "metadata": "plain answer"}),
        ("json_string_meta", {"messages": [{"role": "user", "content": "x"}], "metadata": "{\"answer\": \"s\"}"}),
        ("blocks", {"messages": [{"role": "user", "content": [{"type": "text", "text": "p1"},
                                                               {"type": "image", "url": "u"},
                                                               {"type": "text", "text": "p2"}]},
                                 {"role": "user"}, {"role": "user", "content": "[not a list]"}],
                    "metadata": {"answer": "ok"}}),
    ]
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in bodies], "task string, body_text string") \
              .withColumn("body", F.try_parse_json("body_text")).withColumn("section_status", F.lit("ok"))
    p = rc.extract_answers(rc.normalize_messages(df))
    good, bad = rc.quarantine_rejects(p, rc.reject_reason(p))
    reasons = {r["task"]: r["reason"] for r in bad.collect()}
    assert reasons == {"no_msgs": "no_messages", "bad_json": "bad_messages_json", "number": "bad_messages_type",
                       "bad_meta": "bad_metadata", "no_answer": "no_answer", "zero": "no_answer"}
    g = {r["task"]: r for r in good.collect()}
    assert set(g) == {"string_zero", "bare", "json_string_meta", "blocks"}
    assert g["bare"]["answer"] == "plain answer" and g["bare"]["answer_type"] == "bare"
    assert g["json_string_meta"]["answer"] == "s"
    m = g["blocks"]["messages"]
    assert m[0]["content"] == "p1\np2" and m[1]["content"] == "" and m[2]["content"] == "[not a list]"
    assert good.count() + bad.count() == len(bodies)
