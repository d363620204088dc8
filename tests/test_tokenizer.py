"""Tokenizer plug-ins: the trie against dictionaries, the narrow pass against
the join form, and the plans."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomis.functions.text import tokens
from loomis.operators import tokenizer as tz
from loomis.operators import tokens as tk


def words_of(rng, n):
    return [bytes(rng.choice(b"abcdef\xc3\xa9\xff\x00") for _ in range(rng.randrange(1, 9))) for _ in range(n)]


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_trie_is_a_dictionary(n):
    rng = random.Random(n)
    words = words_of(rng, n)
    want = {}
    for i, w in enumerate(words):
        want.setdefault(w, i)
    trie = tz.DoubleArray.build(words, range(n))
    asked = words + words_of(rng, 500) + [b"", b"\xff" * 40]
    assert trie.lookup(asked).tolist() == [want.get(w, -1) for w in asked]
    used = np.flatnonzero(trie.check >= 0)
    # No two nodes share a slot: a slot names the one parent whose child it is.
    assert all(0 <= u - trie.base[trie.check[u]] < 256 for u in used.tolist())


def test_longest_match():
    rng = random.Random(1)
    words = list(set(words_of(rng, 400)))
    trie = tz.DoubleArray.build(words, range(len(words)))
    have = {w: i for i, w in enumerate(words)}
    text = b"".join(words_of(rng, 300))
    size, ids = trie.longest(text)
    for i in range(len(text)):
        best = max((w for w in have if text.startswith(w, i)), key=len, default=b"")
        assert (size[i], ids[i]) == (len(best), have.get(best, -1))


def test_greedy_cut_and_unknown_characters():
    trie = tz.DoubleArray.build([b"a", b"ab", b"abc", "é".encode(), b"ab"], [5, 6, 7, 8, 2])
    t = tz.TrieTokenizer(trie, unknown_id=-7, pre_token=None)
    assert [x.tolist() for x in t(["abcab", "éxa日b", "", None])] == [[7, 2], [8, -7, 5, -7, -7], [], []]


TEXTS = [None, "", " ", "the cat <|im_start|>user\nthe <s_a_12> 日本語 naïve", "x" * 5000, "a b " * 4000, "\x0b\x0c\t!?",
         "a\u00a0b\u2003c \u0085 \x1c", "Ünïcode—dash 𝔘 😀 </think><think>", "the the the"]


def texts_frame(spark, extra=()):
    rows = [(i, t, -1, "x") for i, t in enumerate([*TEXTS, *extra])]
    return spark.createDataFrame(rows, "k long, text string, id long, token string").repartition(3)


def test_narrow_ids_equal_the_join_form(spark):
    df = texts_frame(spark)
    vocab = tk.build_vocab(df.where("k % 3 <> 1"), "text")
    want = {r.k: r.ids for r in tk.encode(df, "k", "text", vocab).collect()}
    trie = tz.tokenizer_for(vocab)
    enc = tz.encode_with(df, "text", trie)
    assert enc.columns == [*df.columns, "ids"]
    got = {r.k: r.ids for r in enc.collect()}
    assert {k: v or [] for k, v in want.items()} == got
    assert any(-1 in v for v in got.values())
    assert "Exchange" not in tz.encode_with(spark.range(1).select(F.lit("a b").alias("text")), "text", trie) \
        ._jdf.queryExecution().executedPlan().toString()


def test_pre_tokens_equal_the_jvm_pattern(spark):
    df = texts_frame(spark, ["".join(chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000)])
    for r in df.select("text", tokens("text").alias("t")).collect():
        assert (r.t or []) == (tz.PRE_TOKEN.findall(r.text) if r.text else [])


def test_vocabulary_beyond_the_limit_is_not_shipped(spark):
    df = texts_frame(spark)
    vocab = tk.build_vocab(df, "text")
    assert tz.tokenizer_for(vocab, limit=1000) is None
    assert tz.decode_with(df, "text", vocab, limit=1000) is None
    joined = tk.encode_corpus(df, "k", "text", vocab, limit=1000).select("k", "ids")
    narrow = tk.encode_corpus(df, "k", "text", vocab).select("k", "ids")
    assert sorted((r.k, tuple(r.ids or ())) for r in joined.collect()) == sorted((r.k, tuple(r.ids)) for r in narrow.collect())


def test_any_callable_is_a_tokenizer(spark):
    lengths = tz.encode_with(texts_frame(spark), "text", lambda ts: [[len(w) for w in (t or "").split()] for t in ts], "n")
    assert {r.k: r.n for r in lengths.collect()}[9] == [3, 3, 3]


def test_decode_marks_unknown_ids(spark):
    vocab = spark.createDataFrame([("a", 0), ("b", 2), ("<|im_end|>", 3), (None, 4)], "token string, id long")
    df = spark.createDataFrame([(1, [0, 99, 2, 3]), (2, []), (3, None), (4, [-1])], "k long, ids array<long>")
    got = {r.k: r.decoded for r in tz.decode_with(df, "ids", vocab).collect()}
    assert got == {1: "a\ufffdb<|im_end|>", 2: "", 3: None, 4: "\ufffd"}
    cut = tz.decode_with(df, "ids", vocab, skip=F.col("token").rlike(r"^<\|"))
    assert {r.k: r.decoded for r in cut.collect()}[1] == "a\ufffdb"
    joined = {r.k: r.decoded for r in tk.decode(df, "k", "ids", vocab).collect()}
    assert joined[1] == "a\ufffdb<|im_end|>" and joined[4] == "\ufffd"
    assert re.fullmatch(".", tz.UNKNOWN_TEXT)


def test_round_trip(spark):
    df = texts_frame(spark)
    vocab = tk.build_vocab(df, "text")
    enc = tz.encode_with(df, "text", tz.tokenizer_for(vocab))
    dec = tz.decode_with(enc, "ids", vocab)
    for r in dec.collect():
        assert r.decoded == re.sub(r"\s", "", r.text or "", flags=re.ASCII)


def test_labels_from_spans_equal_token_by_token_masks(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([1, 2, 3, 9]) for _ in range(rng.choice([0, 1, 2, 3, 12, 60]))]) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, ids array<long>")
    m = tk.mask_labels(df, "ids", [1, 2], mode="first", out="first")
    m = tk.mask_labels(m, "ids", [1, 2], end_id=9, mode="assistant_only", out="only")
    for r in m.collect():
        ids = r.ids
        starts = [i for i in range(len(ids) - 1) if ids[i:i + 2] == [1, 2]]
        assert r.first == [x if starts and i >= starts[0] + 2 else -100 for i, x in enumerate(ids)]
        want = []
        for i, x in enumerate(ids):
            s = max((q for q in starts if q + 2 <= i), default=None)
            e = max((q for q in range(i) if ids[q] == 9), default=-1)
            want.append(x if s is not None and e < s else -100)
        assert r.only == want, ids
