"""Findings of round 3 on size: vocabularies beyond the shipped limit, tasks
sized by the input."""

import random
import tempfile

from pyspark.sql import functions as F

from loomis.operators import sampling, similarity, tokenizer
from loomis.operators import tokens as tk
from loomis.plans import bindings, sequence


def test_large_vocabulary_ships_its_head(spark, monkeypatch):
    """Beyond the limit only the rare tokens of a row are joined; the rows stay
    what they are below it, with repeated and null keys."""
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(3000)] + ["你", "é", "<|im_end|>"]
    rows = [(i % 50 if i % 7 else None, " ".join(rnd.choice(words if rnd.random() < 0.5 else words[:20]) for _ in range(rnd.randrange(60))))
            for i in range(200)] + [(1, None), (2, ""), (2, "")]
    docs = spark.createDataFrame(rows, "k long, text string")
    full = tk.build_vocab(docs)
    for vocab in (full, full.where("id % 11 <> 3")):
        assert tokenizer.vocabulary_bytes(vocab) > 60000 and tokenizer.head_end(vocab, 60000) > 20
        out = []
        for limit in (tokenizer.LIMIT_BYTES, 60000):
            enc = tk.encode_corpus(docs, "k", "text", vocab, limit=limit)
            dec = tk.decode_corpus(enc, "k", "ids", vocab, limit=limit, skip_special=True, sep=" ")
            out.append(sorted(map(str, dec.collect())))
        assert len(out[0]) == 203 and out[0] == out[1]
    monkeypatch.setattr(tk, "encode", None)         # not the form that joins every token
    assert tk.encode_corpus(docs, "k", "text", full, limit=60000).where(F.exists("ids", lambda x: x < 0)).count() == 0


def test_score_tables_have_tasks_by_the_lines(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="scores-", dir="/tmp")
    rows = [(k, t, 100.0 * t) for k in (None, *range(40)) for t in (1, 2, 2)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_extendedprice double").coalesce(1) \
        .write.parquet(f"{base}/lineitem.parquet")
    monkeypatch.setattr(sequence, "ROWS_PER_TASK", 13)
    logits = bindings.logits(spark, base)
    assert logits.rdd.getNumPartitions() == 10
    assert {(r.prompt_id, r.token, r.logit) for r in logits.collect()} == {(k, t, 0.01 if t == 1 else 0.04) for k, t, _ in rows}
    draws = sampling.sample_tokens(logits, 4)
    assert draws.rdd.getNumPartitions() == 10 and draws.count() == 41 * 4


def test_texts_of_one_row_group_are_dealt(spark, monkeypatch):
    rows = [(i % 30, f"a b c d e f g h i j k l m n o p {i % 40} q r s t u v w x y z") for i in range(80)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    seen = []
    real = similarity.memberships

    def members(df, *args):
        seen.append(df.where("doc_id is not null").select(F.spark_partition_id()).distinct().count())
        return real(df, *args)
    monkeypatch.setattr(similarity, "memberships", members)
    out = similarity.near_groups(docs, "doc_id", "text").collect()
    assert len(out) == 81 and seen[0] > 1
    assert sequence.spread(docs).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
