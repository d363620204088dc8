"""The pipeline's stages against a brute-force version on a small table."""

import random
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from test_small_ops import WORD, brute_fp, brute_leaks
from tokenizers import Tokenizer

import corpus_pipeline
from loomis.llm.quality import quality_rules


def make(spark, path):
    rng = random.Random(17)
    v = [f"{a}{b}" for a in ("tor", "mel", "Kas", "win", "dor") for b in range(60)]
    item = " ".join(rng.choice(v) for _ in range(14))
    rows = []
    for i in range(160):
        t = " ".join(rng.choice(v) for _ in range(rng.randrange(25, 120)))
        if i % 20 == 3:
            t = " ".join(w + "###" for w in t.split())
        if i % 20 == 5:
            t += " " + item
        if i % 20 == 7:
            t = rows[-1][1]
        if i % 40 == 9:
            t = "too short"
        rows.append((i, t, "en", f"s{i % 4}", len(t)))
    rows += [(160, None, None, None, 0), (161, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows, item


def test_stages(spark, tmp_path):
    rows, item = make(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    text = {r[0]: r[1] for r in rows}
    q = corpus_pipeline.quality_stage(spark, docs, str(tmp_path))
    assert q.columns == docs.columns
    kept = {r.doc_id for r in q.collect()}
    assert kept == {r.doc_id for r in quality_rules(docs).where("kept").collect()}
    assert not kept & {i for i in text if i % 20 == 3 or i % 40 == 9 or i > 159} and len(kept) > 120
    n = corpus_pipeline.near_duplicate_stage(spark, q, str(tmp_path))
    fps = {i: brute_fp(text[i]) for i in kept}
    par = {i: i for i in kept}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    for i in kept:
        for j in kept:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                par[b] = a
    one = {i for i in kept if find(i) == i}
    assert sorted(r.doc_id for r in n.collect()) == sorted(one)
    d = corpus_pipeline.decontamination_stage(spark, n, str(tmp_path))
    order = sorted(one)
    clean = {i for i, r in zip(order, brute_leaks([text[i] for i in order], [(0, item)])) if not r[-1]}
    assert {r.doc_id for r in d.collect()} == clean
    m = corpus_pipeline.mixing_stage(spark, d, str(tmp_path)).collect()
    per = Counter()
    for r in m:
        assert r.text == text[r.doc_id]
        per[r.source] += len(WORD.findall(r.text))
    total = Counter()
    for i in clean:
        total[f"s{i % 4}"] += len(WORD.findall(text[i]))
    weights = {"s0": 5, "s1": 2, "s2": 1, "s3": 5}
    assert max(Counter(r.doc_id for r in m).values()) <= 2
    left, free, target = 1.5 * sum(total.values()), set(total), {}
    while free:
        share = {s: (left - sum(target.values())) * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * total[s]] or list(free)
        target |= {s: min(share[s], 2.0 * total[s]) for s in over}
        free -= set(over)
    for s in total:
        assert abs(per[s] - target[s]) <= 0.05 * target[s] + 30
    out = corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r.doc_id, len(lib.encode(r.text, add_special_tokens=False).ids) + 1) for r in m)
    assert Counter((r.doc_id, r.n_tokens) for r in out) == want
    assert [r.start for r in out] == [sum(x.n_tokens for x in out[:i]) for i in range(len(out))]


def test_empty_documents(spark, tmp_path):
    make(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.agg(F.count("*")).first()[0] == 0


def test_null_and_repeated_ids(spark, tmp_path):
    # Different texts without an id or with one id are documents of their own in every stage.
    make(spark, str(tmp_path))
    rng = random.Random(23)
    v = [f"{a}{b}" for a in ("tor", "mel", "Kas", "win", "dor") for b in range(60)]
    item = spark.read.parquet(f"{tmp_path}/benchmark.parquet").where("item_id = 0").first().text
    rows, bad, leaky = [], [], []
    for i, d in [(i, d) for d in (None, 7, 8) for i in range(20)]:
        t = " ".join(rng.choice(v) for _ in range(60))
        rows.append((d, t, "en", f"s{i % 4}", len(t)))
    for d in (None, 7):
        bad.append((d, "too short", "en", "s1", 9))
        t = rows[0][1][:120] + f" {item} " + rows[1][1][:120]
        leaky.append((d, t, "en", "s1", len(t)))
    copies = [(None, *rows[25][1:]), rows[45], rows[3]]  # of a row with id 7, one with id 8, one without id

    def docs(rs):
        return spark.createDataFrame(rs, "doc_id long, text string, lang string, source string, n_chars long")

    def after(stage, rs):
        return Counter(map(tuple, stage(spark, docs(rs), str(tmp_path)).collect()))
    want = Counter(rows)
    assert after(corpus_pipeline.quality_stage, rows + bad) == want
    assert after(corpus_pipeline.decontamination_stage, rows + leaky) == want
    assert after(corpus_pipeline.near_duplicate_stage, rows + copies) == want
    assert after(corpus_pipeline.near_duplicate_stage, (rows + copies)[::-1]) == want
    mixed = after(corpus_pipeline.mixing_stage, rows)
    assert set(mixed) <= want.keys() and max(mixed.values()) <= 2
    twice = after(corpus_pipeline.mixing_stage, rows + rows)
    assert set(twice) <= want.keys() and max(twice.values()) <= 4
    words = 60 * sum(mixed.values())
    assert words <= 1.5 * 60 * len(rows) + 60 * 4 and sum(twice.values()) > 1.6 * sum(mixed.values())
