"""Brute-force checks of token counts, quality rules, SimHash, decontamination
and mixing on awkward documents."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from loomis.llm import quality
from loomis.llm.decontaminate import char_spans, decontaminate, verdicts
from loomis.llm.mixing import mix
from loomis.llm.quality import quality_rules
from loomis.llm.simhash import simhash_groups
from loomis.llm.tokencount import count_texts, load_model, split_safely, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, fp string, w string"


def docs_of(spark, texts, lang="en", sources=("a", "b", None)):
    """Documents with extra columns whose names clash with inner ones."""
    rows = [(i, t, lang, sources[i % len(sources)], 0, -1, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def sample_texts(seed=0, n=60):
    rng = random.Random(seed)
    vocab = ["alpha", "Béta", "gamma,", "délta", "x y", "eps", "zeta.", "ETA", "##", "&&&", "theta"]
    out = [None, "", "   ", "one", "two words", "\n\n", "a b c", "same same " * 30]
    while len(out) < n:
        t = " ".join(rng.choice(vocab) + rng.choice(["", "s", "1"]) for _ in range(rng.randrange(1, 120)))
        out.append(t)
        if rng.random() < 0.4:  # near copy
            w = t.split(" ")
            w[rng.randrange(len(w))] = "changed"
            out.append(" ".join(w))
        if rng.random() < 0.2:
            out.append(t)
        if rng.random() < 0.2:
            out.append(t + "\n" + t + "\n" + t)
    return out


def test_token_counts(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = sample_texts(1) + ["long text here " * 9000, "x" * 70000, "<s> a </s>  double  space\ttab", "日本語 テキスト"]
    got = {r.doc_id: r for r in token_counts(docs_of(spark, texts), path).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n = len(sp.encode(t or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 4096)


def test_safe_splits_keep_counts():
    model = load_model(public_tokenizers.path("piece_bpe_32k.model"))
    t = " ".join(x or "" for x in sample_texts(2, 200))
    assert len(split_safely(t, 50)) > 20
    assert count_texts(model, [t], piece=50, batch=200)[0] == len(model.encode(t))


def brute_quality(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = {i + k for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for k in range(8)}
    return (len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(rep))


def test_quality_base_and_adaptive(spark):
    texts = sample_texts(3, 150)
    got = {r.doc_id: r for r in quality_rules(docs_of(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r, b = got[i], brute_quality(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        assert r.base_failed == (b[0] < 20 or 100 * b[4] > 30 * b[0])
        assert not (r.base_failed and r.kept)


def test_quality_outliers_go_and_clean_stay(spark):
    rng = random.Random(5)
    clean = [" ".join(rng.choice(["word", "other", "thing", "place"]) + str(rng.randrange(999)) for _ in range(80))
             for _ in range(300)]
    junk = [" ".join(f"w{rng.randrange(999)}###" for _ in range(80)) for _ in range(30)]
    got = {r.doc_id: r.kept for r in quality_rules(docs_of(spark, clean + junk)).collect()}
    assert all(got[i] for i in range(300)) and not any(got[i] for i in range(300, 330))


def test_sketches_merge(spark):
    d = spark.range(5000).selectExpr("cast(id % 3 as string) q_lang", "cast(id % 7 as string) q_source", "id * id as v")
    fine = quality.sketch(d, ("q_lang", "q_source"), ("v",))
    merged = {tuple(r) for r in quality.merge(fine, ("q_lang",)).collect()}
    assert merged == {tuple(r) for r in quality.sketch(d, ("q_lang",), ("v",)).collect()}
    q = quality.quantiles(fine, ("q_lang", "q_source")).where("q_lang = '1' and q_source = '4'").first()
    exact = sorted(i * i for i in range(5000) if i % 3 == 1 and i % 7 == 4)
    for have, want in ((q.q10, exact[len(exact) // 10]), (q.q50, exact[len(exact) // 2])):
        assert want * (1 - 1 / 16) <= have <= want * (1 + 1 / 16)


def brute_fp(text):
    words = [w.encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))) for w in WORD.findall(text or "")]
    if not words:
        return 0
    sh = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(spark):
    texts = sample_texts(4, 160)
    rng = random.Random(9)
    long = [f"t{rng.randrange(10**6)}" for _ in range(400)]
    for _ in range(120):  # a large group of near copies
        w = list(long)
        w[rng.randrange(len(w))] = "edit"
        texts.append(" ".join(w))
    got = {r.doc_id: r for r in simhash_groups(docs_of(spark, texts)).collect()}
    fps = [brute_fp(t) for t in texts]
    par = list(range(len(texts)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                par[b] = a
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert got[i].fingerprint == f"{fps[i]:016x}"
        assert got[i].component_id == find(i)


NWORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_leaks(texts, items):
    def words(t):
        return NWORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    wins = defaultdict(set)
    for i, t in items:
        w = words(t)
        for j in range(max(1, len(w) - 9) if w else 0):
            wins[tuple(w[j:j + 10])].add(str(i))
    out = []
    for t in texts:
        w = words(t)
        hit, ids = set(), set()
        for n in {len(x) for x in wins}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in wins:
                    hit |= set(range(j, j + n))
                    ids |= wins[tuple(w[j:j + n])]
        out.append((len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("shard", [4 << 20, 300])
def test_decontamination(spark, shard):
    rng = random.Random(7)
    v = [f"w{i}" for i in range(40)] + ["Élan", "ÀB"]
    items = [(i, " ".join(rng.choice(v) for _ in range(rng.choice([3, 9, 10, 14, 25])))) for i in range(12)]
    items += [(12, None), (13, "..."), (2, items[3][1]), (14, "only two")]
    texts = sample_texts(8, 40)
    for _ in range(40):
        a = " ".join(rng.choice(v) for _ in range(rng.randrange(30)))
        it = rng.choice(items)[1] or ""
        cutw = it.split()[: rng.randrange(1, 30)]
        texts.append(a + "-- " + rng.choice([" ", ", ", "\n"]).join(cutw).upper() + "! " + a)
    b = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(spark, texts)
    got = {r.doc_id: tuple(r)[1:] for r in verdicts(decontaminate(docs, b, shard_bytes=shard)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_leaks(texts, items)


def test_leak_spans_map_to_the_original():
    assert char_spans("Élan, vital!  AB c", [[0, 2], [3, 4]]) == [(0, 11), (17, 18)]


def test_leak_spans_in_the_result(spark):
    item = "Étoile one TWO three-four five six seven eight nine ten eleven"
    body = "début. " + "filler words " * 20_000
    texts = [None, "", "nothing here", body + "… " + item.upper().replace(" ", "  ") + "!", item + " and " + item.lower(),
             "one two three four five six seven eight nine ten"]
    bench = spark.createDataFrame([(7, item, 0), (8, None, 0), (9, "", 0)], "item_id long, text string, n_words long")
    for shard in (1 << 22, 40):         # one automaton, several
        got = {r.doc_id: r for r in verdicts(decontaminate(docs_of(spark, texts), bench, shard_bytes=shard, spans=True)).collect()}
        assert [got[i].leaks for i in (0, 1, 2)] == ["", "", ""]
        for i in (3, 4, 5):
            spans = [tuple(map(int, x.split(":"))) for x in got[i].leaks.split(",")]
            words = [w for a, b in spans for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
                c.lower() if "A" <= c <= "Z" else c for c in texts[i][a:b]))]
            assert len(words) == got[i].n_hit > 0 and got[i].contaminated
            assert all(not texts[i][a - 1:a].strip(" …!") or a == 0 for a, b in spans)


def test_mixing(spark):
    rng = random.Random(11)
    texts, src = [None, "", "one"], ["a", None, "c"]
    for s, n in (("a", 700), ("b", 40), ("c", 200), ("d", 60), (None, 30), ("e", 90)):
        for _ in range(n):
            texts.append("w " * int(rng.paretovariate(1.2) * 20))
            src.append(s)
    rows = [(i, t, "en", s, 0, 0, "", "") for i, (t, s) in enumerate(zip(texts, src))]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mix(docs, bucket_rows=100).collect()
    size = {i: len(WORD.findall(t or "")) for i, t in enumerate(texts)}
    per = Counter()
    for i, s in enumerate(src):
        per[s] += size[i]
    names = sorted(s for s in per if s is not None) + [None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = 1.5 * sum(per.values()), {}, set(names)
    while True:  # reshare the excess until none is above
        left = total - sum(target.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * per[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * per[s]
            free.discard(s)
    taken = Counter()
    for r in got:
        assert r["size"] == size[r.doc_id] and r.source_size == per[r.source] and 0 <= r.copies <= 2
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r["size"] * r.copies
    assert len(got) == len(texts)
    for s in names:
        assert taken[s] == pytest.approx(target[s], rel=0.02, abs=60)
    again = {r.doc_id: r.copies for r in mix(docs.repartition(2), bucket_rows=100).collect()}
    assert again == {r.doc_id: r.copies for r in got}


def test_empty_tables(spark):
    d = docs_of(spark, ["x"]).where("false")
    b = spark.createDataFrame([], "item_id long, text string")
    path = public_tokenizers.path("piece_bpe_32k.model")
    for df in (token_counts(d, path), quality_rules(d), simhash_groups(d), decontaminate(d, b), mix(d)):
        assert df.collect() == []
    one = decontaminate(docs_of(spark, ["x y"]), b).collect()
    assert [(r.n_words, r.ranges) for r in one] == [(2, [])]


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a b c d e", "en", "s", 0, 0, "", "")] * 2 + [(5, "a b c d e", None, None, 0, 0, "", "")] * 2
    d = spark.createDataFrame(rows, SCHEMA)
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert token_counts(d, path).count() == 4
    assert quality_rules(d).count() == 4
    assert {r.component_id for r in simhash_groups(d).collect()} == {5}
    assert mix(d).agg(F.count("*")).first()[0] == 4
