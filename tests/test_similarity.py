"""Exact similarity join against all pairs: random near copies, chains, groups
with hot shingles, and the recall of the LSH form."""

import random
from collections import Counter
from itertools import combinations

import pytest

from loomis.operators import curate as cu
from loomis.operators import similarity as sm

SCHEMA = "doc_id long, text string, node long, token string, a int, root int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, -1, "t", 0, 0) for i, t in texts], SCHEMA).repartition(5)


def shingles(texts, k=5):
    out = {}
    for i, t in texts:
        w = (t or "").lower().encode().split()
        if w:
            out[i] = frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1)))
    return out


def brute(texts):
    """Clusters, and links between different sets."""
    sets, links, up = shingles(texts), set(), {i: i for i, _ in texts}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in combinations(sorted(sets), 2):
        inter = len(sets[a] & sets[b])
        if 5 * inter >= 4 * (len(sets[a]) + len(sets[b]) - inter):
            if sets[a] != sets[b]:
                links.add((a, b))
            x, y = sorted((top(a), top(b)))
            up[y] = x
    sizes = Counter(top(i) for i, _ in texts)
    return {i: (top(i), sizes[top(i)]) for i, _ in texts}, links


def near_texts(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["É", "日本"]
    some = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage = some(40)
    out = [None, "", " \n", "one", "One", "one two", "a b c d e", "a b c d e f", "A  b\tc d e"]
    for _ in range(18):
        base = some(rng.choice([12, 60, 150, 300])) + (passage if rng.random() < 0.5 else [])
        now = base
        for _ in range(rng.choice([1, 2, 6, 18])):
            out.append(" ".join(now))
            now = list(rng.choice([now, base]))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                now[rng.randrange(len(now))] = rng.choice(vocab)
            now = now[rng.randrange(4):] if rng.random() < 0.5 else now
    out += [" ".join(passage + some(rng.choice([2, 4, 6, 8, 10]))) for _ in range(50)]   # one hot passage
    texts = list(enumerate(out, 1))
    rng.shuffle(texts)
    return texts


def groups(df):
    return {r.doc_id: (r.cluster_id, r.n_members) for r in sm.near_groups(df, "doc_id", "text").collect()}


@pytest.mark.parametrize("hot", [sm.HOT, 3])
def test_groups_equal_all_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(sm, "HOT", hot)     # 3: almost all shared shingles take the aggregate path
    texts = near_texts(hot)
    want, links = brute(texts)
    assert len(links) > 100
    assert groups(frame(spark, texts)) == want


def test_pairs_equal_all_pairs(spark):
    texts = near_texts(7)
    df = frame(spark, texts)
    node = {r.key: r.node for r in sm.memberships(df, "doc_id", "text").collect()}
    sets, (_, links) = shingles(texts), brute(texts)
    want = {frozenset((node[a], node[b])): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in links}
    got = {frozenset((r.a, r.b)): r.jaccard for r in sm.similar_pairs(df, "text").collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[x] - want[x]) < 1e-12 for x in want)


def test_chain_is_one_group(spark):
    # Every text is near its neighbours only; a smaller id far down the chain names the group.
    words = [f"c{i}" for i in range(400)]
    chain = [" ".join(words[8 * i:8 * i + 100]) for i in range(30)]
    texts = [(100 - i, t) for i, t in enumerate(chain)] + [(1, "something else entirely with other words")]
    want, links = brute(texts)
    assert {want[100 - i][0] for i in range(30)} == {71} and len(links) == 29
    assert groups(frame(spark, texts)) == want


def test_many_copies_empty_and_long(spark):
    assert sm.near_groups(frame(spark, []), "doc_id", "text").count() == 0
    body = " ".join(f"x{i}" for i in range(60_000))
    texts = [(i, "the same old text in many many copies") for i in range(500)]
    texts += [(600, body), (601, body + " tail"), (602, None), (603, None)]
    got = groups(frame(spark, texts))
    assert {got[i] for i in range(500)} == {(0, 500)}
    assert got[600] == got[601] == (600, 2) and got[602] == (602, 1) and got[603] == (603, 1)


def test_repeated_keys_are_rows(spark):
    texts = [(1, "alpha beta gamma delta epsilon"), (1, "alpha beta gamma delta epsilon"), (2, "zeta eta theta iota kappa")]
    got = sorted((r.doc_id, r.cluster_id, r.n_members) for r in sm.near_groups(frame(spark, texts), "doc_id", "text").collect())
    assert got == [(1, 1, 2), (1, 1, 2), (2, 2, 1)]


def test_recall_of_the_lsh_form(spark):
    """Registered parameters of the approximate form against the exact links."""
    texts = [(i, t) for i, t in near_texts(11) if t and t.split()]
    want, links = brute(texts)
    got = {r.doc_id: r.cluster_id for r in cu.near_duplicates(
        spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text").collect()}
    found = sum(got[a] == got[b] for a, b in links)
    assert found / len(links) >= 0.9
    exact = groups(frame(spark, texts))
    assert all(exact[a] == exact[b] for a, b in links)
