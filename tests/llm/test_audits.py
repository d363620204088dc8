"""Filter interaction audit, secret scan and Merkle manifest against brute
force on awkward documents."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from loomis.llm import secrets
from loomis.llm.interaction import Planes, interaction_audit, survival_words
from loomis.llm.manifest import build, manifest
from loomis.llm.secrets import find_in, find_secrets, secret_digests

DOCS = "doc_id long, source string, lang string, n_chars long, text string, part int, key string, g int, h string"
LABELS = "doc_id long, quality int, toxic int, part string"


def frame(spark, rows):
    """Documents with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, -1, "k", -2, "h") for r in rows], DOCS).repartition(3)


# ------------------------------------------------------------ op 11
def brute_audit(rows, labels):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    first = {}
    for i, _, _, _, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, x in labels if x == 1}
    docs = []
    for i, s, _, _, t in rows:
        t = t or ""
        w = word.findall(t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
             "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t),
             "E": i is not None and first[t] < i}
        docs.append((s or "", {k for k, v in f.items() if v}, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        here = [d[1:] for d in docs if d[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            for k, x in enumerate(order):
                before = set(order[:k])
                removed = [d for d in here if x in d[0] and not d[0] & before]
                shapley[x] += len(removed)
                out[part, "".join(order), k + 1] = [
                    sum(not d[0] & {*before, x} for d in here), len(removed), sum(x in d[0] for d in here) - len(removed),
                    sum(d[0] == {x} for d in here), sum(d[1] for d in removed), sum(d[2] for d in removed)]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(shapley[order[k - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audit_rows(n, seed=0):
    rng = random.Random(seed)
    pool = [None, "", " ", "Éa # b", "AB cd", "x " * 300, "w\u0000w " * 5]
    for _ in range(25):
        size = rng.choice([5, 199, 200, 450])
        words = [rng.choice(["a", "b", "é", "Word", "x$", "日本"]) if rng.random() < 0.5 else f"u{rng.randrange(9999)}"
                 for _ in range(size)]
        pool.append(rng.choice([" ", "\n", "  "]).join(words))
    ids = [rng.choice([i, i, i, i, i, None, i // 2]) for i in range(n)]
    return [(i, rng.choice(["s", "t", "", None, "é"]), "en", 1, rng.choice(pool)) for i in ids]


def test_filter_interaction(spark):
    rows = audit_rows(400)
    rows += rows[:20] + [(i, "s", "en", 1, "hot text") for i in range(1000, 1200)]
    rng = random.Random(1)
    labels = [(rng.randrange(400), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(300)]
    lab = spark.createDataFrame([(*x, "p") for x in labels], LABELS)
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                                              r.shapley) for r in interaction_audit(frame(spark, rows), lab).collect()}
    assert got == brute_audit(rows, labels)


def test_filter_interaction_empty_and_long(spark):
    lab = spark.createDataFrame([], LABELS)
    assert interaction_audit(frame(spark, []), lab).count() == 0
    rows = [(1, "s", "en", 1, "word" + " other" * 400_000), (2, "s", "en", 1, None)]
    got = {(r.filter_order, r.step): r.removed for r in interaction_audit(frame(spark, rows), lab).collect()}
    assert len(got) == 600 and got["ABCDE", 1] == 1 and got["BACDE", 1] == 1 and got["CDEAB", 1] == 0


def test_carry_save_counts():
    rng, planes, want = np.random.default_rng(0), Planes(), np.zeros(32, np.int64)
    for n in (0, 1, 2, 3, 1000, 7, 4096, 1):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        planes.add(words)
        want += ((words[:, None] >> np.arange(32, dtype=np.uint32)) & 1).astype(np.int64).sum(axis=0)
    assert planes.counts().tolist() == want.tolist()
    assert all(len(x) <= 1 for x in planes.levels)
    w = survival_words()
    assert all(bool(int(w[f]) >> s & 1) == ((f & s) == 0) for f in range(32) for s in range(32))


# ------------------------------------------------------------ op 12
SECRET = "password=hunter2hunter"


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


def percent(x):
    return "".join(f"%{b:02X}" for b in x.encode())


def escapes(x):
    return "".join(f"\\u{ord(c):04x}" for c in x)


WRAPPERS = {
    "url": percent, "unicode": escapes, "base64": b64, "gz": lambda x: b64(gzip.compress(x.encode())),
    "zlib": lambda x: b64(zlib.compress(x.encode())), "bz2": lambda x: b64(bz2.compress(x.encode())),
    "xz": lambda x: b64(lzma.compress(x.encode())), "zstd": lambda x: b64(zstandard.compress(x.encode())),
    "refs": lambda x: "".join(f"&#{ord(c)};" for c in x), "safe": lambda x: base64.urlsafe_b64encode(x.encode()).decode(),
    "wide": lambda x: b64(x.encode("utf-16-le")), "bytes": lambda x: "".join(f"\\x{c:02x}" for c in gzip.compress(x.encode())),
}


@pytest.mark.parametrize("outer", sorted(WRAPPERS))
@pytest.mark.parametrize("inner", sorted(WRAPPERS))
def test_nested_layers_map_to_the_text(outer, inner):
    hidden = WRAPPERS[outer](WRAPPERS[inner](SECRET))
    text = "é日 before " + hidden + " after\nnext line"
    base, spans = find_in(text)
    assert base == []
    a, b = text.index(hidden), text.index(hidden) + len(hidden)
    inside = [x for x in spans if x[0] == "assign" and a <= x[1] < x[2] <= b]
    assert len(inside) == len(spans) >= 1


def test_exact_spans_under_escapes():
    text = "é a%20" + "token%3D" + "abcdefgh1 x"
    assert find_in(text)[1] == [("assign", 6, 23, "url")]
    text = "ü" + b64("xyz " + SECRET + " tail")
    (_, a, b, path), = find_in(text)[1]
    # Characters 1 + 8 * 4 // 6 .. of the secret's first and last bits.
    assert (path, a, b) == ("base64", 1 + 8 * 4 // 6, 1 + (8 * (4 + len(SECRET)) + 5) // 6)


def brute_base(t):
    out = []
    for m in re.finditer(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
                         r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 32]
    return [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)]


def test_secret_scan_on_random_texts(spark):
    rng = random.Random(5)
    atoms = ["token", "Api_Key", "APIKEY", "secret", '"', "'", " ", "  ", "=", ":", "\n", "é", "K", "AKIA", "ABCDEFGH1234",
             "deadbeef", "0123456789abcdef", "%3D", "%41", "\\u003d", "value123", "x-y_z.", "𝔘", "A", "passwd", "password"]
    texts = [None, "", " ", "token=short", "AKIA" + "B" * 12, "f" * 31, "f" * 32, "a" * 100_000 + "é" + "0" * 40]
    texts += ["".join(rng.choice(atoms) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    rows = [(i, "s", "en", 1, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in secret_digests(find_secrets(frame(spark, rows + rows[:1]))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want, r = brute_base(t or ""), got[i]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        kinds = Counter(x.split(":")[0] for x in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds[k] for k in secrets.KINDS)
        spans = r.spans.split(",") if r.spans else []
        assert not Counter(want) - Counter(spans)
        if not re.search(r"%[0-9A-Fa-f]{2}|\\u|[A-Za-z0-9+/_-]{16}", t or ""):
            assert spans == want
    assert find_secrets(frame(spark, [])).count() == 0


def test_cycles_and_large_streams(monkeypatch):
    # A stream that holds itself is entered once for each place only.
    real = secrets._streams
    loops = []

    def looping(data):
        loops.append(1)
        assert len(loops) < 50
        yield from real(data)
        if data.startswith(b"loop"):
            yield data, lambda a, b, n=len(data): (0, n)
    monkeypatch.setattr(secrets, "_streams", looping)
    assert find_in(b64("loop " + SECRET))[1][0][0] == "assign"
    monkeypatch.setattr(secrets, "_streams", real)
    monkeypatch.setattr(secrets, "LAYER_BYTES", 1 << 12)
    lines = "\n".join(f"line {i} of a log without any secret" for i in range(2000))
    hidden = b64(gzip.compress(f"{lines}\n{SECRET}\n{lines}".encode()))
    assert [x[3] for x in find_in("x " + hidden)[1]] == ["base64>compressed"]
    assert find_in(b64(gzip.compress(SECRET.encode())[:-9] + b"broken"))[0] == []


def test_wrapped_base64():
    text = base64.encodebytes(("filler " * 30 + SECRET + " after" * 30).encode()).decode()
    (_, a, b, path), = find_in("head\n" + text)[1]
    assert path == "base64" and 0 < a < b <= len(text) + 5
    crlf = text.replace("\n", "\r\n")
    assert len(find_in(crlf)[1]) == 1


# ------------------------------------------------------------ op 13
def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_manifest(rows):
    by = defaultdict(list)
    for i, source, lang, n, t in rows:
        hit = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        low = t if t is None or not hit else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        leaf, bad = (digest(*map(field, (i, source, lang, n, x))) for x in (t, low))
        by[lang].append(((i is not None, i or 0, leaf), bad))

    def tree(h):
        levels = [h]
        while len(levels[-1]) > 1:
            x = levels[-1]
            levels.append([digest(*x[j:j + 8]) for j in range(0, len(x), 8)])
        return levels

    def siblings(levels, i):
        for x in levels[:-1]:
            a = i // 8 * 8
            yield x[a:i], x[i + 1:a + 8]
            i //= 8

    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([k[2] for k, _ in sorted(by[x])]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for g, lang in enumerate(langs):
        for i, ((some, doc, leaf), fold) in enumerate(sorted(by[lang])):
            path = [*siblings(trees[lang], i), *siblings(top, g)]
            proof = digest(*(y for a, b in path for y in a + b))
            for a, b in path:
                fold = digest(*a, fold, *b)
            out.append((doc if some else None, leaf, trees[lang][-1][0], top[-1][0], proof, fold, fold == top[-1][0]))
    return out


@pytest.mark.parametrize("n,langs", [(0, ["a"]), (1, [None]), (8, ["a"]), (700, ["a", "b", None, "é"]),
                                     (4700, ["a"] * 30 + [f"l{k}" for k in range(70)])])
def test_manifest(spark, n, langs):
    rng = random.Random(n)
    rows = [(rng.choice([k, k, k, None, 3]), rng.choice(["s", None]), rng.choice(langs), rng.choice([None, k]),
             rng.choice([None, "", "Abc É", "x y", f"T{k}", "LONG " * 5000 if k < 5 else "t"])) for k in range(n)]
    got = [tuple(r) for r in manifest(frame(spark, rows)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_manifest(rows)))


def test_manifest_has_no_hot_step(spark):
    rows = [(k, "s", "a", k, "t") for k in range(4700)]
    leaves, nodes, _, _ = build(frame(spark, rows))
    # Rows of one join key: all leaves of a block under one node of one level.
    steps = nodes.groupBy("bg", "block", "ng", "nl", "ni").count()
    assert steps.agg({"count": "max"}).first()[0] == 1
    assert nodes.groupBy("bg", "block", "nl").count().where("nl > 3 and count > 1").count() == 0
    assert leaves.count() == 4700


def test_manifest_height_is_short(spark):
    """Heights of trees of any size, by an expression that plans can hold many times."""
    from loomis.llm.manifest import _height
    sizes = [1, 2, 7, 8, 9, 63, 64, 65, 512, 513, 8**10, 8**10 + 1, 8**20, 8**20 + 1]
    got = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", _height(F.col("n")).alias("h")).collect()
    for r in got:
        levels = 0
        while 8**levels < r.n:
            levels += 1
        assert r.h == levels, r
    assert len(str(_height(F.col("n")))) < 200
