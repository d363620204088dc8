"""Exact set-similarity join over word shingles, without LSH.

Texts are sets of hashed word k-grams; equal sets are one node (a copy is never
compared).  Two nodes are linked if their Jaccard similarity is at least the
threshold.  Candidates come from three filters, each of which only drops pairs
that cannot reach the threshold:

* prefix: with the shingles of every set in one global order, similar sets
  share a shingle among their first ``n - ceil(t n) + 1``;
* length: the smaller set has at least ``t`` times the larger one's size;
* position: the shingles behind the first shared one must suffice.

The order is by rising frequency, so a shingle of a common line or passage is
in hardly any prefix.  Frequencies come from a count sketch of fixed size
(``SKETCH`` counters): the sets need *one* order, not exact counts, so the
result does not depend on the sketch's precision.

``near_groups`` gives connected components without ever forming all pairs of a
group: in each shingle's group all members are first compared with one star,
the member with the fewest rarer shingles (of near copies the one that was changed
least, which the others are nearest to); components of those verified links are
found; and only members of groups that still hold several components are then
compared across components.
``similar_pairs`` gives every link between different texts.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomis.plans.sequence import spread
from loomis.session import scratch_path

SHINGLE = 5
THRESHOLD = (4, 5)          # similarity as a fraction
SKETCH = 1 << 20            # counters of the frequency sketch (8 MB where it is broadcast)
_SLICES = 64
HOT = 1 << 16               # a shingle counted more often gets its star by an aggregate, not by a sorted group
_PRESENT = 1 << 23          # bits of the filter in front of the shuffle of sets (131,072 rows)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


# ---------------------------------------------------------------- sets
# Word hashes are polynomials of a table of 64-bit numbers, modulo 2**64, taken
# for all words of a text at once from one running sum.
_BASE = 0x9FB21C651E98DF25
_TABLE = np.frombuffer(b"".join(hashlib.blake2b(bytes([i]), digest_size=8).digest() for i in range(256)), np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_PIECE = 1 << 18
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, as many as a piece has needed."""
    if len(_POWERS.get("up", ())) < n:
        for name, x in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(n, x, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def _word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, in their order; the text is taken in
    pieces that end at white space."""
    flat = np.frombuffer(text, np.uint8)
    out, at = [], 0
    while at < len(flat):
        end = min(at + _PIECE, len(flat))
        while end < len(flat) and not _SPACE[flat[end]]:
            rest = np.flatnonzero(_SPACE[flat[end:end + _PIECE]])
            end = end + int(rest[0]) if len(rest) else min(end + _PIECE, len(flat))
        piece = flat[at:end]
        edge = np.diff(np.concatenate(([True], _SPACE[piece], [True])).astype(np.int8))
        begin, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = _powers(len(piece) + 1)
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_TABLE[piece] * up[:len(piece)], out=total[1:])
        h = (total[stop] - total[begin]) * down[begin]
        # The lower bits of a sum of odd multiples are weak: fold the upper ones in.
        h ^= h >> np.uint64(31)
        out.append(h * _ODD[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(text: str, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word k-grams of a lower-cased text
    (words are cut at ASCII white space; fewer than k words are one k-gram)."""
    w = _word_hashes(text.lower().encode("utf-8", "surrogatepass"))
    n = len(w)
    if n == 0:
        return w
    odd = np.resize(_ODD, k) + np.arange(k, dtype=np.uint64) // np.uint64(len(_ODD)) * np.uint64(2)
    if n < k:
        h = np.array([(w * odd[:n]).sum(dtype=np.uint64) + np.uint64(n)], np.uint64)
    else:
        h = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            h += w[j:n - k + 1 + j] * odd[j]
    h ^= h >> np.uint64(32)
    h *= _ODD[2]
    h ^= h >> np.uint64(29)
    return np.unique(h)


def _node(s: np.ndarray) -> int:
    """64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(batches, k: int, once: bool):
    """(batch, row, node, set) of every text with words; ``once`` skips sets
    that this task has seen."""
    seen = set()
    for b in batches:
        texts = b.column(b.num_columns - 1)
        for i in range(b.num_rows):
            text = texts[i].as_py()
            s = shingle_set(text, k) if text else ()
            if len(s) == 0:
                continue
            node = _node(s)
            if once:
                if node in seen:
                    continue
                seen.add(node)
            yield b, i, node, s


def _chunks(rows, names: list[str], types: list[pa.DataType], limit: int = 1 << 18):
    """Arrow batches from tuples of equally long arrays."""
    held, size = [], 0

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c), t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
    for row in rows:
        held.append(row)
        size += len(row[0])
        if size >= limit:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def frequency_sketch(texts: DataFrame, k: int = SHINGLE) -> np.ndarray:
    """Counts of shingles by their upper hash bits: each task counts into an
    array of ``SKETCH`` counters, the slices of all tasks are added up."""
    width = SKETCH // _SLICES

    def count(batches):
        total = np.zeros(SKETCH, np.uint32)
        some = False
        for _, _, _, s in _sets(batches, k, True):
            total[(s >> np.uint64(44)).astype(np.int64)] += np.uint32(1)
            some = True
        if some:
            total = np.minimum(total, 65535).astype(np.uint16).reshape(_SLICES, width)
            yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int32()),
                                              pa.array([x.tobytes() for x in total], pa.binary())], names=["slice", "n"])

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if i not in held:
                    held[i] = np.zeros(width, np.int64)
                held[i] += np.frombuffer(n, np.uint16)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()),
                                              pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["slice", "n"])

    out = np.zeros((_SLICES, width), np.int64)
    parts = texts.mapInArrow(count, "slice int, n binary").repartition(_SLICES, "slice").mapInArrow(add, "slice int, n binary")
    for r in parts.collect():               # _SLICES rows, 8 MB in all
        out[r["slice"]] = np.frombuffer(r["n"], np.int64)
    return out.reshape(-1)


def prefix_rows(texts: DataFrame, k: int, threshold: tuple[int, int]) -> DataFrame:
    """(token, node, n, pos, often) for the prefix of every set."""
    num, den = threshold
    order = texts.sparkSession.sparkContext.broadcast(frequency_sketch(texts, k))

    def run(batches):
        counts = order.value

        def rows():
            for _, _, node, s in _sets(batches, k, True):
                n = len(s)
                often = counts[(s >> np.uint64(44)).astype(np.int64)]
                keep = n - (num * n + den - 1) // den + 1
                by = np.lexsort((s, often))[:keep]
                yield (s[by].view(np.int64), np.full(keep, node, np.int64), np.full(keep, n, np.int32),
                       np.arange(keep, dtype=np.int32), often[by])
        yield from _chunks(rows(), ["token", "node", "n", "pos", "often"],
                           [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()])

    return texts.mapInArrow(run, "token bigint, node bigint, n int, pos int, often bigint")


_GROUP = "token bigint, node bigint, n int, pos int, star bigint, star_n int, star_pos int"


def _starred(batches):
    """Members of groups of two and more with their group's first member, from
    rows sorted by token, position, size and node; memory is one batch."""
    star = None             # first member of the group that the last batch ended in
    last = None             # last member of that group
    lone = None             # its only member, if it has one so far
    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if lone is not None:
            cols = [np.concatenate([np.array([v], c.dtype), c]) for v, c in zip(lone, cols, strict=True)]
        token, node = cols[0], cols[1]
        same = np.zeros(len(token), bool)
        same[1:] = (token[1:] == token[:-1]) & (node[1:] == node[:-1])
        if lone is None and last is not None and len(token):
            same[0] = token[0] == last[0] and node[0] == last[1]
        cols = [c[~same] for c in cols]
        token = cols[0]
        if not len(token):
            continue
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        size = np.diff(np.append(first, len(token)))
        group = np.repeat(np.arange(len(first)), size)
        goes_on = lone is None and star is not None and token[0] == star[0]
        stars = [c[first].copy() for c in cols]
        if goes_on:
            for c, v in zip(stars, star, strict=True):
                c[0] = v
        large = size > 1
        large[0] |= goes_on
        emit = large[group]
        if emit.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[emit]) for c in cols] + [pa.array(stars[i][group[emit]]) for i in (1, 2, 3)],
                names=["token", "node", "n", "pos", "star", "star_n", "star_pos"])
        last = [c[-1] for c in cols]
        lone = None if large[-1] else last
        star = [c[-1] for c in stars]


def token_groups(prefixes: DataFrame) -> DataFrame:
    """Prefix rows of shingles that several nodes share, each with its group's
    star (the member in which the shingle comes first).  A shingle whose counter exceeds ``HOT`` is not
    gathered: its star is a minimum combined map-side and joined back."""
    cold = prefixes.where(F.col("often") <= HOT).drop("often").repartition("token") \
        .sortWithinPartitions("token", "pos", "n", "node").mapInArrow(_starred, _GROUP)
    hot = prefixes.where(F.col("often") > HOT).select("token", "node", "n", "pos").distinct()
    stars = hot.groupBy(F.col("token").alias("s_token")).agg(
        F.min(F.struct("pos", "n", "node")).alias("s"), F.count(F.lit(1)).alias("m")).where("m > 1")
    hot = hot.join(stars, F.col("token") == F.col("s_token")).select(
        "token", "node", "n", "pos", F.col("s.node").alias("star"), F.col("s.n").alias("star_n"),
        F.col("s.pos").alias("star_pos"))
    return _cut(cold.unionByName(hot), "groups")


def _cut(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage for good."""
    path = scratch_path(df.sparkSession, "similarity", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _possible(n1: str, pos1: str, n2: str, pos2: str, threshold: tuple[int, int]):
    """Length and position filters."""
    num, den = threshold
    need = F.expr(f"({num} * ({n1} + {n2}) + {num + den - 1}) div {num + den}")
    return (F.least(n1, n2) * den >= F.greatest(n1, n2) * num) & \
        (F.least(F.col(n1) - F.col(pos1), F.col(n2) - F.col(pos2)) >= need)


# ---------------------------------------------------------------- verification
def verified(pairs: DataFrame, texts: DataFrame, k: int, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of nodes whose sets reach the threshold, with both sizes
    and the overlap.  Only sets that may be in a pair are shuffled: a bit
    filter of fixed size, joined as a table of at most 131,072 rows, drops the
    others where they are made."""
    num, den = threshold
    bit = lambda c: F.col(c).bitwiseAND(F.lit(_PRESENT - 1))
    nodes = pairs.select(F.inline(F.array(F.struct(F.col("a").alias("x"), F.lit(True).alias("first")),
                                          F.struct(F.col("b").alias("x"), F.lit(False).alias("first")))))
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), bit("x").bitwiseAND(F.lit(63)).cast("int"))
    none = F.lit(0).cast("long")
    words = nodes.groupBy(F.shiftright(bit("x"), 6).alias("word")).agg(
        F.bit_or(F.when(F.col("first"), mark).otherwise(none)).alias("bits_a"),
        F.bit_or(F.when(F.col("first"), none).otherwise(mark)).alias("bits_b"))

    def run(batches):
        held, size = [], 0

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in held], pa.int64()),
                 pa.array([s.view(np.int64) for _, s in held], pa.list_(pa.int64()))], names=["node", "toks"])
        for _, _, node, s in _sets(batches, k, True):
            held.append((node, s))
            size += len(s)
            if size >= 1 << 18:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    sets = texts.mapInArrow(run, "node bigint, toks array<bigint>")
    sets = sets.join(F.broadcast(words), F.shiftright(bit("node"), 6) == F.col("word"))
    has = lambda c: F.call_function("getbit", F.col(c), bit("node").bitwiseAND(F.lit(63)).cast("int")) == 1
    sets = sets.select("node", "toks", has("bits_a").alias("is_a"), has("bits_b").alias("is_b")).where("is_a or is_b")
    sets = _cut(sets.dropDuplicates(["node"]), "sets")
    left = sets.where("is_a").select(F.col("node").alias("a"), F.col("toks").alias("ta"))
    right = sets.where("is_b").select(F.col("node").alias("b"), F.col("toks").alias("tb"))
    j = pairs.select("a", "b").join(right, "b").join(left, "a")
    j = j.select("a", "b", F.size("ta").alias("na"), F.size("tb").alias("nb"),
                 F.size(F.array_intersect("ta", "tb")).alias("inter"))
    return j.where((num + den) * F.col("inter") >= num * (F.col("na") + F.col("nb")))


# ---------------------------------------------------------------- components
def connected(links: DataFrame) -> DataFrame:
    """(node, root): smallest node reachable over the links (a, b), by
    alternating large-star and small-star steps; each is a minimum combined
    map-side and a join on nodes, written before the next one reads it."""
    e = _cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).select("k", F.least("k", "m").alias("m"))
        e = both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = _cut(e.where("u <> v").distinct(), "edges")
        least = e.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = e.join(least, F.col("u") == F.col("k")).select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        small = small.unionAll(least.select(F.col("k").alias("u"), F.col("m").alias("v")))
        e = _cut(small.where("u <> v").distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now


# ---------------------------------------------------------------- operators
def _texts(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.col(text).cast("string").alias("text"))


def memberships(df: DataFrame, key: str, text: str, k: int = SHINGLE) -> DataFrame:
    """(key, node): the set each text stands for, null for texts without words."""
    src = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            nodes = [None] * b.num_rows
            for _, i, node, _ in _sets([b], k, False):
                nodes[i] = node
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(nodes, pa.int64())], names=["key", "node"])
    return src.mapInArrow(run, f"key {src.schema['key'].dataType.simpleString()}, node bigint")


def similar_pairs(df: DataFrame, text: str, k: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Every link between different sets: (a, b, jaccard), a < b by (size,
    name).  With ``memberships`` this is the whole similarity join; copies are
    not expanded into pairs."""
    texts = _texts(df, text)
    g = token_groups(prefix_rows(texts, k, threshold)).select("token", "node", "n", "pos")
    x, y = (g.select("token", *[F.col(c).alias(f"{p}_{c}") for c in ("node", "n", "pos")]) for p in ("x", "y"))
    pairs = x.join(y, "token").where(F.struct("x_n", "x_node") < F.struct("y_n", "y_node")) \
        .where(_possible("x_n", "x_pos", "y_n", "y_pos", threshold))
    pairs = _cut(pairs.select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct(), "pairs")
    found = verified(pairs, texts, k, threshold)
    return found.select("a", "b", (F.col("inter") / (F.col("na") + F.col("nb") - F.col("inter"))).alias("jaccard"))


def near_groups(df: DataFrame, key: str, text: str, k: int = SHINGLE,
                threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(key, cluster_id, n_members): connected components of the similarity
    links; cluster_id is the smallest key.  Exact.  A text without words (null
    included) is a cluster of its own."""
    # Read by every pass: written once, dealt to all tasks (a row group is read by one).
    df = _cut(spread(df.select(key, F.col(text).cast("string").alias(text))), "texts")
    texts = _texts(df, text)
    groups = token_groups(prefix_rows(texts, k, threshold))
    first = groups.where("star <> node").where(_possible("star_n", "star_pos", "n", "pos", threshold)) \
        .select(F.col("star").alias("a"), F.col("node").alias("b")).distinct()
    links = _cut(verified(_cut(first, "pairs"), texts, k, threshold).select("a", "b"), "links")
    labels = _cut(connected(links), "labels")
    # Groups that still hold several components: compare across components.
    named = groups.join(labels.withColumnRenamed("node", "l_node"), F.col("node") == F.col("l_node"), "left") \
        .withColumn("root", F.coalesce("root", "node")).drop("l_node")
    named = _cut(named.select("token", "node", "n", "pos", "star", "root"), "named")
    open_ = named.groupBy(F.col("token").alias("o_token")).agg(F.min("root").alias("lo"), F.max("root").alias("hi")) \
        .where("lo <> hi").select("o_token")
    rest = named.join(open_, F.col("token") == F.col("o_token"), "left_semi")
    x, y = (rest.select("token", *[F.col(c).alias(f"{p}_{c}") for c in ("node", "n", "pos", "star", "root")])
            for p in ("x", "y"))
    # A group's star was compared with all its members.
    pairs = x.where("x_node <> x_star").join(y.where("y_node <> y_star"), "token").where("x_root <> y_root") \
        .where(F.struct("x_n", "x_node") < F.struct("y_n", "y_node")) \
        .where(_possible("x_n", "x_pos", "y_n", "y_pos", threshold))
    pairs = _cut(pairs.select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct(), "pairs")
    if not pairs.isEmpty():
        more = _cut(verified(pairs, texts, k, threshold).select("a", "b"), "links")
        if not more.isEmpty():
            labels = _cut(connected(links.unionAll(more)), "labels")

    members = _cut(memberships(df, key, text, k), "members")
    by_node = members.where("node is not null").groupBy("node").agg(F.min("key").alias("low"), F.count(F.lit(1)).alias("m"))
    by_node = by_node.join(labels.withColumnRenamed("node", "l_node"), F.col("node") == F.col("l_node"), "left") \
        .select("node", F.coalesce("root", "node").alias("root"), "low", "m")
    by_node = _cut(by_node, "nodes")
    by_root = by_node.groupBy(F.col("root").alias("r")).agg(F.min("low").alias("cluster_id"), F.sum("m").alias("n_members"))
    named = by_node.join(by_root, F.col("root") == F.col("r")).select(F.col("node").alias("n_node"), "cluster_id", "n_members")
    out = members.join(named, F.col("node") == F.col("n_node"), "left")
    return out.select(F.col("key").alias(key), F.coalesce("cluster_id", "key").alias("cluster_id"),
                      F.coalesce("n_members", F.lit(1)).cast("long").alias("n_members"))
