"""Tokenizer plug-ins for the token operators (X1, X2).

A tokenizer is a callable that takes a list of texts and returns their lists of
ids; ``encode_with`` runs it over a text column in one narrow Arrow pass (no
shuffle, the other columns stay where they are).  ``TrieTokenizer`` is the
built-in one for a vocabulary table: a double-array trie made with numpy, level
by level without a loop over nodes, shipped to the executors once.  It matches
the default pre-tokens against the vocabulary, or, without a pre-tokenizer, the
longest entry at each place of the text.

A vocabulary is shipped only if its trie stays below a byte limit that is
checked before anything leaves the executors; above it ``tokenizer_for``
returns None.  ``tokens.encode_corpus`` and ``decode_corpus`` then ship the head
of the vocabulary, its smallest ids (the most frequent tokens), within the same
limit, and only the tokens outside it, once a row, are joined.

Defined cases: null text has no ids (an empty list); a pre-token that the
vocabulary lacks gets ``unknown_id``; a null token of the vocabulary is
ignored, of equal tokens the smallest id counts; an id that the vocabulary
lacks decodes to ``UNKNOWN_TEXT``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomis.functions.text import TOKEN_PATTERN

LIMIT_BYTES = 64 << 20      # largest trie that is shipped
UNKNOWN_TEXT = "\ufffd"
_CACHE = 1 << 20            # pre-tokens whose ids a worker keeps

# The default pre-token pattern in Python's notation (it names code points as
# \x{h}); ASCII white space, as in the JVM.
PRE_TOKEN = re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", TOKEN_PATTERN), re.ASCII)


class DoubleArray:
    """Trie over byte strings: the child of node ``s`` by byte ``c`` is
    ``t = base[s] + c`` if ``check[t] == s``; ``value[t]`` is the id of the
    string that ends there (-1: none)."""

    def __init__(self, base: np.ndarray, check: np.ndarray, value: np.ndarray):
        self.base, self.check, self.value = base, check, value

    @property
    def n_bytes(self) -> int:
        return self.base.nbytes + self.check.nbytes + self.value.nbytes

    @classmethod
    def build(cls, strings: Sequence[bytes], ids: Sequence[int]) -> DoubleArray:
        order = sorted(range(len(strings)), key=lambda i: (strings[i], ids[i]))
        order = [i for k, i in enumerate(order) if strings[i] and (not k or strings[i] != strings[order[k - 1]])]
        flat = np.frombuffer(b"".join(strings[i] for i in order), np.uint8)
        length = np.array([len(strings[i]) for i in order], np.int64)
        start = np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64) if len(order) else np.zeros(0, np.int64)
        id_of = np.array([ids[i] for i in order], np.int64)
        # Slot 0 is the root; 0-255 stay empty otherwise, as the children of
        # leaves (base 0) would be looked up there.
        size = 1024 + int(len(flat))
        base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        value = np.full(size, -1, np.int32)
        used = np.zeros(size, bool)
        used[:256] = True
        top = 256                               # all slots from here on are free
        at = np.zeros(len(order), np.int64)     # node of each string's prefix so far
        live = np.arange(len(order))
        depth = 0
        while len(live):
            live = live[length[live] > depth]
            if not len(live):
                break
            node, byte = at[live], flat[start[live] + depth].astype(np.int64)
            # Strings are sorted, so those of one child are neighbours.
            new = np.concatenate([[True], (node[1:] != node[:-1]) | (byte[1:] != byte[:-1])])
            child = np.cumsum(new) - 1
            c_node, c_byte = node[new], byte[new]
            n_new = np.concatenate([[True], c_node[1:] != c_node[:-1]])
            first = np.flatnonzero(n_new)
            fan = np.diff(np.append(first, len(c_node)))
            parents = c_node[first]
            many = fan > 1
            # Nodes with several children get a stretch of their own at the end ...
            last = first + fan - 1
            lo, hi = c_byte[first], c_byte[last]
            span = np.where(many, hi - lo + 1, 0)
            offset = top + np.cumsum(span) - span
            here = offset - lo
            grown = top + int(span.sum())
            while grown + len(c_node) + 512 > len(base):
                n = len(base)
                base, check = np.append(base, np.zeros(n, np.int32)), np.append(check, np.full(n, -1, np.int32))
                value, used = np.append(value, np.full(n, -1, np.int32)), np.append(used, np.zeros(n, bool))
            group = np.cumsum(n_new) - 1
            slot = here[group] + c_byte
            is_many = many[group]
            used[slot[is_many]] = True
            top = grown
            # ... an only child any free slot, the gaps of those stretches first.
            single = int((~many).sum())
            if single:
                gaps = np.flatnonzero(~used[256:top]) + 256
                free = np.concatenate([gaps, np.arange(top, top + max(0, single - len(gaps)))])[:single]
                slot[~is_many] = free
                used[free] = True
                top = max(top, int(free[-1]) + 1)
                here[~many] = free - lo[~many]
            base[parents] = here
            check[slot] = parents[group]
            at[live] = slot[child]
            ends = length[live] == depth + 1
            value[at[live[ends]]] = id_of[live[ends]]
            depth += 1
        size = top + 256                        # room for a lookup behind the last slot
        return cls(base[:size].copy(), check[:size].copy(), value[:size].copy())

    def _step(self, node: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        to = self.base[node] + byte.astype(np.int32)
        inside = (to >= 0) & (to < len(self.check))
        to = np.where(inside, to, 1)
        return to, self.check[to] == node

    def lookup(self, strings: Sequence[bytes]) -> np.ndarray:
        """Ids of whole strings (-1: not in the vocabulary), all at once."""
        length = np.array([len(s) for s in strings], np.int64)
        flat = np.frombuffer(b"".join(strings) or b"\x00", np.uint8)
        start = np.cumsum(length) - length
        node, out = np.zeros(len(strings), np.int32), np.full(len(strings), -1, np.int64)
        live, depth = np.flatnonzero(length > 0), 0
        while len(live):
            to, ok = self._step(node[live], flat[start[live] + depth])
            live, to = live[ok], to[ok]
            node[live] = to
            depth += 1
            done = length[live] == depth
            out[live[done]] = self.value[to[done]]
            live = live[~done]
        return out

    def longest(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For every place of ``text`` the length and id of the longest entry
        that begins there (0 and -1: none)."""
        flat = np.frombuffer(text, np.uint8)
        n = len(flat)
        size, ids = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        live, node, depth = np.arange(n), np.zeros(n, np.int32), 0
        while len(live):
            to, ok = self._step(node, flat[live + depth])
            live, node = live[ok], to[ok]
            depth += 1
            found = self.value[node]
            hit = found >= 0
            size[live[hit]], ids[live[hit]] = depth, found[hit]
            more = live + depth < n
            live, node = live[more], node[more]
        return size, ids


class TrieTokenizer:
    """Tokenizer over a double-array trie; picklable, so that it can be shipped.

    With ``pre_token`` (the default pattern) each pre-token is looked up whole.
    With ``pre_token=None`` the text is cut greedily into longest entries; a
    character at which none begins gets ``unknown_id``."""

    def __init__(self, trie: DoubleArray, unknown_id: int = -1, pre_token: re.Pattern | None = PRE_TOKEN):
        self.trie, self.unknown_id, self.pre_token = trie, unknown_id, pre_token
        self._cache: dict[str, int] = {}

    def __getstate__(self):
        return self.trie, self.unknown_id, self.pre_token

    def __setstate__(self, state):
        self.__init__(*state)

    def __call__(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        if self.pre_token is None:
            return [self._greedy((t or "").encode()) for t in texts]
        return self.ids_of(self.split(texts))

    def split(self, texts: Sequence[str | None]) -> list[list[str]]:
        return [self.pre_token.findall(t) if t else [] for t in texts]

    def ids_of(self, parts: list[list[str]]) -> list[np.ndarray]:
        cache = self._cache
        new = list({w for p in parts for w in p if w not in cache})
        if new:
            if len(cache) + len(new) > _CACHE:
                cache.clear()
                new = list({w for p in parts for w in p})
            ids = self.trie.lookup([w.encode() for w in new])
            cache.update(zip(new, np.where(ids < 0, self.unknown_id, ids).tolist(), strict=True))
        return [np.fromiter((cache[w] for w in p), np.int64, len(p)) for p in parts]

    def _greedy(self, text: bytes) -> np.ndarray:
        size, ids = self.trie.longest(text)
        step = size.tolist()
        out, i, n = [], 0, len(text)
        while i < n:
            out.append(i)
            if step[i]:
                i += step[i]
            else:
                i += 1
                while i < n and text[i] & 0xC0 == 0x80:
                    i += 1
        found = ids[out] if out else np.zeros(0, np.int64)
        return np.where(found < 0, self.unknown_id, found)


def vocabulary_bytes(vocab: DataFrame, token: str = "token") -> int:
    """Size of the trie if no two tokens shared a prefix: a slot of 12 bytes
    for each byte of a token.  The trie itself is measured once it is built."""
    n = vocab.agg(F.sum(F.octet_length(token))).first()[0] or 0
    return 12 * int(n) + 16 * 1024


def head_end(vocab: DataFrame, limit: int = LIMIT_BYTES) -> int | None:
    """The id at which the head of the vocabulary ends: the tokens with smaller
    ids take at most ``limit`` bytes.  Summed over 1024 ranges of ids, so that
    the driver sees as many rows at most.  None: no range of them fits."""
    v = vocab.where("token is not null")
    lo, hi = v.agg(F.min("id"), F.max("id")).first()
    if lo is None:
        return None
    width = (hi - lo) // 1024 + 1
    sums = v.groupBy(F.expr(f"(id - {lo}L) div {width}L").alias("r")).agg(F.sum(F.octet_length("token")).alias("n")).collect()
    size, end = 16 * 1024, None
    for r in sorted(sums):
        size += 12 * r["n"]
        if size > limit:
            break
        end = lo + (r["r"] + 1) * width
    return end


def tokenizer_for(vocab: DataFrame, limit: int = LIMIT_BYTES, unknown_id: int = -1,
                  pre_token: re.Pattern | None = PRE_TOKEN) -> TrieTokenizer | None:
    """The vocabulary's tokenizer, or None if it may exceed ``limit`` bytes.
    Only a vocabulary within the limit comes to the driver."""
    if vocabulary_bytes(vocab) > limit:
        return None
    rows = vocab.where("token is not null").select("token", "id").toArrow()
    tokens = [t.encode() for t in rows.column("token").to_pylist()]
    trie = DoubleArray.build(tokens, rows.column("id").to_pylist())
    return TrieTokenizer(trie, unknown_id, pre_token) if trie.n_bytes <= limit else None


def _column(df: DataFrame, source: str, out: str, kind: str, make: Callable[..., pa.Array],
            more: str | None = None) -> DataFrame:
    """``df`` with a column made from another one (or from two), batch by batch."""
    schema = df.withColumn(out, F.lit(None).cast(kind)).schema
    at = [df.columns.index(c) for c in (source, more) if c is not None]
    name = out

    def run(batches):
        for b in batches:
            made = make(*[b.column(i) for i in at])
            names = [*b.schema.names, name] if name not in b.schema.names else b.schema.names
            cols = list(b.columns)
            if name in b.schema.names:
                cols[b.schema.names.index(name)] = made
            else:
                cols.append(made)
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return df.mapInArrow(run, schema)


_LOADED: dict[str, object] = {}


def _shipped(spark, thing) -> Callable[[], object]:
    """Broadcast any picklable object, lambdas included; a worker unpickles it
    once and keeps the last few."""
    from pyspark import cloudpickle
    packed, mark = spark.sparkContext.broadcast(cloudpickle.dumps(thing)), uuid.uuid4().hex

    def get():
        if mark not in _LOADED:
            while len(_LOADED) > 3:
                _LOADED.pop(next(iter(_LOADED)))
            _LOADED[mark] = cloudpickle.loads(packed.value)
        return _LOADED[mark]
    return get


def _held(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts in lists of about 1 MB; a longer text ends its list."""
    held, size = [], 0
    for t in texts:
        held.append(t.as_py())
        size += len(held[-1] or "")
        if size >= 1 << 20:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_with(df: DataFrame, text: str, tokenizer: Callable[[Sequence[str | None]], Sequence], out: str = "ids") -> DataFrame:
    """``df`` with ids of its text column by a tokenizer plug-in.  Narrow: no
    exchange.  The tokenizer is broadcast once and called with the texts of a
    batch of at most 1 MB (a longer text comes alone)."""
    shipped = _shipped(df.sparkSession, tokenizer)

    def make(texts: pa.Array) -> pa.Array:
        tokenize = shipped()
        ids = [x for held in _held(texts) for x in tokenize(held)]
        lengths = np.array([0, *(len(x) for x in ids)], np.int64).cumsum()
        values = np.concatenate([np.asarray(x, np.int64) for x in ids]) if ids else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(values, pa.int64()))
    return _column(df, text, out, "array<bigint>", make)


def encode_head(df: DataFrame, text: str, tokenizer: TrieTokenizer, mark: int, out: str, rest: str) -> DataFrame:
    """``df`` with ids by the head of a vocabulary, and the distinct pre-tokens
    that it lacks, in ``rest``; the j-th of them (from 0) is ``mark - j`` among
    the ids.  ``tokenizer`` has pre-tokens and ``mark`` as its unknown id."""
    shipped = _shipped(df.sparkSession, tokenizer)
    schema = df.withColumn(out, F.lit(None).cast("array<bigint>")).withColumn(rest, F.lit(None).cast("array<string>")).schema
    at = df.columns.index(text)

    def run(batches):
        tk = shipped()
        for b in batches:
            ids, missing = [], []
            for held in _held(b.column(at)):
                parts = tk.split(held)
                for words, x in zip(parts, tk.ids_of(parts), strict=True):
                    new: dict[str, int] = {}
                    gone = np.flatnonzero(x == mark)
                    x[gone] = [mark - new.setdefault(words[i], len(new)) for i in gone.tolist()]
                    ids.append(x)
                    missing.append(list(new))
            ends = np.array([0, *(len(x) for x in ids)], np.int64).cumsum()
            values = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            made = {out: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64())),
                    rest: pa.array(missing, pa.list_(pa.string()))}
            have = dict(zip(b.schema.names, b.columns, strict=True)) | made
            yield pa.RecordBatch.from_arrays([have[n] for n in schema.names], names=schema.names)
    return df.mapInArrow(run, schema)


def decode_with(df: DataFrame, ids: str, vocab: DataFrame, out: str = "decoded", skip: Column | None = None,
                sep: str = "", limit: int = LIMIT_BYTES, more: str | None = None) -> DataFrame | None:
    """``df`` with the text of an id column: narrow, by an array of the
    vocabulary's tokens in the order of their ids.  An id that the vocabulary
    lacks becomes ``UNKNOWN_TEXT``; tokens for which ``skip`` holds are left
    out.  ``more`` names a column with the (id, token) of a row's other ids, a
    null token left out.  None if the vocabulary exceeds ``limit`` bytes."""
    if vocabulary_bytes(vocab) > limit:
        return None
    voc = vocab.where("token is not null").select(
        "id", "token", (F.coalesce(skip, F.lit(False)) if skip is not None else F.lit(False)).alias("gone")).toArrow()
    gone = np.array(voc.column("gone").to_pylist(), bool)
    keys = np.array(voc.column("id").to_pylist(), np.int64)
    order = np.argsort(keys, kind="stable")
    names = voc.column("token").to_pylist()
    names = [None if gone[i] else names[i] for i in order]
    shipped = df.sparkSession.sparkContext.broadcast((keys[order], names))

    def make(lists: pa.Array, others: pa.Array | None = None) -> pa.Array:
        have, words = shipped.value
        out = []
        for row, x in enumerate(lists):
            if not x.is_valid:
                out.append(None)
                continue
            x = x.values.to_numpy(zero_copy_only=False)
            at = np.searchsorted(have, x)
            known = (at < len(have)) & (have[np.minimum(at, len(have) - 1)] == x) if len(have) else np.zeros(len(x), bool)
            own = {o["id"]: o["token"] for o in others[row].as_py() or ()} if others is not None else {}
            parts = [words[i] if k else UNKNOWN_TEXT for i, k in zip(at.tolist(), known.tolist(), strict=True)]
            if own:
                for i in np.flatnonzero(~known).tolist():
                    parts[i] = own.get(x[i], UNKNOWN_TEXT)
            out.append(sep.join(p for p in parts if p is not None))
        return pa.array(out, pa.string())
    return _column(df, ids, out, "string", make, more)
