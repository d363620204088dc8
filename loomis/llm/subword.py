"""Subword ids of the tokenizers library, piece by piece.

A byte-level tokenizer cuts a text into pieces and merges inside each piece
alone, so a piece has the same ids wherever it stands.  ``PieceTokenizer`` cuts
with the tokenizer's own pattern, hands each new piece to the library's model
and keeps its ids; from then on a piece costs a look-up in each batch of texts,
however often it stands there.  What could be cut differently goes through the
library whole: texts with one of its special strings, or with characters whose
class is not the same in every Unicode version, and all texts under a tokenizer
of another kind.
"""

from __future__ import annotations

import gc
import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  -- used as pa.compute
import regex
from tokenizers import Tokenizer

CACHE_PIECES = 1_000_000
JOINED = 100             # pieces merged in one call
PLAIN_MARKS = ".,;:!?"
# Fixed value: the pattern of the byte-level pre-tokenizer.
PIECE_RE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Where a single space stands between other characters, a new piece starts.
_RUNS = regex.compile(r"\s\s")
_TOKENIZERS: dict[str, "PieceTokenizer"] = {}


def byte_letters() -> dict[int, str]:
    """The letter that the byte-level alphabet writes for each byte: printable
    bytes stand for themselves, the others are numbered from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)}


def _steady(ch: str) -> bool:
    """Is this character of the same class in every Unicode version since 3.2?"""
    old, new = unicodedata.ucd_3_2_0.category(ch), unicodedata.category(ch)
    if ch in " \t\n\r":
        return True
    return old[0] == new[0] and old[0] in "LNPSM"


def _cut(word: str) -> list[str]:
    """Pieces of a space and the word; a line end between words, the usual
    case, without the pattern."""
    a, nl, b = word.partition("\n")
    if nl and b.isalpha():
        if a.isalpha():
            return [" " + a, nl, b]
        if a[-1:] in PLAIN_MARKS and a[:-1].isalpha():
            return [" " + a[:-1], a[-1], nl, b]
    return PIECE_RE.findall(" " + word)


class PieceTokenizer:
    """Ids of whole texts as little-endian bytes, 16 or 32 bits each."""

    def __init__(self, path: str, limit: int = CACHE_PIECES):
        self.lib = Tokenizer.from_file(path)
        self.vocab = self.lib.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if self.vocab <= 1 << 16 else "<u4")
        self.limit = limit
        self._reset()
        self.steady: set[str] = set()
        self.letters = byte_letters()
        self.model = self.lib.model
        spec = json.loads(self.lib.to_str())
        cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.by_piece = (cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space")
                         and cut.get("use_regex", True) and not spec.get("normalizer")
                         and model["type"] == "BPE" and not model.get("dropout"))
        # May pieces be merged in one call, parted by NUL?
        nul = self.letters[0]
        self.joins = (model["type"] == "BPE" and self.model.token_to_id(nul) is not None and not model.get("ignore_merges")
                      and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
                      and not any(nul in t and t != nul for t in model.get("vocab", ())))
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def whole(self, texts: list[str]) -> list[bytes]:
        """The library's ids of whole texts."""
        return [np.array(e.ids, self.kind).tobytes()
                for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _reset(self) -> None:
        """Forget all parts.  Code 0 has no ids and marks a part whose ids are
        not known surely, code 1 is the empty text."""
        self.words: dict[str, int] = {}   # codes of parts behind a space, by what follows it
        self.others: dict[str, int] = {}  # codes of other parts
        self.pool, self.at = np.empty(0, self.kind), np.zeros(3, np.int64)

    def _add(self, ids: np.ndarray, ends: np.ndarray) -> range:
        """Codes of new parts, whose ids stop at ``ends``."""
        base = len(self.at) - 1
        self.at = np.concatenate((self.at, len(self.pool) + ends))
        self.pool = np.concatenate((self.pool, ids))
        return range(base, base + len(ends))

    def _ids(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts, one behind the other, and where each stops."""
        start = self.at[codes]
        length = self.at[codes + 1] - start
        stop = np.cumsum(length)
        start -= stop - length
        where = np.repeat(start, length)
        where += np.arange(len(where))
        return self.pool[where], stop

    def _merge(self, pieces: list[str]) -> range:
        """Codes of new pieces, by the library's model."""
        merge, nul = self.model.tokenize, self.letters[0]
        if not self.joins or any("\0" in p for p in pieces):
            each = [[t.id for t in merge(self._spell(p))] for p in pieces]
            return self._add(np.array([i for e in each for i in e], self.kind), np.cumsum([len(e) for e in each], dtype=np.int64))
        # NUL, with which nothing merges, parts the pieces of one call.
        flat = []
        for x in range(0, len(pieces), JOINED):
            flat += [t.id for t in merge(self._spell("\0".join(pieces[x:x + JOINED]) + "\0"))]
        ids = np.array(flat, self.kind)
        parting = ids == self.model.token_to_id(nul)
        return self._add(ids[~parting], np.flatnonzero(parting) - np.arange(len(pieces)))

    def _compose(self, codes, sizes) -> range:
        """Codes of new parts that are made of known ones, ``sizes`` of each."""
        ids, stop = self._ids(np.array(codes, np.int64))
        return self._add(ids, stop[np.cumsum(sizes) - 1])

    def _learn(self, words: list[str], others: list[str]) -> None:
        """Keep the ids of new parts, except those that may be cut differently
        between versions."""
        fresh = set("".join(words)).union(*others) - self.steady
        doubt = {c for c in fresh if not _steady(c)}
        self.steady |= fresh - doubt
        if doubt:
            words, others = ([p for p in x if doubt.isdisjoint(p)] for x in (words, others))
        # A word with a mark, the usual case, is cut without the pattern.
        behind, marked, cuts = set(), [], [(self.others, p, PIECE_RE.findall(p)) for p in others]
        for w in words:
            if w.isalpha():
                behind.add(w)
            elif w[-1:] in PLAIN_MARKS and w[:-1].isalpha():
                marked.append(w)
            else:
                cuts.append((self.words, w, _cut(w)))
        pieces = {p for c in cuts for p in c[2]}
        behind.update(p[1:] for p in pieces if p[0] == " ")
        pieces = {p for p in pieces if p[0] != " "}
        stems = [w[:-1] for w in marked]
        behind.update(stems)
        pieces.update(w[-1] for w in marked)
        new = [[w for w in behind if w not in self.words], [p for p in pieces if p not in self.others]]
        codes = self._merge([" " + w for w in new[0]] + new[1])
        self.words.update(zip(new[0], codes))
        self.others.update(zip(new[1], codes[len(new[0]):]))
        if marked:
            both = np.empty((len(marked), 2), np.int64)
            both[:, 0] = list(map(self.words.__getitem__, stems))
            both[:, 1] = [self.others[w[-1]] for w in marked]
            self.words.update(zip(marked, self._compose(both.ravel(), np.full(len(marked), 2))))
        cuts = [c for c in cuts if len(c[2]) > 1]
        if cuts:
            flat = [self.words[p[1:]] if p[0] == " " else self.others[p] for c in cuts for p in c[2]]
            for (known, part, _), code in zip(cuts, self._compose(flat, [len(c[2]) for c in cuts])):
                known[part] = code

    def _codes(self, words: list[str], others: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of distinct parts, those behind a space and others."""
        found = [list(map(self.words.get, words)), list(map(self.others.get, others))]
        missing = sum(f.count(None) for f in found)
        if missing:
            if len(self.words) + len(self.others) + missing > self.limit:
                self._reset()
                found = [[None] * len(words), [None] * len(others)]
            self._learn(*[[p for p, c in zip(parts, f) if c is None] for parts, f in zip((words, others), found)])
            found = [[known.get(p) if c is None else c for p, c in zip(parts, f)]
                     for known, parts, f in zip((self.words, self.others), (words, others), found)]
        return tuple(np.array([c or 0 for c in f], np.int64) for f in found)

    def _spell(self, pieces: str) -> str:
        """Text in the letters of the byte-level alphabet."""
        return pieces.encode().decode("latin-1").translate(self.letters)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text.  The lists made on the way form no cycles, so the
        collector, which would walk over all of them again and again, waits."""
        on = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if on:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        out: list = [b""] * len(texts)
        whole, spaced, runs = [], [], []
        for i, t in enumerate(texts):
            if not self.by_piece or (self.special and self.special.search(t)):
                whole.append(i)
            elif t:
                (runs if _RUNS.search(t) else spaced).append(i)
        # Each distinct part is looked up once.  Texts cut at spaces:
        cut = pa.compute.split_pattern(pa.array([texts[i] for i in spaced], pa.large_string()), " ")
        first = cut.offsets.to_numpy()[:-1]
        coded = cut.values.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # A text's first word has no space before it.
        heads = [texts[i].split(" ", 1)[0] for i in spaced]
        # Texts with runs of white space, cut by the pattern:
        cuts = [PIECE_RE.findall(texts[i]) for i in runs]
        pieces, sizes = [p for c in cuts for p in c], [len(c) for c in cuts]
        others = {p: k for k, p in enumerate(dict.fromkeys(p for p in heads + pieces if p))}
        behind, plain = self._codes(words, list(others))
        plain = np.append(plain, 1)
        code = behind[coded.indices.to_numpy()]
        code[first] = plain[np.array([others.get(w, -1) for w in heads], np.int64)]
        code = np.append(code, plain[np.array([others[p] for p in pieces], np.int64)])
        edge = np.concatenate((first, len(coded) + np.cumsum([0, *sizes], dtype=np.int64)))
        if len(code):
            ids, stop = self._ids(code)
            sure = np.logical_and.reduceat(code > 0, edge[:-1])
            raw, x = ids.tobytes(), 0
            for i, y, ok in zip(spaced + runs, (stop[edge[1:] - 1] * self.kind.itemsize).tolist(), sure.tolist()):
                if ok:
                    out[i] = raw[x:y]
                else:
                    whole.append(i)
                x = y
        for i, raw in zip(whole, self.whole([texts[i] for i in whole])):
            out[i] = raw
        return out


def piece_tokenizer(path: str) -> PieceTokenizer:
    """This worker's tokenizer for ``path``."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = PieceTokenizer(path)
    return _TOKENIZERS[path]
