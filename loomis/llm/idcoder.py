"""Adaptive context-mixing range coder for token ids (numpy).

A block is coded on its own: its ids are dealt to lanes that are coded in step,
one numpy operation for all lanes, under one model that learns from all of them
after each step.  The next id is predicted by order 2 (hashed pair of previous
ids), order 1 (previous id) and order 0 (adaptive frequencies).  Orders 1 and 2
name one id each; their shares of the probability are mixed by how often such
predictions came true at their joint confidence so far, the rest goes to order
0.  The cumulative distribution of that mixture is closed-form, so a symbol is
coded and found without a walk over the alphabet.  All model arithmetic is in
integers, hence the decoder repeats it exactly on any machine.

Block layout (little endian): magic, ids, lanes, words of each lane, words, then
the CRC-32 of everything before it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"LCM2"
LANE_STEPS = 256        # ids in a lane, about
MAX_LANES = 4096
REFRESH = 8             # steps between updates of the order-0 frequencies
T_BITS, F_BITS = 24, 18  # total of the mixture, total of order 0
PAIR_BITS = 20          # slots of the order-2 table
# Confidence after a miss (first 16) and after a hit, by confidence before.
CONF = np.array([1, 1] + [c >> 1 for c in range(2, 16)] + [min(c + 1, 15) for c in range(16)], np.int32)
KEEPS = np.array([-1 if c > 1 else 0 for c in range(16)], np.int32)  # may the prediction stay after a miss?
_U = np.uint64


class Model:
    """The adaptive mixture; encoder and decoder drive it alike."""

    def __init__(self, vocab: int, lanes: int, decodes: bool = False):
        if vocab > (1 << F_BITS) // 2:
            raise ValueError("vocabulary too large for the order-0 total")
        self.vocab, self.decodes = vocab, decodes
        self.counts = np.zeros(vocab, np.int64)
        self.recent: list[np.ndarray] = []
        # Predicted id and, in the low four bits, its confidence.
        self.order1 = np.zeros(vocab, np.int32)
        self.order2 = np.zeros(1 << PAIR_BITS, np.int32)
        self.prev1 = np.zeros(lanes, np.int64)
        self.prev2 = np.zeros(lanes, np.int64)
        self.tries = np.zeros(512, np.int64)   # by conf1, conf2 and agreement
        self.hits1, self.hits2 = np.zeros(512, np.int64), np.zeros(512, np.int64)
        self.refresh()

    def refresh(self) -> None:
        if self.recent:
            self.counts += np.bincount(np.concatenate(self.recent), minlength=self.vocab) * 32
            self.recent = []
        room = (1 << F_BITS) - self.vocab
        total = int(self.counts.sum()) + self.vocab
        f = 1 + (self.counts + 1) * room // total
        f[np.argmax(f)] += (1 << F_BITS) - int(f.sum())
        self.cum = np.concatenate(([0], np.cumsum(f)))
        if self.decodes:
            self.inverse = np.repeat(np.arange(self.vocab), f)

    def predict(self) -> None:
        """Set this step's predicted ids (a <= b) and masses."""
        slot = self.prev2 * 0x9E3779B1
        slot += self.prev1 * 0x85EBCA6B
        slot >>= 7
        slot &= (1 << PAIR_BITS) - 1
        self.slot = slot
        e1, e2 = self.order1.take(self.prev1), self.order2.take(slot)
        self.p1, self.c1 = e1 >> 4, e1 & 15
        self.p2, self.c2 = e2 >> 4, e2 & 15
        self.state = (self.p1 == self.p2) * np.int64(256)
        self.state += (self.c1 << 4) + self.c2
        spare = (1 << T_BITS) - (1 << F_BITS)
        share = spare // (2 * self.tries + 6)
        w1, w2 = share * (2 * self.hits1 + 1), share * (2 * self.hits2 + 1)
        w1[256:] = 0  # one id, predicted by both: order 2 speaks for it
        both = w1 + w2
        first = self.p1 < self.p2
        self.a, self.b = np.minimum(self.p1, self.p2), np.maximum(self.p1, self.p2)
        self.wa = np.concatenate((w2, w1)).astype(np.int32).take(first * np.int64(512) + self.state)
        self.wb = both.astype(np.int32).take(self.state) - self.wa
        self.w0 = ((1 << T_BITS) - both).take(self.state)

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cumulative, frequency) of the ids out of 2**T_BITS."""
        lo, end = self.cum.take(ids), self.cum[1:].take(ids)
        lo *= self.w0
        lo >>= F_BITS
        end *= self.w0
        end >>= F_BITS
        end -= lo
        ids = ids.astype(np.int32)
        lo += (ids > self.a) * self.wa + (ids > self.b) * self.wb
        end += (ids == self.a) * self.wa + (ids == self.b) * self.wb
        return lo, end

    def find(self, t: np.ndarray) -> np.ndarray:
        """The id whose interval holds ``t``."""
        def scaled(cum, at):
            out = cum.take(at)
            out *= self.w0
            out >>= F_BITS
            return out
        after = self.cum[1:]
        end_a = scaled(after, self.a) + self.wa
        from_b, end_b = scaled(self.cum, self.b) + self.wa, scaled(after, self.b) + (self.wa + self.wb)
        past_a, past_b = t >= end_a, t >= end_b
        # Without the predictions' own shares, order 0 alone places the rest.
        u = t - (past_a * self.wa + past_b * self.wb)
        u += 1
        u <<= F_BITS
        u -= 1
        u //= self.w0
        ids = self.inverse.take(np.minimum(u, (1 << F_BITS) - 1, out=u))
        at_b = ~past_b & (t >= from_b) & (self.b > self.a)
        at_a = ~past_a & (t >= scaled(self.cum, self.a))
        np.copyto(ids, self.b, where=at_b)
        np.copyto(ids, self.a, where=at_a)
        return ids

    def update(self, ids: np.ndarray, n: int, step: int) -> None:
        """Learn the first ``n`` lanes' ids."""
        i = ids[:n]
        id4 = i.astype(np.int32)
        k1, k2 = self.prev1[:n], self.slot[:n]
        p1, p2, c1, c2 = self.p1[:n], self.p2[:n], self.c1[:n], self.c2[:n]
        ok1, ok2 = (p1 == id4).astype(np.int32), (p2 == id4).astype(np.int32)
        seen = np.bincount(self.state[:n] * 4 + (ok1 * 2 + ok2), minlength=2048).reshape(512, 4)
        self.tries += seen.sum(1)
        self.hits1 += seen[:, 2] + seen[:, 3]
        self.hits2 += seen[:, 1] + seen[:, 3]
        # A miss at low confidence gives the place to the id that came.
        for table, slot, p, c, ok in ((self.order1, k1, p1, c1, ok1), (self.order2, k2, p2, c2, ok2)):
            entry = id4 ^ ((id4 ^ p) & KEEPS.take(c))
            entry <<= 4
            ok <<= 4
            ok += c
            entry += CONF.take(ok)
            table[slot] = entry
        self.recent.append(i)
        self.prev2[:n], self.prev1[:n] = k1.copy(), i
        if (step + 1) % REFRESH == 0:
            self.refresh()


def _lanes(n: int) -> tuple[int, int]:
    lanes = min(MAX_LANES, max(1, n // LANE_STEPS))
    return lanes, -(-n // lanes) if n else 0


def _renorm(low, rng):
    """Lanes that put out a word, after cutting ranges that straddle one."""
    out = np.flatnonzero(rng < _U(1 << 32))
    l, g = low[out], rng[out]
    straddle = ((l ^ (l + g - _U(1))) >> _U(32)) != 0
    rng[out] = np.where(straddle, _U(1 << 32) - (l & _U(0xFFFFFFFF)), g)
    return out


def encode_block(ids: np.ndarray, vocab: int) -> bytes:
    """One checksummed block of ids."""
    n = len(ids)
    lanes, steps = _lanes(n)
    # Column t holds step t of every lane; the last column may be short, and
    # lanes are sorted so that its filled part comes first.
    full = n - lanes * (steps - 1) if steps else 0
    grid = np.zeros((steps, lanes), np.int64)
    flat = np.asarray(ids, np.int64)
    split = full * steps
    grid[:, :full] = flat[:split].reshape(full, steps).T
    if full < lanes:
        grid[:steps - 1, full:] = flat[split:].reshape(lanes - full, steps - 1).T
    model = Model(vocab, lanes)
    low, rng = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
    words = np.zeros((lanes, steps + 2), np.uint32)
    count = np.zeros(lanes, np.int64)
    for t in range(steps):
        k = lanes if t < steps - 1 else full
        model.predict()
        lo, freq = model.interval(grid[t])
        r = rng[:k] >> _U(T_BITS)
        low[:k] += r * lo[:k].astype(_U)
        rng[:k] = r * freq[:k].astype(_U)
        l, g = low[:k], rng[:k]
        out = _renorm(l, g)
        words[out, count[out]] = (l[out] >> _U(32)).astype(np.uint32)
        count[out] += 1
        l[out] <<= _U(32)
        g[out] <<= _U(32)
        model.update(grid[t], k, t)
    every = np.arange(lanes)
    for shift in (32, 0):
        words[every, count] = ((low >> _U(shift)) & _U(0xFFFFFFFF)).astype(np.uint32)
        count += 1
    body = words[np.arange(words.shape[1]) < count[:, None]] if n else np.empty(0, np.uint32)
    head = MAGIC + struct.pack("<QII", n, vocab, lanes) + count.astype("<u4").tobytes()
    data = head + body.astype("<u4").tobytes()
    return data + struct.pack("<I", zlib.crc32(data))


def decode_block(data: bytes) -> np.ndarray:
    """The ids of one block; raises ValueError if it is damaged."""
    if len(data) < 24 or data[:4] != MAGIC or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("damaged token block: checksum or magic differs")
    n, vocab, lanes = struct.unpack("<QII", data[4:20])
    if not n:
        return np.empty(0, np.int64)
    steps = _lanes(n)[1]
    full = n - lanes * (steps - 1)
    count = np.frombuffer(data, "<u4", lanes, 20).astype(np.int64)
    body = np.frombuffer(data, "<u4", int(count.sum()), 20 + 4 * lanes).astype(_U)
    body = np.concatenate((body, np.zeros(2, _U)))
    at = np.cumsum(count) - count
    code = (body[at] << _U(32)) | body[at + 1]
    at += 2
    model = Model(vocab, lanes, decodes=True)
    low, rng = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
    grid = np.zeros((steps, lanes), np.int64)
    for t in range(steps):
        k = lanes if t < steps - 1 else full
        model.predict()
        r = rng >> _U(T_BITS)
        x = np.minimum((code - low) // r, _U((1 << T_BITS) - 1)).astype(np.int64)
        ids = model.find(x)
        grid[t, :k] = ids[:k]
        lo, freq = model.interval(ids)
        low[:k] += r[:k] * lo[:k].astype(_U)
        rng[:k] = r[:k] * freq[:k].astype(_U)
        l, g = low[:k], rng[:k]
        out = _renorm(l, g)
        l[out] <<= _U(32)
        g[out] <<= _U(32)
        code[out] = (code[out] << _U(32)) | body[np.minimum(at[out], len(body) - 1)]
        at[out] += 1
        model.update(ids, k, t)
    out = np.empty(n, np.int64)
    split = full * steps
    out[:split] = grid[:, :full].T.ravel()
    if full < lanes:
        out[split:] = grid[:steps - 1, full:].T.ravel()
    return out
