"""BagMinHash signatures: unbiased weighted-Jaccard sketches of multisets.

An element x of integer weight c stands for Poisson processes over the weight axis: one on
[0, 1), one on [1, 2), one on [2, 4), one on [4, 8), and so on, each seeded by (x, range) alone
and with a rate of one point per register and unit of weight.  Every point falls on one
register and one unit of its range.  An element of weight c owns the points below c: all of
the ranges that lie below, and of the range that c cuts those in its lower units.  A register
keeps its earliest point, so two multisets agree on a register with probability
sum(min) / sum(max) of their weights.

Weights are discretised at the integers, where word counts lie, so nothing is rounded; the
doubling ranges make the work per element logarithmic in its weight.  Points are drawn in
order of time and only while they can still matter: up to a limit that fills all registers
of almost every bag; bags with an open register are drawn further.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from fulcrum.llm import wordhash

SHINGLE = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_counts(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count) of the word shingles of each text, sorted by text and hash.  A text
    of fewer words is one shingle of all of them; a text without a word has none.  Hashes are
    for sketches: what is decided by shingles goes by ``exact_shingles``."""
    w = wordhash.words_of(texts)
    hashes = w.hashes()
    text, at, words = _windows(w.counts(), size)
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        here = words > k
        step = np.where(here, hashes[np.minimum(at + k, max(0, len(hashes) - 1))] if len(hashes) else np.uint64(0), np.uint64(0))
        total = np.where(here, wordhash.mix(total * np.uint64(0xD6E8FEB86659FD93) + step + np.uint64(k + 1)), total)
    return _counted(text, total)


def exact_shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, number, count) like ``shingle_counts``, where equal numbers mean equal words: words are told
    apart by their bytes, and a shingle is numbered by its beginning's number and its last word's."""
    parts, counts = [], []
    for part in wordhash.slices(pa.record_batch([texts], ["text"]), 0):
        w = wordhash.words_of(part.column(0))
        distinct, which = wordhash.distinct_ranges(w.data, w.start, w.end)
        parts.append(pa.DictionaryArray.from_arrays(pa.array(which), distinct))
        counts.append(w.counts())
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = pa.chunked_array(parts).unify_dictionaries()
    word = np.concatenate([c.indices.to_numpy() for c in joined.chunks]).astype(np.int64) + 1
    text, at, words = _windows(np.concatenate(counts), size)
    number = word[at]
    for k in range(1, size):
        here = np.where(words > k, word[np.minimum(at + k, max(0, len(word) - 1))] if len(word) else 0, 0)
        number = np.unique(number * (len(word) + 1) + here, return_inverse=True)[1]
    return _counted(text, number)


def _windows(n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of each shingle of texts of ``n`` words."""
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    taken = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), taken)
    at = np.repeat(first - (np.cumsum(taken) - taken), taken) + np.arange(taken.sum())
    return text, at, np.minimum(n, size)[text]


def _counted(text: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (key[1:] != key[:-1])
    where = np.flatnonzero(new)
    return text[where], key[where], np.diff(np.append(where, len(text)))


def _ranges(text: np.ndarray, element: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, seed, units, owned): the ranges below each weight; ``owned`` of ``units`` count."""
    out, low, units = [], 0, 1
    while True:
        live = count > low
        if not live.any():
            break
        text, element, count = text[live], element[live], count[live]
        out.append((text, wordhash.mix(element + np.uint64(low * int(_STEP) % (1 << 64))), np.full(len(text), units), np.minimum(count - low, units)))
        low, units = low + units, max(1, low + units)
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, np.zeros(0, np.uint64), empty, empty
    return tuple(np.concatenate(c) for c in zip(*out))


def signatures(text: np.ndarray, element: np.ndarray, count: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """(texts, registers) of uint32: the earliest times as 32-bit floats, all ones for an
    empty bag.  A time is rounded to 24 bits, so another machine's last bit doesn't show."""
    best = np.full(texts * registers, np.inf)
    weight = np.bincount(text, weights=count, minlength=texts)
    limit = (np.log(registers) + 3.0) / np.maximum(weight, 1)
    waiting = Processes.start(*_ranges(text, element, count), registers)
    while len(waiting.of):
        later = []
        while len(waiting.of):
            live = waiting.time <= limit[waiting.of]
            later.append(waiting.where(~live))
            waiting = waiting.where(live)
            waiting.enter(best)
            waiting = waiting.next()
        open_ = np.isinf(best).reshape(texts, registers).any(axis=1) & (weight > 0)
        limit = np.where(open_, limit * 2, limit)
        waiting = Processes.joined([p.where(open_[p.of]) for p in later])
    sketch = best.astype(np.float32).view(np.uint32).reshape(texts, registers)
    return np.where((weight > 0)[:, None], sketch, np.uint32(0xFFFFFFFF))


@dataclass
class Processes:
    """Poisson processes, each at its ``drawn``-th point, which lies at ``time``."""

    of: np.ndarray
    seed: np.ndarray
    units: np.ndarray
    owned: np.ndarray
    time: np.ndarray
    drawn: np.ndarray
    registers: int

    @classmethod
    def start(cls, of, seed, units, owned, registers: int) -> Processes:
        return cls(of, seed, units, owned, np.zeros(len(of)), np.zeros(len(of), np.uint64), registers).next()

    def next(self) -> Processes:
        drawn = self.drawn + np.uint64(1)
        r = wordhash.mix(self.seed + drawn * _STEP)
        uniform = ((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        time = self.time - np.log(uniform) / (self.units * float(self.registers))
        return Processes(self.of, self.seed, self.units, self.owned, time, drawn, self.registers)

    def where(self, mask: np.ndarray) -> Processes:
        return Processes(self.of[mask], self.seed[mask], self.units[mask], self.owned[mask], self.time[mask],
                         self.drawn[mask], self.registers)

    @staticmethod
    def joined(parts: list[Processes]) -> Processes:
        columns = [[getattr(p, f) for p in parts] for f in ("of", "seed", "units", "owned", "time", "drawn")]
        return Processes(*map(np.concatenate, columns), parts[0].registers)

    def enter(self, best: np.ndarray) -> None:
        """Enter the points into their registers, if the element owns their unit."""
        r = wordhash.mix(self.seed ^ wordhash.mix(self.drawn * _STEP + np.uint64(1)))
        register = ((r >> np.uint64(32)) * np.uint64(self.registers)) >> np.uint64(32)
        unit = ((r & np.uint64(0xFFFFFFFF)) * self.units.astype(np.uint64)) >> np.uint64(32)
        mine = unit < self.owned.astype(np.uint64)
        np.minimum.at(best, self.of[mine] * self.registers + register[mine].astype(np.int64), self.time[mine])
