"""Words of a whole Arrow column at once, as positions and 64-bit hashes in numpy, and a
table of the ids of words seen before.

Words are maximal runs of bytes other than space, \\t, \\n, \\v, \\f, \\r; they never cross
from one text into the next.  A word's hash depends on its bytes only.  Hashes only choose where to
look: wherever two words count as one, their bytes have been compared.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash

#: Bytes of text handled at once (a longer single text is handled whole).
SLICE_BYTES = 2 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit (splitmix64); wraps modulo 2^64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of ``texts`` texts: byte range and text number of each, in order."""

    data: np.ndarray  # bytes
    bounds: np.ndarray  # byte offsets of the texts (texts + 1)
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.bounds) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.texts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        distinct, which = distinct_ranges(self.data, self.start, self.end)
        return hashes_of(distinct)[which]


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def distinct_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(distinct byte strings in the ranges, which of them each range holds).  Ranges ascend and don't overlap."""
    size = (end - start).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    if len(start) and offsets[-1] == end[-1] - start[0]:  # one range begins where the last one ends
        held = data[start[0]:end[-1]]
    else:
        edge = np.zeros(len(data) + 1, np.int8)
        edge[start] += 1
        edge[end] -= 1
        held = data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
    units = pa.Array.from_buffers(
        pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(held))]).dictionary_encode()
    return units.dictionary, units.indices.to_numpy().astype(np.int64)


def hashes_of(units: pa.Array) -> np.ndarray:
    data, offsets = _bytes_of(units)
    raw, ends = data.tobytes(), offsets.tolist()
    return np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(ends, ends[1:])], np.uint64)


def _bytes_of(units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all units, where each begins and the last ends) of a large_binary array."""
    offsets = np.frombuffer(units.buffers()[1], np.int64)[units.offset:units.offset + len(units) + 1]
    data = np.frombuffer(units.buffers()[2], np.uint8) if units.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


class _Pool:
    """One growing array."""

    def __init__(self, dtype: np.dtype):
        self.values, self.used = np.zeros(1 << 12, dtype), 0

    def add(self, values: np.ndarray) -> int:
        at = self.used
        if at + len(values) > len(self.values):
            grown = np.zeros(max(2 * len(self.values), at + len(values)), self.values.dtype)
            grown[:at] = self.values[:at]
            self.values = grown
        self.values[at:at + len(values)] = values
        self.used += len(values)
        return at


class UnitTable:
    """Ids of byte strings ("units"), looked up for a whole column at once.

    ``encode`` gives the serialized ids of units not seen before; they stay in arrays sorted by hash
    (with the unit's bytes and its ids in two pools) until ``most`` of them are held, then the
    table starts anew.  A unit that is found by its hash is compared with the held bytes; one
    that only shares its hash with another is encoded each time it is met.
    """

    def __init__(self, dtype: np.dtype, encode: Callable[[list[bytes]], list[bytes]], most: int, most_ids: int = 1 << 24):
        self.dtype, self.encode, self.most, self.most_ids = np.dtype(dtype), encode, most, most_ids
        self._clear()

    def _clear(self) -> None:
        self.key = np.zeros(0, np.uint64)
        # of each unit: where its bytes and its ids begin, and how many there are
        self.byte_at, self.byte_n, self.at, self.n = (np.zeros(0, np.int64) for _ in range(4))
        self.bytes, self.pool = _Pool(np.uint8), _Pool(self.dtype)

    def _known(self, key: np.ndarray, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(place in the table, whether the unit there is the same)."""
        place = np.minimum(np.searchsorted(self.key, key), max(0, len(self.key) - 1))
        if not len(self.key):
            return place, np.zeros(len(key), bool)
        data, offsets = _bytes_of(units)
        size = np.diff(offsets)
        same = (self.key[place] == key) & (self.byte_n[place] == size)
        here = np.flatnonzero(same)
        unlike = self.bytes.values[_spans(self.byte_at[place[here]], size[here])] != data[_spans(offsets[here], size[here])]
        same[np.repeat(here, size[here])[unlike]] = False
        return place, same

    def ids(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units in order, number of ids of each unit)."""
        if not len(start):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        if len(self.key) > self.most or self.pool.used > self.most_ids or self.bytes.used > self.most_ids:
            self._clear()
        units, which = distinct_ranges(data, start, end)
        key = hashes_of(units)
        place, known = self._known(key, units)
        at, n = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        at[known], n[known] = (x[place[known]] for x in (self.at, self.n)) if known.any() else (0, 0)
        new = np.flatnonzero(~known)
        if len(new):
            fresh = units.take(pa.array(new))
            ids = self.encode(fresh.to_pylist())
            n[new] = [len(x) // self.dtype.itemsize for x in ids]
            at[new] = self.pool.add(np.frombuffer(b"".join(ids), self.dtype)) + np.cumsum(n[new]) - n[new]
            # of units with one hash, the first is held
            taken = self.key[place[new]] == key[new] if len(self.key) else np.zeros(len(new), bool)
            hold = np.unique(key[new], return_index=True)[1]
            hold = hold[~taken[hold]]
            raw, offsets = _bytes_of(fresh)
            size = np.diff(offsets)
            byte_at = self.bytes.add(raw[offsets[0]:offsets[-1]]) + offsets[:-1] - offsets[0]
            where = np.searchsorted(self.key, key[new][hold])
            self.key = np.insert(self.key, where, key[new][hold])
            self.byte_at, self.byte_n, self.at, self.n = (
                np.insert(old, where, x[hold]) for old, x in
                ((self.byte_at, byte_at), (self.byte_n, size), (self.at, at[new]), (self.n, n[new])))
        size = n[which]
        return self.pool.values[_spans(at[which], size)], size


def words_of(texts: pa.Array) -> Words:
    """Words of a string array; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = (np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
            if texts.buffers()[2] is not None else np.zeros(0, np.uint8))
    bounds = offsets - offsets[0]
    inside = ~_BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = bounds[:-1][bounds[:-1] < len(data)]
    begins[cut] = inside[cut]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cut = bounds[1:][bounds[1:] > 0] - 1
    ends[cut] = inside[cut]
    start = np.flatnonzero(begins)
    return Words(data, bounds, start, np.flatnonzero(ends) + 1,
                 np.searchsorted(bounds, start, "right") - 1)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in consecutive parts of about SLICE_BYTES in a column of strings or of lists."""
    of = batch.column(column)
    sizes = (pa.compute.binary_length(of) if pa.types.is_string(of.type) or pa.types.is_large_string(of.type)
             else pa.compute.multiply(pa.compute.list_value_length(of), 4))
    part = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows] if batch.num_rows else [0]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)
    release()


def release() -> None:
    """Give freed memory back: Spark keeps Python workers for later tasks and stages, and
    what their allocators hold on to is missing there."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)
