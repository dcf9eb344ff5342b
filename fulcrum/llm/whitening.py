"""Embedding whitening by incremental eigendecomposition.

Every entry c of a vector becomes the integer ``floor(1024 c) + 100000``.  Three steps find the unit eigenvectors
of the integers' covariance:

* **Incremental spectra.**  A task keeps the count, the exact integer sums and the eigendecomposition of
  the centred scatter of the rows it has seen.  It takes rows a block at a time, folds a block into at most D
  vectors of the same centred scatter (the triangle of a QR, so a row costs O(D^2) and not O(D^3)) and applies
  each of them, then the shift of the mean, as a rank-one update: secular equations with deflation
  (``secular.py``).
* **Combination.**  Spectra meet up a tree of ``FAN_IN`` per node; each eigenvector of the one, weighted by its
  value, and the difference of the means are rank-one updates of the other.
* **Rayleigh-Ritz.**  One more pass projects the exactly centred rows on the combined vectors and sums the
  D x D matrix of the projections up the same tree; its eigenvectors turn the basis into the final one, to double
  precision, whatever rounding the updates gathered.

A state is one row of D^2 + 2 D numbers per task, so what a node of the tree and at last the driver hold
depends on the dimension alone, not on the number of rows.  Tree nodes merge in order, so
reruns over the same splits agree.  A last pass measures the whitened covariance.

Defined results: vectors that are null or empty or hold a null or a non-finite entry are dropped, and so are those
whose length isn't the most frequent (of two, the smaller); zero vectors count; a null id is kept; repeated rows
count as often as they stand; an entry beyond 2^40 in size counts as 2^40; components whose variance is under 1e-12 of
the total have no direction and are left out (equal vectors, fewer rows than dimensions, an empty table: fewer or no result
rows); of equal variances any orthogonal directions; each direction's largest entry is positive; a deviation
that passes 64 bits is null; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulcrum.llm.scratch import Scratch
from fulcrum.llm.secular import rank_one

SCALE, SHIFT, CLIP = 1024, 100_000, 1 << 40
COMPONENTS, LEAST_SHARE = 8, 1e-12
#: Entries handled at once, and states merged by a node.
BLOCK_ENTRIES, FAN_IN = 1 << 20, 16

_STATE = "part long, n long, sums array<long>, numbers array<double>"


def usable(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """(rows (id, v) that take part, their dimension)."""
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce((F.size("v") > 0) & good, F.lit(False)))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = usual.d if usual else 0
    return rows.where(F.size("v") == dim), dim


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, integer vectors) of some rows at a time."""
    rows = max(1, BLOCK_ENTRIES // dim)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            c = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            yield part.column(0), np.clip(np.floor(SCALE * c), -CLIP, CLIP).astype(np.int64) + SHIFT


@dataclass
class Spectrum:
    """Count, exact sums, and the eigendecomposition of the centred scatter of some rows."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim, np.int64), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray) -> None:
        """Rows of integers."""
        sums = x.sum(axis=0)
        centred = x - sums / len(x)
        if len(x) > x.shape[1]:
            centred = np.linalg.qr(centred, mode="r")
        self._take(len(x), sums, ((1.0, row) for row in centred))

    def merge(self, other: Spectrum) -> None:
        self._take(other.n, other.sums, ((v, q) for v, q in zip(other.values, other.vectors.T) if v > 0))

    def _take(self, n: int, sums: np.ndarray, terms) -> None:
        for weight, v in terms:
            self.values, self.vectors = rank_one(self.values, self.vectors, v, weight)
        if self.n and n:
            apart = sums / n - self.sums / self.n
            self.values, self.vectors = rank_one(self.values, self.vectors, apart, self.n * n / (self.n + n))
        self.n, self.sums = self.n + n, self.sums + sums

    def row(self, part: int) -> tuple:
        return part, self.n, self.sums, np.concatenate([self.values, self.vectors.ravel()])

    @classmethod
    def of(cls, n: int, sums: np.ndarray, numbers: np.ndarray) -> Spectrum:
        dim = len(sums)
        return cls(n, sums, numbers[:dim], numbers[dim:].reshape(dim, dim))


def _state(rows: list[tuple]) -> pa.RecordBatch:
    part, n, sums, numbers = zip(*rows)
    return pa.record_batch([
        pa.array(part, pa.int64()), pa.array(n, pa.int64()), pa.array([s.tolist() for s in sums], pa.list_(pa.int64())),
        pa.array([x.tolist() for x in numbers], pa.list_(pa.float64()))], ["part", "n", "sums", "numbers"])


def _merge_spectra(states: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    whole = Spectrum.of(*states[0])
    for state in states[1:]:
        whole.merge(Spectrum.of(*state))
    return whole.row(0)[1:]


def _add_up(states: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    n, sums, numbers = states[0]
    for m, s, x in states[1:]:
        n, sums, numbers = n + m, sums + s, numbers + x
    return n, sums, numbers


def _up_the_tree(states: DataFrame, merge: Callable, scratch: Scratch, name: str) -> tuple[int, np.ndarray, np.ndarray] | None:
    """All states merged, FAN_IN at a time, in the order of their parts."""
    states = scratch.write(states, name)
    most = states.agg(F.max("part")).first()[0]
    if most is None:
        return None

    def node(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        found = [(n, np.array(s, np.int64), np.array(x, float)) for n, s, x in zip(
            table.column("n").to_pylist(), table.column("sums").to_pylist(), table.column("numbers").to_pylist())]
        return pa.Table.from_batches([_state([(key[0].as_py(), *merge(found))])])

    up = states
    while most:
        up = up.withColumn("node", F.expr(f"part div {FAN_IN}")).groupBy("node").applyInArrow(node, _STATE)
        most //= FAN_IN
    last = up.first()
    scratch.remove(states)
    return last.n, np.array(last.sums, np.int64), np.array(last.numbers, float)


def _per_task(rows: DataFrame, dim: int, start: Callable, take: Callable, finish: Callable) -> DataFrame:
    """One state per task that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for _, x in _blocks(batches, dim):
            held = take(start() if held is None else held, x)
        if held is not None:
            yield _state([(TaskContext.get().partitionId(), *finish(held))])

    return rows.mapInArrow(run, _STATE)


def spectrum(rows: DataFrame, dim: int, scratch: Scratch) -> Spectrum | None:
    """The combined spectrum of all rows, from incremental updates alone."""

    def take(held: Spectrum, x: np.ndarray) -> Spectrum:
        held.add(x)
        return held

    states = _per_task(rows, dim, lambda: Spectrum.empty(dim), take, lambda held: held.row(0)[1:])
    found = _up_the_tree(states, _merge_spectra, scratch, "spectra")
    return Spectrum.of(*found) if found else None


def _projected(rows: DataFrame, dim: int, centre: np.ndarray, basis: np.ndarray, scratch: Scratch, name: str) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sum, sum of outer products) of the centred rows' projections on ``basis``."""
    k = basis.shape[1]

    def take(held: tuple, x: np.ndarray) -> tuple:
        w = (x - centre) @ basis
        return held[0] + len(x), held[1] + w.sum(axis=0), held[2] + w.T @ w

    states = _per_task(
        rows, dim, lambda: (0, np.zeros(k), np.zeros((k, k))), take,
        lambda held: (held[0], np.zeros(0, np.int64), np.concatenate([held[1], held[2].ravel()])))
    n, _, numbers = _up_the_tree(states, _add_up, scratch, name)
    return n, numbers[:k], numbers[k:].reshape(k, k)


@dataclass
class Whitening:
    """Directions (columns) divided by the root of their variance, with what belongs to them."""

    n: int
    sums: np.ndarray
    scaled: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def centre(self) -> np.ndarray:
        return self.sums / self.n


def fit(rows: DataFrame, dim: int, scratch: Scratch, components: int = COMPONENTS) -> Whitening | None:
    """None if there is no row."""
    first = spectrum(rows, dim, scratch) if dim else None
    if first is None:
        return None
    centre = first.sums / first.n
    n, _, scatter = _projected(rows, dim, centre, first.vectors, scratch, "ritz")
    values, turn = np.linalg.eigh(scatter / n)
    values, vectors = values[::-1], (first.vectors @ turn)[:, ::-1]
    total = float(values.sum())
    wanted = np.flatnonzero(values > LEAST_SHARE * total)[:components] if total > 0 else np.zeros(0, int)
    values, vectors = values[wanted], vectors[:, wanted]
    vectors = vectors * np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(wanted))])
    scaled = vectors / np.sqrt(values)
    error = 0.0
    if len(wanted):
        n, sums, scatter = _projected(rows, dim, centre, scaled, scratch, "identity")
        error = float(np.abs(scatter / n - np.outer(sums / n, sums / n) - np.eye(len(wanted))).max())
    return Whitening(first.n, first.sums, scaled, values, values / total if total > 0 else values, error)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """sum of (n x - sums)^2 per row, exact; null beyond 64 bits."""
    fits = n * max(1, int(np.abs(x).max(initial=0))) < 1 << 62
    apart = n * x - sums if fits else n * x.astype(object) - sums.astype(object)
    if fits and (apart.astype(np.float64) ** 2).sum(axis=1).max(initial=0) < 9.2e18:
        return pa.array((apart * apart).sum(axis=1), pa.int64())
    whole = [sum(int(v) ** 2 for v in row) for row in apart]
    return pa.array([v if v < 1 << 63 else None for v in whole], pa.int64())


def whiten(rows: DataFrame, dim: int, fitted: Whitening | None) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every row and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None or not len(fitted.variances):
        return rows.sparkSession.createDataFrame([], schema)
    k = len(fitted.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, dim):
            m = len(x)
            w = (x - fitted.centre) @ fitted.scaled
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.record_batch([
                ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, fitted.n, np.int64)), deviations(x, fitted.n, fitted.sums).take(each),
                pa.array(w.ravel()), pa.array(np.tile(fitted.explained, m)),
                pa.array(np.full(m * k, fitted.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
