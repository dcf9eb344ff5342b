"""Whitening against numpy's eigendecomposition of the exactly centred covariance."""

import math

import numpy as np
import pytest

from fulcrum.llm import queries, whitening
from fulcrum.llm.secular import rank_one

SCHEMA = "vec_id long, embedding array<float>, id string, v int, part long"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in zip(ids, vectors)], SCHEMA).repartition(5)


def ask(df, scratch):
    rows, dim = whitening.usable(df)
    return [r.asDict() for r in whitening.whiten(rows, dim, whitening.fit(rows, dim, scratch)).collect()]


def brute(vectors):
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors]
    n, dim = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(dim)]
    deviation = [sum((n * r[j] - sums[j]) ** 2 for j in range(dim)) for r in x]
    centred = (np.array(x, float) - np.array(sums) / n)
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred, values[::-1], vecs[:, ::-1]


def held(got, vectors, ids):
    deviation, centred, values, vecs = brute(vectors)
    k = min(8, int((values > 1e-12 * values.sum()).sum()))
    assert len(got) == k * len(vectors)
    by = {(r["vec_id"], r["component"]): r for r in got}
    for c in range(k):
        want = centred @ vecs[:, c] / math.sqrt(values[c])
        have = np.array([by[i, c + 1]["whitened"] for i in ids])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-7
        assert all(by[i, c + 1]["deviation"] == d for i, d in zip(ids, deviation))
        assert by[ids[0], c + 1]["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-10)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    assert {r["n"] for r in got} == {len(vectors)}


@pytest.mark.parametrize("kind", ["random", "equal values", "zero parts", "graded", "one"])
def test_rank_one(kind):
    rng = np.random.default_rng(len(kind))
    n = 1 if kind == "one" else 40
    d = np.sort({"equal values": np.repeat(rng.random(8), 5)[:n], "graded": 10.0 ** np.arange(-20, n - 20)}.get(kind, rng.random(n)))
    d = d if len(d) == n else rng.random(n)
    q = np.linalg.qr(rng.normal(size=(n, n)))[0]
    v = rng.normal(size=n)
    if kind == "zero parts":
        v = q[:, ::3] @ rng.normal(size=len(range(0, n, 3)))
    for rho in (1.0, 1e-9, 1e9):
        want = q * d @ q.T + rho * np.outer(v, v)
        values, vectors = rank_one(d, q, v, rho)
        size = np.abs(want).max()
        assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-12
        assert np.abs(vectors * values @ vectors.T - want).max() < 1e-12 * size * n
        assert (np.diff(values) >= 0).all()


def test_spectrum_of_updates_alone(spark, scratch):
    """Before the last refinement the combined spectrum is already right."""
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(700, 12)) * np.arange(1, 13)).astype(np.float32).tolist()
    rows, dim = whitening.usable(table(spark, vectors).repartition(40))
    found = whitening.spectrum(rows, dim, scratch)
    _, centred, values, _ = brute(vectors)
    assert np.allclose(found.values[::-1] / 700, values, rtol=1e-9)
    assert np.abs(found.vectors * found.values @ found.vectors.T - centred.T @ centred).max() < 1e-9 * found.values.max()


def test_against_numpy(spark, scratch):
    rng = np.random.default_rng(3)
    spread = (rng.normal(size=(300, 10)) * np.linspace(3, 0.2, 10) + 0.5).astype(np.float32)
    held(ask(table(spark, spread.tolist()), scratch), spread.tolist(), range(300))
    few = spread[:4].tolist()  # fewer rows than dimensions
    held(ask(table(spark, few), scratch), few, range(4))


def test_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    got = [r.asDict() for r in queries.QUERIES["op12_whitening"](spark, "/root/testdata/sf0.01").collect()]
    held(got, [r.embedding for r in rows], [r.vec_id for r in rows])


def test_odd_rows(spark, scratch):
    rng = np.random.default_rng(4)
    good = (rng.normal(size=(40, 3)) * [3, 2, 1]).astype(np.float32).tolist()
    good += [good[0], good[0], [0.0, 0.0, 0.0]]  # repeated rows and a zero vector count
    odd = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 1.0, 2.0], [1.0, 2.0]]
    ids = list(range(40)) + [100, 101, 102]
    held(ask(table(spark, good + odd, ids + list(range(200, 206))), scratch), good, ids)
    repeated = table(spark, good, [0] * 20 + [None] * 23)
    assert len(ask(repeated, scratch)) == 3 * 43
    assert ask(table(spark, odd[:5]), scratch) == [] and ask(table(spark, []), scratch) == []
    assert ask(table(spark, [[1.0, 2.0]] * 9), scratch) == []  # no variance, no direction


def test_large_entries(spark, scratch):
    """Deviations beyond 64 bits are null, those that fit are exact."""
    vectors = [[float(i % 7), 1e30 if i == 3 else 0.5] for i in range(20)]
    got = ask(table(spark, vectors), scratch)
    assert {r["deviation"] for r in got if r["vec_id"] == 3} == {None}
    assert np.isfinite([r["whitened"] for r in got]).all()


def test_deviations_exact():
    x = np.array([[1 << 40, 3], [5, 7]], np.int64)
    for n in (10, 1 << 30):
        sums = np.array([12345, 678], np.int64)
        want = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
        assert whitening.deviations(x, n, sums).to_pylist() == [v if v < 1 << 63 else None for v in want]
