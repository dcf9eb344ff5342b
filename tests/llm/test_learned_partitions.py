"""Learned partitions against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fulcrum.llm import learned_partitions as L


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, v int, part int").repartition(3)


def brute(ids, x, query, k):
    score = np.zeros(len(x))
    for j in range(x.shape[1]):
        score += x[query, j] * x[:, j]
    rows = sorted((-s, i) for s, i in zip(score, ids) if i != ids[query])[:k]
    return [(i, -s) for s, i in rows]


def clustered(rng, n, dim=16):
    centre = rng.normal(size=(12, dim))
    x = centre[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, dim))
    return x.astype(np.float32).astype(np.float64)


def test_recall_on_clusters(spark, scratch):
    rng = np.random.default_rng(0)
    x = clustered(rng, 4000)
    vectors = L.vectors_of(table(spark, [(i, v.tolist(), 1, 2) for i, v in enumerate(x)]))
    got = L.search(vectors, vectors.where(F.col("id") % 40 == 0), scratch, k=10).toPandas()
    hits = 0
    for q, rows in got.groupby("query_id"):
        rows, want = rows.sort_values("rank"), brute(range(4000), x, q, 10)
        assert list(rows["rank"]) == list(range(1, 11))
        hits += len({i for i, _ in want} & set(rows.vec_id))
        for i, s in zip(rows.vec_id, rows.score):
            assert s == sum(np.multiply(x[q], x[i])) or s == pytest.approx(float(x[q] @ x[i]), rel=1e-12)
    assert hits / (10 * got.query_id.nunique()) >= 0.9


def test_hot_vector_ties_and_small_blocks(spark, scratch, monkeypatch):
    """A third of the rows share one vector; blocks and chunks are far smaller than that."""
    monkeypatch.setattr(L, "BLOCK_ROWS", 64)
    monkeypatch.setattr(L, "CHUNK_QUERIES", 8)
    rng = np.random.default_rng(1)
    x = clustered(rng, 900)
    x[::3] = x[0]
    ids = rng.permutation(5000)[:900]
    vectors = L.vectors_of(table(spark, [(int(i), v.tolist(), 1, 2) for i, v in zip(ids, x)]))
    got = L.search(vectors, vectors.where(F.col("id") % 20 == 0), scratch, k=20, mass=2.0).toPandas()
    asked = [r for r in range(900) if ids[r] % 20 == 0]
    for r in asked:
        rows = got[got.query_id == ids[r]].sort_values("rank")
        assert list(zip(rows.vec_id, rows.score)) == brute(ids.tolist(), x, r, 20)
    assert len(got) == 20 * len(asked)


def test_odd_rows(spark, scratch):
    good = [(i, [float(i), 1.0], 0, 0) for i in range(10)]
    odd = [(20, None, 0, 0), (21, [0.0, 0.0], 0, 0), (22, [None, 1.0], 0, 0), (23, [float("nan"), 1.0], 0, 0), (24, [], 0, 0),
           (25, [float("inf"), 1.0], 0, 0), (26, [1.0, 2.0, 3.0], 0, 0), (None, [1.0, 2.0], 0, 0), (3, [100.0, 1.0], 0, 0)]
    vectors = L.vectors_of(table(spark, good + odd))
    got = L.search(vectors, vectors.where(F.col("id") % 5 == 0), scratch, k=20).toPandas()
    assert set(got.query_id) == {0, 5} and len(got) == 18  # all candidates, each id once
    rows = got[got.query_id == 5].sort_values("rank")
    assert list(rows.vec_id)[:2] == [3, 9] and rows.score.iloc[0] == 501.0


def test_empty_and_single(spark, scratch):
    none = L.vectors_of(table(spark, []))
    assert L.search(none, none, scratch).count() == 0
    one = L.vectors_of(table(spark, [(0, [1.0, 2.0], 0, 0)]))
    assert L.search(one, one, scratch).count() == 0


def test_cut_is_balanced_and_cuts_few_edges():
    rng = np.random.default_rng(3)
    x = clustered(rng, 1500)
    graph = L.neighbour_graph(x, 8)
    part = L.cut_graph(x, graph, 12, rng)
    assert np.bincount(part, minlength=12).max() <= np.ceil(1500 / 12 * L.SLACK)
    crossed = (part[graph] != part[:, None]).mean()
    assert crossed < 0.5 * (rng.permutation(part)[graph] != part[:, None]).mean()


def test_repeated_rows_do_not_use_up_the_places(spark, scratch):
    """One block: every row stands twice, and the best id has more rows, with vectors of its own, than k."""
    rng = np.random.default_rng(5)
    x = clustered(rng, 60)
    x[7] = 3 * x[0]
    near = [x[7] * (1 - 1e-3 * i) for i in range(1, 31)]
    rows = 2 * [(i, v.tolist(), 1, 2) for i, v in enumerate(x)] + [(7, v.tolist(), 1, 2) for v in near]
    vectors = L.vectors_of(spark.createDataFrame(rows, "vec_id long, embedding array<double>, v int, part int"))
    got = L.search(vectors, vectors.where(F.col("id") == 0), scratch, k=20).toPandas().sort_values("rank")
    assert list(zip(got.vec_id, got.score)) == brute(range(60), x, 0, 20)


def test_visited_parts_hold_enough_ids(spark, scratch):
    """The most probable part holds one id many times; the other ids lie in the other part."""
    dim = 2
    router = L.Router([np.eye(dim), np.zeros(dim), 50 * np.eye(dim), np.zeros(dim)], 1.0)
    rows = [(1, [1.0 + i / 100, 0.0], 0, 0) for i in range(40)] + [(100 + i, [0.1, 1.0 + i / 100], 0, 0) for i in range(30)]
    vectors = L.vectors_of(table(spark, rows))
    got = L.search(vectors, vectors.where("id = 1"), scratch, k=20, mass=0.5, router=router)
    assert got.where("query_id = 1").count() == 20


def many_clusters(rng, n, per=100, dim=16):
    centre = 4 * rng.normal(size=(n // per, dim))
    x = centre[rng.integers(0, n // per, n)] + 0.3 * rng.normal(size=(n, dim))
    return x.astype(np.float32).astype(np.float64)


def test_two_levels(spark, scratch, monkeypatch):
    """Parts above PART_ROWS get a cut of their own: recall holds, and visiting all leaves is exact."""
    monkeypatch.setattr(L, "PART_ROWS", 60)
    monkeypatch.setattr(L, "PARTS", 4)
    monkeypatch.setattr(L, "MOST_PARTS", 8)
    rng = np.random.default_rng(2)
    x = many_clusters(rng, 4000)
    vectors = L.vectors_of(table(spark, [(i, v.tolist(), 1, 2) for i, v in enumerate(x)]))
    router = L.train(vectors)
    assert len(router.below) == router.top.parts == 8 and router.parts > 30
    p = router.probabilities(x[:50])
    assert p.shape == (50, router.parts) and np.allclose(p.sum(axis=1), 1)
    asked = vectors.where(F.col("id") % 40 == 0)
    hits = 0
    got = L.search(vectors, asked, scratch, k=10, router=router).toPandas()
    for q, rows in got.groupby("query_id"):
        hits += len({i for i, _ in brute(range(4000), x, q, 10)} & set(rows.vec_id))
    assert hits / (10 * got.query_id.nunique()) >= 0.9
    exact = L.search(vectors, asked, scratch, k=10, router=router, mass=2.0).toPandas()
    for q, rows in exact.groupby("query_id"):
        rows = rows.sort_values("rank")
        assert list(zip(rows.vec_id, rows.score)) == brute(range(4000), x, q, 10)


def test_what_is_dealt_grows_with_the_table(spark, scratch, monkeypatch):
    """Four times the rows and queries of clustered vectors: at most 4^1.1 times the copies."""
    for name, value in (("PART_ROWS", 250), ("PARTS", 4), ("MOST_PARTS", 16), ("BLOCK_ROWS", 250), ("CHUNK_QUERIES", 25)):
        monkeypatch.setattr(L, name, value)
    copies = []
    for n in (4000, 16000):
        x = many_clusters(np.random.default_rng(3), n, per=200)
        vectors = L.vectors_of(table(spark, [(i, v.tolist(), 1, 2) for i, v in enumerate(x)]))
        router = L.train(vectors)
        index = L.index_rows(vectors, router, scratch)
        held = {r.part: r["count"] for r in index.groupBy("part").count().collect()}
        rows_in = [held.get(p, 0) for p in range(router.parts)]
        asked = L.visits(vectors.where(F.col("id") % 20 == 0), router, rows_in, 10, L.MASS)
        copies.append(sum(df.count() for df in L.dealt(asked, index, rows_in)))
    assert copies[1] <= copies[0] * 4 ** 1.1, copies


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_tables(spark, sf):
    """Every query id divisible by 100, against brute force."""
    from fulcrum.llm import queries

    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    got = queries.QUERIES["op1_learned_partitions"](spark, f"/root/testdata/{sf}").where(F.col("query_id") % 100 == 0).toPandas()
    hits = total = 0
    for q, found in got.groupby("query_id"):
        want = {i for i, _ in brute(ids, x, ids.index(q), 20)}
        hits, total = hits + len(want & set(found.vec_id)), total + 20
    assert total and hits / total >= 0.9
