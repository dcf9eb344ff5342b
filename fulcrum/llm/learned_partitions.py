"""Approximate nearest neighbours by learned partitions.

Building: a bounded sample gets its exact neighbour graph; the graph is cut into balanced
parts with few neighbours across (capacity-bound label propagation); a small network learns
to tell, from a vector alone, how its neighbours spread over the parts.  Every row of the
table is then indexed under its most probable part.

Searching: the network ranks the parts of a query; it visits the most probable ones until
they hold ``mass`` of the probability and at least as many rows as it needs, and reranks
their rows by the exact inner product in double precision.  Rows here are distinct pairs of
vec_id and vector: repeats are dropped, map-side first, before anything is sampled or counted,
and what a query needs is counted in vec_ids.

Parts grow in number with the table: a first cut into 32 to 128 parts, and where a part holds more than
PART_ROWS rows, a second one of its own (graph, cut and network from a bounded sample of the
part).  A leaf's probability is the product along its path.

Leaves are split into blocks of about BLOCK_ROWS rows by hash of id and vector, and the queries that visit a
leaf into chunks of about CHUNK_QUERIES, so a task holds one block and one chunk however many
rows share a vector or a leaf; each block returns its best ``k`` per query, which a window merges.
A row is copied once per chunk of the queries that visit its own leaf, and not at all if none does.
So where a query finds its neighbours in a bounded number of leaves, what is shuffled grows with the
table; vectors without any structure have to be looked at in a fixed share of all leaves, and
then no partitioning helps (README).

Defined results: a vector that is null, empty, zero or holds a null or a non-finite component
takes no part, nor does one whose length isn't the table's most frequent (the smaller of
two); a null vec_id takes no part; rows that share a vec_id count once, with their best
score, and a query is never its own candidate under any of them; of several query rows with
one vec_id the smallest vector is asked.  Ties go to the smaller vec_id.  Scores add the
products in the order of the components, so equal vectors score equally everywhere.  An empty table gives an
empty result; very long vectors are scored whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulcrum.llm.scratch import Scratch

#: Bound of the training sample (rows), and its graph.
SAMPLE_ROWS, NEIGHBOURS = 8192, 10
PARTS, SLACK = 32, 1.05
HIDDEN, EPOCHS, RATE, SEED = 128, 20, 2e-3, 11
#: Probability that the visited parts hold, at least.
MASS = 0.955
BLOCK_ROWS, CHUNK_QUERIES = 8192, 4096
#: Rows that a part is meant to hold, most parts of one cut, and entries of a score matrix at once.
PART_ROWS, MOST_PARTS, ENTRIES = 16384, 128, 1 << 22


def usable(vector: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors_of(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the rows that take part."""
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (usual.d if usual else 0))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of each row's ``k`` largest inner products with other rows."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 1024):
        s = x[at:at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else 0
    return out


def _fill(score: np.ndarray, capacity: int) -> np.ndarray:
    """Each row's best part that still has room; the surest rows choose first."""
    part, room = np.full(len(score), -1), np.full(score.shape[1], capacity)
    prefer = np.argsort(-score, axis=1, kind="stable")
    for i in np.argsort(-(score.max(axis=1) - score.mean(axis=1)), kind="stable"):
        for p in prefer[i]:
            if room[p]:
                part[i], room[p] = p, room[p] - 1
                break
    return part


def cut_graph(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """A balanced part number for each row: seeds grow over the graph, then rows move to the
    part that holds most of their neighbours, within the parts' capacity."""
    capacity = int(np.ceil(len(x) / parts * SLACK))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    centre = unit[rng.permutation(len(x))[:parts]]
    for _ in range(6):
        part = _fill(unit @ centre.T, capacity)
        centre = np.stack([unit[part == p].mean(axis=0) if (part == p).any() else centre[p] for p in range(parts)])
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
    for _ in range(6):
        votes = 0.5 * np.eye(parts)[part] + 1e-3 * (unit @ centre.T)
        for k in range(graph.shape[1]):
            votes[np.arange(len(x)), part[graph[:, k]]] += 1
            np.add.at(votes, (graph[:, k], part), 1)
        part = _fill(votes, capacity)
    return part


class Router:
    """Network from a vector to the probabilities of the parts."""

    def __init__(self, weights: list[np.ndarray], scale: float):
        self.weights, self.scale = weights, scale

    @property
    def parts(self) -> int:
        return self.weights[2].shape[1]

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w1, b1, w2, b2 = self.weights
        h = np.maximum(x * self.scale @ w1 + b1, 0)
        o = h @ w2 + b2
        e = np.exp(o - o.max(axis=1, keepdims=True))
        return h, e / e.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x)[1]

    @classmethod
    def fit(cls, x: np.ndarray, parts: int = PARTS) -> Router:
        rng = np.random.default_rng(SEED)
        dim = x.shape[1] if x.ndim == 2 and len(x) else 1
        parts = max(1, min(parts, len(x) // 64))
        weights = [rng.normal(0, 1 / np.sqrt(dim), (dim, HIDDEN)), np.zeros(HIDDEN),
                   rng.normal(0, 0.05, (HIDDEN, parts)), np.zeros(parts)]
        net = cls(weights, np.sqrt(dim) / 2 / max(1e-12, float(np.linalg.norm(x, axis=1).mean()) if len(x) else 1.0))
        if parts == 1:
            return net
        graph = neighbour_graph(x, NEIGHBOURS)
        part = cut_graph(x, graph, parts, rng)
        target = np.eye(parts)[part]
        for k in range(graph.shape[1]):
            target[np.arange(len(x)), part[graph[:, k]]] += 1
        target /= target.sum(axis=1, keepdims=True)
        m, v, step = [0.0] * 4, [0.0] * 4, 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 256):
                some = order[at:at + 256]
                h, p = net._forward(x[some])
                d, step = (p - target[some]) / len(some), step + 1
                dh = (d @ net.weights[2].T) * (h > 0)
                for j, g in enumerate((net.scale * x[some].T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0))):
                    m[j], v[j] = 0.9 * m[j] + 0.1 * g, 0.999 * v[j] + 0.001 * g ** 2
                    net.weights[j] = net.weights[j] - RATE * (m[j] / (1 - 0.9 ** step)) / (np.sqrt(v[j] / (1 - 0.999 ** step)) + 1e-8)
        return net


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Tree:
    """One or two levels of routers; leaves are numbered part by part."""

    def __init__(self, top: Router, below: dict[int, Router]):
        self.top, self.below = top, below
        sizes = [below[p].parts if p in below else 1 for p in range(top.parts)]
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @property
    def parts(self) -> int:
        return int(self.base[-1])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        p = self.top.probabilities(x)
        return np.concatenate([p[:, i:i + 1] * (self.below[i].probabilities(x) if i in self.below else 1.0)
                               for i in range(self.top.parts)], axis=1)

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The most probable leaf of the most probable part."""
        part = self.top.probabilities(x).argmax(axis=1)
        leaf = self.base[part]
        for i in np.unique(part):
            if int(i) in self.below:
                mine = part == i
                leaf[mine] += self.below[int(i)].probabilities(x[mine]).argmax(axis=1)
        return leaf


def _sample(vectors: DataFrame, most: int) -> DataFrame:
    return vectors.orderBy(F.xxhash64("id"), "id", "v").limit(most)


def train(vectors: DataFrame, most: int = SAMPLE_ROWS, parts: int | None = None) -> Tree:
    """Routers from bounded samples: ``most`` rows for the first cut, about as many of each large part."""
    rows = vectors.count()
    wanted = parts or int(np.clip(-(-rows // PART_ROWS), PARTS, MOST_PARTS))
    top = Router.fit(_matrix(_sample(vectors, most).toArrow().column("v")), wanted)
    if rows <= top.parts * PART_ROWS:
        return Tree(top, {})
    placed = vectors.select("id", "v").mapInArrow(_placed(Tree(top, {})), "id long, v array<double>, part int")
    held = {r.part: r.n for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect() if r.n > PART_ROWS}
    every = F.array(*[F.lit(-(-held[p] // most) if p in held else 0) for p in range(top.parts)])
    some = F.get(every, F.col("part"))
    chosen = placed.where((some > 0) & (F.pmod(F.xxhash64("v", "id"), F.greatest(some, F.lit(1))) == 0))

    def fit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        x = _matrix(table.sort_by([("id", "ascending")]).column("v"))
        own = Router.fit(x, int(np.clip(-(-held[part] // PART_ROWS), 2, MOST_PARTS)))
        return pa.table([[part], [[w.ravel().tolist() for w in own.weights]], [float(own.scale)]],
                        pa.schema([("part", pa.int32()), ("weights", pa.list_(pa.list_(pa.float64()))), ("scale", pa.float64())]))

    # at most 128 networks of bounded size
    found = chosen.groupBy("part").applyInArrow(fit, "part int, weights array<array<double>>, scale double").collect()
    below = {}
    for r in found:
        w1, b1, w2, b2 = (np.array(w) for w in r.weights)
        if len(b2) > 1:
            below[r.part] = Router([w1.reshape(-1, HIDDEN), b1, w2.reshape(HIDDEN, -1), b2], r.scale)
    return Tree(top, below)


def _placed(router: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = router.leaf(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.record_batch([*batch.columns, pa.array(leaf.astype(np.int32))], ["id", "v", "part"])

    return run


def index_rows(vectors: DataFrame, router: Tree, scratch: Scratch) -> DataFrame:
    """(id, v, part) of every row; a part is a leaf."""
    return scratch.write(vectors.select("id", "v").mapInArrow(_placed(router), "id long, v array<double>, part int"), "index")


def visits(queries: DataFrame, router: Tree, ids_in: list[int], k: int, mass: float) -> DataFrame:
    """(id, v, parts): the parts that each query visits; ``ids_in``: vec_ids per part, each
    counted in one part only."""
    held = np.array(ids_in)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, ENTRIES // router.parts)
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                p = router.probabilities(_matrix(batch.column(1)))
                order = np.argsort(-p, axis=1, kind="stable")
                seen = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
                ids = np.cumsum(held[order], axis=1)
                # one more id than asked for, as the query itself may be among them
                n = np.minimum(((seen < mass) | (ids < k + 1)).sum(axis=1) + 1, p.shape[1])
                yield pa.record_batch(
                    [*batch.columns, pa.array([o[:m].tolist() for o, m in zip(order, n)], pa.list_(pa.int32()))],
                    ["id", "v", "parts"])

    return queries.mapInArrow(run, "id long, v array<double>, parts array<int>")


def best_of_block(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query id, id, score) of each query's best ``k`` ids in a block, exactly scored."""
    order = np.argsort(cid, kind="stable")
    cid, c = cid[order], c[order]
    rough = q @ c.T
    rough[qid[:, None] == cid[None, :]] = -np.inf
    first = np.flatnonzero(np.append(True, cid[1:] != cid[:-1]))
    best = rough if len(first) == len(cid) else np.maximum.reduceat(rough, first, axis=1)  # of each id
    kth = np.partition(best, -k, axis=1)[:, -k] if best.shape[1] > k else np.full(len(q), -np.inf)
    # the fast product errs by far less than this; what is near the k-th best is scored again
    slack = 1e-12 * len(q[0]) * np.linalg.norm(q, axis=1) * np.linalg.norm(c, axis=1).max()
    row, col = np.nonzero((rough >= (kth - slack)[:, None]) & (rough > -np.inf))
    score = np.zeros(len(row))
    for j in range(q.shape[1]):
        score += q[row, j] * c[col, j]
    order = np.lexsort((-score, cid[col], row))  # of rows with one id, the best
    row, col, score = row[order], col[order], score[order]
    one = np.ones(len(row), bool)
    one[1:] = (row[1:] != row[:-1]) | (cid[col[1:]] != cid[col[:-1]])
    row, col, score = row[one], col[one], score[one]
    order = np.lexsort((cid[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row, "left")
    top = place < k
    return qid[row[top]], cid[col[top]], score[top]


def dealt(asked: DataFrame, index: DataFrame, rows_in: list[int]) -> tuple[DataFrame, DataFrame]:
    """Queries and rows dealt over the cells (part, block, chunk) in which they meet; ``rows_in``: rows per part."""
    visit = asked.select("id", "v", F.explode("parts").alias("part"))
    coming = {r.part: r.n for r in visit.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    of = lambda counts, size: F.get(F.array(*[F.lit(-(-n // size)) for n in counts]), F.col("part"))
    blocks = F.greatest(of(rows_in, BLOCK_ROWS), F.lit(1))
    chunks = of([coming.get(p, 0) for p in range(len(rows_in))], CHUNK_QUERIES)
    hashed = lambda n, *cols: F.pmod(F.xxhash64(*cols), n).cast("int")
    left = visit.withColumn("chunk", hashed(chunks, "id")).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    right = index.select("id", "v", "part").where(chunks > 0).withColumn("block", hashed(blocks, "id", "v")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return left, right


def search(vectors: DataFrame, queries: DataFrame, scratch: Scratch, k: int = 20, mass: float = MASS,
           router: Tree | Router | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's ``k`` nearest rows found.
    ``vectors`` and ``queries``: (id, v) from ``vectors_of``."""
    distinct = scratch.write(vectors.select("id", "v").dropDuplicates(), "distinct")
    router = Tree(router, {}) if isinstance(router, Router) else router or train(distinct)
    index = index_rows(distinct, router, scratch)
    scratch.remove(distinct)
    per = lambda rows: {r.part: r.n for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows_in, ids_in = (
        [found.get(p, 0) for p in range(router.parts)]
        for found in (per(index), per(index.groupBy("id").agg(F.min("part").alias("part")))))
    asked = scratch.write(
        visits(queries.groupBy("id").agg(F.min("v").alias("v")), router, ids_in, k, mass), "visits")
    left, right = dealt(asked, index, rows_in)

    def rerank(queries: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not queries.num_rows or not rows.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        qid, q = queries.column("id").to_numpy(), _matrix(queries.column("v"))
        cid, c = rows.column("id").to_numpy(), _matrix(rows.column("v"))
        some = max(1, ENTRIES // len(cid))
        best = [best_of_block(qid[at:at + some], q[at:at + some], cid, c, k) for at in range(0, len(qid), some)]
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*best)], names)

    cell = ["part", "block", "chunk"]
    pairs = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
        rerank, "query_id long, vec_id long, score double")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))
