"""Near-duplicate classes by BagMinHash: band the signatures, verify the multiset overlap.

Two texts are linked if the multisets of their 5-word shingles overlap by at least 0.8
(sum of the smaller counts over sum of the larger ones); a class is a connected component of
links.  The steps:

1. Sketch every text (one pass); texts that are equal are one node from here on.
2. Band: nodes that agree on the ROWS registers of one of BANDS bands meet in a bucket.  A
   pair of similarity 0.8 meets with probability 1 - (1 - 0.8^5)^25 > 0.9999.
3. Inside the buckets, nodes whose whole signatures agree on LEAST_AGREEING registers
   (similarity 0.64 where 0.8 is asked for, 4.5 standard deviations off) form families; only
   the spanning links of a family leave a task, never all pairs.
4. Inside each family, every such pair is verified exactly on the words of the whole texts (compared by
   their bytes, not by hashes), unless links already join the two; again only spanning links leave a task.
5. Components of the verified links are the classes.

Buckets and families of more than CHUNK nodes, or of more text than CHUNK_WORDS, are dealt over chunks by hash: first each chunk
with one common centre; where that leaves more than one component, all pairs of chunks,
comparing across components only.  So no group has to fit in one task, the largest ones
(many copies of one text) collapse to one component in the first pass, and the rest is
still compared whole.

Defined results: a null text is the empty text; texts without a word are in a class only
with equal texts; texts of fewer than five words are one shingle; a null doc_id belongs to
its text's class like any other row, and never names a class that has another doc_id;
repeated rows share a class; very long texts are compared whole; of equal candidates for a class's name the
smallest doc_id is it; an empty table gives an empty result; other columns are not read, and ``keep_one`` returns
them as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulcrum.llm import wordhash
from fulcrum.llm.bagminhash import exact_shingles, shingle_counts, signatures
from fulcrum.llm.components import components
from fulcrum.llm.scratch import Scratch

BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
LEAST_AGREEING = 80
#: Similarity as a fraction: 4 / 5.
SIMILAR = (4, 5)
CHUNK = 512
#: Shingles of the texts of a chunk, about (a single longer text is a chunk of its own at most).
CHUNK_WORDS = 500_000
#: Pairs compared, and bytes of whole cells handled, at once.
PAIRS, PART_BYTES = 20_000, 8 << 20


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, weight (shingles), sketch (binary) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in wordhash.slices(batch, 2):
                text, shingle, count = shingle_counts(part.column(2))
                found = signatures(text, shingle, count, part.num_rows, REGISTERS)
                weight = np.bincount(text, weights=count, minlength=part.num_rows).astype(np.int64)
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(weight), pa.array([r.tobytes() for r in found], pa.binary())],
                    ["doc_id", "text_key", "weight", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key string, weight long, sketch binary")


def bands(nodes: DataFrame) -> DataFrame:
    """(grp, node): a bucket per band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sketches = _sketches(batch.column(1))
            for band in range(BANDS):
                key = np.full(len(sketches), band + 1, np.uint64)
                for r in range(band * ROWS, (band + 1) * ROWS):
                    key = wordhash.mix(key * np.uint64(0x9E3779B97F4A7C15) + sketches[:, r].astype(np.uint64))
                yield pa.record_batch([pa.array(key.view(np.int64)), batch.column(0)], ["grp", "node"])

    return nodes.where(F.col("weight") > 0).select("node", "sketch").mapInArrow(run, "grp long, node long")


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), REGISTERS)


def group_sizes(members: DataFrame, scratch: Scratch) -> DataFrame:
    """(grp, n, weight, centre) of the groups of more than one node."""
    return scratch.write(
        members.groupBy("grp").agg(
            F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight"),
            F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("c"))
        .where(F.col("n") > 1).select(F.col("grp").alias("g"), "n", F.col("weight").alias("w"), F.col("c.node").alias("centre")), "groups")


def connect(members: DataFrame, payload: Callable[[DataFrame], DataFrame], columns: list[str], linked: Callable,
            scratch: Scratch, chunk: int = CHUNK) -> DataFrame:
    """Spanning links (a, b) between the nodes of each group in ``members`` (grp, node, and if the payload is
    large its weight) that ``linked`` ties together.  ``payload`` adds the ``columns`` that ``linked`` reads."""
    members = members if "weight" in members.columns else members.withColumn("weight", F.lit(0).cast("long"))
    sizes = group_sizes(members, scratch)
    chunks = F.greatest(F.ceil(F.col("n") / chunk), F.ceil(F.col("w") / CHUNK_WORDS)).cast("int")
    own = F.pmod(F.xxhash64("node", "grp"), F.col("chunks")).cast("int")
    placed = (members.join(sizes, F.col("grp") == F.col("g"))
              .withColumn("chunks", chunks).withColumn("own", own)
              .select("grp", "node", "chunks", "own", (F.col("node") == F.col("centre")).alias("is_centre")))
    placed = scratch.write(placed, "placed")
    everywhere = F.sequence(F.lit(0), F.col("chunks") - 1)
    # first pass: each chunk, and the centre in all of them
    cells = (payload(placed).withColumn("comp", F.col("node"))
             .withColumn("lo", F.explode(F.when(F.col("is_centre"), everywhere).otherwise(F.array("own"))))
             .withColumn("hi", F.col("lo")))
    links = scratch.write(_in_cells(cells, columns, linked), "links")
    several = placed.where(F.col("chunks") > 1)
    if several.limit(1).count():
        # where that leaves several components, all pairs of chunks
        roots = components(links, scratch)
        known = (several.join(roots.withColumnRenamed("node", "r"), F.col("node") == F.col("r"), "left")
                 .withColumn("comp", F.coalesce("root", "node")).drop("r", "root"))
        known = scratch.write(known, "known")
        open_ = known.groupBy(F.col("grp").alias("g")).agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
        left = scratch.write(known.join(open_.select("g"), F.col("grp") == F.col("g"), "left_semi"), "open")
        if left.limit(1).count():
            cells = (payload(left).withColumn("other", F.explode(everywhere)).where("other <> own")
                     .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")))
            links = links.unionByName(scratch.write(_in_cells(cells, columns, linked), "links"))
    return links


def _in_cells(cells: DataFrame, columns: list[str], linked: Callable) -> DataFrame:
    """Run ``linked`` on every cell (grp, lo, hi); a task streams through its cells."""
    key = ["grp", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [batch.column(k).to_numpy() for k in range(3)]
            new = np.zeros(batch.num_rows, bool)
            for x in ids:
                new[1:] |= x[1:] != x[:-1]
            last = int(np.flatnonzero(new)[-1]) if new.any() else 0
            if held:
                tail = [held[-1].column(k)[-1].as_py() for k in range(3)]
                if last == 0 and [x[0] for x in ids] == tail:
                    held.append(batch)
                    continue
                # cells of the held rows may go on into this batch, up to its last new cell
                whole = [*held, batch.slice(0, last)]
            else:
                whole = [batch.slice(0, last)]
            for part in _parts(whole, key):
                yield _spanning(part, columns, linked)
            held = [batch.slice(last)]
        if held:
            for part in _parts(held, key):
                yield _spanning(part, columns, linked)
        wordhash.release()

    return (cells.select(*key, "node", "own", "comp", *columns)
            .repartition(*key).sortWithinPartitions(*key, "node")
            .mapInArrow(run, "a long, b long"))


def _parts(batches: list[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Whole cells, some MB at a time."""
    rows = pa.Table.from_batches(batches)
    if not rows.num_rows:
        return
    ids = [rows.column(k).to_numpy() for k in key]
    new = np.zeros(rows.num_rows, bool)
    for x in ids:
        new[1:] |= x[1:] != x[:-1]
    starts = np.flatnonzero(new)
    each = rows.nbytes / rows.num_rows
    at = 0
    while at < rows.num_rows:
        later = starts[starts >= at + PART_BYTES / each]
        to = int(later[0]) if len(later) else rows.num_rows
        yield rows.slice(at, to - at)
        at = to


def _spanning(rows: pa.Table, columns: list[str], linked: Callable) -> pa.RecordBatch:
    """Links (node, smallest node) of each component inside each cell."""
    rows = rows.combine_chunks()
    get = lambda name: rows.column(name).to_numpy()
    grp, lo, hi, node, own, comp = map(get, ("grp", "lo", "hi", "node", "own", "comp"))
    fresh = np.ones(len(node), bool)
    fresh[1:] = (grp[1:] != grp[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    cell = np.cumsum(fresh) - 1
    end = np.append(np.flatnonzero(fresh)[1:], len(node))[cell]
    across = lo != hi
    label = np.arange(len(node))
    order = np.lexsort((node, comp, cell))  # nodes that are known to be one component start as one
    same = (comp[order[1:]] == comp[order[:-1]]) & (cell[order[1:]] == cell[order[:-1]])
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    label[order] = np.repeat(order[heads], np.diff(np.append(heads, len(order))))
    known = label.copy()

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        count = end - 1 - np.arange(len(node))
        total = np.cumsum(count)
        at = 0
        while at < len(node):
            base = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, base + PAIRS, "right")))
            n = count[at:to]
            a = np.repeat(np.arange(at, to), n)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            keep = (comp[a] != comp[b]) & ~(across[a] & (own[a] == own[b])) & (node[a] != node[b])
            if keep.any():
                yield a[keep], b[keep]
            at = to

    a, b = linked([rows.column(c).combine_chunks() for c in columns], pairs(), known)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            break
    moved = label != known
    return pa.record_batch([pa.array(node[moved]), pa.array(node[label[moved]])], ["a", "b"])


def _agreeing(sketches: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (sketches[a] == sketches[b]).sum(axis=1)


def alike(columns: list[pa.Array], pairs, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose signatures agree on enough registers."""
    sketches = _sketches(columns[0])
    found = [(a[ok], b[ok]) for a, b in pairs for ok in [_agreeing(sketches, a, b) >= LEAST_AGREEING] if ok.any()]
    return _stacked(found)


def overlapping(columns: list[pa.Array], pairs, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose shingle multisets overlap enough, as far as they join new components; the
    most alike are verified first."""
    sketches, texts = _sketches(columns[0]), columns[1]
    found = []
    for a, b in pairs:
        agree = _agreeing(sketches, a, b)
        ok = agree >= LEAST_AGREEING
        if ok.any():
            found.append((a[ok], b[ok], agree[ok]))
    if not found:
        return _stacked([])
    a, b, agree = (np.concatenate(c) for c in zip(*found))
    # only the texts of such pairs are cut into shingles
    asked = np.unique(np.concatenate([a, b]))
    text, shingle, count = exact_shingles(texts.take(pa.array(asked)))
    text = asked[text]
    at = np.searchsorted(text, np.arange(len(texts) + 1))
    weight = np.bincount(text, weights=count, minlength=len(texts)).astype(np.int64)
    top, bottom = SIMILAR
    # the smaller multiset bounds the overlap
    ok = bottom * np.minimum(weight[a], weight[b]) >= top * np.maximum(weight[a], weight[b])
    order = np.argsort(-agree[ok], kind="stable")
    a, b = a[ok][order], b[ok][order]
    parent = known.tolist()

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = root(i), root(j)
        if x != y:
            ix, jx = slice(at[i], at[i + 1]), slice(at[j], at[j + 1])
            _, p, q = np.intersect1d(shingle[ix], shingle[jx], assume_unique=True, return_indices=True)
            both = int(np.minimum(count[ix][p], count[jx][q]).sum())
            if (top + bottom) * both >= top * int(weight[i] + weight[j]):
                parent[max(x, y)] = min(x, y)
                links.append((i, j))
    return _stacked([tuple(map(np.array, zip(*links)))] if links else [])


def _stacked(found: list) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found))


def text_classes(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rows, texts).  rows: doc_id and text_key of every row.  texts: per distinct text
    text_key, first_id (its smallest doc_id), rows, class_id (its class's smallest doc_id)
    and class_key (the text_key of that document)."""
    sketches = scratch.write(sketch(docs), "sketches")
    nodes = scratch.write(
        sketches.groupBy("text_key").agg(
            F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("rows"),
            F.first("weight").alias("weight"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    rows = sketches.select("doc_id", "text_key")
    with_sketch = lambda df: df.join(nodes.select(F.col("node").alias("_n"), "sketch"), F.col("node") == F.col("_n")).drop("_n")
    families = components(connect(bands(nodes), with_sketch, ["sketch"], alike, scratch), scratch)
    families = scratch.write(families.select(F.col("root").alias("grp"), "node"), "families")
    keys = families.join(nodes, "node").select(
        "node", "sketch", F.col("text_key").alias("_key"), F.col("first_id").alias("_id"))
    # one text per node: rows that repeat a doc_id (or its lack) with a text collapse map-side
    texts = scratch.write(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
        .join(keys, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
        .groupBy(F.col("node").alias("_n")).agg(F.first("sketch").alias("sketch"), F.first("text").alias("text")),
        "family-texts")
    with_text = lambda df: df.join(texts, F.col("node") == F.col("_n")).drop("_n")
    weighed = families.join(nodes.select(F.col("node").alias("_n"), "weight"), F.col("node") == F.col("_n")).drop("_n")
    links = connect(weighed, with_text, ["sketch", "text"], overlapping, scratch)
    roots = components(links, scratch).withColumnRenamed("node", "_n")
    classed = scratch.write(
        nodes.drop("sketch").join(roots, F.col("node") == F.col("_n"), "left")
        .select("node", "text_key", "first_id", "rows", F.coalesce("root", "node").alias("root")), "classed")
    smallest = F.min(F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id").alias("id"), F.col("text_key").alias("key")))
    names = classed.groupBy(F.col("root").alias("_r")).agg(smallest.alias("s")).select(
        "_r", F.col("s.id").alias("class_id"), F.col("s.key").alias("class_key"))
    texts_out = scratch.write(
        classed.join(scratch.write(names, "names"), F.col("root") == F.col("_r"))
        .select("text_key", "first_id", "rows", "class_id", "class_key"), "texts")
    return rows, texts_out


def near_duplicates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id and class_id (the class's smallest doc_id) of every row."""
    rows, texts = text_classes(docs, scratch)
    return rows.join(texts.select(F.col("text_key").alias("_k"), "class_id"), F.col("text_key") == F.col("_k")).select(
        "doc_id", "class_id")


def keep_one(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs``' own columns, one row of each class: that of its smallest doc_id."""
    rows, texts = text_classes(docs, scratch)
    kept = texts.where(F.col("text_key") == F.col("class_key")).select(
        F.col("text_key").alias("_k"), F.col("first_id").alias("_i"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, F.col("doc_id").cast("long").alias("_id"), text_key(F.col("text")).alias("_t"))
    found = keyed.join(kept, (F.col("_t") == F.col("_k")) & F.col("_id").eqNullSafe(F.col("_i")))
    repeated = (rows.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                .select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_x")))
    repeated = scratch.write(repeated, "repeated")
    if repeated.limit(1).count():
        # of rows that repeat a kept document one stays
        again = (F.col("_t") == F.col("_x")) & F.col("_id").eqNullSafe(F.col("_d"))
        found = found.join(repeated, again, "left_anti").unionByName(
            found.join(repeated, again, "left_semi").dropDuplicates(["_t"]))
    return found.select("_row.*")
