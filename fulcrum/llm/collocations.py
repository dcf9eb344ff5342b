"""Phrase collocations by relational (SETM) mining.

A text is lower-cased (A-Z), cut into pieces and those into words.  ``R_k`` is the occurrence
relation of the frequent k-word phrases, sorted by piece and position and written.  ``R_k`` merge-
joined with itself at the adjacent position of the same piece gives the occurrences of the
(k + 1)-word phrases whose two k-word parts are frequent; these are counted by group, and
the occurrences semi-joined with the frequent groups are ``R_{k+1}``.

The relations are stored in blocks of whole texts, some ``BLOCK_WORDS`` words each: one code per position (0: no
frequent phrase begins here, or a piece ends) and the ids the codes stand for, as packed integers.  A block
is sorted as it stands, so the merge join is a comparison of neighbours in it and moves nothing; only the
block's distinct phrases and their counts are shuffled, packed, a *slice* of them by the phrase's hash to
each counting group.  A group counts its phrases over all blocks, numbers the frequent ones and
answers each block with one bit per phrase and the new ids.  A phrase comes once per block, however
often it occurs, so a hot word or passage is no hot key, and a slice holds about ``BLOCKS_PER_SLICE`` blocks' worth of
phrases at any size of the table.

Words are compared by their bytes (dictionary encoding), phrases by the ids of their two
parts: counts are exact.  Scores use decimals of 38 digits.

A phrase lies inside a longer candidate of at least ``covered`` per cent of its count if and only if it
lies inside one with a single word more: that one occurs as often or more often.  So only the
candidates one word longer are compared.

Defined results: null texts are empty; a null language is ``und``; an empty text or table gives no phrase;
repeated rows count as often as they stand; very long texts are handled whole, as blocks of their
own; ties of the ranking go to the phrase of smaller UTF-8 bytes; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulcrum.llm.scratch import Scratch
from fulcrum.llm.wordhash import mix, release

#: Words of a block, about (a single longer text makes a longer block).
BLOCK_WORDS = 1_500_000
LEAST, LONGEST, COVERED, TOP = 30, 4, 80, 2000
BLOCKS_PER_SLICE = 2
#: A partition has at most 2^13 blocks, a slice at most 2^32 phrases.
_SEQUENCE_BITS, _SLICE_BITS = 13, 32
#: Rows of a language are first ranked in so many parts.
RANK_PARTS = 64

_BREAK, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_FIRST = "block long, langs array<string>, lang array<int>, word array<string>, n array<long>, codes binary"
#: A relation: ``codes`` of all positions, in order; code i stands for the i-th of ``ids`` (ascending).
_RELATION = "block long, ids binary, codes binary"
_DEALT = "slice long, block long, first binary, second binary, n binary"
#: Answers have a block; the row without one lists the slice's frequent phrases.
_COUNTED = ("block long, slice long, chosen binary, ids binary, "
            "phrases array<struct<id:long,first:long,second:long,a:long>>")


# ---------------------------------------------------------------- packed integers
def pack(x: np.ndarray) -> bytes:
    """Integers as zstandard of their byte planes, differences instead of values where they ascend."""
    x = x.astype(np.int64)
    rising = len(x) > 0 and bool((np.diff(x) >= 0).all())
    x = np.diff(x, prepend=0) if rising else x
    small = len(x) > 0 and int(x.min()) >= 0 and int(x.max()) < 1 << 31
    x = x.astype("<i4" if small else "<i8")
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
    return bytes([rising, small]) + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(packed: bytes) -> np.ndarray:
    kind = np.dtype("<i4" if packed[1] else "<i8")
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[2:]), np.uint8)
    x = np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel().astype(np.int64)
    return np.cumsum(x) if packed[0] else x


def _batch(names: dict[str, pa.DataType], columns: list[list]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, names.values())], list(names))


def _ints(lists: pa.ListArray, row: int) -> np.ndarray:
    return lists[row].values.to_numpy(zero_copy_only=False)


def _positions(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words in order, text number of each, whether a piece ends before each)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, bool)
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]]
    bounds = offsets - offsets[0]
    edge = np.zeros(len(data) + 1, bool)  # a text begins at this byte
    edge[bounds] = True
    inside = ~(_BREAK[data] | _BLANK[data])
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    start = np.flatnonzero(begins)
    # the bytes of all words without what stands between them, and where each begins
    held = np.flatnonzero(inside)
    at = np.append(np.searchsorted(held, start), len(held)).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(data[held])])
    breaks = np.concatenate([[0], np.cumsum(_BREAK[data], dtype=np.int32)])
    text = np.searchsorted(bounds, start, "right") - 1
    apart = np.ones(len(start), bool)
    apart[1:] = (breaks[start[1:]] != breaks[start[:-1]]) | (text[1:] != text[:-1])
    return words, text, apart


def _first_blocks(batches: Iterator[pa.RecordBatch], block_words: int) -> Iterator[pa.RecordBatch]:
    """R_1 of blocks of whole texts; batches hold (lang, text)."""
    base = TaskContext.get().partitionId() << _SEQUENCE_BITS
    names = {"block": pa.int64(), "langs": pa.list_(pa.string()), "lang": pa.list_(pa.int32()),
             "word": pa.list_(pa.string()), "n": pa.list_(pa.int64()), "codes": pa.binary()}
    parts: list[tuple] = []
    held = made = 0

    def block() -> pa.RecordBatch:
        nonlocal parts, held, made
        words = pa.chunked_array([p[0] for p in parts]).combine_chunks().dictionary_encode()
        languages = pa.concat_arrays([p[1] for p in parts]).dictionary_encode()
        word = words.indices.to_numpy().astype(np.int64)
        lang = languages.indices.to_numpy().astype(np.int64)[
            np.concatenate([p[2] + at for p, at in zip(parts, np.cumsum([0, *(len(p[1]) for p in parts)]))])]
        apart = np.concatenate([p[3] for p in parts])
        keys, code, n = np.unique(lang * len(words.dictionary) + word, return_inverse=True, return_counts=True)
        if made >> _SEQUENCE_BITS:
            raise ValueError("a partition has too many blocks: read the table in smaller splits")
        # a zero ahead of every piece
        codes = np.zeros(len(code) + int(apart.sum()), np.int64)
        codes[np.arange(len(code)) + np.cumsum(apart)] = code + 1
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        lists = [pa.array((keys // len(words.dictionary)).astype(np.int32)),
                 words.dictionary.take(pa.array(keys % len(words.dictionary))).cast(pa.string()), pa.array(n.astype(np.int64))]
        row = [pa.array([base + made], pa.int64()), pa.array([languages.dictionary.to_pylist()], pa.list_(pa.string())),
               *map(one, lists), pa.array([pack(codes)], pa.binary())]
        parts, held, made = [], 0, made + 1
        return pa.record_batch(row, list(names))

    for batch in batches:
        size = pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(size) // (4 * block_words)
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows] if batch.num_rows else [0]
        for a, b in zip(edges, edges[1:]):
            words, text, apart = _positions(batch.column(1).slice(a, b - a))
            if len(words):
                parts.append((words, batch.column(0).slice(a, b - a), text, apart))
                held += len(words)
                if held >= block_words:
                    yield block()
    if held:
        yield block()
    release()


def _frequent_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """R_1 with the frequent words alone; ``batches`` hold (block, codes, local, id): ``local`` are codes of
    the block's frequent words and ``id`` their ids."""
    names = {"block": pa.int64(), "ids": pa.binary(), "codes": pa.binary()}
    for batch in batches:
        for row in range(batch.num_rows):
            codes = unpack(batch.column(1)[row].as_py())
            local, ids = _ints(batch.column(2), row), _ints(batch.column(3), row)
            order = np.argsort(ids)
            rank = np.zeros(int(max(codes.max(), local.max())) + 1, np.int64)
            rank[local[order]] = np.arange(1, len(ids) + 1)
            yield _batch(names, [[batch.column(0)[row].as_py()], [pack(ids[order])], [pack(rank[codes])]])
    release()


@dataclass
class Pairs:
    """The phrases one word longer in a block: distinct ones in order of their two ids, with their counts
    and their slices, and the places where they begin."""

    first: np.ndarray
    second: np.ndarray
    n: np.ndarray
    places: np.ndarray
    code: np.ndarray
    length: int
    by_slice: np.ndarray
    edges: np.ndarray  # of the slices in ``by_slice``

    @classmethod
    def of(cls, ids: np.ndarray, codes: np.ndarray, slices: int) -> Pairs:
        places = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
        pairs, code, n = np.unique(
            codes[places] * (len(ids) + 1) + codes[places + 1], return_inverse=True, return_counts=True)
        first, second = ids[pairs // (len(ids) + 1) - 1], ids[pairs % (len(ids) + 1) - 1]
        part = (mix(mix(first.astype(np.uint64)) + second.astype(np.uint64)) % np.uint64(slices)).astype(np.int64)
        return cls(first, second, n, places, code, len(codes), np.argsort(part, kind="stable"),
                   np.concatenate([[0], np.cumsum(np.bincount(part, minlength=slices))]))


def _dealt(batches: Iterator[pa.RecordBatch], slices: int) -> Iterator[pa.RecordBatch]:
    """A relation's pairs, for each slice those of a block in a row."""
    names = {"slice": pa.int64(), "block": pa.int64(), "first": pa.binary(), "second": pa.binary(), "n": pa.binary()}
    for batch in batches:
        for row in range(batch.num_rows):
            pairs = Pairs.of(unpack(batch.column(1)[row].as_py()), unpack(batch.column(2)[row].as_py()), slices)
            used = np.flatnonzero(np.diff(pairs.edges))
            mine = [pairs.by_slice[pairs.edges[s]:pairs.edges[s + 1]] for s in used]
            yield _batch(names, [used.tolist(), [batch.column(0)[row].as_py()] * len(used), *[
                [pack(x[m]) for m in mine] for x in (pairs.first, pairs.second, pairs.n)]])
    release()


def _count_slice(rows: pa.Table, least: int) -> pa.Table:
    """Group-count of one slice over all blocks."""
    rows = rows.sort_by("block")
    first, second, n = ([unpack(x) for x in rows.column(c).to_pylist()] for c in ("first", "second", "n"))
    ends = np.cumsum([len(x) for x in first])
    first, second, n = (np.concatenate(x) for x in (first, second, n))
    order = np.lexsort((second, first))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
    begin = np.flatnonzero(new)
    a = np.add.reduceat(n[order], begin)
    often = a >= least
    slice_nr = rows.column("slice")[0].as_py()
    named = np.where(often, (slice_nr << _SLICE_BITS) + np.cumsum(often) - 1, -1)
    ids = np.empty(len(order), np.int64)
    ids[order] = named[np.cumsum(new) - 1]
    blocks, chosen, answer = rows.column("block").to_pylist(), [], []
    for x in np.split(ids, ends[:-1]):
        chosen.append(np.packbits(x >= 0).tobytes())
        answer.append(pack(x[x >= 0]))
    found = order[begin[often]]
    phrases = [dict(zip(("id", "first", "second", "a"), p)) for p in zip(
        named[often].tolist(), first[found].tolist(), second[found].tolist(), a[often].tolist())]
    phrase = pa.struct([(c, pa.int64()) for c in ("id", "first", "second", "a")])
    return pa.Table.from_batches([_batch(
        {"block": pa.int64(), "slice": pa.int64(), "chosen": pa.binary(), "ids": pa.binary(), "phrases": pa.list_(phrase)},
        [[*blocks, None], [slice_nr] * (len(blocks) + 1), [*chosen, None], [*answer, None], [None] * len(blocks) + [phrases]])])


def _longer(batches: Iterator[pa.RecordBatch], slices: int) -> Iterator[pa.RecordBatch]:
    """R_{k+1}; ``batches`` hold (block, ids, codes) of R_k and the slices' answers (slice, chosen, ids)."""
    names = {"block": pa.int64(), "ids": pa.binary(), "codes": pa.binary()}
    for batch in batches:
        for row in range(batch.num_rows):
            pairs = Pairs.of(unpack(batch.column(1)[row].as_py()), unpack(batch.column(2)[row].as_py()), slices)
            named = np.full(len(pairs.first), -1, np.int64)
            for answer in batch.column(3)[row].as_py():
                mine = pairs.by_slice[pairs.edges[answer["slice"]]:pairs.edges[answer["slice"] + 1]]
                bits = np.unpackbits(np.frombuffer(answer["chosen"], np.uint8), count=len(mine)).astype(bool)
                named[mine[bits]] = unpack(answer["ids"])
            ids = np.sort(named[named >= 0])
            if not len(ids):
                continue
            codes = np.zeros(pairs.length, np.int64)
            codes[pairs.places] = np.where(named >= 0, np.searchsorted(ids, named) + 1, 0)[pairs.code]
            yield _batch(names, [[batch.column(0)[row].as_py()], [pack(ids)], [pack(codes)]])
    release()


def _words(blocks: DataFrame, least: int) -> DataFrame:
    """(block, local, lang, word, id, a) of the words that occur ``least`` times or more in all.
    One exchange, by word; ``id`` is the number of a word's first row behind it."""
    spelled = F.transform("lang", lambda i: F.get(F.col("langs"), i))
    listed = blocks.select("block", F.posexplode(F.arrays_zip(spelled.alias("lang"), F.col("word"), F.col("n")))).select(
        "block", (F.col("pos") + 1).alias("local"), F.col("col.lang").alias("lang"), "col.word", F.col("col.n").alias("_n"))
    group = Window.partitionBy("lang", "word")
    return (listed.repartition("lang", "word").withColumn("_at", F.monotonically_increasing_id())
            .withColumns({"a": F.sum("_n").over(group), "id": F.min("_at").over(group)})
            .where(F.col("a") >= least).select("block", "local", "lang", "word", "id", "a"))


def phrase_counts(docs: DataFrame, scratch: Scratch, least: int = LEAST, longest: int = LONGEST,
                  block_words: int = BLOCK_WORDS) -> tuple[DataFrame, list[DataFrame]]:
    """(words per language: lang, n; frequent phrases by length from 1).

    The phrases: id, lang, phrase, a, ``heads`` (counts of its first 1, 2, ... words), ``tails`` (of its last),
    ``last`` (its last word), and from two words on first and second (ids of the phrases without the
    last and without the first word)."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    blocks = scratch.write(docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(
        lambda batches: _first_blocks(batches, block_words), _FIRST), "blocks")
    totals = scratch.write(
        blocks.select(F.explode(F.arrays_zip("lang", "n")).alias("w"), "langs")
        .groupBy(F.get("langs", F.col("w.lang")).alias("lang")).agg(F.sum("w.n").alias("n")), "totals")
    words = scratch.write(_words(blocks, least), "words")
    one = words.groupBy("id").agg(F.first("lang").alias("lang"), F.first("word").alias("phrase"), F.first("a").alias("a"))
    found = [scratch.write(one.select(
        "id", "lang", "phrase", "a", F.array("a").alias("heads"), F.array("a").alias("tails"), F.col("phrase").alias("last")), "p1")]
    lists = words.groupBy("block").agg(F.collect_list(F.struct("local", "id")).alias("kept"))
    relation = scratch.write(
        blocks.select("block", "codes").join(lists, "block")
        .select("block", "codes", F.col("kept.local").alias("local"), F.col("kept.id").alias("id"))
        .mapInArrow(_frequent_words, _RELATION), "r1")
    scratch.remove(blocks, words)
    for k in range(2, longest + 1):
        slices = max(1, -(-relation.count() // BLOCKS_PER_SLICE))

        def count(rows: pa.Table) -> pa.Table:
            return _count_slice(rows, least)

        counted = scratch.write(
            relation.mapInArrow(lambda batches, s=slices: _dealt(batches, s), _DEALT)
            .groupBy("slice").applyInArrow(count, _COUNTED), f"c{k}")
        phrases = counted.where(F.col("block").isNull()).select(F.inline("phrases"))
        left = found[-1].select(F.col("id").alias("first"), "lang", F.col("phrase").alias("_phrase"), F.col("heads").alias("_heads"))
        right = found[-1].select(F.col("id").alias("second"), "last", F.col("tails").alias("_tails"))
        found.append(scratch.write(phrases.join(left, "first").join(right, "second").select(
            "id", "lang", F.concat_ws(" ", "_phrase", "last").alias("phrase"), "a",
            F.concat("_heads", F.array("a")).alias("heads"), F.concat("_tails", F.array("a")).alias("tails"),
            "last", "first", "second"), f"p{k}"))
        if k < longest:
            answers = counted.where(F.col("block").isNotNull()).groupBy("block").agg(
                F.collect_list(F.struct("slice", "chosen", "ids")).alias("answers"))
            longer = scratch.write(relation.join(answers, "block").mapInArrow(
                lambda batches, s=slices: _longer(batches, s), _RELATION), f"r{k}")
            scratch.remove(relation)
            relation = longer
        scratch.remove(counted)
    scratch.remove(relation)
    return totals, found


def _big(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def collocations(docs: DataFrame, scratch: Scratch, least: int = LEAST, longest: int = LONGEST, covered: int = COVERED,
                 top: int = TOP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of every language's ``top`` phrases; ``docs`` has lang and text.

    A phrase of two or more words that occurs ``a`` times is cut where 2,000,000 a / (l + r) is
    least (rounded down; the first such cut), l and r being the counts of its two parts."""
    totals, found = phrase_counts(docs, scratch, least, longest, block_words)
    scored = []
    for k in range(2, longest + 1):
        cuts = F.array_min(F.array(*[F.struct(
            F.expr(f"(a * 2000000BD) div (CAST(heads[{i - 1}] AS DECIMAL(20,0)) + tails[{k - i - 1}])").alias("score"),
            F.lit(i).alias("cut"), F.get("heads", F.lit(i - 1)).alias("l"), F.get("tails", F.lit(k - i - 1)).alias("r"))
            for i in range(1, k)]))
        rows = found[k - 1].withColumn("a", _big(F.col("a"))).withColumn("_cut", cuts)
        if k < longest:  # the most frequent phrase one word longer that it is part of
            longer = found[k].select(F.explode(F.array("first", "second")).alias("id"), "a")
            rows = rows.join(longer.groupBy("id").agg(F.max("a").alias("_longer")), "id", "left").where(
                F.col("_longer").isNull() | (_big(F.col("_longer")) * 100 < F.col("a") * covered))
        scored.append(rows.select("lang", "phrase", F.col("a").cast("long").alias("a"), "_cut.l", "_cut.r", "_cut.score"))
    rows = scored[0]
    for more in scored[1:]:
        rows = rows.unionByName(more)
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's rows are ranked in parts first, so that a large one isn't one task
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    ahead = rows.withColumn("_part", part).withColumn(
        "_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*by))).where(F.col("_place") <= top)
    ranked = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("n").cast("long").alias("n"), F.col("score").cast("long").alias("score"))
