"""Mixing sources to target weights by systematic sampling.

A document's size is its number of words.  Sources, in code point order with null last,
weigh 5, 2, 1 and so on; their targets share the total size by weight, stop at
``MAX_COPIES`` times the source's size, and what they can't take is shared again by weight.
Every document of a source has the same expected copies c = target / source size.  Lined up
by (size, doc_id), the prefix sums of the expected copies are c, 2c, 3c, ...; with one
random offset per source, a document is emitted once per integer its step crosses.  The
order by size stratifies the sample, so the taken words come near the target.

The prefix runs over all documents at once without one task per source: rows are range
partitioned by (source, size, doc_id), numbered inside each block, and the block counts (one
row per block and source) give the offsets, so a source with a third of all rows is spread
over a third of the blocks.

Defined results: null texts have size 0; size-0 documents take nothing; a source without any
word has target 0 and is never emitted; the sources' own rows (one each, some 50 bytes) are ordered in one
task, which is meant for up to some millions of sources; rows that repeat (source, size, doc_id) are
interchangeable; null doc_ids come first.  Offsets are hashes of the source's name and the
seed, so reruns agree on any number of partitions.  Very long texts count whole.  An empty table gives an empty
result; other columns are not read, and ``emit_copies`` returns them whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulcrum.llm.scratch import Scratch
from fulcrum.llm.words import n_words, text_or_empty

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``sizes`` (source, source_size: one row per source) with ``target`` double and the
    source's random ``shift`` in [0, 1), a multiple of 2^-16.

    Sharing by weight under caps is water filling: with sources ordered by cap / weight,
    the level after capping the first k is (total - their caps) / (the others' weight); the
    first source that lies above its level ends the capping, and the highest level is final.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weigh = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    ordered = Window.orderBy(F.col("_cap") / F.col("_w"), "_place")
    whole = Window.partitionBy()
    return (
        sizes.withColumn("_place", F.row_number().over(place) - 1)
        .withColumn("_w", weigh.cast("long"))
        .withColumn("_cap", F.lit(max_copies).cast("long") * F.col("source_size"))
        .withColumn("_left", F.sum("source_size").over(whole)
                    - F.coalesce(F.sum("_cap").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_open", F.sum("_w").over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("_level", F.max(F.col("_left").cast("double") / F.col("_open")).over(whole))
        .withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_w")))
        .withColumn("shift", _shift(F.col("source")))
        .drop("_place", "_w", "_cap", "_left", "_open", "_level")
    )


def _shift(source: Column) -> Column:
    named = F.concat(F.lit(SEED + ":"), F.coalesce(F.concat(F.lit("s:"), source), F.lit("null")))
    return F.conv(F.substring(F.md5(named), 1, 4), 16, 10).cast("double") / F.lit(65536.0)


def systematic_mix(docs: DataFrame, scratch: Scratch, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``keep`` columns, size, source_size, target, copies."""
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)],
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
        n_words(text_or_empty("text")).alias("size"))
    # the position is global: the block number in the high bits, the row's place in the low ones
    placed = scratch.write(
        rows.repartitionByRange("_source", "size", "_id")
        .sortWithinPartitions("_source", "size", "_id")
        .withColumn("_block", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        "placed")
    blocks = scratch.write(
        placed.groupBy("_source", "_block").agg(
            F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_words")),
        "blocks")
    targets = source_targets(
        blocks.groupBy(F.col("_source").alias("source")).agg(F.sum("_words").alias("source_size")))
    before = Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .join(targets, F.col("_source").eqNullSafe(F.col("source")))
        .select(F.col("_block").alias("_b"), "source", "source_size", "target", "shift",
                (F.col("_before") - F.col("_first")).alias("_add"))
    )
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (
        placed.join(offsets, (F.col("_block") == F.col("_b")) & F.col("_source").eqNullSafe(F.col("source")))
        .withColumn("_each", each)
        .withColumn("_rank", F.col("_at") + F.col("_add"))
        .withColumn("copies", (F.floor(F.col("shift") + F.col("_each") * (F.col("_rank") + 1))
                               - F.floor(F.col("shift") + F.col("_each") * F.col("_rank"))).cast("int"))
        .select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "size", "source_size", "target", "copies")
    )


def emit_copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The mix itself: ``docs``' own columns, each document as often as it is taken."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    slim = docs.select("doc_id", "source", "text", row.alias("_row"))
    mixed = systematic_mix(slim, scratch, keep=("_row",))
    return (mixed.where(F.col("copies") > 0)
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"))
            .select("_row.*"))
