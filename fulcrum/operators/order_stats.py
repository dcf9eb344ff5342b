"""Global order statistics without a single-partition window.

``PERCENT_RANK() OVER (ORDER BY x)``, ``NTILE``, ``ROW_NUMBER`` and running sums with no
``PARTITION BY`` make Spark move every row into one task.  Here the rows are range
partitioned once by (value, key): Spark samples the bounds, and as the key is part of the range a
value that most rows share is split like any other.  Each block (partition) is ranked on its own
and the slim result is staged, which fixes the blocks.  A second, tiny step sums the blocks up to
the ones before; rows get their block's offset by a join on the block's number.

Ties are the one thing that reaches over block edges: all rows of a value have one rank
and one cumulative sum.  A block knows its first and its last value and what they add up
to, so a run of equal values is followed from block to block.

What goes through one task is one row per block (and component), however many rows there are.
The staged tables are written with ``stage`` (by default kept until the driver's Python ends).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulcrum.sources.tables import Share, stage_until_exit

_PLACE_BITS = 33  # monotonically_increasing_id: the row's place in its partition


def _in_blocks(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` range partitioned by ``order``, with the block's number."""
    return df.repartitionByRange(*order).withColumn("_block", F.spark_partition_id())


def _before(of: Column, window) -> Column:
    return F.coalesce(F.sum(of).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def row_numbers(
    df: DataFrame, order: str, key: str, name: str = "row_number", descending: bool = False, count: str | None = None,
    totals_of: Sequence[str] = (), stage: Share = stage_until_exit,
) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order, key) with nulls of ``order`` last; ``key`` must be
    unique.  ``count`` names an optional column holding the number of rows; every column in
    ``totals_of`` gets a ``<column>_total`` with its sum over all rows."""
    by = [F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_last(), F.col(key).asc_nulls_last()]
    placed = stage(
        _in_blocks(df, *by).sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))))
    # one row per block from here on
    every = Window.partitionBy()
    blocks = placed.groupBy("_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"), *[F.sum(c).alias(f"{c}_total") for c in totals_of])
    blocks = blocks.select(
        F.col("_block").alias("_b"), (_before(F.col("_n"), Window.orderBy("_block")) - F.col("_from") + 1).alias("_add"),
        F.sum("_n").over(every).alias("_all"), *[F.sum(f"{c}_total").over(every).alias(f"{c}_total") for c in totals_of])
    return placed.join(blocks, F.col("_block") == F.col("_b")).select(
        *df.columns, (F.col("_at") + F.col("_add")).alias(name), *([F.col("_all").alias(count)] if count else []),
        *[f"{c}_total" for c in totals_of])


def ntile_from_row_number(row_number: Column, n: Column, buckets: int) -> Column:
    """NTILE(buckets) given a 1-based row number over n rows: the first n % buckets buckets
    hold one extra row."""
    q = F.floor(n / F.lit(buckets)).cast("long")
    r = n - q * F.lit(buckets)
    i = row_number - F.lit(1)
    big = r * (q + F.lit(1))
    return F.when(i < big, F.floor(i / (q + F.lit(1))) + F.lit(1)).otherwise(
        r + F.floor((i - big) / F.when(q > 0, q)) + F.lit(1)
    ).cast("long")


def ntile(df: DataFrame, buckets: int, order: str, key: str, name: str, stage: Share = stage_until_exit) -> DataFrame:
    """NTILE(buckets) OVER (ORDER BY order, key); ``key`` must be unique."""
    numbered = row_numbers(df, order, key, "_rn", count="_n", stage=stage)
    return numbered.withColumn(name, ntile_from_row_number(F.col("_rn"), F.col("_n"), buckets)).drop("_rn", "_n")


def percent_ranks(df: DataFrame, key: str | Sequence[str], components: dict[str, Column], suffix: str = "_pr",
                  stage: Share = stage_until_exit) -> DataFrame:
    """PERCENT_RANK() OVER (ORDER BY c ASC NULLS LAST) for every component c.

    Returns ``key`` + one ``<name><suffix>`` double per component, one row per input row
    (``key`` must be unique).  Ties share a rank; NULL sorts last (rank = 1 + #non-NULL).
    All components go through one range exchange, one after the other.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = list(components)
    # -0.0 and 0.0 are one value
    values = df.select(*keys, *[(components[n].cast("double") + F.lit(0.0)).alias(n) for n in names])
    long = values.unpivot(keys, names, "_component", "_x").select(
        *keys, F.array_position(F.array(*[F.lit(n) for n in names]), F.col("_component")).cast("int").alias("_component"),
        F.struct(F.col("_x").isNull().alias("none"), F.coalesce("_x", F.lit(0.0)).alias("x")).alias("_value"))
    local = Window.partitionBy("_component", "_block").orderBy("_value")
    placed = stage(_in_blocks(long, F.col("_component"), F.col("_value"), *map(F.col, keys))
                   .withColumn("_rank", F.rank().over(local).cast("long")))
    # one row per component and block from here on
    blocks = placed.groupBy("_component", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_value").alias("_lo"), F.max("_value").alias("_hi"), F.max("_rank").alias("_last"))
    order = Window.partitionBy("_component").orderBy("_block")
    run = Window.partitionBy("_component", "_hi").orderBy("_block")
    blocks = (
        blocks.withColumn("_run", F.sum(F.col("_n") - F.col("_last") + 1).over(run))  # rows of the last value up to here
        .withColumn("_tied", F.when(F.lag("_hi").over(order) == F.col("_lo"), F.lag("_run").over(order)).otherwise(F.lit(0)))
        .select(F.col("_component").alias("_c"), F.col("_block").alias("_b"), "_lo", "_tied",
                _before(F.col("_n"), order).alias("_ahead"), F.sum("_n").over(Window.partitionBy("_component")).alias("_all")))
    less = F.col("_ahead") + F.col("_rank") - 1 - F.when(F.col("_value") == F.col("_lo"), F.col("_tied")).otherwise(F.lit(0))
    rank = F.when(F.col("_all") > 1, less.cast("double") / (F.col("_all") - 1).cast("double")).otherwise(F.lit(0.0))
    ranked = placed.join(blocks, (F.col("_component") == F.col("_c")) & (F.col("_block") == F.col("_b")))
    return ranked.withColumn("_pr", rank).groupBy(*keys).agg(
        *[F.max(F.when(F.col("_component") == i, F.col("_pr"))).alias(n + suffix) for i, n in enumerate(names, 1)])


def cumulative_share_desc(df: DataFrame, key: str, value: str, name: str = "cum_share", total: str = "total",
                          position: str | None = None, stage: Share = stage_until_exit) -> DataFrame:
    """SUM(value) OVER (ORDER BY value DESC) / SUM(value) OVER () with the default RANGE
    frame: rows with equal value share one cumulative sum.  ``total`` is SUM(value) over all
    rows; ``position`` names an optional column with ROW_NUMBER() OVER (ORDER BY value DESC, key);
    ``key`` must be unique then."""
    by = [F.col(value).desc_nulls_last(), F.col(key).asc_nulls_last()]
    inside = Window.partitionBy("_block")
    placed = stage(
        _in_blocks(df, *by)
        .withColumn("_sum", F.coalesce(F.sum(value).over(inside.orderBy(by[0])), F.lit(0)))
        .withColumn("_at", F.row_number().over(inside.orderBy(*by)).cast("long")))
    # one row per block from here on
    blocks = placed.groupBy("_block").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_value"), F.min_by(value, "_at").alias("_lo"),
        F.max_by(value, "_at").alias("_hi"), F.min_by("_sum", "_at").alias("_first"))
    order, every = Window.orderBy("_block"), Window.partitionBy()
    back = Window.partitionBy("_lo").orderBy(F.desc("_block"))
    blocks = (
        blocks.withColumn("_run", F.sum("_first").over(back))  # sum of the first value from here on
        .withColumn("_tied", F.when(F.lead("_lo").over(order).eqNullSafe(F.col("_hi")) & (F.lead("_n").over(order) > 0),
                                    F.lead("_run").over(order)).otherwise(F.lit(0)))
        .select(F.col("_block").alias("_b"), "_hi", "_tied", _before(F.col("_value"), order).alias("_ahead"),
                _before(F.col("_n"), order).alias("_rows"), F.sum("_value").over(every).alias("_all")))
    reached = F.col("_ahead") + F.col("_sum") + F.when(F.col(value).eqNullSafe(F.col("_hi")), F.col("_tied")).otherwise(F.lit(0))
    return placed.join(blocks, F.col("_block") == F.col("_b")).select(
        *df.columns, F.try_divide(reached.cast("double"), F.col("_all").cast("double")).alias(name), F.col("_all").alias(total),
        *([(F.col("_rows") + F.col("_at")).alias(position)] if position else []))
