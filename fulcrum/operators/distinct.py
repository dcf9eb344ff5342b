"""Several exact distinct counts, and other totals, in one scan.

``COUNT(DISTINCT a), COUNT(DISTINCT b)`` makes Spark expand every row once per distinct column
before anything is reduced.  Here the rows are first grouped by all the columns together, map-side,
so that only the groups are listed once per column; a group's totals travel with its first
listing.  No value is numbered or hashed: counts are exact for any type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, distinct: dict[str, str], totals: dict[str, tuple[Column, Callable]]) -> DataFrame:
    """One row: for every name in ``distinct`` the number of distinct non-null values of its column, for
    every name in ``totals`` an aggregate, given with the function that merges its partial results."""
    columns = list(distinct.values())
    groups = df.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)]).agg(
        *[a.alias(f"_t{j}") for j, (a, _) in enumerate(totals.values())])
    tag = F.col("_tag")
    listed = groups.withColumn("_tag", F.explode(F.sequence(F.lit(0), F.lit(len(columns) - 1))))
    keys = [F.when(tag == i, F.col(f"_k{i}")).alias(f"_k{i}") for i in range(len(columns))]
    merges = [merge for _, merge in totals.values()]
    values = listed.select("_tag", *keys, *[F.when(tag == 0, F.col(f"_t{j}")).alias(f"_t{j}") for j in range(len(merges))]).groupBy(
        "_tag", *[f"_k{i}" for i in range(len(columns))]).agg(*[m(f"_t{j}").alias(f"_t{j}") for j, m in enumerate(merges)])
    # a count of no rows is 0, as it would be without the grouping
    merged = [F.coalesce(m(f"_t{j}"), F.lit(0)) if m is F.sum else m(f"_t{j}") for j, m in enumerate(merges)]
    return values.agg(*[F.count(F.when(tag == i, F.col(f"_k{i}"))).alias(n) for i, n in enumerate(distinct)],
                      *[c.alias(n) for c, n in zip(merged, totals)])
