"""Demand volatility: coefficient of variation of per-period activity (C5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulcrum.functions.numeric import coefficient_of_variation


def period_counts(events: DataFrame, entity: str, period: str, name: str = "n_orders") -> DataFrame:
    """Rows per (entity, period) — only observed periods (no zero fill).  ``events`` must
    already be distinct on the counted item (e.g. one row per supplier x order)."""
    return events.groupBy(entity, period).agg(F.count(F.lit(1)).alias(name))


def demand_volatility(counts: DataFrame, entity: str, count_col: str = "n_orders", name: str = "demand_volatility") -> DataFrame:
    """STDDEV_SAMP(count) / AVG(count) per entity over its active periods; NULL for a single
    period.  Computed from exact integer moments, so it is identical under any shuffle."""
    n = F.col(count_col).cast("long")
    moments = counts.groupBy(entity).agg(
        F.count(n).alias("_k"), F.sum(n).alias("_s1"), F.sum(n * n).alias("_s2")
    )
    return moments.select(entity, coefficient_of_variation(F.col("_k"), F.col("_s1"), F.col("_s2")).alias(name))
