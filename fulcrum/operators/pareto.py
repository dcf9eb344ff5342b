"""Revenue concentration: share of total, Pareto cumulative share and ABC class (C4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulcrum.operators.order_stats import cumulative_share_desc
from fulcrum.sources.tables import Share, stage_until_exit

# ABC cut-offs on the cumulative share (A <= 0.80 < B <= 0.95 < C).
ABC_CUTS = (0.80, 0.95)
ABC_LABELS = ("A", "B", "C")


def abc_class(cum_share: Column, cuts: Sequence[float] = ABC_CUTS, labels: Sequence[str] = ABC_LABELS) -> Column:
    """First label whose cut the cumulative share does not exceed; NULL share -> last label."""
    expr = None
    for cut, label in zip(cuts, labels):
        cond = cum_share <= F.lit(float(cut))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(labels[len(cuts)])


def pareto_abc(
    df: DataFrame,
    key: str,
    value: str,
    share: str = "revenue_share",
    cum_share: str = "cum_revenue_share",
    klass: str = "abc_class",
    cuts: Sequence[float] = ABC_CUTS,
    position: str | None = None,
    stage: Share = stage_until_exit,
) -> DataFrame:
    """Add value / total, the cumulative share in descending value order (ties share a
    cumulative value, as the default RANGE frame) and the ABC class.

    ``value`` should be exact (DECIMAL or integer) so shares and classes do not depend on
    aggregation order; ``key`` names the entity.  The total, and the 1-based ``position`` by (value
    DESC, key) if one is asked for, come out of the same distributed pass as the cumulative share
    (no window over a single partition).
    """
    out = cumulative_share_desc(df, key, value, cum_share, total="_total", position=position, stage=stage)
    out = out.withColumn(share, F.try_divide(F.col(value).cast("double"), F.col("_total").cast("double")))
    cols = [c for c in out.columns if c not in (share, cum_share, "_total", position)]
    return out.select(*cols, *([position] if position else []), share, cum_share, abc_class(F.col(cum_share), cuts).alias(klass))
