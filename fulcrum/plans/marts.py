"""The six published marts (C2, C3, C4, C7) over the order fact.

Every mart is one aggregation (one shuffle on its grouping key, partial aggregation
map-side) plus, for category/supplier, the distributed order statistics.  Money is summed
exactly (DECIMAL) and rendered as DOUBLE at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulcrum.functions.measures import conditional_mean, conditional_sum, flag_rate, strict_flag_rate
from fulcrum.functions.numeric import exact_mean, format_fixed, ratio
from fulcrum.operators.pareto import pareto_abc
from fulcrum.sources.tables import Share, stage_until_exit

# The headline KPI names, in published order.
KPI_NAMES = (
    "total_orders",
    "delivered_orders",
    "total_revenue_brl",
    "total_freight_brl",
    "freight_to_revenue",
    "on_time_rate",
    "late_rate",
    "avg_delay_days_late",
    "cancel_rate",
    "bad_review_rate",
    "revenue_exposed_to_late_brl",
)

def _delivered() -> Column:
    return F.col("is_delivered")


def _late() -> Column:
    return F.col("is_late")


def _reviewed() -> Column:
    return F.col("review_score").isNotNull()


def _late_rate() -> Column:
    """Region/category/supplier rule: over delivered orders, NULL lateness = not late."""
    return F.avg(F.when(_delivered() & _late(), F.lit(1.0)).when(_delivered(), F.lit(0.0)))


def _bad_review_rate() -> Column:
    return flag_rate(F.col("is_bad_review"), _reviewed())


def _avg_delay_late() -> Column:
    return conditional_mean(F.col("delay_days"), _delivered() & _late())


def _mean_freight_ratio() -> Column:
    return exact_mean(F.col("freight_ratio"))


def _exec_aggregates(fact: DataFrame) -> DataFrame:
    """All eleven headline KPIs in one aggregate pass (instead of eleven scans)."""
    revenue, freight = F.sum("revenue"), F.sum("freight")
    return fact.agg(
        F.count(F.lit(1)).cast("double").alias("total_orders"),
        F.count_if(_delivered()).cast("double").alias("delivered_orders"),
        revenue.cast("double").alias("total_revenue_brl"),
        freight.cast("double").alias("total_freight_brl"),
        ratio(freight, revenue).alias("freight_to_revenue"),
        flag_rate(~_late(), _delivered()).alias("on_time_rate"),
        flag_rate(_late(), _delivered()).alias("late_rate"),
        _avg_delay_late().cast("double").alias("avg_delay_days_late"),
        flag_rate(F.col("is_canceled")).alias("cancel_rate"),
        _bad_review_rate().alias("bad_review_rate"),
        conditional_sum(F.col("revenue"), _delivered() & _late()).cast("double").alias("revenue_exposed_to_late_brl"),
    )


def kpi_exec_wide(fact: DataFrame) -> DataFrame:
    """One row, one double column per KPI."""
    return _exec_aggregates(fact).select(*KPI_NAMES)


def kpi_exec(fact: DataFrame) -> DataFrame:
    """Tall (kpi, value) form of the same single aggregate."""
    return kpis_tall(kpi_exec_wide(fact))


def kpis_tall(wide: DataFrame) -> DataFrame:
    """(kpi, value) rows of the one-row wide KPI frame, in published order."""
    return wide.unpivot([], list(KPI_NAMES), "kpi", "value")


def _fmt_thousands(c: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), format_fixed(c, 0, thousands=True))


def _fmt_percent(c: Column, digits: int) -> Column:
    # '{:.N%}' multiplies by 100 in double arithmetic, then prints with N decimals
    return F.concat(format_fixed(c * F.lit(100.0), digits), F.lit("%"))


# Display format per KPI (thousands, money, percent with n places, days).
KPI_FORMATS = {
    "total_orders": ("count", None),
    "delivered_orders": ("count", None),
    "total_revenue_brl": ("money", None),
    "total_freight_brl": ("money", None),
    "freight_to_revenue": ("percent", 1),
    "on_time_rate": ("percent", 1),
    "late_rate": ("percent", 1),
    "avg_delay_days_late": ("days", 1),
    "cancel_rate": ("percent", 2),
    "bad_review_rate": ("percent", 1),
    "revenue_exposed_to_late_brl": ("money", None),
}


def kpi_exec_labels(fact: DataFrame) -> DataFrame:
    """Tall KPIs plus a display label (``98,666``, ``R$ 13,591,644``, ``93.2%``, ``10.6 days``)."""
    return kpi_exec_labels_from_wide(kpi_exec_wide(fact))


def kpi_exec_labels_from_wide(wide: DataFrame) -> DataFrame:
    """Display labels for a one-row wide KPI frame (e.g. the headline document)."""
    v = F.col("value")
    label = None
    for name, (kind, digits) in KPI_FORMATS.items():
        if kind == "count":
            text = _fmt_thousands(v)
        elif kind == "money":
            text = _fmt_thousands(v, "R$ ")
        elif kind == "percent":
            text = _fmt_percent(v, digits)
        else:
            text = F.concat(format_fixed(v, digits), F.lit(" days"))
        cond = F.col("kpi") == name
        label = F.when(cond, text) if label is None else label.when(cond, text)
    return kpis_tall(wide.select(*[F.col(k).cast("double") for k in KPI_NAMES])).select("kpi", "value", label.alias("label"))


def mart_monthly(fact: DataFrame) -> DataFrame:
    """Per order month: orders, revenue, on-time rate (NULL lateness leaves the
    denominator), mean delay of late deliveries, bad-review rate."""
    return fact.groupBy("order_month").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("revenue").cast("double").alias("revenue"),
        strict_flag_rate(~_late(), _delivered()).alias("on_time_rate"),
        _avg_delay_late().cast("double").alias("avg_delay_days_late"),
        _bad_review_rate().alias("bad_review_rate"),
    )


def mart_region(fact: DataFrame) -> DataFrame:
    """Per customer state: orders, revenue, late rate, mean delay, mean freight ratio
    (mean of per-order ratios), bad-review rate."""
    return fact.where(F.col("region_state").isNotNull()).groupBy("region_state").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("revenue").cast("double").alias("revenue"),
        _late_rate().alias("late_rate"),
        _avg_delay_late().cast("double").alias("avg_delay_days_late"),
        _mean_freight_ratio().alias("avg_freight_ratio"),
        _bad_review_rate().alias("bad_review_rate"),
    )


def category_base(fact: DataFrame) -> DataFrame:
    """Per primary category (whole-order values attributed to the primary line); revenue DECIMAL."""
    return fact.where(F.col("primary_category").isNotNull()).groupBy(F.col("primary_category").alias("product_category")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("revenue").alias("revenue"),
        _mean_freight_ratio().alias("avg_freight_ratio"),
        _late_rate().alias("late_rate"),
        _bad_review_rate().alias("bad_review_rate"),
    )


def mart_category_risk(fact: DataFrame, stage: Share = stage_until_exit, position: str | None = None) -> DataFrame:
    """Category risk with revenue share, Pareto cumulative share and ABC class, and with the
    1-based ``position`` in descending revenue order if one is asked for."""
    return category_risk_from_base(category_base(fact), stage, position)


def category_risk_from_base(base: DataFrame, stage: Share = stage_until_exit, position: str | None = None) -> DataFrame:
    ranked = pareto_abc(base, "product_category", "revenue", position=position, stage=stage)
    return ranked.select(
        "product_category", "orders", F.col("revenue").cast("double").alias("revenue"), "avg_freight_ratio",
        "late_rate", "bad_review_rate", "revenue_share", "cum_revenue_share", "abc_class", *([position] if position else []),
    )
