"""Chart and exploratory extracts over the marts (C8, C9, summaries, Pareto series).

These were pandas post-processing steps on collected results; here each is part of the
Spark plan and only the small final result ever reaches a driver.  Top-k extracts carry
a total order (value, then name) so LIMIT is deterministic; the others come unordered, and
``SUMMARY_ORDER`` names the order in which a summary is shown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulcrum.functions.measures import flag_rate
from fulcrum.functions.numeric import round_half_even, round_half_up
from fulcrum.operators.distinct import distinct_counts
from fulcrum.operators.order_stats import row_numbers

# The order in which the summaries are shown.
SUMMARY_ORDER = {
    "abc_summary": (F.asc, "abc_class"),
    "status_distribution": (F.desc, "n"),
    "risk_quintile_summary": (F.desc, "risk_quintile"),
    "late_vs_satisfaction": (F.asc, "bucket"),
    "satisfaction_chart": (F.desc, "bucket"),
}


def shown(name: str, summary: DataFrame) -> DataFrame:
    """A summary in its published row order."""
    way, column = SUMMARY_ORDER[name]
    return summary.orderBy(way(column))


def positioned(summary: DataFrame, column: str, falls: bool, key: str) -> DataFrame:
    """``summary`` with the 1-based ``position`` of every row in its published order."""
    return row_numbers(summary, column, key, "position", descending=falls)


# Extract parameters (thresholds, limits, buckets, chart scale factors).
REGION_MIN_ORDERS = 500
REGION_TOP_LATE = 12
REGION_HEAD = 8
REGION_TOP_IMPACT = 10
HIGH_LATE_RATE = 0.10
TOP_CATEGORY_LABELS = 6
AB_CLASSES = ("A", "B")
LATE_BUCKET, ON_TIME_BUCKET = "late", "on_time"
LATE_LABEL, ON_TIME_LABEL = "Late", "On-time"
REVENUE_MILLIONS = 1e6
BUBBLE_SCALE = 1200.0
POINT_SCALE = 200.0


# ------------------------------------------------------------------ satisfaction (C8)
def late_vs_satisfaction(fact: DataFrame) -> DataFrame:
    """Delivered, reviewed orders split into late / on-time (NULL lateness = on-time):
    orders, mean score (2 places), bad-review rate (3 places)."""
    bucket = F.when(F.col("is_late"), LATE_BUCKET).otherwise(ON_TIME_BUCKET)
    return (
        fact.where(F.col("is_delivered") & F.col("review_score").isNotNull())
        .groupBy(bucket.alias("bucket"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            round_half_up(F.avg(F.col("review_score").cast("double")), 2).alias("avg_review"),
            round_half_up(flag_rate(F.col("is_bad_review")), 3).alias("bad_review_rate"),
        )
    )


def satisfaction_chart(fact: DataFrame) -> DataFrame:
    """The same split for the chart: labels, unrounded bad-review rate and mean score."""
    bucket = F.when(F.col("is_late"), LATE_LABEL).otherwise(ON_TIME_LABEL)
    return (
        fact.where(F.col("is_delivered") & F.col("review_score").isNotNull())
        .groupBy(bucket.alias("bucket"))
        .agg(flag_rate(F.col("is_bad_review")).alias("bad_rate"),
             F.avg(F.col("review_score").cast("double")).alias("avg_score"))
    )


def late_relative_risk(fact: DataFrame) -> DataFrame:
    """max / min of the (rounded) bucket bad-review rates, to one decimal."""
    rates = late_vs_satisfaction(fact)
    return rates.agg(
        round_half_up(F.try_divide(F.max("bad_review_rate"), F.min("bad_review_rate")), 1).alias("relative_risk")
    )


# --------------------------------------------------------------------- overview
def fact_overview(fact: DataFrame) -> DataFrame:
    return distinct_counts(
        fact, {"suppliers": "primary_supplier_id", "regions": "region_state"},
        {"orders": (F.count(F.lit(1)), F.sum), "first_order": (F.min("order_ts"), F.min), "last_order": (F.max("order_ts"), F.max)},
    ).select("orders", "suppliers", "regions", "first_order", "last_order")


def status_distribution(fact: DataFrame) -> DataFrame:
    """Orders per status and percent of all orders (2 places).  The total is summed over the
    grouped rows (one per status), so the fact is read once."""
    total = F.sum("n").over(Window.partitionBy())
    return fact.groupBy("order_status").agg(F.count(F.lit(1)).alias("n")).select(
        "order_status", "n", round_half_up(F.lit(100.0) * F.col("n") / total.cast("double"), 2).alias("pct")
    )


def ontime_trend(monthly: DataFrame, first_month: str, last_month: str) -> DataFrame:
    """Monthly on-time rate between two ``yyyy-MM`` months, inclusive (string compare)."""
    return monthly.where(F.col("order_month").between(first_month, last_month)).select("order_month", "on_time_rate", "orders")


# -------------------------------------------------------------------- regions (C9)
def _big_regions(region: DataFrame, min_orders: int) -> DataFrame:
    return region.where(F.col("orders") >= F.lit(min_orders))


def region_top_late(region: DataFrame, min_orders: int = REGION_MIN_ORDERS, k: int = REGION_TOP_LATE) -> DataFrame:
    return (
        _big_regions(region, min_orders)
        .select("region_state", "late_rate", (F.col("late_rate") >= F.lit(HIGH_LATE_RATE)).alias("high_risk"))
        .orderBy(F.col("late_rate").desc_nulls_last(), F.col("region_state"))
        .limit(k)
    )


def _with_impact(region: DataFrame, min_orders: int) -> DataFrame:
    return _big_regions(region, min_orders).select(
        "region_state", "orders", "late_rate", "avg_delay_days_late", "bad_review_rate",
        round_half_even(F.col("orders").cast("double") * F.col("late_rate"), 0).alias("impact_late_orders"),
    )


def region_late_head(region: DataFrame, min_orders: int = REGION_MIN_ORDERS, k: int = REGION_HEAD) -> DataFrame:
    """First k big regions by late rate, with estimated late orders (orders x late rate)."""
    return _with_impact(region, min_orders).orderBy(F.col("late_rate").desc_nulls_last(), F.col("region_state")).limit(k)


def region_impact(region: DataFrame, min_orders: int = REGION_MIN_ORDERS, k: int = REGION_TOP_IMPACT) -> DataFrame:
    """Top k big regions by estimated late orders."""
    return (
        _with_impact(region, min_orders)
        .select("region_state", "impact_late_orders")
        .orderBy(F.col("impact_late_orders").desc_nulls_last(), F.col("region_state"))
        .limit(k)
    )


# ------------------------------------------------------------------ categories
def abc_summary(category: DataFrame) -> DataFrame:
    """Categories and revenue share per ABC class; the class share is class revenue /
    total revenue (exact), equal to the sum of member shares."""
    per_class = category.groupBy("abc_class").agg(
        F.count(F.lit(1)).alias("categories"), F.sum(F.col("revenue").cast("decimal(38,2)")).alias("_rev")
    )
    total = F.sum("_rev").over(Window.partitionBy())  # over the (at most three) class rows
    return per_class.select(
        "abc_class", "categories",
        round_half_up(F.try_divide(F.col("_rev").cast("double"), total.cast("double")), 3).alias("revenue_share"),
    )


def category_ab_map(category: DataFrame, classes=AB_CLASSES) -> DataFrame:
    """A/B categories with the bubble-chart measures (revenue in millions, bubble size)."""
    return category.where(F.col("abc_class").isin(*classes)).select(
        "product_category", "revenue", "late_rate", "bad_review_rate", "avg_freight_ratio",
        (F.col("revenue") / F.lit(REVENUE_MILLIONS)).alias("revenue_millions"),
        (F.col("bad_review_rate") * F.lit(BUBBLE_SCALE)).alias("bubble_size"),
    )


def category_top_labels(category: DataFrame, classes=AB_CLASSES, k: int = TOP_CATEGORY_LABELS) -> DataFrame:
    return (
        category.where(F.col("abc_class").isin(*classes))
        .select("product_category", "revenue")
        .orderBy(F.col("revenue").desc(), F.col("product_category"))
        .limit(k)
    )


def pareto_series(category: DataFrame) -> DataFrame:
    """Categories in descending revenue order with their 1-based position; ``category`` is the
    mart with its ``position``."""
    return category.select("position", "product_category", "revenue_share", "cum_revenue_share", "abc_class")


# -------------------------------------------------------------------- suppliers
def supplier_risk_points(scorecard: DataFrame) -> DataFrame:
    """Scatter extract: one point per scored supplier, sized by revenue."""
    return scorecard.select(
        "supplier_id", "late_rate", "bad_review_rate", "revenue", "risk_score",
        (F.col("revenue") / F.lit(POINT_SCALE)).alias("point_size"),
    )


def risk_quintile_summary(scorecard: DataFrame) -> DataFrame:
    """Per quintile: suppliers, revenue (0 places), mean late and bad-review rates (3 places)."""
    return scorecard.groupBy("risk_quintile").agg(
        F.count(F.lit(1)).alias("suppliers"),
        round_half_up(F.sum(F.col("revenue").cast("decimal(38,2)")).cast("double"), 0).alias("revenue"),
        round_half_up(F.avg("late_rate"), 3).alias("avg_late"),
        round_half_up(F.avg("bad_review_rate"), 3).alias("avg_bad"),
    )
