"""Percentile-rank composite scoring (C6) and the supplier scorecard (C7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulcrum.functions.numeric import coefficient_of_variation, ratio, round_half_up
from fulcrum.operators.order_stats import ntile_from_row_number, percent_ranks, row_numbers
from fulcrum.operators.volatility import demand_volatility, period_counts
from fulcrum.sources.tables import Share, stage_until_exit, unshared

# Risk weights per percentile-ranked component (higher = worse), sum 1.
RISK_WEIGHTS = {"late": 0.30, "cancel": 0.20, "badrev": 0.20, "freight": 0.15, "vol": 0.15}
MIN_ORDERS = 20
RISK_BUCKETS = 5


def weighted_score(ranks: dict[str, Column], weights: dict[str, float]) -> Column:
    """sum_i w_i * rank_i, summed left to right in the order of ``weights``."""
    if set(ranks) != set(weights):
        raise ValueError(f"weights {sorted(weights)} do not match components {sorted(ranks)}")
    if abs(sum(weights.values()) - 1.0) > 1e-9:
        raise ValueError(f"weights must sum to 1, got {sum(weights.values())}")
    expr = None
    for name, w in weights.items():
        term = F.lit(float(w)) * ranks[name]
        expr = term if expr is None else expr + term
    return expr


def percentile_score(
    df: DataFrame,
    key: str,
    components: dict[str, Column],
    weights: dict[str, float],
    buckets: int = RISK_BUCKETS,
    score: str = "risk_score",
    bucket: str = "risk_quintile",
    totals_of: tuple[str, ...] = (),
    share: Share = unshared,
    stage: Share = stage_until_exit,
) -> DataFrame:
    """Rank every component over the rows of ``df`` (0 = best, 1 = worst, NULL worst),
    combine with ``weights`` into ROUND(100 * score, 1) and an NTILE bucket (ascending,
    ties broken by ``key``).  Returns df + ``<component>_pr`` + score + bucket, plus
    ``<col>_total`` (sum over all rows) for every column in ``totals_of``.  ``share`` keeps
    the input, which is read twice; ``stage`` writes the ranked rows."""
    df = share(df)
    raw = weighted_score({n: F.col(n + "_pr") for n in components}, weights)
    scored = df.join(percent_ranks(df, key, components, stage=stage), key, "inner").withColumn("_raw", raw)
    numbered = row_numbers(scored, "_raw", key, "_rn", count="_n", totals_of=totals_of, stage=stage)
    return numbered.select(
        *df.columns,
        *[n_ + "_pr" for n_ in components],
        *[f"{m}_total" for m in totals_of],
        round_half_up(F.lit(100.0) * F.col("_raw"), 1).alias(score),
        ntile_from_row_number(F.col("_rn"), F.col("_n"), buckets).alias(bucket),
    )


# ---------------------------------------------------------------- supplier scorecard (C7)
ORDER_FLAGS = ("order_month", "is_delivered", "is_late", "is_canceled", "is_bad_review", "review_score")


def supplier_orders(pairs: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct (supplier, order, month, flags), for orders in the order fact.  ``pairs`` are
    distinct (order, supplier), so only repeated rows of the fact need collapsing; that
    happens on the order side, before the join."""
    distinct = orders.select("order_id", *ORDER_FLAGS).distinct()
    return pairs.select("supplier_id", "order_id").join(distinct, "order_id", "inner").select(
        "supplier_id", "order_id", *ORDER_FLAGS)


def supplier_monthly(sorders: DataFrame) -> DataFrame:
    """Distinct orders per supplier and month."""
    return period_counts(
        sorders.select("supplier_id", "order_month", "order_id").distinct().where(F.col("order_id").isNotNull()),
        "supplier_id", "order_month", "n_orders")


def supplier_volatility(sorders: DataFrame) -> DataFrame:
    return demand_volatility(supplier_monthly(sorders), "supplier_id", "n_orders", "demand_volatility")


def _order_summary(orders: DataFrame) -> DataFrame:
    """Per (order, month): sums over the distinct flag rows, and whether it is the order's first
    month.  A sound fact has one row per order; repeated rows collapse here, then one exchange by
    order serves both groupings and the join that follows."""
    delivered, late, reviewed = F.col("is_delivered"), F.col("is_late"), F.col("review_score").isNotNull()
    per_month = orders.select("order_id", *ORDER_FLAGS).distinct().repartition("order_id").groupBy("order_id", "order_month").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(delivered & late).alias("_late"),
        F.count_if(delivered).alias("_delivered"),
        F.count_if(F.col("is_canceled")).alias("_canceled"),
        F.count_if(F.col("is_bad_review") & reviewed).alias("_bad"),
        F.count_if(reviewed).alias("_reviewed"),
    )
    first = F.row_number().over(Window.partitionBy("order_id").orderBy("order_month")) == 1
    return per_month.withColumn("_first", first).withColumnRenamed("order_id", "_oid")


def supplier_base(pairs: DataFrame, orders: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """All suppliers with an order in the fact: distinct orders, revenue, freight (DECIMAL),
    freight burden, late / cancel / bad-review rates (region rule: NULL lateness counts as
    not late) and volatility.  ``pairs`` are distinct (order, supplier).

    (order, supplier) pairs JOIN the orders' summary, aggregated to (supplier, month) and then to
    supplier.  Rates are over the distinct (order, flags) rows, as integer sums over integer counts
    (the same double as averaging 1.0/0.0); volatility comes from exact monthly moments.  Revenue and
    freight are summed apart, from ``lines`` (``star.supplier_lines``; by default from columns of
    ``pairs``), which needs no order: they cover every item of the supplier, also items of orders
    missing from the fact, and count once however often the fact repeats an order."""
    parts = ("_rows", "_late", "_delivered", "_canceled", "_bad", "_reviewed")
    money = (pairs if lines is None else lines).groupBy(F.col("supplier_id").alias("_sid")).agg(
        F.sum("revenue").alias("revenue"), F.sum("freight").alias("freight"))
    links = pairs.where(F.col("supplier_id").isNotNull()).select("supplier_id", "order_id")
    monthly = links.join(_order_summary(orders), F.col("order_id") == F.col("_oid")).groupBy("supplier_id", "order_month").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("_first")).alias("_orders"),
        *[F.sum(c).alias(c) for c in parts],
    )
    n = F.col("_n")
    base = monthly.groupBy("supplier_id").agg(
        F.sum("_orders").alias("orders"),
        *[F.sum(c).alias(c) for c in parts],
        F.count(n).alias("_k"), F.sum(n).alias("_s1"), F.sum(n * n).alias("_s2"),
    ).where(F.col("orders") > 0).join(money, F.col("supplier_id") == F.col("_sid"), "left")

    def rate(num: str, den: str) -> Column:
        return F.when(F.col(den) > 0, F.col(num).cast("double") / F.col(den).cast("double"))

    return base.select(
        "supplier_id",
        "orders",
        "revenue",
        "freight",
        F.when(F.col("revenue") > 0, ratio(F.col("freight"), F.col("revenue"))).alias("freight_burden"),
        rate("_late", "_delivered").alias("late_rate"),
        rate("_canceled", "_rows").alias("cancel_rate"),
        rate("_bad", "_reviewed").alias("bad_review_rate"),
        coefficient_of_variation(F.col("_k"), F.col("_s1"), F.col("_s2")).alias("demand_volatility"),
    )


def score_components() -> dict[str, Column]:
    """Ranked components (higher = worse); missing volatility ranks as 0."""
    return {
        "late": F.col("late_rate"),
        "cancel": F.col("cancel_rate"),
        "badrev": F.col("bad_review_rate"),
        "freight": F.col("freight_burden"),
        "vol": F.coalesce(F.col("demand_volatility"), F.lit(0.0)),
    }


def supplier_percent_ranks(base: DataFrame, min_orders: int = MIN_ORDERS, stage: Share = stage_until_exit) -> DataFrame:
    """Component percent ranks over the *scored* population (orders >= min_orders)."""
    scored = base.where(F.col("orders") >= F.lit(min_orders))
    return percent_ranks(scored, "supplier_id", score_components(), stage=stage)


def supplier_scorecard(
    base: DataFrame,
    min_orders: int = MIN_ORDERS,
    weights: dict[str, float] | None = None,
    share: Share = unshared,
    stage: Share = stage_until_exit,
) -> DataFrame:
    """Scorecard of suppliers with >= min_orders orders: rates, revenue share of the scored
    population, ROUND(100 * weighted percentile score, 1) and risk quintile (1 = best)."""
    weights = RISK_WEIGHTS if weights is None else weights
    scored = base.where(F.col("orders") >= F.lit(min_orders))
    out = percentile_score(
        scored, "supplier_id", score_components(), weights, RISK_BUCKETS, totals_of=("revenue",), share=share, stage=stage)
    return out.select(
        "supplier_id",
        "orders",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("freight").cast("double").alias("freight"),
        "late_rate",
        "cancel_rate",
        "bad_review_rate",
        "freight_burden",
        "demand_volatility",
        F.try_divide(F.col("revenue").cast("double"), F.col("revenue_total").cast("double")).alias("revenue_share"),
        "risk_score",
        "risk_quintile",
    )
