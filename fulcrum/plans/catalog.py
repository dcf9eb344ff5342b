"""Query catalogue: every named query as ``(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables through the adapter and builds one lazy plan from the
operators: nothing is collected, and no job runs before the caller's action, but where rows are
ranked over the whole table: those stage a slim ranked table when the query is built.
Names follow SURVEY §7.3.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fulcrum.operators import quality, scoring, star
from fulcrum.plans import exports, insights, marts
from fulcrum.sources.tables import Shared, unshared
from fulcrum.sources.testdata import from_driver_tables

# Parameters chosen to make each filter bite on the driver data.
ONTIME_FIRST_MONTH = "1996-01"
ONTIME_LAST_MONTH = "1998-12"
STRICT_MIN_ORDERS = 580

Query = Callable[[SparkSession, str], DataFrame]


def _star(spark: SparkSession, sf_dir: str) -> star.Star:
    return star.Star(from_driver_tables(spark, sf_dir))


def _fact(spark, d) -> DataFrame:
    return _star(spark, d).orders


def _base(spark, d) -> DataFrame:
    st = _star(spark, d)
    return scoring.supplier_base(st.links, st.orders, st.lines)


def _scorecard(spark, d, min_orders=scoring.MIN_ORDERS, extract: Callable = unshared) -> DataFrame:
    shared = Shared()
    return shared.until(extract(scoring.supplier_scorecard(_base(spark, d), min_orders, share=shared.share)))


def _percent_ranks(spark, d) -> DataFrame:
    return scoring.supplier_percent_ranks(_base(spark, d))


def _region(spark, d) -> DataFrame:
    return marts.mart_region(_fact(spark, d))


def _category(spark, d, extract: Callable = unshared) -> DataFrame:
    return extract(marts.mart_category_risk(_fact(spark, d)))


def _pareto_series(spark, d) -> DataFrame:
    return insights.pareto_series(marts.mart_category_risk(_fact(spark, d), position="position"))


def _categories(src) -> DataFrame:
    return star.dim_category(src.products, src.category_translation)


def _order_value(spark, d) -> DataFrame:
    src = from_driver_tables(spark, d)
    return star.as_reference_types(star.order_value(src.order_items))


def _order_primary(spark, d) -> DataFrame:
    src = from_driver_tables(spark, d)
    return star.order_primary(src.order_items, _categories(src))


def _supplier_orders(spark, d) -> DataFrame:
    st = _star(spark, d)
    return scoring.supplier_orders(st.links, st.orders)


def _dq_report(spark, d) -> DataFrame:
    return quality.expect(_fact(spark, d), quality.FACT_ORDERS_RULES)


def _dq_summary(spark, d) -> DataFrame:
    return quality.summary(quality.expect(_fact(spark, d), quality.FACT_ORDERS_RULES, with_rows=True))


QUERIES: dict[str, Query] = {
    # dimensions
    "dim_supplier": lambda spark, d: star.dim_supplier(from_driver_tables(spark, d).sellers),
    "dim_region": lambda spark, d: star.dim_region(from_driver_tables(spark, d).customers),
    "dim_category": lambda spark, d: _categories(from_driver_tables(spark, d)),
    "dim_date": lambda spark, d: star.dim_date(from_driver_tables(spark, d).orders),
    # facts and their building blocks
    "fact_order_items": lambda spark, d: star.as_reference_types(_star(spark, d).items()),
    "order_value": _order_value,
    "order_primary": _order_primary,
    "order_review": lambda spark, d: star.order_review(from_driver_tables(spark, d).reviews),
    "fact_orders": lambda spark, d: star.as_reference_types(_fact(spark, d)),
    # headline marts
    "kpi_exec": lambda spark, d: marts.kpi_exec(_fact(spark, d)),
    "kpi_exec_wide": lambda spark, d: marts.kpi_exec_wide(_fact(spark, d)),
    "kpi_exec_labels": lambda spark, d: marts.kpi_exec_labels(_fact(spark, d)),
    "mart_monthly": lambda spark, d: marts.mart_monthly(_fact(spark, d)),
    "mart_region": _region,
    "mart_category_risk": _category,
    # category extracts
    "abc_summary": lambda spark, d: _category(spark, d, insights.abc_summary),
    "pareto_series": _pareto_series,
    "category_ab_map": lambda spark, d: _category(spark, d, insights.category_ab_map),
    "category_top_labels": lambda spark, d: _category(spark, d, insights.category_top_labels),
    # supplier chain
    "supplier_orders": _supplier_orders,
    "supplier_monthly": lambda spark, d: scoring.supplier_monthly(_supplier_orders(spark, d)),
    "supplier_volatility": lambda spark, d: scoring.supplier_volatility(_supplier_orders(spark, d)),
    "supplier_base": lambda spark, d: star.as_reference_types(_base(spark, d)),
    "supplier_percent_ranks": _percent_ranks,
    "supplier_scorecard": lambda spark, d: _scorecard(spark, d),
    "supplier_scorecard_min": lambda spark, d: _scorecard(spark, d, STRICT_MIN_ORDERS),
    "supplier_risk_points": lambda spark, d: _scorecard(spark, d, extract=insights.supplier_risk_points),
    "risk_quintile_summary": lambda spark, d: _scorecard(spark, d, extract=insights.risk_quintile_summary),
    # satisfaction and overview
    "late_vs_satisfaction": lambda spark, d: insights.late_vs_satisfaction(_fact(spark, d)),
    "satisfaction_chart": lambda spark, d: insights.satisfaction_chart(_fact(spark, d)),
    "late_relative_risk": lambda spark, d: insights.late_relative_risk(_fact(spark, d)),
    "fact_overview": lambda spark, d: insights.fact_overview(_fact(spark, d)),
    "status_distribution": lambda spark, d: insights.status_distribution(_fact(spark, d)),
    "ontime_trend": lambda spark, d: insights.ontime_trend(
        marts.mart_monthly(_fact(spark, d)), ONTIME_FIRST_MONTH, ONTIME_LAST_MONTH
    ),
    # regions
    "region_top_late": lambda spark, d: insights.region_top_late(_region(spark, d)),
    "region_late_head": lambda spark, d: insights.region_late_head(_region(spark, d)),
    "region_impact": lambda spark, d: insights.region_impact(_region(spark, d)),
    # data quality
    "dq_report": _dq_report,
    "dq_summary": _dq_summary,
}

QUERIES |= exports.ordered_queries(QUERIES) | exports.QUERIES
