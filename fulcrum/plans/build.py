"""End-to-end build: sources -> staged star -> data-quality gate -> marts -> sinks.

The star (item roll-up and order fact) is materialised once as staged Parquet and every
mart reads it; the quality gate runs on the fact *before* any mart is written.  All tables of a
build are published at once or not at all.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulcrum.operators import quality, scoring, star
from fulcrum.plans import marts
from fulcrum.sources.model import Sources
from fulcrum.sources.published import Published, Table
from fulcrum.sources.sinks import write_headline_json, write_table
from fulcrum.sources.tables import drop_stage_root, new_stage_root, stage_table, staging_scope, submit_in_scope

# The published mart names, in export order.
MART_NAMES = (
    "mart_exec_kpis",
    "mart_exec_kpis_wide",
    "mart_monthly",
    "mart_region",
    "mart_product_risk",
    "mart_supplier_scorecard",
)


# The row order each mart is exported in: column, whether it falls, and the key that
# breaks ties (sorting happens at the sink only).
MART_ORDER = {
    "mart_monthly": ("order_month", False, "order_month"),
    "mart_region": ("orders", True, "region_state"),
    "mart_product_risk": ("revenue", True, "product_category"),
    "mart_supplier_scorecard": ("risk_score", True, "supplier_id"),
}


def mart_sort_order(name: str) -> list[Column]:
    if name not in MART_ORDER:
        return []
    column, falls, key = MART_ORDER[name]
    return [F.col(column).desc() if falls else F.col(column).asc(), *([F.col(key).asc()] if key != column else [])]


# Staging view name per source role.
STAGING_VIEWS = {
    "orders": "stg_orders",
    "order_items": "stg_order_items",
    "payments": "stg_payments",
    "reviews": "stg_reviews",
    "customers": "stg_customers",
    "products": "stg_products",
    "sellers": "stg_sellers",
    "category_translation": "stg_category_translation",
}


class Pipeline:
    """Star + marts over one ``Sources``, staged once in a folder of its own until ``close()``.
    ``keep_links``: whether the scorecard will be asked for (it can be anyway, at the cost of one
    more pass over the items)."""

    def __init__(self, src: Sources, min_orders: int = scoring.MIN_ORDERS, keep_links: bool = True):
        self.src = src
        self.min_orders = min_orders
        self.spark = src.orders.sparkSession
        self.stage_root = new_stage_root(self.spark)
        with staging_scope(self.stage_root):
            self.star = star.Star(src, materialize=True, keep_links=keep_links)

    def close(self) -> None:
        """Delete every table this pipeline staged (DataFrames built from it become invalid)."""
        drop_stage_root(self.spark, self.stage_root)

    def __enter__(self) -> "Pipeline":
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    @property
    def fact(self) -> DataFrame:
        return self.star.orders

    def _stage(self, df: DataFrame) -> DataFrame:
        with staging_scope(self.stage_root):
            return stage_table(df, "shared")

    def category(self) -> DataFrame:
        return marts.mart_category_risk(self.fact, stage=self._stage)

    def scorecard(self) -> DataFrame:
        base = scoring.supplier_base(self.star.links, self.fact, self.star.lines)
        return scoring.supplier_scorecard(base, self.min_orders, share=self._stage, stage=self._stage)

    def marts(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "mart_exec_kpis": lambda: marts.kpi_exec(self.fact),
            "mart_exec_kpis_wide": lambda: marts.kpi_exec_wide(self.fact),
            "mart_monthly": lambda: marts.mart_monthly(self.fact),
            "mart_region": lambda: marts.mart_region(self.fact),
            "mart_product_risk": self.category,
            "mart_supplier_scorecard": self.scorecard,
        }

    def quality_report(self) -> DataFrame:
        return quality.expect(self.fact, quality.FACT_ORDERS_RULES)

    def register_views(self) -> list[str]:
        """Register staging roles, dimensions, facts and marts as temporary views so ad-hoc
        SQL (``spark.sql("SELECT ... FROM mart_region")``) runs against them."""
        views: dict[str, DataFrame] = {}
        for role, view in STAGING_VIEWS.items():
            df = getattr(self.src, role)
            if df is not None:
                views[view] = df
        views["dim_supplier"] = star.dim_supplier(self.src.sellers)
        views["dim_customer_region"] = star.dim_region(self.src.customers)
        views["dim_product_category"] = self.star.categories
        views["dim_date"] = star.dim_date(self.src.orders)
        views["fact_order_items"] = star.as_reference_types(self.star.items())
        views["fact_orders"] = star.as_reference_types(self.fact)
        for name, build in self.marts().items():
            views[name] = build()
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return list(views)


def run_pipeline(src: Sources, out_dir: str, fmt: str = "csv", parallelism: int = 4, only: Collection[str] | None = None) -> dict:
    """Build everything and publish it under ``out_dir`` as one set (``sources.published``); returns row
    counts, headline KPIs, the paths of the tables and the number of the manifest.

    Raises ``QualityGateError`` (before any mart is written) if a critical rule fails.  The
    marts only read the staged star, so they are written as up to ``parallelism``
    concurrent jobs.  If any of them fails, nothing is published: readers keep the former set.
    ``only`` names the tables to build, if not all are wanted."""
    with Pipeline(src, keep_links=only is None or "mart_supplier_scorecard" in only) as p:
        published = Published(p.spark, out_dir)
        before = published.current_number()
        version = published.new_version()
        tables, headline = _export(p, version, fmt, parallelism, only)
        number = published.publish(version, tables, after=before)
    return {"rows": {n: t.rows for n, t in tables.items() if n != "headline_kpis"}, "headline": headline,
            "paths": {n: t.path for n, t in tables.items()}, "manifest": number}


def _export(p: Pipeline, out: str, fmt: str, parallelism: int, only: Collection[str] | None = None) -> tuple[dict[str, Table], dict]:
    spark = p.spark
    report = quality.enforce(p.quality_report())
    # the eleven KPIs are one aggregate row: compute it once, derive tall, wide and JSON
    kpis = marts.kpi_exec_wide(p.fact)
    wide = spark.createDataFrame(kpis.collect(), kpis.schema)

    def export(name: str, build: Callable[[], DataFrame]) -> Table:
        df, path = build(), f"{out}/{name}"
        if name == "fact_orders" and fmt != "csv":  # a CSV fact keeps all columns in the files, in published order
            # a partition column comes back as the last one
            kept = df.select(*[c for c in df.columns if c != "order_month"], "order_month")
            month = star.derived_attributes()["order_month"].alias("order_month")
            rows = write_table(p.star.base.select("*", month), path, fmt, partition_by=["order_month"], cluster_by=["order_id"],
                               derive=lambda base: star.as_reference_types(star.derive_fact(base)))
            return Table(path, fmt, rows, kept.schema.json())
        order = mart_sort_order(name)
        return Table(path, fmt, write_table(df.orderBy(*order) if order else df, path, fmt), df.schema.json())

    jobs = {"dq_report": lambda: report, **p.marts()}
    jobs["mart_exec_kpis_wide"] = lambda: wide
    jobs["mart_exec_kpis"] = lambda: marts.kpis_tall(wide)
    jobs["fact_orders"] = lambda: star.as_reference_types(p.fact)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        futures = {name: submit_in_scope(pool, export, name, build) for name, build in jobs.items() if only is None or name in only}
        tables = {name: f.result() for name, f in futures.items()}
    headline = write_headline_json(wide, f"{out}/headline_kpis")
    tables["headline_kpis"] = Table(f"{out}/headline_kpis", "json", 1, wide.schema.json())
    return tables, headline
