"""Queries over what has been written: published tables read back, raw files written from the given
tables and read by the raw readers, marts in their published order, views.

Folders are staged and go when the driver's Python ends.
"""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulcrum.operators import quality
from fulcrum.plans.build import MART_ORDER, Pipeline, run_pipeline
from fulcrum.plans.insights import SUMMARY_ORDER, positioned
from fulcrum.sources.checked import read_checked
from fulcrum.sources.published import Published
from fulcrum.sources.raw import read_raw_csv
from fulcrum.sources.schemas import RAW_FILES
from fulcrum.sources.tables import drop_stage_root_quietly, new_stage_root
from fulcrum.sources.testdata import from_driver_tables


def _folder(spark: SparkSession) -> str:
    root = new_stage_root(spark)
    atexit.register(drop_stage_root_quietly, spark, root)
    return root


def _published(spark: SparkSession, sf_dir: str, table: str, fmt: str) -> DataFrame:
    out = _folder(spark)
    run_pipeline(from_driver_tables(spark, sf_dir), out, fmt=fmt, only=(table,))
    return Published(spark, out).read(table)


def exported_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact, exported as partitioned Parquet and read back."""
    return _published(spark, sf_dir, "fact_orders", "parquet")


def exported_fact_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report on the exported fact."""
    return quality.expect(exported_fact(spark, sf_dir), quality.FACT_ORDERS_RULES)


def exported_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier scorecard, exported as CSV and read back with its types."""
    return _published(spark, sf_dir, "mart_supplier_scorecard", "csv")


def headline_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headline KPIs from their JSON document."""
    out = _folder(spark)
    run_pipeline(from_driver_tables(spark, sf_dir), out, only=())
    return Published(spark, out).read("headline_kpis")


def exported_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table of a whole published set: counted while written, and as read back."""
    out = _folder(spark)
    run_pipeline(from_driver_tables(spark, sf_dir), out, fmt="parquet")
    published = Published(spark, out)
    found = None
    for name, table in published.manifest()["tables"].items():
        one = published.read(name).agg(F.lit(name).alias("name"), F.lit(table.rows).cast("long").alias("written"), F.count(F.lit(1)).alias("rows"))
        found = one if found is None else found.unionByName(one)
    return found


def view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL over the named views of a build: scored suppliers and their worst score per state."""
    p = Pipeline(from_driver_tables(spark, sf_dir))
    atexit.register(drop_stage_root_quietly, spark, p.stage_root)
    p.register_views()
    return spark.sql("""
        SELECT s.supplier_state, count(*) AS scored, max(m.risk_score) AS worst_score, sum(m.orders) AS orders
        FROM mart_supplier_scorecard m JOIN dim_supplier s USING (supplier_id) GROUP BY s.supplier_state""")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` written as a review file with multi-line texts and read by its splits."""
    path = f"{_folder(spark)}/{RAW_FILES['reviews']}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    (docs.select(F.col("doc_id").cast("string").alias("order_id"), (F.col("n_chars") % 5 + 1).alias("review_score"),
                 F.col("text").alias("review_comment_message"))
     .write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    text = F.col("review_comment_message")
    return read_raw_csv(spark, path, "reviews").select(
        "order_id", "review_score", F.length(text).cast("long").alias("n_chars"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).cast("long").alias("line_breaks"), F.md5(text).alias("digest"))


def raw_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` written as an item file in which every 13th order's prices have a decimal comma, the
    fifth lines a spelled number and every 11th order's last field is missing: per column the
    cells that the quarantine counted and kept, and the rows and money that could be typed."""
    path = f"{_folder(spark)}/{RAW_FILES['order_items']}"
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order, price = F.col("l_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    fields = [order.cast("string"), F.when(F.col("l_linenumber") == 5, F.lit("five")).otherwise(F.col("l_linenumber").cast("string")),
              F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
              F.when(order % 13 == 0, F.concat(F.lit('"'), F.replace(price, F.lit("."), F.lit(",")), F.lit('"'))).otherwise(price)]
    line = F.concat_ws(",", *fields, F.when(order % 11 != 0, F.lit("1.50")))
    header = "order_id,order_item_id,product_id,seller_id,price,freight_value"
    # each part is a file of its own with a header line
    parts = items.select(line.alias("value"), F.spark_partition_id().alias("_p"))
    (parts.unionByName(parts.select("_p").distinct().select(F.lit(header).alias("value"), "_p"))
     .repartition("_p").sortWithinPartitions("_p", F.col("value") != header).select("value", "_p")
     .write.partitionBy("_p").text(path))
    checked = read_checked(spark, f"{path}/*", "order_items")
    counted = spark.createDataFrame([(c, n) for c, n in checked.counts.items()], "column string, counted long")
    kept = checked.rejects.groupBy(F.col("column").alias("_c")).agg(F.count(F.lit(1)).alias("kept"))
    typed = checked.rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("price").cast("decimal(38,2)").cast("double").alias("money"))
    return counted.join(kept, F.col("column") == F.col("_c"), "left").crossJoin(typed).select(
        "column", "counted", F.coalesce("kept", F.lit(0)).alias("kept"), "rows", "money")


def _ordered(query, column: str, falls: bool, key: str):
    return lambda spark, sf_dir: positioned(query(spark, sf_dir), column, falls, key)


#: Published order of a catalogue query: (column, whether it falls, tie-breaking key).
ORDERED = {
    "mart_monthly": MART_ORDER["mart_monthly"], "mart_region": MART_ORDER["mart_region"],
    "mart_category_risk": MART_ORDER["mart_product_risk"], "supplier_scorecard": MART_ORDER["mart_supplier_scorecard"],
    **{name: (column, way is F.desc, {"status_distribution": "order_status"}.get(name, column)) for name, (way, column) in SUMMARY_ORDER.items()},
}


def ordered_queries(catalog: dict) -> dict:
    return {f"ordered_{name}": _ordered(catalog[name], *order) for name, order in ORDERED.items()}


QUERIES = {
    "exported_fact": exported_fact,
    "exported_fact_checked": exported_fact_checked,
    "exported_scorecard": exported_scorecard,
    "exported_counts": exported_counts,
    "headline_document": headline_document,
    "view_sql": view_sql,
    "raw_reviews": raw_reviews,
    "raw_rejects": raw_rejects,
}
