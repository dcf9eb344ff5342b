"""Adapter: the driver's TPC-H-like tables -> the marketplace source roles.

The driver tables carry no promise, delivery or review fields, so these are derived by
fixed rules (stand-ins that exercise every operator; no business meaning).  The oracle SQL
in ``fulcrum.plans.oracle`` applies exactly the same rules.

    order_id, order_ts          o_orderkey, o_orderdate (also the approval time)
    order_status                F -> delivered, O -> shipped, P -> canceled
    customer_state              nation name via customer -> nation
    seller id / state / city    s_suppkey; nation name of the supplier; s_name
    product / native category   p_partkey; NULLIF(p_brand, 'Brand#25')
    translation                 Brand#1 .. Brand#20 -> category_1 .. category_20
    weight, l, h, w             p_size
    order_item_id               l_linenumber
    price                       l_extendedprice as DECIMAL(18,2)
    freight_value               price * l_tax as DECIMAL(4,2)  (exact, 4 places)
    promised date               o_orderdate + 60 days
    carrier hand-over           MIN(l_shipdate) of the order
    customer delivery           MAX(l_shipdate) over lines with l_linestatus = 'F'
    review rows                 one per line with l_returnflag = 'R', score 1 + int(l_quantity) % 5
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulcrum.sources.model import Sources

# Fixed values of the adapter rules above.
STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "canceled"}
UNCATEGORISED_BRAND = "Brand#25"
TRANSLATED_BRANDS = 20
PROMISE_DAYS = 60
REVIEW_FLAG = "R"
DELIVERED_LINE_STATUS = "F"


# The driver table columns this adapter reads (declared, so no read has to
# infer a schema from the file footers).
DRIVER_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status(code: F.Column) -> F.Column:
    expr = None
    for k, v in STATUS_BY_CODE.items():
        expr = F.when(code == k, v) if expr is None else expr.when(code == k, v)
    return expr


def from_driver_tables(spark: SparkSession, sf_dir: str) -> Sources:
    lineitem = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders")
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = _table(spark, sf_dir, "supplier")
    part = _table(spark, sf_dir, "part")

    # Delivery milestones per order: one partial+final aggregation over the line items.
    milestones = lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min("l_shipdate").alias("order_delivered_carrier_date"),
        F.max(F.when(F.col("l_linestatus") == DELIVERED_LINE_STATUS, F.col("l_shipdate"))).alias(
            "order_delivered_customer_date"
        ),
    )
    # what the role derives from an order's date and code is computed after the join, so no shuffle carries it
    orders_role = orders.join(milestones, orders.o_orderkey == milestones.order_id, "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _status(F.col("o_orderstatus")).alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_orderdate").alias("order_approved_at"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(PROMISE_DAYS))).alias("order_estimated_delivery_date"),
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
    )

    price = F.col("l_extendedprice").cast("decimal(18,2)")
    items_role = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).alias("freight_value"),
    )
    reviews_role = lineitem.where(F.col("l_returnflag") == REVIEW_FLAG).select(
        F.col("l_orderkey").alias("order_id"),
        (F.lit(1) + F.col("l_quantity").cast("int") % 5).alias("review_score"),
    )
    customers_role = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("customer_state")
    )
    sellers_role = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("n_name").alias("seller_state"),
        F.col("s_name").alias("seller_city"),
    )
    products_role = part.select(
        F.col("p_partkey").alias("product_id"),
        F.nullif(F.col("p_brand"), F.lit(UNCATEGORISED_BRAND)).alias("product_category_name"),
        *[F.col("p_size").alias(c) for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")],
    )
    translation_role = spark.range(1, TRANSLATED_BRANDS + 1).select(
        F.concat(F.lit("Brand#"), F.col("id").cast("string")).alias("product_category_name"),
        F.concat(F.lit("category_"), F.col("id").cast("string")).alias("product_category_name_english"),
    )
    return Sources(
        orders=orders_role,
        order_items=items_role,
        reviews=reviews_role,
        customers=customers_role,
        products=products_role,
        sellers=sellers_role,
        category_translation=translation_role,
    )
