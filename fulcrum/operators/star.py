"""Star schema: dimensions, the item-grain fact and the order-grain fact (C1).

Plan shape (what Catalyst gets to see):

* ``order_rollup`` aggregates the items to orders in one shuffle: sums, line count and the key of
  the most expensive line (a ``min`` over an ordering struct instead of a row_number window).  It
  reduces map-side, so an order holding a third of all lines is collapsed before the shuffle.
* What is distinct per (order, supplier) travels as bare keys (``order_suppliers``): the number of an
  order's suppliers is counted from them, and the supplier scorecard joins them.  Money never goes
  through that level: a supplier's is summed from its items (``supplier_lines``).
* The product category is attached after the roll-up, at order grain (one row per order
  instead of one per item).  The order side (status, customer region, dates, review,
  flags) never touches items, so it is built independently and joined to the roll-up once
  on order id.
* Columns that follow from others of the same row (month, day differences, flags, freight ratio) are
  computed after the joins, so no shuffle carries them; a staged fact holds its base columns
  (``fact_base``), and its readers derive the rest (``derive_fact``).
* Money is carried as DECIMAL (exact sums); ``as_reference_types`` renders the double
  columns of the published schemas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulcrum.functions.numeric import ratio
from fulcrum.sources.model import Sources
from fulcrum.sources.tables import stage_table

DAY_NAME_PATTERN = "EEEE"  # full English day name, e.g. Wednesday
MONTH_PATTERN = "yyyy-MM"


# --------------------------------------------------------------------------- dimensions
def dim_supplier(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        F.col("seller_id").alias("supplier_id"),
        F.upper(F.trim("seller_state")).alias("supplier_state"),
        F.lower(F.trim("seller_city")).alias("supplier_city"),
    )


def dim_region(customers: DataFrame) -> DataFrame:
    return (
        customers.where(F.col("customer_state").isNotNull())
        .select(F.upper(F.trim("customer_state")).alias("region_state"))
        .distinct()
    )


def dim_category(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Product -> category label: English name, else native name, else 'unknown'."""
    t = translation.select(
        F.col("product_category_name").alias("_native"),
        F.col("product_category_name_english").alias("_english"),
    )
    return products.join(t, products.product_category_name == t._native, "left").select(
        "product_id",
        F.coalesce(F.col("_english"), F.col("product_category_name"), F.lit("unknown")).alias("product_category"),
        "product_weight_g",
        (F.col("product_length_cm").cast("long") * F.col("product_height_cm") * F.col("product_width_cm")).alias("product_volume_cm3"),
    )


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per calendar day between the first and last purchase date (dense).

    The day span is bounded by the calendar, not by the data volume; the bounds are one
    global aggregate and the series is generated from that single row.
    """
    day = F.col("order_purchase_timestamp").cast("date")
    bounds = orders.agg(F.min(day).alias("d0"), F.max(day).alias("d1"))
    d = F.col("date_key")
    return bounds.select(F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias("date_key")).select(
        d,
        F.year(d).cast("long").alias("year"),
        F.quarter(d).cast("long").alias("quarter"),
        F.month(d).cast("long").alias("month"),
        F.date_format(d, MONTH_PATTERN).alias("year_month"),
        F.date_format(d, DAY_NAME_PATTERN).alias("day_name"),
    )


# ----------------------------------------------------------------------------- item fact
def fact_order_items(order_items: DataFrame, categories: DataFrame) -> DataFrame:
    """Item grain: (order_id, order_item_id, product_id, supplier_id, item_revenue,
    item_freight, product_category) with money as DECIMAL."""
    c = categories.select("product_id", "product_category")
    return order_items.join(c, "product_id", "left").select(
        "order_id",
        "order_item_id",
        "product_id",
        F.col("seller_id").alias("supplier_id"),
        F.col("price").alias("item_revenue"),
        F.col("freight_value").alias("item_freight"),
        "product_category",
    )


def _primary_line_key() -> F.Column:
    """Ordering struct for the primary line: price DESC NULLS LAST, then item id, supplier
    and product ascending NULLS LAST; ``min`` of it is the first line of that order."""
    rev, item, sup, prod = (F.col(c) for c in ("price", "order_item_id", "seller_id", "product_id"))
    return F.struct(
        rev.isNull().alias("k0"), (-rev).alias("k1"),
        item.isNull().alias("k2"), item.alias("k3"),
        sup.isNull().alias("k4"), sup.alias("supplier_id"),
        prod.isNull().alias("k6"), prod.alias("product_id"),
    )


def order_supplier_rollup(order_items: DataFrame) -> DataFrame:
    """(order_id, supplier_id) grain: revenue, freight (DECIMAL), line count."""
    return order_items.groupBy("order_id", F.col("seller_id").alias("supplier_id")).agg(
        F.sum("price").alias("revenue"),
        F.sum("freight_value").alias("freight"),
        F.count(F.lit(1)).alias("n_items"),
    )


def order_suppliers(order_items: DataFrame) -> DataFrame:
    """The distinct (order_id, supplier_id)."""
    return order_items.select("order_id", F.col("seller_id").alias("supplier_id")).distinct()


def supplier_lines(order_items: DataFrame) -> DataFrame:
    """Money (DECIMAL) of every item with its supplier."""
    return order_items.select(
        F.col("seller_id").alias("supplier_id"), F.col("price").alias("revenue"), F.col("freight_value").alias("freight"))


def order_rollup(order_items: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Order grain: revenue, freight, n_items, n_suppliers (distinct suppliers; a NULL supplier is not
    counted), and the supplier and product of the most expensive line.  ``links`` are the items'
    ``order_suppliers``, if they are at hand."""
    links = order_suppliers(order_items) if links is None else links
    value = order_items.groupBy("order_id").agg(
        F.sum("price").alias("revenue"),
        F.sum("freight_value").alias("freight"),
        F.count(F.lit(1)).alias("n_items"),
        F.min(_primary_line_key()).alias("_best"),
    )
    known = F.col("order_id").isNotNull()
    counts = links.where(known).groupBy(F.col("order_id").alias("_oid")).agg(F.count("supplier_id").alias("_n"))
    # items without an order are one group of the roll-up, which no equality finds
    unplaced = links.where(~known).agg(F.count("supplier_id")).scalar()
    return value.join(counts, F.col("order_id") == F.col("_oid"), "left").select(
        "order_id", "revenue", "freight", "n_items", F.when(known, F.col("_n")).otherwise(unplaced).alias("n_suppliers"),
        F.col("_best.supplier_id").alias("primary_supplier_id"),
        F.col("_best.product_id").alias("primary_product_id"),
    )


def order_value(order_items: DataFrame) -> DataFrame:
    return order_rollup(order_items).select("order_id", "revenue", "freight", "n_items", "n_suppliers")


def order_primary(order_items: DataFrame, categories: DataFrame) -> DataFrame:
    """(order_id, primary_supplier_id, primary_category)."""
    return _with_primary_category(order_rollup(order_items), categories).select(
        "order_id", "primary_supplier_id", "primary_category")


def _with_primary_category(orders: DataFrame, categories: DataFrame) -> DataFrame:
    cats = categories.select(F.col("product_id").alias("primary_product_id"), F.col("product_category").alias("primary_category"))
    return orders.join(cats, "primary_product_id", "left")


def order_review(reviews: DataFrame) -> DataFrame:
    """Worst (minimum) review score per order."""
    return (
        reviews.where(F.col("review_score").isNotNull())
        .groupBy("order_id")
        .agg(F.min(F.col("review_score").cast("int")).alias("review_score"))
    )


# ---------------------------------------------------------------------------- order fact
# The published columns of the order fact, and their types in an export.
FACT_ORDERS_COLUMNS = [
    "order_id", "order_status", "region_state", "primary_supplier_id", "primary_category",
    "order_ts", "order_month", "promised_date", "delivered_date", "revenue", "freight",
    "n_items", "n_suppliers", "freight_ratio", "review_score", "delay_days", "handling_days",
    "transit_days", "is_delivered", "is_canceled", "is_late", "is_bad_review",
]
FACT_ORDERS_DDL = (
    "order_id string, order_status string, region_state string, primary_supplier_id string, primary_category string, "
    "order_ts timestamp_ntz, order_month string, promised_date date, delivered_date date, revenue double, freight double, "
    "n_items bigint, n_suppliers bigint, freight_ratio double, review_score int, delay_days bigint, handling_days bigint, "
    "transit_days bigint, is_delivered boolean, is_canceled boolean, is_late boolean, is_bad_review boolean"
)


def order_side(src: Sources) -> DataFrame:
    """What the order-side part of the fact (no item data) is derived from: status, customer region,
    purchase timestamp, the days of the milestones and the review score."""
    day = lambda c: F.col(c).cast("date")
    cust = src.customers.select("customer_id", F.upper(F.trim("customer_state")).alias("region_state"))
    orders = src.orders.select(
        "order_id",
        "customer_id",
        "order_status",
        F.col("order_purchase_timestamp").cast("timestamp_ntz").alias("order_ts"),
        day("order_estimated_delivery_date").alias("promised_date"),
        day("order_delivered_customer_date").alias("delivered_date"),
        day("order_approved_at").alias("approved_date"),
        day("order_delivered_carrier_date").alias("carrier_date"),
    )
    joined = orders.join(order_review(src.reviews), "order_id", "left").join(cust, "customer_id", "left")
    return joined.select("order_id", "order_status", "region_state", *orders.columns[3:], "review_score")


def derived_attributes() -> dict[str, F.Column]:
    """The order month, the day differences, the four flags and the freight ratio, from the columns of
    ``fact_base``."""
    promised, delivered, approved, carrier = (F.col(f"{c}_date") for c in ("promised", "delivered", "approved", "carrier"))
    status = F.col("order_status")
    return {
        "order_month": F.date_format(F.col("order_ts").cast("date"), MONTH_PATTERN),
        "delay_days": F.datediff(delivered, promised).cast("long"),
        "handling_days": F.datediff(carrier, approved).cast("long"),
        "transit_days": F.datediff(delivered, carrier).cast("long"),
        "is_delivered": (status == "delivered") & delivered.isNotNull(),
        "is_canceled": status == "canceled",
        "is_late": delivered > promised,
        "is_bad_review": F.col("review_score") <= 2,
        "freight_ratio": F.when(F.col("revenue") > 0, ratio(F.col("freight"), F.col("revenue"))),
    }


def fact_base(attributes: DataFrame, value: DataFrame, categories: DataFrame) -> DataFrame:
    """What the order fact is derived from: ``order_side`` x ``order_rollup`` + the primary line's
    category.  Orders whose revenue is NULL — no line item, or no priced line — are dropped (the
    filter runs on the roll-up side, before the joins)."""
    joined = _with_primary_category(attributes.join(value.where(F.col("revenue").isNotNull()), "order_id", "inner"), categories)
    return joined.drop("primary_product_id")


def derive_fact(base: DataFrame) -> DataFrame:
    """Order fact = ``fact_base`` with the derived columns."""
    derived = derived_attributes()
    return base.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in FACT_ORDERS_COLUMNS])


def as_reference_types(df: DataFrame) -> DataFrame:
    """Render DECIMAL money columns as DOUBLE (the published fact/mart schemas)."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema.fields]
    )


class Star:
    """Star schema over one ``Sources``.

    ``materialize=False`` keeps everything lazy (one plan per consumer, Catalyst fuses it
    with the mart on top).  ``materialize=True`` stages the base of the order fact as Parquet, and
    before it the distinct (order, supplier) if they are read again (``keep_links``: the scorecard
    does) — the way the facts are materialised once before the marts are computed; every consumer
    then starts from a scan instead of re-planning (and possibly re-running) the item roll-up.
    What one job alone reads is not staged.
    """

    def __init__(self, src: Sources, materialize: bool = False, keep_links: bool = True):
        self.src = src
        self.categories = dim_category(src.products, src.category_translation)
        links = order_suppliers(src.order_items)
        if materialize and keep_links:
            links = stage_table(links, "order_supplier")
        self.links = links
        self.lines = supplier_lines(src.order_items)
        base = fact_base(order_side(src), order_rollup(src.order_items, links), self.categories)
        if materialize:
            base = stage_table(base, "fact_orders")
        self.base = base
        self.orders = derive_fact(base)

    @property
    def pairs(self) -> DataFrame:
        return order_supplier_rollup(self.src.order_items)

    def items(self) -> DataFrame:
        return fact_order_items(self.src.order_items, self.categories)
