"""Small builders for hand-made fixture frames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from fulcrum.sources.model import Sources

ORDERS_DDL = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
    "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
)
ITEMS_DDL = "order_id string, order_item_id int, product_id string, seller_id string, price decimal(18,2), freight_value decimal(18,2)"
REVIEWS_DDL = "order_id string, review_score int"
CUSTOMERS_DDL = "customer_id string, customer_state string"
PRODUCTS_DDL = (
    "product_id string, product_category_name string, product_weight_g int, product_length_cm int, "
    "product_height_cm int, product_width_cm int"
)
SELLERS_DDL = "seller_id string, seller_state string, seller_city string"
TRANSLATION_DDL = "product_category_name string, product_category_name_english string"


def ts(s: str | None):
    return None if s is None else dt.datetime.fromisoformat(s)


def money(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def order(oid, status="delivered", purchase="2020-01-01 10:00", delivered="2020-01-05 12:00", promised="2020-01-10 00:00",
          customer="c1", carrier="2020-01-02 09:00"):
    return (oid, customer, status, ts(purchase), ts(purchase), ts(carrier), ts(delivered), ts(promised))


def item(oid, n, product="p1", seller="s1", price=10.0, freight=1.0):
    return (oid, n, product, seller, money(price), money(freight))


def sources(spark, orders, items, reviews=(), customers=(("c1", "sp"),), products=(("p1", "cat_a", 1, 1, 1, 1),),
            sellers=(("s1", "sp", "city"),), translation=()):
    return Sources(
        orders=spark.createDataFrame(list(orders), ORDERS_DDL),
        order_items=spark.createDataFrame(list(items), ITEMS_DDL),
        reviews=spark.createDataFrame(list(reviews), REVIEWS_DDL),
        customers=spark.createDataFrame(list(customers), CUSTOMERS_DDL),
        products=spark.createDataFrame(list(products), PRODUCTS_DDL),
        sellers=spark.createDataFrame(list(sellers), SELLERS_DDL),
        category_translation=spark.createDataFrame(list(translation), TRANSLATION_DDL),
    )


def rows(df, *cols, order=None):
    sel = df.select(*cols) if cols else df
    if order:
        sel = sel.orderBy(*order)
    return [tuple(r) for r in sel.collect()]


def col_values(df, c, order=None):
    return [r[0] for r in (df.orderBy(*(order or [c])).select(c).collect())]


def lit_frame(spark, data, ddl):
    return spark.createDataFrame(list(data), ddl)


__all__ = ["F"]
