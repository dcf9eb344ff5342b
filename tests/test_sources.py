"""Raw CSV sources: the eight files round-trip into the same marts as the in-memory roles."""

from __future__ import annotations

from dataclasses import fields, replace

from pyspark.sql import functions as F

from fulcrum.plans.build import Pipeline
from fulcrum.sources.raw import read_sources_csv
from fulcrum.sources.schemas import RAW_FILES, ROLE_COLUMNS
from fulcrum.sources.testdata import from_driver_tables
from tests.conftest import SF_SMALL


def _write_csv(df, path):
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def test_csv_sources_match_in_memory_roles(spark, tmp_path):
    src = from_driver_tables(spark, SF_SMALL)
    # raw files carry 2-decimal money; apply that to the in-memory roles too
    src = replace(src, order_items=src.order_items.withColumn("freight_value", F.col("freight_value").cast("decimal(18,2)")))
    payments = src.orders.select("order_id", F.lit(1).alias("payment_sequential"), F.lit("voucher").alias("payment_type"),
                                 F.lit(1).alias("payment_installments"), F.lit("1.00").alias("payment_value"))
    raw_dir = tmp_path / "raw"
    for f in fields(src):
        df = payments if f.name == "payments" else getattr(src, f.name)
        staging = str(tmp_path / f"_{f.name}")
        _write_csv(df.select(*ROLE_COLUMNS[f.name]), staging)
        part = next(p for p in (tmp_path / f"_{f.name}").iterdir() if p.name.endswith(".csv"))
        raw_dir.mkdir(exist_ok=True)
        part.rename(raw_dir / RAW_FILES[f.name])
    csv = read_sources_csv(spark, str(raw_dir))
    assert csv.payments.count() == src.orders.count()
    assert dict(csv.orders.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"

    a, b = Pipeline(src), Pipeline(csv)
    for name in ("mart_exec_kpis", "mart_monthly", "mart_region", "mart_product_risk"):
        left = sorted(map(tuple, a.marts()[name]().collect()))
        right = sorted(map(tuple, b.marts()[name]().collect()))
        assert left == right, name
    sa = a.scorecard().withColumn("supplier_id", F.col("supplier_id").cast("string"))
    sb = b.scorecard()
    assert sorted(map(tuple, sa.collect())) == sorted(map(tuple, sb.collect()))


def test_bad_cells_become_null_and_missing_columns_fail(spark, tmp_path):
    import pytest

    from fulcrum.sources.raw import read_raw_csv

    p = tmp_path / "items.csv"
    p.write_text("order_id,order_item_id,product_id,seller_id,price,freight_value,extra\n"
                 "o1,1,p1,s1,12.5,abc,x\n"
                 "o2,?,p2,s2,,1.25,y\n")
    df = read_raw_csv(spark, str(p), "order_items")
    got = [tuple(r) for r in df.orderBy("order_id").collect()]
    assert got[0][4] is not None and float(got[0][4]) == 12.5 and got[0][5] is None
    assert got[1][1] is None and got[1][4] is None
    q = tmp_path / "sellers.csv"
    q.write_text("seller_id,seller_city\ns1,x\n")
    with pytest.raises(ValueError):
        read_raw_csv(spark, str(q), "sellers")


def test_raw_timestamp_format_and_empty_cells(spark, tmp_path):
    import datetime as dt

    from fulcrum.sources.raw import read_raw_csv

    p = tmp_path / "orders.csv"
    p.write_text(
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
        "order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-04 19:55:00,2017-10-10 21:25:13,2017-10-18 00:00:00\n"
        "o2,c2,canceled,2018-08-08 08:38:49,,,,2018-08-20 00:00:00\n"
    )
    df = read_raw_csv(spark, str(p), "orders")
    assert dict(df.dtypes)["order_delivered_customer_date"] == "timestamp_ntz"
    rows = {r.order_id: r for r in df.collect()}
    assert rows["o1"].order_delivered_customer_date == dt.datetime(2017, 10, 10, 21, 25, 13)
    assert rows["o2"].order_approved_at is None and rows["o2"].order_delivered_customer_date is None
    assert rows["o2"].order_estimated_delivery_date == dt.datetime(2018, 8, 20)


def test_all_columns_are_kept_and_money_is_not_rounded(spark, tmp_path):
    from decimal import Decimal

    from fulcrum.sources.raw import read_raw_csv

    p = tmp_path / "items.csv"
    p.write_text("order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
                 "o1,1,p1,s1,2017-01-01 00:00:00,12.345,1.005\n")
    df = read_raw_csv(spark, str(p), "order_items")
    assert df.columns == ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]
    r = df.first()
    assert (r.price, r.freight_value, r.shipping_limit_date) == (Decimal("12.345"), Decimal("1.005"), "2017-01-01 00:00:00")


def test_large_files_are_split(spark, tmp_path):
    from fulcrum.sources.raw import read_raw_csv

    p = tmp_path / "orders.csv"
    head = "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date," \
           "order_delivered_customer_date,order_estimated_delivery_date\n"
    p.write_text(head + "".join(f"o{i},c{i},delivered,2017-10-15 00:30:00,,,,2017-11-01 00:00:00\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        df = read_raw_csv(spark, str(p), "orders")
        assert df.rdd.getNumPartitions() > 1 and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_timestamps_do_not_depend_on_the_session_zone(spark, tmp_path):
    """A local time that a zone skips (start of summer time) stays as written."""
    import datetime as dt

    from fulcrum.sources.raw import read_raw_csv

    p = tmp_path / "o.csv"
    p.write_text("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
                 "order_delivered_customer_date,order_estimated_delivery_date\no1,c1,x,2017-10-15 00:30:00,,,,\n")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = read_raw_csv(spark, str(p), "orders").first().order_purchase_timestamp
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == dt.datetime(2017, 10, 15, 0, 30)


def test_reviews_convert_once(spark, tmp_path):
    from fulcrum.sources.raw import convert_reviews

    p = tmp_path / "r.csv"
    p.write_text('order_id,review_score,review_comment_message\n' + "".join(f'o{i},{i % 5 + 1},"a\nb"\n' for i in range(100)))
    df = convert_reviews(spark, str(p), str(tmp_path / "reviews"), 4)
    assert df.count() == 100 and df.rdd.getNumPartitions() > 1 and df.first().review_comment_message == "a\nb"
