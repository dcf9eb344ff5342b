"""The splittable multi-line reader against Spark's one-task reader, and the quarantine of bad cells."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fulcrum.operators import quality
from fulcrum.sources import checked, multiline, raw


@pytest.fixture()
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def one_task(spark, path):
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def written(rng, n, end):
    parts = ["good", "bad, worse", 'say ""hi""', "é名", end, end + end, '""', " ", ",", "x" * 60]
    lines = ["order_id,review_score,message,more"]
    for i in range(n):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        lines.append(rng.choice([f'o{i},{i % 5 + 1},"{text}",z', f"o{i},{i % 5 + 1},plain,", f'"o{i}","{i % 5}","{text}",""', "", f"o{i},,,"]))
    return end.join(lines) + rng.choice(["", end])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equal_to_the_one_task_reader(spark, tmp_path, small_splits, end):
    rng = random.Random(len(end))
    folder = tmp_path / "r"
    folder.mkdir()
    for i in range(4):
        (folder / f"f{i}.csv").write_bytes(written(rng, 60 * i + 1, end).encode())
    got = multiline.read_multiline_csv(spark, str(folder))
    want = one_task(spark, str(folder))
    assert got.columns == want.columns and rows(got) == rows(want)
    states = multiline.split_states(spark, str(folder))
    assert states.count() > 15 and states.where("inside").count() > 1
    assert multiline.unpaired(states).count() == 0


def test_a_record_longer_than_its_splits(spark, tmp_path, small_splits):
    path = tmp_path / "long.csv"
    text = "line of text\n" * 900  # spans many splits
    path.write_text(f'a,b\n1,"{text}"\n2,"x"\n3,"{text}{text}"\n4,y\n')
    got = multiline.read_multiline_csv(spark, str(path))
    assert rows(got) == rows(one_task(spark, str(path))) and len(rows(got)) == 4


def test_nothing_but_a_header_and_unpaired_quotes(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("a,b\n")
    got = multiline.read_multiline_csv(spark, str(path))
    assert got.columns == ["a", "b"] and got.count() == 0
    path = tmp_path / "u.csv"
    path.write_text('a,b\n1,"open\n2,x\n')
    assert multiline.unpaired(multiline.split_states(spark, str(path))).count() == 1


def test_reviews_are_read_by_several_tasks(spark, tmp_path, small_splits):
    path = tmp_path / "reviews.csv"
    path.write_text('order_id,review_score,review_comment_message\n' + "".join(f'o{i},{i % 5 + 1},"a\nb, c"\n' for i in range(300)))
    df = raw.read_raw_csv(spark, str(path), "reviews")
    assert df.count() == 300 and df.agg(F.sum("review_score")).first()[0] == sum(i % 5 + 1 for i in range(300))
    assert {r.review_comment_message for r in df.select("review_comment_message").distinct().collect()} == {"a\nb, c"}
    states = multiline.split_states(spark, str(path))
    assert states.count() > 5


ITEMS = """order_id,order_item_id,product_id,seller_id,price,freight_value,extra
o1,1,p1,s1,12.5,abc,x
o2,?,p2,s2,,1.25,y
o3,3,p3,s3,1e3,  ,z
o4,4,p4,s4,"1,5",2.5,z
o5,5,p5
o6,6,p6,s6,1.0,2.0,z,too,many
o7, 7 ,p7,s7, 3.25 ,0,z
"""


def test_quarantine(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(ITEMS)
    got = checked.read_checked(spark, str(path), "order_items")
    assert got.n_rows == 7
    assert got.counts == {"order_item_id": 1, "price": 1, "freight_value": 1, checked.RECORD: 2}
    cells = {(r.column, r.value) for r in got.rejects.collect()}
    assert {("freight_value", "abc"), ("order_item_id", "?"), ("price", "1,5")} <= cells and len(cells) == 5
    whole = {r.column: r.record for r in got.rejects.where("value = 'abc'").collect()}
    assert whole == {"freight_value": "o1,1,p1,s1,12.5,abc,x"}
    assert {r.value for r in got.rejects.where(F.col("column") == checked.RECORD).collect()} == {"o5,5,p5", "o6,6,p6,s6,1.0,2.0,z,too,many"}
    # the typed rows are those of the plain reader
    assert rows(got.rows) == rows(raw.read_raw_csv(spark, str(path), "order_items"))
    report = got.report()
    assert {r.column: r.result for r in report.collect()} == {f"order_items.{c}": "FAIL" for c in got.counts}
    with pytest.raises(quality.QualityGateError):
        quality.enforce(report)
    lenient = {r.column: (r.result, r.unexpected_pct) for r in got.report(mostly=0.8).collect()}
    assert lenient["order_items.price"] == ("PASS", 14.286) and lenient[f"order_items.{checked.RECORD}"][0] == "FAIL"


def test_quarantine_of_reviews_and_clean_files(spark, tmp_path, small_splits):
    path = tmp_path / "reviews.csv"
    path.write_text("order_id,review_score,text\n" + "".join(f'o{i},{"five" if i % 50 == 7 else i % 5},"a\nb"\n' for i in range(200)) + "o,1\n")
    got = checked.read_checked(spark, str(path), "reviews")
    assert got.n_rows == 201 and got.counts == {"review_score": 4, checked.RECORD: 1}
    assert {r.value for r in got.rejects.collect()} == {"five", "o,1"}
    empty = tmp_path / "sellers.csv"
    empty.write_text("seller_id,seller_state,seller_city\n")
    clean = checked.read_checked(spark, str(empty), "sellers")
    assert (clean.n_rows, clean.counts, clean.rejects.count()) == (0, {checked.RECORD: 0}, 0)
    quality.enforce(clean.report())


def test_one_pass(spark, tmp_path):
    """Rows, rejects and counts come out of one staged write."""
    path = tmp_path / "items.csv"
    path.write_text(ITEMS)
    writes = []

    def stage(df):
        from fulcrum.sources.tables import stage_until_exit

        writes.append(df._jdf.queryExecution().executedPlan().toString().count("FileScan csv"))
        return stage_until_exit(df)

    got = checked.read_checked(spark, str(path), "order_items", stage)
    assert writes == [1]
    for df in (got.rows, got.rejects):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "csv" not in plan.lower().split("filescan parquet")[0]
