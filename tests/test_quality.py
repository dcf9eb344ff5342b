from __future__ import annotations

import pytest

from fulcrum.operators import quality


def test_unique_rule_counts_every_duplicate_member(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "order_id int")
    rep = quality.expect(df, [quality.unique("order_id")]).first()
    assert (rep.result, rep.unexpected_pct) == ("FAIL", 66.667)
    with pytest.raises(quality.QualityGateError):
        quality.enforce(quality.expect(df, [quality.unique("order_id")]))


def test_mostly_and_nulls(spark):
    df = spark.createDataFrame([(i, None if i == 0 else i) for i in range(1000)], "order_id int, x int")
    rules = [
        quality.between("x", min_value=1, max_value=998, critical=False, mostly=0.99),  # 1 of 999 non-null out
        quality.between("x", min_value=1, max_value=998, critical=True),
        quality.not_null("x", critical=False, mostly=0.98),
        quality.in_set("x", list(range(1, 1000))),
    ]
    rep = [tuple(r) for r in quality.expect(df, rules).collect()]
    assert rep[0][3:] == ("PASS", 0.1)
    assert rep[1][3:] == ("FAIL", 0.1)
    assert rep[2][3:] == ("PASS", 0.1)
    assert rep[3][3:] == ("PASS", 0.0)
    with pytest.raises(quality.QualityGateError):
        quality.enforce(quality.expect(df, rules))


def test_warning_failure_does_not_gate(spark):
    df = spark.createDataFrame([(1, 500), (2, 3)], "order_id int, delay_days int")
    rep = quality.expect(df, [quality.between("delay_days", -120, 240, critical=False, mostly=0.999)])
    assert rep.first().result == "FAIL"
    quality.enforce(rep)


def test_summary(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "order_id int")
    rep = quality.expect(df, [quality.not_null("order_id"), quality.unique("order_id")], with_rows=True)
    s = quality.summary(rep).first()
    assert tuple(s) == (3, 2, 0, 2, 2)


def test_the_data_are_scanned_once(spark):
    from fulcrum.plans.catalog import QUERIES

    for name in ("dq_report", "dq_summary", "status_distribution", "fact_orders"):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        scans = [line for line in final.splitlines() if "FileScan parquet" in line and "/orders.parquet" in line]
        assert len(scans) == 1, name


def test_two_unique_columns(spark):
    from fulcrum.operators import quality

    df = spark.createDataFrame([(1, 1), (1, 2), (2, None), (None, 3), (None, 3)], "a int, b int")
    rows = {(r.column): r for r in quality.expect(df, (quality.unique("a"), quality.unique("b"), quality.not_null("a"))).collect()
            if r.expectation.endswith("Unique")}
    assert rows["a"].unexpected_pct == 66.667 and rows["b"].unexpected_pct == 50.0
    empty = quality.expect(df.where("false"), (quality.unique("a"),))
    assert [r.result for r in empty.collect()] == ["PASS"]


def test_several_unique_columns_take_one_scan(spark, tmp_path):
    rows = [(i % 7 if i % 5 else None, f"k{i % 11}", i, i % 3 == 0) for i in range(60)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "a int, b string, c long, d boolean").write.parquet(path)
    rules = (quality.unique("a"), quality.unique("b"), quality.unique("c"), quality.not_null("a"),
             quality.between("c", 5, 50), quality.in_set("d", [True]), quality.between("a", 1, None))
    df = quality.expect(spark.read.parquet(path), rules, with_rows=True)
    got = [(r.result, r.unexpected_pct, r.rows) for r in df.collect()]

    def pct(bad, of):
        return int(100.0 * bad / of * 1000 + 0.5) / 1000

    a = [r[0] for r in rows if r[0] is not None]
    want = [pct(sum(a.count(x) > 1 for x in a), len(a)), 100.0, 0.0, pct(60 - len(a), 60), pct(14, 60), pct(40, 60), pct(a.count(0), len(a))]
    assert [g[1] for g in got] == want and {g[2] for g in got} == {60}
    assert [g[0] for g in got] == ["FAIL", "FAIL", "PASS", "FAIL", "FAIL", "FAIL", "FAIL"]
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1
    empty = quality.expect(spark.read.parquet(path).where("false"), rules[:2])
    assert [r.result for r in empty.collect()] == ["PASS", "PASS"]


def test_distinct_counts(spark):
    from pyspark.sql import functions as F

    from fulcrum.operators.distinct import distinct_counts
    from fulcrum.plans.catalog import QUERIES

    rows = [(i % 7 if i % 5 else None, f"k{i % 11}", float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    totals = {"n": (F.count(F.lit(1)), F.sum), "lo": (F.min("c"), F.min), "hi": (F.max("c"), F.max)}
    got = distinct_counts(df, {"as": "a", "bs": "b"}, totals).collect()
    assert [tuple(r) for r in got] == [(7, 11, 60, 0.0, 59.0)]
    assert [tuple(r) for r in distinct_counts(df.where("false"), {"as": "a", "bs": "b"}, totals).collect()] == [(0, 0, 0, None, None)]
    plan = QUERIES["fact_overview"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
