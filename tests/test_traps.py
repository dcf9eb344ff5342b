"""Micro-fixtures with hand-computed answers, one per semantic trap."""

from __future__ import annotations

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fulcrum.functions.measures import flag_rate
from fulcrum.functions.numeric import round_half_up
from fulcrum.operators import order_stats, pareto, scoring, star
from fulcrum.operators.volatility import demand_volatility
from fulcrum.plans import marts
from tests.helpers import item, order, sources


FACT_DDL = (
    "order_id string, order_month string, region_state string, primary_category string, revenue decimal(18,2), "
    "freight decimal(18,2), freight_ratio double, review_score int, delay_days long, is_delivered boolean, "
    "is_canceled boolean, is_late boolean, is_bad_review boolean"
)


def _dec(rows, *idx):
    return [tuple(Decimal(str(v)) if i in idx and v is not None else v for i, v in enumerate(r)) for r in rows]


def fact_rows(spark, rows):
    return spark.createDataFrame(_dec(rows, 4, 5), FACT_DDL)


def test_a_percent_rank_nulls_last(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.2), (3, 0.2), (4, None)], "k int, v double")
    out = order_stats.percent_ranks(df, "k", {"v": F.col("v")})
    got = {r.k: r.v_pr for r in out.collect()}
    assert got == {1: 0.0, 2: 1 / 3, 3: 1 / 3, 4: 1.0}


def test_b_rate_is_double(spark):
    df = spark.createDataFrame([(True,), (False,), (False,)], "f boolean")
    out = df.agg(flag_rate(F.col("f")).alias("r"))
    assert dict(out.dtypes)["r"] == "double"
    assert out.first().r == 0.3333333333333333


def _c_fact(spark):
    rows = []
    for i, late in enumerate([True, False, False, None]):
        rows.append((f"o{i}", "2020-01", "SP", "a", 10, 1, 0.1, 5, 3 if late else -1, True, False, late, False))
    return fact_rows(spark, rows)


def test_c_three_null_rules(spark):
    fact = _c_fact(spark)
    wide = marts.kpi_exec_wide(fact).first()
    assert wide.on_time_rate == 0.5 and wide.late_rate == 0.25
    assert marts.mart_monthly(fact).first().on_time_rate == 2 / 3
    assert marts.mart_region(fact).first().late_rate == 0.25


def test_d_review_and_cancel_denominators(spark):
    rows = [
        ("o1", "2020-01", "SP", "a", 1, 0, 0.0, 1, None, False, True, None, True),
        ("o2", "2020-01", "SP", "a", 1, 0, 0.0, 5, None, True, False, None, False),
        ("o3", "2020-01", "SP", "a", 1, 0, 0.0, None, None, None, None, None, None),
    ]
    wide = marts.kpi_exec_wide(fact_rows(spark, rows)).first()
    assert wide.bad_review_rate == 0.5
    assert wide.cancel_rate == 1 / 3


def test_e_mean_of_ratios_vs_ratio_of_sums(spark):
    rows = [
        ("o1", "2020-01", "SP", "a", 2, 1, 0.5, None, None, False, False, None, None),
        ("o2", "2020-01", "SP", "a", 8, 1, 0.125, None, None, False, False, None, None),
    ]
    fact = fact_rows(spark, rows)
    assert marts.mart_region(fact).first().avg_freight_ratio == 0.3125
    assert marts.kpi_exec_wide(fact).first().freight_to_revenue == 0.2


def test_f_money_sum_is_partition_independent(spark):
    df = spark.createDataFrame([("0.10",)] * 1000, "x string").select(F.col("x").cast("decimal(18,2)").alias("x"))
    one = df.coalesce(1).agg(F.sum("x").cast("double").alias("s")).first().s
    eight = df.repartition(8).agg(F.sum("x").cast("double").alias("s")).first().s
    assert one == eight == 100.0


def test_g_cumulative_share_ties_share_a_value(spark):
    df = spark.createDataFrame([("w", 50), ("x", 20), ("y", 20), ("z", 10)], "c string, revenue long")
    out = pareto.pareto_abc(df, df.columns[0], "revenue")
    got = {r.c: (r.cum_revenue_share, r.abc_class) for r in out.collect()}
    assert got == {"w": (0.5, "A"), "x": (0.9, "B"), "y": (0.9, "B"), "z": (1.0, "C")}


def test_h_ntile_ties_broken_by_id(spark):
    df = spark.createDataFrame([(i, 0.5) for i in range(1, 8)], "id int, score double")
    out = order_stats.ntile(df, 5, "score", "id", "q")
    assert [r.q for r in out.orderBy("id").collect()] == [1, 1, 2, 2, 3, 4, 5]


def test_i_single_month_volatility_null(spark):
    counts = spark.createDataFrame([("s1", "2020-01", 7)], "supplier_id string, order_month string, n_orders long")
    assert demand_volatility(counts, "supplier_id").first().demand_volatility is None
    comp = scoring.score_components()["vol"]
    base = spark.createDataFrame([("s1", None)], "supplier_id string, demand_volatility double")
    assert base.select(comp.alias("v")).first().v == 0.0


def test_j_cv_over_active_months_only(spark):
    counts = spark.createDataFrame(
        [("s1", "2020-01", 2), ("s1", "2020-03", 4)], "supplier_id string, order_month string, n_orders long"
    )
    v = demand_volatility(counts, "supplier_id").first().demand_volatility
    assert math.isclose(v, math.sqrt(2) / 3, rel_tol=0, abs_tol=1e-12)


def test_k_category_vs_supplier_revenue_grain(spark):
    src = sources(
        spark,
        [order("o1")],
        [item("o1", 1, "pa", "s1", 60.0, 0.0), item("o1", 2, "pb", "s2", 40.0, 0.0)],
        products=[("pa", "a", 1, 1, 1, 1), ("pb", "b", 1, 1, 1, 1)],
    )
    st = star.Star(src)
    cats = {r.product_category: r.revenue for r in marts.mart_category_risk(st.orders).collect()}
    assert cats == {"a": 100.0}
    sup = {r.supplier_id: float(r.revenue) for r in scoring.supplier_base(st.pairs, st.orders).collect()}
    assert sup == {"s1": 60.0, "s2": 40.0}


def test_l_round_half_up_on_binary_value(spark):
    df = spark.createDataFrame([(12.35, 1.005)], "a double, b double")
    r = df.select(round_half_up(F.col("a"), 1).alias("a"), round_half_up(F.col("b"), 2).alias("b")).first()
    assert r.a == 12.4 and r.b == 1.0


def test_m_zero_revenue_gives_nulls_not_errors(spark):
    src = sources(spark, [order("o1"), order("o2")], [item("o1", 1, price=0.0, freight=1.0), item("o2", 1, price=0.0)])
    st = star.Star(src)
    assert [r.freight_ratio for r in st.orders.collect()] == [None, None]
    cat = marts.mart_category_risk(st.orders).first()
    assert cat.revenue_share is None and cat.cum_revenue_share is None
    assert marts.kpi_exec_wide(st.orders).first().freight_to_revenue is None


def test_n_o_dim_date_dense_and_typed(spark):
    src = sources(spark, [order("o1", purchase="2020-01-30 08:00"), order("o2", purchase="2020-02-02 23:59")], [])
    d = star.dim_date(src.orders)
    assert dict(d.dtypes)["date_key"] == "date"
    got = [(str(r.date_key), r.year_month, r.day_name) for r in d.orderBy("date_key").collect()]
    assert got == [
        ("2020-01-30", "2020-01", "Thursday"),
        ("2020-01-31", "2020-01", "Friday"),
        ("2020-02-01", "2020-02", "Saturday"),
        ("2020-02-02", "2020-02", "Sunday"),
    ]
    wed = sources(spark, [order("o1", purchase="2020-01-01 00:00")], [])
    assert star.dim_date(wed.orders).first().day_name == "Wednesday"


def test_p_primary_line_tie_goes_to_lower_item(spark):
    src = sources(
        spark,
        [order("o1")],
        [item("o1", 2, "pb", "s2", 50.0), item("o1", 1, "pa", "s1", 50.0)],
        products=[("pa", "a", 1, 1, 1, 1), ("pb", "b", 1, 1, 1, 1)],
    )
    st = star.Star(src)
    r = st.orders.first()
    assert (r.primary_supplier_id, r.primary_category) == ("s1", "a")


def test_q_single_supplier_and_single_category(spark):
    base = _base(spark, [("s1", 30, 100, 10, 0.1, 0.2, 0.3, 0.4, 0.5)])
    card = scoring.supplier_scorecard(base).first()
    assert (card.risk_score, card.risk_quintile, card.revenue_share) == (0.0, 1, 1.0)
    cat = pareto.pareto_abc(spark.createDataFrame([("a", 5)], "c string, revenue long"), "c", "revenue").first()
    assert (cat.cum_revenue_share, cat.abc_class) == (1.0, "C")


def test_r_csv_quoted_multiline(spark, tmp_path):
    from fulcrum.sources.raw import read_raw_csv

    p = tmp_path / "reviews.csv"
    p.write_text('order_id,review_score,review_comment_message\n"o1",4,"first line\nsecond ""quoted"" line"\n')
    df = read_raw_csv(spark, str(p), "reviews")
    assert [tuple(r) for r in df.collect()] == [("o1", 4, 'first line\nsecond "quoted" line')]


def _base(spark, rows):
    return spark.createDataFrame(
        _dec(rows, 2, 3),
        "supplier_id string, orders long, revenue decimal(18,2), freight decimal(18,2), freight_burden double, "
        "late_rate double, cancel_rate double, bad_review_rate double, demand_volatility double",
    )


def test_s_share_of_scored_population(spark):
    base = _base(spark, [("s1", 20, 30, 1, 0.1, 0.1, 0.1, 0.1, 0.1), ("s2", 19, 70, 1, 0.1, 0.1, 0.1, 0.1, 0.1)])
    out = scoring.supplier_scorecard(base).collect()
    assert [(r.supplier_id, r.revenue_share) for r in out] == [("s1", 1.0)]


def test_t_unscored_outlier_does_not_move_ranks(spark):
    rows = [(f"s{i}", 25, 10 + i, 1, 0.01 * i, 0.02 * (i % 3), 0.03 * (i % 2), 0.1, None if i == 2 else 0.2 * i) for i in range(6)]
    a = scoring.supplier_scorecard(_base(spark, rows))
    b = scoring.supplier_scorecard(_base(spark, rows + [("outlier", 3, 10**6, 1, 9.0, 1.0, 1.0, 1.0, 9.0)]))
    cols = ["supplier_id", "risk_score", "risk_quintile"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_u_day_precision_lateness(spark):
    src = sources(
        spark,
        [order("o1", delivered="2020-01-05 23:00", promised="2020-01-05 00:00")],
        [item("o1", 1)],
    )
    r = star.Star(src).orders.first()
    assert (r.delay_days, r.is_late) == (0, False)


def test_orders_without_priced_lines_are_dropped(spark):
    src = sources(
        spark,
        [order("o1"), order("o2"), order("o3")],
        [item("o1", 1, price=10.0), item("o2", 1, price=None, freight=None)],
    )
    assert sorted(r.order_id for r in star.Star(src).orders.collect()) == ["o1"]


def test_labels_round_the_binary_value_half_even(spark):
    from fulcrum.functions.numeric import format_fixed

    vals = [94.25, 94.35, 0.155, 0.165, 2.675, 0.125, 1234567.5, 1234568.5, 0.0, 12.0, 1e-9]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(format_fixed(F.col("x"), 1)).collect()]
    assert got == [f"{v:.1f}" for v in vals]
    got2 = [r[0] for r in df.select(format_fixed(F.col("x"), 2)).collect()]
    assert got2 == [f"{v:.2f}" for v in vals]
    got0 = [r[0] for r in df.select(format_fixed(F.col("x"), 0, thousands=True)).collect()]
    assert got0 == [f"{v:,.0f}" for v in vals]


def test_binary_rounding_matches_python_on_random_doubles(spark):
    import random

    from fulcrum.functions.numeric import format_fixed

    rng = random.Random(3)
    vals = [rng.uniform(0, 10 ** rng.randrange(0, 9)) for _ in range(2000)]
    vals += [k / 8 for k in range(400)] + [k / 1000 + 0.0005 for k in range(400)]  # exact and near ties
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for d in (0, 1, 2, 3):
        got = [r[0] for r in df.select(format_fixed(F.col("x"), d)).collect()]
        assert got == [f"{v:.{d}f}" for v in vals], d
