"""Property tests: the distributed order statistics equal the single-window forms, which are
written here with Spark's own window functions."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from fulcrum.operators import order_stats, pareto
from fulcrum.sources.tables import drop_stage_root, new_stage_root, stage_until_exit, staging_scope

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

values = st.lists(
    st.one_of(st.none(), st.integers(-3, 6).map(lambda x: x / 4), st.sampled_from([-0.0, 1e300, -1e-300, 5e-324])),
    min_size=1, max_size=60)


def _frame(spark, vals):
    return spark.createDataFrame(
        [(i * 7 % 1009, v, None if v is None else v * 3 % 1.5) for i, v in enumerate(vals)], "k int, a double, b double")


def _rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()))


@SETTINGS
@given(vals=values)
def test_percent_ranks_match_window(spark, vals):
    df = _frame(spark, vals)
    w = df.select("k", *[F.percent_rank().over(Window.orderBy(F.col(c).asc_nulls_last())).alias(c + "_pr") for c in "ab"])
    d = order_stats.percent_ranks(df, "k", {"a": F.col("a"), "b": F.col("b")})
    assert _rows(w, "k", "a_pr", "b_pr") == _rows(d, "k", "a_pr", "b_pr")


@SETTINGS
@given(vals=values, buckets=st.integers(1, 9), down=st.booleans())
def test_ntile_and_row_number_match_window(spark, vals, buckets, down):
    df = _frame(spark, vals)
    a = F.col("a").desc_nulls_last() if down else F.col("a").asc_nulls_last()
    w = Window.orderBy(a, "k")
    want = df.select("k", F.row_number().over(w).cast("long").alias("rn"), F.count("*").over(Window.partitionBy()).alias("n"))
    got = order_stats.row_numbers(df, "a", "k", "rn", descending=down, count="n")
    assert _rows(want, "k", "rn", "n") == _rows(got, "k", "rn", "n")
    if not down:
        want = df.select("k", F.ntile(buckets).over(w).cast("long").alias("q"))
        assert _rows(want, "k", "q") == _rows(order_stats.ntile(df, buckets, "a", "k", "q"), "k", "q")


@SETTINGS
@given(revs=st.lists(st.integers(0, 5), min_size=1, max_size=40))
def test_pareto_matches_window(spark, revs):
    df = spark.createDataFrame([(f"category {i:03d}", r) for i, r in enumerate(revs)], "c string, revenue long")
    whole = F.sum("revenue").over(Window.partitionBy())
    cum = F.sum("revenue").over(Window.orderBy(F.desc("revenue")))
    want = df.select("c", (F.try_divide(cum.cast("double"), whole.cast("double"))).alias("cum_revenue_share"))
    got = pareto.pareto_abc(df, "c", "revenue")
    assert _rows(want, "c", "cum_revenue_share") == _rows(got, "c", "cum_revenue_share")


@pytest.mark.parametrize("kind, vals", [
    ("bigint", [-(1 << 62), -5, 0, 7, (1 << 62)]), ("string", ["", "a", "ab", "b", "prefix_1", "prefix_10", "é"]),
    ("double", [float("-inf"), -2.0, -1e-300, 0.0, 1e-300, 2.0, float("inf"), float("nan")]),
])
def test_row_numbers_keep_the_order(spark, kind, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)] + [(len(vals), None)], f"i int, v {kind}")
    numbered = order_stats.row_numbers(df, "v", "i", "rn")
    assert [r.rn for r in numbered.orderBy("i").collect()] == list(range(1, len(vals) + 2))


class Staged:
    """A ``stage`` that keeps what it wrote, over as many blocks as there are shuffle partitions."""

    def __init__(self, spark):
        self.spark, self.tables = spark, []

    def __enter__(self):
        self.spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        return self

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    def __call__(self, df):
        self.tables.append(stage_until_exit(df))
        return self.tables[-1]

    def sizes(self):
        return [r.n for r in self.tables[-1].groupBy("_block").agg(F.count("*").alias("n")).collect()]


def test_a_value_that_most_rows_share(spark):
    """90 % of the entities share each component's value: results whole, and no block holds more than its share."""
    rows = [(i, 0.5 if i % 10 else float(i), 0.0 if i % 10 else (None if i % 20 else float(-i))) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k int, a double, b double")
    w = df.select("k", *[F.percent_rank().over(Window.orderBy(F.col(c).asc_nulls_last())).alias(c + "_pr") for c in "ab"])
    with Staged(spark) as stage:
        d = order_stats.percent_ranks(df, "k", {"a": F.col("a"), "b": F.col("b")}, stage=stage)
        assert _rows(w, "k", "a_pr", "b_pr") == _rows(d, "k", "a_pr", "b_pr")
        assert len(stage.sizes()) == 8 and max(stage.sizes()) < 1.5 * 40_000 / 8
    cum = F.sum("a").over(Window.orderBy(F.desc("a")))
    want = df.select("k", (cum / F.sum("a").over(Window.partitionBy())).alias("s"), F.row_number().over(Window.orderBy(F.desc("a"), "k")).alias("p"))
    with Staged(spark) as stage:
        got = order_stats.cumulative_share_desc(df, "k", "a", "s", position="p", stage=stage)
        assert _rows(want, "k", "p") == _rows(got, "k", "p")
        assert [r[1] for r in _rows(got, "k", "s")] == pytest.approx([r[1] for r in _rows(want, "k", "s")], rel=1e-12)
        assert len(stage.sizes()) == 8 and max(stage.sizes()) < 1.5 * 20_000 / 8


def test_a_million_ties_with_alike_ids(spark):
    """Ids that share twenty characters, all tied in value, are dealt over all blocks."""
    df = spark.range(1_000_000).select(
        F.format_string("Supplier#00000000000%012d", (F.col("id") * 7919) % 1_000_000).alias("key"), F.lit(1).alias("v"))
    with Staged(spark) as stage:
        numbered = order_stats.row_numbers(df, "v", "key", "rn", count="n", stage=stage)
        wrong = F.col("rn") != F.substring("key", 21, 12).cast("long") + 1
        assert numbered.agg(F.count("*"), F.count_if(wrong), F.min("n"), F.max("n")).first()[:] == (1_000_000, 0, 1_000_000, 1_000_000)
        assert len(stage.sizes()) == 8 and max(stage.sizes()) < 1.5 * 1_000_000 / 8


def test_few_exchanges(spark):
    """The scorecard's ranks take one range exchange and one local one, then slim joins."""
    df = _frame(spark, [float(i % 7) for i in range(50)])
    plans = []

    def stage(df):
        plans.append(df)
        return stage_until_exit(df)

    ranks = order_stats.percent_ranks(df, "k", {"a": F.col("a"), "b": F.col("b")}, stage=stage)
    plans.append(order_stats.row_numbers(ranks, "a_pr", "k", stage=stage))
    assert len(plans) == 3
    plan = "".join(p._jdf.queryExecution().executedPlan().toString() for p in plans)
    assert len(re.findall(r"\bExchange ", plan)) <= 10


def test_no_job_before_an_action(spark):
    """Only what ranks the whole table stages something when the query is built."""
    import __spark_entry__ as E

    tracker, group = spark.sparkContext.statusTracker(), "lazy-check"
    spark.sparkContext.setJobGroup(group, group)
    for name in ("fact_orders", "mart_region", "supplier_base", "dq_report"):
        E.queries()[name](spark, "/root/testdata/sf0.001")
    assert not tracker.getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_staged_folders_end(spark):
    import glob

    from fulcrum.plans.catalog import QUERIES
    from fulcrum.session import checkpoint_dir

    folder = checkpoint_dir(spark).removeprefix("file:").rstrip("/") + "/fulcrum-stage/*"
    before = set(glob.glob(folder))
    for name in ("supplier_base", "mart_region"):
        QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert set(glob.glob(folder)) == before
    # in a scope, ranks stage with the rest of the scope
    root = new_stage_root(spark)
    with staging_scope(root):
        order_stats.row_numbers(spark.range(5), "id", "id").collect()
    assert set(glob.glob(folder)) - before == {root.removeprefix("file:")}
    drop_stage_root(spark, root)
    assert set(glob.glob(folder)) == before
