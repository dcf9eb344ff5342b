"""What a build stages, and what the exchanges around the staged fact carry."""

from __future__ import annotations

import glob
import os

import pytest

from fulcrum.operators import star
from fulcrum.plans import build
from fulcrum.sources.published import Published
from fulcrum.sources.testdata import DRIVER_SCHEMAS, from_driver_tables
from tests.helpers import item, order, sources

ITEMS = [item("o1", 1, "p1", "s1", price=5), item("o1", 2, "p1", "s2", price=7), item("o2", 1, "p1", "s1", price=9),
         item("gone", 1, "p1", "s1", price=100)]


@pytest.fixture
def static_joins(spark):
    """Plans as they are for tables that no join broadcasts."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _source(spark):
    return sources(spark, [order(o) for o in ("o1", "o2")], ITEMS, reviews=[("o1", 1)], products=[("p1", "a", 1, 1, 1, 1)])


def _staged(p: build.Pipeline) -> list[str]:
    return sorted(name.rsplit("-", 1)[0] for name in os.listdir(p.stage_root.removeprefix("file:")))


def _plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def test_only_what_is_read_again_is_staged(spark):
    with build.Pipeline(_source(spark)) as p:
        assert _staged(p) == ["fact_orders", "order_supplier"]
        assert all(f.endswith(".zstd.parquet") for f in glob.glob(f"{p.stage_root.removeprefix('file:')}/*/part-*"))
        scored = sorted(tuple(r) for r in p.scorecard().collect())
    with build.Pipeline(_source(spark), keep_links=False) as p:
        assert _staged(p) == ["fact_orders"]
        assert sorted(tuple(r) for r in p.scorecard().collect()) == scored


@pytest.mark.parametrize("only, links", [(("fact_orders",), False), (("mart_supplier_scorecard",), True), (None, True), ((), False)])
def test_links_are_staged_for_the_scorecard_alone(spark, tmp_path, monkeypatch, only, links):
    seen = []
    real = star.stage_table
    monkeypatch.setattr(star, "stage_table", lambda df, name: seen.append(name) or real(df, name))
    build.run_pipeline(_source(spark), str(tmp_path / "out"), fmt="parquet", only=only)
    assert ("order_supplier" in seen) == links and "fact_orders" in seen


def test_the_published_fact_is_derived_after_its_exchange(spark, tmp_path, monkeypatch):
    carried = {}
    real = build.write_table

    def noted(df, path, *args, **kwargs):
        carried[path.rsplit("/", 1)[-1]] = set(df.columns)
        return real(df, path, *args, **kwargs)

    monkeypatch.setattr(build, "write_table", noted)
    out = str(tmp_path / "out")
    build.run_pipeline(_source(spark), out, fmt="parquet", only=("fact_orders",))
    assert carried["fact_orders"].isdisjoint({"freight_ratio", "delay_days", "handling_days", "transit_days", "is_delivered", "is_canceled",
                                              "is_late", "is_bad_review"})
    got = Published(spark, out).read("fact_orders").select(*star.FACT_ORDERS_COLUMNS)
    expected = star.as_reference_types(star.Star(_source(spark)).orders)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert [f.dataType for f in got.schema] == [f.dataType for f in expected.schema]


def test_order_side_moves_days_not_timestamps(spark, static_joins):
    lines = _plan(star.order_side(_source(spark)))
    top = "\n".join(lines[:next(i for i, line in enumerate(lines) if "Exchange" in line)])
    assert "cast(order_" not in top, top


def test_the_adapter_derives_order_columns_after_its_join(spark, static_joins, tmp_path):
    for name, ddl in DRIVER_SCHEMAS.items():
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = _plan(from_driver_tables(spark, str(tmp_path)).orders)
    below = "\n".join(lines[next(i for i, line in enumerate(lines) if "Exchange" in line):])
    assert "CASE WHEN (o_orderstatus" not in below and "INTERVAL" not in below, below
