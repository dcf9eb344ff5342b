"""Result sets are replaced as a whole or not at all."""

from __future__ import annotations

import glob

import pytest

from fulcrum.operators import star
from fulcrum.plans import build, marts
from fulcrum.sources.published import Published, PublishConflict, Table
from fulcrum.sources.sinks import write_table
from fulcrum.sources.testdata import from_driver_tables
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one_set(spark, out, value):
    p = Published(spark, out)
    version = p.new_version()
    tables = {}
    for name in ("a", "b"):
        df = spark.createDataFrame([(value, name, None), (value, None, 1.5)], "v int, name string, x double")
        tables[name] = Table(f"{version}/{name}", "parquet", write_table(df, f"{version}/{name}"), df.schema.json())
    return p, version, tables


def test_sets_follow_each_other(spark, tmp_path):
    out = str(tmp_path / "out")
    p, version, tables = one_set(spark, out, 1)
    with pytest.raises(FileNotFoundError):
        p.read("a")
    assert p.publish(version, tables) == 1 and rows(p.read("a")) == [(1, "a", None), (1, None, 1.5)]
    with pytest.raises(KeyError):
        p.read("c")
    _, version, tables = one_set(spark, out, 2)
    assert {r.v for r in p.read("a").collect()} == {1}  # written, not published
    assert p.publish(version, tables) == 2 and {r.v for r in p.read("b").collect()} == {2}
    assert {r.v for r in p.read("b", number=1).collect()} == {1}
    one_set(spark, out, 3)  # abandoned
    assert len(p.clean(keep=1)) == 2 and {r.v for r in p.read("a").collect()} == {2}
    with pytest.raises(Exception):
        p.read("b", number=1)


def test_two_builds_at_once(spark, tmp_path):
    out = str(tmp_path / "out")
    first, v1, t1 = one_set(spark, out, 1)
    second, v2, t2 = one_set(spark, out, 2)
    before = first.current_number()
    assert first.publish(v1, t1, after=before) == 1
    with pytest.raises(PublishConflict):
        second.publish(v2, t2, after=before)
    assert {r.v for r in first.read("a").collect()} == {1}
    assert not glob.glob(f"{out}/manifests/*draft")


@pytest.mark.parametrize("failing", ["mart_region", "fact_orders"])
def test_a_failed_mart_leaves_the_old_set(spark, tmp_path, monkeypatch, failing):
    out = str(tmp_path / "out")
    src = from_driver_tables(spark, SF_SMALL)
    assert build.run_pipeline(src, out, fmt="parquet")["manifest"] == 1
    p = Published(spark, out)
    names = set(p.manifest()["tables"])
    assert set(build.MART_NAMES) | {"fact_orders", "dq_report", "headline_kpis"} == names
    old = {n: rows(p.read(n)) for n in names}

    real = build.write_table

    def broken(df, path, *args, **kwargs):
        if path.endswith("/" + failing):
            raise OSError("disk full")
        return real(df, path, *args, **kwargs)

    monkeypatch.setattr(build, "write_table", broken)
    with pytest.raises(OSError):
        build.run_pipeline(src, out, fmt="parquet")
    assert p.current_number() == 1
    assert {n: rows(p.read(n)) for n in names} == old
    monkeypatch.setattr(build, "write_table", real)
    assert build.run_pipeline(src, out, fmt="csv")["manifest"] == 2


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_published_tables_keep_their_types(spark, tmp_path, fmt):
    out = str(tmp_path / "out")
    src = from_driver_tables(spark, SF_SMALL)
    build.run_pipeline(src, out, fmt=fmt)
    p = Published(spark, out)
    with build.Pipeline(src) as pipe:
        fact = star.as_reference_types(pipe.fact)
        got = p.read("fact_orders")
        assert dict(got.dtypes) == dict(fact.dtypes)
        assert rows(got.select(*fact.columns)) == rows(fact)
        want = marts.mart_monthly(pipe.fact)
        assert p.read("mart_monthly").schema == want.schema or dict(p.read("mart_monthly").dtypes) == dict(want.dtypes)
        assert rows(p.read("mart_monthly")) == rows(want)
