"""Sinks: mart/fact writers that report row counts without a second scan, and the
headline KPI JSON document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
    cluster_by: list[str] | None = None, derive: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Write ``df`` (overwrite) and return its row count, observed during the write.

    CSV output has a header row and ',' delimiter; Parquet keeps the types.  A partitioned
    write is range-partitioned on (partition columns, ``cluster_by``) first, so each task
    writes about one directory (not one file per directory per task) and a directory
    holding a third of the rows is still split over many tasks, deterministically.  ``derive`` makes
    the table to write from ``df`` after that exchange, which so carries the columns of ``df``."""
    if partition_by:
        df = df.repartitionByRange(*[F.col(c) for c in partition_by], *[F.col(c) for c in (cluster_by or [])])
    if derive is not None:
        df = derive(df)
    obs = Observation()
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("delimiter", ",").csv(path)
    else:
        writer.format(fmt).save(path)
    return int(obs.get["rows"])


def write_headline_json(wide: DataFrame, path: str) -> dict:
    """Write the one-row wide KPI mart as a JSON document and return it as a dict (the
    document is read back, so the aggregate behind ``wide`` runs once)."""
    wide.coalesce(1).write.mode("overwrite").json(path)
    one = wide.sparkSession.read.schema(wide.schema).json(path).collect()
    if len(one) != 1:
        raise ValueError(f"headline KPI mart must have exactly one row, got {len(one)}")
    return one[0].asDict()
