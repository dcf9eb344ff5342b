"""Raw CSV sources: header row, all columns kept, read as strings and then typed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulcrum.sources.model import Sources
from fulcrum.sources.multiline import read_multiline_csv
from fulcrum.sources.schemas import MULTILINE_ROLES, RAW_FILES, ROLE_COLUMNS
from fulcrum.sources.tables import Share, stage_until_exit


def raw_text(spark: SparkSession, path: str, role: str, corrupt: str | None = None, stage: Share = stage_until_exit) -> DataFrame:
    """One raw CSV as text columns, checked for the columns of ``role``; ``corrupt`` names a further column
    with the text of records that have too few or too many fields (null for the others).

    Only review texts hold line breaks: that file goes through the reader that splits quoted
    multi-line CSV; all others are split by Spark's own."""
    names = spark.read.option("header", True).option("escape", '"').csv(path).columns
    missing = [c for c in ROLE_COLUMNS[role] if c not in names]
    if missing:
        raise ValueError(f"{path}: missing column(s) {missing} for source role {role!r}")
    if role in MULTILINE_ROLES:
        return read_multiline_csv(spark, path, stage, corrupt)
    reader = spark.read.option("header", True).option("escape", '"').option("mode", "PERMISSIVE")
    if not corrupt:
        return reader.option("inferSchema", False).csv(path)
    ddl = ", ".join("`" + n.replace("`", "``") + "` string" for n in [*names, corrupt])
    return reader.schema(ddl).option("columnNameOfCorruptRecord", corrupt).csv(path)


def read_raw_csv(spark: SparkSession, path: str, role: str, stage: Share = stage_until_exit) -> DataFrame:
    """Read one raw CSV and type the columns of ``role``.

    Every column of the file is kept: those of the role get their type, the others stay text.
    Nothing is inferred: a zip-like ``01409`` stays text, and numbers and timestamps are converted
    with ``try_cast`` (timestamps without a time zone), so a bad cell is NULL rather than a
    failed job; ``checked.read_checked`` keeps and counts such cells.
    """
    raw, wanted = raw_text(spark, path, role, stage=stage), ROLE_COLUMNS[role]
    cols = []
    for name in raw.columns:
        c, dtype = F.col(f"`{name}`"), wanted.get(name, "string")
        cols.append((c if dtype == "string" else F.trim(c).try_cast(dtype)).alias(name))
    return raw.select(*cols)


def convert_reviews(spark: SparkSession, csv_path: str, parquet_path: str, files: int) -> DataFrame:
    """Rewrite a review file as ``files`` Parquet files, for many later reads."""
    read_raw_csv(spark, csv_path, "reviews").repartition(files).write.mode("overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def read_sources_csv(spark: SparkSession, raw_dir: str) -> Sources:
    """Read the eight raw CSV files of a directory into ``Sources``."""
    frames = {role: read_raw_csv(spark, f"{raw_dir.rstrip('/')}/{fname}", role) for role, fname in RAW_FILES.items()}
    return Sources(**frames)
