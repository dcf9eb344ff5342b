"""Raw CSV with a quarantine: typed rows, and every cell that its type refuses.

``read_raw_csv`` turns a bad cell into NULL.  Here one pass over the file types the rows, keeps each
bad cell (its column, its text, the whole record) and counts per column while it writes: the
typed rows with their bad cells are staged once, the counts come out of the same write.  A cell is bad if it
holds text that its column's type doesn't take; an empty cell is no value and not bad.  A record
with too few or too many fields is bad as a whole (column ``<record>``); its row is kept as
far as it could be read.

``report`` gives the counts in the form of the data-quality operator, so that
``quality.enforce`` can stop a build on them.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fulcrum.sources.model import Sources
from fulcrum.sources.raw import raw_text
from fulcrum.sources.schemas import RAW_FILES, ROLE_COLUMNS
from fulcrum.sources.tables import Share, stage_until_exit, submit_in_scope

RECORD = "<record>"
_TEXT, _BAD = "_record_text", "_bad_cells"


@dataclass
class Checked:
    """``rows``: typed.  ``rejects``: role, column, type, value, record of every bad cell.
    ``counts``: bad cells per typed column; ``n_rows``: rows read."""

    role: str
    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]
    n_rows: int

    def report(self, mostly: float | None = None) -> DataFrame:
        """A row per typed column, as ``quality.expect`` reports its rules: without ``mostly`` one bad cell
        fails a column, else a share of more than 1 - ``mostly`` of the rows."""
        spark = self.rows.sparkSession
        types = {**ROLE_COLUMNS[self.role], RECORD: "record"}
        rows = []
        for column, bad in self.counts.items():
            ok = bad == 0 if mostly is None else not self.n_rows or (self.n_rows - bad) / self.n_rows >= mostly
            pct = int(bad / self.n_rows * 100_000 + 0.5) / 1000 if self.n_rows else 0.0
            rows.append((f"ExpectColumnValuesToBeOfType({types[column]})", f"{self.role}.{column}", "yes", "PASS" if ok else "FAIL", pct))
        return spark.createDataFrame(rows, "expectation string, column string, critical string, result string, unexpected_pct double")


def read_checked(spark: SparkSession, path: str, role: str, stage: Share = stage_until_exit) -> Checked:
    raw = raw_text(spark, path, role, corrupt=_TEXT, stage=stage)
    wanted = {c: t for c, t in ROLE_COLUMNS[role].items() if t != "string"}
    typed, bad = [], []
    for name in raw.columns:
        if name == _TEXT:
            continue
        cell = F.col(f"`{name}`")
        value = F.trim(cell).try_cast(wanted[name]) if name in wanted else cell
        typed.append(value.alias(name))
        if name in wanted:
            refused = value.isNull() & (F.trim(cell) != "")
            bad.append(F.when(refused, F.struct(
                F.lit(name).alias("column"), F.lit(wanted[name]).alias("type"), cell.alias("value"))))
    record = F.coalesce(F.col(_TEXT), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in raw.columns if c != _TEXT])))
    bad.append(F.when(F.col(_TEXT).isNotNull(), F.struct(
        F.lit(RECORD).alias("column"), F.lit("record").alias("type"), F.col(_TEXT).alias("value"))))
    cells = F.filter(F.array(*bad), lambda x: x.isNotNull())
    named = raw.select(*typed, F.when(F.size(cells) > 0, F.struct(cells.alias("cells"), record.alias("record"))).alias(_BAD))
    seen = Observation()
    columns = [*wanted, RECORD]
    counted = [F.count_if(F.array_contains(F.col(_BAD)["cells"]["column"], c)).alias(f"c{i}")
               for i, c in enumerate(columns)]
    staged = stage(named.observe(seen, F.count(F.lit(1)).alias("n"), *counted))
    found = seen.get
    rejects = staged.where(F.col(_BAD).isNotNull()).select(
        F.lit(role).alias("role"), F.col(_BAD)["record"].alias("record"), F.inline(F.col(_BAD)["cells"]))
    return Checked(role, staged.drop(_BAD), rejects.select("role", "column", "type", "value", "record"),
                   {c: int(found[f"c{i}"]) for i, c in enumerate(columns)}, int(found["n"]))


def read_sources_checked(spark: SparkSession, raw_dir: str, stage: Share = stage_until_exit) -> tuple[Sources, dict[str, Checked]]:
    """The eight raw files, each typed and checked in one pass; the files are read concurrently."""
    folder = raw_dir.rstrip("/")
    with ThreadPoolExecutor(max_workers=len(RAW_FILES)) as pool:
        jobs = {role: submit_in_scope(pool, read_checked, spark, f"{folder}/{name}", role, stage) for role, name in RAW_FILES.items()}
        checked = {role: job.result() for role, job in jobs.items()}
    return Sources(**{role: c.rows for role, c in checked.items()}), checked


def all_reports(checked: dict[str, Checked], mostly: float | None = None) -> DataFrame:
    reports = [c.report(mostly) for c in checked.values()]
    out = reports[0]
    for more in reports[1:]:
        out = out.unionByName(more)
    return out


def all_rejects(checked: dict[str, Checked]) -> DataFrame:
    tables = [c.rejects for c in checked.values()]
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out
