"""A set of result tables that is replaced as a whole.

Tables are written under a version folder nobody reads yet; one small manifest, created
last, makes them the current set:

    <out>/versions/<version>/<table>/...      a finished or an abandoned set
    <out>/manifests/0000000007.json           version, and per table: path, format, rows, schema

Readers take the manifest of the highest number.  A build that fails before its manifest leaves the
former set as it was; what it wrote is never read and ``clean`` removes it.  A manifest is written under
a name of its own and then renamed, and the rename fails if the number is taken, so of two builds
that publish at once one fails instead of mixing with the other.  (On object stores without an atomic
rename, publish from one driver at a time.)
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fulcrum.sources.tables import drop_stage_root


class PublishConflict(RuntimeError):
    pass


@dataclass(frozen=True)
class Table:
    path: str
    format: str
    rows: int
    schema: str  # as JSON


class Published:
    """The published tables of one output folder."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self._jvm = spark.sparkContext._jvm

    # ---------------------------------------------------------------- files
    def _path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.out}/{name}" if name else self.out)

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(), self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    # ---------------------------------------------------------------- writing
    def new_version(self) -> str:
        """Folder for the tables of a build."""
        return f"{self.out}/versions/{uuid.uuid4().hex}"

    def publish(self, version: str, tables: dict[str, Table], after: int | None = None) -> int:
        """Make ``tables`` the current set, as the successor of the manifest ``after`` (by default of the
        current one).  Raises ``PublishConflict`` if another build has published since."""
        number = (self.current_number() if after is None else after) + 1
        body = json.dumps({"version": version.rsplit("/", 1)[-1], "tables": {n: vars(t) for n, t in tables.items()}}, indent=1)
        fs, draft, final = self._fs(), self._path(f"manifests/_{uuid.uuid4().hex}.draft"), self._path(f"manifests/{number:010d}.json")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(body.encode()))
        finally:
            stream.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise PublishConflict(f"{self.out}: manifest {number} has been published by another build")
        return number

    # ---------------------------------------------------------------- reading
    def current_number(self) -> int:
        """0 if nothing has been published."""
        return max((int(n[:-5]) for n in self._names("manifests") if n.endswith(".json")), default=0)

    def manifest(self, number: int | None = None) -> dict:
        number = self.current_number() if number is None else number
        if not number:
            raise FileNotFoundError(f"{self.out}: nothing published")
        text = self.spark.read.text(f"{self.out}/manifests/{number:010d}.json", wholetext=True).first()[0]
        found = json.loads(text)
        return {"number": number, "version": found["version"], "tables": {n: Table(**t) for n, t in found["tables"].items()}}

    def read(self, name: str, number: int | None = None) -> DataFrame:
        """One table of the current set, or of an earlier one, with the types it was written with."""
        tables = self.manifest(number)["tables"]
        if name not in tables:
            raise KeyError(f"{self.out}: no table {name!r} in the published set")
        t = tables[name]
        reader = self.spark.read.schema(StructType.fromJson(json.loads(t.schema)))
        if t.format == "csv":
            return reader.option("header", True).option("escape", '"').csv(t.path, enforceSchema=False)
        return reader.format(t.format).load(t.path)

    # ---------------------------------------------------------------- housekeeping
    def clean(self, keep: int = 2) -> list[str]:
        """Remove the versions of all but the last ``keep`` manifests, and those of builds that never
        published; call it while no build runs.  Returns the versions removed."""
        numbers = sorted(int(n[:-5]) for n in self._names("manifests") if n.endswith(".json"))
        held = {self.manifest(n)["version"] for n in numbers[-keep:]} if keep else set()
        gone = [v for v in self._names("versions") if v not in held]
        for v in gone:
            drop_stage_root(self.spark, f"{self.out}/versions/{v}")
        for n in numbers[:-keep] if keep else numbers:
            self._fs().delete(self._path(f"manifests/{n:010d}.json"), False)
        return gone
