"""Scratch tables of the operators: Parquet in the cluster's shared ``spark.checkpoint.dir``.

Writing an intermediate result cuts lineage, survives lost executors, and fixes anything
that is not a pure function of the rows (range bounds, generated ids).  A folder lives
until ``drop()`` or, for tables that a returned lazy DataFrame still reads, until the
driver's Python exits.
"""

from __future__ import annotations

import atexit
import contextlib

from pyspark.sql import DataFrame, SparkSession

from fulcrum.sources.tables import drop_stage_root, new_stage_root


class Scratch:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = new_stage_root(spark)
        self._n = 0
        atexit.register(self.drop)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written copy."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, *frames: DataFrame) -> None:
        """Delete written tables that nothing reads any more."""
        for df in frames:
            for file in df.inputFiles()[:1]:
                drop_stage_root(self.spark, file.rsplit("/", 1)[0])

    def drop(self) -> None:
        atexit.unregister(self.drop)
        with contextlib.suppress(Exception):  # the session may have ended already
            drop_stage_root(self.spark, self.root)
