"""Staged tables: materialise an intermediate result as Parquet in the shared checkpoint
folder and continue from the written copy.

This is how lineage is cut: the downstream plan starts from a Parquet scan (column
pruning, filter pushdown, real size statistics for join planning), a lost executor only
costs a re-read, and the optimiser never re-plans the upstream DAG.  The folder is the
cluster's ``spark.checkpoint.dir``; a scratch folder is used only when none is set.

Tables staged inside ``staging_scope(root)`` go under ``root`` (a pipeline's own folder,
removed by ``drop_stage_root`` when the pipeline is closed); the scope follows work handed
to worker threads by ``submit_in_scope``.
"""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import uuid
import weakref
from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from fulcrum.session import checkpoint_dir

_ROOT: contextvars.ContextVar[str | None] = contextvars.ContextVar("fulcrum_stage_root", default=None)


#: Keeps an intermediate result that several branches of a plan read: ``stage_table`` in a
#: pipeline's scope, ``Shared`` for lazy plans, or nothing.
Share = Callable[[DataFrame], DataFrame]


def unshared(df: DataFrame) -> DataFrame:
    return df


class Shared:
    """Lazy sharing: what is passed to ``share`` is persisted (nothing runs before the
    caller's action, lost blocks are computed again from their lineage) and unpersisted when
    the result given to ``until`` is no longer referenced.  Frames derived from that result
    stay valid; they only lose the shortcut."""

    def __init__(self):
        self._held: list[DataFrame] = []

    def share(self, df: DataFrame) -> DataFrame:
        df.persist()
        _USES[df.semanticHash()] += 1  # equal plans share one persisted copy
        self._held.append(df)
        return df

    def until(self, result: DataFrame) -> DataFrame:
        weakref.finalize(result, _unpersist, self._held).atexit = False
        return result


_USES: Counter[int] = Counter()


def _unpersist(frames: list[DataFrame]) -> None:
    for df in frames:
        with contextlib.suppress(Exception):  # the session may have ended
            _USES[df.semanticHash()] -= 1
            if _USES[df.semanticHash()] <= 0:
                df.unpersist()


def new_stage_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/fulcrum-stage/{uuid.uuid4().hex}"


@contextlib.contextmanager
def staging_scope(root: str):
    token = _ROOT.set(root)
    try:
        yield root
    finally:
        _ROOT.reset(token)


def drop_stage_root(spark: SparkSession, root: str) -> None:
    """Delete a staging folder (any Hadoop-compatible file system)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def submit_in_scope(pool: ThreadPoolExecutor, fn, *args):
    """``pool.submit(fn, *args)`` running in a copy of the *submitting* thread's context, so
    the staging scope follows the work."""
    return pool.submit(contextvars.copy_context().run, fn, *args)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    root = _ROOT.get() or new_stage_root(df.sparkSession)
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_until_exit(df: DataFrame) -> DataFrame:
    """Stage in the running scope if there is one, else in a folder that is deleted when the driver's
    Python ends."""
    if _ROOT.get() is None:
        root = new_stage_root(df.sparkSession)
        atexit.register(drop_stage_root_quietly, df.sparkSession, root)
        with staging_scope(root):
            return stage_table(df, "kept")
    return stage_table(df, "kept")


def drop_stage_root_quietly(spark: SparkSession, root: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        drop_stage_root(spark, root)
