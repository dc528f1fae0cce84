"""Materialise an intermediate table in the shared checkpoint folder (cuts lineage).

The folder is ``spark.checkpoint.dir`` of the session (shared storage on a cluster), so
a lost executor never loses the table; every write goes to a fresh sub-folder.  Tables belong to
the ``Scope`` that is open when they are written: ``with scope(spark):`` deletes its own at the end
and nobody else's; what is written outside any scope is deleted at the end of the process.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from lapse.session import ensure_checkpoint_dir


class Scope:
    """Folders written by one run."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def release(self, spark: SparkSession) -> int:
        """Delete the folders; returns how many were there."""
        jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
        while self.paths:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            n += bool(path.getFileSystem(conf).delete(path, True))
        return n


_PROCESS = Scope()
_SCOPE: ContextVar[Scope] = ContextVar("lapse_tables", default=_PROCESS)


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """Own the tables written inside; they are deleted on leaving, so read results before that."""
    mine = Scope()
    token = _SCOPE.set(mine)
    try:
        yield mine
    finally:
        _SCOPE.reset(token)
        mine.release(spark)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, owned by the open scope."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lapse-tables/{name}-{uuid.uuid4().hex[:12]}"
    _SCOPE.get().paths.append(path)
    return path


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    spark = df.sparkSession
    path = new_folder(spark, name)
    w = df.write.mode("error").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return spark.read.schema(_stored_schema(df, partition_by)).parquet(path)


def _stored_schema(df: DataFrame, partition_by: str | None):
    """The schema as the reader gives it: the partition column last, all nullable."""
    from pyspark.sql import types as T

    fields = sorted(df.schema.fields, key=lambda f: f.name == partition_by)
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def release(spark: SparkSession) -> int:
    """Delete the tables of the open scope (outside any: of the process); returns how many."""
    return _SCOPE.get().release(spark)


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _PROCESS.paths:
        with contextlib.suppress(Exception):  # the session may have ended; nothing is left to do then
            _PROCESS.release(spark)
