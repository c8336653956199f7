"""Written intermediate tables, in the folder the cluster shares."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_staged: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("staged", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session may fall back to its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="commitpost-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Writes ``df`` once and reads it back: later uses neither recompute it nor depend on its executors."""
    path = new_path(df.sparkSession, name)
    staged = _staged.get()
    if staged is not None:
        staged.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a folder this job has written and no longer reads, in whatever store it lies."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end, also after a failure, what was staged inside: results must have been written by then."""
    staged: list[str] = []
    token = _staged.set(staged)
    try:
        yield
    finally:
        _staged.reset(token)
        for path in staged:
            drop(spark, path)
