"""Where intermediate results go when a job has to write them down.

Everything lands in the shared folder the session names in
``spark.checkpoint.dir``. Only a session without a cluster may go without one.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_open_scopes: ContextVar[tuple[str, ...]] = ContextVar("open_scopes", default=())


@cache
def _folder_of_this_process() -> str:
    return tempfile.mkdtemp(prefix="footfall-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    # Driver and executors are one process here; "local-cluster" is not of this kind.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _folder_of_this_process()


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders inside a folder; none if there is no such folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(target):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(target) if s.isDirectory())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of any store Spark writes to; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[str]:
    """Tables written inside are deleted at the end; read what you need before.

    Scopes can be nested; a table belongs to the innermost one.
    """
    folder = f"{shared_folder(spark)}/scope-{uuid.uuid4().hex}"
    token = _open_scopes.set((*_open_scopes.get(), folder))
    try:
        yield folder
    finally:
        _open_scopes.reset(token)
        delete_folder(spark, folder)


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table; a rerun never collides with an earlier one."""
    open_scopes = _open_scopes.get()
    parent = open_scopes[-1] if open_scopes else shared_folder(spark)
    return f"{parent}/{name}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, name: str = "rows", path: str | None = None, **options: str
) -> DataFrame:
    """Compute ``df`` once, for consumers that read it several times.

    The rows become a table in the shared folder: they survive the loss of an
    executor, nothing later goes back to the lineage, and every reader takes
    only the columns it needs. It stays until its ``scope`` ends, or, outside
    of one, until somebody clears the folder. ``path``, a ``table_path`` from before a scope, lets it
    outlive that one. ``options`` are those of the Parquet writer.
    """
    path = path or table_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# So many keys of one long each may go to every task.
FEW_KEYS = 1_000_000


def is_few(keys: DataFrame) -> bool:
    """Whether ``keys``, a table written before, may be broadcast whatever the planner thinks of its size."""
    return keys.count() <= FEW_KEYS


def with_few(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """``rows`` without most of those whose ``name`` isn't among ``keys``, and with all others.

    Where keys are few, their hashes reach all tasks, so that rows without a key aren't shuffled
    by the exact join that has to follow. Where they are many, ``rows`` stays as it is.
    """
    if not is_few(keys):
        return rows
    hashes = keys.select(F.xxhash64(name).alias("hash_of_key")).distinct()
    return rows.join(F.broadcast(hashes), F.xxhash64(rows[name]) == F.col("hash_of_key"), "left_semi")
