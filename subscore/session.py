"""Session set-up and the shared folder that jobs may write to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Paths given out within each open :func:`scratch_scope`, the innermost last.
_scopes: list[list[str]] = []


def build_session(
    app_name: str = "subscore", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Session with adaptive execution and UTC timestamps, plus the settings in ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # The JVM never compiles a longer method, so let Spark generate several shorter ones.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    for name, value in (settings | (conf or {})).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach: below ``spark.checkpoint.dir``, as the cluster names it.

    Without that setting, below ``spark.sql.warehouse.dir``, which executors share as well.
    """
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root is not None:
        return root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing else writes there."""
    path = f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, all paths that :func:`scratch_path` gives out within.

    Results that still have to be read from them must be written elsewhere by then, to a path
    that was taken outside. Scopes may lie within each other, in one thread.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove_scratch(spark, path)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a path that :func:`scratch_path` gave, once nothing reads it any more."""
    if not path.startswith(shared_root(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not below the shared folder")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
