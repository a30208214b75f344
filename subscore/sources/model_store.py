"""Numbered versions of a model in one folder, of which only complete ones are ever seen.

Version n lies in ``version=n``. It counts from the moment its marker is there, which is written
after everything else; a folder without one is a version that was never finished.
"""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

MARKER = "_COMMITTED"


def _files(spark: SparkSession, store: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(store)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _folder(store: str, version: int) -> str:
    return f"{store.rstrip('/')}/version={version:06d}"


def versions(spark: SparkSession, store: str, committed: bool = True) -> list[int]:
    """The numbers of the versions, rising; without ``committed`` unfinished ones as well."""
    system, root = _files(spark, store)
    if not system.exists(root):
        return []
    names = [status.getPath().getName() for status in system.listStatus(root)]
    found = sorted(int(name[1]) for name in (re.fullmatch(r"version=(\d+)", x) for x in names) if name)
    path = spark._jvm.org.apache.hadoop.fs.Path
    return [v for v in found if not committed or system.exists(path(f"{_folder(store, v)}/{MARKER}"))]


def publish_model(spark: SparkSession, model: PipelineModel, store: str) -> int:
    """Add a model as the next version, and return its number.

    Numbers of unfinished versions are not used again. Of two writers that take the same
    number at once, one fails, as its folder's claim is already there.
    """
    version = max(versions(spark, store, committed=False), default=0) + 1
    system, _ = _files(spark, store)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system.create(path(f"{_folder(store, version)}/_CLAIMED"), False).close()
    model.write().save(f"{_folder(store, version)}/model")
    system.create(path(f"{_folder(store, version)}/{MARKER}"), False).close()
    return version


def newest_version(spark: SparkSession, store: str) -> int | None:
    return max(versions(spark, store), default=None)


def load_version(spark: SparkSession, store: str, version: int | None = None) -> PipelineModel:
    """A committed version, the newest if none is named."""
    found = versions(spark, store)
    wanted = max(found, default=None) if version is None else version
    if wanted not in found:
        raise FileNotFoundError(f"{store} has no committed version" + (f" {version}" if version else ""))
    return PipelineModel.load(f"{_folder(store, wanted)}/model")
