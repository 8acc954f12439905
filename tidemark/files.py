"""Folders in the store Spark writes to, whichever it is."""

from __future__ import annotations

import uuid
from typing import Any, NamedTuple

from pyspark.sql import SparkSession


class Folder(NamedTuple):
    system: Any
    path: Any


def folder(spark: SparkSession, path: str) -> Folder:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return Folder(target.getFileSystem(context._jsc.hadoopConfiguration()), target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, none where there is no folder."""
    at = folder(spark, path)
    if not at.system.exists(at.path):
        return []
    return sorted(entry.getPath().getName() for entry in at.system.listStatus(at.path))


def remove(at: Folder, quiet: bool = False) -> None:
    """Delete a folder. ``quiet`` is for the end of the driver, when Spark may be gone."""
    try:
        at.system.delete(at.path, True)
    except Exception:
        if not quiet:
            raise


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``, which goes when that is done.

    The old folder is renamed aside first: if the second rename fails it comes back.
    """
    new, old = folder(spark, source), folder(spark, target)
    aside = folder(spark, f"{target.rstrip('/')}-old-{uuid.uuid4().hex}")
    there = old.system.exists(old.path)
    if there and not old.system.rename(old.path, aside.path):
        raise OSError(f"cannot move {target} aside")
    if not new.system.rename(new.path, old.path):
        if there:
            old.system.rename(aside.path, old.path)
        raise OSError(f"cannot move {source} to {target}")
    if there:
        remove(aside)
