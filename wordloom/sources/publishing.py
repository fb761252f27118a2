"""Tables that are replaced as a whole: readers see the old version or the new one, never parts.

A version is written to a folder of its own, checked there, and becomes the current one when the file that names it is moved into place, which a
file system does in one step.  A job that fails, or a check that finds something, leaves the old version as it was.  Versions are kept until
``tidied`` removes those that are no longer named.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wordloom.sources.writers import changed

POINTER = "CURRENT"


class NotPublished(ValueError):
    """A check found rows in a new version."""


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version; None before the first."""
    files, where = _folder(spark, f"{path}/{POINTER}")
    return f"{path}/{spark.read.text(str(where)).first().value}" if files.exists(where) else None


def read(spark: SparkSession, path: str) -> DataFrame:
    where = current(spark, path)
    if where is None:
        raise FileNotFoundError(f"nothing is published in {path}")
    return spark.read.parquet(where)


def _named(spark: SparkSession, path: str, version: str) -> None:
    """Make a version the current one: the new pointer replaces the old one in one step."""
    files, beside = _folder(spark, f"{path}/.{POINTER}-{uuid.uuid4().hex}")
    out = files.create(beside)
    out.write(bytearray(version.encode()))
    out.close()
    java = spark._jvm
    over = java.java.lang.reflect.Array.newInstance(java.org.apache.hadoop.fs.Options.Rename.OVERWRITE.getClass(), 1)
    over[0] = java.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = java.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(beside, java.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), over)


def publish(df: DataFrame, path: str, checks: dict[str, Callable[[DataFrame], DataFrame]] | None = None, if_changed: bool = False) -> bool:
    """Write df as the new version of path and name it; whether it was.

    Each check gets the version as it was written and returns the rows that break it: any row is an error (NotPublished), and the old version stays.  With
    ``if_changed`` a version equal to the current one, as a multiset of rows, isn't named.
    """
    spark = df.sparkSession
    version = f"versions/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    new = spark.read.parquet(f"{path}/{version}")
    for name, check in (checks or {}).items():
        if not check(new).isEmpty():
            raise NotPublished(f"{name}: {check(new).first()}")
    if if_changed and current(spark, path) and not changed(read(spark, path), new):
        return False
    _named(spark, path, version)
    return True


def tidied(spark: SparkSession, path: str) -> int:
    """Remove all versions but the current one, when nobody writes or reads another; how many were removed."""
    files, where = _folder(spark, f"{path}/versions")
    kept, gone = (current(spark, path) or "").rsplit("/", 1)[-1], 0
    for f in files.listStatus(where) if files.exists(where) else ():
        if f.getPath().getName() != kept:
            gone += bool(files.delete(f.getPath(), True))
    return gone
