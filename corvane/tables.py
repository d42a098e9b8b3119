"""Intermediate tables in the shared folder, each deleted at the end of the scope it was written in."""

from __future__ import annotations

import atexit
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .session import shared_dir

#: Tables of the running scopes, the innermost last; the first lives until the driver ends.
_scopes: list[list[tuple[weakref.ref, str]]] = [[]]


def materialize(df: DataFrame, label: str, result: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Lineage ends at the table, which every executor can read again after another one is lost. The table lives until
    the end of the innermost scope(), or of the one around that if it is the scope's ``result``, or of the driver.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    own = len(_scopes) - 1
    _scopes[max(0, own - result)].append((weakref.ref(spark), path))
    return spark.read.schema(df.schema).parquet(path)


def keep_until_exit(spark: SparkSession, path: str) -> None:
    _scopes[0].append((weakref.ref(spark), path))


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def _drop(tables: list[tuple[weakref.ref, str]]) -> None:
    while tables:
        ref, path = tables.pop()
        spark = ref()
        if spark is not None and spark._jsc is not None and spark._jsc.sc() is not None:
            drop_path(spark, path)


@contextmanager
def scope() -> Iterator[None]:
    """Tables that are written inside are deleted at its end; those of other queries stay."""
    _scopes.append([])
    try:
        yield
    finally:
        _drop(_scopes.pop())


@atexit.register
def _at_exit() -> None:
    try:
        _drop(_scopes[0])
    except Exception:  # the JVM may be gone by now; nothing is left to clean through it
        _scopes[0].clear()
