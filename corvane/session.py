"""Sessions: configuration for this library's plans, and shipping its code to executors."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: weakref.WeakSet = weakref.WeakSet()

#: Serves a single machine whose session names no shared folder, as in tests.
LOCAL_SHARED = "/tmp/checkpoints/corvane"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir, which a cluster has to name."""
    if given := spark.conf.get("spark.checkpoint.dir", None):
        return given.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return LOCAL_SHARED


def set_checkpoints(spark: SparkSession) -> None:
    """Point checkpoint() to the shared folder where no other has been set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC times; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName("corvane").config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Give executors this package's modules, once a Spark context, whatever their own path is."""
    context = spark.sparkContext
    if context not in _shipped:
        top = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="corvane-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        place = os.path.join(folder, "corvane-code.zip")
        with zipfile.ZipFile(place, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        context.addPyFile(place)
        _shipped.add(context)
    return spark
