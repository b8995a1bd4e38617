"""Session set-up shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from palabre.sources.manifests import delete_folder

_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def build_session(app_name: str = "palabre", hive: bool = False, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution and its skew handling on.

    ``conf`` holds further settings with ``__`` in place of dots. With ``hive``
    the catalog is the Hive metastore, else Spark's own.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder that all executors can reach.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
    local session without that setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="palabre-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    place = _scratch.get() or f"{root.rstrip('/')}/palabre"
    return f"{place}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[None]:
    """Within, ``shared_dir`` gives paths in a folder that is deleted at the end."""
    path = shared_dir(spark, purpose)
    token = _scratch.set(path)
    try:
        yield
    finally:
        _scratch.reset(token)
        delete_folder(spark, path)


def store(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written to the shared folder and read back: made once, however often it is used.

    It survives lost executors, and its size is known when joins are planned.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
