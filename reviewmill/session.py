"""Session defaults, the shared scratch folder and stored tables that cut lineage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# AQE picks join strategy, partition counts and skew splits at run time; nothing
# below depends on the size of the machine the driver happens to run on.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_SCOPES: list[list[str]] = []


def build_session(app_name: str = "reviewmill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; keyword arguments use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting uses a folder of its own below the warehouse, which outlives no machine but its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse").rstrip("/")
    return f"{warehouse}/scratch-{spark.sparkContext.applicationId}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at its end, every table and folder that was named below the shared folder inside.

    For work whose result no longer reads them: a fitted model, a table written elsewhere.
    """
    named: list[str] = []
    _SCOPES.append(named)
    try:
        yield
    finally:
        _SCOPES.remove(named)
        for path in named:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused between calls."""
    path = os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def publish(df: DataFrame, label: str, schema: StructType | None = None) -> DataFrame:
    """Write once to the shared folder and return the stored table, read by ``schema`` where another one stands for the same files."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)
