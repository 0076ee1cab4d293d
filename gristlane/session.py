"""Session helpers that hold on a laptop and on a cluster."""

from __future__ import annotations

import itertools
import os
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_seq = itertools.count()


def build(master: str = "local[*]", shuffle: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A session with the settings that the operators assume (UTC, AQE).

    ``shared``: the folder that driver and executors share, where spark.checkpoint.dir is not given already.
    """
    builder = SparkSession.builder.master(master)
    if shared and "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.config("spark.checkpoint.dir", shared)
    return (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where it is unset and the session is local (tests, one machine) a folder under the warehouse
    is taken; on a cluster an unset folder is an error.
    """
    got = spark.conf.get("spark.checkpoint.dir", None)
    if not got:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        got = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse").rstrip("/") + "/_shared"
        if "://" not in got and not got.startswith("file:"):
            got = "file://" + got
        elif got.startswith("file:/") and not got.startswith("file://"):
            got = "file://" + got[5:]
    return got.rstrip("/")


_scratch: ContextVar[str] = ContextVar("_scratch", default="")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/gristlane/{spark.sparkContext.applicationId}/{_scratch.get()}{next(_seq)}-{uuid.uuid4().hex[:8]}-{name}"


@contextmanager
def scratch(spark: SparkSession):
    """Intermediate tables that are written within are deleted at the end; what is to stay is written to a path taken before."""
    folder = f"{next(_seq)}-{uuid.uuid4().hex[:8]}-scratch/"
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        discard(spark, f"{shared_dir(spark)}/gristlane/{spark.sparkContext.applicationId}/{folder}")


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut the lineage with a written table in the shared folder and read it again.

    Unlike a cached table it outlives lost executors, and its size is known to the planner.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete finished intermediate tables of the shared folder."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def cleanup(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results that were not written elsewhere go with them."""
    discard(spark, f"{shared_dir(spark)}/gristlane/{spark.sparkContext.applicationId}")
