"""Session helpers: settings the operators rely on, and the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the operators. AQE's skew handling splits hot keys on
# the streamed side of the left joins used throughout; it is on by default in
# Spark and named here so that a cluster profile does not lose it.
OPERATOR_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidegate")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in OPERATOR_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one ``spark.checkpoint.dir`` names.

    Only a local master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        folder = configured
    elif spark.sparkContext.getCheckpointDir():
        folder = spark.sparkContext.getCheckpointDir()
    elif spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tidegate-")
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


# The run folder that step copies go to, while a `run_folder` is open.
_RUN: ContextVar[str | None] = ContextVar("run_folder", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, or the open run folder; nothing is created yet."""
    parent = _RUN.get() or f"{shared_folder(spark).rstrip('/')}/tidegate"
    return f"{parent}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it; a missing one is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting while one statement runs, for what writers take from the session only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[None]:
    """Step copies made inside are removed at the end; `finished` brings a result out."""
    path = scratch_path(spark, "run")
    token = _RUN.set(path)
    try:
        yield
    finally:
        _RUN.reset(token)
        remove_folder(spark, path)


def finished(df: DataFrame) -> DataFrame:
    """The frame written beside the open run folder, so that it outlives the run's step copies."""
    spark, path = df.sparkSession, _RUN.get()
    token = _RUN.set(path.rpartition("/")[0] if path else None)
    try:
        return cut_lineage(df)
    finally:
        _RUN.reset(token)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back.

    Survives the loss of executors, unlike a cached block, and Spark knows the copy's
    size when it plans what follows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def step_copy(df: DataFrame) -> Iterator[DataFrame]:
    """The frame as `cut_lineage` gives it, removed at the end: for wide copies read once or twice."""
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)
