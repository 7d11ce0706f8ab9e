"""File listing and checks, as frames: contents are never read here."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.compare import filter_join

# The layout Spark's binaryFile source has.
LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def literal_path(path: str) -> str:
    """A listed path for Spark's readers, which take paths as glob patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def list_files(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """(path, file_name, length, modified) of every file; column pruning leaves contents alone.

    Files of zero bytes do not appear: Spark's file sources pass over them.
    """
    listed = spark.read.format("binaryFile").options(**options).load(paths if isinstance(paths, str) else list(paths))
    return listed.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def missing_files(claimed: DataFrame, present: DataFrame, on: str | Sequence[str] = "file_name") -> DataFrame:
    """Claimed files that no listing shows. Pass the union of the places a file may be."""
    keys = [on] if isinstance(on, str) else list(on)
    return filter_join(claimed, present.select(*keys).distinct(), keys, "left_anti")
