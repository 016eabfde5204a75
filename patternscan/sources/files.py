"""Whole files as blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, *globs: str) -> DataFrame:
    """``file, n_bytes, content`` for every file the globs name."""
    files = spark.read.format("binaryFile").load(list(globs))
    return files.select(
        F.col("path").alias("file"), F.col("length").alias("n_bytes"), "content"
    )
