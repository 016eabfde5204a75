"""Enough tasks for scans, which cost far more per byte than reading does."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread rows over all cores when the input has fewer splits than that.

    A file with one row group is one split, and a scan of it would run on one
    core.  Inputs with a split per core, as any large table has, stay as they
    are and are not shuffled.  Meant for tables as read, whose number of splits
    is known without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
