"""Tables in and intermediate tables out."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patternscan.plans.layout import spread

_LOCAL: list[tempfile.TemporaryDirectory] = []


def table(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    """A given table; with keys, small inputs are spread over all cores."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, *keys) if keys else df


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    A session in one process that names none gets a temporary folder, which
    goes when the process ends; a cluster that names none is an error, since
    its machines share no local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.TemporaryDirectory(prefix="patternscan-"))
        base = _LOCAL[0].name
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def saved(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table into a shared folder and read it again.

    This cuts the lineage: a lost executor costs no more than what reads it.
    """
    path = f"{folder}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Ids up to this number (some 30 MB) go to every executor; more are joined.
MOST_BROADCAST_IDS = 2_000_000


def keep_ids(df: DataFrame, col: str, ids: DataFrame, others: bool = False) -> DataFrame:
    """The rows whose ``col`` is among ``ids`` (one column of that name), or the
    others.  Wide rows are not shuffled as long as the ids, which are counted,
    are few enough to broadcast."""
    few = ids.count() <= MOST_BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, col, "leftanti" if others else "leftsemi").select(*df.columns)


def check_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {', '.join(df.columns)}")
