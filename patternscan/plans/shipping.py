"""Make this package usable in Python workers that do not have it installed."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Functions of this package travel inside the job, by value.

    Files added to a session (``--py-files``) do not reach the worker that
    prepares a stateful streaming query, so the code itself is sent.
    """
    package = sys.modules[__name__.partition(".")[0]]
    if package.__name__ not in cloudpickle.list_registry_pickle_by_value():
        cloudpickle.register_pickle_by_value(package)
