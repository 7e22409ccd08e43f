"""What the Python workers of a session need."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def find_package(spark: SparkSession) -> None:
    """Let workers import this package from where the driver found it.

    It matters where the session was started in another folder; a cluster gets the
    package shipped (`--py-files`) and ignores a place it does not have.
    """
    environment = spark.sparkContext.environment
    places = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in places:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, places), ROOT])
