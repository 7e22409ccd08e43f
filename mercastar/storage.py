"""Where intermediate and warehouse tables are written."""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and all executors reach, from `spark.checkpoint.dir`."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def workspace(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark)}/mercastar/{spark.sparkContext.applicationId}"


# Folders of the steps that are there, with their numbers in the order of writing.
_steps: dict[str, int] = {}
_numbers = itertools.count()


def durable(df: DataFrame) -> DataFrame:
    """Write `df` to the workspace and read it back.

    The stored copy fixes non-deterministic values, ends the lineage and survives the
    loss of executors, since it does not depend on their disks. It is kept until
    `release` or `drop_steps`, because plans that read it may run at any later time.
    """
    spark = df.sparkSession
    path = f"{workspace(spark)}/steps/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _steps[path] = next(_numbers)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; nothing happens where there is none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def steps_mark() -> int:
    """A mark after the steps written so far."""
    return next(_numbers)


def steps_since(mark: int) -> list[str]:
    """Folders of the steps written after a mark."""
    return [path for path, number in _steps.items() if number > mark]


def delete_steps(spark: SparkSession, paths: list[str]) -> None:
    """Delete steps. For callers that know that no later plan reads them."""
    for path in list(paths):
        if _steps.pop(path, None) is not None:
            delete_folder(spark, path)


def drop_steps(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Delete the steps written after a mark, except the last `keep`.

    For a loop that has written its next state, or a result that is stored and no longer
    depends on its inner steps.
    """
    paths = steps_since(since)
    delete_steps(spark, paths[: len(paths) - keep])


def release(spark: SparkSession) -> None:
    """Delete everything this application has left in its workspace."""
    delete_folder(spark, workspace(spark))
    _steps.clear()
