"""Loads that are seen whole or not at all.

A folder of versions looks like this:

    versions/<number>-<name>/...   the tables of one load
    published/<number>-<name>      an empty file for each load that ended

A load writes a version of its own and publishes it by one empty file, whose name says
all there is to say, so that nobody can read half of it on any file system. Readers take
the published version of the greatest number. A load that fails, or is killed, leaves
what was published before as it was. Two loads at once do not meet: each is whole, and
the one that began last is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from mercastar.storage import delete_folder

VERSIONS, PUBLISHED = "versions", "published"
# The version before the last one stays for those who have opened it.
KEPT = 2


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, ascending; none where there is no folder."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def published(spark: SparkSession, folder: str) -> list[str]:
    """Names of the published versions, oldest first."""
    return _names(spark, f"{folder.rstrip('/')}/{PUBLISHED}")


def current(spark: SparkSession, folder: str) -> str:
    """The published version to read, or `folder` itself if it has none."""
    folder = folder.rstrip("/")
    names = published(spark, folder)
    return f"{folder}/{VERSIONS}/{names[-1]}" if names else folder


def _publish(spark: SparkSession, folder: str, name: str) -> None:
    system, marker = _place(spark, f"{folder}/{PUBLISHED}/{name}")
    system.create(marker, False).close()


def _forget(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Delete published versions: first the mark, so that nobody opens what goes away."""
    for name in names:
        delete_folder(spark, f"{folder}/{PUBLISHED}/{name}")
        delete_folder(spark, f"{folder}/{VERSIONS}/{name}")


@contextmanager
def loading(spark: SparkSession, folder: str, kept: int = KEPT) -> Iterator[str]:
    """Give a new version's path to write to, and publish it if the block ends well.

    Afterwards the last `kept` published versions remain, this one included. If the
    block fails, its version is deleted and the error goes on.
    """
    folder = folder.rstrip("/")
    known = _names(spark, f"{folder}/{VERSIONS}")
    number = max((int(name.split("-")[0]) for name in known), default=0) + 1
    name = f"{number:012d}-{uuid.uuid4().hex}"
    version = f"{folder}/{VERSIONS}/{name}"
    system, place = _place(spark, version)
    system.mkdirs(place)  # later loads count from here on
    try:
        yield version
    except BaseException:
        delete_folder(spark, version)
        raise
    _publish(spark, folder, name)
    _forget(spark, folder, published(spark, folder)[: -max(kept, 1)])


def drop_unpublished(spark: SparkSession, folder: str) -> list[str]:
    """Delete what killed loads have left. Only for times when no load is running."""
    folder = folder.rstrip("/")
    whole = set(published(spark, folder))
    left = [name for name in _names(spark, f"{folder}/{VERSIONS}") if name not in whole]
    for name in left:
        delete_folder(spark, f"{folder}/{VERSIONS}/{name}")
    return left
