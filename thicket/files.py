"""Small files beside tables: marks of versions and steps, on whatever file system Spark writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    system, place = _at(spark, folder)
    return sorted(x.getPath().getName() for x in system.listStatus(place)) if system.exists(place) else []


def read(spark: SparkSession, path: str) -> str | None:
    system, place = _at(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Writes a file whole or not at all, by its last name only when it is complete; False if it is there already and is not
    to be replaced."""
    system, place = _at(spark, path)
    _, part = _at(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = system.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if replace and system.exists(place):
        system.delete(place, False)
    if system.exists(place) or not system.rename(part, place):
        system.delete(part, False)
        return False
    return True


def listing(spark: SparkSession, path: str) -> list[str]:
    """``path length time`` of every file under a path, or a pattern of paths."""
    system, place = _at(spark, path)
    found, folders = [], list(system.globStatus(place) or [])
    while folders:
        status = folders.pop()
        if status.isDirectory():
            folders += [x for x in system.listStatus(status.getPath()) if not x.getPath().getName().startswith((".", "_"))]
        else:
            found.append(f"{status.getPath().toString()} {status.getLen()} {status.getModificationTime()}")
    return sorted(found)
