"""Small files and folders on whatever file system a path is on, through the session's own file-system client."""

from __future__ import annotations

import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=4)
def _path_class(jvm):
    """Looked up once: each part of a class's name is a call to the JVM."""
    return jvm.org.apache.hadoop.fs.Path


def _at(spark: SparkSession, path: str):
    place = _path_class(spark._jvm)(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file or folder. The folder that ``target`` lies in is made."""
    system, place = _at(spark, target)
    system.mkdirs(place.getParent())
    return system.rename(_at(spark, source)[1], place)


def stamps(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """Path, size and change time of files."""
    found = []
    for path in sorted(paths):
        system, place = _at(spark, path)
        status = system.getFileStatus(place)
        found.append((path, status.getLen(), status.getModificationTime()))
    return found


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, the last changed one first; none if there is no such folder."""
    system, place = _at(spark, folder)
    if not system.exists(place):
        return []
    listed = [(s.getModificationTime(), s.getPath().getName()) for s in system.listStatus(place)]
    return [name for _, name in sorted(listed, reverse=True)]


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, or none if there is no such file."""
    if not exists(spark, path):
        return None
    system, place = _at(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that readers see whole or not at all. False if another writer was first."""
    side = f"{path}.{uuid.uuid4().hex}"
    system, place = _at(spark, side)
    stream = system.create(place, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not exists(spark, path) and rename(spark, side, path):
        return True
    remove(spark, side)
    return False
