"""Small files of the driver, on whatever file system a path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    files, place = _at(spark, folder)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place))


def read(spark: SparkSession, path: str) -> str:
    files, place = _at(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears whole or not at all; an error if it is there already."""
    folder, name = path.rsplit("/", 1)
    files, draft = _at(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(place) or not files.rename(draft, place):
        files.delete(draft, False)
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    """A file or a folder with all it holds; nothing happens if it is absent."""
    files, place = _at(spark, path)
    files.delete(place, True)


def fingerprint(spark: SparkSession, paths: list[str]) -> tuple:
    """Path, length and time of files, ascending; nothing of them is read."""
    out = []
    for path in sorted(paths):
        files, place = _at(spark, path)
        status = files.getFileStatus(place)
        out.append((path, status.getLen(), status.getModificationTime()))
    return tuple(out)
