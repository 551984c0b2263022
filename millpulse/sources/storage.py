"""Small files and folders on whatever file system Spark uses."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none when there is no such folder."""
    fs, folder = _at(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(folder))


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.delete(target, True)


def write_json(spark: SparkSession, path: str, value: object) -> None:
    """Write a small file whole: it is written beside its place and then moved there."""
    fs, target = _at(spark, path)
    _, beside = _at(spark, f"{path}.new")
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(beside, target):
        raise OSError(f"cannot move {path}.new into place")


def read_json(spark: SparkSession, path: str) -> object:
    fs, target = _at(spark, path)
    stream = fs.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
