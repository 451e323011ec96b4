"""Files of path tables, on whatever file system the path names."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _resolve(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none when there is no such folder."""
    target, fs = _resolve(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """Values of the integer partitions ``<column>=<value>`` in a folder, in order."""
    prefix = f"{column}="
    return sorted(int(n[len(prefix) :]) for n in names(spark, path) if n.startswith(prefix))


def touch(spark: SparkSession, path: str) -> None:
    target, fs = _resolve(spark, path)
    fs.create(target).close()


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _resolve(spark, path)
    fs.delete(target, True)


def write_new_json(spark: SparkSession, path: str, value: object) -> bool:
    """Write a small file that wasn't there; false if it was."""
    target, fs = _resolve(spark, path)
    if fs.exists(target):
        return False
    temporary, _ = _resolve(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    # A rename doesn't replace a file, so of several writers one succeeds and none sees half a file.
    if fs.exists(target) or not fs.rename(temporary, target):
        fs.delete(temporary, False)
        return False
    return True


def read_json(spark: SparkSession, path: str) -> object:
    target, fs = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
