"""Small JSON records beside the data, on whatever file system Spark writes to."""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class RecordConflict(RuntimeError):
    """Another writer stored the record first."""


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def uri(spark: SparkSession, path: str) -> str:
    """Return the full URI of a path, as other readers than Spark's want it."""
    fs, hadoop = _path(spark, path)
    found = fs.makeQualified(hadoop).toUri().toString()
    local = found.startswith("file:/") and not found.startswith("file://")
    return f"file://{found[5:]}" if local else found


def names(spark: SparkSession, folder: str) -> list[str]:
    """Return the sorted names in a folder, or nothing if it does not exist."""
    fs, path = _path(spark, folder)
    if not fs.exists(path):
        return []
    found = [status.getPath().getName() for status in fs.listStatus(path)]
    return sorted(name for name in found if not name.startswith((".", "_")))


def create(spark: SparkSession, path: str, value: dict[str, Any]) -> None:
    """Write a new record. Never overwrites: of two writers only one succeeds.

    The record gets its name once its content is written, so a reader sees all of it or nothing.
    """
    fs, target = _path(spark, path)
    _, draft = _path(spark, f"{target.getParent()}/.draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(value), "utf-8"))
    finally:
        stream.close()
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    never_over = spark.sparkContext._gateway.new_array(kind, 0)
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        files.rename(fs.makeQualified(draft), fs.makeQualified(target), never_over)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if fs.exists(target):
            raise RecordConflict(f"{path} was written by another load") from error
        raise


def read(spark: SparkSession, path: str) -> dict[str, Any]:
    fs, target = _path(spark, path)
    size = fs.getFileStatus(target).getLen()
    stream = fs.open(target)
    try:
        body = spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)
    finally:
        stream.close()
    return json.loads(bytes(body)[:size].decode("utf-8"))
