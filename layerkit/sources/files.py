"""Small files on any Hadoop file system, read and written by the driver."""

from __future__ import annotations

import json
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

SCHEMA_FILE = "_layer_schema.json"


def _open(spark: SparkSession, path: str) -> tuple[Any, Any]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _caused_by(error: Py4JJavaError, *names: str) -> bool:
    cause = error.java_exception
    while cause is not None:
        if cause.getClass().getSimpleName() in names:
            return True
        cause = cause.getCause()
    return False


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds; none if it does not exist, or if its file system is not installed."""
    try:
        place, files = _open(spark, folder)
        return [status.getPath().getName() for status in files.listStatus(place)]
    except Py4JJavaError as error:
        if _caused_by(error, "FileNotFoundException", "ClassNotFoundException", "UnsupportedFileSystemException"):
            return []
        raise


def read_text(spark: SparkSession, path: str) -> str | None:
    """A file's whole text; None if there is none."""
    place, files = _open(spark, path)
    try:
        stream = files.open(place)
    except Py4JJavaError as error:
        if _caused_by(error, "FileNotFoundException"):
            return None
        raise
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """Write a file; without ``replace`` only where there is none, and say whether it was written."""
    place, files = _open(spark, path)
    try:
        stream = files.create(place, replace)
    except Py4JJavaError as error:
        if not replace and _caused_by(error, "FileAlreadyExistsException"):
            return False
        raise
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    return True


def remove(spark: SparkSession, path: str) -> None:
    place, files = _open(spark, path)
    files.delete(place, True)


def store_schema(spark: SparkSession, folder: str, schema: StructType) -> None:
    """Keep a table's schema beside its data files, which may be none."""
    write_text(spark, f"{folder}/{SCHEMA_FILE}", schema.json())


def stored_schema(spark: SparkSession, folder: str) -> StructType | None:
    text = read_text(spark, f"{folder}/{SCHEMA_FILE}")
    return None if text is None else StructType.fromJson(json.loads(text))
