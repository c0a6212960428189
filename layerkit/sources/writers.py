"""Parquet and CSV sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from layerkit.functions.columns import moment_text
from layerkit.schemas import DATE_FORMAT
from layerkit.session import relieve
from layerkit.sources.files import store_schema


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition value meet in few tasks, whose size adaptive execution evens out.

    A task that holds every value writes a file for each, so files grow with
    tasks times values. Rebalanced rows make a file or two a value; a value
    with more data than ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` is
    split into as many files as that asks for, small ones share a task.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def write_layer(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), incremental: bool = False, observe: Mapping[str, Column] | None = None,
    keep_schema: bool = True, rebalance: bool = True,
) -> int | dict[str, int]:
    """Overwrite a Parquet table and return the number of rows written.

    A full refresh replaces the whole table, so partitions missing from the new
    data disappear. ``incremental`` replaces only the partitions present in it.
    The count is observed by the write itself and costs no second job. With
    ``observe``, further aggregates are observed too and all come as a mapping,
    the count under ``rows``. The schema is kept beside the files, so that a table
    without any can be read. ``rebalance`` is turned off for rows that come from
    files by partition, of which a task has few values as they stand.
    """
    seen = Observation()
    watched = [c.alias(name) for name, c in (observe or {}).items()]
    schema = df.schema
    noted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *watched)
    writer = (clustered(noted, partition_by) if partition_by and rebalance else noted).write.mode("overwrite")
    # Denser than the default codec: what is written is written and read over the network.
    writer = writer.option("partitionOverwriteMode", "dynamic" if incremental else "static").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if keep_schema:
        # Partition columns come last when files are read.
        fields = [f for f in schema if f.name not in partition_by] + [f for f in schema if f.name in partition_by]
        store_schema(df.sparkSession, path, StructType(fields))
    found = {"rows": 0, **{name: 0 for name in observe or {}}, **observed(seen)}
    relieve(df.sparkSession)
    return found["rows"] if observe is None else found


def observed(seen: Observation) -> dict[str, int]:
    """What was observed; nothing if the plan turned out to be empty at run time and its observing part was left out."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in error.java_exception.toString():
            raise
        return {}


def write_csv(df: DataFrame, path: str) -> None:
    """Headed CSV in the dialect of RFC 4180; NULL becomes an empty field.

    Quotes are doubled and blanks kept. A fraction of a second is written where
    there is one.
    """
    moments = {f.name: moment_text(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, TimestampType)}
    (
        (df.withColumns(moments) if moments else df)
        .write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
        .option("dateFormat", DATE_FORMAT)
        .csv(path)
    )
