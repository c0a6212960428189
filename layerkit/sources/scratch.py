"""Intermediate tables in the shared checkpoint folder.

Written tables cut the lineage: a lost executor re-reads files instead of
recomputing, and every later pass sees the same rows in the same places.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DecimalType, MapType, StringType, StructType, VarcharType

from layerkit.session import catalogued, scratch_path
from layerkit.sources.writers import write_layer

# What a task can hold of a broadcast side, as rows of the join's hash table.
BROADCAST_BYTES = 64 << 20
# Bytes that a row of such a table takes besides its values.
ROW_OVERHEAD = 32
# And what the table adds for it: lengths, the address of the next row and two to four words of its index.
TABLE_OVERHEAD = 56


def _value_bytes(value: Column, kind: DataType) -> Column:
    """Bytes of a value beyond its eight-byte slot."""
    if isinstance(kind, (StringType, VarcharType, BinaryType)):
        return F.coalesce(F.octet_length(value).cast("long"), F.lit(0))
    if isinstance(kind, StructType):
        return _fields_bytes([(value[f.name], f.dataType) for f in kind])
    if isinstance(kind, (ArrayType, MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.array(value))).cast("long"), F.lit(0))
    return F.lit(16 if isinstance(kind, DecimalType) and kind.precision > 18 else 0)


def _fields_bytes(fields: list[tuple[Column, DataType]]) -> Column:
    return reduce(lambda a, b: a + b, [_value_bytes(c, kind) + 8 for c, kind in fields], F.lit(0).cast("long"))


def row_bytes(df: DataFrame) -> Column:
    """Bytes that a row takes in memory, by its own values."""
    return _fields_bytes([(F.col(f"`{f.name}`"), f.dataType) for f in df.schema]) + ROW_OVERHEAD


def settle(df: DataFrame) -> tuple[DataFrame, int]:
    """Write ``df`` once; return the stored table and its number of rows."""
    path = scratch_path(df.sparkSession, "settled")
    rows = write_layer(df, path, keep_schema=False)
    return df.sparkSession.read.schema(df.schema).parquet(path), rows


def settle_by(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """Write ``df`` once in buckets of a column; grouping or ordering by that column then needs no shuffle.

    Bucketed files belong to a table of the session's catalogue, here one of a
    name of its own over a scratch folder.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "bucketed")
    name = f"layerkit_{path.rsplit('-', 1)[1]}"
    catalogued.append(name)
    df.write.mode("overwrite").bucketBy(buckets, column).option("path", path).format("parquet").saveAsTable(name)
    return spark.read.table(name)


@dataclass(frozen=True)
class Side:
    """A written join side, with a broadcast hint if it is ``small``."""

    df: DataFrame
    rows: int
    bytes: int
    small: bool


def sized(df: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> Side:
    """Settle a join side and broadcast it only when it measured small.

    Its bytes in memory are added up by the write itself, so long keys count for
    what they are. The driver builds the table of a broadcast, so its rows count
    with what the table adds for them. Above the bound the side joins by shuffle,
    where adaptive execution splits skewed keys.
    """
    path = scratch_path(df.sparkSession, "sized")
    seen = write_layer(df, path, keep_schema=False, observe={"bytes": F.sum(row_bytes(df))})
    stored, size = df.sparkSession.read.schema(df.schema).parquet(path), seen["bytes"] or 0
    small = size + TABLE_OVERHEAD * seen["rows"] <= broadcast_bytes and broadcast_bytes > 0
    return Side(F.broadcast(stored) if small else stored, seen["rows"], size, small)
