"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.operators.rowid import ROW_ID, with_row_id
from layerkit.sources.scratch import settle

# What separates words, and the runs between.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# Bitmaps grow with the keys that were counted, up to 32 MB.
KEY_BITS = 8
LEAST_BITS = 1 << 15
MOST_BITS = 1 << 28
DROPPED_ROWS = 1_000_000


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        name = f"{tempfile.mkdtemp(prefix='layerkit-code-')}/{package.name}"
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def mapped(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package, wherever workers run."""
    ship_code(df.sparkSession)
    return df.mapInArrow(function, schema)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of fewer rows for the jobs run inside, which bounds what a worker holds."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(docs: DataFrame, *columns: str) -> DataFrame:
    """Some columns of a stored table (see ``in_place``), with the row's file and position.

    Every pass over the result sees the same numbers, so rows can be told apart
    even where every column repeats.
    """
    row = F.col(ROW_ID)
    return with_row_id(docs.select(*columns), from_files=True).select(
        row["file"].alias("file"), row["at"].alias("at"), *columns
    )


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows named by ``(file, at)``.

    The list is written and counted. Up to a million rows of two longs, 16 MB,
    it is broadcast and the wide rows stay where they are; a longer list is
    joined by shuffle, on row numbers, which are even whatever the data.
    """
    kept, rows = settle(dropped.select(F.struct("file", "at").alias(ROW_ID)))
    kept = F.broadcast(kept) if rows <= DROPPED_ROWS else kept
    return with_row_id(docs, from_files=True).join(kept, ROW_ID, "left_anti").select(*docs.columns)


def bitmap_bits(keys: int) -> int:
    """Bits for a measured number of keys: a power of two, eight a key or more."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (KEY_BITS * max(keys, 1) - 1).bit_length()))


def key_bitmap(keys: DataFrame, column: str, count: int) -> bytes:
    """Bits by the measured number of keys, set for each key modulo their number.

    A set bit means perhaps, so what it lets pass must be joined exactly. Up to
    ``MOST_BITS / KEY_BITS`` keys, 33 million, at most one bit in eight is set;
    with more keys more passes.
    """
    bits = bitmap_bits(count)
    bit = F.pmod(F.col(column), F.lit(bits)) + 1
    parts = (
        keys.select(F.bitmap_bucket_number(bit).alias("part"), F.bitmap_bit_position(bit).alias("position"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("position").alias("bits"))
        .collect()
    )
    size = 4096  # bytes in one of Spark's bitmaps
    held = bytearray(bits // 8)
    for part in parts:
        start = (part["part"] - 1) * size
        held[start : start + size] = part["bits"]
    return bytes(held)


def _edges(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with the larger node first."""
    return (
        pairs.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def components(pairs: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of the links ``(a, b)``; root is the smallest node.

    Stars: each round ties the neighbours of a node to the smallest of them,
    first the larger neighbours, then the smaller ones, until nothing moves.
    Rounds grow with the logarithm of the longest chain. Every round is a table
    in the shared folder. Hubs meet joins on one key, which adaptive execution
    splits.
    """
    edges, rows = settle(_edges(pairs))
    mark = None
    while rows:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("hub"), F.least("a", "low").alias("low"))
        larger = both.where("b > a").join(least, F.col("a") == F.col("hub")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        larger = _edges(larger)
        low = larger.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("hub"), "low")
        smaller = larger.join(low, F.col("a") == F.col("hub")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges, rows = settle(_edges(smaller.union(low)))
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def global_rank(df: DataFrame, order: Sequence[Column], name: str, width: int | None = None) -> tuple[DataFrame, int]:
    """Number rows 0, 1, ... in the given order; also their count.

    Rows are range-partitioned over the whole order, so one value with many
    rows spreads over many tasks. Partition sizes, one row for each, give every
    row its number. Columns of ``order`` must leave only equal rows tied.
    """
    width = width or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices, rows = settle(
        df.repartitionByRange(width, *order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "__slice": F.spark_partition_id(),
                "__at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
    )
    counts = {r["__slice"]: r["n"] for r in slices.groupBy("__slice").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, starts = 0, [0] if not counts else []
    for part in range(max(counts, default=-1) + 1):
        starts.append(before)
        before += counts.get(part, 0)
    start = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("__slice") + 1)
    return slices.withColumn(name, start + F.col("__at")).drop("__slice", "__at"), rows
