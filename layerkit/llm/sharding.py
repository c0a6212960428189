"""Sharding along a Hilbert curve, so that files prune on several dimensions.

Metadata dimensions are quantised to cells of a cube: numbers by the power of
two they lie in, categories by a hash. Rows are sorted by the cell's index on
the Hilbert curve, where neighbours on the curve are neighbours in every
dimension, and the order is cut into runs of equal row counts. A shard then
covers a small box of cells, and a reader skips the shards whose box its
conditions miss (``shard_boxes``).

The law is ``rows``: counts of shards differ by one at most. A hot source or a
group of equal texts fills as many shards as it has rows for, since the order
goes on by text checksum and doc_id within a cell. Rows are range-partitioned
over the whole order, and numbered by the sizes of partitions. Only DataFrame
functions are used, over one narrow table.

Defined cases: a null text counts as empty, a null category as a cell of its
own kind, a null number as 0. Repeated rows take neighbouring slots. An empty
table has no rows to place. Columns that the dimensions do not name are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.common import global_rank, table

SHARDS = 24
BITS = 5
ROW_BYTES = 8


def number_cell(value: Column, bits: int = BITS) -> Column:
    """The power of two that a number lies in, up to the last cell."""
    power = F.length(F.bin(F.greatest(F.coalesce(value, F.lit(0)), F.lit(0)).cast("long")))
    return F.least(power, F.lit((1 << bits) - 1)).cast("int")


def category_cell(value: Column, bits: int = BITS) -> Column:
    """A cell picked by checksum, so equal values share it; null has cell 0."""
    return F.coalesce(F.crc32(value.cast("binary")) % ((1 << bits) - 1) + 1, F.lit(0)).cast("int")


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def hilbert_index(cells: Sequence[Column], bits: int = BITS) -> Column:
    """Index of a cell on the Hilbert curve of ``len(cells)`` dimensions.

    Skilling's public method (2004): undo the curve's turns from the coarsest
    bit to the finest, Gray-decode across dimensions, then interleave the bits.
    """
    count = len(cells)

    def turn(level: int, which: int) -> Callable[[Column], Column]:
        """Undo one turn: flip the low bits of the first axis, or swap them with this one's."""
        low = F.lit((1 << level) - 1)

        def turned(axes: Column) -> Column:
            here = axes[which].bitwiseAND(F.lit(1 << level)) != 0
            swap = axes[0].bitwiseXOR(axes[which]).bitwiseAND(low)
            after = [axes[i] for i in range(count)]
            after[which] = F.when(here, axes[which]).otherwise(axes[which].bitwiseXOR(swap))
            after[0] = F.when(here, axes[0].bitwiseXOR(low)).otherwise(axes[0].bitwiseXOR(swap))
            return F.array(*after)

        return turned

    axes = F.array(*[c.cast("int") for c in cells])
    for level in range(bits - 1, 0, -1):
        for which in range(count):
            axes = _with(axes, turn(level, which))

    def decoded(axes: Column) -> Column:
        """Gray code: each axis takes the exclusive or with all before it."""
        done = [axes[0]]
        for axis in range(1, count):
            done.append(done[-1].bitwiseXOR(axes[axis]))
        return F.array(*done)

    def flipped(axes: Column) -> Column:
        fix = F.lit(0)
        for level in range(bits - 1, 0, -1):
            at = F.lit(1 << level)
            fix = fix.bitwiseXOR(F.when(axes[count - 1].bitwiseAND(at) != 0, F.lit((1 << level) - 1)).otherwise(0))
        return F.transform(axes, lambda a: a.bitwiseXOR(fix))

    def index(axes: Column) -> Column:
        total = F.lit(0).cast("long")
        for level in range(bits - 1, -1, -1):
            for axis in range(count):
                bit = F.shiftright(axes[axis], level).bitwiseAND(F.lit(1)).cast("long")
                total = total.bitwiseOR(F.shiftleft(bit, level * count + count - 1 - axis))
        return total

    return _with(_with(_with(axes, decoded), flipped), index)


def sharded(rows: DataFrame, cells: dict[str, Column], then: Sequence[str], shards: int = SHARDS) -> DataFrame:
    """``rows`` with cells, ``curve``, ``shard`` and ``slot``, in the order of the curve.

    ``then`` orders rows within a cell and should leave only equal rows tied.
    Pass narrow rows: they are sorted and written once.
    """
    placed = rows.withColumns(cells)
    placed = placed.withColumn("curve", hilbert_index([F.col(c) for c in cells]))
    ranked, count = global_rank(placed, [F.col("curve").asc(), *[F.col(c).asc_nulls_first() for c in then]], "__rank")
    if not count:
        return ranked.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}).drop("__rank")
    shard = F.floor(F.expr(f"__rank * {shards} div {count}")).cast("int")
    begin = F.expr(f"(shard * {count}L + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", shard).withColumn("slot", (F.col("__rank") - begin).cast("long")).drop("__rank")


def shard_boxes(placed: DataFrame, cells: Sequence[str]) -> DataFrame:
    """The smallest and largest cell of each shard in each dimension, for pruning."""
    ends = [f(c).alias(f"{name}_{c}") for c in cells for name, f in (("low", F.min), ("high", F.max))]
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *ends)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards along the curve of source, language and length."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        "source",
        "lang",
    )
    cells = {
        "source_cell": category_cell(F.col("source")),
        "lang_cell": category_cell(F.col("lang")),
        "size_cell": number_cell(F.col("size")),
    }
    placed = sharded(rows, cells, ["text_crc32", "doc_id", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), *cells, "curve"
    )
