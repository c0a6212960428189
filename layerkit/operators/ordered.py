"""Numbering and neighbour access over ordered rows, without oversized tasks.

A window gathers each group in one task. That is the right plan while groups
are small, and the wrong one when a single key holds a large share of the
table or when there is no key at all. Groups found to be heavy are sorted
across the cluster instead: range partitioning over the full sort order cuts
them into even slices, slice sizes give every row its global number, and slices
hand the rows at their edges to the next ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerkit.operators.rowid import ROW_ID, with_row_id
from layerkit.sources.scratch import settle, settle_by, sized

GROUP_ROWS = 5_000_000
SINGLE_TASK_ROWS = 1_000_000
SLICE_ROWS = 2_000_000
SAMPLE_ROWS = 500


def _named(df: DataFrame, from_files: bool) -> DataFrame:
    """Rows with their identity, which breaks ties alike in every plan.

    What is not a plain scan is written here, so it is computed once only.
    """
    return df if ROW_ID in df.columns else with_row_id(df, from_files)


def _kept(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ROW_ID]


def _order(order_by: Sequence[str], total: bool = False) -> list[Column]:
    """Sort order; rows that tie on it follow stored position, unless it leaves no ties."""
    return [*[F.col(c).asc_nulls_first() for c in order_by], *([] if total else [F.col(ROW_ID).asc()])]


def named_rows(df: DataFrame, from_files: bool = False) -> tuple[DataFrame, int]:
    """Rows with their identity, and their number, which the write that names them counts."""
    if from_files or ROW_ID in df.columns:
        named = _named(df, from_files)
        return named, named.count()
    stored, rows = settle(df)
    return with_row_id(stored, from_files=True), rows


def heavy_groups(df: DataFrame, keys: Sequence[str], group_rows: int = GROUP_ROWS, rows: int | None = None) -> DataFrame | None:
    """Hashes ``__h`` of the keys whose groups are too large for one task.

    The limit is the same at every size of the table. The answer only chooses a
    plan, so it may come from a sample: both plans give the same rows. It is a
    written table, broadcast if it measured small; None if no group is heavy.
    ``rows`` spares the count where it is known.
    """
    if (df.count() if rows is None else rows) <= group_rows:
        return None
    fraction = min(1.0, SAMPLE_ROWS / group_rows)
    counted = df.select(F.xxhash64(*keys).alias("__h")).sample(fraction, seed=11).groupBy("__h").count()
    found = sized(counted.filter(F.col("count") > group_rows * fraction / 2).select("__h"))
    return found.df if found.rows else None


def _split(df: DataFrame, keys: Sequence[str], group_rows: int, rows: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    heavy = heavy_groups(df, keys, group_rows, rows)
    if heavy is None:
        return df, None
    hashed = df.withColumn("__h", F.xxhash64(*keys))
    return hashed.join(heavy, "__h", "left_anti").drop("__h"), hashed.join(heavy, "__h", "left_semi").drop("__h")


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    condition = F.lit(True)
    for mine, theirs in pairs:
        condition = condition & left[mine].eqNullSafe(right[theirs])
    return condition


def _sliced(named: DataFrame, order: Sequence[Column], slices: int) -> DataFrame:
    """Rows range-partitioned over the order, sorted, with their slice ``__slice`` and place ``__at`` in it.

    Range bounds are sampled per job, so the slices are written before anyone
    counts them; by slice, so that a window over a slice finds it in place.
    """
    cut = named.repartitionByRange(slices, *order).sortWithinPartitions(*order).withColumns(
        {
            "__slice": F.spark_partition_id(),
            "__at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    return settle_by(cut.drop(ROW_ID), "__slice", slices)


def _offsets(ranged: DataFrame) -> DataFrame:
    """Rows before each slice: one row per slice, so neither the window nor a broadcast of it can grow."""
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.groupBy("__slice")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__slice", "__n", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )


def _slices(named: DataFrame, rows: int | None = None) -> int:
    width = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(width, (named.count() if rows is None else rows) // SLICE_ROWS)


def sliced_number(
    df: DataFrame, order_by: Sequence[str], name: str, from_files: bool = False, slices: int | None = None
) -> DataFrame:
    """Dense 1..N numbers in the given order, from evenly sized sorted slices."""
    named = _named(df, from_files)
    ranged = _sliced(named, _order(order_by), slices or _slices(named))
    return (
        ranged.join(F.broadcast(_offsets(ranged).drop("__n")), "__slice")
        .withColumn(name, F.col("__before") + F.col("__at") + 1)
        .drop("__slice", "__at", "__before")
    )


def sliced_neighbour(
    named: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, name: str, step: int, slices: int | None = None
) -> DataFrame:
    """``value`` of the row ``step`` places on in the same group, however large groups are.

    Rows are range-partitioned once. A slice finds neighbours within itself by a
    window; for the rows next to its end it needs the first (for a negative step,
    the last) ``step`` rows of what follows. Those edge rows, a few for each
    slice, are broadcast. A group that lies over many slices hands its edges from
    one to the next.
    """
    kept = [c for c in named.columns if c != ROW_ID]
    grouped = [F.col(k).asc_nulls_first() for k in keys]
    ranged = _sliced(named, [*grouped, *order], slices or _slices(named))
    there = F.struct(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(value).alias("__value"))
    inside = Window.partitionBy("__slice").orderBy("__at")
    placed = ranged.join(F.broadcast(_offsets(ranged)), "__slice").withColumn("__number", F.col("__before") + F.col("__at"))
    # Slices may be short, so edges are looked up by number and not by slice.
    at_edge = F.col("__at") < step if step > 0 else F.col("__n") - F.col("__at") <= -step
    edges = sized(placed.filter(at_edge).select(F.col("__number").alias("__edge"), there.alias("__over"))).df
    near = placed.withColumn("__near", F.lead(there, step).over(inside))
    out = F.col("__at") + step >= F.col("__n") if step > 0 else F.col("__at") < -step
    met = near.withColumn("__match", F.when(out, F.col("__number") + step)).join(edges, F.col("__match") == F.col("__edge"), "left")
    found = F.when(out, F.col("__over")).otherwise(F.col("__near"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__found.__k_{k}"))
    return met.withColumn("__found", found).select(
        *kept, F.when(F.col("__found").isNotNull() & same, F.col("__found.__value")).alias(name)
    )


def surrogate_key(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    from_files: bool = False,
    single_task_rows: int = SINGLE_TASK_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Dense ``bigint`` key 1..N; one window when the table is known to be small.

    Rows that tie are numbered by stored position, in the window and in slices.
    ``rows`` spares the count where it is known.
    """
    named, counted = (_named(df, from_files), rows) if rows is not None else named_rows(df, from_files)
    if counted > single_task_rows:
        return sliced_number(named, order_by, name)
    return named.withColumn(name, F.row_number().over(Window.orderBy(*_order(order_by))).cast("long")).drop(ROW_ID)


def rank_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    name: str,
    from_files: bool = False,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``row_number`` per key; NULL keys form one group, ties follow stored position."""
    light, heavy = _split(_named(df, from_files), keys, group_rows)
    window = Window.partitionBy(*keys).orderBy(*_order(order_by))
    ranked = light.withColumn(name, F.row_number().over(window).cast("long")).drop(ROW_ID)
    if heavy is None:
        return ranked
    numbered = sliced_number(heavy, [*keys, *order_by], "__number")
    # At most one row per heavy key, and heavy keys are few.
    starts = sized(numbered.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(F.min("__number").alias("__start"))).df
    joined = numbered.join(starts, _same(numbered, starts, [(k, f"__k_{k}") for k in keys]))
    return ranked.unionByName(
        joined.select(*_kept(df), (F.col("__number") - F.col("__start") + 1).alias(name))
    )


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    name: str,
    step: int = 1,
    from_files: bool = False,
    group_rows: int = GROUP_ROWS,
    rows: int | None = None,
    total: bool = False,
) -> DataFrame:
    """``value`` of the row ``step`` places later (earlier if negative) in its group.

    Rows that tie on the order follow stored position; ``total`` says that none
    do, so rows need no identity. ``rows`` spares the count where it is known.
    """
    if total:
        named, counted = df, df.count() if rows is None else rows
    else:
        named, counted = (_named(df, from_files), rows) if rows is not None else named_rows(df, from_files)
    light, heavy = _split(named, keys, group_rows, counted)
    order = _order(order_by, total)
    near = light.withColumn(name, F.lead(value, step).over(Window.partitionBy(*keys).orderBy(*order))).drop(ROW_ID)
    return near if heavy is None else near.unionByName(sliced_neighbour(heavy, keys, order, value, name, step))
