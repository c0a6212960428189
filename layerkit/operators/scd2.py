"""Valid-time versions: building, checking and looking them up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerkit.operators.ordered import GROUP_ROWS, neighbour
from layerkit.schemas import OPEN_END

BUCKET_DAYS = 31


def build_versions(
    history: DataFrame,
    key: str,
    start: str = "effective_from",
    end: str = "effective_to",
    current: str = "is_current",
    from_files: bool = False,
    group_rows: int = GROUP_ROWS,
    rows: int | None = None,
    number: str | None = None,
) -> DataFrame:
    """Close each version the day before the next one starts.

    Ends and current flags of the source are recomputed, which also closes gaps.
    ``number`` names a unique column in the order of versions, if there is one;
    ``rows`` is their number, if it is known.
    """
    order = [start] if number is None else [start, number]
    ahead = neighbour(history, [key], order, start, "__next", 1, from_files, group_rows, rows, number is not None)
    return ahead.withColumns(
        {end: F.date_sub("__next", 1), current: F.col("__next").isNull()}
    ).drop("__next")


def overlapping(
    versions: DataFrame,
    key: str,
    start: str = "effective_from",
    end: str = "effective_to",
    open_blocks: bool = False,
    from_files: bool = False,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Versions that start on or before the previous version's end.

    An open previous end is passed over, or with ``open_blocks`` treated as
    lasting for ever, which rejects every later version.
    """
    bound = F.coalesce(F.col(end), F.to_date(F.lit(OPEN_END))) if open_blocks else F.col(end)
    behind = neighbour(
        versions.withColumn("__end", bound), [key], [start], "__end", "__previous", -1, from_files, group_rows
    )
    return behind.filter(F.col(start) <= F.col("__previous")).drop("__end", "__previous")


def holds_on(day: Column, start: Column, end: Column) -> Column:
    """Closed interval test; a NULL end is open."""
    return (day >= start) & (end.isNull() | (day <= end))


def busiest_key(versions: DataFrame, key: str) -> int:
    """Largest number of versions of one key."""
    counted = versions.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.max("n")).first()[0] or 0


def version_on(
    df: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    take: Sequence[str],
    start: str = "effective_from",
    end: str = "effective_to",
    how: str = "inner",
    bucket_days: int | None = None,
    period_as: str | None = None,
) -> DataFrame:
    """Join each row to the version of its key that holds on ``day``.

    Rows of a key are compared with all its versions. When keys have many, set
    ``bucket_days``: time is swept in periods of that length. A version belongs to
    the period in which it starts, and versions still open where a period starts
    are carried into it, if the key is asked for in that period at all. A row then
    meets the versions of its own period, and hot keys spread over their periods.
    Versions may overlap or leave gaps. ``period_as`` keeps the row's period under
    that name: grouping by key, period and more then needs no further shuffle.
    """
    side = versions.select(F.col(key).alias("__key"), F.col(start).alias("__from"), F.col(end).alias("__to"), *take)
    if bucket_days is None:
        condition = df[key] == side["__key"]
        left = df
    else:
        period = lambda c: F.floor(F.unix_date(c) / F.lit(bucket_days)).cast("int")
        left = df.withColumn("__period", period(F.col(day)))
        asked = left.select(F.col(key).alias("__asked"), "__period").where("__period IS NOT NULL").distinct()
        begin = F.date_from_unix_date(F.col("__period") * bucket_days)
        still_open = (F.col("__from") < begin) & (F.col("__to").isNull() | (F.col("__to") >= begin))
        carried = asked.join(side, (F.col("__asked") == F.col("__key")) & still_open)
        own = side.withColumn("__side", period(F.col("__from")))
        side = own.unionByName(carried.withColumnRenamed("__period", "__side").drop("__asked"))
        condition = (left[key] == side["__key"]) & (left["__period"] == side["__side"])
    matched = left.join(side, condition & holds_on(left[day], side["__from"], side["__to"]), how)
    kept = [] if period_as is None else [left["__period"].alias(period_as)]
    return matched.select(*[left[c] for c in df.columns], *kept, *take)


def version_as_of(
    df: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    take: Sequence[str],
    start: str = "effective_from",
    how: str = "inner",
) -> DataFrame:
    """Latest version starting on or before ``day``; needs contiguous versions.

    Only distinct (key, day) pairs and version starts are ordered, so a group is
    bounded by the calendar however many rows or versions share a key. The rows
    themselves meet their version by equality.
    """
    days = df.select(F.col(key).alias("__key"), F.col(day).alias("__day")).distinct()
    starts = versions.groupBy(F.col(key).alias("__key"), F.col(start).alias("__day")).agg(
        F.max(F.struct(*take)).alias("__found")
    )
    line = Window.partitionBy("__key").orderBy("__day").rowsBetween(Window.unboundedPreceding, 0)
    # One row per key and day: a day that also starts a version sees that version.
    merged = (
        days.withColumn("__asked", F.lit(True))
        .unionByName(starts, allowMissingColumns=True)
        .groupBy("__key", "__day")
        .agg(F.max("__asked").alias("__asked"), F.max("__found").alias("__found"))
        .withColumn("__found", F.last("__found", ignorenulls=True).over(line))
        .filter("__asked AND __found IS NOT NULL")
    )
    condition = (df[key] == merged["__key"]) & (df[day] == merged["__day"])
    matched = df.join(merged, condition, how)
    return matched.select(*[df[c] for c in df.columns], *[F.col(f"__found.{c}").alias(c) for c in take])
