"""Calendar tables and schedules over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.functions import date_key


def calendar(spans: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per day of each span, with key, names, parts and weekend flag."""
    days = spans.select(F.explode(F.sequence(first.cast("date"), last.cast("date"))).alias("full_date"))
    day = F.col("full_date")
    weekday = F.weekday(day) + 1  # Monday is 1
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.dayofmonth(day).cast("short").alias("day"),
        F.month(day).cast("short").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).cast("short").alias("quarter"),
        F.year(day).cast("short").alias("year"),
        weekday.cast("short").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
    )


def even_schedule(df: DataFrame, opened: str, first: Column, last: Column, times: int, name: str) -> DataFrame:
    """``times`` evenly spaced days from opening to ``last``, both included.

    Positions are computed, so no row is joined with the calendar's days. Rows
    with fewer than ``times`` days left get no schedule.
    """
    start = F.greatest(F.col(opened), first.cast("date"))
    days = F.date_diff(last.cast("date"), start) + 1
    step = F.posexplode(F.array_repeat(F.lit(0), times)).alias("__step", "__unused")
    offset = (
        F.lit(0)
        if times == 1
        else F.call_function("div", F.col("__step") * (F.col("__days") - 1), F.lit(times - 1)).cast("int")
    )
    return (
        df.withColumns({"__start": start, "__days": days})
        .filter(F.col("__days") >= times)
        .select("*", step)
        .withColumn(name, F.date_add("__start", offset))
        .drop("__start", "__days", "__step", "__unused")
    )
