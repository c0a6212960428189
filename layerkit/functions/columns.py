"""Keys, codes, text forms and technical columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.schemas import DATE_FORMAT, SECOND_FORMAT


def run_time(at: datetime | None) -> Column:
    """The given run time, or the query's start time."""
    return F.current_timestamp() if at is None else F.lit(at)


def stamped(df: DataFrame, name: str, at: datetime | None = None) -> DataFrame:
    return df.withColumn(name, run_time(at))


def audited(df: DataFrame, run_id: str, system: str, at: datetime | None = None) -> DataFrame:
    """Mark a batch with its run id, source system and processing time."""
    return df.withColumns(
        {"load_run_id": F.lit(run_id), "source_system": F.lit(system), "processed_at": run_time(at)}
    )


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def key_year(key: Column) -> Column:
    """Year of a ``yyyymmdd`` key; integral division truncates."""
    return F.call_function("div", key, F.lit(10000)).cast("int")


def day_of(moment: Column) -> Column:
    """Calendar day of a timestamp or of its ISO text."""
    return F.to_date(moment)


def change_hash(*parts: Column) -> Column:
    """First 16 hex digits of SHA-256 over the ``|``-joined parts."""
    # concat_ws leaves NULLs out, which would shift the remaining parts.
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.substring(F.sha2(F.concat_ws("|", *texts), 256), 1, 16)


def coded(prefix: str, width: int, number: Column) -> Column:
    """Prefix plus zero-padded number, such as ``TXN-000042``."""
    return F.format_string(f"{prefix}%0{width}d", number)


def bool_text(flag: Column) -> Column:
    return flag.cast("string")


def date_text(day: Column) -> Column:
    return F.coalesce(F.date_format(day, DATE_FORMAT), F.lit(""))


def moment_text(moment: Column) -> Column:
    """Timestamp in ISO form, with microseconds only where there are any."""
    fraction = F.when(moment != F.date_trunc("second", moment), F.date_format(moment, ".SSSSSS")).otherwise("")
    return F.concat(F.date_format(moment, SECOND_FORMAT), fraction, F.lit("Z"))


def earliest_allowed(*days: Column) -> Column:
    """Latest of several lower bounds."""
    return F.greatest(*days)


def join_reasons(flags: Sequence[Column], separator: str) -> Column:
    """Non-NULL reasons in the given order; empty text when there are none."""
    return F.concat_ws(separator, *flags)
