"""Checks as report rows ``(check, subject, expected, actual, bad_rows, ok)``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_FIELDS = (("check", pa.string()), ("subject", pa.string()), ("expected", pa.int64()), ("actual", pa.int64()))


class CheckFailed(AssertionError):
    """At least one report row is not ok."""


def _finish(df: DataFrame) -> DataFrame:
    bad = F.abs(F.col("actual") - F.col("expected"))
    return df.select(
        "check",
        "subject",
        F.col("expected").cast("long").alias("expected"),
        F.col("actual").cast("long").alias("actual"),
        bad.cast("long").alias("bad_rows"),
        F.col("actual").eqNullSafe(F.col("expected")).alias("ok"),
    )


def static_report(spark: SparkSession, rows: Sequence[tuple[str, str, int, int]]) -> DataFrame:
    """Report from values already known to the driver, such as row counts."""
    # An Arrow table becomes a local relation, which needs no job of its own.
    columns = zip(REPORT_FIELDS, zip(*rows)) if rows else ((name, []) for name in REPORT_FIELDS)
    table = pa.table([pa.array(list(values), kind) for (_, kind), values in columns], [n for n, _ in REPORT_FIELDS])
    return _finish(spark.createDataFrame(table))


def one_pass(df: DataFrame, subject: str, checks: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """All (expected, actual) aggregates of a table in a single scan."""
    columns = []
    for position, (expected, actual) in enumerate(checks.values()):
        columns += [expected.cast("long").alias(f"e{position}"), actual.cast("long").alias(f"a{position}")]
    measured = df.agg(*columns)
    rows = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(subject).alias("subject"),
            # A sum over no rows is NULL.
            F.coalesce(F.col(f"e{position}"), F.lit(0)).alias("expected"),
            F.coalesce(F.col(f"a{position}"), F.lit(0)).alias("actual"),
        )
        for position, check in enumerate(checks)
    ]
    return _finish(measured.select(F.inline(F.array(*rows))))


def none_of(df: DataFrame, subject: str, bad: Mapping[str, Column]) -> DataFrame:
    """Each predicate must hold for no row."""
    return one_pass(df, subject, {name: (F.lit(0), F.count_if(test)) for name, test in bad.items()})


def same_count(subject: str, source: DataFrame, *targets: DataFrame, check: str = "row_count", weight: str | None = None) -> DataFrame:
    """Rows of the source equal the rows of all targets together.

    ``weight`` names a column of the targets with the rows that each row stands for.
    """
    rows = F.count(F.lit(1)) if weight is None else F.coalesce(F.sum(weight), F.lit(0))
    counts = [source.agg(F.count(F.lit(1)).alias("expected"), F.lit(0).cast("long").alias("actual"))]
    counts += [t.agg(F.lit(0).cast("long").alias("expected"), rows.alias("actual")) for t in targets]
    total = union(counts).agg(F.sum("expected").alias("expected"), F.sum("actual").alias("actual"))
    return _finish(total.select(F.lit(check).alias("check"), F.lit(subject).alias("subject"), "expected", "actual"))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; NULL is a key like any other."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def unique(df: DataFrame, subject: str, keys: Sequence[str], check: str | None = None, weight: str | None = None) -> DataFrame:
    """Distinct keys equal rows; copies of a hot key combine before the shuffle.

    ``weight`` names a column with the rows that each row stands for.
    """
    counted = df.groupBy(*keys).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n"))
    name = check or "unique_" + "_".join(keys)
    return one_pass(counted, subject, {name: (F.sum("n"), F.count(F.lit(1)))})


def missing_keys(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    subject: str,
    check: str = "orphans",
    weight: str | None = None,
) -> DataFrame:
    """Child rows whose key has no parent; a NULL key counts as missing.

    Keys are counted first, so the anti join sees each key once. ``weight``
    names a column with the rows that each child row stands for.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counted = child.groupBy(F.col(column).alias("__key")).agg(rows.alias("n"))
    known = parent.select(F.col(parent_column).alias("__key"))
    return one_pass(counted.join(known, "__key", "left_anti"), subject, {check: (F.lit(0), F.sum("n"))})


def missing_columns(df: DataFrame, required: Iterable[str]) -> set[str]:
    return set(required) - set(df.columns)


def column_rows(df: DataFrame, subject: str, required: Iterable[str]) -> list[tuple[str, str, int, int]]:
    """Column contract as report values; metadata only, no job over the table."""
    wanted = sorted(set(required))
    missing = missing_columns(df, wanted)
    return [("required_column", f"{subject}.{name}", 1, int(name not in missing)) for name in wanted]


def has_columns(df: DataFrame, subject: str, required: Iterable[str]) -> DataFrame:
    return static_report(df.sparkSession, column_rows(df, subject, required))


def union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def settled(report: DataFrame) -> tuple[DataFrame, bool]:
    """Run a report once: its rows, and whether all are ok. A report has a row per check."""
    rows = report.collect()
    values = [(r["check"], r["subject"], r["expected"], r["actual"]) for r in rows]
    return static_report(report.sparkSession, values), all(r["ok"] for r in rows)


def enforce(report: DataFrame) -> DataFrame:
    """Run a report once, raise if a check failed, and return its rows.

    A report has one row per check, so its rows fit the driver at any scale.
    """
    rows = report.collect()
    failed = [r for r in rows if not r["ok"]]
    if failed:
        lines = [f"{r['subject']} {r['check']}: expected {r['expected']}, found {r['actual']}" for r in failed]
        raise CheckFailed("; ".join(lines))
    return static_report(report.sparkSession, [(r["check"], r["subject"], r["expected"], r["actual"]) for r in rows])
