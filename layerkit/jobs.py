"""``spark-submit`` entry point: one stage or the whole run.

    spark-submit submit.py all --root s3a://lake --jdbc-url jdbc:postgresql://... \\
        --jdbc user=... --jdbc driver=org.postgresql.Driver --split transactions=transaction_id

A secret belongs in a properties file, not on the command line: pass it to
spark-submit as ``--conf spark.layerkit.jdbc.password=...`` there.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.layout import Layout
from layerkit.operators.reports import enforce
from layerkit.plans import medallion
from layerkit.schemas import REASON_SEPARATOR, TABLES, contract
from layerkit.session import build_session, drop_scratch
from layerkit.sources.readers import JdbcSource, read_csv, source_ready

STAGES = ("ready", "validate", "bronze", "silver", "dimensions", "fact", "validation", "all")
SECRET_PREFIX = "spark.layerkit.jdbc."


def _pairs(items: Sequence[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="layerkit")
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("--root", required=True, help="root of the layer tables")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--split", action="append", default=[], metavar="TABLE=COLUMN")
    parser.add_argument("--partitions", type=int, default=64)
    parser.add_argument("--csv-root", help="read headed CSV extracts instead of JDBC tables")
    parser.add_argument("--single-line", action="store_true", help="the extracts have no quoted line breaks, so a file is read by many tasks")
    parser.add_argument("--expect", action="append", default=[], metavar="NAME=ROWS:SQL", help="rows of the source transactions that meet a predicate")
    parser.add_argument("--known", metavar="SQL", help="source transactions that may have defects; all others must have none")
    parser.add_argument("--reason", action="append", default=[], metavar="ID=REASON|REASON", help="why a known bad transaction must be in quarantine")
    parser.add_argument("--run-id", help="keep reports under this id; a run started again under it takes up where it stopped")
    parser.add_argument("--attempts", type=int, default=2)
    parser.add_argument("--wait", type=float, default=120.0, help="seconds before a stage is tried again")
    return parser.parse_args(argv)


def reader(spark: SparkSession, args: argparse.Namespace) -> medallion.Reader:
    if args.csv_root:
        return lambda session, table: read_csv(session, f"{args.csv_root}/{table}.csv", contract(table), not args.single_line)
    if not args.jdbc_url:
        raise SystemExit("give --jdbc-url or --csv-root")
    held = {k[len(SECRET_PREFIX):]: v for k, v in spark.sparkContext.getConf().getAll() if k.startswith(SECRET_PREFIX)}
    return JdbcSource(args.jdbc_url, {**_pairs(args.jdbc), **held}, _pairs(args.split), args.partitions).read


def expected_rows(items: Sequence[str]) -> dict[str, tuple[Column, int]] | None:
    """``NAME=ROWS:SQL`` as predicates with the number of rows that meet them."""
    split = [(name, *rest.split(":", 1)) for name, rest in (item.split("=", 1) for item in items)]
    return {name: (F.expr(sql), int(rows)) for name, rows, sql in split} or None


def expected_reasons(items: Sequence[str]) -> dict[int, list[str]] | None:
    return {int(identity): reasons.split(REASON_SEPARATOR) for identity, reasons in _pairs(items).items()} or None


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    layout = Layout(args.root)
    expected, reasons = expected_rows(args.expect), expected_reasons(args.reason)
    known = None if args.known is None else F.expr(args.known)
    if args.stage == "silver":
        return medallion.silver(spark, layout, reasons=reasons)
    if args.stage == "dimensions":
        return medallion.gold_dimensions(spark, layout)
    if args.stage == "fact":
        return medallion.gold_fact(spark, layout)
    if args.stage == "validation":
        return medallion.gold_validation(spark, layout)
    read = reader(spark, args)
    if args.stage == "ready":
        return source_ready(spark, TABLES, read)
    if args.stage == "validate":
        return medallion.validate(spark, read, known)
    if args.stage == "bronze":
        return medallion.bronze(spark, layout, read, expected=expected)
    return medallion.run_all(
        spark, layout, read, expected=expected, reasons=reasons, known=known, run_id=args.run_id, attempts=args.attempts, wait=args.wait
    )


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"layerkit-{args.stage}")
    try:
        report = enforce(run(spark, args))
        report.show(report.count(), truncate=False)
    finally:
        drop_scratch(spark)
