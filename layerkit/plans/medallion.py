"""Bronze, silver and gold jobs; each writes its layer and returns its report."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit import layout as names
from layerkit.functions import key_year, stamped
from layerkit.functions.columns import run_time
from layerkit.layout import Layout
from layerkit.operators import checks
from layerkit.operators.lookup import lookup_guard
from layerkit.operators.quarantine import route
from layerkit.operators.reports import column_rows, enforce, same_count, settled, static_report, union
from layerkit.operators.rowid import with_row_id
from layerkit.operators.rules import FirstCopyRule, KnownKeyRule, RowRule, Rule, evaluated, not_in
from layerkit.operators.star import DIMENSIONS, FACT, Dimension, build_dimension, build_fact, resolve_transactions
from layerkit.schemas import (
    ALLOWED_CURRENCIES,
    AUDIT_COLUMNS,
    BRONZE_COLUMNS,
    DUPLICATE,
    GOLD_STAMP,
    INVALID_CURRENCY,
    NEGATIVE_AMOUNT,
    NULL_AMOUNT,
    ORPHAN_ACCOUNT,
    SILVER_STAMP,
    TABLES,
    YEAR_COLUMN,
    business_columns,
)
from layerkit.plans.ledger import Ledger
from layerkit.session import concurrently
from layerkit.sources.commits import Staging, publish_if
from layerkit.sources.readers import read_layer

Reader = Callable[[SparkSession, str], DataFrame]
ROUTED = "transactions"
PLAIN = tuple(t for t in TABLES if t != ROUTED)


@dataclass(frozen=True)
class Run:
    """Settings of one run. ``tie_break`` makes the kept copy of a key definite."""

    at: datetime | None = None
    allowed: tuple[str, ...] = ALLOWED_CURRENCIES
    tie_break: tuple[str, ...] = ()


def together(work: Callable[[str], list[tuple[str, str, int, int]]], names: Iterable[str]) -> list[tuple[str, str, int, int]]:
    """Report rows of independent tables."""
    return [row for rows in concurrently(work, names) for row in rows]


def bronze_columns(df: DataFrame, table: str, at: datetime | None = None) -> DataFrame:
    """Lineage columns, and the partition year for the routed table."""
    ingested, origin = BRONZE_COLUMNS
    landed = df.withColumns({ingested: run_time(at), origin: F.lit(table)})
    return landed.withColumn(YEAR_COLUMN, key_year(F.col("date_key"))) if table == ROUTED else landed


def _land(staging: Staging, read: Reader, run: Run, table: str) -> list[tuple[str, str, int, int]]:
    """Read a source table once and write it unseen; its rows as counted on the way and as stored."""
    source = read(staging.spark, table)
    name, subject = names.bronze(table), f"bronze.{table}"
    rows = staging.write(bronze_columns(source, table, run.at), name, [YEAR_COLUMN] if table == ROUTED else [])["rows"]
    stored = staging.read(name)
    return [("row_count", subject, rows, stored.count()), *column_rows(stored, subject, source.columns)]


def bronze(
    spark: SparkSession,
    layout: Layout,
    read: Reader,
    run: Run = Run(),
    tables: Iterable[str] = TABLES,
    expected: Mapping[str, tuple[Column, int]] | None = None,
) -> DataFrame:
    """Copy source tables as they are, all or none. ``expected`` counts known defects.

    Each source table is read once. If a check fails, or an error stops the
    copying, bronze stays as it was.
    """

    def build(staging: Staging) -> DataFrame:
        report = static_report(spark, together(lambda table: _land(staging, read, run, table), tables))
        if expected is None:
            return report
        return report.unionByName(checks.expectations(staging.read(names.bronze(ROUTED)), f"bronze.{ROUTED}", expected))

    return publish_if(spark, layout.root, build, settled)


def validate(spark: SparkSession, read: Reader, known: Column | None = None, run: Run = Run()) -> DataFrame:
    """Checks of the source that must hold before anything is copied.

    ``known`` marks transactions with expected defects; given it, no other may have any.
    """
    return checks.source_validation({table: read(spark, table) for table in TABLES}, ROUTED, known, run.allowed)


def landing(
    spark: SparkSession,
    layout: Layout,
    read: Reader,
    run: Run = Run(),
    expected: Mapping[str, tuple[Column, int]] | None = None,
    known: Column | None = None,
) -> dict[str, DataFrame]:
    """Readiness, validation and bronze from one read of each source table.

    Tables land unseen, the landed rows are validated, and only then bronze is
    published. The first report with a failed check raises.
    """
    staging = Staging(spark, layout.root)
    reports: dict[str, DataFrame] = {}

    def land(table: str) -> list[tuple[str, str, int, int]]:
        try:
            source = read(spark, table)
        except (AnalysisException, Py4JJavaError) as error:
            logging.getLogger(__name__).warning("%s is not ready: %s", table, error)
            return []
        return _land(staging, lambda *_: source, run, table)

    try:
        found = dict(zip(TABLES, concurrently(land, TABLES)))
        ready = [("source_ready", t, 1, int(staging.rows.get(names.bronze(t), 0) > 0)) for t in TABLES]
        reports["ready"] = enforce(static_report(spark, ready))
        landed = {t: staging.read(names.bronze(t)).drop(*BRONZE_COLUMNS, YEAR_COLUMN) for t in TABLES}
        reports["validate"] = enforce(validate(spark, lambda _, t: landed[t], known, run))
        copied = static_report(spark, [row for rows in found.values() for row in rows])
        if expected is not None:
            copied = copied.unionByName(checks.expectations(landed[ROUTED], f"bronze.{ROUTED}", expected))
        reports["bronze"] = enforce(copied)
        staging.publish()
        return reports
    finally:
        staging.discard()


def transaction_rules(accounts: DataFrame, run: Run = Run()) -> list[Rule]:
    """The five rules in the order their reasons are joined."""
    order = ("transaction_timestamp", "processed_at", *run.tie_break)
    return [
        FirstCopyRule(DUPLICATE, ("transaction_id",), order),
        RowRule(NULL_AMOUNT, F.col("amount").isNull()),
        KnownKeyRule(ORPHAN_ACCOUNT, "account_id", accounts, "account_id"),
        RowRule(NEGATIVE_AMOUNT, F.col("amount") < 0),
        RowRule(INVALID_CURRENCY, not_in("currency", run.allowed)),
    ]


def _bronze_table(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    required = [*business_columns(table), *AUDIT_COLUMNS, *BRONZE_COLUMNS]
    return read_layer(spark, layout.bronze(table), required)


def _pass_on(staging: Staging, layout: Layout, table: str, run: Run) -> list[tuple[str, str, int, int]]:
    """Write a table with a stamp; report that no row or column was lost."""
    source = _bronze_table(staging.spark, layout, table)
    subject = f"silver.{table}"
    staging.write(stamped(source, SILVER_STAMP, run.at), names.silver(table))
    stored = staging.read(names.silver(table))
    return [("row_count", subject, source.count(), stored.count()), *column_rows(stored, subject, source.columns)]


def _route(staging: Staging, layout: Layout, run: Run, reasons: Mapping[object, Sequence[str]] | None) -> DataFrame:
    """Evaluate the rules once, write valid rows and quarantine, and check both."""
    spark = staging.spark
    source = _bronze_table(spark, layout, ROUTED)
    accounts = staging.read(names.silver("accounts")).select("account_id")
    # Row ids given here keep every row in the task that scans it, which sees few years: bronze has a folder for each.
    result, moved = evaluated(with_row_id(source, from_files=True), transaction_rules(accounts, run))
    valid, quarantined = route(result, run.at)
    # Two passes over columnar files cost less than caching every wide row.
    kept = staging.write(valid, names.silver(ROUTED), [YEAR_COLUMN], rebalance=moved)["rows"]
    aside = staging.write(quarantined, names.quarantine(ROUTED))["rows"]
    stored, held = staging.read(names.silver(ROUTED)), staging.read(names.quarantine(ROUTED))
    parts = [
        static_report(spark, [("routed_rows", ROUTED, source.count(), kept + aside)]),
        same_count(ROUTED, source, stored, held, check="row_balance"),
        checks.clean_transactions(stored, accounts, allowed=run.allowed),
    ]
    if reasons:
        parts.append(checks.expected_reasons(held, "transaction_id", reasons))
    return union(parts)


def silver_plain(spark: SparkSession, layout: Layout, table: str, run: Run = Run()) -> list[tuple[str, str, int, int]]:
    """One plain table by itself."""
    report = publish_if(spark, layout.root, lambda staging: static_report(spark, _pass_on(staging, layout, table, run)), settled)
    return [(r["check"], r["subject"], r["expected"], r["actual"]) for r in report.collect()]


def silver_routed(
    spark: SparkSession, layout: Layout, run: Run = Run(), reasons: Mapping[object, Sequence[str]] | None = None
) -> DataFrame:
    """The routed table by itself: valid rows and quarantine, both or neither.

    ``reasons`` lists known bad ids with the reasons they must be held for.
    """
    return publish_if(spark, layout.root, lambda staging: _route(staging, layout, run, reasons), settled)


def silver(
    spark: SparkSession, layout: Layout, run: Run = Run(), reasons: Mapping[object, Sequence[str]] | None = None
) -> DataFrame:
    """All plain tables and the routed one, which needs the accounts; all are published, or none."""

    def build(staging: Staging) -> DataFrame:
        plain = together(lambda table: _pass_on(staging, layout, table, run), PLAIN)
        return static_report(spark, plain).unionByName(_route(staging, layout, run, reasons))

    return publish_if(spark, layout.root, build, settled)


def gold_dimensions(spark: SparkSession, layout: Layout, run: Run = Run()) -> DataFrame:
    """Build, write and check the four dimensions."""
    sources = {
        d.name: read_layer(spark, layout.silver(d.source), business_columns(d.source)) for d in DIMENSIONS
    }

    def build(staging: Staging) -> DataFrame:
        def write(dimension: Dimension) -> None:
            staging.write(build_dimension(dimension, sources[dimension.name], run.at, from_files=True), names.dimension(dimension.name))

        concurrently(write, DIMENSIONS)  # the suites below compare counts
        stored = {name: staging.read(names.dimension(name)) for name in sources}
        parts = []
        for dimension in DIMENSIONS:
            suite = checks.version_suite if dimension.version_start else checks.dimension_suite
            parts.append(suite(stored[dimension.name], dimension, sources[dimension.name]))
        links = checks.dimension_links(stored["dim_account"], stored["dim_branch"], stored["dim_customer"])
        return union([*parts, links])

    return publish_if(spark, layout.root, build, settled)


def read_dimensions(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    # What resolving a fact needs besides the keys.
    needed = {
        "dim_account": ["customer_id", "branch_id"], "dim_date": ["full_date"], "dim_customer": ["effective_from", "effective_to"]
    }
    return {
        d.name: read_layer(spark, layout.dimension(d.name), [d.surrogate, d.key, *needed.get(d.name, [])]) for d in DIMENSIONS
    }


def gold_fact(spark: SparkSession, layout: Layout, run: Run = Run(), on_unresolved: str = "keep") -> DataFrame:
    """Resolve and write the fact.

    Lookup guards and the suite run on the staged table. If one fails, the fact
    that stood before stays.
    """
    transactions = read_layer(spark, layout.silver(ROUTED), business_columns(ROUTED))
    dims = read_dimensions(spark, layout)
    resolved = resolve_transactions(transactions, *_fact_sides(dims), on_unresolved=on_unresolved)

    def build(staging: Staging) -> DataFrame:
        staging.write(build_fact(resolved, run.at), names.fact(FACT))
        stored = staging.read(names.fact(FACT))
        rows = transactions.count() if on_unresolved == "keep" else stored.count()
        guards = [lookup_guard(stored, rows, f"{FACT}.{key}", key) for key in ("account_sk", "date_sk", "branch_sk", "customer_sk")]
        return union([*guards, checks.fact_suite(stored, transactions, dims, run.allowed)])

    return publish_if(spark, layout.root, build, settled)


def _fact_sides(dims: dict[str, DataFrame]) -> Sequence[DataFrame]:
    return dims["dim_account"], dims["dim_date"], dims["dim_branch"], dims["dim_customer"]


def gold_validation(spark: SparkSession, layout: Layout) -> DataFrame:
    """Independent recheck of the stored fact."""
    fact = read_layer(spark, layout.fact(FACT), [GOLD_STAMP])
    source = read_layer(spark, layout.silver(ROUTED))
    return checks.fact_recheck(fact, source, read_dimensions(spark, layout))


def _rows(report: DataFrame) -> list[tuple[str, str, int, int]]:
    return [(r["check"], r["subject"], r["expected"], r["actual"]) for r in report.collect()]


def run_all(
    spark: SparkSession,
    layout: Layout,
    read: Reader,
    run: Run = Run(),
    expected: Mapping[str, tuple[Column, int]] | None = None,
    reasons: Mapping[object, Sequence[str]] | None = None,
    known: Column | None = None,
    run_id: str | None = None,
    attempts: int = 2,
    wait: float = 0.0,
) -> DataFrame:
    """Every stage in order; a failed report stops the run.

    ``expected`` counts known defects at the source, ``reasons`` says for what
    known bad ids must end in quarantine, ``known`` marks all rows that may have
    defects. A stage that fails by an error is tried ``attempts`` times in all,
    ``wait`` seconds apart. Reports are kept under ``run_id``: a run that was
    broken off and is started again under the same id takes up where it stopped.
    """
    ledger = Ledger(spark, layout.root, run_id or uuid.uuid4().hex)

    def one(name: str, stage: Callable[[], DataFrame]) -> Callable[[], dict[str, list[tuple[str, str, int, int]]]]:
        return lambda: {name: _rows(enforce(stage()))}

    bronze_tables, silver_tables = [names.bronze(t) for t in TABLES], [names.silver(t) for t in TABLES]
    stages: list[tuple[str, Callable, list[str]]] = [
        # Each source table is read once for the first three.
        ("bronze", lambda: {n: _rows(r) for n, r in landing(spark, layout, read, run, expected, known).items()}, bronze_tables),
        ("silver", one("silver", lambda: silver(spark, layout, run, reasons)), [*silver_tables, names.quarantine(ROUTED)]),
        ("dimensions", one("dimensions", lambda: gold_dimensions(spark, layout, run)), [names.dimension(d.name) for d in DIMENSIONS]),
        ("fact", one("fact", lambda: gold_fact(spark, layout, run)), [names.fact(FACT)]),
        ("validation", one("validation", lambda: gold_validation(spark, layout)), []),
    ]
    parts = []
    for stage, work, tables in stages:
        for name, rows in ledger.run(stage, work, tables, attempts, wait).items():
            parts.append(static_report(spark, rows).withColumn("stage", F.lit(name)))
    return union(parts)
