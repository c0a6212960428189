"""The seeded-defect bank through every layer."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import bank
from layerkit import jobs
from layerkit.layout import Layout
from layerkit.operators import checks, star
from layerkit.operators.quarantine import reasons_by_id
from layerkit.operators.reports import CheckFailed, enforce, static_report
from layerkit.plans import medallion
from layerkit.schemas import DUPLICATE, INVALID_CURRENCY, NEGATIVE_AMOUNT, TABLES, business_columns, contract
from layerkit.sources import writers
from layerkit.sources.readers import read_csv, source_ready
from layerkit.sources.writers import write_csv, write_layer

RUN = medallion.Run(at=bank.AT)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("lake")))
    identity = F.col("transaction_id")
    expected = {
        "repeated": (identity == 4, 2),
        "null_amount": ((identity == 6) & F.col("amount").isNull(), 1),
        "orphan": ((identity == 7) & (F.col("account_id") == 999), 1),
        "bad_row": ((identity == 8) & (F.col("amount") == -50) & (F.col("currency") == "XXX"), 1),
    }
    reasons = {4: [DUPLICATE], 6: ["NULL_AMOUNT"], 7: ["ORPHAN_ACCOUNT"], 8: [NEGATIVE_AMOUNT, INVALID_CURRENCY]}
    report = medallion.run_all(spark, layout, bank.reader, RUN, expected, reasons)
    return layout, report


def test_every_check_of_every_stage_passes(lake):
    _, report = lake
    assert report.filter(~F.col("ok")).count() == 0
    assert {r["stage"] for r in report.select("stage").distinct().collect()} == {
        "ready", "validate", "bronze", "silver", "dimensions", "fact", "validation"
    }


def test_defects_end_in_quarantine_with_their_reasons(spark, lake):
    layout, _ = lake
    valid = spark.read.parquet(layout.silver("transactions"))
    aside = spark.read.parquet(layout.quarantine("transactions"))
    assert sorted(r["transaction_id"] for r in valid.collect()) == [1, 2, 3, 4, 5]
    assert valid.filter("transaction_id = 4").first()["transaction_timestamp"].second == 0
    assert {r["transaction_id"]: r["reasons"] for r in reasons_by_id(aside, "transaction_id").collect()} == {
        4: "DUPLICATE_TRANSACTION_ID",
        6: "NULL_AMOUNT",
        7: "ORPHAN_ACCOUNT",
        8: "NEGATIVE_AMOUNT|INVALID_CURRENCY",
    }
    assert "silver_processed_at" not in aside.columns
    assert {"data_quality_reason", "quarantined_at"} <= set(aside.columns)


def test_silver_rows_stay_in_the_tasks_that_scan_bronze(spark, tmp_path, monkeypatch):
    layout, moved = Layout(str(tmp_path)), []
    enforce(medallion.bronze(spark, layout, bank.reader, RUN))
    clustered = writers.clustered
    monkeypatch.setattr(writers, "clustered", lambda df, by: moved.append(df.columns) or clustered(df, by))
    enforce(medallion.silver(spark, layout, RUN))
    assert moved == []
    stored = spark.read.parquet(layout.silver("transactions"))
    assert sorted(r["transaction_id"] for r in stored.collect()) == [1, 2, 3, 4, 5]
    assert "transaction_year" in stored.columns and "__row" not in stored.columns


def test_expected_reasons_are_reported(spark, lake):
    aside = spark.read.parquet(lake[0].quarantine("transactions"))
    wanted = {4: [DUPLICATE], 8: [NEGATIVE_AMOUNT, INVALID_CURRENCY], 6: [DUPLICATE]}
    report = checks.expected_reasons(aside, "transaction_id", wanted)
    assert {r["check"]: r["ok"] for r in report.collect()} == {
        f"4 {DUPLICATE}": True, f"8 {NEGATIVE_AMOUNT}": True, f"8 {INVALID_CURRENCY}": True, f"6 {DUPLICATE}": False
    }


def contents(spark, layout):
    """Every file of the published silver and gold tables."""
    tables = [layout.silver("transactions"), layout.quarantine("transactions"), layout.fact("fact_transaction"), layout.dimension("dim_customer")]
    return {str(p): p.read_bytes() for t in tables for p in sorted(Path(t).rglob("*")) if p.is_file()}


def test_a_failed_run_leaves_the_published_tables_as_they_were(spark, lake, monkeypatch):
    layout, _ = lake
    before = contents(spark, layout)
    bad = lambda *_, **__: static_report(spark, [("planted", "failure", 0, 1)])
    for suite, stage in (("fact_suite", medallion.gold_fact), ("clean_transactions", medallion.silver_routed), ("dimension_links", medallion.gold_dimensions)):
        with monkeypatch.context() as patch:
            patch.setattr(checks, suite, bad)
            with pytest.raises(CheckFailed, match="planted"):
                enforce(stage(spark, layout, RUN))
        assert contents(spark, layout) == before
    assert not [p for p in Path(layout.root).rglob("*__staged-*")]


def test_a_lookup_that_finds_nothing_stops_the_fact(spark, lake, folder):
    layout, _ = lake
    other = Layout(folder)
    used = spark.read.parquet(layout.silver("transactions")).first()["account_id"]
    for d in star.DIMENSIONS:
        df = spark.read.parquet(layout.dimension(d.name))
        write_layer(df.filter(F.col("account_id") != used) if d.name == "dim_account" else df, other.dimension(d.name))
    write_layer(spark.read.parquet(layout.silver("transactions")), other.silver("transactions"), ["transaction_year"])
    bad = {r["subject"] for r in medallion.gold_fact(spark, other, RUN).filter("NOT ok AND check = 'unresolved'").collect()}
    assert "fact_transaction.account_sk" in bad and not Path(other.fact("fact_transaction")).exists()


@pytest.mark.parametrize("table, change", [("loan_lifecycle", lambda df: df.withColumn("account_id", F.lit(12345))), ("customers", lambda df: df.union(df))])
def test_orphans_and_repeated_keys_stop_the_run_at_the_source(spark, folder, table, change):
    read = lambda s, t: change(bank.table(s, t)) if t == table else bank.table(s, t)
    with pytest.raises(CheckFailed, match=table):
        medallion.run_all(spark, Layout(folder), read, RUN)
    assert not Path(Layout(folder).bronze("accounts")).exists()


def test_many_versions_and_accounts_of_one_owner(spark):
    """Each row finds its version; nothing is expanded on the way."""
    count = 200
    days = spark.range(count).select(F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("day"), "id")
    dates = days.select(F.col("id").alias("date_sk"), F.col("id").cast("int").alias("date_key"), F.col("day").alias("full_date"))
    owner = days.select((F.col("id") + 1).alias("customer_sk"), F.lit(7).alias("customer_id"), F.col("day").alias("effective_from"),
                        F.when(F.col("id") < count - 1, F.col("day")).alias("effective_to"))
    accounts = spark.range(count).select(F.col("id").alias("account_sk"), F.col("id").cast("int").alias("account_id"), F.lit(7).alias("customer_id"), (F.col("id") % 1 + 1).cast("int").alias("branch_id"))
    branches = spark.createDataFrame([(1, 1)], "branch_sk LONG, branch_id INT")
    rows = spark.range(count * 10).select("id", (F.col("id") % count).cast("int").alias("account_id"), (F.col("id") * 7 % count).cast("int").alias("date_key"))
    found = star.resolve_transactions(rows, accounts, dates, branches, owner)
    assert found.filter("customer_sk = date_key + 1 AND account_sk = account_id AND branch_sk = 1").count() == count * 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_unresolved_rows_are_kept_or_dropped(spark, lake):
    layout, _ = lake
    sides = medallion._fact_sides(medallion.read_dimensions(spark, layout))
    source = spark.read.parquet(layout.silver("transactions"))
    assert star.resolve_transactions(source, *sides, on_unresolved="drop").count() == 5
    with pytest.raises(ValueError):
        star.resolve_transactions(source, *sides, on_unresolved="guess")


def test_columns_of_each_layer(spark, lake):
    layout, _ = lake
    bronze = spark.read.parquet(layout.bronze("transactions"))
    assert bronze.columns[-1] == "transaction_year" and dict(bronze.dtypes)["transaction_year"] == "int"
    assert {"bronze_ingested_at", "bronze_source_table", "load_run_id"} <= set(bronze.columns)
    customer = spark.read.parquet(layout.dimension("dim_customer"))
    assert customer.columns == ["customer_sk", *business_columns("customer_history"), "gold_processed_at"]
    fact = spark.read.parquet(layout.fact("fact_transaction"))
    assert fact.columns == [
        "transaction_id", "transaction_ref", "account_sk", "customer_sk", "branch_sk", "date_sk",
        "transaction_timestamp", "amount", "currency", "transaction_type", "channel", "gold_processed_at",
    ]


def test_versions_close_the_gap_and_facts_use_their_day(spark, lake):
    layout, _ = lake
    customer = spark.read.parquet(layout.dimension("dim_customer"))
    rows = {r["customer_sk"]: (r["customer_id"], r["effective_to"], r["is_current"]) for r in customer.collect()}
    assert rows == {1: (1, None, True), 2: (2, date(2025, 1, 31), False), 3: (2, None, True)}
    fact = spark.read.parquet(layout.fact("fact_transaction"))
    assert {r["transaction_id"]: r["customer_sk"] for r in fact.collect()} == {1: 1, 2: 3, 3: 1, 4: 1, 5: 2}


def test_second_run_from_csv_extracts_changes_nothing(spark, lake, folder):
    layout, _ = lake
    before = sorted(spark.read.parquet(layout.fact("fact_transaction")).collect())
    for name in TABLES:
        write_csv(bank.table(spark, name), f"{folder}/{name}.csv")
    read = lambda s, t: read_csv(s, f"{folder}/{t}.csv", contract(t))
    medallion.run_all(spark, layout, read, RUN)
    assert sorted(spark.read.parquet(layout.fact("fact_transaction")).collect()) == before


def test_transaction_before_the_first_version_fails_the_suite(spark, lake):
    layout, _ = lake
    dims = medallion.read_dimensions(spark, layout)
    late = dims["dim_customer"].withColumn("effective_from", F.greatest("effective_from", F.lit(date(2025, 2, 1))))
    dims = {**dims, "dim_customer": late.cache()}
    source = spark.read.parquet(layout.silver("transactions"))
    fact = star.build_fact(star.resolve_transactions(source, *medallion._fact_sides(dims)), bank.AT)
    bad = {r["check"]: r["bad_rows"] for r in checks.fact_suite(fact, source, dims).filter(~F.col("ok")).collect()}
    assert bad["null_customer_sk"] == 2 and bad["orphans"] == 2


def test_empty_source_stops_the_run(spark, folder):
    read = lambda s, t: bank.table(s, t, [] if t == "accounts" else None)
    with pytest.raises(CheckFailed, match="accounts source_ready"):
        medallion.run_all(spark, Layout(folder), read, RUN)


def test_missing_table_is_not_ready(spark, folder):
    report = source_ready(spark, ["x"], lambda s, t: s.read.parquet(f"{folder}/none"))
    assert [r["ok"] for r in report.collect()] == [False]


def test_stage_rejects_a_table_without_required_columns(spark, folder):
    layout = Layout(folder)
    write_layer(bank.table(spark, "branches").drop("city"), layout.bronze("branches"))
    with pytest.raises(ValueError, match="city"):
        medallion.silver_plain(spark, layout, "branches")


def test_source_checks_of_the_clean_bank(spark):
    tables = {t: bank.table(spark, t) for t in TABLES}
    known = F.col("transaction_id").isin(4, 6, 7, 8)
    reports = [
        checks.referential_integrity(tables, excused={"transactions": F.col("transaction_id") == 7}),
        checks.audit_nulls(tables),
        checks.no_other_defects(tables["transactions"], F.col("transaction_id").isin(2, 4, 6, 7, 8), tables["accounts"]),
        checks.no_other_defects(tables["transactions"], known, tables["accounts"], zero_allowed=True),
        checks.temporal_consistency(tables["transactions"], tables["accounts"], tables["customer_history"], known),
        *[checks.schema_conformance(df, name) for name, df in tables.items()],
        *[checks.not_null(df, name) for name, df in tables.items()],
    ]
    for report in reports:
        assert report.filter(~F.col("ok")).count() == 0
    assert checks.weights_sum_to_one(tables["account_customer_bridge"]).count() == 0
    zero = checks.no_other_defects(tables["transactions"], known, tables["accounts"])
    assert {r["check"]: r["bad_rows"] for r in zero.collect()}["amount"] == 1
    full = checks.referential_integrity(tables)
    assert {r["subject"] for r in full.filter(~F.col("ok")).collect()} == {"transactions.account_id -> accounts.account_id"}


def test_job_entry_point_runs_a_stage(spark, lake, capsys, monkeypatch):
    monkeypatch.setattr(jobs, "drop_scratch", lambda _: None)
    jobs.main(["validation", "--root", lake[0].root])
    assert "different_version" in capsys.readouterr().out
