"""Scans, sinks and column expressions."""

import csv
import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerkit.functions import bool_text, change_hash, coded, date_key, date_text, day_of, earliest_allowed, key_year
from layerkit.jobs import arguments, reader
from layerkit.layout import Layout
from layerkit.operators.calendar import calendar, even_schedule
from layerkit.operators.reports import CheckFailed, enforce, missing_keys, one_pass, static_report, unique
from layerkit.schemas import TABLES, business_columns, contract
from layerkit.session import build_session, checkpoint_dir, scratch_path
from layerkit.sources.readers import JdbcSource, read_csv, read_layer
from layerkit.sources.writers import write_csv, write_layer


def years(spark, *values):
    return spark.createDataFrame([(y, i) for i, y in enumerate(values)], "y INT, n INT")


def stored_years(spark, path):
    return sorted(r["y"] for r in spark.read.parquet(path).collect())


def test_full_refresh_drops_partitions_the_new_data_lacks(spark, folder):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        assert write_layer(years(spark, 2023, 2024, 2024), folder + "/t", ["y"]) == 3
        write_layer(years(spark, 2024), folder + "/t", ["y"])
        assert stored_years(spark, folder + "/t") == [2024]
        write_layer(years(spark, 2025), folder + "/t", ["y"], incremental=True)
        assert stored_years(spark, folder + "/t") == [2024, 2025]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_empty_table_is_written_and_counted(spark, folder):
    assert write_layer(years(spark, 2024).filter("y < 0"), folder + "/t") == 0
    assert spark.read.parquet(folder + "/t").columns == ["y", "n"]


def test_years_prune_partitions(spark, folder):
    write_layer(years(spark, 2023, 2024, 2025), folder + "/t", ["y"])
    df = read_layer(spark, folder + "/t", ["n"], years=[2024, 2025], year_column="y")
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "IN (2024,2025)]" in plan.split("PartitionFilters")[1]


def test_missing_column_is_named(spark, folder):
    write_layer(years(spark, 2023), folder + "/t")
    with pytest.raises(ValueError, match="amount"):
        read_layer(spark, folder + "/t", ["amount", "n"])


def test_csv_keeps_nulls_quotes_and_commas(spark, folder):
    schema = StructType.fromDDL("id INT, note STRING, day DATE, at TIMESTAMP, ok BOOLEAN")
    rows = [(1, 'a "b", c', date(2025, 1, 2), datetime(2025, 1, 2, 3, 4, 5), True), (2, None, None, None, None)]
    write_csv(spark.createDataFrame(rows, schema), folder + "/c")
    assert sorted(map(tuple, read_csv(spark, folder + "/c", schema).collect())) == rows
    text = "".join(r["value"] for r in spark.read.text(folder + "/c").collect())
    assert "2025-01-02T03:04:05Z" in text and "true" in text


def test_csv_keeps_blanks_quotes_and_line_breaks(spark, folder):
    schema = StructType.fromDDL("id INT, note STRING")
    notes = ["  a  ", 'a "q", b', "two\nlines", 'end, "', "back\\slash", '\\"', "tab\t"]
    write_csv(spark.createDataFrame(list(enumerate(notes)), schema), folder + "/c")
    assert [r["note"] for r in read_csv(spark, folder + "/c", schema).orderBy("id").collect()] == notes
    with open(f"{folder}/standard.csv", "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([["id", "note"], *enumerate(notes)])
    assert [r["note"] for r in read_csv(spark, f"{folder}/standard.csv", schema).orderBy("id").collect()] == notes


def test_malformed_csv_fails(spark, folder):
    spark.createDataFrame([("x",)], "id STRING").write.option("header", True).csv(folder + "/c")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|cannot"):
        read_csv(spark, folder + "/c", StructType.fromDDL("id INT")).collect()


def test_jdbc_options():
    source = JdbcSource("jdbc:x", {"user": "u"}, {"t": "id"}, partitions=8)
    assert source.options("s") == {"user": "u", "url": "jdbc:x", "dbtable": "s", "fetchsize": "10000"}
    assert source.bounds_query("t") == "(SELECT min(id) AS low, max(id) AS high FROM t) AS bounds"
    split = source.split_options("t", 1, 90)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "90", "8")


def test_job_arguments(spark):
    args = arguments(["bronze", "--root", "/r", "--jdbc-url", "jdbc:x", "--jdbc", "user=u", "--split", "transactions=transaction_id"])
    source = reader(spark, args).__self__
    assert source.properties == {"user": "u"} and source.split_on == {"transactions": "transaction_id"}
    with pytest.raises(SystemExit):
        reader(spark, arguments(["all", "--root", "/r"]))


def test_layout():
    layout = Layout("s3a://lake/")
    assert layout.bronze("t") == "s3a://lake/bronze/t"
    assert layout.quarantine("t") == "s3a://lake/quarantine/t"
    assert layout.dimension("d") == "s3a://lake/gold/dimensions/d"
    assert layout.fact("f") == "s3a://lake/gold/facts/f"


def test_session_and_scratch(spark):
    assert build_session("again") is not None
    assert scratch_path(spark, "x").startswith(checkpoint_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_contracts(spark):
    for table in TABLES:
        assert contract(table, audit=False).fieldNames() == business_columns(table)
        assert contract(table).fieldNames()[-3:] == ["load_run_id", "source_system", "processed_at"]


def test_column_expressions(spark):
    df = spark.createDataFrame([(7, date(2025, 12, 31), True, None, 20259999, "2025-01-02T23:59:59Z")], "n INT, d DATE, b BOOLEAN, e DATE, k INT, t STRING")
    row = df.select(
        date_key(F.col("d")), key_year(F.col("k")), key_year(F.lit(None).cast("int")), coded("BR", 3, F.col("n")), bool_text(F.col("b")),
        date_text(F.col("e")), date_text(F.col("d")), earliest_allowed(F.col("d"), F.lit("2026-01-01").cast("date")), day_of(F.col("t")),
        change_hash(F.lit("A"), F.lit("e@x"), F.lit(None).cast("string"), F.lit(7)),
    ).first()
    expected = hashlib.sha256(b"A|e@x||7").hexdigest()[:16]
    assert tuple(row) == (20251231, 2025, None, "BR007", "true", "", "2025-12-31", date(2026, 1, 1), date(2025, 1, 2), expected)


def test_calendar(spark):
    span = spark.createDataFrame([(date(2023, 1, 1), date(2025, 12, 31))], "a DATE, b DATE")
    days = calendar(span, F.col("a"), F.col("b"))
    assert days.count() == 1096
    assert tuple(days.orderBy("date_key").first()) == (20230101, date(2023, 1, 1), 1, 1, "January", 1, 2023, 7, "Sunday", True)
    assert [f.dataType.simpleString() for f in days.schema] == [f.dataType.simpleString() for f in contract("dim_date", audit=False)]


@pytest.mark.parametrize("times", [1, 4])
def test_schedule_matches_positions_in_the_calendar(spark, times):
    last = date(2025, 1, 31)
    accounts = spark.createDataFrame([(i, date(2025, 1, d)) for i, d in enumerate((1, 10, 28, 29, 31))] + [(9, date(2024, 5, 1))], "id INT, opened DATE")
    made = even_schedule(accounts, "opened", F.lit("2025-01-01"), F.lit(last), times, "day")
    found = sorted((r["id"], r["day"]) for r in made.collect())
    # Evenly spread over the days left in the month; accounts with fewer days than dates get none.
    by_hand = {
        1: {0: [1], 1: [10], 2: [28], 3: [29], 4: [31], 9: [1]},
        4: {0: [1, 11, 21, 31], 1: [10, 17, 24, 31], 2: [28, 29, 30, 31], 9: [1, 11, 21, 31]},
    }
    assert found == [(account, date(2025, 1, d)) for account, marks in by_hand[times].items() for d in marks]


def test_reports(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k INT")
    assert unique(df, "t", ["k"]).first().asDict() == {
        "check": "unique_k", "subject": "t", "expected": 5, "actual": 3, "bad_rows": 2, "ok": False
    }
    parent = spark.createDataFrame([(1,)], "p INT")
    assert missing_keys(df, "k", parent, "p", "t").first()["bad_rows"] == 3  # NULL keys are missing too
    empty = one_pass(df.filter("k > 9"), "t", {"s": (F.lit(0), F.sum("k")), "n": (F.sum("k"), F.count(F.lit(1)))})
    assert all(r["ok"] for r in empty.collect())
    assert static_report(spark, []).count() == 0
    with pytest.raises(CheckFailed, match="s c: expected 1, found 2"):
        enforce(static_report(spark, [("c", "s", 1, 2)]))
