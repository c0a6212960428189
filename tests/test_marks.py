"""Rows marked by their place, and rules above the broadcast bound that shuffle and write no wide row."""

import pytest
from pyspark.sql import functions as F

from layerkit.operators.marks import BLOCK_ROWS, Marks
from layerkit.operators.rowid import ROW_ID, with_row_id
from layerkit.operators.rules import FirstCopyRule, KnownKeyRule, RowRule, evaluate
from layerkit.sources import scratch


@pytest.fixture
def rows(spark, folder):
    """Six files of more than one block; NULL and repeated ids, a busy one, unknown accounts, a wide note."""
    number = F.col("id")
    tid = F.when(number % 13 == 0, F.lit(None)).when(number % 5 == 0, F.lit(-1)).otherwise(number - number % 2)
    spark.range(0, 7 * BLOCK_ROWS, 1, 6).select(
        tid.alias("tid"), F.when(number % 17 > 0, number % 101).alias("account"), (number % 3).alias("rank"), F.repeat(F.lit("w"), 50).alias("note"),
        "id",
    ).write.parquet(f"{folder}/rows")
    return spark.read.parquet(f"{folder}/rows")


def rules(spark):
    known = spark.range(101).filter("id % 10 <> 3").toDF("account")
    return [FirstCopyRule("TWICE", ("tid",), ("rank",)), RowRule("LOW", F.col("rank") < 1), KnownKeyRule("UNKNOWN", "account", known, "account")]


def reasons(judged):
    return sorted((r["id"], r["data_quality_reason"]) for r in judged.select("id", "data_quality_reason").collect())


def test_marks_are_exact(spark, rows):
    named = with_row_id(rows, from_files=True)
    marks = Marks.of(named.filter("id % 3 = 0 OR id < 70").select(ROW_ID).repartition(5))
    flagged = marks.flag(named, "marked")
    assert flagged.columns == [*named.columns, "marked"]
    assert flagged.filter("marked IS NULL OR marked <> (id % 3 = 0 OR id < 70)").count() == 0
    assert flagged.count() == rows.count()


def test_no_marked_row_and_too_many_blocks(spark, rows):
    named = with_row_id(rows, from_files=True)
    assert Marks.of(named.filter("id < 0").select(ROW_ID)).flag(named, "marked").filter("marked").count() == 0
    assert Marks.of(named.select(ROW_ID), most_bytes=1000) is None


def test_large_sets_shuffle_and_write_no_wide_row(spark, rows, monkeypatch):
    expected = reasons(evaluate(rows, rules(spark), from_files=True))
    monkeypatch.setattr(scratch.sized, "__defaults__", (0,))
    judged = evaluate(rows, rules(spark), from_files=True)
    assert reasons(judged) == expected
    # The judged rows are the scan itself, not a written copy of it.
    assert set(rows.inputFiles()) <= set(judged.inputFiles())
    # Few splits are spread by number; no join asks for a shuffle.
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "ENSURE_REQUIREMENTS" not in plan


def test_rows_too_many_to_mark_are_judged_alike(spark, rows, monkeypatch):
    expected = reasons(evaluate(rows, rules(spark), from_files=True))
    monkeypatch.setattr(scratch.sized, "__defaults__", (0,))
    monkeypatch.setattr(Marks.of, "__defaults__", (0,))
    assert reasons(evaluate(rows, rules(spark), from_files=True)) == expected


def test_rows_named_by_the_caller_are_judged_from_one_written_copy(spark, rows):
    """A joined input is not joined again by each rule."""
    named = with_row_id(rows, from_files=True).join(F.broadcast(spark.range(101).toDF("account")), "account", "left").select(*rows.columns, ROW_ID)
    judged = evaluate(named, rules(spark))
    assert not set(rows.inputFiles()) & set(judged.inputFiles())
    assert judged.columns == [*rows.columns, "data_quality_reason"]
    assert reasons(judged) == reasons(evaluate(rows, rules(spark), from_files=True))
