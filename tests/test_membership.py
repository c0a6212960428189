"""Filters of large sets of offending keys, and broadcasts by measured bytes."""

import pytest
from pyspark.sql import functions as F

from layerkit.operators import membership
from layerkit.operators.lookup import dimension_lookup
from layerkit.operators.membership import Filter
from layerkit.operators.rowid import with_row_id
from layerkit.operators.rules import FirstCopyRule, KnownKeyRule, RowRule, evaluate, judged
from layerkit.sources import scratch
from layerkit.sources.scratch import BROADCAST_BYTES, row_bytes, sized


def test_a_filter_misses_no_key_and_passes_few_others(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("n"))
    rows = spark.range(60_000).select(F.concat(F.lit("k"), "id").alias("a"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("b"))
    made = Filter.of(keys, ["k", "n"], 20_000)
    flagged = made.flag(rows, ["a", "b"], "maybe")
    assert flagged.columns == ["a", "b", "maybe"]
    held = F.substring("a", 2, 9).cast("int") < 20_000
    assert flagged.filter(held & ~F.col("maybe")).count() == 0
    assert flagged.filter(~held & F.col("maybe")).count() < 0.02 * 40_000
    assert flagged.filter("maybe IS NULL").count() == 0


def test_a_full_filter_still_misses_nothing(spark, monkeypatch):
    monkeypatch.setattr(membership, "MOST_BLOCKS", 2)
    keys = spark.range(5_000).toDF("k")
    assert Filter.of(keys, ["k"], 5_000).flag(keys, ["k"], "maybe").filter("NOT maybe").count() == 0


def test_an_empty_set_clears_every_row(spark):
    keys = spark.range(10).toDF("k")
    assert Filter.of(keys.filter("k < 0"), ["k"], 0).flag(keys, ["k"], "maybe").filter("maybe").count() == 0


def test_blocks_follow_the_measured_keys():
    assert [membership.blocks_for(n) for n in (0, 1, 16, 17)] == [1, 1, 1, 2]
    # Five million keys: a broadcast of some twenty megabytes, a fraction of that of the keys.
    assert membership.blocks_for(5_000_000) * 72 < BROADCAST_BYTES
    assert membership.blocks_for(10**12) == membership.MOST_BLOCKS


@pytest.fixture
def payments(spark, folder):
    """A tenth of the ids come twice, a tenth of the accounts are unknown; rows are wide."""
    ids = F.when(F.col("id") % 10 == 0, F.col("id") - F.col("id") % 20).otherwise(F.col("id"))
    rows = spark.range(0, 40_000, 1, 6).select(
        ids.alias("tid"), (F.col("id") % 5000).alias("account"), F.repeat(F.lit("wide "), 20).alias("note"),
        F.when(F.col("id") % 11 > 0, F.col("id") - 100).alias("amount"), "id",
    )
    rows.write.parquet(f"{folder}/payments")
    known = spark.range(5000).filter("id % 10 <> 3").toDF("account")
    rules = [
        FirstCopyRule("TWICE", ("tid",), ("id",)), RowRule("NO_AMOUNT", F.col("amount").isNull()), KnownKeyRule("UNKNOWN", "account", known, "account"),
        RowRule("NEGATIVE", F.col("amount") < 0),
    ]
    return spark.read.parquet(f"{folder}/payments"), rules


def test_rows_that_are_cleared_are_not_shuffled(spark, payments, monkeypatch):
    """Above the bound: the same reasons, and an exchange on the suspects' branch alone."""
    rows, rules = payments
    expected = sorted((r["id"], r["data_quality_reason"]) for r in evaluate(rows, rules, from_files=True).collect())
    monkeypatch.setattr(scratch.sized, "__defaults__", (0,))
    assert sorted((r["id"], r["data_quality_reason"]) for r in evaluate(rows, rules, from_files=True).collect()) == expected
    work = with_row_id(rows, from_files=True)
    found = [rule.find(work, f"__rule{i}") for i, rule in enumerate(rules)]
    assert [f is not None and not f.side.small for f in found] == [True, False, True, False]
    result, shuffled = judged(work, rules, found, "data_quality_reason", "|")
    assert shuffled
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The two branches of the union: cleared rows meet broadcasts only.
    cleared, suspects = plan.split("Union\n", 1)[1].split("\n   +- ", 1)
    assert "note" in cleared and "BroadcastHashJoin" in cleared
    assert "SortMergeJoin" not in cleared and "Exchange hashpartitioning" not in cleared
    assert "SortMergeJoin" in suspects
    offending = sum(1 for _, reason in expected if "TWICE" in reason or "UNKNOWN" in reason)
    for position in (0, 2):
        work = found[position].flag(work, f"maybe{position}")
    # Both copies of a repeated id are suspects, and few besides.
    assert work.filter("maybe0 OR maybe2").count() < 1.6 * offending


def test_long_keys_count_by_their_bytes(spark, monkeypatch):
    short = spark.range(20_000).select(F.lit("k").alias("k"))
    long = spark.range(20_000).select(F.repeat(F.lit("k"), 400).alias("k"))
    monkeypatch.setattr(scratch.sized, "__defaults__", (2 << 20,))
    assert sized(short).small and not sized(long).small
    assert sized(long).bytes > 20_000 * 400 and sized(long).rows == 20_000
    # A million keys of a kilobyte are far above the bound.
    assert spark.range(1).select(F.repeat(F.lit("k"), 1000).alias("k")).transform(lambda d: d.agg(F.sum(row_bytes(d)))).first()[0] * 1_000_000 > BROADCAST_BYTES


def test_bytes_of_every_kind_of_value(spark):
    df = spark.sql(
        "SELECT 1 AS i, 'äb' AS s, CAST(NULL AS STRING) AS n, X'0102' AS b, named_struct('x', 'abc', 'y', 1.5D) AS t, "
        "array('p', 'qq') AS a, CAST(1 AS DECIMAL(30,2)) AS d, DATE '2025-01-01' AS day"
    )
    fixed = 8 * 8 + 32
    assert df.select(row_bytes(df)).first()[0] == fixed + 3 + 0 + 2 + (8 + 3 + 8) + len('[["p","qq"]]') + 16


def test_a_checked_lookup_broadcasts_by_bytes(spark, folder):
    spark.range(3000).select(F.col("id").alias("k"), F.repeat(F.lit("v"), 300).alias("v")).write.parquet(f"{folder}/d")
    dimension = spark.read.parquet(f"{folder}/d")
    rows = spark.range(10).toDF("k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plans = [dimension_lookup(rows, dimension, "k", ["v"], bound)._jdf.queryExecution().executedPlan().toString() for bound in (100_000, 10_000_000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ["BroadcastHashJoin" in p for p in plans] == [False, True]


def test_blocks_are_broadcast_in_groups(spark):
    """The join's hash table has a row for each 128 blocks; one for each block would be five times their words."""
    keys = spark.range(40_000).toDF("k")
    made = Filter.of(keys, ["k"], 40_000)
    assert made.count == 2500
    words = [r["__words"] for r in made.groups.collect()]
    assert len(words) == 20 and {len(w) for w in words} == {128 * membership.WORDS}
    assert sum(bin(w & (2**64 - 1)).count("1") for group in words for w in group) > 100_000


def test_the_index_of_a_broadcast_table_counts(spark, monkeypatch):
    """A number takes 40 bytes as a row and more than a hundred in the table that the driver builds."""
    monkeypatch.setattr(scratch.sized, "__defaults__", (1_000_000,))
    assert sized(spark.range(5_000)).small and not sized(spark.range(20_000)).small


def test_keys_without_null_are_joined_by_plain_equality(spark, payments):
    rows, rules = payments
    work = with_row_id(rows, from_files=True).select("id", F.when(F.col("id") % 4 > 0, F.col("account")).alias("account"))
    found = rules[2].find(work, "__rule2")
    plan = found.join(work)._jdf.queryExecution().analyzed().toString()
    assert "<=>" not in plan
    broken = found.join(work).filter(rules[2].broken("__rule2"))
    assert broken.filter("account IS NULL OR account % 10 <> 3").count() == 0
    assert broken.count() == work.filter("account % 10 = 3").count()
