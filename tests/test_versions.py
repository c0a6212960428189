"""Type-2 versions and lookups by day."""

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerkit.operators.checks import current_counts, interval_tests, version_history
from layerkit.operators.reports import none_of
from layerkit.operators.scd2 import build_versions, busiest_key, overlapping, version_as_of, version_on

D = date(2025, 1, 1)


def days(n):
    return D + timedelta(days=n)


def history(spark, rows):
    return spark.createDataFrame(rows, "id INT, effective_from DATE, effective_to DATE, is_current BOOLEAN, seg STRING")


def test_ends_and_flags_are_recomputed(spark):
    raw = history(spark, [(1, days(0), days(3), True, "a"), (1, days(10), None, False, "b"), (2, days(5), days(6), False, "c")])
    built = {r["seg"]: (r["effective_to"], r["is_current"]) for r in build_versions(raw, "id").collect()}
    assert built == {"a": (days(9), False), "b": (None, True), "c": (None, True)}


def test_same_start_twice_is_visible_to_the_checks(spark):
    raw = history(spark, [(1, days(4), None, True, "a"), (1, days(4), None, True, "b")])
    built = build_versions(raw, "id")
    assert sorted([r["effective_to"] for r in built.collect()], key=str) == [days(3), None]
    bad = {r["check"]: r["bad_rows"] for r in none_of(built, "t", interval_tests()).collect()}
    assert bad == {"current_is_open": 0, "history_is_closed": 1}


def test_open_previous_end(spark):
    raw = history(spark, [(1, days(0), None, False, "a"), (1, days(5), None, True, "b")])
    assert overlapping(raw, "id").count() == 0
    assert overlapping(raw, "id", open_blocks=True).count() == 1
    report = {r["check"]: r["bad_rows"] for r in version_history(raw, "id", "h").collect()}
    assert report == {"one_current": 0, "no_overlap_strict": 1}


def test_overlap_on_shared_day(spark):
    raw = history(spark, [(1, days(0), days(5), False, "a"), (1, days(5), None, True, "b")])
    assert [r["seg"] for r in overlapping(raw, "id").collect()] == ["b"]


def test_current_counts(spark):
    raw = history(spark, [(1, days(0), None, True, "a"), (2, days(0), None, False, "a"), (3, days(0), None, True, "a"), (3, days(1), None, True, "b")])
    assert {r["id"]: r["current_versions"] for r in current_counts(raw, "id").collect()} == {2: 0, 3: 2}


@pytest.mark.parametrize("bucket", [None, 3, 31])
def test_first_and_last_day_belong_to_the_version(spark, bucket):
    versions = build_versions(history(spark, [(1, days(0), None, True, "a"), (1, days(10), None, True, "b")]), "id")
    asked = spark.createDataFrame([(1, days(n), n) for n in (-1, 0, 9, 10, 500)] + [(2, days(3), 99), (None, days(3), 98)], "id INT, day DATE, n INT")
    inner = {r["n"]: r["seg"] for r in version_on(asked, versions, "id", "day", ["seg"], bucket_days=bucket).collect()}
    assert inner == {0: "a", 9: "a", 10: "b", 500: "b"}
    left = version_on(asked, versions, "id", "day", ["seg"], how="left", bucket_days=bucket)
    assert {r["n"]: r["seg"] for r in left.collect()} == {**inner, -1: None, 99: None, 98: None}
    as_of = {r["n"]: r["seg"] for r in version_as_of(asked, versions, "id", "day", ["seg"]).collect()}
    assert as_of == inner


def test_busiest_key(spark):
    assert busiest_key(history(spark, [(1, days(n), None, True, "a") for n in range(4)]), "id") == 4
    assert busiest_key(history(spark, []), "id") == 0


starts = st.dictionaries(st.integers(0, 2), st.sets(st.integers(0, 30), min_size=1, max_size=6), min_size=1)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(starts, st.lists(st.tuples(st.integers(0, 3), st.integers(-3, 40)), min_size=1, max_size=15))
def test_all_lookups_agree_and_versions_are_contiguous(spark, by_key, asks):
    rows = [(k, days(n), None, False, f"{k}-{n}") for k, ns in by_key.items() for n in ns]
    raw = history(spark, rows)
    versions = build_versions(raw, "id")
    assert current_counts(versions, "id").count() == 0
    assert overlapping(versions, "id", open_blocks=True).count() == 0
    spread = build_versions(raw, "id", group_rows=2)
    assert sorted(versions.collect(), key=str) == sorted(spread.select(versions.columns).collect(), key=str)
    asked = spark.createDataFrame([(k, days(n), i) for i, (k, n) in enumerate(asks)], "id INT, day DATE, n INT")

    def found(df):
        return {r["n"]: r["seg"] for r in df.select("n", F.col("seg")).collect()}

    expected = {}
    for i, (k, n) in enumerate(asks):
        earlier = [s for s in by_key.get(k, ()) if s <= n]
        if earlier:
            expected[i] = f"{k}-{max(earlier)}"
    assert found(version_on(asked, versions, "id", "day", ["seg"])) == expected
    assert found(version_on(asked, versions, "id", "day", ["seg"], bucket_days=7)) == expected
    assert found(version_as_of(asked, raw, "id", "day", ["seg"])) == expected


@pytest.mark.parametrize("how", ["inner", "left"])
def test_overlapping_versions_and_gaps_in_swept_periods(spark, how):
    """Every version that holds on a day is found once, those that began periods ago too; nothing is expanded."""
    import random

    draw = random.Random(7)
    held = []
    for key in (1, 2, 3):
        for n in range(25):
            first = draw.randrange(-200, 400)
            held.append((key, days(first), draw.choice([None, days(first), days(first + 3), days(first + draw.randrange(0, 300))]), False, f"{key}-{n}"))
    held += [(3, days(-5000), None, False, "old"), (3, days(-5000), days(-4990), False, "gone"), (None, days(0), None, False, "no key")]
    versions = history(spark, held)
    asks = [(draw.choice([1, 2, 3, 4, None]), draw.randrange(-250, 500), i) for i in range(120)]
    asked = spark.createDataFrame([(k, days(n), i) for k, n, i in asks] + [(1, None, 999)], "id INT, day DATE, n INT")
    expected = []
    for k, n, i in asks:
        match = [r[4] for r in held if k is not None and r[0] == k and r[1] <= days(n) and (r[2] is None or days(n) <= r[2])]
        expected += [(i, seg) for seg in match] or ([(i, None)] if how == "left" else [])
    expected += [(999, None)] if how == "left" else []
    for bucket in (1, 31, 100_000):
        found = version_on(asked, versions, "id", "day", ["seg"], how=how, bucket_days=bucket)
        assert sorted(((r["n"], r["seg"]) for r in found.collect()), key=str) == sorted(expected, key=str)
        assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_grouping_by_key_and_period_needs_no_further_shuffle(spark):
    versions = spark.sql("SELECT id % 5 AS k, date_add(DATE'2024-01-01', cast(id AS INT) * 3) AS effective_from, CAST(NULL AS DATE) AS effective_to, id FROM range(40)")
    asks = spark.sql("SELECT if(id % 7 = 0, NULL, id % 6) AS k, if(id % 9 = 0, NULL, date_add(DATE'2024-01-01', cast(id AS INT))) AS day, id AS m FROM range(100)")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = version_on(asks, versions, "k", "day", ["id"], how="left", bucket_days=31, period_as="period")
        counted = found.groupBy("k", "period", "day", "m").agg(F.count("id").alias("n"))
        exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert exchanges(counted) == exchanges(found)
        plain = version_on(asks, versions, "k", "day", ["id"], how="left").groupBy("k", "day", "m").agg(F.count("id").alias("n"))
        assert sorted(counted.drop("period").collect(), key=str) == sorted(plain.collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_versions_are_carried_only_where_they_are_asked_for(spark):
    """A version open for a thousand periods meets the two that have rows."""
    versions = history(spark, [(1, days(-30_000), None, True, "a")])
    asked = spark.createDataFrame([(1, days(0), 1), (1, days(1), 2), (1, days(400), 3)], "id INT, day DATE, n INT")
    found = version_on(asked, versions, "id", "day", ["seg"], bucket_days=31)
    assert found.count() == 3
