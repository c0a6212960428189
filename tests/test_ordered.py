"""Numbering, ranks and neighbours: spread plans equal single-task plans."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from layerkit.operators.ordered import _order, heavy_groups, neighbour, rank_in_group, sliced_neighbour, sliced_number, surrogate_key
from layerkit.operators.rowid import with_row_id


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share key 1, another large group is NULL."""
    rng = random.Random(3)
    keys = [1] * 200 + [None] * 100 + [rng.randrange(2, 90) for _ in range(300)]
    rows = [(k, rng.randrange(1000), i) for i, k in enumerate(keys)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k INT, v INT, id INT").repartition(5).cache()


def window():
    return Window.partitionBy("k").orderBy("v", "id")


def as_map(df, name):
    return {r["id"]: r[name] for r in df.collect()}


def test_small_tables_have_no_heavy_groups(skewed):
    assert heavy_groups(skewed, ["k"]) is None


def test_heavy_groups_are_found(skewed):
    assert heavy_groups(skewed, ["k"], 50).count() == 2


def test_rank_of_heavy_and_light_groups(skewed):
    expected = as_map(skewed.withColumn("r", F.row_number().over(window())), "r")
    assert as_map(rank_in_group(skewed, ["k"], ["v", "id"], "r", group_rows=50), "r") == expected
    assert as_map(rank_in_group(skewed, ["k"], ["v", "id"], "r"), "r") == expected


@pytest.mark.parametrize("step", [1, -1, 3])
def test_neighbours_of_heavy_and_light_groups(skewed, step):
    expected = as_map(skewed.withColumn("n", F.lead("v", step).over(window())), "n")
    assert as_map(neighbour(skewed, ["k"], ["v", "id"], "v", "n", step, group_rows=50), "n") == expected


def test_numbers_are_dense_and_ordered(skewed):
    expected = as_map(skewed.withColumn("n", F.row_number().over(Window.orderBy("v", "id")).cast("long")), "n")
    assert as_map(sliced_number(skewed, ["v", "id"], "n", slices=7), "n") == expected
    assert as_map(surrogate_key(skewed, ["v", "id"], "n"), "n") == expected
    assert as_map(surrogate_key(skewed, ["v", "id"], "n", single_task_rows=10), "n") == expected


def test_ties_are_numbered_alike_in_both_plans(spark, tmp_path):
    """Stored position breaks ties, so a table may cross the limit unchanged."""
    path = str(tmp_path / "tied")
    spark.range(0, 300, 1, 6).select((F.col("id") % 3).alias("k"), F.lit(7).alias("v"), "id").write.parquet(path)
    df = spark.read.parquet(path)
    assert as_map(surrogate_key(df, ["v"], "n", True), "n") == as_map(surrogate_key(df, ["v"], "n", True, 10), "n")
    for operator, extra in ((rank_in_group, ["r"]), (neighbour, ["id", "r"])):
        small, large = (operator(df, ["k"], ["v"], *extra, from_files=True, group_rows=g) for g in (1000, 20))
        assert as_map(small, "r") == as_map(large, "r")


def test_slices_split_equal_order_values(spark):
    """Copies of one sort key spread over slices and still get distinct numbers."""
    df = spark.range(0, 4000).select(F.lit(1).alias("k"), "id")
    numbered = sliced_number(df, ["k"], "n", slices=4)
    assert sorted(r["n"] for r in numbered.select("n").collect()) == list(range(1, 4001))


def test_key_type_is_bigint(skewed):
    assert dict(surrogate_key(skewed, ["id"], "n").dtypes)["n"] == "bigint"
    assert dict(sliced_number(skewed, ["id"], "n").dtypes)["n"] == "bigint"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=40))
def test_sliced_equals_global_window(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id INT, v INT")
    expected = as_map(df.withColumn("n", F.row_number().over(Window.orderBy("v", "id")).cast("long")), "n")
    assert as_map(sliced_number(df, ["v", "id"], "n"), "n") == expected


@pytest.mark.parametrize("step", [1, -1, 2, -3])
@pytest.mark.parametrize("slices", [1, 7, 60])
def test_edges_are_handed_on_over_many_slices(spark, skewed, step, slices):
    """Slices of a few rows, some shorter than the step: the neighbours are those of one window."""
    named = with_row_id(skewed)
    found = sliced_neighbour(named, ["k"], _order(["v", "id"]), "v", "n", step, slices)
    assert as_map(found, "n") == as_map(skewed.withColumn("n", F.lead("v", step).over(window())), "n")


def test_heavy_rows_are_shuffled_once(spark, skewed):
    """One range exchange before the slices are written; reading them needs none."""
    named = with_row_id(skewed)
    found = sliced_neighbour(named, ["k"], _order(["v", "id"]), "v", "n", 1, 8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.split("\n") if "Exchange" in line and "Broadcast" not in line and "__at" in line]
    assert "SortMergeJoin" not in plan and "Window" in plan and not wide


def test_a_known_count_and_a_unique_order_change_nothing(skewed):
    keyed = surrogate_key(skewed, ["k", "v", "id"], "sk")
    plain = as_map(neighbour(skewed, ["k"], ["v", "id"], "v", "n"), "n")
    for rows in (600, None):
        assert as_map(neighbour(keyed, ["k"], ["v", "sk"], "v", "n", total=True, rows=rows), "n") == plain
        assert as_map(neighbour(keyed, ["k"], ["v", "sk"], "v", "n", total=True, rows=rows, group_rows=50), "n") == plain
