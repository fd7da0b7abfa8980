"""Numbering gives the same rows whether or not a key counts as heavy."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfmark.functions.times import order_slices
from shelfmark.operators.skew import heavy_keys, number_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds a third of the rows, NULL keys some."""
    key = (F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None)
           .otherwise(F.col("id") % 17 + 1))
    return spark.range(3000).select("id", key.alias("k"),
                                    (F.xxhash64("id") % 1000).alias("t")).cache()


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_heavy_keys(skewed):
    got = heavy_keys(skewed, ["k"], 400).collect()
    assert [r["k"] for r in got] == [0]


def slices(levels):
    """Slices of rows ordered by ``t`` and ``id``: hundreds of t, t itself, ranges of ids."""
    return [F.floor(F.col("t") / 500), F.col("t"), F.floor(F.col("id") / 200)][:levels]


def numbered(df):
    return df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")))


@pytest.mark.parametrize("levels", [1, 2, 3])
@pytest.mark.parametrize("rows_per_task", [5, 400, 10**6])
def test_number_rows(skewed, levels, rows_per_task):
    got = number_rows(skewed, ["k"], ["t", "id"], slices(levels), "n", rows_per_task)
    assert got.columns == ["id", "k", "t", "n"]
    assert as_set(got) == as_set(numbered(skewed))


def test_equal_times_are_cut_by_ids(skewed):
    """A key whose rows all have one time."""
    same = skewed.withColumn("t", F.lit(7).cast("bigint"))
    got = number_rows(same, ["k"], ["t", "id"], slices(3), "n", 50)
    assert as_set(got) == as_set(numbered(same))


def test_no_task_sorts_more_than_a_piece(spark, skewed):
    """The pieces a heavy key is numbered in, read off the plan's window."""
    got = number_rows(skewed, ["k"], ["t", "id"], slices(1), "n", 400)
    plan = got._jdf.queryExecution().executedPlan().toString()
    window = [line for line in plan.split("\n") if "row_number()" in line and "Window" in line]
    assert window and "_piece" in window[0]
    assert re.search(r"Exchange hashpartitioning\(k#\w+, _piece#", plan)


@pytest.mark.parametrize("rows_per_task", [5, 100, 10**6])
def test_null_order_values_of_heavy_keys(skewed, rows_per_task):
    holes = skewed.withColumn("t", F.when(F.col("id") % 6 != 0, F.col("t")))
    got = number_rows(holes, ["k"], ["t", "id"], slices(3), "n", rows_per_task)
    assert as_set(got) == as_set(numbered(holes))


def test_exact_times_make_few_pieces(spark):
    """A heavy hour of microsecond times is cut by seconds, not by row."""
    times = spark.range(4000).select("id", F.lit(1).alias("k"), F.timestamp_micros(
        F.col("id") * 800_001).alias("t"))
    cuts = order_slices(F.col("t"), F.col("id"))
    got = number_rows(times, ["k"], ["t", "id"], cuts, "n", 500)
    assert sorted(r["n"] for r in got.collect()) == list(range(1, 4001))
    assert got.where("n <> id + 1").count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "_slice2" in plan


def test_map_columns_pass(spark):
    rows = spark.createDataFrame([(1, {"a": "b"}), (1, {"c": "d"}), (2, {})],
                                 "k int, m map<string,string>")
    rows = rows.withColumn("t", F.monotonically_increasing_id()).withColumn("id", F.col("t"))
    got = number_rows(rows, ["k"], ["t", "id"], slices(2), "n", 1)
    assert sorted((r["k"], r["n"]) for r in got.collect()) == [(1, 1), (1, 2), (2, 1)]
