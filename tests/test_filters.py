"""The filter language against a plain model, its errors, and its pushdown."""

from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.operators.filters import (
    all_filters, by_source_id, date_filters, in_scope, select_submissions,
)

SCHEMA = ("id int, name string, size double, n bigint, active boolean, test boolean, "
          "submission_time timestamp_ntz, tags array<string>, info struct<who:string>, "
          "owner bigint")
NAMES = ["", "a", "ab", "a%", "a_b", "%", "_", "B", "ba.*", None]
SIZES = [-1.5, 0.0, 1.0, 2.5, None]
ROWS = [(i, NAMES[i % len(NAMES)], SIZES[i % len(SIZES)], i % 7, i % 2 == 0, i % 3 == 0,
         datetime(2020, 2, 1) + timedelta(hours=12 * i), ["x", "y"][: i % 3], (f"w{i % 4}",), i % 5)
        for i in range(40)]

MODEL = {
    "^": lambda a, v: a is not None and a.startswith(v),
    "*": lambda a, v: a is not None and v in a,
    "==": lambda a, v: a is None if v is None else a == v,
    "!=": lambda a, v: a is not None if v is None else a is not None and a != v,
    ">": lambda a, v: a is not None and a > v,
    ">=": lambda a, v: a is not None and a >= v,
    "<": lambda a, v: a is not None and a < v,
    "<=": lambda a, v: a is not None and a <= v,
    "[]": lambda a, v: a is not None and v[0] <= a <= v[1],
    "in": lambda a, v: a is not None and a in v,
}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


texts = st.sampled_from([n for n in NAMES if n is not None])
numbers = st.sampled_from([-2, -1.5, 0, 1, 2.5, 3])


def one_filter(field, values):
    ordered = st.tuples(st.just(field), st.sampled_from(["==", "!=", ">", ">=", "<", "<="]), values)
    missing = st.tuples(st.just(field), st.sampled_from(["==", "!="]), st.none())
    between = st.tuples(st.just(field), st.just("[]"), st.lists(values, min_size=2, max_size=2))
    among = st.tuples(st.just(field), st.just("in"), st.lists(values, max_size=3))
    return st.one_of(ordered, missing, between, among)


text_filters = st.one_of(one_filter("name", texts),
                         st.tuples(st.just("name"), st.sampled_from(["^", "*"]), texts))


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(text_filters, one_filter("size", numbers)), max_size=3))
def test_filters_equal_model(table, filters):
    got = {r["id"] for r in table.where(all_filters(table.schema, filters)).collect()}
    position = {"name": 1, "size": 2}
    want = {r[0] for r in ROWS
            if all(MODEL[op](r[position[field]], value) for field, op, value in filters)}
    assert got == want


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_list_and_nested_fields(table):
    assert ids(table.where(all_filters(table.schema, [("tags", "*", "y")]))) == [
        r[0] for r in ROWS if "y" in r[7]]
    assert ids(table.where(all_filters(table.schema, [("info.who", "==", "w1")]))) == [
        r[0] for r in ROWS if r[8][0] == "w1"]


def test_flags_and_callers_list(table):
    filters = [("n", ">", 2)]
    got = select_submissions(table, filters, active_only=True, include_tests=False)
    assert ids(got) == [r[0] for r in ROWS if r[3] > 2 and r[4] and not r[5]]
    assert filters == [("n", ">", 2)]


def test_one_day_and_the_midnight_after(table):
    got = select_submissions(table, newer_than=(2020, 2, 11), older_than=(2020, 2, 12))
    assert [r["submission_time"] for r in got.orderBy("id").collect()] == [
        datetime(2020, 2, 11), datetime(2020, 2, 11, 12), datetime(2020, 2, 12)]


def test_aware_bounds_are_taken_in_utc():
    zone = timezone(timedelta(hours=2))
    assert date_filters(datetime(2020, 2, 11, 1, tzinfo=zone), None) == [
        ("submission_time", ">=", datetime(2020, 2, 10, 23))]


@pytest.mark.parametrize("newer, older", [((2020, 2, 11), (2020, 2, 11)),
                                          ((2020, 2, 12), datetime(2020, 2, 11))])
def test_equal_or_reversed_bounds(newer, older):
    with pytest.raises(ValueError):
        date_filters(newer, older)


@pytest.mark.parametrize("wrong", [
    ("nothing", "==", 1), ("name", "~", "a"), ("name", "==", 5), ("size", ">", "5"),
    ("size", ">", None), ("size", "[]", [1]), ("size", "[]", [1, 2, 3]), ("size", "in", 3),
    ("active", "==", 1), ("n", "==", True), ("n", "^", "1"), ("info.nobody", "==", "x"),
    ("name", "in", ["a", None]), ("submission_time", ">", 3),
])
def test_unfit_filters_raise(table, wrong):
    with pytest.raises(ValueError):
        all_filters(table.schema, [wrong])


def test_iso_text_as_time(table):
    got = table.where(all_filters(table.schema, [
        ("submission_time", "<=", "2020-02-01T12:00:00Z")]))
    assert ids(got) == [0, 1]


def test_scopes(table):
    assert ids(in_scope(table, owner=1)) == [r[0] for r in ROWS if r[9] == 1]
    assert len(ids(in_scope(table, code="all"))) == len(ROWS)
    assert ids(in_scope(table, code="active")) == [r[0] for r in ROWS if r[4]]
    with pytest.raises(ValueError):
        in_scope(table, code="other")


def test_filters_reach_the_scan(spark, table, tmp_path):
    path = str(tmp_path / "status")
    named = table.withColumns({"source_name": F.concat(F.lit("n"), "n"),
                               "source_id": F.concat(F.lit("n"), "n", F.lit("_v1.1"))})
    named.write.partitionBy("test").parquet(path)
    stored = spark.read.schema(named.schema).parquet(path)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    found = plan(select_submissions(
        stored, [("name", "^", "a"), ("info.who", "in", ["w1", "w2"]), ("size", "==", None)],
        active_only=True, include_tests=False, newer_than=(2020, 1, 1)).select("id"))
    for pushed in ("StringStartsWith(name,a)", "IsNull(size)", "EqualTo(active,true)",
                   "GreaterThanOrEqual(submission_time,", "In(info.who, [w1,w2])"):
        assert pushed in found
    assert "PartitionFilters: [isnotnull(test" in found
    assert "tags" not in found.split("ReadSchema")[1]
    lookup = plan(by_source_id(stored, "n3_v1.1"))
    assert "EqualTo(source_name,n3)" in lookup and "EqualTo(source_id,n3_v1.1)" in lookup
