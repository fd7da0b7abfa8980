"""Stored catalogs: what a lookup reads."""

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import access, filters
from shelfmark.sources.sinks import write_catalog


def rows_read(df):
    """The rows that the scan of a query handed on, after it has run."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("catalog") / "c")
    name = F.concat(F.lit("ds_"), F.col("id").cast("string"))
    write_catalog(spark.range(40_000).select(
        (F.col("id") * 2).alias("source_key"), name.alias("source_name"),
        F.concat(name, F.lit("_v1.1")).alias("source_id"), (F.col("id") % 10 == 0).alias("test")),
        path)
    return spark.read.parquet(path)


def test_lookup_of_an_absent_id_reads_nothing(stored):
    for absent in ("ds_77_v9.1", "ds_12345_v2.1", "ds_3x_v1.1"):
        df = filters.select_submissions(stored, [("source_id", "==", absent)])
        assert df.count() == 0 and rows_read(df) == 0
    df = filters.select_submissions(stored, [("source_key", "==", 40_001)])
    assert df.count() == 0 and rows_read(df) == 0


def test_lookup_of_an_id_reads_part_of_the_catalog(stored):
    df = filters.select_submissions(stored, [("source_id", "==", "ds_777_v1.1")])
    assert [r["source_key"] for r in df.collect()] == [1554] and rows_read(df) <= 20_000


def test_lists_are_matched_once(spark):
    """A third of all rows under one list, others under lists in another order or with nulls."""
    lists = [["a", "b"], ["b", "a"], ["c"], [None, "a"], [None], [], None, ["public", "x"], ["ab"],
             ["a\", \"b"]]
    rows = [(n, lists[0] if n % 3 == 0 else lists[n % len(lists)]) for n in range(300)]
    entries = spark.createDataFrame(rows, "id int, acl array<string>")
    who = spark.createDataFrame([("a",), ("zz",)], "principal string")
    got = sorted(r["id"] for r in access.visible_records(entries, who, "id").collect())
    assert got == [n for n, acl in rows if not acl or "public" in acl or "a" in acl]
