"""Stored catalogs of which an update rewrites a part."""

import os

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import catalog
from shelfmark.sources import buckets

SCHEMA = "source_id string, title string, tags array<string>, _note int"


def entries(spark, n=300):
    """A third of all entries under one name, one without an id."""
    rows = [(f"{'big' if k % 3 == 0 else f'n{k}'}_v{k}.1", f"title {k}", [str(k)], k)
            for k in range(n)] + [(None, "lost", None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(str, df.select("source_id", "title", "tags", "_note").collect()))


def files_of(path):
    return {os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
            for folder, _, names in os.walk(f"{path}/generations") for name in names
            if name.startswith("part-")}


def test_update_of_one_id_leaves_other_files(spark, tmp_path):
    path = str(tmp_path / "c")
    buckets.create(entries(spark), path, 16)
    assert rows_of(buckets.read(spark, path)) == rows_of(entries(spark))
    before = files_of(path)
    update = spark.createDataFrame([("big_v30.1", "new", None)],
                                   "source_id string, title string, tags array<string>")
    assert buckets.overlay(update, path, ["title", "tags"]) == 1
    after = files_of(path)
    assert {f: after[f] for f in before} == before
    new = set(after) - set(before)
    assert new and len({os.path.dirname(f) for f in new}) == 1
    want = rows_of(catalog.overlay_metadata(entries(spark), update, ["title", "tags"]))
    assert rows_of(buckets.read(spark, path)) == want
    assert [r["title"] for r in buckets.lookup(spark, path, "big_v30.1").collect()] == ["new"]
    assert buckets.lookup(spark, path, "gone_v1.1").count() == 0


def test_updates_one_after_another(spark, tmp_path):
    path, want = str(tmp_path / "c"), entries(spark)
    buckets.create(want, path, 8)
    for turn in range(3):
        update = spark.createDataFrame(
            [(f"big_v{k}.1", f"{turn}:{k}") for k in range(0, 90, 9 + turn)] + [
                ("unknown_v1.1", "x"), (None, "no id")], "source_id string, title string")
        want = catalog.overlay_metadata(want, update, ["title"])
        buckets.overlay(update, path, ["title"])
    assert rows_of(buckets.read(spark, path)) == rows_of(want)
    old = buckets.superseded(spark, path)
    assert old and all(os.path.isdir(folder) for folder in old)
    held = {os.path.dirname(f.removeprefix("file:")) for f in
            buckets.read(spark, path).select(F.input_file_name()).toPandas().iloc[:, 0]
            .str.replace("file://", "").str.replace("%3D", "=")}
    assert not held & set(old)


def test_a_crash_before_the_record_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    buckets.create(entries(spark), path, 8)
    first = spark.createDataFrame([("n1_v1.1", "half"), ("n2_v2.1", "half")],
                                  "source_id string, title string")
    with monkeypatch.context() as patch:
        def crash(*_):
            raise RuntimeError("lost")
        patch.setattr(buckets, "_commit", crash)
        with pytest.raises(RuntimeError):
            buckets.overlay(first, path, ["title"])
    assert rows_of(buckets.read(spark, path)) == rows_of(entries(spark))
    second = first.where("source_id = 'n1_v1.1'").withColumn("title", F.lit("whole"))
    buckets.overlay(second, path, ["title"])
    want = catalog.overlay_metadata(entries(spark), second, ["title"])
    assert rows_of(buckets.read(spark, path)) == rows_of(want)


def test_empty_catalog(spark, tmp_path):
    path = str(tmp_path / "c")
    buckets.create(entries(spark).limit(0), path, 8)
    update = spark.createDataFrame([("a_v1.1", "x")], "source_id string, title string")
    assert buckets.overlay(update, path, ["title"]) == 0
    assert buckets.read(spark, path).count() == 0
    assert buckets.read(spark, path).columns == ["source_id", "title", "tags", "_note"]
