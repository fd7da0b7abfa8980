"""Versions numbered batch by batch, against the numbering of everything."""

import random

import pytest

from shelfmark.operators import catalog
from shelfmark.streaming import tiers, versions

SCHEMA = "source_name string, submission_time timestamp_ntz, source_key bigint"


def submissions(n, seed):
    """A third under one name, equal times, names and times that are missing."""
    from datetime import datetime, timedelta
    pick = random.Random(seed)
    start = datetime(2021, 3, 30, 22)
    return [(pick.choice(["hot", *[f"d{pick.randrange(20)}"] * 2, None]),
             None if pick.random() < .05 else start + timedelta(
                 seconds=pick.choice([0, 1, 3600, 86_400]) * pick.randrange(30)), key)
            for key in range(n)]


def numbers(df):
    return sorted((r["source_key"], r["version"], r["source_id"]) for r in df.collect())


@pytest.mark.parametrize("rows_per_task", [4_000_000, 20])
def test_batches_equal_the_whole(spark, tmp_path, rows_per_task):
    rows = submissions(400, rows_per_task)
    random.Random(1).shuffle(rows)  # late ones in every batch
    folder, done = str(tmp_path / "v"), []
    for n in range(3):
        part = rows[130 * n:130 * n + 130]
        done += part
        batch = spark.createDataFrame(part, SCHEMA)
        versions.add(batch, folder, n)
        whole = numbers(catalog.with_versions(spark.createDataFrame(done, SCHEMA)))
        keys = {key for _, _, key in part}
        assert numbers(versions.numbered(batch, folder, rows_per_task)) == [
            r for r in whole if r[0] in keys]
    versions.add(batch.limit(0), folder, 3)
    assert numbers(versions.numbered(spark.createDataFrame(done, SCHEMA), folder)) == whole


def test_a_batch_again_and_a_crash_in_between(spark, tmp_path, monkeypatch):
    rows, folder = submissions(60, 3), str(tmp_path / "v")
    batches = [spark.createDataFrame(rows[at:at + 20], SCHEMA) for at in (0, 20, 40)]
    versions.add(batches[0], folder, 0)
    versions.add(batches[0], folder, 0)
    versions.add(batches[1], folder, 1)
    real = tiers.add

    def crash(rows, folder, *rest, **more):
        if folder.endswith("times"):
            raise RuntimeError("lost")
        real(rows, folder, *rest, **more)
    with monkeypatch.context() as patch:
        patch.setattr(tiers, "add", crash)
        with pytest.raises(RuntimeError):
            versions.add(batches[2], folder, 2)
    versions.add(batches[2], folder, 2)
    whole = spark.createDataFrame(rows, SCHEMA)
    assert numbers(versions.numbered(whole, folder)) == numbers(catalog.with_versions(whole))


def test_parts_are_merged(spark, tmp_path):
    folder = str(tmp_path / "v")
    rows = [r for r in submissions(200, 5) if r[0] in ("hot", None)][:10]
    for n, row in enumerate(rows):
        versions.add(spark.createDataFrame([row], SCHEMA), folder, n)
    assert len(tiers.standing(spark, f"{folder}/times")) <= 4
    whole = spark.createDataFrame(rows, SCHEMA)
    assert numbers(versions.numbered(whole, folder)) == numbers(catalog.with_versions(whole))


def test_a_batch_reads_its_span_alone(spark, tmp_path):
    from datetime import datetime
    folder = str(tmp_path / "v")
    rows = [("a", datetime(2022, 1 + k % 12, 3), k) for k in range(120)]
    versions.add(spark.createDataFrame(rows, SCHEMA), folder, 0)
    batch = spark.createDataFrame([("a", datetime(2022, 5, 4), 1000)], SCHEMA)
    versions.add(batch, folder, 1)
    got = versions.numbered(batch, folder)
    assert [r["version"] for r in got.collect()] == [5 * 10 + 1]
    assert "PartitionFilters: [isnotnull(span" in got._jdf.queryExecution().toString()


def test_rows_are_joined_once_without_a_heavy_hour(spark, tmp_path):
    """The stored counts tell that no hour is heavy; they did not spare counting the rows."""
    rows, folder = submissions(200, 7), str(tmp_path / "v")
    whole = spark.createDataFrame(rows, SCHEMA)
    versions.add(whole, folder, 0)
    got = versions.numbered(whole, folder)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2  # counts of the names, times of the hours
    assert numbers(got) == numbers(catalog.with_versions(whole))
