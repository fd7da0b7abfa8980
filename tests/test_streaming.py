"""Streams over several micro-batches equal the batch results, also after a replay or a crash."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from drafts import random_log
from shelfmark.operators import draft, fold
from shelfmark.plans.views import edits
from shelfmark.schema import EVENTS
from shelfmark.streaming import runs, tiers

TYPES = ["view", "click", "purchase", "signup", "error"]


@pytest.fixture(scope="module")
def event_folder(spark, tmp_path_factory):
    """Events in six files, out of time order, one user with a third of them."""
    path = str(tmp_path_factory.mktemp("events"))
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(seconds=(i * 7919) % 5003), 0 if i % 3 == 0 else i % 11,
             TYPES[(i * i) % 5], float(i % 9), f'{{"k": {i}}}') for i in range(600)]
    for n in range(6):
        spark.createDataFrame(rows[n::6], EVENTS).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path, schema=EVENTS):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_current_status(spark, event_folder, tmp_path):
    def statuses(events):
        return events.select(F.col("user_id").cast("string").alias("source_id"), "ts", "event_id",
                             F.col("event_type").alias("status"))

    runs.run_current_status(statuses(stream(spark, event_folder)), str(tmp_path))
    assert tiers.standing(spark, str(tmp_path)) == [(n, n) for n in range(6)]
    want = runs.current_status(statuses(spark.read.parquet(event_folder)))
    assert as_set(runs.read_current_status(spark, str(tmp_path))) == as_set(want)


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_fold(spark, event_folder, tmp_path, monkeypatch, fan):
    monkeypatch.setattr(tiers.add, "__defaults__", (fan,))
    log = edits(stream(spark, event_folder))
    runs.run_fold(log, str(tmp_path))
    whole = edits(spark.read.parquet(event_folder))
    want = as_set(fold.without_deleted(fold.after_clear(whole)))
    assert as_set(runs.read_fold(spark, str(tmp_path))) == want
    assert len(tiers.standing(spark, str(tmp_path))) == {2: 2, 3: 2, 8: 6}[fan]
    # Nothing is new, so a second run changes nothing.
    runs.run_fold(log, str(tmp_path))
    assert as_set(runs.read_fold(spark, str(tmp_path))) == want


SCHEMA = "submission_id int, seq bigint, op string, field string, key string, payload string"


@pytest.mark.parametrize("fan", [2, 8])
def test_draft_with_late_calls(spark, tmp_path, monkeypatch, fan):
    """Every kind of call, dealt over batches without regard to their order."""
    monkeypatch.setattr(tiers.add, "__defaults__", (fan,))
    draw = random.Random(5)
    rows, drafts = random_log(draw, 40, 25)
    draw.shuffle(rows)
    for n in range(4):
        spark.createDataFrame(rows[n::4], SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/log")
    out = f"{tmp_path}/out"
    runs.run_draft(stream(spark, f"{tmp_path}/log", SCHEMA), out)
    got = as_set(runs.read_draft(spark, out))
    assert got == as_set(draft.current_state(spark.read.schema(SCHEMA).parquet(f"{tmp_path}/log")))
    assert len(got) == sum(1 for d in drafts.values() for _ in d.state())
    tags = [(r.submission_id, r.pos, r.payload) for r in runs.read_draft(spark, out).where(
        "field = 'tags'").collect()]
    assert sorted(tags) == sorted((n, p, v) for n, d in drafts.items()
                                  for f, _, p, v in d.state() if f == "tags")
    # The last batch runs again, as after a failure before its end was noted.
    last = spark.createDataFrame(rows[3::4], SCHEMA)
    if fan == 8:
        parts = spark.read.parquet(f"{tmp_path}/log").count()
        tiers.add(draft.partial_state(last), out, 3, draft.merged_state)
        assert parts == len(rows) and len(tiers.standing(spark, out)) == 4


def test_parts_stay_few():
    for fan in (2, 8):
        parts, most = [], 0
        for batch in range(1000):
            parts.append((batch, batch))
            while some := tiers.due(parts, fan):
                parts = [*parts[:-fan], (some[0][0], some[-1][1])]
            most = max(most, len(parts))
            assert [p for a, b in parts for p in range(a, b + 1)] == list(range(batch + 1))
        assert most <= 28


def test_crashes_and_replays(spark, tmp_path):
    """A batch stopped at any point and run again leaves what it would have left at once."""
    folder, sums = str(tmp_path), lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    rows = lambda batch: spark.createDataFrame([(batch % 3, 1), (7, batch)], "k int, n bigint")

    class Crash(Exception):
        pass

    def crashing(df):
        raise Crash
    for batch in range(10):
        if batch % 2:  # the first try ends when parts are merged, or after they were
            try:
                tiers.add(rows(batch), folder, batch, crashing, fan=2)
            except Crash:
                assert tiers.standing(spark, folder)[-1][1] == batch - 1
        tiers.add(rows(batch), folder, batch, sums, fan=2)
        if batch % 3 == 0:  # the whole batch again
            tiers.add(rows(batch), folder, batch, sums, fan=2)
        want = {}
        for b in range(batch + 1):
            for k, n in ((b % 3, 1), (7, b)):
                want[k] = want.get(k, 0) + n
        got = {r["k"]: r["n"] for r in sums(tiers.read(spark, folder)).collect()}
        assert got == want
    assert tiers.standing(spark, folder) == [(0, 7), (8, 9)]
    gone = tiers.superseded(spark, folder, fan=2)
    assert f"{folder}/parts/0-0" in gone and f"{folder}/parts/0-7" not in gone
    with pytest.raises(ValueError, match="no record"):
        tiers.add(rows(20), folder, 20, sums)
