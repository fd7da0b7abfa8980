"""Submissions built call by call against a plain model of them."""

import json
import random

import pytest

from drafts import random_log
from shelfmark.operators import draft
from shelfmark.operators.submission import submission_json

SCHEMA = "submission_id int, seq bigint, op string, field string, key string, payload string"
LISTS = ("data_sources", "data_destinations", "tags")


@pytest.fixture(scope="module")
def built(spark):
    rows, drafts = random_log(random.Random(11), 120, 25)
    return spark.createDataFrame(rows, SCHEMA).checkpoint(), drafts


def stated(rows):
    """State rows with their payloads as values; list elements are plain texts."""
    return sorted(str((r["submission_id"], r["field"], r["key"], r["pos"], r["payload"]
                       if r["field"] in LISTS else json.loads(r["payload"]))) for r in rows)


def expected(drafts):
    return sorted(str((n, *row)) for n, d in drafts.items() for row in d.state()
                  if row[0] != "links" or row[3])


@pytest.mark.parametrize("rows_per_task", [1, 10**6])
def test_state(built, rows_per_task):
    log, drafts = built
    assert stated(draft.current_state(log, rows_per_task).collect()) == expected(drafts)


@pytest.mark.parametrize("parts", [1, 4])
def test_states_of_parts_merge_in_any_order(built, parts):
    log, drafts = built
    state = None
    for n in random.Random(parts).sample(range(parts), parts):
        part = draft.partial_state(log.where(f"(seq * 7 + submission_id) % {parts} = {n}"))
        state = part if state is None else draft.merged_state(state.unionByName(part)).checkpoint()
    assert stated(draft.standing(state).collect()) == expected(drafts)


@pytest.mark.parametrize("rows_per_task", [1, 10**6])
def test_documents(built, rows_per_task):
    log, drafts = built
    whole = draft.documents(draft.current_state(log, rows_per_task), rows_per_task=rows_per_task)
    text = whole.select("submission_id", submission_json(whole).alias("json")).collect()
    got = {r["submission_id"]: json.loads(r["json"]) for r in text}
    for n, model in drafts.items():
        if any(True for _ in model.state()):
            assert got[n] == model.document(), n
    assert whole.where("part > 0").isEmpty()


def test_large_submissions_take_several_parts(spark):
    rows = [(s, n, "append", "tags", None, f'"t{n}"') for s, size in ((1, 3), (2, 25))
            for n in range(size)]
    rows += [(2, 100 + n, "upsert", "services", f"s{n:02}", "null") for n in range(12)]
    state = draft.current_state(spark.createDataFrame(rows, SCHEMA))
    parts = {(r["submission_id"], r["part"]): r
             for r in draft.documents(state, part_rows=10).collect()}
    assert sorted(parts) == [(1, 0), (2, 0), (2, 1), (2, 2)]
    assert parts[1, 0]["tags"] == ["t0", "t1", "t2"]
    assert [t for p in range(3) for t in parts[2, p]["tags"]] == [f"t{n}" for n in range(25)]
    assert sorted(parts[2, 0]["services"]) + sorted(parts[2, 1]["services"]) == [
        f"s{n:02}" for n in range(12)]
    assert set(parts[2, 0]["services"].values()) == {"true"}
