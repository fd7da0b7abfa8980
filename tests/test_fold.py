"""Folds of edit logs against a plain model of a submission being built."""

import json
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.operators import fold

OPS = ["append", "upsert", "delete", "set", "clear", "reset"]
edits = st.lists(st.tuples(st.integers(1, 2), st.sampled_from(OPS),
                           st.sampled_from(["a", "b", "test"]), st.integers(1, 5)), max_size=25)
SCHEMA = "submission_id int, seq int, op string, key string, payload string"
quick = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def log_of(spark, edits):
    return spark.createDataFrame(
        [(s, n, op, key, str(p)) for n, (s, op, key, p) in enumerate(edits)], SCHEMA)


def result(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@quick
@given(edits)
def test_clear_and_reset(spark, edits):
    # A reset clears all fields but "test"; a clear one field.
    log = log_of(spark, edits)
    got = fold.after_clear(fold.after_reset(log, keep=["test"]))
    assert result(got, "submission_id", "seq", "key", "op", "payload") == sorted(replay(edits))


def replay(edits):
    """Edits left after clears and resets, taken one by one."""
    left = []
    for n, (s, op, key, payload) in enumerate(edits):
        if op == "clear":
            left = [e for e in left if (e[0], e[2]) != (s, key)]
        elif op == "reset":
            left = [e for e in left if e[0] != s or e[2] == "test"]
        else:
            left.append((s, n, key, op, str(payload)))
    return left


@quick
@given(edits, st.sampled_from([3, 10**6]))
def test_appended_lists(spark, edits, rows_per_task):
    lists = defaultdict(list)
    for s, op, key, payload in edits:
        if op == "append":
            lists[s, key].append(str(payload))
    elements = fold.appended(log_of(spark, edits), [F.floor(F.col("seq") / 4)], rows_per_task)
    assert result(elements, "submission_id", "key", "pos", "payload") == sorted(
        (s, key, n, p) for (s, key), texts in lists.items() for n, p in enumerate(texts, 1))
    chunks = fold.in_chunks(elements, chunk_size=3).collect()
    assert all(len(c["payloads"]) <= 3 for c in chunks)
    joined = defaultdict(list)
    for c in sorted(chunks, key=lambda c: c["chunk"]):
        joined[c["submission_id"], c["key"]] += c["payloads"]
    assert joined == lists


@quick
@given(edits)
def test_last_first_and_deleted(spark, edits):
    last, first, kept = {}, {}, {}
    for s, op, key, payload in edits:
        if op == "set":
            last[s, key] = str(payload)
            first.setdefault((s, key), str(payload))
        if op == "upsert":
            kept[s, key] = str(payload)
        elif op == "delete":
            kept.pop((s, key), None)
    log = log_of(spark, edits)
    flat = lambda d: sorted((s, key, p) for (s, key), p in d.items())
    sets = log.where("op = 'set'")
    columns = ("submission_id", "key", "payload")
    assert result(fold.last_write(sets), *columns) == flat(last)
    assert result(fold.first_write(sets), *columns) == flat(first)
    assert result(fold.without_deleted(log), *columns) == flat(kept)


@pytest.mark.parametrize("payload", [None, "null", "{}", " [ ] ", "false", "0", '""'])
def test_falsy_data_deletes(spark, payload):
    log = spark.createDataFrame([(1, 1, "upsert", "p", '{"a": 1}'), (1, 2, "upsert", "p", payload),
                                 (1, 3, "upsert", "q", '{"b": 1}')], SCHEMA)
    assert result(fold.without_deleted(log), "key") == [("q",)]


def test_invalid_edit_leaves_the_earlier_value(spark):
    log = spark.createDataFrame([(1, 1, "upsert", "p", json.dumps({"a": 1})),
                                 (1, 2, "upsert", "p", '{"a": NaN}'),
                                 (1, 3, "upsert", "p", '{"a": -1e999}')], SCHEMA)
    got = fold.upserted(fold.valid_edits(log))
    assert result(got, "key", "payload") == [("p", '{"a": 1}')]


def test_an_upsert_replaces_a_value_whole(spark):
    """The last of several values of a key stands, with nothing of the earlier ones."""
    values = [("shelf", {"row": n, **({"lamp": "on"} if n % 2 else {})}) for n in range(4)]
    values += [("box", {"row": 9}), ("shelf", {"left": []})]
    log = spark.createDataFrame([(8, n, "upsert", key, json.dumps(value))
                                 for n, (key, value) in enumerate(values)], SCHEMA)
    got = {k: json.loads(v) for k, v in result(fold.upserted(log), "key", "payload")}
    assert got == dict(values)


@pytest.mark.parametrize("payload, falsy", [
    (None, True), ("", True), (" null ", True), ("false", True), ("0", True), ("-0", True),
    ("0.00", True), ("0e5", True), ('""', True), ("[ ]", True), ("{\n}", True), ('" "', False),
    ("[0]", False), ("1", False), ("0.01", False), ('"0"', False), ("true", False)])
def test_falsy(rows, payload, falsy):
    assert rows([(payload,)], "p string", f=fold.is_falsy(F.col("p"))) == [(falsy,)]


def test_rejected_edits_have_a_reason(spark):
    payloads = ['{"a": 1}', '{"a"', '{"a": 1e400}', None, "1" + "0" * 220 + "e99",
                '{"a":"Infinity","a":1e400}', '{"a":"\\u0049nfinity","b":"e100"}', '"1e999 \\" 1e999"']
    log = spark.createDataFrame([(1, n, "set", "k", p) for n, p in enumerate(payloads)],
                                "submission_id int, seq int, op string, key string, payload string")
    got = {r["seq"]: r["reason"] for r in fold.rejected_edits(log).collect()}
    assert got == {1: "malformed", 2: "not finite", 4: "not finite", 5: "not finite"}
    assert sorted(r["seq"] for r in fold.valid_edits(log).collect()) == [0, 3, 6, 7]


def test_very_large_documents_are_not_called_malformed(spark):
    large = spark.range(1).select(F.lit(1).alias("submission_id"), F.concat(
        F.lit('"'), F.repeat(F.lit("x"), 20 * 1024 * 1024), F.lit('"')).alias("payload"))
    kept, refused = fold.valid_edits(large).count(), fold.rejected_edits(large).select(
        "reason").collect()
    assert kept == 1 or [r["reason"] for r in refused] == ["too large"]
