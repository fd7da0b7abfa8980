"""Passages with edits against full tables of distances."""

import random

import pytest

from shelfmark.llm import decontam


def brute(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        above, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(above[j - 1] + (a != b), above[j] + 1, row[j - 1] + 1))
    return min(row)


def test_distance():
    draw = random.Random(1)
    for _ in range(800):
        item = "".join(draw.choice("abc ") for _ in range(draw.randint(1, 30)))
        text = "".join(draw.choice("abc ") for _ in range(draw.randint(0, 60)))
        assert decontam.Pattern(item).distance(text) == min(brute(item, text), len(item))


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.25])
def test_all_items_within_budget_are_found(rate):
    draw = random.Random(2)
    words = ["ab", "ba", "aab", "c", "Abc,"]
    for _ in range(300):
        items = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(1, 14))))
                 for i in range(4)]
        text = " ".join(draw.choice(words) for _ in range(draw.randint(0, 40)))
        got = {h.item: h.distance for h in decontam.Searcher(items, rate).find(text)}
        want = {}
        for i, item in items:
            item = decontam.normal(item)
            least = brute(item, decontam.normal(text))
            if text and least <= int(rate * len(item)):
                want[i] = least
        assert got == want


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 30)
    items = [(i, f"item number {i} about topic {i * i}") for i in range(7)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = spark.createDataFrame(
        [(i, f"Well: {t.upper()}!" if i % 2 else "nothing here") for i, t in items],
        "doc_id bigint, text string")
    got = decontam.leaks(docs, benchmark, rate=0.02).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (3, 3), (5, 5)]
    left = decontam.without_leaks(docs, benchmark, rate=0.02).collect()
    assert sorted(r.doc_id for r in left) == [0, 2, 4, 6]


def test_blocks_give_what_one_walk_gives(spark, monkeypatch):
    """Equal items, null and repeated ids, empty texts and clashing names, in many blocks."""
    draw = random.Random(5)
    words = ["mill", "river", "old", "found", "again", "they", "the"]
    def text(n):
        return " ".join(draw.choice(words) for _ in range(n))
    items = [(k % 9 if k % 4 else None, text(draw.randint(1, 9))) for k in range(40)]
    items += items[:6] + [(50, None), (51, ""), (52, "..."), (53, items[0][1])]
    docs = [(k % 30 if k % 7 else None, text(draw.randint(0, 60)), k, "x") for k in range(60)]
    docs += [(1, None, 60, "x"), (2, "", 61, "x"), *docs[:9]]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, _key int, _block string")
    def both():
        found = decontam.leaks(frame, benchmark, 0.1)
        kept = decontam.without_leaks(frame, benchmark, 0.1)
        assert kept.columns == frame.columns
        return [sorted(map(str, df.collect())) for df in (found, kept)]
    want = both()
    assert want[0] and want[1]
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 400)
    assert decontam.small(benchmark) is None and decontam.distinct_texts(benchmark)[1] > 3
    assert both() == want
    none = spark.createDataFrame([], frame.schema)
    assert decontam.leaks(none, benchmark).count() == 0
    assert decontam.without_leaks(none, benchmark).count() == 0


def test_empty_benchmark(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "some text")], "doc_id bigint, text string")
    assert decontam.leaks(docs, none).count() == 0
    assert decontam.without_leaks(docs, none).count() == 1


def test_item_ids_of_any_type(spark):
    docs = spark.createDataFrame([("d1", "so they found the old mill by the river again")],
                                 "doc_id string, text string")
    items = [("q-1", "the old mill by the river"), (None, "found the old mill by the river")]
    for kind, ids in (("string", [i for i, _ in items]), ("date", [None, None])):
        rows = [(i, t) for i, (_, t) in zip(ids, items, strict=True)]
        got = decontam.leaks(docs, spark.createDataFrame(rows, f"item_id {kind}, text string"))
        assert sorted(str((r.doc_id, r.item_id, r.distance)) for r in got.collect()) == sorted(
            str(("d1", i, 0)) for i in ids)
