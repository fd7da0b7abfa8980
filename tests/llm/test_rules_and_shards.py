"""Quality rules and shards against plain Python."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import quality_rules, sharding


def counted(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_counts(spark):
    draw = random.Random(4)
    texts = ["".join(draw.choice(["a ", "b ", "é ", "\n", "# ", "\t", "\x0bc"])
                     for _ in range(draw.randint(0, 80))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in quality_rules.report(docs).collect():
        want = counted(texts[row.doc_id])
        got = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert got == want, texts[row.doc_id]
        assert row.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def test_policies_and_ablations(spark):
    few, symbols = quality_rules.mask(["few_words"]), quality_rules.mask(["many_symbols"])
    ledgers = spark.createDataFrame([(0,), (0,), (few,), (few | symbols,), (symbols,)],
                                    "failed bigint")
    kept = ledgers.select(quality_rules.passes("base").alias("b"),
                          quality_rules.passes("v2").alias("v")).collect()
    assert [r.b for r in kept] == [True, True, False, False, True]
    assert [r.v for r in kept] == [True, True, False, False, False]
    got = {r.rule: (r.n_failed, r.n_failed_alone, r.n_kept_without)
           for r in quality_rules.ablations(ledgers, "v2").collect()}
    assert got["few_words"] == (2, 1, 3) and got["many_symbols"] == (2, 1, 3)
    assert got["repeated_lines"] == (0, 0, 2)


def smallest_capacity(sizes, shards):
    """By trying every sum of neighbours."""
    def fits(capacity):
        used, room = 0, 0
        for size in sizes:
            if size > capacity:
                return False
            if size > room:
                used, room = used + 1, capacity
            room -= size
        return used <= shards
    sums = {sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)}
    return min(c for c in sums if fits(c))


@pytest.mark.parametrize("seed, shards, bits", [(0, 8, 2), (1, 3, 1), (2, 5, 4), (3, 8, 12)])
def test_capacity_is_the_smallest(spark, monkeypatch, seed, shards, bits):
    monkeypatch.setattr(sharding, "LEVEL_BITS", bits)
    draw = random.Random(seed)
    texts = [draw.choice(["copy " * 40, "x" * draw.randint(0, 90), None]) for _ in range(90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    groups = {}
    for row in sharding.sized(docs).collect():
        groups[row["_key"]] = groups.get(row["_key"], 0) + row["size"]
    want = smallest_capacity([groups[k] for k in sorted(groups)], shards)
    capacity, _ = sharding.minimax(sharding.sized(docs), shards)
    assert capacity == want
    placed = sharding.assign(docs, shards).toPandas()
    assert placed.groupby("shard")["size"].sum().max() <= want
    for _, part in placed.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    by_text = {}
    for doc, shard in zip(placed["doc_id"], placed["shard"], strict=True):
        by_text.setdefault(texts[doc] or "", set()).add(shard)
    assert all(len(s) == 1 for s in by_text.values())


def test_pieces_number_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_PIECE", 10)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text"))
    placed = sharding.assign(docs, 4).toPandas()
    assert len(placed) == 3000 and np.ptp(placed.groupby("shard")["size"].sum()) < 4100
    for _, part in placed.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
