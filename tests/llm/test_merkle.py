"""The manifest and its proofs against a tree built level by level from a list."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree int, idx int, part int, hash string"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return digest(field(row[0]), field(row[3]), field(row[2]), field(row[4]), field(text))


def tree(hashes):
    """The root, and for every leaf the siblings on its way."""
    paths, places, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for n, at in enumerate(places):
            run = range(at - at % 3, min(at - at % 3 + 3, len(level)))
            paths[n].append(("".join(level[k] for k in run if k < at),
                             "".join(level[k] for k in run if k > at)))
            places[n] = at // 3
        level = [digest(*level[k:k + 3]) for k in range(0, len(level), 3)]
    return level[0], paths


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subtrees = [(sorted(groups[s], key=lambda x: x[:3])) for s in order]
    made = [tree([x[2] for x in members]) for members in subtrees]
    root, above = tree([m[0] for m in made])
    return [(x[3][0], x[2], made[k][0], root, made[k][1][n] + above[k])
            for k, members in enumerate(subtrees) for n, x in enumerate(members)]


def data(n, sources, seed=1):
    draw = random.Random(seed)
    rows = [(k, draw.choice(["a\nb", "", None, "é\n\n漢字" * 3, f"text {k}"]),
             draw.choice(["en", None]), draw.choice(sources), draw.choice([k, None]), 1, 2, 3, "x")
            for k in range(n)]
    return rows + rows[:3] + [(None, "no id", None, sources[0], None, 1, 2, 3, "x")] * 2


@pytest.mark.parametrize("n, sources, levels", [
    (200, [None, "hot", "hot", "hot", "é", "z", "a"], 1), (130, ["only"], 2), (90, ["a", "b"], 7),
    (1, ["one"], 1), (60, [f"s{k}" for k in range(40)], 1)])
def test_proofs(spark, n, sources, levels):
    rows = data(n, sources)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = merkle.proofs(merkle.leaves(docs), levels=levels).collect()
    got = [(r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in got]
    assert sorted(map(str, got)) == sorted(map(str, expected(rows)))


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_proofs_of_some_rows_are_those_of_all(spark, levels):
    rows = merkle.leaves(spark.createDataFrame(data(150, ["a", "b", "b", None]), SCHEMA))
    wanted = spark.createDataFrame([(5,), (6,), (77,), (400,), (None,)], "doc_id bigint")
    of = lambda df: sorted(str(r) for r in df.collect())
    some = merkle.proofs(rows, wanted, levels)
    every = merkle.proofs(rows, levels=levels).where("doc_id in (5, 6, 77) or doc_id is null")
    assert of(some) == of(every)


def test_fewest_missing_nodes():
    assert merkle.missing({0}, 1) == []
    assert merkle.missing({0, 1, 2}, 9) == [(1, 1), (1, 2)]
    assert merkle.missing({0, 8}, 9) == [(0, 1), (0, 2), (0, 6), (0, 7), (1, 1)]
    assert merkle.missing({9}, 10) == [(2, 0)]


def test_tampering_shows(spark):
    docs = spark.createDataFrame(data(80, ["a", "b", "c"]), SCHEMA)
    rows = merkle.leaves(docs, now={"text": merkle.without_line_ends()})
    got = merkle.report(merkle.proofs(rows, levels=1)).join(
        docs.select("doc_id", "text").dropDuplicates(["doc_id"]), "doc_id")
    changed = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.col("text").contains("\n")
    found = got.select("verified", F.coalesce(changed, F.lit(False)).alias("changed"),
                       (F.col("folded_root") == F.col("root")).alias("same")).collect()
    assert {r.changed for r in found} == {True, False}
    assert all(r.verified == r.same == (not r.changed) for r in found)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    out = merkle.report(merkle.proofs(merkle.leaves(docs)))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                           "verified"] and out.count() == 0
