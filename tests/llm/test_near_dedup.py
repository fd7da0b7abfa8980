"""Near-duplicate groups against comparing all pairs."""

import random

import pytest

from shelfmark.llm import near_dedup
from shelfmark.llm.components import components


def shingle_set(text, length):
    words = text.translate({c: c + 32 for c in range(65, 91)}).split()
    if len(words) < length:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + length]) for i in range(len(words) - length + 1)}


def brute(texts, length, similarity=0.8):
    sets = [shingle_set(t, length) for t in texts]
    group = list(range(len(texts)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and both >= similarity * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return [root(i) for i in range(len(texts))]


def corpus(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"W{k}" for k in range(400)]
    bases = [[draw.choice(vocabulary) for _ in range(draw.randint(1, 120))] for _ in range(n // 6)]
    texts = []
    for _ in range(n):
        words = list(draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 2, 4, 8])):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("length", [2, 5])
def test_groups_equal_all_pairs(spark, length):
    texts = corpus(length, 300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in near_dedup.groups(docs, length=length).collect()}
    for i, least in enumerate(brute(texts, length)):
        assert (got[i].component_id, got[i].kept) == (least, least == i)
        assert got[i].n_shingles == len(shingle_set(texts[i], length))


def test_large_group_of_near_copies(spark, monkeypatch):
    """Nodes that never fall apart, and chains through them."""
    monkeypatch.setattr(near_dedup, "NODE_ROWS", 8)
    draw = random.Random(9)
    base = [f"b{k}" for k in range(60)]
    texts = []
    for k in range(250):
        words = list(base)
        words[draw.randrange(60)] = f"x{k}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.component_id for r in near_dedup.groups(docs, length=2).collect()}
    assert len(got) == len(set(brute(texts, 2))) == 1


@pytest.mark.parametrize("depth, block_rows", [(5, 1024), (3, 100)])
def test_template_family(spark, monkeypatch, depth, block_rows):
    """Texts of one template, 0.71 to each other, with few pairs just above 0.8 among them."""
    monkeypatch.setattr(near_dedup, "DEPTH", depth)
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block_rows)
    n, pairs = 1500, 25
    template = " ".join(f"t{k}" for k in range(100))
    texts = [template + "".join(f" own{i}x{k}" for k in range(20)) for i in range(n)]
    for p in range(pairs):
        for i in (p, n - 1 - p):
            texts[i] = (template + "".join(f" pair{p}x{k}" for k in range(10))
                        + "".join(f" own{i}x{k}" for k in range(13)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.groups(docs, length=1).collect()}
    assert got == {i: n - 1 - i if i >= n - pairs else i for i in range(n)}


def test_shared_counts():
    draw = random.Random(8)
    sets = [near_dedup.shingles([b"%d" % draw.randrange(3000) for _ in range(k * 40)], 1)
            for k in range(60)]
    both = near_dedup.shared(sets[:20], sets[20:])
    assert both.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[20:]]
                             for a in sets[:20]]
    assert near_dedup.shared(sets[:3], []).shape == (3, 0)


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(200, 300)] + [(7, 7)]
    got = {r.node: r.root for r in components(
        spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[k] == 100 for k in range(100, 161))
    assert all(got[k] == 5 for k in range(200, 300))
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_of_each_group_also_of_repeated_rows(spark):
    texts = corpus(3, 60)
    rows = [(i, t, k) for i, t in enumerate(texts) for k in range(1 + (i % 5 == 0))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key int")
    got = near_dedup.one_of_each(docs, length=2)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(brute(texts, 2)))
