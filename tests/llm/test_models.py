"""The classifier and the language model: held-out quality, exact counts, proper probabilities."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm import classifier, lm


def test_trees_separate_and_flatten():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(3000, len(classifier.FEATURES)))
    y = ((x[:, 2] > 0.3) ^ (x[:, 5] > 0)).astype(float)
    trees = classifier.fit(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95

    def walk(row):
        total = trees.start
        for feature, limit, leaf in zip(trees.feature, trees.limit, trees.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (row[feature[node]] > limit[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))
    assert np.allclose(trees.score(x[:50]), [walk(r) for r in x[:50]])


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = [(i, "good words of prose here. " * (1 + i % 7) if i % 2 else "X!! " * (5 + i % 9))
            for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = [(i, i % 2 if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2) for i in range(300)]
    trees = classifier.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    out = classifier.report(classifier.scores(docs, trees)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(r.predicted == r.doc_id % 2 for r in out)


def test_one_class_or_none(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)],
                                 "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    scores = {r.score for r in classifier.scores(docs, classifier.train(docs, none)).collect()}
    assert scores == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id bigint, quality int")
    assert all(r.score > 0.9 for r in classifier.scores(
        docs, classifier.train(docs, ones)).collect())


@pytest.fixture(scope="module")
def prose():
    draw = random.Random(8)
    tongues = [[f"{p}{k}" for k in range(60)] for p in ("the", "dé", "ñu")]
    rows = []
    for i in range(240):
        words = tongues[i % 3]
        rows.append((i, " ".join(words[min(int(draw.expovariate(0.1)), 59)]
                                 + ("" if draw.random() < 0.9 else str(draw.randrange(10**6)))
                                 for _ in range(draw.randint(0, 120)))))
    return rows


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


@pytest.mark.parametrize("head", [lm.HEAD_WORDS, 50, 0])
def test_base_score_and_gain(spark, prose, head):
    docs = spark.createDataFrame(prose, "doc_id bigint, text string")
    counts = Counter()
    for i, text in prose:
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    texts = dict(prose)
    rows = lm.fit_and_score(docs, head_words=head).collect()
    assert len(rows) == len(prose)
    for r in rows:
        words = tokens(texts[r.doc_id])
        base = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert (r.n_tokens, r.n_known) == (len(words), sum(w in counts for w in words))
        assert r.train_tokens == total
    if head == lm.HEAD_WORDS:
        held = [r for r in rows if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one(prose):
    """Over all known words, and one unknown word of every rare class."""
    lexicon = lm.Lexicon()
    ids, _ = lexicon.numbers([t.encode() for _, t in prose])
    counts = np.bincount(ids)
    order = np.argsort(lexicon.hash)
    h, c, kind = lexicon.hash[order], counts[order], lexicon.kind[order]
    by_kind = {int(k): (int(c[kind == k].sum()), int((kind == k).sum())) for k in np.unique(kind)}
    model = lm.Model.start(int(c.sum()), len(h), h, c, kind, by_kind)
    trainer = lm.Trainer(model)
    trainer.add([t.encode() for _, t in prose[:100]])
    context = model.names(h[:3], kind[:3])
    name = model.names(h, kind)
    rare = name >= lm.WORDS
    for _ in range(2):
        classes, small = model.features(np.append(context, 0), np.zeros(1, np.int64))
        n = len(name)
        log_p = model.log_probabilities(name, np.repeat(classes[-1:], n, 0),
                                        np.repeat(small[-1:], n, 0)).astype(float)
        share = model.rare_total + lm.SMOOTH * (model.rare_distinct + 1)
        log_p[rare] += np.log(c[rare] + lm.SMOOTH) - np.log(share[name[rare] - lm.WORDS])
        unknown = np.arange(lm.WORDS, lm.NAMES)
        log_u = model.log_probabilities(
            unknown, np.repeat(classes[-1:], len(unknown), 0),
            np.repeat(small[-1:], len(unknown), 0)) + np.log(lm.SMOOTH) - np.log(share)
        assert np.exp(log_p).sum() + np.exp(log_u).sum() == pytest.approx(1, abs=1e-3)
        context = context[::-1]


def test_rarer_words_are_known_by_themselves_as_context():
    """Two words beyond the frequent ones, of one class, each followed by a word of its own."""
    frequent = [b"f%d" % k for k in range(lm.WORDS + 100)]
    _, kinds = lm.hashes([b"rare%d" % k for k in range(200)])
    one, other = np.flatnonzero(kinds == np.bincount(kinds).argmax())[:2].tolist()
    one, other = b"rare%d" % one, b"rare%d" % other
    words = [lm.END, *frequent, one, other]
    h, kind = lm.hashes(words)
    order = np.argsort(h)
    counts = np.array([90_000, *[60_000 - 90 * k for k in range(len(frequent))], 1, 1])
    by_kind = {int(k): (int(counts[kind == k].sum()), int((kind == k).sum()))
               for k in np.unique(kind)}
    model = lm.Model.start(int(counts.sum()), len(words), h[order], counts[order], kind[order],
                           by_kind)
    left, right = frequent[10], frequent[400]
    trainer = lm.Trainer(model)
    for _ in range(20):
        trainer.add([one + b" " + left, other + b" " + right] * 20)
    score = lm.Scorer(model).score([a + b" " + b for a in (one, other) for b in (left, right)])[3]
    assert score[0] + score[3] > score[1] + score[2] + 0.5
    # Contexts without a rare word have a row that learns nothing.
    assert model.class_rows[:-1].any() and not model.class_rows[-1].any()
