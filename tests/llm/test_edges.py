"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, per operator."""

import public_tokenizers
import pytest

from shelfmark.llm import (
    bpe, classifier, decontam, html_extract, lm, near_dedup, pii, quality_rules, sharding,
    token_counts)
from shelfmark.llm.common import prepared

BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

CLASHING = ("ids", "key", "sig", "leaf", "path", "comp", "score", "_text", "_words", "_key", "h",
            "c", "kind", "host", "_host", "tail", "shard", "slot", "size", "base", "masked",
            "item_id", "text_crc32", "_label", "f0", "node", "root", "_kept", "_rows", "_one",
            "_set_key", "_chosen", "row", "id", "kept", "n", "one", "chosen", "set_key", "leaves")
ROWS = [(1, None), (2, ""), (3, "   \n\t "), (4, "a"), (5, "a"), (5, "a"), (None, "b c d"),
        (None, None), (6, "word " * 60_000), (7, "x" * 200_000), (8, "éß漢字 \U0001d518 <|"),
        (9, "mail me at jo.1@host.example.com please")]


@pytest.fixture(scope="module")
def docs(spark):
    prepared(spark)
    rows = [(i, t, *([1] * len(CLASHING))) for i, t in ROWS]
    schema = "doc_id bigint, text string, " + ", ".join(f"`{c}` int" for c in CLASHING)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(i, i % 2) for i in range(12)] + [(3, None), (None, 1), (4, 1)],
        "doc_id bigint, quality int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "mail me at jo 1 host example com"),
                                  (4, "mail me at jo 1 host example com")],
                                 "item_id bigint, text string")


PER_ROW = {
    "bpe": lambda d, l, b: bpe.digests(bpe.encode_decode(d, BPE)),
    "pii": lambda d, l, b: pii.report(pii.spans(d)),
    "rules": lambda d, l, b: quality_rules.report(d),
    "near": lambda d, l, b: near_dedup.groups(d, length=2),
    "classifier": lambda d, l, b: classifier.report(
        classifier.scores(d, classifier.train(d, l))),
    "lm": lambda d, l, b: lm.fit_and_score(d),
    "sharding": lambda d, l, b: sharding.report(sharding.assign(d)),
}
KEEPING = {
    "masked": lambda d, l, b: pii.mask_texts(d),
    "good": lambda d, l, b: classifier.keep_good(d, classifier.train(d, l), threshold=0.0),
    "clean": lambda d, l, b: decontam.without_leaks(d, b),
    "one": lambda d, l, b: near_dedup.one_of_each(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(name, docs, labels, benchmark):
    out = PER_ROW[name](docs, labels, benchmark).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in ROWS)
    by_id = {}
    for row in out:
        by_id.setdefault(row.doc_id, []).append(row)
    same = [tuple(v for k, v in r.asDict().items() if k not in ("slot", "doc_id"))
            for r in by_id[5]]
    assert same[0] == same[1]


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(name, docs, labels, benchmark):
    none = docs.limit(0)
    out = PER_ROW[name](none, labels, benchmark)
    assert out.count() == 0
    assert out.columns == PER_ROW[name](docs, labels, benchmark).columns


@pytest.mark.parametrize("name", KEEPING)
def test_stages_keep_all_columns(name, docs, labels, benchmark):
    out = KEEPING[name](docs, labels, benchmark)
    assert out.columns == docs.columns
    got = [r.doc_id for r in out.collect()]
    if name == "clean":
        assert 9 not in got and len(got) == len(ROWS) - 1
    elif name == "one":
        assert {4, 9, 1, 2, 3} <= set(got) and 5 not in got
    else:
        assert len(got) == len(ROWS)
    assert KEEPING[name](docs.limit(0), labels, benchmark).count() == 0


def test_leaks_of_equal_items(docs, benchmark):
    got = decontam.leaks(docs, benchmark).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == [(9, 3, 0), (9, 4, 0)]
    assert decontam.leaks(docs, benchmark.limit(0)).count() == 0
    assert decontam.without_leaks(docs, benchmark.limit(0)).count() == len(ROWS)


def test_sections_of_every_document(docs):
    rows = token_counts.count(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted({str(r.doc_id) for r in rows}) == sorted({str(i) for i, _ in ROWS})
    assert [(r.section, r.start, r.end, r.tokens) for r in rows if r.doc_id == 2] == [(0, 0, 0, 0)]


def test_pages_of_all_kinds(spark):
    pages = spark.createDataFrame(
        [(1, None, None, 1, 1), (1, "http://a.b/", "", 1, 1), (None, "odd", "<p>x", 1, 1),
         (2, "http://A.b/2", "<body><p>one<p>two</body>", 1, 1),
         (2, "http://A.b/2", "<body><p>one<p>two</body>", 1, 1),
         (3, "http://a.b/3", "<p>" + "long " * 100_000, 1, 1)],
        "page_id bigint, url string, html string, host int, path int")
    got = html_extract.report(html_extract.main_texts(pages)).collect()
    texts = sorted((str(r.page_id), r.text[:20], r.n_chars) for r in got)
    assert texts == [("1", "", 0), ("1", "", 0), ("2", "one\ntwo", 7), ("2", "one\ntwo", 7),
                     ("3", "long long long long ", 499_999), ("None", "x", 1)]
    assert html_extract.main_texts(pages.limit(0)).count() == 0


def test_nulls_count_as_empty(docs):
    rows = {r.doc_id: r for r in quality_rules.report(docs).collect()}
    assert [rows[1][k] for k in ("n_words", "word_chars", "n_dup_lines", "n_repeat_words")] == [0] * 4
    assert rows[1].base_failed and not rows[1].kept
    assert rows[6].n_repeat_words == rows[6].n_words == 60_000
    near = {r.doc_id: r for r in near_dedup.groups(docs, length=2).where(
        "doc_id is not null").collect()}
    assert (near[1].n_shingles, near[1].component_id, near[1].kept) == (0, 1, True)
    assert near[5].component_id == 4 and not near[5].kept and near[4].kept


def test_one_of_each_of_null_and_repeated_ids(spark):
    texts = [" ".join(f"{name}{k}" for k in range(30)) for name in "abcdefg"]
    rows = [(None, texts[0], 0), (None, texts[1], 1), (None, texts[1], 2),   # null, copies
            (1, texts[2], 3), (1, texts[3], 4), (1, texts[3], 5),           # other texts of an id
            (2, texts[4], 6), (None, texts[4], 7),                          # a copy without an id
            (3, texts[5], 8), (4, texts[5], 9), (4, texts[6], 10),          # a copy of a shared id
            (None, None, 11), (None, "", 12), (5, "", 13), (5, " ", 14)]
    got = near_dedup.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string, n int"))
    kept = sorted(r.n for r in got.collect())
    assert sum(n in (1, 2) for n in kept) == sum(n in (4, 5) for n in kept) == 1
    assert [n for n in kept if n not in (1, 2, 4, 5)] == [0, 3, 6, 8, 10, 11, 12, 13, 14]
