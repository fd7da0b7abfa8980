"""The pipeline against its stages done by hand on small tables."""

import random

import pytest

import corpus_pipeline
from shelfmark.llm import bpe


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(3)
    vocabulary = [f"word{k}" for k in range(300)]

    def prose(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n)) + "."
    passage = prose(30)
    rows = [(i, prose(80)) for i in range(60)]
    rows += [(100 + i, "BUY!! NOW!! " * 30) for i in range(30)]
    rows += [(200, rows[0][1]), (201, rows[1][1] + " tail"), (300, prose(40) + passage + prose(9)),
             (400, prose(40) + " me@host.example.com " + prose(9)),
             (500, prose(40) + " me [at] host [dot] net " + prose(9))]
    at = tmp_path_factory.mktemp("tables")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, "
                                 "n_chars bigint")
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 0 if 100 <= i < 200 else 1) for i, _ in rows if i < 200],
                          "doc_id bigint, quality int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(
        f"{at}/benchmark.parquet")
    return str(at)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = {"quality classifier": set(range(60)) | {200, 201, 300, 400, 500}}
    want["near-duplicates"] = want["quality classifier"] - {200, 201}
    want["benchmark decontamination"] = want["near-duplicates"] - {300}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, folder)
        got = {r.doc_id for r in docs.select("doc_id").collect()}
        assert got == want.get(name, want["benchmark decontamination"]), name
        if name != "bpe":
            assert docs.columns == before.columns


def test_run(spark, folder):
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert len(rows) == 62
    assert "host" not in rows[400].decoded and "host" not in rows[500].decoded
    assert all(len(r.ids) == 4 * r.n_tokens for r in rows.values())
    [again] = bpe.WordBpe(bpe_path()).encode_batch(
        [spark.read.parquet(f"{folder}/documents.parquet").where("doc_id = 5").first().text])
    assert again == bytes(rows[5].ids)


def written(spark, folder, rows, schema):
    """Tables of a folder with other documents."""
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id bigint, quality int"
                          ).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "never in any of the documents here"), (2, None), (3, "")],
                          "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_odd_rows_and_clashing_names(spark, tmp_path):
    names = ["_kept", "_rows", "_one", "_set_key", "_chosen", "row", "id", "key", "ids", "score",
             "leaf", "comp", "masked", "_text", "_id", "n_tokens", "decoded", "item_id", "path"]
    texts = [None, "", " \n", "word", "word", "two words", "x" * 50_000, "a b c d e f g " * 5_000]
    rows = [(n if n != 5 else None, t, *[n] * len(names)) for n, t in enumerate(texts)]
    rows += [rows[6], rows[0]]
    folder = written(spark, tmp_path, rows, "doc_id bigint, text string, " + ", ".join(
        f"`{n}` int" for n in names))
    got = corpus_pipeline.run(spark, folder).collect()
    # What stays once each: all but copies with words, and what the classifier takes away.
    assert {r.doc_id for r in got} <= {n for n in range(len(texts))} | {None}
    assert sum(r.doc_id in (3, 4) for r in got) <= 1 and sum(r.doc_id == 6 for r in got) <= 1


def test_empty_tables(spark, tmp_path):
    folder = written(spark, tmp_path, [], "doc_id bigint, text string, lang string")
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "ids", "n_tokens", "decoded"] and out.count() == 0


def bpe_path():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
