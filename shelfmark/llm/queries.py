"""The registered query of each operator of this subpackage, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    alignment, bpe, classifier, decontam, html_extract, lm, merkle, near_dedup, pii,
    quality_rules, sharding, token_counts, warc)
from shelfmark.llm.common import stored, table
from shelfmark.session import work_folder


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.encode_decode(table(spark, sf_dir, "documents"), path))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data in every document."""
    return pii.report(pii.spans(table(spark, sf_dir, "documents")))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the quality rules for every document."""
    return quality_rules.report(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.report(html_extract.main_texts(table(spark, sf_dir, "pages")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items that they hold."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
                          ).withColumn("leaked", F.lit(True))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document: sets of two-word shingles, Jaccard 0.8."""
    return near_dedup.groups(table(spark, sf_dir, "documents"), similarity=0.8, length=2)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every line of every document, from one encoding of the whole."""
    counts = token_counts.count(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN)
    return counts.select("doc_id", "section", "start", "end",
                         F.col("tokens").cast("bigint").alias("n_tokens"), "crossing")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    trees = classifier.train(docs, table(spark, sf_dir, "labels"))
    return classifier.report(classifier.scores(docs, trees))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language model scores of every document."""
    return lm.fit_and_score(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in eight shards of nearly equal size."""
    return sharding.report(sharding.assign(table(spark, sf_dir, "documents")))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers align in every document, and how common the pairs are."""
    return alignment.report(alignment.measures(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), with_groups=False))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proof of every document in the manifest of all, held against a tampered copy."""
    docs = table(spark, sf_dir, "documents")
    rows = stored(merkle.leaves(docs, now={"text": merkle.without_line_ends()}), "hashed")
    return merkle.report(merkle.proofs(rows))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back as a capture."""
    folder = work_folder(spark, "archives")
    warc.write(table(spark, sf_dir, "pages"), folder)
    records = stored(warc.read(spark, folder, with_payload=False), "records")
    return warc.report(warc.captures(records))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_pii": op2_pii,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_extraction": op4_html_extraction,
    "op5_decontamination": op5_decontamination,
    "op6_near_dedup": op6_near_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_sharding": op10_sharding,
    "op11_alignment": op11_alignment,
    "op12_merkle": op12_merkle,
    "op13_warc": op13_warc,
}
ORACLE = {
    "op3_quality_rules": quality_rules.ORACLE,
    "op6_near_dedup": near_dedup.ORACLE,
    "op12_merkle": merkle.ORACLE,
    "op13_warc": warc.ORACLE,
}
