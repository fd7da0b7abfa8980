"""A quality classifier: histogram gradient-boosted trees over statistics of documents.

Statistics of whole texts are the only inputs of a score: no id, label, language or source. The
trees are fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, the first by a hash of the
id), and flattened into arrays, through which numpy moves all rows of a batch at once.

Null and empty texts have statistics like others (all counts 0) and get a score. Rows labelled
twice count once, with the higher label; rows without a label or id teach nothing. Without any
labelled row every score is 0.5, with one class only it is near that class. Repeated rows get
equal scores, an empty table gives an empty result. Only the named columns are read for scores;
``keep_good`` keeps all columns as they are.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import map_batches, texts_of

SAMPLE_ROWS = 30_000  # labelled rows that are learned from at most
THRESHOLD = 0.3
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
LEAST_ROWS = 8
PULL = 1.0  # of leaf values towards 0

FEATURES = (
    "log_chars", "log_words", "word_length", "distinct_words", "top_word", "repeated_neighbours",
    "capitals", "digits", "wide", "symbols", "exclamations", "stops", "line_words",
    "repeated_lines", "entropy", "longest_word")
_SYMBOLS = np.frombuffer(b"#*$%&|<>{}[]^~_=\\", np.uint8)


def statistics(text: str) -> list[float]:
    """The features of one text."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(data, minlength=256)
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    n, w, size = len(text), max(1, len(words)), max(1, len(data))
    tally = Counter(words)
    share = counts[counts > 0] / size
    return [
        np.log1p(n), np.log1p(len(words)), sum(map(len, words)) / w, len(tally) / w,
        max(tally.values(), default=0) / w, sum(map(eq, words, words[1:])) / w,
        counts[65:91].sum() / size, counts[48:58].sum() / size, counts[128:].sum() / size,
        counts[_SYMBOLS].sum() / w, counts[33] / w, (counts[46] + counts[44]) / w,
        np.log1p(len(words) / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)), -float((share * np.log2(share)).sum()),
        np.log1p(max(map(len, tally), default=0))]


def features(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


@dataclass
class Trees:
    """Complete trees of ``DEPTH`` levels, one row of each array per tree. Node ``i`` leads to
    ``2 i + 1``, or ``2 i + 2`` if the feature is above the limit."""

    start: float
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of features."""
        n, trees = len(x), len(self.feature)
        total = np.full(n, self.start)
        if trees and n:
            rows, which = np.arange(n)[:, None], np.arange(trees)[None, :]
            node = np.zeros((n, trees), np.int64)
            for _ in range(DEPTH):
                above = x[rows, self.feature[which, node]] > self.limit[which, node]
                node = 2 * node + 1 + above
            total += self.leaf[which, node - (2 ** DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees that follow the gradient of the logistic loss, split at histogram bins."""
    inner = 2 ** DEPTH - 1
    n = len(y)
    mean = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(mean / (1 - mean)))
    none = Trees(start, np.zeros((0, inner), np.int64), np.zeros((0, inner)),
                 np.zeros((0, inner + 1)))
    if n < 2 * LEAST_ROWS or y.min() == y.max():
        return none
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))
             for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)])
    total = np.full(n, start)
    features_, limits, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-6)
            at = np.zeros((2, width), np.int64) - 1
            for f in range(len(edges)):
                cell = (node - first) * BINS + binned[f]
                g, h, c = (np.bincount(cell, v, width * BINS).reshape(width, BINS).cumsum(axis=1)
                           for v in (gradient, weight, None))
                gr, hr, cr = g[:, -1:] - g, h[:, -1:] - h, c[:, -1:] - c
                gain = (g * g / (h + PULL) + gr * gr / (hr + PULL)
                        - g[:, -1:] ** 2 / (h[:, -1:] + PULL))
                gain[(c < LEAST_ROWS) | (cr < LEAST_ROWS)] = 0
                cut = gain.argmax(axis=1)
                better = gain[np.arange(width), cut] > best
                best[better] = gain[np.arange(width), cut][better]
                at[0, better], at[1, better] = f, cut[better]
            for k in np.flatnonzero(at[0] >= 0):
                feature[first + k], limit[first + k] = at[0, k], edges[at[0, k]][at[1, k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > limit[node])
        cell = node - inner
        g, h = (np.bincount(cell, v, inner + 1) for v in (gradient, weight))
        leaf = -RATE * g / (h + PULL)
        total += leaf[cell]
        features_.append(feature)
        limits.append(limit)
        leaves.append(leaf)
    return Trees(start, np.array(features_), np.array(limits), np.array(leaves))


def held_out(id_col: str = "doc_id", parts: int = 5) -> Column:
    """Whether an id is set aside: the checksum of its text leaves no remainder."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Trees:
    """Trees fitted on labelled rows that are not held out, ``sample_rows`` of them at most."""
    known = (labels.where(~held_out(id_col)).groupBy(id_col)
             .agg(F.max(label_col).alias("_label")).dropna()
             .orderBy(F.xxhash64(id_col), id_col).limit(sample_rows))
    # At most sample_rows ids and labels: small enough for every task.
    rows = docs.select(id_col, F.col(text_col).alias("_text")).join(F.broadcast(known), id_col)
    names = [f"f{i}" for i in range(len(FEATURES))]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features(texts_of(batch, "_text"))
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), batch.column("_label").cast(pa.float64()), *map(pa.array, x.T)],
            [id_col, "_label", *names])
    kind = docs.schema[id_col].dataType.simpleString()
    got = (map_batches(rows, [id_col, "_text", "_label"],
                       f"`{id_col}` {kind}, _label double, " + ", ".join(
                           f"{n} double" for n in names), work)
           # Repeated documents teach once, as the bound is one of rows.
           .groupBy(id_col).agg(F.max("_label").alias("_label"),
                                *[F.max(n).alias(n) for n in names])
           .toPandas().sort_values(id_col))
    return fit(got[names].to_numpy(np.float64), got["_label"].to_numpy(np.float64))


def scores(docs: DataFrame, trees: Trees, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per document its id and ``score``, the probability of label 1."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), pa.array(trees.score(features(texts_of(batch, text_col))))],
            [id_col, "score"])
    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs, [id_col, text_col], f"`{id_col}` {kind}, score double", work)


def keep_good(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD,
              text_col: str = "text") -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(
            trees.score(features(texts_of(batch, text_col))) >= threshold))
    return map_batches(docs, docs.columns, docs.schema, work)


def report(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
