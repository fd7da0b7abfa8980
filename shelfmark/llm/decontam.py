"""Benchmark passages in documents, found with a budget of edits.

A test item of ``m`` characters may differ by ``e = floor(rate * m)`` insertions, deletions and
substitutions. Cut into ``e + 1`` pieces, at least one piece of it must then occur unchanged. One
automaton finds all pieces of all items in a single walk over a document; around every hit, the
distance of the item to the best substring is computed with bit vectors.

Texts are compared as lower-case words joined by one blank, with a blank at both ends. Null and
empty items match nothing, nor do such documents. Items of equal text all match. Documents of any
length are searched whole: hits of one item that lie close together share one verification, so
that the work stays in proportion to the text. Repeated rows give repeated results, empty tables
an empty one. Only the named columns are read for the result of pairs; ``without_leaks`` keeps all
columns as they are.

Items may have ids of any type. The size of the benchmark is counted first. Up to ``BLOCK_CHARS``
characters it is sent to the tasks as it is, and one walk over the documents does. A larger one is
grouped by text and dealt by hash into blocks of half that size on average; one block at a time is
sent, and what it finds is written before the next is read, so that neither the driver nor a task
holds more than a block, whatever the benchmark's size. The documents are walked once per block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfmark.llm.common import map_batches, stored, texts_of
from shelfmark.session import work_folder

RATE = 0.08
BLOCK_CHARS = 4_000_000  # characters of a benchmark that is searched for in one walk

_WORD = re.compile(r"\w+")


def normal(text: str) -> str:
    words = " ".join(_WORD.findall(text.lower()))
    return f" {words} " if words else ""


class Pattern:
    """An item as bit masks, for distances to the best substring of a text."""

    def __init__(self, text: str):
        self.text, self.length = text, len(text)
        self.masks: dict[str, int] = {}
        for at, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << at

    def distance(self, text: str) -> int:
        """The least number of edits between the item and any substring of ``text``."""
        full, high = (1 << self.length) - 1, 1 << (self.length - 1)
        plus, minus, score, best = full, 0, self.length, self.length
        get = self.masks.get
        for c in text:
            equal = get(c, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | ~(horizontal | plus)
            down = plus & horizontal
            if up & high:
                score += 1
            elif down & high:
                score -= 1
                best = min(best, score)
            up <<= 1
            plus = ((down << 1) | ~(vertical | up)) & full
            minus = up & vertical & full
        return best


def pieces(length: int, budget: int) -> list[tuple[int, int]]:
    """``budget + 1`` spans of nearly equal length that make up an item."""
    n = min(budget + 1, length)
    ends = [length * k // n for k in range(n + 1)]
    return list(zip(ends, ends[1:], strict=False))


@dataclass
class Hit:
    item: int
    distance: int


class Searcher:
    """All pieces of some items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        self.ids: list[list[int]] = []
        self.patterns: list[Pattern] = []
        self.budgets: list[int] = []
        by_text: dict[str, int] = {}
        where: dict[str, list[tuple[int, int]]] = {}
        for item, text in items:
            text = normal(text or "")
            if not text:
                continue
            if text in by_text:
                self.ids[by_text[text]].append(item)
                continue
            n = by_text[text] = len(self.ids)
            budget = int(rate * len(text))
            self.ids.append([item])
            self.patterns.append(Pattern(text))
            self.budgets.append(budget)
            for begin, end in pieces(len(text), budget):
                where.setdefault(text[begin:end], []).append((n, end))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, places)
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def find(self, text: str) -> list[Hit]:
        """The items within their budget somewhere in a text, each with its least distance."""
        text = normal(text)
        if self.empty or not text:
            return []
        begins: dict[int, list[int]] = {}
        for last, places in self.automaton.iter(text):
            for n, end in places:
                begins.setdefault(n, []).append(last + 1 - end)
        out = []
        for n, found in begins.items():
            pattern, budget = self.patterns[n], self.budgets[n]
            if pattern.text in text:
                best = 0
            else:
                best = budget + 1
                for low, high in self._windows(sorted(set(found)), pattern.length, budget):
                    best = min(best, pattern.distance(text[max(0, low):high]))
            if best <= budget:
                out += [Hit(item, best) for item in self.ids[n]]
        return out

    @staticmethod
    def _windows(begins: list[int], length: int, budget: int) -> Iterator[tuple[int, int]]:
        low = high = None
        for begin in begins:
            if high is not None and begin - budget <= high:
                high = begin + length + budget
            else:
                if high is not None:
                    yield low, high
                low, high = begin - budget, begin + length + budget
        if high is not None:
            yield low, high


def small(benchmark: DataFrame, item_col: str = "item_id",
          text_col: str = "text") -> list[tuple[object, str]] | None:
    """The items with a text, or None if they have more than ``BLOCK_CHARS`` characters."""
    items = benchmark.select(item_col, text_col).where(F.length(text_col) > 0)
    # One more for each item, so that many tiny ones count as well.
    if (items.agg(F.sum(F.length(text_col) + 1)).first()[0] or 0) > BLOCK_CHARS:
        return None
    return [(item, text) for item, text in items.collect()]


def distinct_texts(benchmark: DataFrame, text_col: str = "text") -> tuple[DataFrame, int]:
    """The different texts of a benchmark with a ``_key`` and a ``_block``, and how many blocks."""
    texts = benchmark.select(F.col(text_col).alias("_text")).where("length(_text) > 0").distinct()
    texts = stored(texts.withColumn("_key", F.sha2(F.col("_text").cast("binary"), 256)), "texts")
    chars = texts.agg(F.sum(F.length("_text") + 1)).first()[0] or 0
    n = max(1, -(-2 * chars // BLOCK_CHARS))
    return texts.withColumn("_block", F.expr(f"pmod(xxhash64(_key), {n})")), n


def blocks(texts: DataFrame, n: int) -> Iterator[list[tuple[str, str]]]:
    """One block of keys and texts after the other; the driver holds one at a time."""
    for block in range(n):
        yield [(key, text) for key, text in
               texts.where(F.col("_block") == block).select("_key", "_text").collect()]


def _hits(docs: DataFrame, items: list, rate: float, id_col: str, text_col: str, item_kind: str,
          item_type: pa.DataType, item_col: str = "item_id") -> DataFrame:
    """One row per document and item found in it."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        searcher = _searcher(items, rate)
        at, found, distances = [], [], []
        for row, text in enumerate(texts_of(batch, text_col)):
            for hit in searcher.find(text):
                at.append(row)
                found.append(hit.item)
                distances.append(hit.distance)
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col).take(pa.array(at, pa.int64())),
             pa.array(found, item_type), pa.array(distances, pa.int64())],
            [id_col, item_col, "distance"])
    doc_kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs, [id_col, text_col],
                       f"`{id_col}` {doc_kind}, {item_col} {item_kind}, distance bigint", work)


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document and item found in it, with the ``distance`` in edits."""
    kind = benchmark.schema["item_id"].dataType
    items = small(benchmark)
    if items is not None:
        return _hits(docs, items, rate, id_col, text_col, kind.simpleString(),
                     to_arrow_type(kind))
    texts, n = distinct_texts(benchmark)
    folder = work_folder(docs.sparkSession, "hits")
    for block in blocks(texts, n):
        part = _hits(docs, block, rate, id_col, text_col, "string", pa.string(), "_key")
        part.write.mode("append").parquet(folder)
    hits = docs.sparkSession.read.schema(part.schema).parquet(folder)
    keys = benchmark.select("item_id", F.sha2(F.col("text").cast("binary"), 256).alias("_key"))
    return hits.join(keys, "_key").select(id_col, "item_id", "distance")


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE,
                  text_col: str = "text") -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    items = small(benchmark)
    if items is not None:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            searcher = _searcher(items, rate)
            return batch.filter(pa.array([not searcher.find(t) for t in texts_of(batch, text_col)],
                                         pa.bool_()))
        return map_batches(docs, docs.columns, docs.schema, work)
    # Documents go by the hash of their text, so that ids may be null or repeated.
    texts, n = distinct_texts(benchmark)
    folder = work_folder(docs.sparkSession, "leaked")
    for block in blocks(texts, n):
        def leaked(batch: pa.RecordBatch, block=block) -> pa.RecordBatch:
            searcher = _searcher(block, rate)
            keys = [hashlib.sha256(t.encode()).hexdigest() for t in texts_of(batch, text_col)
                    if searcher.find(t)]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["_key"])
        part = map_batches(docs, [text_col], "_key string", leaked).distinct()
        part.write.mode("append").parquet(folder)
    found = docs.sparkSession.read.schema("_key string").parquet(folder).distinct()
    same = F.sha2(docs[text_col].cast("binary"), 256) == found["_key"]
    return docs.join(found, same, "left_anti")


_KEPT: list = []


def _searcher(block: list[tuple[object, str]], rate: float) -> Searcher:
    """The searcher of a block; a worker keeps the last one."""
    if not _KEPT or _KEPT[0] != (rate, block):
        _KEPT[:] = [(rate, block), Searcher(block, rate)]
    return _KEPT[1]
