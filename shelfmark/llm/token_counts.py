"""Token counts of the sections of documents, from one encoding of the whole text.

A document is encoded once. The byte lengths of its tokens give the character span of each; an
interval join of these spans with the sections finds the section in which a token begins and the
one in which it ends. Where they differ, a rule decides: ``most`` (the section with most of the
token's characters, the earliest of equals), ``first``, ``last``, or ``share`` (a fraction to each
section in proportion to its characters).

Sections are disjoint spans in order; tokens in gaps count for section -1. Unless given, sections
are the lines of a text, each with its line feed. Null and empty texts have one empty section
without tokens. A letter of several tokens is the span of each. Texts of any length are encoded
whole. Repeated rows give repeated results, an empty table an empty one; only the named columns
are read.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from shelfmark.llm.common import map_batches, texts_of

LONG_RUN = 10_000
_LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}"
                         % LONG_RUN)
RULES = ("most", "first", "last", "share")


class Tokens:
    """A byte-level vocabulary of ranks with the byte length of every token."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def _encode(self, text: str) -> list[int]:
        """The library's ids. Its pattern takes a run of white space but for the last character
        as one piece, with a stack that very long runs exceed, so these are cut out before."""
        ids, at = [], 0
        for run in _LONG_BLANK.finditer(text) if len(text) >= LONG_RUN else ():
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += self.encoding.encode_ordinary(text[at:run.start()])
            ids += self.encoding._encode_single_piece(text[run.start():end])
            at = end
        return [*ids, *self.encoding.encode_ordinary(text[at:])]

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and last character of every token."""
        ids = np.asarray(self._encode(text), np.int64)
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        if text.isascii():
            return starts, ends - 1
        data = np.frombuffer(text.encode(), np.uint8)
        # The character that each byte belongs to.
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        return character[starts], character[ends - 1]


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Tokens:
    return Tokens(path, pattern)


def line_sections(text: str) -> np.ndarray:
    """Spans of the lines, one per row."""
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return np.column_stack([[0, *ends[:-1]], ends])


def attribute(first: np.ndarray, last: np.ndarray, sections: np.ndarray,
              rule: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Tokens per section, tokens per section that cross a boundary, and tokens in no section,
    for tokens from character ``first`` to ``last`` and disjoint sections in order."""
    n = len(sections)
    # Every boundary cuts the text into cells; a cell is a section or a gap (n).
    edges = np.unique(np.concatenate([[-1], sections.ravel()]))
    cell_section = np.full(len(edges), n)
    full = sections[:, 1] > sections[:, 0]
    cell_section[np.searchsorted(edges, sections[full, 0])] = np.flatnonzero(full)
    begin = np.searchsorted(edges, first, "right") - 1
    end = np.searchsorted(edges, last, "right") - 1
    counts, crossing = np.zeros(n + 1), np.zeros(n + 1)
    inside = begin == end
    np.add.at(counts, cell_section[begin[inside]], 1)
    for k in np.flatnonzero(~inside):
        cells = np.arange(begin[k], end[k] + 1)
        stops = np.append(edges[cells[1:]], last[k] + 1)
        widths = stops - np.maximum(edges[cells], first[k])
        owners = cell_section[cells]
        if rule == "share":
            np.add.at(counts, owners, widths / widths.sum())
        else:
            owner = {"first": 0, "last": -1, "most": int(widths.argmax())}[rule]
            counts[owners[owner]] += 1
        crossing[np.unique(owners)] += 1
    return counts[:n], crossing[:n], float(counts[n])


def count(docs: DataFrame, path: str, pattern: str, rule: str = "most", id_col: str = "doc_id",
          text_col: str = "text", sections_col: str | None = None) -> DataFrame:
    """Per document and section: its number, ``start`` and ``end``, ``tokens`` (a double, whole
    but for rule ``share``) and ``crossing``, the tokens that also reach beyond it.

    ``sections_col`` may name a column of arrays of structs with ``start`` and ``end``.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    columns = [id_col, text_col, *([sections_col] if sections_col else [])]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens = load(path, pattern)
        given = batch.column(sections_col).to_pylist() if sections_col else None
        rows, parts = [], []
        for row, text in enumerate(texts_of(batch, text_col)):
            if given is None:
                sections = line_sections(text)
            else:
                sections = np.array([(s["start"], s["end"]) for s in given[row] or []],
                                    np.int64).reshape(-1, 2)
                if (sections[1:, 0] < sections[:-1, 1]).any():
                    raise ValueError("sections must be in order and apart")
            counts, crossing, outside = attribute(*tokens.spans(text), sections, rule)
            numbers = np.arange(len(sections))
            if outside:
                numbers = np.append(numbers, -1)
                sections = np.vstack([sections, [0, len(text)]])
                counts, crossing = np.append(counts, outside), np.append(crossing, 0)
            rows.append(np.full(len(numbers), row))
            parts.append(np.column_stack([numbers, sections, counts, crossing]))
        flat = np.concatenate(parts)
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col).take(pa.array(np.concatenate(rows))),
             *[pa.array(flat[:, k].astype(np.int64)) for k in range(3)], pa.array(flat[:, 3]),
             pa.array(flat[:, 4].astype(np.int64))],
            [id_col, "section", "start", "end", "tokens", "crossing"])
    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs, columns, f"`{id_col}` {kind}, section bigint, start bigint, "
                                      "end bigint, tokens double, crossing bigint", work)
