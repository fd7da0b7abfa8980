"""Two tokenizers aligned over a corpus: which tokens of one stand where tokens of the other do.

Equal texts are tokenised and aligned once: documents are grouped by their full text, and what a
text counts for is weighted by its number of documents. Byte offsets at which tokens of both end
cut them into groups; a link is a pair of tokens, one of each, in one group.

Tasks take texts in runs whose link pairs fit memory. A run keeps its texts' pairs as places in
the list of its distinct pairs, and gives that list with the number of documents of each pair. The
lists are summed over the corpus; each run then asks for its own pairs only, once each, so that
what is shuffled grows with the distinct pairs of runs and not with the links of documents.
Measures go back to documents by a digest of the text. A pair that most texts have is one row per
run and is summed in parts; copies of one text are one row from the first shuffle on.

A text has tokens if those of each tokenizer, joined, give a blank and the text. Null and empty
texts, and those for which that fails, have none: zeros, and an empty digest. Strings of special
tokens in a text are plain text. Texts may be of any length that a row holds. Repeated rows and
null ids are rows like others. An empty table gives an empty result. Only id and text are read;
further columns do no harm.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import runs, stored

RUN_PAIRS = 2_000_000   # pairs of texts in a run, each once a text
CHUNK_BYTES = 1 << 20   # of texts that are tokenised together, or one longer text
BATCH_LINKS = 1 << 20   # links that are listed at once
_MEASURES = ("n_a", "n_b", "n_groups", "n_links")


@dataclass(frozen=True)
class Tokenizers:
    """Both tokenizers and what their ids stand for."""

    a: object
    b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    lengths_a: np.ndarray
    lengths_b: np.ndarray
    line_a: np.ndarray   # the bytes of all ids, one after another
    line_b: np.ndarray
    written: list[bytes]  # ids of A, then of B, as text with each sign that can follow

    @property
    def size_b(self) -> int:
        return len(self.bytes_b)


def _byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@cache
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """Loaded once per worker: byte-level BPE (A) and pieces with byte fallback (B)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    letters = _byte_letters()
    bytes_a = [b""] * a.get_vocab_size()
    for name, at in a.get_vocab().items():
        bytes_a[at] = bytes(letters[c] for c in name) if set(name) <= letters.keys() \
            else name.encode()
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    bytes_b = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k)
               else b.id_to_piece(k).replace("▁", " ").encode()
               for k in range(b.vocab_size())]
    lengths = [np.array([len(x) for x in names], np.int64) for names in (bytes_a, bytes_b)]
    written = [b"%d%s" % (k, sign) for names, signs in ((bytes_a, b",|"), (bytes_b, b",;"))
               for k in range(len(names)) for sign in (signs[:1], signs[1:])]
    lines = [np.frombuffer(b"".join(names), np.uint8) for names in (bytes_a, bytes_b)]
    return Tokenizers(a, b, bytes_a, bytes_b, *lengths, *lines, written)


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The items of all rows, and the row of each."""
    counts = [len(r) for r in rows]
    return (np.fromiter(chain.from_iterable(rows), np.int64, sum(counts)),
            np.repeat(np.arange(len(rows)), counts))


def _written_out(ids: np.ndarray, lengths: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The bytes of ids, one after another."""
    size = lengths[ids]
    shift = (np.cumsum(lengths) - lengths)[ids] - (np.cumsum(size) - size)
    return line[np.repeat(shift, size) + np.arange(int(size.sum()))]


def _faulty(wanted: list[bytes], ids: np.ndarray, text: np.ndarray, lengths: np.ndarray,
            line: np.ndarray) -> np.ndarray:
    """Whether the tokens of each text, joined, differ from what is wanted."""
    n = len(wanted)
    want = np.fromiter(map(len, wanted), np.int64, n)
    size = np.zeros(n, np.int64)
    np.add.at(size, text, lengths[ids])
    wrong = size != want
    if wrong.any():  # the others are compared alone
        some = ~wrong[text]
        ids = ids[some]
        wanted = [w for w, bad in zip(wanted, wrong, strict=True) if not bad]
    same = _written_out(ids, lengths, line) == np.frombuffer(b"".join(wanted), np.uint8)
    if not same.all():
        wrong[np.repeat(np.flatnonzero(~wrong), want[~wrong])[~same]] = True
    return wrong


@dataclass
class Aligned:
    """The alignment of some texts; groups are numbered through all of them."""

    a: np.ndarray        # ids
    b: np.ndarray
    text_a: np.ndarray   # text of each token
    text_b: np.ndarray
    group_a: np.ndarray  # group of each token
    group_b: np.ndarray
    text: np.ndarray     # text of each group

    @property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.text)
        return np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)


def align(both: Tokenizers, texts: list[str]) -> Aligned:
    """The tokens of texts and their groups; texts that do not come back whole have no tokens."""
    ids_a = [e.ids for e in both.a.encode_batch_fast([f" {t}" for t in texts],
                                                     add_special_tokens=False)]
    ids_b = both.b.encode(texts, num_threads=1)
    (a, text_a), (b, text_b) = _flat(ids_a), _flat(ids_b)
    wanted = [f" {t}".encode() for t in texts]
    wrong = (np.array([not t for t in texts], bool)
             | _faulty(wanted, a, text_a, both.lengths_a, both.line_a)
             | _faulty(wanted, b, text_b, both.lengths_b, both.line_b))
    if wrong.any():
        a, text_a = a[~wrong[text_a]], text_a[~wrong[text_a]]
        b, text_b = b[~wrong[text_b]], text_b[~wrong[text_b]]
    # Texts stand one after another on one line of bytes, as both cover the same bytes.
    ends_a = np.cumsum(both.lengths_a[a])
    ends_b = np.cumsum(both.lengths_b[b])
    is_end = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, bool)
    is_end[ends_a] = True
    is_cut = is_end[ends_b] if len(a) else np.zeros(0, bool)
    # No token is empty, and the group of one is the number of cuts before its end.
    cuts = np.zeros(len(is_end), np.int64)
    cuts[ends_b[is_cut]] = 1
    before = np.cumsum(cuts) - cuts
    return Aligned(a, b, text_a, text_b, before[ends_a], before[ends_b], text_b[is_cut])


def group_texts(both: Tokenizers, found: Aligned, n: int) -> list[bytes]:
    """Per text its groups, written ``a1,a2|b1;a3|b2,b3``."""
    out = [b""] * n
    if not len(found.a):
        return out
    last_a = np.append(found.group_a[1:] != found.group_a[:-1], True)
    last_b = np.append(found.group_b[1:] != found.group_b[:-1], True)
    codes = np.concatenate([2 * found.a + last_a, 2 * (len(both.bytes_a) + found.b) + last_b])
    order = np.argsort(np.concatenate([2 * found.group_a, 2 * found.group_b + 1]), kind="stable")
    text = np.concatenate([found.text_a, found.text_b])[order]
    written = list(map(both.written.__getitem__, codes[order].tolist()))
    starts = np.searchsorted(text, np.arange(n + 1)).tolist()
    for k in range(n):
        if starts[k] < starts[k + 1]:
            out[k] = b"".join(written[starts[k]:starts[k + 1]])[:-1]
    return out


def pairs(found: Aligned, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs (``a * size_b + b``) of each text: text, pair and number of links,
    sorted by text and pair."""
    count_a, count_b = found.sizes
    links = count_a * count_b
    first_a, first_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    # Groups with very many links are counted by their distinct tokens.
    for g in np.flatnonzero(links > BATCH_LINKS).tolist():
        a, m = np.unique(found.a[first_a[g]:first_a[g] + count_a[g]], return_counts=True)
        b, k = np.unique(found.b[first_b[g]:first_b[g] + count_b[g]], return_counts=True)
        pair = (a[:, None] * size_b + b[None, :]).ravel()
        parts.append((np.full(len(pair), found.text[g]), pair, np.outer(m, k).ravel()))
    usual = np.flatnonzero(links <= BATCH_LINKS)
    ends = np.cumsum(links[usual])
    start = 0
    while start < len(usual):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + 2 * BATCH_LINKS, "right")))
        some = usual[start:stop]
        group = np.repeat(some, links[some])
        at = np.arange(len(group)) - np.repeat(np.cumsum(links[some]) - links[some], links[some])
        a = found.a[first_a[group] + at // count_b[group]]
        b = found.b[first_b[group] + at % count_b[group]]
        parts.append(_summed(found.text[group], a * size_b + b))
        start = stop
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    return _summed(*[np.concatenate([p[k] for p in parts]) for k in range(3)])


def _summed(text: np.ndarray, pair: np.ndarray,
            n: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct pairs of each text and the sum of their ``n``, or how often each is there."""
    width = int(pair.max()) + 1 if len(pair) else 1
    if n is None and (int(text.max()) + 1 if len(text) else 1) * width < 1 << 63:
        both = np.sort(text * width + pair)  # one key sorts much faster than two
        at = np.flatnonzero(np.append(True, both[1:] != both[:-1])[:len(both)])
        text, pair = np.divmod(both[at], width)
        return text, pair, np.diff(at, append=len(both))
    n = np.ones(len(text), np.int64) if n is None else n
    order = np.lexsort((pair, text))
    text, pair, n = text[order], pair[order], n[order]
    new = np.append(True, (text[1:] != text[:-1]) | (pair[1:] != pair[:-1]))[:len(text)]
    at = np.flatnonzero(new)
    return text[at], pair[at], np.add.reduceat(n, at) if len(at) else n[:0]


def _packed(places: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending places and the number of links at each, small."""
    rows = np.concatenate([places, n])
    rows[1:len(places)] -= places[:-1]
    for kind in (np.uint8, np.uint16, np.uint32, np.uint64):
        if not len(rows) or rows.max() <= np.iinfo(kind).max:
            break
    width = np.dtype(kind).itemsize
    return bytes([width]) + zstandard.compress(rows.astype(kind).tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(zstandard.decompress(data[1:]), f"<u{data[0]}").astype(np.int64)
    half = len(rows) // 2
    return np.cumsum(rows[:half]), rows[half:]


@dataclass
class _Run:
    """Texts whose pairs are still to be written as places in the list of all of theirs."""

    rows: list[dict] = field(default_factory=list)
    pairs: list[np.ndarray] = field(default_factory=list)
    links: list[np.ndarray] = field(default_factory=list)
    weights: list[int] = field(default_factory=list)
    held: int = 0

    def add(self, row: dict, pair: np.ndarray, links: np.ndarray, weight: int) -> None:
        self.rows.append(row)
        self.pairs.append(pair)
        self.links.append(links)
        self.weights.append(weight)
        self.held += len(pair)

    def batches(self, run: int) -> Iterator[pa.RecordBatch]:
        """A row per text, then a row per distinct pair with its number of documents."""
        every = np.concatenate(self.pairs) if self.pairs else np.zeros(0, np.int64)
        known, places = np.unique(every, return_inverse=True)
        counts = np.zeros(len(known), np.int64)
        np.add.at(counts, places, np.repeat(self.weights, [len(p) for p in self.pairs]))
        start = 0
        for row, pair, links in zip(self.rows, self.pairs, self.links, strict=True):
            row["run"] = run
            row["links"] = _packed(places[start:start + len(pair)], links) if len(pair) else None
            start += len(pair)
        for k in range(0, len(self.rows), 512):
            yield pa.RecordBatch.from_pylist(self.rows[k:k + 512], _ARROW)
        for k in range(0, len(known), 65_536):
            part, n = known[k:k + 65_536], counts[k:k + 65_536]
            none = {name: pa.nulls(len(part), _ARROW.field(name).type) for name in _ARROW.names}
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), run)) if name == "run" else pa.array(part)
                 if name == "pair" else pa.array(n) if name == "count" else none[name]
                 for name in _ARROW.names], _ARROW.names)


_SCHEMA = ("run bigint, key string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
           "groups_sha256 string, groups string, links binary, pair bigint, count bigint")
_ARROW = pa.schema([
    ("run", pa.int64()), ("key", pa.string()), *[(m, pa.int64()) for m in _MEASURES],
    ("groups_sha256", pa.string()), ("groups", pa.string()), ("links", pa.binary()),
    ("pair", pa.int64()), ("count", pa.int64())])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """Texts, keys and multiplicities, some bytes of text at a time."""
    for batch in batches:
        size = pc.binary_length(batch.column("text").cast(pa.binary())).to_numpy()
        chunk = (np.cumsum(size) - size) // CHUNK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield tuple(batch.column(c).slice(start, end - start).to_pylist()
                        for c in ("text", "key", "n"))


def _aligning(path_a: str, path_b: str, with_groups: bool, run_pairs: int):
    """Rows of texts and of pairs, run by run, from distinct texts with their multiplicity."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(path_a, path_b)
        # Runs of two tasks have different numbers; a task that runs again writes the same ones.
        number, run = TaskContext.get().partitionId() << 32, _Run()
        for texts, keys, weights in _chunks(batches):
            found = align(both, texts)
            n = len(texts)
            count_a, count_b = found.sizes
            measures = zip(np.bincount(found.text_a, minlength=n).tolist(),
                           np.bincount(found.text_b, minlength=n).tolist(),
                           np.bincount(found.text, minlength=n).tolist(),
                           _sums(found.text, count_a * count_b, n).tolist(), strict=True)
            text, pair, links = pairs(found, both.size_b)
            starts = np.searchsorted(text, np.arange(n + 1))
            for k, (m, written) in enumerate(zip(measures, group_texts(both, found, n),
                                                 strict=True)):
                row = dict(zip(_MEASURES, m, strict=True))
                row["key"] = keys[k]
                row["groups_sha256"] = hashlib.sha256(written).hexdigest() if written else ""
                if with_groups:
                    row["groups"] = written.decode()
                some = slice(starts[k], starts[k + 1])
                run.add(row, pair[some], links[some], weights[k])
                if run.held > run_pairs:
                    yield from run.batches(number)
                    number, run = number + 1, _Run()
        if run.rows:
            yield from run.batches(number)
    return work


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, at, values)
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text the sum of its links' counts, and how many of them are their A id's best."""
    for group in runs(batches, "run"):
        is_pair = group.column("pair").is_valid()
        answers = group.filter(is_pair)
        order = np.argsort(answers.column("pair").to_numpy())
        count = answers.column("count").to_numpy()[order]
        best = answers.column("best").to_numpy(zero_copy_only=False)[order].astype(bool)
        texts = group.filter(pc.invert(is_pair))
        sums, bests = [], []
        for data in texts.column("links").to_pylist():
            at, links = _unpacked(data)
            sums.append(int((count[at] * links).sum()))
            bests.append(int(links[best[at]].sum()))
        yield pa.RecordBatch.from_arrays(
            [texts.column("key").combine_chunks(), pa.array(bests, pa.int64()),
             pa.array(sums, pa.int64())], ["key", "n_best", "count_sum"])


def aligned_texts(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text",
                  with_groups: bool = True, run_pairs: int = RUN_PAIRS) -> DataFrame:
    """Rows of distinct texts (``key``, measures, ``groups``, packed ``links``) and, in the same
    table, those of the distinct pairs of each run with their ``count`` of documents."""
    texts = (docs.where(F.octet_length(text_col) > 0).groupBy(F.col(text_col).alias("text"))
             .agg(F.count("*").alias("n")).select("text", "n", F.sha2("text", 256).alias("key")))
    return stored(texts.mapInArrow(_aligning(path_a, path_b, with_groups, run_pairs), _SCHEMA),
                  "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How many documents of the corpus have each ``pair`` linked."""
    return aligned.where("pair is not null").groupBy("pair").agg(F.sum("count").alias("count"))


def measures(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
             text_col: str = "text", with_groups: bool = True,
             run_pairs: int = RUN_PAIRS) -> DataFrame:
    """Per document its tokens, groups and links, ``groups`` as text and digest, ``n_best`` and
    ``count_sum``."""
    aligned = aligned_texts(docs, path_a, path_b, text_col, with_groups, run_pairs)
    size_b = _vocabulary(path_b)
    counts = stored(pair_counts(aligned).withColumn("a", F.floor(F.col("pair") / size_b)),
                    "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("_most"))
    known = counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("_most"))
                                          .alias("best"))
    asked = aligned.where("pair is not null").select("run", "pair")
    answers = asked.join(known, "pair").select(
        "run", "pair", "count", "best", F.lit(None).cast("string").alias("key"),
        F.lit(None).cast("binary").alias("links"))
    linked = aligned.where("links is not null").select(
        "run", F.lit(None).cast("bigint").alias("pair"), F.lit(None).cast("bigint").alias("count"),
        F.lit(None).cast("boolean").alias("best"), "key", "links")
    summed = (answers.unionByName(linked).repartition("run").sortWithinPartitions("run")
              .mapInArrow(_measured, "key string, n_best bigint, count_sum bigint"))
    of_text = aligned.where("key is not null").select(
        F.col("key").alias("_key"), *_MEASURES, "groups_sha256", "groups")
    per_text = of_text.join(summed, F.col("_key") == F.col("key"), "left").drop("key")
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.when(F.octet_length(text_col) > 0, F.sha2(F.col(text_col), 256))
                       .alias("key"))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return rows.join(per_text, F.col("key") == F.col("_key"), "left").select(
        "doc_id", *map(number, _MEASURES), number("n_best"), number("count_sum"),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
        F.coalesce("groups", F.lit("")).alias("groups"))


def _vocabulary(path_b: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size()


def report(found: DataFrame) -> DataFrame:
    return found.drop("groups")
