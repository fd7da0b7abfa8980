"""A hashed maximum-entropy language model with a class-factored softmax.

The probability of a token is that of its class times that of the token in its class. The most
frequent words share classes of ``CLASS_WORDS``; every other word belongs to one of the rare
classes, told by its last letters and accents, and has there the smoothed share of its count. Both
softmax layers add up weights of hashed features of the words before: the last word, the one before
it (a skip), and the pair of them, beside a bias that starts at the observed frequencies. These know
rarer words by their class; the layer of classes therefore also has hashed rows for the words
themselves, so that whichever of the two words before is rare, the nearer one, is known as itself.

Training is distributed: every task of a round updates its copy of the weights by gradients over
small batches of its documents, and the copies are averaged, each feature weighed by how often a
task has met it. All training documents take part, each in one of ``ROUNDS``. The weights have a
fixed size. Scoring is done in sparse numpy batches.

Counts of words are an aggregation over the whole training corpus and grow with it. Tasks get only
the head of that table, at most ``HEAD_WORDS`` words; what the rest contributes is joined by word.

Null and empty texts have one token, the end. Without training documents every word is unknown,
and the base probability of the end is 1. Texts of any length are scored whole, in pieces of
bounded size. Repeated rows and null ids are scored like others; an empty table gives an empty
result. Words are known by 64-bit hashes. Only id and text are read, so further columns do no harm.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import bytes_of, lower_words, stored

HEAD_WORDS = 1 << 18   # of the table of counts that every task gets
CLASS_WORDS = 32
CLASSES = 16           # of frequent words
RARE = 48              # classes of all other words
PAIRS = 2048           # rows for hashed pairs of words
OTHERS = 2048          # rows for hashed words beyond the frequent ones
ROUNDS = 2
BATCH = 4096           # tokens of one gradient update
RATE = 0.6
PIECE = 1 << 11        # tokens scored at once
LEXICON_WORDS = 600_000  # distinct words that a task remembers, about
SMOOTH = 0.1

WORDS = CLASSES * CLASS_WORDS
NAMES = WORDS + RARE   # a frequent word is named by its rank, another by its class
_WIDTH = CLASSES + RARE
_HASH = np.uint64(0x9E3779B97F4A7C15)
WORD_ROWS = 256        # hashed rows of the word layer, for each of its features
_BLOCK = 256           # rows of weights that are averaged together
LANES = 64             # sums of a block before the last

#: The end of a text among its words; no word is empty.
END = b""


class _Numbers(dict):
    """Gives every new word the next number."""

    def __init__(self):
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.fresh.append(word)
        self[word] = number = len(self)
        return number


class Lexicon:
    """Numbers for the distinct words of a task, with hash and rare class of each."""

    def __init__(self):
        self.index = _Numbers()
        self.hash = np.zeros(0, np.uint64)
        self.kind = np.zeros(0, np.int64)

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts as numbers, each text with its end, and where texts begin."""
        words: list[bytes] = []
        starts = []
        for text in texts:
            starts.append(len(words))
            words += lower_words(text)
            words.append(END)
        return self.add(words, len(words)), np.array(starts, np.int64)

    def add(self, words: Iterable[bytes], n: int) -> np.ndarray:
        """The numbers of ``n`` words; new ones get theirs."""
        ids = np.fromiter(map(self.index.__getitem__, words), np.int64, n)
        if self.index.fresh:
            h, kind = hashes(self.index.fresh)
            self.hash = np.concatenate([self.hash, h])
            self.kind = np.concatenate([self.kind, kind])
            self.index.fresh = []
        return ids

    @property
    def full(self) -> bool:
        return len(self.index) > LEXICON_WORDS


def hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and rare class of words."""
    n = len(words)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = np.fromiter(map(len, words), np.int64, n)
    # A blank before each word keeps the empty one from borrowing letters.
    data = np.frombuffer(b" " + b" ".join(words), np.uint8)
    ends = np.cumsum(size + 1)
    # The highest byte of an accented letter tells languages apart, the last one word forms.
    accents = np.where((data >= 128) & (data < 192), data, 0)
    accent = np.maximum.reduceat(accents, ends - size - 1).astype(np.int64)
    last = data[ends - 1].astype(np.int64)
    marked = (last == 44) | (last == 46)
    last = np.where(marked & (size > 1), data[np.maximum(ends - 2, 0)], last)
    return h, ((accent * 64 + last * 2 + marked) * 40503 % 65537) % RARE


def _name_of(h: np.ndarray, kind: np.ndarray, words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Rank of frequent words, ``WORDS`` and the rare class of others."""
    if not len(words):
        return WORDS + kind
    at = np.minimum(np.searchsorted(words, h), len(words) - 1)
    return np.where(words[at] == h, order[at], WORDS + kind)


@dataclass
class Model:
    """Weights of both layers. ``head`` has the hashes of the head in order with their counts;
    ``words`` those of frequent words in order, ``ranks`` their ranks."""

    total: int
    distinct: int
    head: np.ndarray
    head_counts: np.ndarray
    words: np.ndarray
    ranks: np.ndarray
    rare_total: np.ndarray
    rare_distinct: np.ndarray
    class_bias: np.ndarray
    word_bias: np.ndarray
    class_rows: np.ndarray
    word_rows: np.ndarray

    @classmethod
    def start(cls, total: int, distinct: int, head: np.ndarray, counts: np.ndarray,
              kinds: np.ndarray, by_kind: dict[int, tuple[int, int]]) -> Model:
        """Biases from counts; all other weights 0. ``by_kind`` has count and number of distinct
        words of each rare class, frequent words included."""
        first = np.lexsort((head, -counts))[:WORDS]
        rare = np.zeros((2, RARE), np.int64)
        for kind, pair in by_kind.items():
            rare[:, kind] = pair
        np.subtract.at(rare[0], kinds[first], counts[first])
        np.subtract.at(rare[1], kinds[first], 1)
        frequent = np.zeros(WORDS)
        frequent[:len(first)] = counts[first]
        order = np.argsort(head[first])
        mass = np.concatenate([frequent.reshape(CLASSES, -1).sum(axis=1), rare[0]]) + SMOOTH
        # Ranks without a word never occur; they get no share.
        share = (frequent + SMOOTH) / np.repeat(
            (frequent + SMOOTH).reshape(CLASSES, -1).sum(axis=1), CLASS_WORDS)
        word_bias = np.where(np.arange(WORDS) < len(first), np.log(share), -1e9)
        return cls(total, distinct, head, counts, head[first][order],
                   np.arange(len(first))[order], rare[0], rare[1],
                   np.log(mass / mass.sum()).astype(np.float32), word_bias.astype(np.float32),
                   np.zeros((2 * NAMES + PAIRS + OTHERS + 1, _WIDTH), np.float32),
                   np.zeros((2 * WORD_ROWS, WORDS), np.float32))

    def names(self, h: np.ndarray, kind: np.ndarray) -> np.ndarray:
        return _name_of(h, kind, self.words, self.ranks)

    def features(self, name: np.ndarray, starts: np.ndarray,
                 h: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the class layer and of the word layer for each token of texts that begin at
        ``starts``; before a text stands the end of another. Without the words' hashes ``h`` rarer
        words are known by their class alone."""
        end = hashes([END])
        last, skip = _before(name, starts, self.names(*end)[0])
        pair = ((last * 65_599 + skip).astype(np.uint64) * _HASH >> np.uint64(40)).astype(np.int64)
        # Rows of one word as the last and as the skip differ; without a rare one it is one of zeros.
        word = np.full(len(name), OTHERS)
        if h is not None:
            last_word, skip_word = _before(h, starts, end[0][0])
            rare = np.where(last >= WORDS, last_word, skip_word + np.uint64(1)) * _HASH
            word = np.where((last >= WORDS) | (skip >= WORDS),
                            (rare >> np.uint64(40)).astype(np.int64) % OTHERS, OTHERS)
        classes = np.stack([last, NAMES + skip, 2 * NAMES + pair % PAIRS,
                            2 * NAMES + PAIRS + word], axis=1)
        small = ((np.stack([last, skip], axis=1).astype(np.uint64) + np.uint64(1)) * _HASH
                 >> np.uint64(40)).astype(np.int64) % WORD_ROWS
        return classes, small + np.array([0, WORD_ROWS])

    def class_logits(self, rows: np.ndarray) -> np.ndarray:
        out = self.class_rows.take(rows[:, 0], axis=0)
        out += self.class_bias
        for k in range(1, rows.shape[1]):
            out += self.class_rows.take(rows[:, k], axis=0)
        return out

    def word_logits(self, rows: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Logits of the words of each row's class."""
        layer = self.word_rows.reshape(-1, CLASS_WORDS)
        out = self.word_bias.reshape(CLASSES, CLASS_WORDS).take(cls, axis=0)
        for k in range(rows.shape[1]):
            out += layer.take(rows[:, k] * CLASSES + cls, axis=0)
        return out

    def log_probabilities(self, name: np.ndarray, classes: np.ndarray,
                          small: np.ndarray) -> np.ndarray:
        """Natural logarithms: of class and word for frequent words, of the class for others."""
        cls = np.where(name < WORDS, name // CLASS_WORDS, CLASSES + name - WORDS)
        out = _log_shares(self.class_logits(classes), cls)
        common = np.flatnonzero(name < WORDS)
        if len(common):
            out[common] += _log_shares(self.word_logits(small[common], cls[common]),
                                       name[common] % CLASS_WORDS)
        return out

    def learn(self, name: np.ndarray, classes: np.ndarray, small: np.ndarray,
              seen: tuple[np.ndarray, np.ndarray]) -> None:
        """One gradient update; steps shrink with the root of how often a feature was ``seen``."""
        n = len(name)
        cls = np.where(name < WORDS, name // CLASS_WORDS, CLASSES + name - WORDS)
        slope = _shares(self.class_logits(classes))
        slope[np.arange(n), cls] -= 1
        common = np.flatnonzero(name < WORDS)
        own = cls[common]
        inner = _shares(self.word_logits(small[common], own))
        inner[np.arange(len(common)), name[common] % CLASS_WORDS] -= 1
        layer = self.word_rows.reshape(-1, CLASS_WORDS)
        steps = [(self.class_rows, seen[0], classes[:, k], slope) for k in range(classes.shape[1])]
        steps += [(layer, seen[1], small[common, k] * CLASSES + own, inner) for k in range(2)]
        for weights, often, keys, slopes in steps:
            rows, sums, counts = _sum_rows(keys, slopes)
            often[rows] += counts
            sums *= (RATE / np.sqrt(often[rows])).astype(np.float32)[:, None]
            weights[rows] -= sums
        self.class_rows[-1] = 0  # it stands for no word, and a row of most tokens leaps in a batch


def _before(values: np.ndarray, starts: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """The value before each token and the one before that, ``end`` before a text."""
    last = np.append(end, values[:-1])
    last[starts] = end
    skip = np.append(end, last[:-1])
    skip[starts] = end
    return last, skip


def _log_shares(logits: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The logarithm of the probability of one column per row; the logits are lost."""
    own = logits[np.arange(len(of)), of]
    return own - np.log(_exp(logits))


def _shares(logits: np.ndarray) -> np.ndarray:
    """Probabilities, in the place of the logits."""
    logits *= (1 / _exp(logits))[:, None]
    return logits


def _exp(logits: np.ndarray) -> np.ndarray:
    """Exponentials in the place of logits, and their sum per row.

    Biases are logarithms of shares and weights are small, so that no row needs to be shifted to
    its maximum; the bounds only keep an odd one from overflowing.
    """
    np.clip(logits, -80, 60, out=logits)
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], np.float32)


def _sum_rows(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys (below 65,536), and sum and number of the rows of each."""
    if not len(keys):
        return keys, values, np.zeros(0)
    short = keys.astype(np.uint16)  # these are sorted in linear time
    order = np.argsort(short, kind="stable")
    sorted_ = short[order]
    starts = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
    counts = np.diff(np.append(starts, len(keys)))
    sums = values.take(order, axis=0)
    # Neighbours are added pairwise, then pairs, and so on: only rows of keys met again are touched.
    place = np.arange(len(keys)) - np.repeat(starts, counts)
    left = np.repeat(counts, counts) - place  # rows of the key from here on
    at, step = np.flatnonzero((left > 1) & (place % 2 == 0)), 1
    while len(at):
        sums[at] += sums[at + step]
        step *= 2
        at = at[(left[at] > step) & (place[at] % (2 * step) == 0)]
    return sorted_[starts].astype(np.int64), sums[starts], counts


class Trainer:
    """A task's copy of the weights, updated batch by batch."""

    def __init__(self, model: Model):
        self.model = model
        self.begun = model.class_rows.copy(), model.word_rows.copy()
        self.seen = (np.zeros(len(model.class_rows), np.float32),
                     np.zeros(2 * WORD_ROWS * CLASSES, np.float32))
        self._lexicon = Lexicon()
        self._names = np.zeros(0, np.int64)

    def add(self, texts: list[bytes]) -> None:
        if self._lexicon.full:
            self._lexicon, self._names = Lexicon(), self._names[:0]
        ids, starts = self._lexicon.numbers(texts)
        at = len(self._names)
        self._names = np.append(self._names, self.model.names(
            self._lexicon.hash[at:], self._lexicon.kind[at:]))
        name = self._names[ids]
        classes, small = self.model.features(name, starts, self._lexicon.hash[ids])
        for at in range(0, len(name), BATCH):
            part = slice(at, at + BATCH)
            self.model.learn(name[part], classes[part], small[part], self.seen)

    def changes(self) -> Iterator[tuple[int, bytes, bytes]]:
        """Per block of rows what has changed, times how often it was seen, and that number."""
        flat = ((self.model.class_rows - self.begun[0], self.seen[0], 0),
                ((self.model.word_rows - self.begun[1]).reshape(-1, CLASS_WORDS), self.seen[1],
                 1 << 20))
        for change, seen, base in flat:
            for at in range(0, len(change), _BLOCK):
                weight = seen[at:at + _BLOCK].astype(np.float32)
                if weight.any():
                    part = change[at:at + _BLOCK] * weight[:, None]
                    yield base + at, part.astype(np.float32).tobytes(), weight.tobytes()


def held_out(id_col: str, parts: int) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == 0, F.lit(False))


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``h``, rare class ``kind`` and count ``c`` of every token, summed up in tasks first."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, counts = Lexicon(), np.zeros(0, np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(counts), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lexicon.hash[part].view(np.int64)),
                     pa.array(lexicon.kind[part].astype(np.int32)), pa.array(counts[part])],
                    ["h", "kind", "c"])
        for batch in batches:
            if lexicon.full:
                yield from out()
                lexicon, counts = Lexicon(), np.zeros(0, np.int64)
            found: Counter[bytes] = Counter()
            for text in bytes_of(batch, text_col):
                found.update(lower_words(text))
                found[END] += 1
            ids = lexicon.add(found, len(found))
            counts = np.append(counts, np.zeros(len(lexicon.index) - len(counts), np.int64))
            counts[ids] += np.fromiter(found.values(), np.int64, len(found))
        yield from out()
    return (docs.select(text_col).mapInArrow(work, "h bigint, kind int, c bigint")
            .groupBy("h").agg(F.max("kind").alias("kind"), F.sum("c").alias("c")))


def begin(counts: DataFrame, head_words: int = HEAD_WORDS) -> Model:
    """A model without weights, from a table of counts."""
    # How many words have which count decides from which count on the head fits.
    often = (counts.groupBy(F.least(F.col("c"), F.lit(1 << 16)).alias("c"))
             .agg(F.count("*").alias("n")).toPandas().sort_values("c", ascending=False))
    fits = often[often["n"].cumsum() <= head_words]
    least = int(fits["c"].min()) if len(fits) else (1 << 62)
    head = counts.where(F.col("c") >= least).toPandas()
    head = head.iloc[np.argsort(head["h"].to_numpy(np.int64).view(np.uint64))]
    by_kind = {r.kind: (r.c, r.n) for r in counts.groupBy("kind").agg(
        F.sum("c").alias("c"), F.count("*").alias("n")).collect()}
    return Model.start(
        sum(c for c, _ in by_kind.values()), sum(n for _, n in by_kind.values()),
        head["h"].to_numpy(np.int64).view(np.uint64), head["c"].to_numpy(np.int64),
        head["kind"].to_numpy(np.int64), by_kind)


def train(docs: DataFrame, model: Model, id_col: str, text_col: str,
          rounds: int = ROUNDS) -> Model:
    """The model after one pass over the documents, a part of them per round."""
    spark = docs.sparkSession
    for number in range(rounds):
        sent = spark.sparkContext.broadcast(model)

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(_copied(sent.value))
            for batch in batches:
                if batch.num_rows:
                    trainer.add(bytes_of(batch, text_col))
            lane = TaskContext.get().partitionId() % LANES
            for at, change, weight in trainer.changes():
                yield _sums(at * LANES + lane, change, weight)
        part = docs.where(F.pmod(F.xxhash64(id_col, text_col), F.lit(rounds)) == number)
        changes = part.select(text_col).mapInArrow(work, _SUMS)
        for key in (F.col("at"), F.floor(F.col("at") / LANES).alias("at")):  # lanes, then blocks
            changes = (changes.select(key, "change", "weight").repartition("at")
                       .sortWithinPartitions("at").mapInArrow(_summed, _SUMS))
        model = _copied(model)
        # As many rows as the weights have blocks.
        for row in changes.toLocalIterator():
            weight = np.frombuffer(row.weight, np.float32)
            change = (np.frombuffer(row.change, np.float32).reshape(len(weight), -1)
                      / np.maximum(weight, 1)[:, None])
            if row.at < 1 << 20:
                change = change.reshape(-1, _WIDTH)
                model.class_rows[row.at:row.at + len(change)] += change
            else:
                change, at = change.reshape(-1, CLASS_WORDS), row.at - (1 << 20)
                model.word_rows.reshape(-1, CLASS_WORDS)[at:at + len(change)] += change
        sent.unpersist()
    return model


_SUMS = "at bigint, change binary, weight binary"


def _sums(at: int, change: bytes, weight: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([at], pa.int64()), pa.array([change], pa.binary()),
         pa.array([weight], pa.binary())], ["at", "change", "weight"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of changes and weights per block, by which rows are sorted; one block is held."""
    held, change, weight = None, np.zeros(0), np.zeros(0)
    for batch in batches:
        for at, c, w in zip(*(batch.column(k).to_pylist() for k in ("at", "change", "weight")),
                            strict=True):
            c, w = np.frombuffer(c, np.float32), np.frombuffer(w, np.float32)
            if at == held:
                change, weight = change + c, weight + w
                continue
            if held is not None:
                yield _sums(held, change.tobytes(), weight.tobytes())
            held, change, weight = at, c, w
    if held is not None:
        yield _sums(held, change.tobytes(), weight.tobytes())


def _copied(model: Model) -> Model:
    return Model(**{**model.__dict__, "class_rows": model.class_rows.copy(),
                    "word_rows": model.word_rows.copy()})


class Scorer:
    """Scores of a task's texts, but for what words beyond the head add."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self._lexicon = Lexicon()
        self._names = np.zeros(0, np.int64)
        self._logs = np.zeros(0)

    def _learn_words(self) -> None:
        """Name and logarithm of the count for new words; NaN for words beyond the head."""
        model, at = self.model, len(self._names)
        h = self._lexicon.hash[at:]
        logs = np.full(len(h), np.nan)
        if len(model.head):
            found = np.minimum(np.searchsorted(model.head, h), len(model.head) - 1)
            known = model.head[found] == h
            logs[known] = np.log10(model.head_counts[found[known]] + SMOOTH)
        self._logs = np.append(self._logs, logs)
        self._names = np.append(self._names, model.names(h, self._lexicon.kind[at:]))

    def score(self, texts: list[bytes]) -> tuple:
        """Per text its number of tokens and of known ones, base and model score; and per text
        the hashes of words beyond the head and how often each occurs."""
        model = self.model
        if self._lexicon.full:
            self._forget()
        ids, starts = self._lexicon.numbers(texts)
        self._learn_words()
        name, logs = self._names[ids], self._logs[ids]
        beyond = np.isnan(logs)
        logs[beyond] = 0
        n = np.diff(np.append(starts, len(ids)))
        classes, small = model.features(name, starts, self._lexicon.hash[ids])
        fit = np.concatenate([
            model.log_probabilities(name[at:at + PIECE], classes[at:at + PIECE],
                                    small[at:at + PIECE]).astype(np.float64)
            for at in range(0, len(ids), PIECE)]) / np.log(10)
        others = name >= WORDS
        share = np.log10(model.rare_total + SMOOTH * (model.rare_distinct + 1))
        fit[others] += logs[others] - share[name[others] - WORDS]
        base = np.add.reduceat(logs, starts) - n * np.log10(
            model.total + SMOOTH * (model.distinct + 1))
        tails, times = [], []
        ends = np.append(starts, len(ids))[1:]
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            word, often = np.unique(ids[a:b][beyond[a:b]], return_counts=True)
            tails.append(self._lexicon.hash[word])
            times.append(often)
        return (n, n - np.add.reduceat(beyond.astype(np.int64), starts), base,
                np.add.reduceat(fit, starts), tails, times)


def score(docs: DataFrame, counts: DataFrame, model: Model, id_col: str,
          text_col: str) -> DataFrame:
    """Per document: id, ``n_tokens``, ``n_known``, ``base_score`` and ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            *columns, tails, times = scorer.score(bytes_of(batch, text_col))
            offsets = pa.array(np.cumsum([0, *map(len, tails)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), *map(pa.array, columns),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(tails).view(np.int64))),
                 pa.ListArray.from_arrays(offsets, pa.array(
                     np.concatenate(times).astype(np.int32)))],
                ["doc_id", "n_tokens", "n_known", "base_score", "score", "tail", "times"])
    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(id_col, text_col).mapInArrow(
        work, f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double, "
              "tail array<bigint>, times array<int>")
    # Numbered, then stored, so that the numbers stay.
    scored = stored(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    rest = scored.select("_row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select(
        "_row", F.col("t.tail").alias("h"), "t.times")
    found = F.coalesce("c", F.lit(0))
    sums = (rest.join(counts.select("h", "c"), "h", "left").groupBy("_row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("_known"),
        F.sum(F.col("times") * F.log10(found + F.lit(SMOOTH))).alias("_log")))
    more = F.coalesce("_log", F.lit(0.0))
    return scored.join(sums, "_row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"))


def fit_and_score(docs: DataFrame, parts: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", head_words: int = HEAD_WORDS) -> DataFrame:
    """Scores of all documents by a model of those not held out, with ``held_out`` and
    ``train_tokens``."""
    known = docs.where(~held_out(id_col, parts))
    counts = stored(word_counts(known, text_col), "counts")
    model = begin(counts, head_words)
    model = train(known, model, id_col, text_col)
    return score(docs, counts, model, id_col, text_col).select(
        "doc_id", held_out("doc_id", parts).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("bigint").alias("train_tokens"), "base_score", "score")
