"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A word starts as one symbol per byte. The leaves of its tree hold, for every symbol, the rank of
the pair it forms with the next one, joined with the position; the root therefore names the
leftmost pair of the lowest rank. A merge changes three leaves, and only their ancestors are
recomputed, until the root holds no mergeable pair. Short words are merged many at a time, one
tree per row of an array; a long word has a tree of its own.

Null and empty texts have no tokens and decode to the empty text. Text of any length is encoded
whole. Repeated rows give repeated results; an empty table gives an empty one. Only the id and the
text column are read, so further columns of any name are allowed and do not appear in the result.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import map_batches, texts_of

WORD_LIMIT = 63          # bytes of the longest word that is merged in the common arrays
CACHE_WORDS = 1_000_000  # chunks whose ids a worker remembers: some 250 MB at most
_NONE = np.int64(1 << 60)
_NO_SYMBOL = 65_535
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {}, 256
    for byte in range(256):
        if byte in shown:
            table[byte] = chr(byte)
        else:
            table[byte], spare = chr(spare), spare + 1
    return [table[byte] for byte in range(256)]


class WordBpe:
    """A lower-casing BPE with word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (vocab | self.special).items()}
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int32)
        self.final = np.array([vocab[c + suffix] for c in alphabet], np.int32)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.rank_of = {int(k): r for r, k in enumerate(keys)}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # \s of the file's engine has no information separators, which Python's has.
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.cache: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """The chunks of a text between white space, lower case; special tokens stand among them
        behind a blank, which no other chunk holds. No word of the file's pattern holds one."""
        if "<|" not in text:
            return self._plain(text)
        out = []
        for part in self.marks.split(text):
            if part in self.special:
                out.append(f" {part}")
            elif part:
                out.extend(self._plain(part))
        return out

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            text = text.lower()
        else:
            # Lower case letter by letter: no special form of a sigma at a word's end.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if SEPARATORS.search(text):
            # Python takes these for white space, the file's engine does not.
            return self.words.findall(text)
        return text.split()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.cache) > CACHE_WORDS:
            # Frequent chunks were met early on, so the half learned last goes.
            for chunk in list(islice(reversed(self.cache), CACHE_WORDS // 2)):
                del self.cache[chunk]
        cache, split = self.cache, [self.split(t) for t in texts]
        new = [c for c in set().union(*split) if c not in cache]
        if new:
            words = {c: [c] if c[0] == " " else self.words.findall(c) for c in new}
            self._learn({w for parts in words.values() for w in parts if w not in cache})
            cache.update({c: b"".join(map(cache.__getitem__, parts))
                          for c, parts in words.items() if len(parts) != 1})
        return [b"".join(map(cache.__getitem__, chunks)) for chunks in split]

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, joined by blanks."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _learn(self, words: set[str]) -> None:
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            if word[0] == " ":
                self.cache[word] = np.array([self.special[word[1:]]], "<u4").tobytes()
                continue
            data = word.encode()
            if len(data) > WORD_LIMIT:
                self.cache[word] = np.array(self.merge_long(data), "<u4").tobytes()
            else:
                width = 1 << max(2, len(data).bit_length())
                by_width.setdefault(width, []).append((word, data))
        for width, group in by_width.items():
            for start in range(0, len(group), 16_384):
                part = group[start:start + 16_384]
                for (word, _), ids in zip(part, self.merge_many([d for _, d in part], width),
                                          strict=True):
                    self.cache[word] = ids

    def _rank(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaf values: rank and position of a pair, or ``_NONE``."""
        key = left.astype(np.int64) << 16 | right
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[found] == key, self.ranks[found] << 6 | at, _NONE)

    def merge_many(self, words: list[bytes], width: int) -> list[bytes]:
        """Merge words of fewer than ``width`` (at most 64) bytes, one segment tree each."""
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        # Symbols stand at 1 to length; those at 0 and beyond the end form no pair.
        symbols = np.full((n, width + 2), _NO_SYMBOL, np.int32)
        inside = np.arange(width + 2) <= lengths[:, None]
        inside[:, 0] = False
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols[inside] = self.inner[data]
        rows = np.arange(n)
        last = np.cumsum(lengths) - 1
        symbols[rows, lengths] = self.final[data[last]]
        following = np.tile(np.arange(1, width + 3, dtype=np.int64), (n, 1))
        before = np.tile(np.arange(-1, width + 1, dtype=np.int64), (n, 1))
        tree = np.full((n, 2 * width), _NONE, np.int64)
        tree[:, width:] = self._rank(symbols[:, :width], symbols[:, 1:width + 1],
                                     np.arange(width))
        level = width
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2],
                                                   tree[:, level + 1:2 * level:2])
            level //= 2
        alive = inside
        active = rows
        while True:
            root = tree[active, 1]
            more = root < _NONE
            active, root = active[more], root[more]
            if not len(active):
                break
            at = root & 63
            right = following[active, at]
            after = following[active, right]
            ahead = before[active, at]
            symbol = self.merged[root >> 6]
            symbols[active, at] = symbol
            alive[active, right] = False
            following[active, at] = after
            before[active, after] = at
            tree[active, width + at] = self._rank(symbol, symbols[active, after], at)
            tree[active, width + right] = _NONE
            tree[active, width + ahead] = self._rank(symbols[active, ahead], symbol, ahead)
            nodes = (width + at, width + right, width + ahead)
            for _ in range(width.bit_length() - 1):
                nodes = tuple(node >> 1 for node in nodes)
                for node in nodes:
                    tree[active, node] = np.minimum(tree[active, 2 * node],
                                                    tree[active, 2 * node + 1])
        ids = symbols[alive].astype("<u4").tobytes()
        ends = (4 * np.cumsum(alive.sum(axis=1))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge_long(self, word: bytes) -> list[int]:
        """Merge one word with one segment tree."""
        size = len(word)
        symbols = [*self.inner[list(word)].tolist(), _NO_SYMBOL]
        symbols[size - 1] = int(self.final[word[-1]])
        width = 1 << (size - 1).bit_length()
        none, rank_of = 1 << 60, self.rank_of

        def leaf(at: int, right: int) -> int:
            rank = rank_of.get(symbols[at] << 16 | symbols[right])
            return none if rank is None else rank * width + at

        tree = [none] * (2 * width)
        tree[width:width + size] = [leaf(i, i + 1) for i in range(size)]
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        following, before = list(range(1, size + 2)), list(range(-1, size + 1))
        gone = bytearray(size)

        def put(at: int, value: int) -> None:
            node = width + at
            tree[node] = value
            while node > 1:
                node >>= 1
                value = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == value:
                    break
                tree[node] = value

        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            right = following[at]
            after, ahead = following[right], before[at]
            symbols[at] = int(self.merged[rank])
            gone[right] = 1
            following[at], before[after] = after, at
            put(right, none)
            put(at, leaf(at, after))
            if ahead >= 0:
                put(ahead, leaf(ahead, at))
        return [s for s, g in zip(symbols[:size], gone, strict=True) if not g]


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """The tokenizer of a file, read once per worker."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``ids`` (binary: little-endian unsigned 32-bit integers) and
    ``n_tokens``. ``path`` names the tokenizer file, present on every executor."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = load(path).encode_batch(texts_of(batch, text_col))
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), pa.array(ids, pa.binary()),
             pa.array([len(i) // 4 for i in ids], pa.int64())], [id_col, "ids", "n_tokens"])
    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs, [id_col, text_col],
                       f"`{id_col}` {kind}, ids binary, n_tokens bigint", work)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``encode`` with ``decoded``, the text that the ids decode to."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(path)
        ids = bpe.encode_batch(texts_of(batch, text_col))
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), pa.array(ids, pa.binary()),
             pa.array([len(i) // 4 for i in ids], pa.int64()),
             pa.array([bpe.decode(i) for i in ids], pa.string())],
            [id_col, "ids", "n_tokens", "decoded"])
    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs, [id_col, text_col],
                       f"`{id_col}` {kind}, ids binary, n_tokens bigint, decoded string", work)


def digests(encoded: DataFrame) -> DataFrame:
    """The result of ``encode_decode`` with hashes in place of ids and texts."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
