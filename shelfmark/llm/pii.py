"""Personal data in texts, plain or disguised, with spans of the source.

Plain identifiers are found by patterns. For disguised ones, transducers rewrite the text piece by
piece: look-alike letters and wide forms become plain characters, invisible ones vanish, spelled
digits become digits, ``at`` and ``dot`` in words or brackets become ``@`` and ``.``. Each keeps
for every character of its output the span of the source it came from, so that what the patterns
find in the rewritten text maps back to the source. Spans found that way are added unless a plain
span of that kind covers them already.

All offsets count code points, ends are exclusive. Null and empty texts have no spans. Each pattern
works in time linear in the text; texts of any length are read whole. Repeated rows give repeated
results, an empty table an empty one. Only the named columns are read; further ones do no harm.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import map_batches, texts_of

KINDS = ("email", "ip", "card", "phone")

_LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){15,}+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Characters that look like another, after the wide and mathematical forms.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j",
    "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "А": "A", "В": "B", "Е": "E",
    "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I",
    "Ѕ": "S", "Ј": "J", "α": "a", "ο": "o", "ν": "v", "ι": "i", "ρ": "p", "Α": "A", "Β": "B",
    "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ⅼ": "l", "‐": "-", "‑": "-", "‒": "-",
    "–": "-", "−": "-", "․": ".", "。": ".", "٠": "0", "﹫": "@", "﹒": ".",
    " ": " ", " ": " ", " ": " ", " ": " ",
}
# Characters without width.
INVISIBLE = ("­", "​", "‌", "‍", "⁠", "﻿")
# Digits, at, dot and plus in words.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9", "null": "0", "eins": "1", "zwei": "2",
    "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9", "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4",
    "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
AT_WORDS = ("at", "arroba", "arobase")
DOT_WORDS = ("dot", "punkt", "point", "punto")


def _plain_forms() -> dict[str, str]:
    """Wide, mathematical and other decimal forms of ASCII, by rule, and the look-alikes."""
    forms = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    for c in range(0x1D400, 0x1D800):
        plain = unicodedata.normalize("NFKC", chr(c))
        if len(plain) == 1 and plain.isascii() and plain.isalnum():
            forms[chr(c)] = plain
    for c in (*range(0x660, 0x66A), *range(0x6F0, 0x6FA), *range(0x966, 0x970)):
        forms[chr(c)] = str(unicodedata.decimal(chr(c)))
    return forms | LOOK_ALIKES


PLAIN_FORMS = _plain_forms()
_ODD = re.compile("[" + "".join(map(re.escape, [*PLAIN_FORMS, *INVISIBLE])) + "]")
# None of them is among the letters of western European languages: a quick first look.
_RARE = re.compile("[^\x00-\x9f\xa1-\xac\xae-\xff]")
_DIGIT_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_SPELLED = re.compile(
    rf"(?<![^\W_])(?:plus[ -]+)?(?:{_DIGIT_WORD}|[0-9])(?:(?:[ -]{{1,2}}(?:{_DIGIT_WORD}|[0-9]))"
    r"){2,}(?![^\W_])", re.IGNORECASE)
# Between dots the digits of an address may be few.
_DOT_MARK = rf"[\[({{<][ ]*(?:{'|'.join(DOT_WORDS)}|\.)[ ]*[\])}}>]|&#46;|&#x2e;|&period;"
_AT_MARK = rf"[\[({{<][ ]*(?:{'|'.join(AT_WORDS)}|@)[ ]*[\])}}>]|&#64;|&#x40;|&commat;"
_DOT, _AT = rf"[ ]*(?:{_DOT_MARK})[ ]*", rf"[ ]*(?:{_AT_MARK})[ ]*"
_BARE_DOT = rf"(?:[ ]+(?:{'|'.join(DOT_WORDS)}|\.)[ ]+|[-_*]dot[-_*])"
_BARE_AT = rf"(?:[ ]+(?:{'|'.join(AT_WORDS)}|@)[ ]+|[-_*]at[-_*])"
_IN_BRACKETS_DOT, _IN_BRACKETS_AT = re.compile(_DOT, re.I), re.compile(_AT, re.I)
_OCTET = rf"(?:[0-9]{{1,3}}|(?:{_DIGIT_WORD})(?:[ -](?:{_DIGIT_WORD})){{0,2}})"
_SPELLED_IP = re.compile(rf"(?<![^\W_]){_OCTET}(?:(?:{_BARE_DOT}|{_DOT}|\.){_OCTET}){{3}}(?![^\W_])",
                         re.IGNORECASE)
_NAME = r"[A-Za-z0-9-]{1,63}"
_LAST = r"(?:[A-Za-z]{2,4}|online|example)"
_LONG_LAST = r"[A-Za-z]{5,63}"
# name at host dot net, with a short last part: bare words count only where both stand in their places; before a host
# with plain dots, bare "at" counts if the name has a digit or a mark inside. A long last part
# takes such a name, one of several parts, a host of several parts, or signs instead of blanks.
_BARE_MAIL = re.compile(
    rf"(?<![A-Za-z0-9._%+-])(?:[A-Za-z0-9._%+-]{{1,64}}(?:{_BARE_DOT}[A-Za-z0-9._%+-]{{1,64}})"
    rf"{{0,2}}(?:{_BARE_AT}|@){_NAME}(?:\.{_NAME}){{0,8}}(?:{_BARE_DOT}{_NAME}){{0,3}}"
    rf"{_BARE_DOT}{_LAST}"
    rf"|(?:[A-Za-z0-9_%+-]{{1,64}}[0-9._%+-][A-Za-z0-9_%+-]{{1,64}}|[A-Za-z0-9._%+-]{{1,64}}"
    rf"(?:{_BARE_DOT}[A-Za-z0-9._%+-]{{1,64}}){{1,2}}){_BARE_AT}{_NAME}(?:\.{_NAME}){{0,8}}"
    rf"(?:{_BARE_DOT}{_NAME}){{0,3}}{_BARE_DOT}{_LONG_LAST}"
    rf"|[A-Za-z0-9._%+-]{{1,64}}{_BARE_AT}{_NAME}(?:{_BARE_DOT}{_NAME}){{1,3}}{_BARE_DOT}{_LONG_LAST}"
    rf"|[A-Za-z0-9._%+-]{{1,64}}(?:[ ]*@[ ]*{_NAME}(?:{_BARE_DOT}{_NAME}){{0,3}}{_BARE_DOT}"
    rf"|[-_*]at[-_*]{_NAME}[-_*]dot[-_*]){_LONG_LAST}"
    rf"|[A-Za-z0-9_%+-]{{1,64}}[0-9._%+-][A-Za-z0-9_%+-]{{1,64}}{_BARE_AT}{_NAME}"
    rf"(?:\.{_NAME}){{1,8}}"
    rf"|[A-Za-z0-9._%+-]{{1,64}}(?:[ ]+@[ ]*|@[ ]+){_NAME}(?:\.{_NAME}){{1,8}})(?![A-Za-z0-9-])",
    re.IGNORECASE)
_BARE_DOT_RE, _BARE_AT_RE = re.compile(_BARE_DOT, re.I), re.compile(_BARE_AT, re.I)
_SPACED_AT = re.compile(r"[ ]+@[ ]*|@[ ]+")
_WORD_OR_DIGIT = re.compile(rf"{_DIGIT_WORD}|plus|[0-9]", re.IGNORECASE)

Span = tuple[int, int, int]


def _emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        if at >= end:
            host = _HOST.match(text, at)
            start = at
            if host:
                while start > end and text[start - 1] in _LOCAL:
                    start -= 1
            if start < at:
                end = host.end()
                out.append((start, end))
        at = text.find("@", at + 1)
    return out


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in map(int, digits[-2::-2]):
        total += 2 * d - 9 * (d > 4)
    return total % 10 == 0


def find_plain(text: str) -> list[Span]:
    """Spans (kind, start, end) of plain identifiers, by kind and start."""
    spans = [(0, s, e) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(map(_octet, m.groups())):
            spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                spans.append((3, *m.span()))
    return spans


class Rewritten:
    """A text after some rewriting, with the source span of each of its characters."""

    def __init__(self, text: str):
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put texts in place of spans, which are in order and apart. Each new character stands
        for the whole span it replaces."""
        if not edits:
            return
        text, starts, ends, at = [], [], [], 0
        for begin, end, new in edits:
            text += [self.text[at:begin], new]
            starts += [self.starts[at:begin], np.full(len(new), self.starts[begin])]
            ends += [self.ends[at:begin], np.full(len(new), self.ends[end - 1])]
            at = end
        self.text = "".join([*text, self.text[at:]])
        self.starts = np.concatenate([*starts, self.starts[at:]])
        self.ends = np.concatenate([*ends, self.ends[at:]])

    def source(self, begin: int, end: int) -> tuple[int, int]:
        return int(self.starts[begin]), int(self.ends[end - 1])


def _plain_characters(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), PLAIN_FORMS.get(m.group(), "")) for m in _ODD.finditer(text)]


def _inside(pattern: re.Pattern, text: str, span: tuple[int, int], new: str) -> list:
    return [(m.start(), m.end(), new) for m in pattern.finditer(text, *span)]


def _spelled_address(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for found in _SPELLED_IP.finditer(text):
        written = _IN_BRACKETS_DOT.sub(".", _BARE_DOT_RE.sub(".", found.group()))
        digits = re.sub(rf"(?:{_DIGIT_WORD})", lambda m: DIGIT_WORDS.get(m.group().lower(), ""), written,
                        flags=re.I)
        digits = digits.replace(" ", "").replace("-", "")
        if digits != found.group():
            edits.append((*found.span(), digits))
    return edits


def _spelled_digits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for run in _SPELLED.finditer(text):
        if not re.search(_DIGIT_WORD, run.group(), re.I):
            continue
        found = [*_WORD_OR_DIGIT.finditer(text, *run.span())]
        for i, m in enumerate(found):
            word = m.group().lower()
            new = "+" if word == "plus" else DIGIT_WORDS.get(word, word)
            # The gap to the next digit goes with this one, so that no separator is left.
            end = found[i + 1].start() if i + 1 < len(found) else m.end()
            edits.append((m.start(), end, new))
    return edits


def _at_and_dot(text: str) -> list[tuple[int, int, str]]:
    edits = [*_inside(_IN_BRACKETS_AT, text, (0, len(text)), "@"),
             *_inside(_IN_BRACKETS_DOT, text, (0, len(text)), ".")]
    for mail in _BARE_MAIL.finditer(text):
        edits += _inside(_BARE_AT_RE, text, mail.span(), "@")
        edits += _inside(_SPACED_AT, text, mail.span(), "@")
        edits += _inside(_BARE_DOT_RE, text, mail.span(), ".")
    kept, end = [], 0
    for edit in sorted(edits):
        if edit[0] >= end:
            kept.append(edit)
            end = edit[1]
    return kept


# The quick look: what every match that changes a text holds, in lower case, from the same
# alternatives; each pattern starts with a sign, which is faster than with a word.
_ANY_DOT = re.compile(rf"[ ](?:{'|'.join(DOT_WORDS)}|\.)[ ]|[-_*]dot[-_*]|{_DOT_MARK}")
_ANY_AT = re.compile(rf"(?:[ ](?:{'|'.join(AT_WORDS)}|@)[ ]+|[-_*]at[-_*])[a-z0-9-]{{1,63}}\.[a-z0-9-]"
                     rf"|[ ]@|@[ ]|{_AT_MARK}")
_AFTER_WORD = "|".join(rf"(?<={w}[ -])|(?<={w}[ -][ -])" for w in DIGIT_WORDS)
_WORD_BY_DOT = re.compile(
    rf"\.(?:{_DIGIT_WORD}|{'|'.join(rf'(?<={w}[.])' for w in DIGIT_WORDS)})")
_WORD_BY_DIGIT = re.compile(
    rf"[ -](?:(?=[0-9])(?:{_AFTER_WORD})"
    rf"|(?={_DIGIT_WORD})(?:(?<=[0-9][ -])|(?<=[0-9][ -][ -])|{_AFTER_WORD}))")
# What counts as an ASCII letter where case is ignored, but has another lower case.
_CASES = str.maketrans({"ſ": "s", "ı": "i", "İ": "i"})


def _quick(text: str) -> tuple[bool, bool, bool]:
    """Whether there may be spelled addresses, spelled digits, and at or dot in disguise."""
    low = (text if text.isascii() else text.translate(_CASES)).lower()
    dots = bool(_ANY_DOT.search(low))
    return (dots or bool(_WORD_BY_DOT.search(low)), bool(_WORD_BY_DIGIT.search(low)),
            dots or bool(_ANY_AT.search(low)))


def rewrite(text: str, quick: bool = True) -> Rewritten | None:
    """The text without disguises, or None if it has none; ``quick`` leaves out the patterns that
    cannot match."""
    out = Rewritten(text)
    if not text.isascii() and _RARE.search(text):
        out.replace(_plain_characters(text))
    octets, digits, marks = _quick(out.text) if quick else (True, True, True)
    if octets:
        out.replace(_spelled_address(out.text))
    if digits:
        out.replace(_spelled_digits(out.text))
    if marks:
        out.replace(_at_and_dot(out.text))
    return None if out.text == text else out


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and those that only show without disguises; each by kind and start."""
    plain = find_plain(text)
    rewritten = rewrite(text)
    if rewritten is None:
        return plain, []
    known: dict[int, list[tuple[int, int]]] = {}
    for kind, start, end in plain:
        known.setdefault(kind, []).append((start, end))
    starts = {k: [s for s, _ in v] for k, v in known.items()}
    added = []
    for kind, begin, end in find_plain(rewritten.text):
        span = rewritten.source(begin, end)
        if kind in known:
            at = int(np.searchsorted(starts[kind], span[0], "right")) - 1
            if at >= 0 and known[kind][at][1] >= span[1]:
                continue
        added.append((kind, *span))
    return plain, sorted(set(added))


def masked(text: str, spans: list[Span]) -> str:
    """The text with a mark in place of each span; overlapping spans have one mark."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:int,end:int>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                   ("end", pa.int32())]))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its id, ``base`` and ``added`` spans, and the text ``masked`` at both."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch, text_col)
        found = [find(t) for t in texts]

        def column(which: int) -> pa.Array:
            return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for k, s, e in f[which]]
                             for f in found], _ARROW_SPANS)
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), column(0), column(1),
             pa.array([masked(t, [*b, *a]) if b or a else t
                       for t, (b, a) in zip(texts, found, strict=True)], pa.string())],
            [id_col, "base", "added", "masked"])
    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs, [id_col, text_col],
                       f"`{id_col}` {kind}, base {SPANS}, added {SPANS}, masked string", work)


def mask_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the texts masked; every other column as it is. A null text stays null."""
    names = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in batch.column(text_col).to_pylist():
            if text:
                base, added = find(text)
                text = masked(text, [*base, *added]) if base or added else text
            out.append(text)
        at = batch.schema.get_field_index(text_col)
        return batch.set_column(at, text_col, pa.array(out, pa.string()))
    return map_batches(docs, names, docs.schema, work)


def _listed(spans: Column) -> Column:
    """Spans as kind:start:end, by kind as in ``KINDS``, then start and end."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).alias("at"),
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts and digest of the plain spans of ``spans``, and all spans in one text."""
    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
        F.sha2("masked", 256).alias("masked_sha256"))
