"""Personal names split into family and given parts with regular expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark import fixed


def _any_of(words: list[str]) -> str:
    """A pattern for one of the words, letter case and inner periods (``Ph.D.``) aside."""
    return "(?i:" + "|".join(r"\.?".join(w) for w in words) + r")\.?"


_SUFFIX = _any_of(fixed.NAME_SUFFIXES)
_TITLES = rf"^(?:{_any_of(fixed.NAME_TITLES)}\s+)+"
_ONLY_SUFFIXES = rf"^{_SUFFIX}(?:\s+{_SUFFIX})*$"
# "Given Family Jr." needs two words before the suffix, "Given Jr." after a comma only one.
_SUFFIX_AFTER_TWO = rf"^(\S+\s+\S.*?)((?:\s+{_SUFFIX})+)$"
_SUFFIX_AFTER_ONE = rf"^(\S.*?)((?:\s+{_SUFFIX})+)$"
# Particles belong to the family name but never open the name.
_PLAIN = rf"^(\S+(?:\s+\S+)*?)\s+((?:{_any_of(fixed.NAME_PARTICLES)}\s+)*\S+)$"
_NICKNAME = r""""[^"]*"|\([^)]*\)|\[[^\]]*\]|(?<!\S)'[^']*'(?!\S)"""


def split_names(authors: Column) -> Column:
    """Family and given part of each author of a list, as structs ``family``, ``given``.

    Known forms are ``Given Family``, ``Family, Given`` and ``Family; Given``. The family part
    carries particles (``van``) and suffixes (``Jr.``), the given part middle names; titles and
    nicknames are dropped. A single word is a given name.

    Each step is a pass over the list, so that every pattern is tried once per name.
    """
    steps = [_parts, _in_order, _cut_suffixes, _cut_family, _joined]
    return reduce(F.transform, steps, authors)


def creator_name(family: Column, given: Column) -> Column:
    """``Family, Given`` without stray blanks or commas at either end."""
    return F.btrim(F.concat(family, F.lit(", "), given), F.lit(" ,"))


def _parts(author: Column) -> Column:
    """What commas and semicolons separate, tidied, without empty parts."""
    bare = F.regexp_replace(author, _NICKNAME, " ")
    tidy = F.transform(F.split(bare, "[,;]"),
                       lambda part: F.trim(F.regexp_replace(part, r"\s+", " ")))
    return F.filter(tidy, lambda part: part != "")


def _in_order(parts: Column) -> Column:
    """The family part if it stands first, the other words, and suffixes in further parts."""
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    suffix_second = second.rlike(_ONLY_SUFFIXES) & first.contains(" ")
    family_first = (F.size(parts) > 1) & ~suffix_second
    words = F.when(family_first, second).otherwise(F.coalesce(first, F.lit("")))
    return F.struct(
        F.when(family_first, first).alias("family"),
        F.regexp_replace(words, _TITLES, "").alias("words"),
        F.slice(parts, F.when(family_first, 3).otherwise(2), F.greatest(F.size(parts), F.lit(1)))
        .alias("suffixes"),
    )


def _cut_suffixes(name: Column) -> Column:
    """The words as a list: those before trailing suffixes, and the suffixes if there are any."""
    return F.struct(
        name["family"].alias("family"),
        F.when(name["family"].isNull(), _halves(name["words"], _SUFFIX_AFTER_TWO))
        .otherwise(_halves(name["words"], _SUFFIX_AFTER_ONE)).alias("halves"),
        name["suffixes"].alias("suffixes"),
    )


def _cut_family(name: Column) -> Column:
    """Without a family part in front, the last word and the particles before it are the family."""
    words = name["halves"][0]
    found = F.filter(F.split(F.trim(F.get(name["halves"], F.lit(1))), " "), lambda w: w != "")
    return F.struct(
        name["family"].alias("family"),
        F.when(name["family"].isNull(), _halves(words, _PLAIN)).otherwise(F.array(words))
        .alias("halves"),
        F.concat(F.coalesce(found, F.array().cast("array<string>")), name["suffixes"])
        .alias("suffixes"),
    )


def _joined(name: Column) -> Column:
    last = F.coalesce(name["family"], F.get(name["halves"], F.lit(1)))
    return F.struct(
        F.trim(F.concat_ws(" ", last, F.array_join(name["suffixes"], ", "))).alias("family"),
        F.trim(name["halves"][0]).alias("given"),
    )


def _halves(text: Column, pattern: str) -> Column:
    """Both groups of the pattern, or the whole text where it does not match."""
    return F.split(F.regexp_replace(text, pattern, "$1\n$2"), "\n")
