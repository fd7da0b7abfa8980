"""Rules for submissions, each a Column with the error text or NULL, and their collection."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import fixed
from shelfmark.functions import locations
from shelfmark.functions.documents import is_finite_json, is_finite_number


def required_arguments(titles: Column, authors: Column) -> Column:
    """Titles and authors, both lists, must be there."""
    no_title, no_authors = _is_empty(titles), _is_empty(authors)
    return (F.when(no_title & no_authors, F.lit(fixed.TITLE_AND_AUTHORS_REQUIRED))
            .when(no_title, F.lit(fixed.TITLE_REQUIRED))
            .when(no_authors, F.lit(fixed.AUTHORS_REQUIRED)))


def required_blocks(has_dc: Column, data_sources: Column, metadata_only: Column) -> Column:
    """The citation block and data sources must be there, unless only metadata is updated."""
    exempt = F.coalesce(metadata_only, F.lit(False))
    return F.when((~has_dc | _is_empty(data_sources)) & ~exempt, F.lit(fixed.BLOCKS_REQUIRED))


def finite_json(name: str, text: Column) -> Column:
    """A JSON block must parse and hold no NaN or infinite number."""
    return F.when(~is_finite_json(text), F.lit(f"Error: Your {name} is invalid"))


def finite_values(name: str, col: Column, data_type: T.DataType) -> Column:
    """No number at any depth of a typed block may be NaN or infinite."""
    return F.when(~F.coalesce(_is_finite(col, data_type), F.lit(True)),
                  F.lit(f"Error: Your {name} is invalid"))


def custom_keys(custom: Column, limit: int = 10) -> Column:
    """At most ten custom fields; their ``_desc`` entries do not count."""
    return F.when(F.size(_fields(custom)) > limit,
                  F.lit(f"A custom block has at most {limit} fields"))


def described_fields(custom: Column) -> Column:
    """Every ``<field>_desc`` needs its field."""
    lonely = F.filter(F.map_keys(custom), lambda k: k.endswith("_desc") & ~F.map_contains_key(
        custom, F.regexp_replace(k, "_desc$", "")))
    return F.when(F.size(lonely) > 0,
                  F.concat(F.lit("Description without a field: "), F.array_join(lonely, ", ")))


def passthrough_sources(no_extract: Column, data_sources: Column) -> Column:
    """Data passed through without extraction cannot come over HTTP(S)."""
    return F.when(F.coalesce(no_extract, F.lit(False)) & F.exists(data_sources, locations.is_http),
                  F.lit("HTTP(S) data sources are not supported with pass-through"))


def destinations(data_destinations: Column) -> Column:
    """Every destination is an endpoint location or a web-app link."""
    return F.when(F.exists(data_destinations, lambda d: ~locations.is_destination(d)),
                  F.lit("Data destinations must be endpoint locations"))


def verdict(action: Column) -> Column:
    """A verdict is ``accept`` or ``reject`` once trimmed and in lower case."""
    return F.lower(F.regexp_replace(action, r"^\s+|\s+$", ""))


def verdict_error(action: Column) -> Column:
    known = list(fixed.DEFAULT_REASONS)
    valid = F.coalesce(verdict(action).isin(known), F.lit(False))
    text = F.concat(F.lit("Verdict '"), F.coalesce(verdict(action), F.lit("")),
                    F.lit("' is invalid. Valid verdicts are: " + ", ".join(known)))
    return F.when(~valid, text)


def with_errors(df: DataFrame, rules: Mapping[str, Column] | list[Column]) -> DataFrame:
    """Adds ``errors``, the texts of all rules a row breaks; accepted rows have none."""
    columns = list(rules.values()) if isinstance(rules, Mapping) else list(rules)
    return df.withColumn("errors", F.array_compact(F.array(*columns)))


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows."""
    is_accepted = F.size("errors") == 0
    return validated.where(is_accepted), validated.where(~is_accepted)


def _is_finite(col: Column, data_type: T.DataType) -> Column:
    """Whether all numbers in a value are finite; NULL where there is nothing to test."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return is_finite_number(col)
    if isinstance(data_type, T.StructType):
        tests = [F.coalesce(_is_finite(col[f.name], f.dataType), F.lit(True)) for f in data_type]
        return reduce(and_, tests, F.lit(True))
    if isinstance(data_type, T.ArrayType):
        return F.forall(col, lambda x: F.coalesce(_is_finite(x, data_type.elementType),
                                                  F.lit(True)))
    if isinstance(data_type, T.MapType):
        return _is_finite(F.map_values(col), T.ArrayType(data_type.valueType))
    return F.lit(True)


def _fields(custom: Column) -> Column:
    return F.filter(F.map_keys(custom), lambda k: ~k.endswith("_desc"))


def _is_empty(items: Column) -> Column:
    return F.coalesce(F.size(items) == 0, F.lit(True))
