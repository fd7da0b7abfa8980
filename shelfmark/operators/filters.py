"""The filter language over tables of submissions.

A filter is ``(field, operator, value)``; a list of filters means all of them. Each becomes a
plain Column expression, so Spark pushes it down to the scan.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.locations import SOURCE_ID
from shelfmark.functions.times import utc_bound, utc_literal

Filter = tuple[str, str, object]

_PLAIN_TYPES = (str, bool, int, float, datetime)


def filter_condition(schema: T.StructType, field: str, operator: str, value: object) -> Column:
    """One filter as a Column; unknown fields, operators and unfit values raise ``ValueError``.

    ``^`` begins with, ``*`` contains, ``==`` and ``!=`` (with ``None``: field missing, field
    present), ``>``, ``>=``, ``<``, ``<=``, ``[]`` between two values inclusive, ``in`` one of a
    list. A missing field satisfies nothing but ``== None``.
    """
    data_type = _field_type(schema, field)
    col = F.col(field)
    if operator in ("==", "!=") and value is None:
        return col.isNull() if operator == "==" else col.isNotNull()
    if operator in _TEXT_OPERATORS:
        return _TEXT_OPERATORS[operator](col, data_type, field, value)
    if operator == "[]":
        low, high = _literals(data_type, field, value, exactly=2)
        return col.between(low, high)
    if operator == "in":
        return col.isin(*_literals(data_type, field, value))
    if operator in _COMPARISONS:
        return _COMPARISONS[operator](col, _literal(data_type, field, value))
    raise ValueError(f"unknown filter operator {operator!r}")


def all_filters(schema: T.StructType, filters: Sequence[Filter]) -> Column:
    """The conjunction of the filters; no filter lets every row through."""
    return reduce(and_, [filter_condition(schema, *f) for f in filters], F.lit(True))


def select_submissions(
    submissions: DataFrame,
    filters: Sequence[Filter] | None = None,
    active_only: bool = False,
    include_tests: bool = True,
    newer_than: datetime | tuple[int, int, int] | None = None,
    older_than: datetime | tuple[int, int, int] | None = None,
) -> DataFrame:
    """Submissions that match all filters, flags and date bounds (both bounds inclusive)."""
    wanted = list(filters or [])
    if active_only:
        wanted.append(("active", "==", True))
    if not include_tests:
        wanted.append(("test", "==", False))
    wanted += date_filters(newer_than, older_than)
    return submissions.where(all_filters(submissions.schema, wanted))


def date_filters(newer_than, older_than, field: str = "submission_time") -> list[Filter]:
    """Filters for the date bounds given; equal or reversed bounds raise ``ValueError``."""
    start = None if newer_than is None else utc_bound(newer_than)
    end = None if older_than is None else utc_bound(older_than)
    if start is not None and end is not None:
        if start == end:
            raise ValueError("the date bounds are identical: to see one day, put the older bound "
                             "on the day after it")
        if start > end:
            raise ValueError("the newer-than bound must lie before the older-than bound")
    bounds = [(field, ">=", start), (field, "<=", end)]
    return [b for b in bounds if b[2] is not None]


def in_scope(submissions: DataFrame, owner: int | str | None = None,
             code: str | None = None) -> DataFrame:
    """The owner's submissions, or with a code ``all`` or all ``active`` ones."""
    if code is None:
        return submissions.where(F.col("owner") == F.lit(owner))
    if code == "all":
        return submissions
    if code == "active":
        return submissions.where("active")
    raise ValueError(f"unknown scope {code!r}")


def by_source_id(submissions: DataFrame, source_id: str) -> DataFrame:
    """The submission with this id.

    The name within the id is tested as well, so that a table laid out by name is read only
    where that name lies. The test prefix asks for a test submission. For submissions that are
    not numbered yet see ``catalog.by_source_id``.
    """
    parts = re.fullmatch(SOURCE_ID, source_id)
    if not parts:
        return submissions.where(F.col("source_id") == source_id)
    rows = submissions.where(F.col("source_id").isin(
        source_id, source_id.removeprefix(parts.group(1) or "")))
    if parts.group(1) and "test" in submissions.columns:
        rows = rows.where("test")
    if "source_name" in submissions.columns:
        rows = rows.where(F.col("source_name") == parts.group(2))
    return rows


def _begins(col, data_type, field, value):
    _require(isinstance(data_type, T.StringType) and isinstance(value, str), field, value)
    return col.startswith(F.lit(value))


def _contains(col, data_type, field, value):
    if isinstance(data_type, T.ArrayType):
        return F.array_contains(col, _literal(data_type.elementType, field, value))
    _require(isinstance(data_type, T.StringType) and isinstance(value, str), field, value)
    return col.contains(F.lit(value))


_TEXT_OPERATORS = {"^": _begins, "*": _contains}
_COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "==": lambda col, value: col == value,
    "!=": lambda col, value: col != value,
    ">": lambda col, value: col > value,
    ">=": lambda col, value: col >= value,
    "<": lambda col, value: col < value,
    "<=": lambda col, value: col <= value,
}


def _field_type(schema: T.StructType, field: str) -> T.DataType:
    found: T.DataType = schema
    for name in field.split("."):
        if not isinstance(found, T.StructType) or name not in found.names:
            raise ValueError(f"unknown field {field!r}")
        found = found[name].dataType
    return found


def _require(fits: bool, field: str, value: object) -> None:
    if not fits:
        raise ValueError(f"value {value!r} does not fit field {field!r}")


def _literals(data_type, field, value, exactly=None) -> list[Column]:
    is_list = isinstance(value, (list, tuple))
    _require(is_list and (exactly is None or len(value) == exactly), field, value)
    return [_literal(data_type, field, v) for v in value]


def _literal(data_type: T.DataType, field: str, value: object) -> Column:
    """The value as a literal, once it is known to suit the field's type."""
    is_number = isinstance(value, (int, float)) and not isinstance(value, bool)
    _require(isinstance(value, _PLAIN_TYPES), field, value)
    if isinstance(data_type, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        if isinstance(value, str):
            value = datetime.fromisoformat(value)
        _require(isinstance(value, datetime), field, value)
        return utc_literal(utc_bound(value))
    if isinstance(data_type, T.BooleanType):
        _require(isinstance(value, bool), field, value)
    elif isinstance(data_type, T.NumericType):
        _require(is_number, field, value)
    elif isinstance(data_type, T.StringType):
        _require(isinstance(value, str), field, value)
    else:
        _require(False, field, value)
    return F.lit(value)
