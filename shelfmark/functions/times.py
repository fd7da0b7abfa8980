"""Dates and times of the catalog, all of them UTC without a zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_time(time: Column) -> Column:
    """ISO text ending in a literal ``Z``; a fraction is written only where there is one."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    exact = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(exact.endswith(".000000Z"), whole).otherwise(exact)


def utc_bound(bound: datetime | tuple[int, int, int]) -> datetime:
    """A date bound as a naive UTC datetime; ``(year, month, day)`` means that midnight."""
    if not isinstance(bound, datetime):
        bound = datetime(*bound)
    if bound.tzinfo is not None:
        bound = bound.astimezone(timezone.utc).replace(tzinfo=None)
    return bound


def utc_literal(bound: datetime) -> Column:
    """A naive datetime as a ``timestamp_ntz`` literal."""
    return F.lit(bound.isoformat(" ")).cast("timestamp_ntz")


def hour_number(time: Column) -> Column:
    """Hours since 1970, a coarse order that never contradicts the time itself."""
    return F.datediff(F.to_date(time), F.lit("1970-01-01")) * 24 + F.hour(time)


def order_slices(time: Column, number: Column, ids_per_slice: int = 1_000_000) -> list[Column]:
    """Slices, coarse to fine, of rows ordered by a time and then a number: hours, seconds, and
    within a second equal times by ranges of the number.

    Each level is cut only where the one before is still too large, so that there are few pieces
    however exact the times are.
    """
    id_range = F.floor(number / ids_per_slice)
    return [hour_number(time), F.minute(time) * 60 + F.floor(F.second(time)),
            F.struct(time.alias("time"), id_range.alias("range"))]
