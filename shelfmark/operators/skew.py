"""Row numbers that hold when one key has a large share of all rows.

A key is *heavy* when it has more than ``rows_per_task`` rows. There are fewer heavy keys than
rows / ``rows_per_task``, which is what bounds the tables of heavy keys broadcast here: at a
trillion rows they have at most 250,000 entries. Joins on skewed keys need nothing of the kind:
adaptive execution splits them, see ``session.SETTINGS``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_TASK = 4_000_000


def heavy_keys(df: DataFrame, keys: Sequence[str],
               rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The keys with more than ``rows_per_task`` rows."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return counts.where(F.col("_n") > rows_per_task).select(*keys)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                slices: Sequence[Column], out: str,
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``row_number()`` per key without putting a heavy key into one task.

    Each of ``slices`` must never decrease along ``order`` (nulls first) among rows equal in those
    before it: the hour of a time, say, then the minute, and so on. Heavy keys are cut by the first
    one, heavy pieces by the next, and every piece is numbered from the count of rows before it.
    All other keys stay whole, so that they need the usual single shuffle. Beyond the count per
    key, the passes join the heavy keys, and adaptive execution leaves them out if there are none.
    """
    # In a struct, NULL keys and slices equal each other, so that they too can be heavy.
    rows = df.withColumn("_key", F.struct(*keys))
    piece, inside = ["_key"], rows
    for level, slice_by in enumerate(slices):
        heavy = F.broadcast(heavy_keys(inside, piece, rows_per_task))
        name = f"_slice{level}"
        inside = inside.join(heavy, piece).withColumn(name, F.struct(slice_by))
        rows = (rows.join(heavy.withColumn("_cut", F.lit(True)), piece, "left")
                .withColumn(name, F.when(F.col("_cut"), F.struct(slice_by))).drop("_cut"))
        if level == 0:
            first = heavy
        piece = [*piece, name]
    earlier = Window.partitionBy("_key").orderBy(*piece[1:]).rowsBetween(
        Window.unboundedPreceding, -1)
    before = (rows.join(first, "_key").groupBy(*piece).agg(F.count("*").alias("_n"))
              .select(F.struct(*piece).alias("_piece"), F.sum("_n").over(earlier).alias("_before")))
    # The plain keys are named too, so that filters on them reach the scan.
    within = Window.partitionBy(*keys, "_piece").orderBy(*order)
    number = F.row_number().over(within) + F.coalesce(F.col("_before"), F.lit(0))
    return (rows.withColumn("_piece", F.struct(*piece)).join(before, "_piece", "left")
            .withColumn(out, number.cast("bigint"))
            .drop(*piece, "_piece", "_before"))
