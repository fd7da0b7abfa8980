"""Version numbers of submissions that arrive in batches, kept without numbering all anew.

Two results are kept in tiers (``streaming/tiers.py``): how many submissions a name has per hour,
and when each one was submitted, in
folders of ``SPAN_DAYS``. A number is the count of the name's earlier hours and the
place within its own hour, so that a batch reads the counts of its own names and the times of the
spans it falls on. A submission that arrives late moves those after it: asked again, they have their new numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.locations import source_id
from shelfmark.functions.times import hour_number, order_slices
from shelfmark.operators.catalog import ORDER
from shelfmark.operators.skew import ROWS_PER_TASK, number_rows
from shelfmark.streaming import tiers

SPAN_DAYS = 30
NO_SPAN = -1_000_000  # of a submission without a time


def add(batch: DataFrame, folder: str, batch_id: int) -> None:
    """Takes in a batch of submissions: ``source_name``, ``submission_time``, ``source_key``.

    The key is unique. A batch that runs again under its number replaces itself, also after a
    crash between the two results.
    """
    rows = _times(batch)
    counts = rows.groupBy("source_name", "hour").agg(F.count("*").alias("n"))
    tiers.add(counts, f"{folder}/counts", batch_id, _summed)
    tiers.add(rows.hint("rebalance", "span"), f"{folder}/times", batch_id,
              lambda parts: parts.hint("rebalance", "span"), by=["span"])


def numbered(wanted: DataFrame, folder: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Adds ``version`` and ``source_id``, as of the last batch, to submissions taken in before.

    Equal to ``catalog.with_versions`` over all submissions so far, whichever are asked for. The
    driver collects the spans of those wanted, twelve a year at most.
    """
    spark = wanted.sparkSession
    asked = wanted.withColumns({"_hour": _hour(), "_span": _span()})
    spans = [row["_span"] for row in asked.select("_span").distinct().collect()]
    pieces = _known(asked.select("source_name", F.col("_hour").alias("hour")),
                    "source_name", "hour").select(*_KNOWN).distinct()
    names = _known(asked, "source_name").select(*_KNOWN).distinct()

    counts = (_known(tiers.read(spark, f"{folder}/counts"), "source_name")
              .join(names, _KNOWN, "left_semi").drop(*_KNOWN))
    summed = _summed(counts)
    earlier = Window.partitionBy("source_name").orderBy("hour").rowsBetween(
        Window.unboundedPreceding, -1)
    before = _known(summed.withColumn(
        "_before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "source_name", "hour").select(
            *_KNOWN, "_before")

    times = (tiers.read(spark, f"{folder}/times", _times(wanted).schema).where(F.col("span").isin(spans)))
    times = _known(times, "source_name", "hour").join(pieces, _KNOWN, "left_semi")
    # An hour has at most the largest count of a part from each of them.
    most = tiers.read(spark, f"{folder}/counts").agg(F.max("n")).first()[0] or 0
    parts = len(tiers.standing(spark, f"{folder}/counts"))
    if most * parts <= rows_per_task or summed.where(F.col("n") > rows_per_task).isEmpty():
        # The counts tell that no hour is heavy, so that the rows need not be counted again.
        inside = Window.partitionBy(*_KNOWN).orderBy(*ORDER)
        places = times.withColumn("_place", F.row_number().over(inside).cast("bigint"))
    else:
        # The hour is a key here, so that only what is finer is left to cut a heavy one by.
        finer = order_slices(F.col("submission_time"), F.col("source_key"))[1:]
        places = _known(number_rows(times.drop(*_KNOWN), ["source_name", "hour"], ORDER, finer,
                                    out="_place", rows_per_task=rows_per_task),
                        "source_name", "hour")
    versions = places.join(before, _KNOWN).drop(*_KNOWN).withColumn(
        "version", F.col("_before") + F.col("_place"))
    versions = _known(versions, "source_name", *ORDER).select(*_KNOWN, "version")
    return (_known(asked, "source_name", *ORDER).join(versions, _KNOWN)
            .drop(*_KNOWN, "_hour", "_span")
            .withColumn("source_id", source_id(F.col("source_name"), F.col("version"))))


_KNOWN = ["_hash", "_piece"]


def _known(rows: DataFrame, *columns: str) -> DataFrame:
    """Adds a key of columns that may be NULL. Sorts compare it by the hash in front; a struct
    alone is compared field by field."""
    return rows.withColumns({"_hash": F.xxhash64(*columns), "_piece": F.struct(*columns)})


def _times(submissions: DataFrame) -> DataFrame:
    return submissions.select("source_name", *ORDER, _hour(), _span())


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("source_name", "hour").agg(F.sum("n").alias("n"))


def _hour() -> Column:
    return hour_number(F.col("submission_time")).alias("hour")


def _span() -> Column:
    day = F.datediff(F.to_date("submission_time"), F.lit("1970-01-01"))
    return F.coalesce(F.floor(day / SPAN_DAYS), F.lit(NO_SPAN)).cast("int").alias("span")
