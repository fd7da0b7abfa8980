"""Curation tasks: summaries and the verdicts applied to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.functions.times import iso_time
from shelfmark.operators.validate import verdict, verdict_error


def summaries(tasks: DataFrame) -> DataFrame:
    """The four fields a curator looks at first, and the text made of them."""
    return tasks.select(
        "source_id",
        F.col("submission_info.submitter").alias("submitter"),
        iso_time(F.col("curation_start_date")).alias("waiting_since"),
        "extraction_summary",
    ).withColumn("summary", F.format_string(
        fixed.CURATION_SUMMARY, "source_id", F.col("submitter").cast("string"), "waiting_since",
        "extraction_summary"))


def reason(action: Column, given: Column) -> Column:
    """The reason given, as it is, else the default one of the verdict."""
    default = F.coalesce(*[F.when(action == a, F.lit(text))
                           for a, text in fixed.DEFAULT_REASONS.items()])
    return F.coalesce(F.nullif(given, F.lit("")), default)


def usable_verdicts(verdicts: DataFrame) -> DataFrame:
    """Valid verdicts with normal action and reason."""
    action = verdict(F.col("action"))
    return (verdicts.where(verdict_error(F.col("action")).isNull())
            .withColumns({"action": action, "reason": reason(action, F.col("reason"))}))


def first_verdicts(verdicts: DataFrame, order: str) -> DataFrame:
    """The first verdict on each task; once decided a task takes no more."""
    first = F.min_by(F.struct("action", "reason"), order).alias("_first")
    return verdicts.groupBy("source_id").agg(first).select("source_id", "_first.*")


def apply_verdicts(tasks: DataFrame, verdicts: DataFrame, order: str) -> DataFrame:
    """Decided tasks: accepted ones continue, rejected ones have failed for good."""
    decided = first_verdicts(usable_verdicts(verdicts), order)
    outcome = F.when(F.col("action") == "accept", "continues").otherwise("failed")
    return tasks.join(decided, "source_id").withColumn("outcome", outcome)


def unknown_verdicts(verdicts: DataFrame, tasks: DataFrame) -> DataFrame:
    """Valid verdicts on tasks that do not exist, with the error text."""
    return (usable_verdicts(verdicts).join(tasks.select("source_id"), "source_id", "left_anti")
            .withColumn("error", F.lit(fixed.TASK_NOT_FOUND)))
