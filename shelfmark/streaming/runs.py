"""Streams run over what is available now, with results kept as files in tiers.

A batch that runs again after a failure replaces its own files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import draft, fold
from shelfmark.streaming import tiers

# Keeps the state of a stream on disk, so that it may outgrow an executor's memory.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def current_status(events: DataFrame) -> DataFrame:
    """The newest status per submission, for a stream or a table of status events.

    Columns ``source_id``, ``ts``, ``event_id``, ``status``. A late event loses by its own
    ``(ts, event_id)``, so no watermark is needed; the state is one row per submission.
    """
    newest = F.max_by(F.struct("status", "ts", "event_id"), F.struct("ts", "event_id"))
    return (events.groupBy("source_id").agg(newest.alias("_newest"))
            .select("source_id", "_newest.*"))


def run_current_status(events: DataFrame, folder: str) -> None:
    """Processes the available events; every micro-batch writes the submissions it changed."""
    events.sparkSession.conf.set(*STATE_STORE)
    _run(current_status(events).writeStream.outputMode("update"), folder, lambda batch: batch,
         current_status)


def read_current_status(spark: SparkSession, folder: str) -> DataFrame:
    """The newest status per submission over all micro-batches."""
    return current_status(tiers.read(spark, folder))


def run_fold(log: DataFrame, folder: str) -> None:
    """Keeps the state of an edit log up to date, batch by batch.

    Each micro-batch writes the state of its own edits, so that its work grows with the batch and
    not with the history; states merge in any order.
    """
    _run(log.writeStream.outputMode("append"), folder, fold.partial_state, fold.merged_state)


def read_fold(spark: SparkSession, folder: str) -> DataFrame:
    """The values that hold after all micro-batches."""
    return fold.current_values(fold.merged_state(tiers.read(spark, folder)))


def run_draft(log: DataFrame, folder: str) -> None:
    """Keeps submissions up to date with a log of builder calls, all kinds of them.

    A batch writes the steps of its own calls that still count. An edit may arrive late, a clear
    or reset as well: what it changes shows when states merge, and the list elements after it
    move when they are numbered, without going back to the log.
    """
    _run(log.writeStream.outputMode("append"), folder, draft.partial_state, draft.merged_state)


def read_draft(spark: SparkSession, folder: str) -> DataFrame:
    """What submissions hold after all micro-batches, as ``draft.current_state`` has it."""
    return draft.standing(draft.merged_state(tiers.read(spark, folder)))


def _run(writer, folder: str, of_batch: Callable[[DataFrame], DataFrame],
         merge: Callable[[DataFrame], DataFrame]) -> None:
    def write(batch: DataFrame, batch_id: int) -> None:
        tiers.add(of_batch(batch), folder, batch_id, merge)
    (writer.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
