"""Edit logs folded into the current state of submissions.

A log has columns ``submission_id``, ``op``, ``key``, ``payload`` and an orderable ``seq``, unique
within a submission. Results stay in long form, one row per list element or per key, so that a
submission with any number of edits is never gathered in one place. Aggregations combine partial
results before the shuffle; joins are split by adaptive execution, numberings by slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.documents import is_finite_json, json_problem
from shelfmark.operators.skew import ROWS_PER_TASK, number_rows

FIELD = ("submission_id", "key")


def appended(log: DataFrame, slices: Sequence[Column], rows_per_task: int = ROWS_PER_TASK,
             keys: Sequence[str] = FIELD) -> DataFrame:
    """Every appended element with its place ``pos`` in the list, from 1; duplicates stay.

    ``slices`` cut a heavy list along ``seq``; see ``number_rows``.
    """
    elements = log.where("op = 'append'")
    return number_rows(elements, keys, ["seq"], slices, out="pos", rows_per_task=rows_per_task)


def last_write(log: DataFrame, keys: Sequence[str] = FIELD,
               columns: Sequence[str] = ("payload",)) -> DataFrame:
    """The last edit per key: later ones overwrite."""
    return _pick(log, keys, columns, F.max_by)


def first_write(log: DataFrame, keys: Sequence[str] = FIELD,
                columns: Sequence[str] = ("payload",)) -> DataFrame:
    """The first edit per key: later ones are ignored."""
    return _pick(log, keys, columns, F.min_by)


def upserted(log: DataFrame, columns: Sequence[str] = ("payload",)) -> DataFrame:
    """The last value of each key of each submission."""
    return last_write(log.where("op = 'upsert'"), FIELD, columns)


def without_deleted(log: DataFrame, columns: Sequence[str] = ("payload",)) -> DataFrame:
    """The last value of each key, without keys whose last edit deletes them.

    An upsert with falsy JSON in it deletes too.
    """
    edits = log.where(F.col("op").isin("upsert", "delete"))
    last = last_write(edits, FIELD, ["op", *columns, *({"payload"} - set(columns))])
    return last.where((F.col("op") == "upsert") & ~is_falsy(F.col("payload"))).select(
        *FIELD, *columns)


def partial_state(log: DataFrame) -> DataFrame:
    """What some edits say about each key: its last ``edit`` and when it was last ``cleared``.

    Such states of parts of a log merge in any order, see ``merged_state``.
    """
    written = F.when(F.col("op").isin("upsert", "delete"), F.col("seq"))
    return log.groupBy(*FIELD).agg(
        F.max(F.when(F.col("op") == "clear", F.col("seq"))).alias("cleared"),
        F.max_by(F.struct("seq", "op", "payload"), written).alias("edit"))


def merged_state(states: DataFrame) -> DataFrame:
    """One state per key from those of several parts of the log."""
    return states.groupBy(*FIELD).agg(F.max("cleared").alias("cleared"),
                                      F.max_by("edit", "edit.seq").alias("edit"))


def current_values(state: DataFrame) -> DataFrame:
    """The values that hold, as ``without_deleted(after_clear(log))`` has them for a whole log."""
    stands = F.col("cleared").isNull() | (F.col("edit.seq") > F.col("cleared"))
    return (state.where(stands & (F.col("edit.op") == "upsert"))
            .select(*FIELD, F.col("edit.payload").alias("payload"))
            .where(~is_falsy(F.col("payload"))))


def after_clear(log: DataFrame, keys: Sequence[str] = FIELD) -> DataFrame:
    """The edits that come after the last ``clear`` of their field."""
    cleared = (log.where("op = 'clear'").groupBy(*keys)
               .agg(F.max("seq").alias("_cleared")))
    edits = log.where("op <> 'clear'")
    joined = edits.join(cleared, list(keys), "left")
    return joined.where(_is_after("_cleared")).drop("_cleared")


def after_reset(log: DataFrame, keep: Sequence[str] = ("test", "update")) -> DataFrame:
    """The edits that come after the last ``reset`` of their submission.

    Fields in ``keep`` are not reset. Clears still stand: apply ``after_clear`` to the result.
    """
    reset = (log.where("op = 'reset'").groupBy("submission_id")
             .agg(F.max("seq").alias("_reset")))
    edits = log.where("op <> 'reset'")
    joined = edits.join(reset, "submission_id", "left")
    return joined.where(F.col("key").isin(*keep) | _is_after("_reset")).drop("_reset")


def is_falsy(payload: Column) -> Column:
    """Whether a payload is nothing: missing, JSON null, false, zero, empty text, list or object."""
    bare = F.regexp_replace(payload, r"^\s+|\s+$", "")
    zero = bare.rlike(r"^-?0(\.0+)?([eE][+-]?[0-9]+)?$")
    return (payload.isNull() | bare.isin("", "null", "false", '""') | zero
            | bare.rlike(r"^(\[\s*\]|\{\s*\})$"))


def valid_edits(log: DataFrame) -> DataFrame:
    """The log without edits whose payload is not finite JSON, so earlier values stand."""
    return log.where(is_finite_json(F.col("payload")))


def rejected_edits(log: DataFrame) -> DataFrame:
    """The edits that ``valid_edits`` leaves out, with the ``reason``."""
    return (log.withColumn("reason", json_problem(F.col("payload")))
            .where(F.col("reason").isNotNull()))


def in_chunks(elements: DataFrame, chunk_size: int = 10_000) -> DataFrame:
    """Numbered list elements as arrays of at most ``chunk_size``, in order.

    Columns ``submission_id``, ``key``, ``chunk`` (from 0) and ``payloads``. A list that fits one
    chunk is one row; a longer one takes as many rows as it needs.
    """
    chunk = F.floor((F.col("pos") - 1) / chunk_size).cast("bigint")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "payload")))
    return (elements.groupBy(*FIELD, chunk.alias("chunk"))
            .agg(F.transform(ordered, lambda e: e["payload"]).alias("payloads")))


def _pick(log, keys, columns, choose) -> DataFrame:
    return (log.groupBy(*keys).agg(choose(F.struct(*columns), "seq").alias("_edit"))
            .select(*keys, "_edit.*"))


def _is_after(bound: str) -> Column:
    return F.col(bound).isNull() | (F.col("seq") > F.col(bound))
