"""Status codes and the texts shown for them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark import fixed


def status_word(code: Column) -> Column:
    """One word for a status code; the first rule that holds decides.

    A code has one letter per processing step, so a failed step outranks a running one, and only
    then do the last and first steps count. An empty or missing code is ``Unknown``.
    """
    rules = {
        "Failed": code.contains("F"),
        "Processing": code.contains("P"),
        "Succeeded": code.endswith("S"),
        "Cancelled": code.endswith("X"),
        "Not started": code.startswith("z"),
        "Retrying error": code.contains("R"),
    }
    return F.coalesce(*[F.when(holds, F.lit(word)) for word, holds in rules.items()],
                      F.lit("Unknown"))


def active_message(active: Column) -> Column:
    """The sentence for a submission that is, or is no longer, being processed."""
    return (F.when(active, F.lit(fixed.STILL_PROCESSING))
            .otherwise(F.lit(fixed.NO_LONGER_PROCESSING)))


def report_line(source_id: Column, active: Column, code: Column) -> Column:
    """``id: Processing - word`` or ``id: Not processing - word``."""
    phase = F.when(active, F.lit("Processing")).otherwise(F.lit("Not processing"))
    return F.concat(source_id, F.lit(": "), phase, F.lit(" - "), status_word(code))


def short_line(source_id: Column, flow_status: Column) -> Column:
    """``id: message`` for one submission, or the error text when its flow has no status."""
    return _with_status(flow_status, lambda message: F.concat(source_id, F.lit(": "), message))


def full_text(display: Column, flow_status: Column) -> Column:
    """The display status and the message below it, or the error text."""
    return _with_status(flow_status, lambda message: F.concat_ws("\n", display, message))


def verbose_text(status_message: Column, active: Column) -> Column:
    """A submission's own message directly followed by the activity sentence."""
    return F.concat(F.coalesce(status_message, F.lit("")), active_message(active))


def status_error(flow_status: Column) -> Column:
    """The error text where a flow has no status, else NULL."""
    return F.when(flow_status.isNull(), F.lit(fixed.NO_STATUS))


def _with_status(flow_status: Column, text) -> Column:
    return F.coalesce(status_error(flow_status), text(active_message(flow_status == "ACTIVE")))
