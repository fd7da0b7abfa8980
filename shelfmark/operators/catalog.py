"""Versions, inheritance, metadata updates and organizations of catalog entries."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.functions.locations import SOURCE_ID, source_id
from shelfmark.functions.status import status_word
from shelfmark.functions.times import order_slices
from shelfmark.operators.skew import ROWS_PER_TASK, number_rows
from shelfmark.session import checkpointed

ORDER = ("submission_time", "source_key")


def with_versions(submissions: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Adds ``version``, counted from 1 within a source name, and the ``source_id`` made of it."""
    numbered = number_rows(submissions, ["source_name"], ORDER,
                           order_slices(F.col("submission_time"), F.col("source_key")),
                           out="version", rows_per_task=rows_per_task)
    return numbered.withColumn("source_id", source_id(F.col("source_name"), F.col("version")))


def by_source_id(submissions: DataFrame, wanted: str) -> DataFrame:
    """The submission with an id, found among unnumbered ones: only its name is numbered.

    An id with the test prefix means the test submission of that version, as statuses and
    curation tasks write it; one without names either kind.
    """
    parts = re.fullmatch(SOURCE_ID, wanted)
    if not parts:
        return with_versions(submissions).limit(0)
    named = with_versions(submissions.where(F.col("source_name") == parts.group(2)))
    found = named.where(F.col("source_id") == wanted.removeprefix(parts.group(1) or ""))
    return found.where("test") if parts.group(1) else found


def latest_versions(submissions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The newest submission of each source name with its version.

    Versions have no gaps, so the newest one's number is the count: a plain aggregation with
    partial results, whatever the size of a name.
    """
    newest = F.max_by(F.struct(*columns), F.struct(*ORDER)).alias("_newest")
    return (submissions.groupBy("source_name")
            .agg(newest, F.count("*").alias("version"))
            .select("source_name", "version", "_newest.*"))


def resubmission_errors(incoming: DataFrame, submissions: DataFrame) -> DataFrame:
    """Adds ``error`` to incoming rows whose name exists already and that are no update."""
    known = submissions.select("source_name").distinct().withColumn("_known", F.lit(True))
    refused = F.col("_known").isNotNull() & ~F.coalesce(F.col("update"), F.lit(False))
    return (incoming.join(known, "source_name", "left")
            .withColumn("error", F.when(refused, F.lit(fixed.ALREADY_SUBMITTED)))
            .drop("_known"))


def inherit(incoming: DataFrame, submissions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fills what an update leaves out from the latest submission of the same name.

    Adds ``previous_version``, NULL where the name is new.
    """
    latest = latest_versions(submissions, columns).withColumnsRenamed(
        {"version": "previous_version", **{c: f"_old_{c}" for c in columns}})
    joined = incoming.join(latest, "source_name", "left")
    return (joined.withColumns({c: F.coalesce(c, f"_old_{c}") for c in columns})
            .drop(*[f"_old_{c}" for c in columns]))


def overlay_metadata(catalog: DataFrame, updates: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Catalog entries with the blocks of their metadata update, old blocks where it has none.

    ``updates`` has at most one row per ``source_id``; see ``last_update``.
    """
    new = updates.select("source_id", *[F.col(c).alias(f"_new_{c}") for c in columns])
    return (catalog.join(new, "source_id", "left")
            .withColumns({c: F.coalesce(f"_new_{c}", c) for c in columns})
            .drop(*[f"_new_{c}" for c in columns]))


def last_update(updates: DataFrame, columns: Sequence[str], order: Column) -> DataFrame:
    """The last of several metadata updates to one submission."""
    last = F.max_by(F.struct(*columns), order).alias("_last")
    return updates.groupBy("source_id").agg(last).select("source_id", "_last.*")


def eligible_updates(updates: DataFrame, catalog: DataFrame) -> DataFrame:
    """Metadata updates by the owner of a submission that has finished and succeeded."""
    done = ~F.col("active") & (status_word(F.col("status_code")) == "Succeeded")
    open_to = catalog.where(done).select("source_id", F.col("owner").alias("requester"))
    return updates.join(open_to, ["source_id", "requester"], "left_semi")


def registered_organizations(submissions: DataFrame, registry: DataFrame) -> DataFrame:
    """Submissions with an organization that is not in the registry set to NULL."""
    known = registry.select("organization").distinct().withColumn("_known", F.lit(True))
    registered = F.when(F.col("_known").isNotNull(), F.col("organization"))
    return (submissions.join(known, "organization", "left")
            .withColumn("organization", registered).drop("_known"))


def organization_ancestors(parents: DataFrame) -> DataFrame:
    """Every organization with each of its ancestors and the number of steps between them.

    ``parents`` has one row ``(org, parent)`` per organization. Chains may have any length; one
    that runs into a cycle ends where an ancestor would repeat, so that an organization in a cycle
    is listed as its own ancestor.

    Each round doubles the steps: the ancestors known of the farthest known ancestor are appended,
    by one join on it. A chain of ``n`` takes ``log2(n)`` rounds.
    """
    reach = 1
    known = checkpointed(parents.where("parent IS NOT NULL").select(
        "org", F.col("parent").alias("ancestor"), F.lit(1).cast("bigint").alias("depth")))
    newest, cyclic = known, False
    while True:
        # A path repeats itself only once those in the cycle have reached themselves.
        cyclic = cyclic or not newest.where("org = ancestor").isEmpty()
        far = newest.where(F.col("depth") == reach)
        if cyclic:
            met = known.groupBy("org", "ancestor").agg(F.min("depth").alias("depth"))
            known = checkpointed(met)
            # Whoever has met an ancestor twice has met them all.
            full = known.groupBy("org").agg(F.max("depth").alias("_all")).where(
                F.col("_all") == reach)
            far = far.join(full, "org", "left_semi")
        far = far.select("org", F.col("ancestor").alias("_far"))
        if far.isEmpty():
            return known.select("org", "ancestor", F.col("depth").cast("int").alias("depth"))
        above = known.select(F.col("org").alias("_far"), "ancestor", "depth")
        newest = checkpointed(far.join(above, "_far").select(
            "org", "ancestor", (F.col("depth") + reach).alias("depth")))
        known, reach = known.unionAll(newest), 2 * reach


def with_ancestors(submissions: DataFrame, parents: DataFrame) -> DataFrame:
    """One row per submission and organization: its own and that one's ancestors."""
    own = submissions.where(F.col("organization").isNotNull()).select("source_key", "organization")
    lines = organization_ancestors(parents).where("ancestor <> org").select(
        F.col("org").alias("organization"), F.col("ancestor").alias("_ancestor"))
    above = own.join(lines, "organization")
    return own.unionByName(above.select("source_key", F.col("_ancestor").alias("organization")))
