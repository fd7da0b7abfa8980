"""Writers for assembled submissions and routed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shelfmark.operators.submission import submission_json

# Columns by which a stored catalog is asked for single entries.
LOOKED_UP = ["source_id", "source_key"]


def write_submissions(submissions: DataFrame, path: str, placement_name: str = "placement",
                      mode: str = "errorifexists") -> None:
    """Submissions as lines of JSON, exactly one document per line."""
    submissions.select(submission_json(submissions, placement_name).alias("value")) \
        .write.mode(mode).text(path)


def write_routed(df: DataFrame, path: str, by: str | Sequence[str],
                 mode: str = "errorifexists") -> None:
    """Rows as parquet, one folder per route (``service``, ``test``, ``search_index``).

    Rebalanced by route first: few files for a small route, several tasks for a large one.
    """
    routes = [by] if isinstance(by, str) else list(by)
    df.hint("rebalance", *routes).write.mode(mode).partitionBy(*routes).parquet(path)


def write_catalog(catalog: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The catalog as parquet, tests apart from live entries, in order of source name.

    Files then cover narrow ranges of names, so that a lookup by name or source id reads few of
    them. The range is taken over the unique key as well, which splits a name with many entries.
    Bloom filters on the ids let a lookup leave out the row groups that lack its id, though it
    lies within their range: one of an id that is nowhere reads hardly any.
    """
    writer = (catalog.repartitionByRange("test", "source_name", "source_key")
              .sortWithinPartitions("test", "source_name", "source_key")
              .write.mode(mode).partitionBy("test"))
    for name in LOOKED_UP:
        if name in catalog.columns:
            # Sized by what a row group holds, up to the writer's bound.
            writer = (writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
                      .option("parquet.bloom.filter.adaptive.enabled", "true"))
    writer.parquet(path)
