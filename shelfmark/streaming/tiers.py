"""Results of micro-batches in files of which a bounded number is ever read.

Every batch adds one part. As soon as the last ``FAN`` parts are of one width they are merged into
one, that one with its like in turn, and so on, so that after ``n`` batches at most
``FAN * log(n, FAN)`` parts stand, and each row has been rewritten ``log(n, FAN)`` times. Which
parts stand is told by a commit record, of which the last two are kept: a batch writes its parts
first and its record last, over the older one. A crash at any point leaves the record of the batch
before, and the batch that runs again overwrites whatever was left half done. Parts that were
merged are not read any more and can be removed (``superseded``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FAN = 8
_RECORD = "upto bigint, parts array<string>"
Part = tuple[int, int]  # first and last batch


def due(parts: list[Part], fan: int = FAN) -> list[Part]:
    """The parts at the end that are to be merged now, if any."""
    last = parts[-fan:]
    widths = {b - a for a, b in last}
    return last if len(last) == fan and len(widths) == 1 else []


def add(rows: DataFrame, folder: str, batch_id: int, merge: Callable[[DataFrame], DataFrame],
        fan: int = FAN, *, by: Sequence[str] = ()) -> None:
    """Adds the rows of a batch; ``merge`` turns the rows of several parts into those of one.

    Within a part there is one folder for each value of the columns ``by``.
    """
    spark = rows.sparkSession
    parts = _recorded(spark, folder).get(batch_id - 1, [])
    if batch_id and not parts:
        raise ValueError(f"{folder} has no record of batch {batch_id - 1}")
    rows.write.mode("overwrite").partitionBy(*by).parquet(_path(folder, (batch_id, batch_id)))
    parts = [*parts, (batch_id, batch_id)]
    while some := due(parts, fan):
        whole = (some[0][0], some[-1][1])
        rows_of_parts = _read(spark, folder, some, rows.schema if by else None)
        (merge(rows_of_parts).write.mode("overwrite").partitionBy(*by)
         .parquet(_path(folder, whole)))
        parts = [*parts[:-fan], whole]
    record = spark.createDataFrame([(batch_id, [f"{a}-{b}" for a, b in parts])], _RECORD)
    record.coalesce(1).write.mode("overwrite").parquet(f"{folder}/current/slot={batch_id % 2}")


def read(spark: SparkSession, folder: str, schema: StructType | None = None) -> DataFrame:
    """The rows of all parts that stand, still to be merged; ``schema`` is needed if they were
    added with ``by``."""
    return _read(spark, folder, standing(spark, folder), schema)


def standing(spark: SparkSession, folder: str) -> list[Part]:
    """The parts that are read."""
    recorded = _recorded(spark, folder)
    if not recorded:
        raise ValueError(f"no batch has been recorded in {folder}")
    return recorded[max(recorded)]


def superseded(spark: SparkSession, folder: str, fan: int = FAN) -> list[str]:
    """Folders of parts that no reader or rerun needs: those merged before the last batch."""
    recorded = _recorded(spark, folder)
    needed = {p for parts in recorded.values() for p in parts}
    out, parts = [], []
    for batch in range(min(recorded) + 1):
        parts.append((batch, batch))
        while some := due(parts, fan):
            out += some
            parts = [*parts[:-fan], (some[0][0], some[-1][1])]
    return [_path(folder, p) for p in out if p not in needed]


def _path(folder: str, part: Part) -> str:
    return f"{folder}/parts/{part[0]}-{part[1]}"


def _read(spark: SparkSession, folder: str, parts: list[Part],
          schema: StructType | None = None) -> DataFrame:
    paths = [_path(folder, p) for p in parts]
    if schema is None:
        return spark.read.parquet(*paths)
    # Parts with folders of their own inside cannot be one scan, and one may hold no rows at all.
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(p) for p in paths])


def _recorded(spark: SparkSession, folder: str) -> dict[int, list[Part]]:
    """The parts that stood after the last batch, and after the one before it."""
    try:
        rows = spark.read.schema(_RECORD).parquet(f"{folder}/current").collect()
    except AnalysisException:  # not one batch yet
        return {}
    return {r.upto: [tuple(map(int, p.split("-"))) for p in r.parts] for r in rows}
