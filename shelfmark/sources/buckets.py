"""A stored catalog of which an update rewrites only the buckets it touches.

Entries are dealt into buckets by a hash of their ``source_id``, so that the entries of one name
are spread however many there are. An update writes the buckets of its ids as a new generation
and then a record of which generation holds each bucket; all other files stay as they are. The last
two records are kept: a crash leaves the catalog as it was, and an update that runs again writes
the same. One update runs at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.operators.catalog import overlay_metadata

BUCKETS = 256
_RECORD = "generation bigint, buckets int, columns string, holders map<int,bigint>"


def create(catalog: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Writes a catalog, which has a ``source_id`` column, into an empty folder."""
    _commit(catalog, path, 0, buckets, _write(catalog, path, 0, buckets))


def read(spark: SparkSession, path: str) -> DataFrame:
    """All entries."""
    return _read(spark, path, _records(spark, path)[0], None)


def lookup(spark: SparkSession, path: str, wanted: str) -> DataFrame:
    """The entry with an id, from its bucket alone."""
    record = _records(spark, path)[0]
    bucket = spark.range(1).select(_bucket(F.lit(wanted), record.buckets)).first()[0]
    return _read(spark, path, record, {bucket}).where(F.col("source_id") == wanted)


def overlay(updates: DataFrame, path: str, columns: Sequence[str]) -> int:
    """Lays metadata updates over the stored entries, as ``catalog.overlay_metadata`` does.

    ``updates`` has at most one row per ``source_id``. Returns how many buckets were rewritten;
    the driver collects their numbers, of which there are no more than buckets.
    """
    spark = updates.sparkSession
    record = _records(spark, path)[0]
    touched = {row[0] for row in updates.where("source_id is not null").select(
        _bucket(F.col("source_id"), record.buckets)).distinct().collect()} & set(record.holders)
    if not touched:
        return 0
    generation = record.generation + 1
    laid = overlay_metadata(_read(spark, path, record, touched), updates, columns)
    _write(laid, path, generation, record.buckets)
    _commit(laid, path, generation, record.buckets,
            {**record.holders, **dict.fromkeys(touched, generation)})
    return len(touched)


def superseded(spark: SparkSession, path: str) -> list[str]:
    """Folders of buckets that neither of the two last records needs."""
    needed = {_folder("", g, b) for r in _records(spark, path) for b, g in r.holders.items()}
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(f"{path}/generations"))
    stored = files.select(F.regexp_extract("path", "/generations/[0-9]+/_bucket=[0-9]+", 0)
                          .alias("folder")).where("folder <> ''").distinct()
    return sorted(f"{path}{row['folder']}" for row in stored.collect()
                  if row["folder"] not in needed)


def _bucket(source_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(source_id), F.lit(buckets)).cast("int").alias("_bucket")


def _folder(path: str, generation: int, bucket: int) -> str:
    return f"{path}/generations/{generation}/_bucket={bucket}"


def _write(entries: DataFrame, path: str, generation: int, buckets: int) -> dict[int, int]:
    """Writes entries as a generation; returns the generation of each bucket that has some."""
    dealt = entries.withColumn("_bucket", _bucket(F.col("source_id"), buckets))
    target = f"{path}/generations/{generation}"
    # A large bucket is written by several tasks, small ones together by one.
    dealt.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket") \
        .parquet(target)
    found = entries.sparkSession.read.schema(dealt.schema).parquet(target)
    return {row[0]: generation for row in found.select("_bucket").distinct().collect()}


def _read(spark: SparkSession, path: str, record: Row, some: set[int] | None) -> DataFrame:
    schema = StructType.fromJson(json.loads(record.columns))
    held = {b: g for b, g in record.holders.items() if some is None or b in some}
    if not held:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(
        *[_folder(path, g, b) for b, g in sorted(held.items())])


def _commit(entries: DataFrame, path: str, generation: int, buckets: int,
            holders: dict[int, int]) -> None:
    record = entries.sparkSession.createDataFrame(
        [(generation, buckets, entries.schema.json(), holders)], _RECORD)
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/current/slot={generation % 2}")


def _records(spark: SparkSession, path: str) -> list[Row]:
    """The last record, and the one before it."""
    return sorted(spark.read.schema(_RECORD).parquet(f"{path}/current").collect(),
                  key=lambda r: -r.generation)
