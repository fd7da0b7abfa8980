"""What the operators of this subpackage share: session settings, folders, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shelfmark.session import work_folder

# Rows of a batch handed to Python: bounds its memory also where every text is long.
BATCH_ROWS = 512
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def prepared(spark: SparkSession) -> SparkSession:
    """Settings the operators count on; they hold for the session from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read from there: cuts lineage in a
    way that survives lost executors."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def map_batches(df: DataFrame, columns: list[str], schema: str,
                work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """``work`` on every Arrow batch of the named columns of ``df``.

    Only these columns leave the JVM, so that further columns of any name do no harm.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)
    return df.select(*columns).mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a column, null read as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def lower_words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text with A-Z in lower case; white space is
    the blank, tab, line feed, vertical tab, form feed and carriage return."""
    return text.translate(_LOWER).split()


def bytes_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a column as UTF-8, null read as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows of each value of a long column by which the batches are sorted. Never holds more
    than a batch and one value's rows."""
    parts: list[pa.Table] = []  # of the value that the last batch ended with

    def whole() -> pa.Table:
        return pa.concat_tables(parts).combine_chunks()
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy()
        cuts = [*(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        if parts and values[0] != last:
            yield whole()
            parts = []
        start = 0
        for cut in cuts:
            if start:
                yield whole()
                parts = []
            parts.append(pa.Table.from_batches([batch.slice(start, cut - start)]))
            start = cut
        last = values[-1]
    if parts:
        yield whole()
