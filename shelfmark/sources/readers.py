"""Readers that apply a mapping to files and return nested records.

Each reads only the mapped fields, keeps the file's path as ``file``, and leaves out rows in
which no mapped field has a value.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.extract import (
    NaValues, json_records, name_records, nested_schema, records, struct_fields, tabular_na,
    union_records, yaml_documents,
)

Mapped = Mapping[str, str]


def read_json(spark: SparkSession, path: str, mapping: Mapped, types: Mapped | None = None,
              na_values: NaValues = None, multi_line: bool = True) -> DataFrame:
    """JSON files, one document (or list of documents) per file or one per line."""
    schema = nested_schema(list(mapping.values()))
    df = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return _records(df, mapping, types, na_values)


def read_csv(spark: SparkSession, path: str, mapping: Mapped, delimiter: str = ",",
             types: Mapped | None = None, na_values: NaValues = None,
             one_header: bool = False) -> DataFrame:
    """Delimited files with a header line each, which may differ from file to file.

    A first pass finds the header of every file; files of one header are then one scan that reads
    only the mapped columns, and the scans are united by name. A mapped column that a file lacks
    is missing in its records. With ``one_header`` the pass is left out: a file whose header has
    other names, or the same in another order, then fails the query.
    """
    def scan(paths: str | list[str]) -> DataFrame:
        df = spark.read.csv(paths, sep=delimiter, header=True, quote='"', escape='"',
                            emptyValue="", enforceSchema=False)
        return _records(df, mapping, types, tabular_na(na_values))
    groups = [] if one_header else _files_by_header(spark, path)
    return union_records(*map(scan, groups)) if len(groups) > 1 else scan(path)


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files under a path, those with the same first line together.

    The driver learns the files' names, as it does for any read.
    """
    headers = _headers(spark, path)
    # Paths come escaped as in a URL, and are read as patterns.
    plain = F.regexp_replace(F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B"))),
                             r"([\\\[\]{}*?])", r"\\$1")
    groups = headers.groupBy("h0", "h1").agg(F.sort_array(F.collect_list(plain)).alias("files"))
    return [row["files"] for row in groups.orderBy("files").collect()]


def _headers(spark: SparkSession, path: str) -> DataFrame:
    """Each ``file`` with 128 bits of hashes of its first line, ``h0`` and ``h1``.

    Only one row per file leaves a task. Unlike texts, hashes are aggregated without sorting all
    lines of a task.
    """
    line = F.col("value")
    lines = spark.read.text(path).where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"),
        line).where(F.trim(line) != "")
    return lines.groupBy("file").agg(
        *[F.min_by(F.xxhash64(F.lit(n), line), "at").alias(f"h{n}") for n in range(2)])


def read_xml(spark: SparkSession, path: str, mapping: Mapped, row_tag: str,
             types: Mapped | None = None, na_values: NaValues = None) -> DataFrame:
    """XML files, one record per ``row_tag`` element."""
    schema = nested_schema(list(mapping.values()))
    df = spark.read.format("xml").schema(schema).option("rowTag", row_tag).load(path)
    return _records(df, mapping, types, na_values)


def read_yaml(spark: SparkSession, path: str, mapping: Mapped, types: Mapped | None = None,
              na_values: NaValues = None) -> DataFrame:
    """YAML files, one record per document."""
    files = spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("file"), F.col("content").cast("string").alias("text"))
    return yaml_records(files, "text", mapping, types, na_values, keep=["file"])


def read_file_names(spark: SparkSession, path: str, patterns: Mapped) -> DataFrame:
    """Records from file names by regular expressions; the files' content is not read."""
    files = spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("file"), F.regexp_extract("path", "[^/]*$", 0).alias("name"))
    return name_records(files, F.col("name"), patterns, keep=["file"])


def read_indexed(spark: SparkSession, paths: Mapping[str, str], index: Mapping[str, Mapping],
                 row_tag: str = "record", types: Mapped | None = None) -> DataFrame:
    """Records of all data types of a submission, by its index configuration.

    ``index`` gives each data type its ``mapping`` and, where wanted, ``delimiter`` and
    ``na_values``; ``paths`` says where the files of that type are. Records carry ``data_type``.
    """
    readers = {
        "json": lambda path, c: read_json(spark, path, c["mapping"], types, c.get("na_values")),
        "csv": lambda path, c: read_csv(spark, path, c["mapping"], c.get("delimiter") or ",",
                                        types, c.get("na_values")),
        "xml": lambda path, c: read_xml(spark, path, c["mapping"], row_tag, types,
                                        c.get("na_values")),
        "yaml": lambda path, c: read_yaml(spark, path, c["mapping"], types, c.get("na_values")),
        "filename": lambda path, c: read_file_names(spark, path, c["mapping"]),
    }
    unknown = set(index) - set(readers)
    if unknown:
        raise ValueError(f"no reader for data types {sorted(unknown)}")
    return union_records(*[
        readers[kind](paths[kind], config).withColumn("data_type", F.lit(kind))
        for kind, config in index.items()])


def yaml_records(df: DataFrame, text: str, mapping: Mapped, types: Mapped | None = None,
                 na_values: NaValues = None, keep: list[str] | None = None) -> DataFrame:
    """Records from a column of YAML text, one per document in it.

    Spark has no YAML reader: Arrow batches go through Python, which only rewrites each document
    as JSON; the mapping is applied in the JVM.
    """
    keep = list(keep or [])
    kept = df.select(*keep, F.col(text).alias("_yaml"))
    out = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1]],
                     "_json string"])
    as_json = kept.mapInPandas(_yaml_to_json, f"{out}, _error string")
    return json_records(as_json, F.col("_json"), mapping, types, na_values, keep)


def yaml_rejects(df: DataFrame, text: str, keep: list[str] | None = None) -> DataFrame:
    """The texts that are not YAML throughout, with the ``reason``; documents before the fault
    count."""
    keep = list(keep or [])
    kept = df.select(*keep, F.col(text).alias("_yaml"))
    out = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1]],
                     "_json string, _error string"])
    return kept.mapInPandas(_yaml_to_json, out).where("_error is not null").select(
        *keep, F.col("_error").alias("reason"))


def _yaml_to_json(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per document as JSON, or per text that cannot be read further with the error."""
    for batch in batches:
        found = batch.pop("_yaml").map(lambda text: list(yaml_documents(text)), na_action="ignore")
        out = batch.assign(_found=found).explode("_found", ignore_index=True)
        pairs = [f if isinstance(f, tuple) else (None, None) for f in out.pop("_found")]
        yield out.assign(_json=[p[0] for p in pairs], _error=[p[1] for p in pairs])


def _records(df: DataFrame, mapping: Mapped, types: Mapped | None,
             na_values: NaValues) -> DataFrame:
    source = df.withColumn("_file", F.col("_metadata.file_path"))
    fields = struct_fields(df.schema, mapping, types, na_values)
    return records(source, fields, keep=["_file"]).withColumnRenamed("_file", "file")
