"""Records from mapped fields: dotted targets, missing values, unions, directories."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import fixed
from shelfmark.functions.documents import json_problem, variant_path
from shelfmark.functions.locations import directory

NaValues = str | Sequence[str] | None


def without_na(col: Column, na_values: NaValues) -> Column:
    """NULL in place of the values that stand for missing data."""
    values = [na_values] if isinstance(na_values, str) else list(na_values or [])
    return F.when(~col.isin(values), col) if values else col


def tabular_na(na_values: NaValues) -> NaValues:
    """Delimited data takes blank and space as missing unless told otherwise."""
    return fixed.TABULAR_NA_VALUES if na_values is None else na_values


def json_records(df: DataFrame, document: Column, mapping: Mapping[str, str],
                 types: Mapping[str, str] | None = None, na_values: NaValues = None,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Records from dotted paths in JSON text."""
    parsed = _parsed_once(df, F.try_parse_json(document), keep)
    return records(parsed, {
        target: _value(F.try_variant_get("_parsed", variant_path(F.lit(source)), "string"), target,
                       types, na_values) for target, source in mapping.items()}, keep)


def json_rejects(df: DataFrame, document: Column, keep: Sequence[str] = ()) -> DataFrame:
    """The rows whose document gives no record because it cannot be read, with the ``reason``."""
    found = df.select(*keep, json_problem(document).alias("reason"))
    return found.where(F.col("reason").isin("malformed", "too large"))


def csv_records(df: DataFrame, line: Column, header: Sequence[str], mapping: Mapping[str, str],
                delimiter: str = ",", types: Mapping[str, str] | None = None,
                na_values: NaValues = None, keep: Sequence[str] = ()) -> DataFrame:
    """Records from named cells of delimited text."""
    cells = ", ".join(f"`{name}` string" for name in header)
    parsed = _parsed_once(df, F.from_csv(line, cells, {"sep": delimiter, "escape": '"'}), keep)
    return _struct_records(parsed, mapping, types, tabular_na(na_values), keep)


def xml_records(df: DataFrame, document: Column, mapping: Mapping[str, str],
                types: Mapping[str, str] | None = None, na_values: NaValues = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """Records from dotted element paths in XML text."""
    row = F.from_xml(document, nested_schema(list(mapping.values())).simpleString())
    return _struct_records(_parsed_once(df, row, keep), mapping, types, na_values, keep)


def name_records(df: DataFrame, name: Column, patterns: Mapping[str, str],
                 keep: Sequence[str] = ()) -> DataFrame:
    """Records from a name by regular expressions, by their first group if they have one."""
    groups = {f"_g{n}": F.regexp_extract(name, pattern, min(1, re.compile(pattern).groups))
              for n, pattern in enumerate(patterns.values())}
    parsed = _parsed_once(df, F.struct(*[c.alias(g) for g, c in groups.items()]), keep)
    return records(parsed, {target: F.nullif(F.col(f"_parsed.{g}"), F.lit(""))
                            for target, g in zip(patterns, groups)}, keep)


def struct_fields(schema: T.StructType, mapping: Mapping[str, str],
                  types: Mapping[str, str] | None = None,
                  na_values: NaValues = None) -> dict[str, Column]:
    """Target fields read from columns or nested fields; those the schema lacks are NULL."""
    return {target: _value(_column_or_null(schema, source), target, types, na_values)
            for target, source in mapping.items()}


def nested_schema(paths: Sequence[str]) -> T.StructType:
    """The struct type with a text leaf at each dotted path, for readers to take only those."""
    tree: dict = {}
    for path in paths:
        reduce(lambda node, name: node.setdefault(name, {}), path.split("."), tree)
    return _tree_type(tree)


def nested(fields: Mapping[str, Column]) -> list[Column]:
    """Columns nested by their dotted names; a struct without any value is NULL."""
    for path in fields:
        if any(other.startswith(f"{path}.") for other in fields):
            raise ValueError(f"field {path!r} is both a value and a block")
    tree: dict = {}
    for path, col in fields.items():
        *parents, leaf = path.split(".")
        reduce(lambda node, name: node.setdefault(name, {}), parents, tree)[leaf] = col
    return [_tree_column(node).alias(name) for name, node in tree.items()]


def records(df: DataFrame, fields: Mapping[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """Nested records of the mapped fields; rows in which none has a value are no records."""
    flat = {path: f"_f{n}" for n, path in enumerate(fields)}
    has_value = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in flat.values()])
    return (df.select(*keep, *[fields[path].alias(c) for path, c in flat.items()])
            .where(has_value)
            .select(*keep, *nested({path: F.col(c) for path, c in flat.items()})))


def extractable(submissions: DataFrame) -> DataFrame:
    """Submissions whose files are extracted, those not passed through."""
    return submissions.where(~F.coalesce(F.col("no_extract"), F.lit(False)))


def union_records(*tables: DataFrame) -> DataFrame:
    """Records of several data types together, with fields one of them lacks left NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def group_by_directory(files: DataFrame, location: str, fields: Sequence[str]) -> DataFrame:
    """One record per directory: each field from the first file, by name, that has it.

    Also ``n_files``, ``first_file`` and ``last_file``. Partial results are combined before the
    shuffle, so a directory may hold any number of files.
    """
    merged = [F.min_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(location))).alias(f)
              for f in fields]
    return (files.groupBy(directory(F.col(location)).alias("directory"))
            .agg(F.count("*").alias("n_files"), F.min(location).alias("first_file"),
                 F.max(location).alias("last_file"), *merged))


def yaml_documents(text: str) -> Iterator[tuple[str | None, str | None]]:
    """Each document of a YAML text as JSON, or the error that keeps the rest from being read."""
    import yaml

    loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

    def plain(value):
        """Keys as texts and numbers that JSON lacks as null, so that the rest is kept."""
        if isinstance(value, dict):
            return {k if isinstance(k, str) else str(k): plain(v) for k, v in value.items()}
        if isinstance(value, (list, tuple, set)):
            return [plain(v) for v in value]
        if isinstance(value, float) and not math.isfinite(value):
            return None
        return value
    try:
        for document in yaml.load_all(text, loader):
            yield json.dumps(plain(document), default=str), None
    except (yaml.YAMLError, ValueError, RecursionError) as error:
        yield None, f"{type(error).__name__}: {error}"[:500]


def _parsed_once(df: DataFrame, value: Column, keep: Sequence[str]) -> DataFrame:
    """The value as column ``_parsed``, computed once per row.

    It goes through a list of one, as an optimizer would otherwise repeat the parsing wherever
    the column is used, in the filter and for every field.
    """
    return df.select(*keep, F.explode(F.array(value)).alias("_parsed"))


def _struct_records(parsed: DataFrame, mapping, types, na_values, keep) -> DataFrame:
    paths = {target: f"_parsed.{source}" for target, source in mapping.items()}
    return records(parsed, struct_fields(parsed.schema, paths, types, na_values), keep)


def _value(col: Column, target: str, types: Mapping[str, str] | None,
           na_values: NaValues) -> Column:
    col = without_na(col, na_values)
    return col.try_cast(types[target]) if types and target in types else col


def _column_or_null(schema: T.StructType, source: str) -> Column:
    col, kind = None, schema
    for name in source.split("."):
        if not isinstance(kind, T.StructType) or name not in kind.names:
            return F.lit(None).cast("string")
        col = F.col(f"`{name}`") if col is None else col[name]
        kind = kind[name].dataType
    return F.to_json(col) if isinstance(kind, T.StructType) else col


def _tree_type(tree: dict) -> T.StructType:
    return T.StructType([T.StructField(name, _tree_type(node) if node else T.StringType())
                         for name, node in tree.items()])


def _tree_column(node: dict | Column) -> Column:
    if isinstance(node, Column):
        return node
    children = {name: _tree_column(child) for name, child in node.items()}
    has_value = reduce(lambda a, b: a | b, [c.isNotNull() for c in children.values()])
    return F.when(has_value, F.struct(*[c.alias(name) for name, c in children.items()]))
