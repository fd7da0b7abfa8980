"""Records of files of every data type, each through the mapping of its own submission.

``files`` has columns ``submission_id``, ``data_type``, ``name`` and ``text``; ``index`` has one row
per submission and data type with its ``mapping`` (dotted target to source), ``delimiter`` and
``na_values``. As every submission maps to other fields, a ``record`` is JSON text, nested by the
dotted targets with its keys in order.

=========  =======================================  ============================================
data type  a record is                              a source is
=========  =======================================  ============================================
json       the document, or each one of a list      a dotted path
yaml       each document of the text                a dotted path
xml        the root element                         a dotted path; attributes as ``_name``
csv        each line below the header               a name in the header of that very file
filename   the file's name                          a pattern, by its first group if it has one
=========  =======================================  ============================================

A document is parsed once and its mapped values are taken from the parsed form. YAML and XML are
rewritten as JSON by a Python helper, as Spark has no reader for the former and guesses types for
the latter; all else stays in the JVM. Nothing is shuffled but for the join of files with their
mappings.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.functions.documents import json_problem, variant_path
from shelfmark.operators.extract import yaml_documents

TREES = ("json", "yaml", "xml")
KINDS = (*TREES, "csv", "filename")
KEY = ["submission_id", "data_type"]


def mapped_records(files: DataFrame, index: DataFrame) -> DataFrame:
    """``submission_id``, ``data_type``, ``name``, ``at`` (place of the record in its file, from
    0) and ``record``. Values that are missing are left out; a record without any is none."""
    rows = _documents(_indexed(files, index)).where("_error is null")
    # Through lists of one, so that the parse is not repeated wherever its result is used.
    parsed = rows.select("*", F.explode(F.array(F.when(
        F.col("data_type").isin(*TREES), F.try_parse_json("_json")))).alias("_parsed"))
    items = parsed.select(*KEY, "name", "mapping", "na_values", "_at", F.when(
        F.col("data_type") == "csv", csv_lines(F.col("text"), F.col("delimiter"))
    ).alias("_lines"), _list_of(F.col("_parsed")).alias("_trees"))
    width = F.when(F.col("data_type") == "csv", F.size("_lines") - 1).when(
        F.col("data_type") == "filename", 1).otherwise(F.size("_trees"))
    each = items.where(width > 0).withColumn("_n", F.explode(F.sequence(F.lit(0), width - 1)))
    values = each.select(*KEY, "name", (F.col("_at") + F.col("_n")).alias("at"),
                         F.explode(F.array(_values())).alias("_values"))
    return values.where(F.size("_values") > 0).select(
        *KEY, "name", "at", nested_json(F.map_entries("_values")).alias("record"))


def rejected_files(files: DataFrame, index: DataFrame) -> DataFrame:
    """The files that give no records, or not all, because they cannot be read: with a
    ``reason``."""
    rows = _documents(_indexed(files, index))
    problem = F.when(F.col("data_type") == "json", json_problem(F.col("text")))
    reason = F.coalesce("_error", F.when(problem.isin("malformed", "too large"), problem))
    return rows.select(*KEY, "name", reason.alias("reason")).where("reason is not null")


def index_problem(data_type: Column, mapping: Column) -> Column:
    """Why a mapping cannot be used: no records come of such a one; NULL if it can."""
    targets = F.map_keys(mapping)
    clash = F.exists(targets, lambda t: F.exists(
        targets, lambda other: F.startswith(other, F.concat(t, F.lit(".")))))
    names = F.flatten(F.transform(F.map_values(mapping), lambda s: F.split(s, "[.]")))
    odd = F.exists(names, lambda n: F.contains(n, F.lit("[")) & F.contains(n, F.lit("'"))
                   & F.contains(n, F.lit('"')))
    return (F.when(~data_type.isin(*KINDS), F.concat(F.lit("no reader for "), data_type))
            .when(clash, "a target is both a value and a block")
            .when(data_type.isin(*TREES) & odd, "a source name has a bracket and both quotes"))


def csv_lines(text: Column, delimiter: Column) -> Column:
    """The cells of each line, line ends and quotes as usual: a quoted cell may hold delimiters,
    line ends and doubled quotes. Blank lines are left out.

    The patterns repeat without backtracking, so that cells may have any length.
    """
    sep = F.concat(F.lit(r"\Q"), delimiter, F.lit(r"\E"))
    quoted = r'"(?:[^"]++|"")*+"'
    line = F.concat(F.lit(r"(?:(?:(?<![^\n])|(?<="), sep, F.lit(f")){quoted}(?="), sep,
                    F.lit(r'|\r?\n|\r?\z)|[^\n"]++|")++'))
    lines = F.transform(F.regexp_extract_all(text, line, F.lit(0)),
                        lambda x: F.regexp_replace(x, r"\r$", ""))
    cell = F.concat(F.lit(rf"({quoted}|[\s\S]*?)"), sep)
    doubled, is_quoted = F.lit('""'), r'(?s)^".*"$'
    return F.transform(
        F.filter(lines, lambda x: F.trim(x) != ""),
        lambda x: F.transform(
            F.regexp_extract_all(F.concat(x, delimiter), cell, F.lit(1)),
            lambda c: F.when((F.length(c) > 1) & c.rlike(is_quoted), F.replace(
                F.substr(c, F.lit(2), F.length(c) - 2), doubled, F.lit('"'))).otherwise(c)))


def nested_json(entries: Column) -> Column:
    """JSON text from entries of dotted ``key`` and text ``value``, nested and in key order."""
    paths = F.array_sort(F.transform(entries, lambda e: F.struct(
        F.split(e["key"], "[.]").alias("path"), e["value"].alias("value"))))

    def parents(path: Column) -> Column:
        return F.slice(path, 1, F.size(path) - 1)

    def fragment(entry: Column, at: Column) -> Column:
        """What an entry adds: it closes blocks of the one before, then opens its own."""
        old = F.coalesce(parents(F.get(paths, at - 1)["path"]), F.array().cast("array<string>"))
        new = parents(entry["path"])
        same = F.zip_with(old, new, lambda a, b: F.coalesce(a == b, F.lit(False)))
        first = F.array_position(same, F.lit(False))
        kept = F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")
        close = F.when(at == 0, "{").otherwise(
            F.concat(F.repeat(F.lit("}"), F.size(old) - kept), F.lit(",")))
        opened = F.transform(F.slice(new, kept + 1, F.size(new)),
                             lambda name: F.concat(json_text(name), F.lit(":{")))
        return F.concat(close, F.array_join(opened, ""), json_text(F.element_at(entry["path"], -1)),
                        F.lit(":"), json_text(entry["value"]))
    depth = F.size(F.element_at(paths, -1)["path"])
    return F.concat(F.array_join(F.transform(paths, fragment), ""),
                    F.repeat(F.lit("}"), depth))


def json_text(text: Column) -> Column:
    """A text as JSON writes it."""
    listed = F.to_json(F.array(text))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def _indexed(files: DataFrame, index: DataFrame) -> DataFrame:
    usable = index.where(index_problem(F.col("data_type"), F.col("mapping")).isNull()).select(
        *KEY, "mapping", F.coalesce("delimiter", F.lit(",")).alias("delimiter"),
        F.coalesce("na_values", F.when(F.col("data_type") == "csv", F.array(
            *map(F.lit, fixed.TABULAR_NA_VALUES))).otherwise(F.array().cast("array<string>")))
        .alias("na_values"))
    return files.select(*KEY, "name", "text").join(usable, KEY)


def _documents(rows: DataFrame) -> DataFrame:
    """The rows with their documents as JSON text ``_json``, those before it in the file counted
    in ``_at``, or an ``_error``."""
    foreign = rows.where(F.col("data_type").isin("yaml", "xml"))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    made = foreign.mapInPandas(_as_json, f"{out}, _at int, _json string, _error string")
    own = rows.where(~F.col("data_type").isin("yaml", "xml")).select(
        "*", F.lit(0).alias("_at"), F.col("text").alias("_json"),
        F.lit(None).cast("string").alias("_error"))
    return own.unionByName(made)


def _as_json(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def found(kind: str, text: str | None) -> list[tuple]:
        documents = yaml_documents(text) if kind == "yaml" else _xml_documents(text)
        return [(at, *d) for at, d in enumerate(documents)] if text is not None else []
    for batch in batches:
        rows = [found(k, t) for k, t in zip(batch["data_type"], batch["text"], strict=True)]
        out = batch.assign(_found=rows).explode("_found", ignore_index=True)
        out = out[out["_found"].notna()]
        triples = list(out.pop("_found"))
        yield out.assign(_at=[t[0] for t in triples], _json=[t[1] for t in triples],
                         _error=[t[2] for t in triples])


def _xml_documents(text: str) -> Iterator[tuple[str | None, str | None]]:
    """The root element as JSON, all leaves as text; a repeated element is a list."""
    def plain(element):
        fields: dict = {f"_{k}": v for k, v in element.attrib.items()}
        for child in element:
            name = child.tag.rpartition("}")[2]
            fields.setdefault(name, []).append(plain(child))
        fields = {k: v[0] if isinstance(v, list) and len(v) == 1 else v for k, v in fields.items()}
        own = (element.text or "").strip()
        if not fields:
            return own
        return fields | ({"_VALUE": own} if own else {})
    try:
        yield json.dumps(plain(ElementTree.fromstring(text))), None
    except (ElementTree.ParseError, ValueError, RecursionError) as error:
        yield None, f"{type(error).__name__}: {error}"[:500]


def _list_of(tree: Column) -> Column:
    """The documents of a file: the items of a list, or the one there is."""
    is_list = F.startswith(F.schema_of_variant(tree), F.lit("ARRAY"))
    return F.when(tree.isNotNull(), F.when(
        is_list, F.try_variant_get(tree, "$", "array<variant>")).otherwise(F.array(tree)))


def _values() -> Column:
    """The mapped values of a row's ``_n``-th record, by target."""
    kind = F.col("data_type")
    header, cells = F.get("_lines", F.lit(0)), F.get("_lines", F.col("_n") + 1)
    tree = F.get("_trees", F.col("_n"))
    bare = lambda p: reduce(lambda s, pattern: F.regexp_replace(s, pattern, ""),
                            [r"\\.", r"\[[^\]]*\]"], p)
    group = lambda p: F.when(bare(p).rlike(r"\((?!\?)|\(\?<[A-Za-z]"), 1).otherwise(0)
    cell = lambda s: F.get(cells, F.array_position(header, s).cast("int") - 1)
    found = F.transform_values("mapping", lambda _, source: F.when(
        kind == "csv", cell(source)).when(kind == "filename", F.call_function(
            "nullif", F.call_function("regexp_extract", F.col("name"), source, group(source)),
            F.lit(""))).otherwise(F.try_variant_get(tree, variant_path(source), "string")))
    return F.map_filter(found, lambda _, v: v.isNotNull() & ~F.array_contains("na_values", v))
