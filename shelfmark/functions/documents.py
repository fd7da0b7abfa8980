"""Nested values: lists from scalars, JSON checks, sorted keys, merged blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# A text that the JSON parser refuses may be valid if it is longer than this.
PARSER_BYTES = 16 * 1024 * 1024


def absent_if_empty(col: Column) -> Column:
    """NULL in place of an empty array or map, so that JSON leaves the field out."""
    return F.when(F.size(col) > 0, col)


def absent_if_blank(col: Column) -> Column:
    """NULL in place of empty text."""
    return F.nullif(col, F.lit(""))


def as_list(col: Column, data_type: T.DataType) -> Column:
    """A list column as it is, any other as a list of one; NULL gives an empty list."""
    if isinstance(data_type, T.ArrayType):
        empty = F.array().cast(data_type)
        return F.coalesce(col, empty)
    return F.when(col.isNull(), F.array().cast(T.ArrayType(data_type))).otherwise(F.array(col))


def json_as_list(text: Column) -> Column:
    """A JSON value as a list of texts: its items, or the one scalar it is."""
    value = F.try_parse_json(text)
    items = F.try_variant_get(value, "$", "array<string>")
    return (F.when(F.schema_of_variant(value).startswith("ARRAY"), items)
            .when(F.is_variant_null(value), F.array().cast("array<string>"))
            .when(value.isNotNull(), F.array(F.try_variant_get(value, "$", "string"))))


def variant_path(source: Column) -> Column:
    """The path of a dotted name in a parsed document. Names may hold any character, but for a
    bracket together with both kinds of quotes: such a path is NULL."""
    def step(name: Column) -> Column:
        plain = (name != "") & ~F.contains(name, F.lit("["))
        return (F.when(plain, F.concat(F.lit("."), name))
                .when(~F.contains(name, F.lit("'")), F.concat(F.lit("['"), name, F.lit("']")))
                .when(~F.contains(name, F.lit('"')), F.concat(F.lit('["'), name, F.lit('"]'))))
    steps = F.transform(F.split(source, "[.]"), step)
    return F.when(~F.exists(steps, lambda s: s.isNull()),
                  F.concat(F.lit("$"), F.array_join(steps, "")))


def is_finite_number(number: Column) -> Column:
    """Whether a number is neither NaN nor infinite; a missing one passes."""
    return F.coalesce(~F.isnan(number) & (F.abs(number) != float("inf")), F.lit(True))


def json_problem(text: Column) -> Column:
    """Why a text is no JSON to work with: ``malformed``, ``too large`` or ``not finite``; NULL if
    it is, or is missing.

    The parser refuses the words ``NaN`` and ``Infinity`` itself. Numbers that overflow, such as
    ``1e400``, are looked for among the number tokens outside of strings. A text beyond the
    parser's limit is not taken for a malformed one.
    """
    no_escapes = F.regexp_replace(text, r"(?s)\\.", "")
    bare = F.regexp_replace(no_escapes, '"[^"]*"', "")
    numbers = F.regexp_extract_all(bare, F.lit(r"-?[0-9][0-9.eE+-]*"), F.lit(0))
    infinite = F.exists(numbers, lambda n: F.abs(n.try_cast("double")) == float("inf"))
    unread = F.when(F.octet_length(text) > PARSER_BYTES, F.lit("too large")).otherwise(
        F.lit("malformed"))
    return (F.when(text.isNull(), F.lit(None).cast("string"))
            .when(F.try_parse_json(text).isNull(), unread)
            .when(F.coalesce(infinite, F.lit(False)), F.lit("not finite")))


def is_finite_json(text: Column) -> Column:
    """Whether the text is JSON without NaN or infinite numbers; a missing one passes."""
    return json_problem(text).isNull()


def parsed_values(col: Column) -> Column:
    """A map of JSON texts as a map of values, so that ``to_json`` nests them."""
    return F.transform_values(col, lambda _, v: F.try_parse_json(v))


def sorted_keys(col: Column, data_type: T.DataType) -> Column:
    """The same value with struct fields and map keys in name order, at every depth."""
    if isinstance(data_type, T.StructType):
        fields = [sorted_keys(col[f.name], f.dataType).alias(f.name)
                  for f in sorted(data_type.fields, key=lambda f: f.name)]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.ArrayType) and _has_keys(data_type.elementType):
        return F.transform(col, lambda x: sorted_keys(x, data_type.elementType))
    if isinstance(data_type, T.MapType):
        entries = F.array_sort(F.map_entries(
            F.transform_values(col, lambda _, v: sorted_keys(v, data_type.valueType))
            if _has_keys(data_type.valueType) else col),
            lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        return F.map_from_entries(entries)
    return col


def _has_keys(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _has_keys(data_type.elementType)
    return isinstance(data_type, (T.StructType, T.MapType))


def canonical_json(schema: T.StructType, columns: list[str],
                   open_columns: Sequence[str] = ()) -> Column:
    """JSON of the given columns with all keys sorted.

    ``open_columns`` hold JSON text, or maps or lists of it; parsed documents keep their keys in
    order, so that these are sorted at every depth, too. A text that is no JSON is left out.
    """
    def value(name: str) -> Column:
        kind = schema[name].dataType
        if name not in open_columns:
            return sorted_keys(F.col(name), kind)
        if isinstance(kind, T.MapType):
            return parsed_values(sorted_keys(F.col(name), kind))
        if isinstance(kind, T.ArrayType):
            return F.transform(name, lambda text: F.try_parse_json(text))
        return F.try_parse_json(name)
    fields = [value(name).alias(name) for name in sorted(columns)]
    return F.to_json(F.struct(*fields))


def merge_maps(base: Column, extra: Column) -> Column:
    """Entries of both maps; where both have a key the base keeps its value."""
    new = F.map_filter(extra, lambda k, _: ~F.map_contains_key(base, k))
    return F.when(extra.isNull(), base).when(base.isNull(), extra).otherwise(
        F.map_concat(base, new))


def merge_blocks(base: Column, base_type: T.StructType,
                 extra: Column, extra_type: T.StructType) -> Column:
    """Fields of both structs; nested structs merge in turn, otherwise the base wins."""
    extra_fields = {f.name: f.dataType for f in extra_type.fields}
    merged = []
    for field in base_type.fields:
        mine, other = base[field.name], extra_fields.pop(field.name, None)
        if isinstance(field.dataType, T.StructType) and isinstance(other, T.StructType):
            value = merge_blocks(mine, field.dataType, extra[field.name], other)
        elif other is not None:
            value = F.coalesce(mine, extra[field.name])
        else:
            value = mine
        merged.append(value.alias(field.name))
    merged += [extra[name].alias(name) for name in extra_fields]
    return F.struct(*merged)


def with_descriptions(custom: Column, descriptions: Column) -> Column:
    """Custom values with ``<field>_desc`` entries added; a new description replaces an old one."""
    named = F.transform_keys(descriptions, lambda k, _: F.concat(k, F.lit("_desc")))
    return merge_maps(named, custom)
