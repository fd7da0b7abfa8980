"""The citation block, built from flat input columns.

Each function takes and returns Columns; ``dc_block`` puts them together. Missing or empty
optional input gives NULL, which JSON leaves out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import fixed
from shelfmark.functions.documents import (
    absent_if_blank, absent_if_empty, as_list, merge_blocks)
from shelfmark.functions.names import creator_name, split_names
from shelfmark.schema import DC

_TEXTS = T.ArrayType(T.StringType())


def titles(texts: Column) -> Column:
    return F.transform(texts, lambda t: F.struct(t.alias("title")))


def affiliation_lists(data_type: T.DataType, col: Column) -> Column:
    """Affiliations of any accepted shape as a list of lists."""
    if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.ArrayType):
        return F.coalesce(F.transform(col, lambda a: F.coalesce(a, _no_texts())),
                          F.array().cast(T.ArrayType(_TEXTS)))
    # A blank one stays as an empty list, so that the others keep their places.
    if isinstance(data_type, T.StringType):
        col = absent_if_blank(col)
    return F.transform(as_list(col, data_type),
                       lambda a: F.filter(F.array(a), lambda t: F.coalesce(t, F.lit("")) != ""))


def align_affiliations(authors: Column, affiliations: Column) -> Column:
    """One list of affiliations per author.

    As many lists as authors go to them in order; any other number goes to every author whole.
    """
    everything = F.flatten(affiliations)
    return F.when(F.size(authors) == F.size(affiliations), affiliations).otherwise(
        F.transform(authors, lambda _: everything))


def creators(authors: Column, affiliations: Column) -> Column:
    """Creator structs from a list of authors and a list of affiliation lists."""
    pairs = F.arrays_zip(split_names(authors).alias("name"),
                         align_affiliations(authors, affiliations).alias("places"))
    return F.transform(pairs, lambda p: F.struct(
        creator_name(p["name"]["family"], p["name"]["given"]).alias("creatorName"),
        p["name"]["family"].alias("familyName"),
        p["name"]["given"].alias("givenName"),
        absent_if_empty(p["places"]).alias("affiliations"),
    ))


def publisher(col: Column, default: str) -> Column:
    return F.coalesce(absent_if_blank(col), F.lit(default))


def publication_year(col: Column, data_type: T.DataType, as_of_year: int) -> Column:
    """The year as integer text; what is no integer becomes the year of the run.

    Numbers lose their fraction. Text may have blanks around it, a sign, and single underscores
    between digits.
    """
    if isinstance(data_type, T.StringType):
        is_integer = col.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$")
        col = F.when(is_integer, F.regexp_replace(col, r"[\s_]", ""))
    return F.coalesce(col.try_cast("bigint").cast("string"), F.lit(str(as_of_year)))


def resource_type(col: Column) -> Column:
    """The general type never changes, the specific one may be given."""
    return F.struct(
        F.lit(fixed.RESOURCE_TYPE).alias("resourceTypeGeneral"),
        F.coalesce(absent_if_blank(col), F.lit(fixed.RESOURCE_TYPE)).alias("resourceType"))


def descriptions(col: Column) -> Column:
    return F.when(col != "", F.array(F.struct(
        col.alias("description"), F.lit(fixed.DESCRIPTION_TYPE).alias("descriptionType"))))


def identifier(doi: Column) -> Column:
    return F.when(doi != "", F.struct(
        doi.alias("identifier"), F.lit(fixed.IDENTIFIER_TYPE).alias("identifierType")))


def related_identifiers(dois: Column) -> Column:
    return absent_if_empty(F.transform(dois, lambda doi: F.struct(
        doi.alias("relatedIdentifier"),
        F.lit(fixed.IDENTIFIER_TYPE).alias("relatedIdentifierType"),
        F.lit(fixed.RELATION_TYPE).alias("relationType"))))


def subjects(texts: Column) -> Column:
    return absent_if_empty(F.transform(texts, lambda s: F.struct(s.alias("subject"))))


def dc_block(schema: T.StructType, fields: Mapping[str, str], default_publisher: str,
             as_of_year: int, extra: str | None = None) -> Column:
    """The whole block as a struct.

    ``fields`` names the input column of each argument: ``title`` and ``authors``, optionally
    ``affiliations``, ``publisher``, ``publication_year``, ``resource_type``, ``description``,
    ``dataset_doi``, ``related_dois`` and ``subjects``. Where lists are allowed, a column may
    hold a list or a single text. ``extra`` may name a struct column of further citation fields:
    they are added, nested blocks field by field, and never replace what the block has.
    """
    unknown = set(fields) - _ARGUMENTS
    if unknown:
        raise ValueError(f"unknown arguments {sorted(unknown)}")
    if not {"title", "authors"} <= set(fields):
        raise ValueError("title and authors are required")

    def kind(argument: str) -> T.DataType:
        return schema[fields[argument]].dataType if argument in fields else T.StringType()

    def given(argument: str) -> Column:
        return F.col(fields[argument]) if argument in fields else F.lit(None).cast("string")

    def listed(argument: str) -> Column:
        col = given(argument)
        if isinstance(kind(argument), T.StringType):
            col = absent_if_blank(col)
        return as_list(col, kind(argument))

    block = F.struct(
        titles(listed("title")).alias("titles"),
        creators(listed("authors"),
                 affiliation_lists(kind("affiliations"), given("affiliations"))).alias("creators"),
        publisher(given("publisher"), default_publisher).alias("publisher"),
        publication_year(given("publication_year"), kind("publication_year"), as_of_year)
        .alias("publicationYear"),
        resource_type(given("resource_type")).alias("resourceType"),
        descriptions(given("description")).alias("descriptions"),
        identifier(given("dataset_doi")).alias("identifier"),
        related_identifiers(listed("related_dois")).alias("relatedIdentifiers"),
        subjects(listed("subjects")).alias("subjects"),
    )
    return block if extra is None else merge_blocks(block, DC, F.col(extra),
                                                    schema[extra].dataType)


def with_dc_block(df: DataFrame, fields: Mapping[str, str], default_publisher: str,
                  as_of_year: int, out: str = "dc", extra: str | None = None) -> DataFrame:
    """Adds the block as a column."""
    return df.withColumn(out, dc_block(df.schema, fields, default_publisher, as_of_year, extra))


def tags_and_subjects(dc: Column, tags: Column) -> Column:
    """Subjects of the block and separately added tags, each text once."""
    texts = F.transform(dc["subjects"], lambda s: s["subject"])
    return F.array_union(F.coalesce(texts, _no_texts()), F.coalesce(tags, _no_texts()))


def _no_texts() -> Column:
    return F.array().cast(_TEXTS)


_ARGUMENTS = {"title", "authors", "affiliations", "publisher", "publication_year",
              "resource_type", "description", "dataset_doi", "related_dois", "subjects"}
