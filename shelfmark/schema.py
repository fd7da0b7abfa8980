"""Schemas of the catalog's tables and nested blocks."""

from pyspark.sql import types as T

_text = T.StringType()


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _text) for n in names])


LINK = _texts("type", "doi", "url", "description", "bibtex")

DC = T.StructType([
    T.StructField("titles", T.ArrayType(_texts("title"))),
    T.StructField("creators", T.ArrayType(T.StructType([
        T.StructField("creatorName", _text),
        T.StructField("familyName", _text),
        T.StructField("givenName", _text),
        T.StructField("affiliations", T.ArrayType(_text)),
    ]))),
    T.StructField("publisher", _text),
    T.StructField("publicationYear", _text),
    T.StructField("resourceType", _texts("resourceTypeGeneral", "resourceType")),
    T.StructField("descriptions", T.ArrayType(_texts("description", "descriptionType"))),
    T.StructField("identifier", _texts("identifier", "identifierType")),
    T.StructField("relatedIdentifiers", T.ArrayType(
        _texts("relatedIdentifier", "relatedIdentifierType", "relationType"))),
    T.StructField("subjects", T.ArrayType(_texts("subject"))),
])

# organization, name and access of a submission
PLACEMENT = T.StructType([
    T.StructField("organization", _text),
    T.StructField("links", T.ArrayType(LINK)),
    T.StructField("acl", T.ArrayType(_text)),
    T.StructField("source_name", _text),
])

INDEX = T.MapType(_text, T.StructType([
    T.StructField("mapping", T.MapType(_text, _text)),
    T.StructField("delimiter", _text),
    T.StructField("na_values", T.ArrayType(_text)),
]))

STATUS = T.StructType([
    T.StructField("source_id", _text),
    T.StructField("owner", T.LongType()),
    T.StructField("active", T.BooleanType()),
    T.StructField("test", T.BooleanType()),
    T.StructField("status_code", _text),
    T.StructField("status_message", _text),
    T.StructField("submission_time", T.TimestampNTZType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", _text),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", _text),
])
