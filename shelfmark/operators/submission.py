"""Submissions put together from their blocks, and where they are sent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import fixed
from shelfmark.functions import locations
from shelfmark.functions.documents import absent_if_blank, absent_if_empty, parsed_values
from shelfmark.schema import DC, INDEX, PLACEMENT

_TEXTS = T.ArrayType(T.StringType())
_TEXT_MAP = T.MapType(T.StringType(), T.StringType())

# The blocks of a submission in their order, with the type of an absent column.
BLOCKS: dict[str, T.DataType] = {
    "dc": DC,
    "data_sources": _TEXTS,
    "test": T.BooleanType(),
    "update": T.BooleanType(),
    "placement": PLACEMENT,
    "mrr": T.StringType(),
    "custom": _TEXT_MAP,
    "projects": _TEXT_MAP,
    "data_destinations": _TEXTS,
    "external_uri": T.StringType(),
    "index": INDEX,
    "extraction_config": T.StringType(),
    "services": _TEXT_MAP,
    "tags": _TEXTS,
    "curation": T.BooleanType(),
    "no_extract": T.BooleanType(),
    "dataset_acl": _TEXTS,
    "update_metadata_only": T.BooleanType(),
}
_FLAGS_ALWAYS_SENT = {"test", "update", "update_metadata_only"}
# Blocks that are free JSON texts.
_JSON_TEXTS = {"mrr", "extraction_config"}


def assemble(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per submission with every block in order, absent where empty.

    Columns the input lacks count as absent; ``dc`` may also be JSON text, and ``index`` a map of
    JSON texts like ``custom``, ``projects`` and ``services``. ``dc``, ``data_sources``, ``test``, ``update``,
    ``placement`` (name, organization, access) and ``update_metadata_only`` are always present.
    """
    return df.select(*keep, *[_block(df, name, kind).alias(name) for name, kind in BLOCKS.items()])


def submission_json(submissions: DataFrame, placement_name: str = "placement") -> Column:
    """JSON of assembled submissions, or of the blocks left of them.

    ``placement_name`` is the JSON name of the ``placement`` block.
    """
    fields = []
    for name in submissions.columns:
        if name not in BLOCKS:
            continue
        col, kind = F.col(name), submissions.schema[name].dataType
        if name in _JSON_TEXTS or (name == "dc" and isinstance(kind, T.StringType)):
            col = F.try_parse_json(col)
        elif isinstance(kind, T.MapType) and isinstance(kind.valueType, T.StringType):
            col = parsed_values(col)
        fields.append(col.alias(placement_name if name == "placement" else name))
    return F.to_json(F.struct(*fields))


def metadata_update(submissions: DataFrame) -> DataFrame:
    """Only the blocks a metadata update carries."""
    return submissions.drop(*fixed.NOT_IN_METADATA_UPDATE)


def service_routes(submissions: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row ``service``, ``parameters`` per service; ``false`` cancels it.

    A service without parameters gets ``true``.
    """
    given = F.transform_values("services", lambda _, v: F.coalesce(v, F.lit("true")))
    wanted = F.map_filter(given, lambda _, v: v != "false")
    return submissions.select(*keep, F.explode(wanted).alias("service", "parameters"))


def route_tests(submissions: DataFrame, live_index: str, test_index: str) -> DataFrame:
    """Adds ``routed_id``, ``search_index`` and ``public``, which tests never are.

    ``public`` keeps the value of a column of that name and is true by default.
    """
    test = F.col("test")
    prefixed = F.concat(F.lit(fixed.TEST_PREFIX), F.col("source_id"))
    asked = F.col("public") if "public" in submissions.columns else F.lit(None).cast("boolean")
    return submissions.withColumns({
        "routed_id": F.when(test, prefixed).otherwise(F.col("source_id")),
        "search_index": F.when(test, F.lit(test_index)).otherwise(F.lit(live_index)),
        "public": F.when(test, F.lit(False)).otherwise(F.coalesce(asked, F.lit(True))),
    })


def manifest(submissions: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    """One row per location of a list of data sources or destinations, counted from 0.

    Web-app links are resolved into ``location``; ``scheme``, ``host`` and ``path`` are its parts.
    """
    rows = submissions.select(*keep, F.posexplode(column).alias("pos", "url"))
    rows = rows.withColumn("location", locations.canonical(F.col("url")))
    return rows.select(*keep, "pos", "location",
                       locations.scheme(F.col("location")).alias("scheme"),
                       locations.host(F.col("location")).alias("host"),
                       locations.path(F.col("location")).alias("path"))


def _block(df: DataFrame, name: str, kind: T.DataType) -> Column:
    has = name in df.columns
    col = F.col(name) if has else F.lit(None).cast(kind)
    if name in _FLAGS_ALWAYS_SENT:
        return F.coalesce(col, F.lit(False))
    if isinstance(kind, T.BooleanType):
        return F.when(col, col)
    if name == "dc" and has and isinstance(df.schema[name].dataType, T.StringType):
        return F.coalesce(col, F.lit("{}"))
    if isinstance(kind, T.StructType):
        # A struct of nothing is written as {} where a NULL one would be left out.
        fields = df.schema[name].dataType if has else kind
        nothing = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
        return F.coalesce(col, nothing)
    if name == "data_sources":
        return F.coalesce(col, F.array().cast(kind))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return absent_if_empty(col)
    if name in _JSON_TEXTS:
        return F.when(~F.regexp_replace(col, r"\s", "").isin("", "{}", "[]", "null"), col)
    return absent_if_blank(col)
