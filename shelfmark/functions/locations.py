"""Data locations (URLs), source names and source ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark import fixed

# Location forms.
TRANSFER_SCHEME = "globus"
TRANSFER_WEB_HOST = "www.globus.org"
TRANSFER_WEB_PATH = "/app/transfer"
SOURCE_ID = r"^(_test_)?(.*)_v([0-9]+)[.]([0-9]+)$"

# Parts of a location as RFC 3986 (appendix B) splits them. Unlike ``parse_url`` this takes
# locations with blanks, which file paths have.
_URI = (r"^([A-Za-z][A-Za-z0-9+.-]*):(?://(?:[^@/?#]*@)?([^:/?#]*)(?::[0-9]*)?)?"
        r"([^?#]*)(?:\?([^#]*))?(?:#.*)?$")


def scheme(url: Column) -> Column:
    return _part(url, 1)


def host(url: Column) -> Column:
    return _part(url, 2)


def path(url: Column) -> Column:
    return F.when(url.rlike(_URI), F.regexp_extract(url, _URI, 3))


def _part(url: Column, group: int) -> Column:
    return F.nullif(F.regexp_extract(url, _URI, group), F.lit(""))


def _query(url: Column, key: str) -> Column:
    pair = rf"(?:^|&){key}=([^&]*)"
    value = F.nullif(F.regexp_extract(_part(url, 4), pair, 1), F.lit(""))
    return F.try_url_decode(value)


def is_web_app_link(url: Column) -> Column:
    """Whether the location is a link copied from the transfer web app, naming its endpoint."""
    return F.coalesce(
        (host(url) == TRANSFER_WEB_HOST) & (path(url) == TRANSFER_WEB_PATH)
        & _query(url, "origin_id").isNotNull(),
        F.lit(False))


def canonical(url: Column) -> Column:
    """A web-app link as ``globus://endpoint/path``; any other location unchanged."""
    target = F.concat(F.lit(f"{TRANSFER_SCHEME}://"), _query(url, "origin_id"),
                      F.coalesce(_query(url, "origin_path"), F.lit("/")))
    return F.when(is_web_app_link(url), target).otherwise(url)


def is_destination(url: Column) -> Column:
    """Whether data can be sent there: an endpoint location or a web-app link."""
    return F.coalesce(scheme(url) == TRANSFER_SCHEME, F.lit(False)) | is_web_app_link(url)


def is_http(url: Column) -> Column:
    """Whether the location is fetched over HTTP(S); a web-app link is not."""
    return (F.coalesce(F.lower(scheme(url)).isin("http", "https"), F.lit(False))
            & ~is_web_app_link(url))


def file_name(url: Column) -> Column:
    """The last part of the location, with its query and fragment."""
    return F.regexp_extract(url, "[^/]*$", 0)


def directory(url: Column) -> Column:
    """The location up to and including its last slash."""
    return F.regexp_extract(url, "^.*/", 0)


def clean_source_name(title: Column) -> Column:
    """A source name made from a title: lower case, every other run of characters one ``_``."""
    return F.btrim(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "_"), F.lit("_"))


def source_id(name: Column, version: Column, test: Column | None = None) -> Column:
    """``name_vN.1``, with the test prefix where ``test`` holds."""
    plain = F.concat(name, F.lit("_v"), version.cast("string"), F.lit(".1"))
    if test is None:
        return plain
    return F.when(test, F.concat(F.lit(fixed.TEST_PREFIX), plain)).otherwise(plain)


def source_id_parts(sid: Column) -> Column:
    """Struct ``test``, ``source_name``, ``major``, ``minor``; NULL when it is no source id."""
    part = lambda n: F.regexp_extract(sid, SOURCE_ID, n)
    return F.when(sid.rlike(SOURCE_ID), F.struct(
        (part(1) != "").alias("test"),
        part(2).alias("source_name"),
        part(3).try_cast("bigint").alias("major"),
        part(4).try_cast("bigint").alias("minor"),
    ))
