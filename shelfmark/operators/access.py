"""Who may see and curate submissions.

``acl`` is the base list (missing: public) and ``dataset_acl`` the list for the dataset entry
alone. Distinct lists are matched against a table of principals entry by entry, as an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.functions.documents import absent_if_empty


def base_acl(acl: Column) -> Column:
    """The base list, public where none is set."""
    return F.coalesce(absent_if_empty(acl), F.array(F.lit(fixed.PUBLIC)))


def effective_acl(acl: Column, dataset_acl: Column) -> Column:
    """Everyone who may see the dataset entry."""
    return F.array_union(base_acl(acl),
                         F.coalesce(dataset_acl, F.array().cast("array<string>")))


def visible_entries(submissions: DataFrame, principals: DataFrame, key: str) -> DataFrame:
    """Keys of the dataset entries some principal may see."""
    acl = effective_acl(F.col("acl"), F.col("dataset_acl"))
    return _matching(submissions, acl, principals, key)


def visible_records(submissions: DataFrame, principals: DataFrame, key: str) -> DataFrame:
    """Keys of the submissions whose records and files some principal may see."""
    return _matching(submissions, base_acl(F.col("acl")), principals, key)


def curation_identities(memberships: DataFrame, requesters: DataFrame) -> DataFrame:
    """The requesters themselves and the groups they manage or administer."""
    leading = memberships.where(F.col("role").isin("manager", "admin"))
    groups = (leading.join(requesters.select("principal"), "principal", "left_semi")
              .select(F.col("group").alias("principal")))
    return requesters.select("principal").unionByName(groups).distinct()


def curatable(tasks: DataFrame, identities: DataFrame, key: str) -> DataFrame:
    """Keys of the tasks the identities may decide; anyone may decide a public one."""
    return _matching(tasks, base_acl(F.col("acl")), identities, key)


def not_public(tasks: DataFrame) -> DataFrame:
    """Tasks as they are listed: public ones are left out, though anyone may curate them."""
    return tasks.where(~_is_public(base_acl(F.col("acl"))))


def _is_public(acl: Column) -> Column:
    # A list with a NULL in it would make the plain test NULL.
    return F.coalesce(F.array_contains(acl, fixed.PUBLIC), F.lit(False))


def _matching(df: DataFrame, acl: Column, principals: DataFrame, key: str) -> DataFrame:
    """Public rows by a test of the row. Of the others every distinct list is matched once, entry
    by entry, and rows follow the verdict on their list, known by its digest."""
    rows = df.select(key, acl.alias("_acl"))
    private = rows.where(~_is_public(F.col("_acl"))).withColumn(
        "_list", F.sha2(F.to_json("_acl"), 256))
    lists = private.groupBy("_list").agg(F.first("_acl").alias("_acl"))
    allowed = (lists.select("_list", F.explode("_acl").alias("principal"))
               .join(principals.select("principal"), "principal", "left_semi"))
    listed = private.select(key, "_list").join(allowed, "_list", "left_semi").select(key)
    return rows.where(_is_public(F.col("_acl"))).select(key).unionAll(listed).distinct()
