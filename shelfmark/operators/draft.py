"""Submissions built by edits: a log of builder calls turned into assembled submissions.

The log has columns ``submission_id``, ``seq`` (a number, unique within a submission), ``op``,
``field``, ``key`` and ``payload`` (JSON text):

=========  =========================================  =============================================
op         fields                                     meaning
=========  =========================================  =============================================
append     data_sources, data_destinations, tags      adds a text or a list of texts
upsert     index, services, projects                  replaces the value of ``key``; falsy data
                                                      deletes a project
set        all other fields                           replaces the value
describe   custom                                     adds ``<name>_desc`` for each entry
clear      any                                        forgets all edits of the field so far
reset      none                                       forgets all but ``test`` and ``update``
=========  =========================================  =============================================

Links keep the first value set that is not empty, until cleared. An edit whose payload is not finite JSON is
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.documents import json_as_list
from shelfmark.operators import fold, submission
from shelfmark.operators.skew import ROWS_PER_TASK, number_rows
from shelfmark.schema import LINK
from shelfmark.session import checkpointed

LIST_FIELDS = ["data_sources", "data_destinations", "tags"]
MAP_FIELDS = ["index", "services", "projects", "custom"]
VALUE_FIELDS = ["dc", "organization", "links", "acl", "source_name", "mrr", "external_uri",
                "extraction_config", "curation", "no_extract", "dataset_acl",
                "update_metadata_only"]
_KEYS = ("submission_id", "field")
_STATE = ["submission_id", "field", "key", "pos", "payload"]
_STEP = ["submission_id", "field", "key", "seq", "op", "payload"]
FLAGS = ["test", "update"]
# Elements of a list, or entries of a map, in one part of a submission.
PART_ROWS = 100_000
# Edits of one list numbered together when a list is heavy.
_SLICE = 100_000


def current_state(log: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """What holds after all edits, one row per list element, map entry or single value.

    Columns ``submission_id``, ``field``, ``key`` (of map entries), ``pos`` (of list elements,
    from 1) and ``payload`` (list elements are plain texts, everything else JSON).
    """
    steps = _steps(fold.valid_edits(log))
    # Written once, as each kind of field is folded in its own way from here.
    return _held(checkpointed(fold.after_clear(steps, _KEYS)), rows_per_task)


def partial_state(log: DataFrame) -> DataFrame:
    """The steps of some calls that can still count. Such states of parts of a log merge in any
    order, see ``merged_state``; ``standing`` gives what holds after all of them."""
    return merged_state(_steps(fold.valid_edits(log)))


def merged_state(states: DataFrame) -> DataFrame:
    """One state from those of several parts of the log.

    Of each field the last clear stays, with all list elements and links after it, the last step
    on each entry, and the last value. Elements before a clear go; an entry deleted stays as such,
    as an earlier value may arrive yet.
    """
    clears = states.where("op = 'clear'").groupBy(*_KEYS).agg(F.max("seq").alias("seq"))
    cleared = clears.select(*_KEYS, F.col("seq").alias("_cleared"))
    live = states.where("op <> 'clear'").join(cleared, list(_KEYS), "left").where(
        F.col("_cleared").isNull() | (F.col("seq") > F.col("_cleared"))).drop("_cleared")
    listed = (F.col("op") == "append") | (F.col("field") == "links")
    links = (F.col("field") != "links") | ~fold.is_falsy(F.col("payload"))
    last = live.where(~listed).groupBy(*_KEYS, "key").agg(
        F.max_by(F.struct("seq", "op", "payload"), "seq").alias("_last")).select(
        *_KEYS, "key", "_last.*")
    none = F.lit(None).cast("string")
    return (live.where(listed & links).select(*_STEP)
            .unionByName(last.select(*_STEP))
            .unionByName(clears.select(*_KEYS, none.alias("key"), "seq", F.lit("clear").alias("op"),
                                       none.alias("payload"))))


def standing(state: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """What holds by a merged state, as ``current_state`` has it."""
    return _held(checkpointed(state.where("op <> 'clear'")), rows_per_task)


def _held(live: DataFrame, rows_per_task: int) -> DataFrame:
    """What the steps that no clear has undone leave, in the columns of ``current_state``."""
    lists = fold.appended(live, [F.floor(F.col("seq.at") / _SLICE)], rows_per_task, _KEYS)
    entries = fold.last_write(live.where("op = 'upsert'"), [*_KEYS, "key"])
    values = live.where("op = 'set'")
    last = fold.last_write(values.where("field <> 'links'"), _KEYS)
    is_links = (F.col("field") == "links") & ~fold.is_falsy(F.col("payload"))
    first = fold.first_write(values.where(is_links), _KEYS)
    deleted = (F.col("field") == "projects") & fold.is_falsy(F.col("payload"))
    parts = [lists, entries.where(~deleted), last, first]
    state = parts[0].select(*_columns(parts[0]))
    for part in parts[1:]:
        state = state.unionByName(part.select(*_columns(part)))
    return state


def documents(state: DataFrame, part_rows: int = PART_ROWS,
              rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Assembled submissions, one row for each ``part`` of a submission, counted from 0.

    A part has at most ``part_rows`` elements of each list and entries of each map; longer ones go
    on in the next part, in order. Single values stand in part 0.
    """
    # Entries of maps are numbered by key, as elements of lists are.
    is_entry = F.col("key").isNotNull()
    slices = [F.substring("key", 1, 2), F.substring("key", 1, 8), F.col("key")]
    entries = number_rows(state.where(is_entry).drop("pos"), _KEYS, ["key"], slices, "pos",
                          rows_per_task)
    placed = state.where(~is_entry).unionByName(entries).withColumn(
        "part", F.coalesce(F.floor((F.col("pos") - 1) / part_rows), F.lit(0)).cast("bigint"))

    def of(field: str, *columns: str) -> Column:
        return F.collect_list(F.when(F.col("field") == field, F.struct(*columns)))

    def value(field: str) -> Column:
        return F.max(F.when(F.col("field") == field, F.col("payload")))
    lists = [of(name, "pos", "payload").alias(name) for name in LIST_FIELDS]
    maps = [of(name, "key", "payload").alias(name) for name in MAP_FIELDS]
    values = [value(name).alias(name) for name in (*VALUE_FIELDS, *FLAGS)]
    gathered = placed.groupBy("submission_id", "part").agg(*lists, *maps, *values)
    blocks = {name: F.transform(F.array_sort(name), lambda r: r["payload"])
              for name in LIST_FIELDS}
    blocks |= {name: F.map_from_entries(F.array_sort(name)) for name in MAP_FIELDS}
    blocks |= {name: F.col(name) == "true" for name in (
        *FLAGS, "update_metadata_only", "curation", "no_extract")}
    blocks["external_uri"] = _text("external_uri")
    blocks["dataset_acl"] = json_as_list(F.col("dataset_acl"))
    blocks["placement"] = F.struct(
        _text("organization").alias("organization"),
        F.from_json("links", T.ArrayType(LINK)).alias("links"),
        json_as_list(F.col("acl")).alias("acl"), _text("source_name").alias("source_name"))
    return submission.assemble(gathered.withColumns(blocks), keep=["submission_id", "part"])


def _steps(log: DataFrame) -> DataFrame:
    """Edits as steps on single elements and entries, ordered by ``seq`` and step within it.

    A reset becomes the clears of all fields it concerns.
    """
    is_list = (F.col("op") == "append") & F.col("field").isin(LIST_FIELDS)
    is_custom = (F.col("field") == "custom") & F.col("op").isin("set", "describe")
    describes = F.col("op") == "describe"
    none = F.lit(None).cast("string")

    def step(op, field=F.col("field"), key=none, payload=none, n=F.lit(0)):
        return F.struct(n.alias("n"), F.lit(op).alias("op") if isinstance(op, str)
                        else op.alias("op"), field.alias("field"), key.alias("key"),
                        payload.alias("payload"))

    elements = F.transform(json_as_list(F.col("payload")),
                           lambda item, n: step("append", payload=item, n=n))
    fields = F.map_entries(F.transform_values(
        F.try_variant_get(F.try_parse_json("payload"), "$", "map<string,variant>"),
        lambda _, v: F.to_json(v)))
    named = lambda e: F.when(describes, F.concat(e["key"], F.lit("_desc"))).otherwise(e["key"])
    entries = F.transform(
        fields, lambda e: step("upsert", key=named(e), payload=e["value"], n=F.lit(1)))
    # A new custom block replaces the old one with all its descriptions.
    custom = F.when(describes, entries).otherwise(F.concat(F.array(step("clear")), entries))
    reset = F.array(*[step("clear", field=F.lit(name))
                      for name in [*LIST_FIELDS, *MAP_FIELDS, *VALUE_FIELDS]])
    is_service = (F.col("op") == "upsert") & (F.col("field") == "services")
    given = F.when(~(is_service & (F.trim("payload") == "null")), F.col("payload"))
    plain = F.array(step(F.col("op"), key=F.col("key"),
                         payload=F.coalesce(given, F.when(is_service, F.lit("true")))))
    steps = (F.when(F.col("op") == "reset", reset).when(is_list, elements)
             .when(is_custom, custom).otherwise(plain))
    return (log.select("submission_id", F.col("seq").alias("at"), F.explode(steps).alias("s"))
            .select("submission_id", F.struct("at", "s.n").alias("seq"),
                    "s.op", "s.field", "s.key", "s.payload"))


def _columns(part: DataFrame) -> list[Column]:
    types = {"key": "string", "pos": "bigint"}
    return [F.col(c) if c in part.columns else F.lit(None).cast(types[c]).alias(c)
            for c in _STATE]


def _text(field: str) -> Column:
    return F.try_variant_get(F.try_parse_json(field), "$", "string")
