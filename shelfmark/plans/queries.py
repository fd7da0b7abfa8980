"""The registered queries: each takes a session and a data folder and returns flat columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import documents, locations, status
from shelfmark.functions.times import iso_time, order_slices
from shelfmark.operators import (
    access, catalog, curation, dc, draft, extract, filters, fold, indexed, submission, validate,
)
from shelfmark.plans import views
from shelfmark.schema import EVENTS
from shelfmark.session import configure, work_folder
from shelfmark.sources import buckets
from shelfmark.sources.readers import read_csv, yaml_records
from shelfmark.streaming import runs, versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF_YEAR = 2024
PUBLISHER = "Open Dataset Catalog"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# --- filters ----------------------------------------------------------------

FILTERS: dict[str, list[filters.Filter]] = {
    "f_begins": [("organization", "^", "1")],
    "f_contains": [("organization", "*", "NOT")],
    "f_eq": [("status_code", "==", "SRS")],
    "f_is_null": [("organization", "==", None)],
    "f_ne": [("organization", "!=", "5-LOW")],
    "f_not_null": [("organization", "!=", None)],
    "f_gt": [("size_mb", ">", 250000)],
    "f_ge": [("size_mb", ">=", 400000.0)],
    "f_lt": [("size_mb", "<", 50000)],
    "f_le": [("size_mb", "<=", 100000.0)],
    "f_between": [("size_mb", "[]", [100000, 200000])],
    "f_in": [("status_code", "in", ["SSF", "SPz"])],
    "f_all": [("organization", "^", "2"), ("size_mb", ">=", 1000), ("test", "==", False),
              ("status_code", "in", ["SSF", "SRS"])],
}
SHOWN = ["source_key", "organization", "status_code", "size_mb"]


def _filter_query(wanted: list[filters.Filter]) -> Query:
    return lambda spark, folder: filters.select_submissions(
        views.submissions(spark, folder), wanted).select(*SHOWN)


QUERIES.update({name: _filter_query(wanted) for name, wanted in FILTERS.items()})


@query
def f_active_only(spark, folder):
    return filters.select_submissions(
        views.submissions(spark, folder), active_only=True).select(*SHOWN)


@query
def f_no_tests(spark, folder):
    return filters.select_submissions(
        views.submissions(spark, folder), include_tests=False).select(*SHOWN)


@query
def f_date_range(spark, folder):
    return filters.select_submissions(
        views.submissions(spark, folder), newer_than=(1996, 1, 1),
        older_than=(1997, 1, 1)).select(*SHOWN)


@query
def f_scope(spark, folder):
    subs = views.submissions(spark, folder)
    scopes = {"own": filters.in_scope(subs, owner=1), "all": filters.in_scope(subs, code="all"),
              "active": filters.in_scope(subs, code="active")}
    return extract.union_records(*[
        df.select(F.lit(name).alias("scope"), "source_key") for name, df in scopes.items()])


@query
def f_point_lookup(spark, folder):
    found = catalog.by_source_id(views.submissions(spark, folder), "ds_1_v2.1")
    return found.select("source_id", "source_key", "status_code")


@query
def f_lookup_test(spark, folder):
    """An id as statuses of tests carry it."""
    found = catalog.by_source_id(views.submissions(spark, folder), "_test_ds_3_v3.1")
    return found.select("source_id", "source_key", "status_code")


# --- status -----------------------------------------------------------------

@query
def status_report(spark, folder):
    """The flagship: a filtered catalog as report lines."""
    found = filters.select_submissions(
        views.catalog(spark, folder), [("organization", "^", "1")], include_tests=False,
        newer_than=(1996, 1, 1), older_than=(1997, 1, 1))
    line = status.report_line(F.col("source_id"), F.col("active"), F.col("status_code"))
    return found.select("source_id", line.alias("line"))


@query
def status_word(spark, folder):
    return views.submissions(spark, folder).select(
        "source_key", status.status_word(F.col("status_code")).alias("word"))


def _flow_status():
    return F.when(F.col("status_code") != "MMM",
                  F.when(F.col("active"), "ACTIVE").otherwise("SUCCEEDED"))


@query
def status_short(spark, folder):
    return views.catalog(spark, folder).select(
        "source_id", status.short_line(F.col("source_id"), _flow_status()).alias("line"))


@query
def status_verbose(spark, folder):
    shown = F.concat(F.lit("Status of "), "source_id")
    return views.catalog(spark, folder).select(
        "source_id", status.full_text(shown, _flow_status()).alias("full_text"),
        status.verbose_text(shown, F.col("active")).alias("verbose_text"))


@query
def status_missing(spark, folder):
    return views.catalog(spark, folder).select(
        "source_id", status.status_error(_flow_status()).alias("error"))


def _event_stream(spark, folder):
    # A pattern, because a stream takes a plain path for a directory and this may be one file.
    return (configure(spark).readStream.schema(EVENTS).option("maxFilesPerTrigger", 64)
            .parquet(f"{folder}/events.parque[t]"))


@query
def stream_current_status(spark, folder):
    out = work_folder(spark, "status")
    events = _event_stream(spark, folder)
    runs.run_current_status(events.select(
        F.col("user_id").cast("string").alias("source_id"), "ts", "event_id",
        F.col("event_type").alias("status")), out)
    return runs.read_current_status(spark, out).select("source_id", "status", "event_id")


def _iso_time(spark, folder):
    return views.table(spark, folder, "events").select(
        "event_id", iso_time(F.col("ts")).alias("iso"))


QUERIES["iso_time"] = _iso_time


# --- catalog ----------------------------------------------------------------

@query
def version_number(spark, folder):
    return views.catalog(spark, folder).select("source_key", "source_name", "version")


@query
def version_batches(spark, folder):
    """Versions of submissions taken in as four batches, of which the last three come late."""
    out = work_folder(spark, "versions")
    arrived = views.submissions(spark, folder)
    for n in range(4):
        versions.add(arrived.where(F.pmod(F.xxhash64("source_key"), F.lit(4)) == n), out, n)
    return versions.numbered(arrived, out).select("source_key", "source_name", "version")


@query
def latest_version(spark, folder):
    return catalog.latest_versions(views.submissions(spark, folder),
                                   ["source_key", "status_code"])


def _routed(spark, folder):
    return submission.route_tests(views.catalog(spark, folder), "catalog", "catalog-test")


@query
def test_routing(spark, folder):
    return _routed(spark, folder).select("source_key", "routed_id", "search_index", "public")


@query
def source_id_parts(spark, folder):
    parts = locations.source_id_parts(F.col("routed_id"))
    return _routed(spark, folder).select("source_key", parts.alias("p")).select(
        "source_key", F.col("p.test").alias("is_test"), "p.source_name", "p.major", "p.minor")


@query
def resubmit_guard(spark, folder):
    return catalog.resubmission_errors(
        views.incoming(spark, folder), views.submissions(spark, folder),
    ).select("incoming_key", "source_name", "error")


@query
def incremental_inherit(spark, folder):
    return catalog.inherit(
        views.incoming(spark, folder), views.submissions(spark, folder),
        ["organization", "size_mb"],
    ).select("incoming_key", "previous_version", "organization", "size_mb")


@query
def metadata_overlay(spark, folder):
    old = views.catalog(spark, folder).select(
        "source_id", F.concat(F.lit("title of "), "source_name").alias("title"))
    return catalog.overlay_metadata(old, views.metadata_updates(spark, folder), ["title"])


@query
def overlay_buckets(spark, folder):
    """The same overlay on a stored catalog of which only the touched buckets are rewritten."""
    path = work_folder(spark, "catalog")
    buckets.create(views.catalog(spark, folder).select(
        "source_id", F.concat(F.lit("title of "), "source_name").alias("title")), path, 32)
    buckets.overlay(views.metadata_updates(spark, folder).select("source_id", "title"), path,
                    ["title"])
    return buckets.read(spark, path)


@query
def update_eligible(spark, folder):
    return catalog.eligible_updates(
        views.metadata_updates(spark, folder), views.catalog(spark, folder),
    ).select("source_id", "requester")


@query
def metadata_update_flow(spark, folder):
    """Eligible updates only, of several to one submission the last, laid over the catalog."""
    entries = views.catalog(spark, folder)
    once = views.metadata_updates(spark, folder).withColumn("seq", F.lit(1))
    again = once.where("length(source_id) % 2 = 0").withColumns(
        {"seq": F.lit(2), "title": F.concat("title", F.lit(" again"))})
    eligible = catalog.eligible_updates(once.unionByName(again), entries)
    last = catalog.last_update(eligible.where("title is not null"), ["title"], F.col("seq"))
    old = entries.select("source_id", F.concat(F.lit("title of "), "source_name").alias("title"))
    return catalog.overlay_metadata(old, last, ["title"])


@query
def org_registry(spark, folder):
    return catalog.registered_organizations(
        views.submissions(spark, folder).select("source_key", "organization"),
        views.org_registry(spark, folder))


@query
def org_ancestors(spark, folder):
    return catalog.organization_ancestors(views.org_parents(spark, folder))


@query
def org_with_ancestors(spark, folder):
    subs = views.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("source_key"), F.col("o_custkey").alias("organization"))
    return catalog.with_ancestors(subs, views.org_parents(spark, folder))


# --- citation block ---------------------------------------------------------

def _dc_lists(spark, folder):
    """The input with its lists: titles, authors, affiliations, related DOIs, subjects."""
    related = F.when(F.col("dataset_doi").isNotNull(), F.array(
        F.concat("dataset_doi", F.lit("/a")), F.concat("dataset_doi", F.lit("/b"))))
    return views.dc_input(spark, folder).withColumns({
        "titles": F.when(F.col("title") != "", F.array("title", "tag1")),
        "authors": views.present("author1", "author2", "author3"),
        "affiliations": F.transform(views.present("aff1", "aff2"), lambda a: F.array(a)),
        "related_dois": related,
        "subjects": F.array("subject1", "tag1"),
        "description": F.when(F.col("size") % 2 == 0, F.col("subject1")).otherwise(""),
        "resource_type": F.when(F.col("size") % 5 == 0, F.col("tag1")),
    })


def _dc(spark, folder):
    return dc.with_dc_block(_dc_lists(spark, folder), {
        "title": "titles", "authors": "authors", "affiliations": "affiliations",
        "publisher": "publisher", "publication_year": "publication_year",
        "resource_type": "resource_type", "description": "description",
        "dataset_doi": "dataset_doi", "related_dois": "related_dois", "subjects": "subjects",
    }, default_publisher=PUBLISHER, as_of_year=AS_OF_YEAR)


def _spread(df, column, name):
    """Items of a list with their position.

    The outer form keeps Spark from testing the list for emptiness first, which would build it
    twice; the rows of empty lists go afterwards.
    """
    items = df.select("submission_id", F.posexplode_outer(column).alias("pos", name))
    return items.where("pos is not null")


@query
def dc_titles(spark, folder):
    return _spread(_dc(spark, folder), "dc.titles", "item").select(
        "submission_id", "pos", "item.title")


@query
def dc_author_names(spark, folder):
    return _spread(_dc(spark, folder), "dc.creators", "creator").select(
        "submission_id", "pos", F.col("creator.creatorName").alias("creator_name"),
        F.col("creator.familyName").alias("family"), F.col("creator.givenName").alias("given"))


@query
def dc_affiliations(spark, folder):
    creators = _spread(_dc(spark, folder), "dc.creators", "creator")
    return creators.select("submission_id", F.col("pos").alias("author_pos"),
                           F.posexplode("creator.affiliations").alias("pos", "affiliation"))


@query
def dc_creators(spark, folder):
    creators = _spread(_dc(spark, folder), "dc.creators", "creator")
    return creators.select("submission_id", "pos",
                           F.col("creator.creatorName").alias("creator_name"),
                           F.array_join("creator.affiliations", "|").alias("affiliations"))


@query
def dc_defaults(spark, folder):
    return _dc(spark, folder).select(
        "submission_id", "dc.publisher",
        F.col("dc.resourceType.resourceTypeGeneral").alias("general"),
        F.col("dc.resourceType.resourceType").alias("specific"))


@query
def dc_year(spark, folder):
    return _dc(spark, folder).select(
        "submission_id", F.col("dc.publicationYear").alias("publication_year"))


@query
def dc_optional(spark, folder):
    return _dc(spark, folder).select(
        "submission_id", F.get("dc.descriptions", F.lit(0))["description"].alias("description"),
        F.get("dc.descriptions", F.lit(0))["descriptionType"].alias("description_type"),
        F.col("dc.identifier.identifier").alias("identifier"),
        F.col("dc.identifier.identifierType").alias("identifier_type"))


@query
def dc_related(spark, folder):
    return _spread(_dc(spark, folder), "dc.relatedIdentifiers", "item").select(
        "submission_id", "pos", F.col("item.relatedIdentifier").alias("related"),
        F.col("item.relatedIdentifierType").alias("related_type"),
        F.col("item.relationType").alias("relation"))


@query
def dc_subjects(spark, folder):
    return _spread(_dc(spark, folder), "dc.subjects", "item").select(
        "submission_id", "pos", "item.subject")


@query
def dc_extra(spark, folder):
    base = F.create_map(F.lit("publisher"), F.col("dc.publisher"),
                        F.lit("publicationYear"), F.col("dc.publicationYear"))
    extra = F.create_map(F.lit("publisher"), F.lit("ignored"), F.lit("other"), F.lit("5"),
                         F.lit("sizes"), F.col("size").cast("string"))
    return _dc(spark, folder).select(
        "submission_id",
        F.explode(documents.merge_maps(base, extra)).alias("field", "value"))


@query
def dc_block(spark, folder):
    first = F.get("dc.creators", F.lit(0))
    return _dc(spark, folder).select(
        "submission_id",
        F.get("dc.titles", F.lit(0))["title"].alias("title"),
        F.size("dc.titles").alias("n_titles"),
        F.size("dc.creators").alias("n_creators"),
        first["creatorName"].alias("first_creator"),
        F.col("dc.publisher").alias("publisher"),
        F.col("dc.publicationYear").alias("publication_year"),
        F.col("dc.resourceType.resourceType").alias("resource_type"),
        F.col("dc.identifier.identifier").alias("doi"),
        F.size(F.coalesce("dc.relatedIdentifiers", F.array())).alias("n_related"),
        F.size("dc.subjects").alias("n_subjects"))


@query
def tags_subjects(spark, folder):
    tags = F.array(F.col("tag1"), F.concat(F.lit("tag "), "subject1"))
    return _dc(spark, folder).select(
        "submission_id", F.explode(dc.tags_and_subjects(F.col("dc"), tags)).alias("tag"))


@query
def source_name_clean(spark, folder):
    title = F.concat(F.lit("The "), "author1", F.lit(" ("), "tag1", F.lit(")!"))
    return views.dc_input(spark, folder).select(
        "submission_id", locations.clean_source_name(title).alias("source_name"))


@query
def coerce_list(spark, folder):
    key = F.col("submission_id")
    value = (F.when(key % 3 == 0, F.concat(F.lit('"'), "subject1", F.lit('"')))
             .when(key % 3 == 1, F.concat(F.lit('["'), "subject1", F.lit('", "'), "tag1",
                                          F.lit('"]')))
             .otherwise(F.col("size").cast("string")))
    listed = views.dc_input(spark, folder).withColumn("list", documents.json_as_list(value))
    return _spread(listed, "list", "item")


# --- submissions ------------------------------------------------------------

def _submissions(spark, folder):
    size = F.col("size")
    placement = F.struct(
        F.when(size % 4 == 0, F.col("tag1")).alias("organization"),
        F.lit(None).cast("array<struct<type:string,doi:string,url:string,description:string,"
                         "bibtex:string>>").alias("links"),
        F.when(size % 7 == 0, F.array(F.lit("public"))).alias("acl"),
        locations.clean_source_name(F.col("title")).alias("source_name"))
    services = F.when(size % 2 == 0, F.create_map(
        F.lit("publish"), F.lit("true"),
        F.lit("registry"), F.concat(F.lit('{"collection": '), size.cast("string"), F.lit("}"))))
    return submission.assemble(_dc(spark, folder).withColumns({
        "data_sources": F.when(size % 5 != 0, F.array(F.concat(F.lit("https://x.org/"), "tag1"))),
        "test": size % 6 == 0,
        "placement": placement,
        "custom": F.when(size % 3 == 0, F.create_map(F.lit("size"), size.cast("string"))),
        "services": services,
        "tags": F.when(size % 2 == 0, F.array("tag1")).otherwise(F.array().cast("array<string>")),
        "curation": size % 4 == 1,
        "external_uri": F.when(size % 9 == 0, ""),
        "extraction_config": F.when(size % 8 == 0, '{"group_by_dir": true}').otherwise("{}"),
    }), keep=["submission_id"])


@query
def submission_json(spark, folder):
    subs = _submissions(spark, folder)
    text = subs.select("submission_id", submission.submission_json(subs).alias("json"))
    part = lambda path: F.get_json_object("json", path)
    return text.select(
        "submission_id",
        F.array_join(F.json_object_keys("json"), ",").alias("blocks"),
        part("$.dc.titles[0].title").alias("title"),
        part("$.dc.creators[0].creatorName").alias("first_creator"),
        part("$.data_sources").alias("data_sources"),
        part("$.services").alias("services"),
        part("$.placement").alias("placement"),
        part("$.custom.size").alias("custom_size"),
        part("$.tags[0]").alias("first_tag"))


@query
def metadata_update_projection(spark, folder):
    update = submission.metadata_update(_submissions(spark, folder))
    return update.select("submission_id", F.array_join(
        F.json_object_keys(submission.submission_json(update)), ",").alias("blocks"))


@query
def service_routing(spark, folder):
    """Services asked for by edits: the last request per service holds."""
    asked = F.when(F.col("value") < 3, None).when(F.col("value") < 6, "false").otherwise(
        F.col("payload"))
    last = fold.last_write(views.edit_log(spark, folder).withColumn("asked", asked),
                           columns=["asked"])
    requests = last.select("submission_id", F.create_map("key", "asked").alias("services"))
    return submission.service_routes(requests, keep=["submission_id"])


@query
def source_manifest(spark, folder):
    drive = F.concat(F.lit("googledrive:///"), F.col("page_id").cast("string"))
    df = views.locations(spark, folder).withColumn("data_sources", F.array(F.col("url"), drive))
    return submission.manifest(df, "data_sources", keep=["page_id"])


@query
def destination_manifest(spark, folder):
    usable = F.filter(F.array("url"), locations.is_destination)
    df = views.locations(spark, folder).withColumn("data_destinations", usable)
    return submission.manifest(df, "data_destinations", keep=["page_id"])


@query
def url_parts(spark, folder):
    url = F.col("url")
    return views.locations(spark, folder).select(
        "page_id", locations.scheme(url).alias("scheme"), locations.host(url).alias("host"),
        locations.path(url).alias("path"))


@query
def url_canonical(spark, folder):
    return views.locations(spark, folder).select(
        "page_id", locations.canonical(F.col("url")).alias("location"))


# --- validation -------------------------------------------------------------

@query
def v_required(spark, folder):
    return _dc_lists(spark, folder).select("submission_id", validate.required_arguments(
        F.col("titles"), F.col("authors")).alias("error"))


@query
def v_blocks(spark, folder):
    size = F.col("size")
    data = F.when(size % 5 != 0, F.array("tag1"))
    return _dc_lists(spark, folder).select("submission_id", validate.required_blocks(
        F.col("titles").isNotNull(), data, size % 6 == 0).alias("error"))


def _unsafe_log(spark, folder):
    """The edit log with payloads spoilt in three ways."""
    kind = F.col("event_id") % 7
    payload = (F.when(kind == 0, '{"k": NaN}').when(kind == 1, '{"k": 1e400}')
               .when(kind == 2, '{"k": ').when(kind == 3, '{"k": "Infinity"}')
               .otherwise(F.col("payload")))
    return views.edit_log(spark, folder).withColumn("payload", payload)


@query
def v_finite(spark, folder):
    return _unsafe_log(spark, folder).select("event_id", validate.finite_json(
        "custom block", F.col("payload")).alias("error"))


def _custom(spark, folder):
    """Custom blocks of ``size % 14`` fields, the first of them described, some wrongly."""
    numbers = F.filter(F.sequence(F.lit(0), F.col("size") % 14), lambda n: n > 0)
    fields = F.map_from_arrays(
        F.transform(numbers, lambda n: F.concat(F.lit("f"), n.cast("string"))),
        F.transform(numbers, lambda n: n.cast("string")))
    described = F.create_map(F.when(F.col("size") % 3 == 0, "f1_desc").otherwise("other_desc"),
                             F.col("tag1"))
    return views.dc_input(spark, folder).withColumn("custom", F.map_concat(fields, described))


@query
def v_custom_keys(spark, folder):
    return _custom(spark, folder).select(
        "submission_id", validate.custom_keys(F.col("custom")).alias("error"))


@query
def v_custom_desc(spark, folder):
    return _custom(spark, folder).select(
        "submission_id", validate.described_fields(F.col("custom")).alias("error"))


@query
def v_passthrough_http(spark, folder):
    return views.locations(spark, folder).select("page_id", validate.passthrough_sources(
        F.col("page_id") % 2 == 0, F.array("url")).alias("error"))


@query
def v_destination(spark, folder):
    return views.locations(spark, folder).select(
        "page_id", validate.destinations(F.array("url")).alias("error"))


@query
def v_verdict(spark, folder):
    return views.verdicts(spark, folder).select(
        "source_key", validate.verdict(F.col("action")).alias("action"),
        validate.verdict_error(F.col("action")).alias("error"))


# --- folds ------------------------------------------------------------------

@query
def fold_append(spark, folder):
    slices = order_slices(F.col("seq.ts"), F.col("event_id"))
    return fold.appended(views.edit_log(spark, folder), slices).select(
        "submission_id", "key", "pos", "payload")


@query
def fold_last(spark, folder):
    return fold.last_write(views.edit_log(spark, folder).where("op = 'set'"), ["submission_id"],
                           ["key", "payload"])


@query
def fold_upsert(spark, folder):
    return fold.upserted(views.edit_log(spark, folder), ["payload", "event_id"])


@query
def fold_delete(spark, folder):
    return fold.without_deleted(views.edit_log(spark, folder))


@query
def fold_first(spark, folder):
    """The first value set since the field was last cleared."""
    edits = fold.after_clear(views.edit_log(spark, folder)).where("op = 'set'")
    return fold.first_write(edits, columns=["payload", "event_id"])


@query
def fold_clear(spark, folder):
    return fold.after_clear(views.edit_log(spark, folder)).select(
        "submission_id", "key", "op", "event_id", "payload")


@query
def fold_reset(spark, folder):
    """Clears of field k0 are taken for resets, which spare field k4."""
    op = F.when((F.col("op") == "clear") & (F.col("key") == "k0"), "reset").otherwise(F.col("op"))
    log = views.edit_log(spark, folder).withColumn("op", op)
    return fold.after_clear(fold.after_reset(log, keep=["k4"])).select(
        "submission_id", "key", "op", "event_id")


@query
def fold_skips_invalid(spark, folder):
    return fold.last_write(fold.valid_edits(_unsafe_log(spark, folder)),
                           columns=["payload", "event_id"])


@query
def stream_fold(spark, folder):
    out = work_folder(spark, "fold")
    events = _event_stream(spark, folder)
    runs.run_fold(views.edits(events), out)
    return runs.read_fold(spark, out).select("submission_id", "key", "payload")


@query
def stream_draft(spark, folder):
    """What submissions hold after all builder calls, kept up to date by a stream of them."""
    out = work_folder(spark, "draft")
    runs.run_draft(views.builder_calls(_event_stream(spark, folder)), out)
    return runs.read_draft(spark, out)


@query
def draft_documents(spark, folder):
    """Submissions in parts of three elements, put together from all builder calls."""
    state = draft.current_state(views.builder_log(spark, folder))
    parts = draft.documents(state, part_rows=3)
    return parts.select(
        "submission_id", "part", F.array_join("tags", "|").alias("tags"),
        F.array_join(F.map_keys("services"), "|").alias("services"),
        F.array_join(F.map_keys("projects"), "|").alias("projects"),
        F.col("placement.organization").alias("organization"))


@query
def draft_state(spark, folder):
    """What submissions hold after all builder calls."""
    return draft.current_state(views.builder_log(spark, folder))


@query
def custom_desc(spark, folder):
    custom = F.create_map(F.lit("type"), F.col("subject1"), F.lit("brand"), F.col("tag1"),
                          F.lit("brand_desc"), F.lit("old text"))
    texts = F.create_map(F.when(F.col("size") % 2 == 0, "brand").otherwise("type"),
                         F.concat(F.lit("about "), "tag1"))
    return views.dc_input(spark, folder).select("submission_id", F.explode(
        documents.with_descriptions(custom, texts)).alias("field", "value"))


# --- access and curation ----------------------------------------------------

@query
def acl_effective(spark, folder):
    acl = access.effective_acl(F.col("acl"), F.col("dataset_acl"))
    return views.acl_input(spark, folder).select("source_key", F.explode(acl).alias("principal"))


@query
def acl_entry_visible(spark, folder):
    return access.visible_entries(views.acl_input(spark, folder),
                                  views.principals(spark, folder), "source_key")


@query
def acl_record_visible(spark, folder):
    return access.visible_records(views.acl_input(spark, folder),
                                  views.principals(spark, folder), "source_key")


@query
def curation_eligible(spark, folder):
    members = views.memberships(spark, folder)
    requester = members.where("principal = 'supplier_1'").select("principal")
    return access.curatable(views.acl_input(spark, folder),
                            access.curation_identities(members, requester), "source_key")


@query
def curation_available(spark, folder):
    return access.not_public(views.curation_tasks(spark, folder)).select("source_id")


@query
def curation_summary(spark, folder):
    return curation.summaries(views.curation_tasks(spark, folder))


@query
def curation_list(spark, folder):
    """What one of a priority's curators sees: the tasks of that list, with their summaries."""
    tasks = views.curation_tasks(spark, folder)
    identities = spark.createDataFrame([("1-URGENT",), ("2-HIGH",)], "principal string")
    mine = access.curatable(tasks, identities, "source_id")
    return curation.summaries(access.not_public(tasks).join(mine, "source_id", "left_semi"))


@query
def canonical_json(spark, folder):
    tasks = views.curation_tasks(spark, folder).withColumn(
        "curation_start_date", iso_time(F.col("curation_start_date")))
    text = documents.canonical_json(tasks.schema, [
        "source_id", "submission_info", "curation_start_date", "extraction_summary"])
    return tasks.select("source_id", text.alias("json"))


@query
def canonical_open(spark, folder):
    """Open blocks as they were given, in any order, with keys sorted at every depth."""
    events = views.table(spark, folder, "events")
    block = F.format_string('{"z": [{"y": %s, "b": "%s"}], "props": %s, "a": {"n": null, "m": true}}',
                            F.col("event_id").cast("string"), F.col("event_type"), F.col("props"))
    blocks = events.select("event_id", block.alias("mrr"), F.create_map(
        F.lit("two"), F.lit('{"d": 1, "c": "x"}'), F.lit("one"), F.col("props")).alias("projects"))
    text = documents.canonical_json(blocks.schema, ["projects", "mrr"], ["projects", "mrr"])
    return blocks.select("event_id", text.alias("json"))


@query
def curation_apply(spark, folder):
    decided = curation.apply_verdicts(views.curation_tasks(spark, folder).select("source_id"),
                                      views.verdicts(spark, folder), order="source_key")
    return decided.select("source_id", "action", "reason", "outcome")


@query
def curation_unknown(spark, folder):
    return curation.unknown_verdicts(
        views.verdicts(spark, folder), views.curation_tasks(spark, folder),
    ).select("source_id", "action", "error")


# --- records ----------------------------------------------------------------

DOCUMENT_MAPPING = {
    "label.mark": "stock.entry.maker's mark",
    "label.words": "stock.entry.words",
    "packing.outer.units": "stock.entry.box [outer].units",
    "offer.price": "price",
    "offer.ends": "terms.until",
}
DOCUMENT_TYPES = {"packing.outer.units": "int", "offer.price": "double", "offer.ends": "date"}


@query
def index_json(spark, folder):
    mapping = {"reading.k": "k", "reading.y": "x.y"}
    return extract.json_records(
        views.table(spark, folder, "events"), F.col("props"), mapping, {"reading.k": "bigint"},
        keep=["event_id"]).select("event_id", "reading.k", "reading.y")


def _document_records(spark, folder):
    return extract.json_records(views.part_documents(spark, folder), F.col("document"),
                                DOCUMENT_MAPPING, DOCUMENT_TYPES, "n/a", keep=["p_partkey"])


@query
def index_nested(spark, folder):
    return _document_records(spark, folder).select(
        "p_partkey", "label.mark", "label.words", "packing.outer.units", "offer.price",
        "offer.ends")


@query
def index_by_submission(spark, folder):
    """Files of five types from 15 submissions, each read through its own mapping."""
    return indexed.mapped_records(views.indexed_files(spark, folder), views.file_index(spark))


LINE_HEADER = ["number", "flag", "status"]
LINE_MAPPING = {"line.number": "number", "line.flag": "flag", "line.status": "status",
                "line.comment": "comment"}


def _line_records(spark, folder, na_values=None):
    return extract.csv_records(
        views.delimited(spark, folder), F.col("line"), LINE_HEADER, LINE_MAPPING, "#",
        {"line.number": "int"}, na_values, keep=["l_orderkey", "l_linenumber", "l_partkey"])


@query
def index_csv(spark, folder):
    return _line_records(spark, folder).select("l_orderkey", "l_linenumber", "line.*")


@query
def index_csv_headers(spark, folder):
    """Files of one folder under three headers: other orders, other names, quotes."""
    path = work_folder(spark, "csv")
    cells = views.delimited(spark, folder).select(
        F.col("l_orderkey").alias("order"), "l_linenumber",
        F.split("line", "#")[2].alias('the "status"'), F.col("l_partkey").alias("part, own"))
    place = F.col("l_linenumber") % 3
    for n, names in enumerate([cells.columns, cells.columns[::-1], cells.columns[:2]]):
        cells.where(place == n).select(*[F.col(f"`{c}`") for c in names]).write.csv(
            f"{path}/form={n}", sep=";", header=True, quote='"', escape='"')
    got = read_csv(spark, f"{path}/*", {
        "key.order": "order", "key.line": "l_linenumber", "status": 'the "status"',
        "part": "part, own"}, ";", {"key.order": "bigint", "key.line": "bigint", "part": "bigint"})
    return got.select("key.order", "key.line", "status", "part")


@query
def index_na_values(spark, folder):
    return _line_records(spark, folder, na_values=["A", "N"]).select(
        "l_orderkey", "l_linenumber", "line.flag", "line.status")


@query
def index_xml(spark, folder):
    df = views.table(spark, folder, "part").select("p_partkey", F.concat(
        F.lit("<entry><mat><comp>"), "p_type", F.lit("</comp></mat><size>"),
        F.col("p_size").cast("string"), F.lit("</size></entry>")).alias("document"))
    return extract.xml_records(df, F.col("document"), {
        "goods.kind": "mat.comp", "goods.size": "size", "goods.gone": "mat.gone",
    }, {"goods.size": "int"}, keep=["p_partkey"]).select("p_partkey", "goods.*")


@query
def index_yaml(spark, folder):
    df = views.table(spark, folder, "part").select("p_partkey", F.concat(
        F.lit("mat:\n  comp: '"), "p_type", F.lit("'\n  size: "),
        F.col("p_size").cast("string"), F.lit("\n")).alias("document"))
    return yaml_records(df, "document", {
        "goods.kind": "mat.comp", "goods.size": "mat.size",
        "goods.gone": "mat.gone"}, {"goods.size": "int"}, keep=["p_partkey"],
    ).select("p_partkey", "goods.*")


NAME_PATTERNS = {"page.number": r"^(\d+)", "page.kind": r"\.([a-z]+)", "page.view": r"page=\d+"}


def _page_fields(spark, folder):
    name = locations.file_name(F.col("url"))
    return extract.name_records(views.locations(spark, folder), name, NAME_PATTERNS,
                                keep=["page_id", "url"])


@query
def index_filename(spark, folder):
    return _page_fields(spark, folder).select("page_id", "page.*")


@query
def group_by_dir(spark, folder):
    files = _page_fields(spark, folder).select("url", "page.*")
    return extract.group_by_directory(files, "url", ["kind", "view"])


@query
def index_union(spark, folder):
    from_json = _document_records(spark, folder).select(
        "p_partkey", F.col("label.mark").alias("kind"), "packing.outer.units")
    from_csv = _line_records(spark, folder).select(
        F.col("l_partkey").alias("p_partkey"), F.col("line.flag").alias("kind"),
        "line.status")
    return extract.union_records(from_json, from_csv)


@query
def passthrough_filter(spark, folder):
    df = views.locations(spark, folder).withColumn("no_extract", F.when(
        F.col("page_id") % 3 != 0, F.col("page_id") % 2 == 0))
    return extract.extractable(df).select("page_id", "url")
