"""Assembled submissions, routing, validation and JSON checks."""

import json

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.documents import (
    as_list, canonical_json, is_finite_json, is_finite_number, json_as_list, with_descriptions,
)
from shelfmark.operators import submission, validate
from shelfmark.sources.sinks import write_catalog, write_routed, write_submissions

EMPTY = {"dc": {}, "data_sources": [], "test": False, "update": False, "placement": {},
         "update_metadata_only": False}


def document(df, **kwargs):
    subs = submission.assemble(df)
    return json.loads(subs.select(submission.submission_json(subs, **kwargs)).first()[0])


def test_empty_submission(spark):
    assert document(spark.range(1)) == EMPTY


def test_empty_optional_blocks_are_left_out(spark):
    df = spark.sql("""select array() as tags, cast(map() as map<string,string>) as services,
        '{}' as mrr, '' as external_uri, false as curation, true as test, true as no_extract,
        array('x') as data_sources, map('partner', 'false', 'publish', '{"id": 5}') as projects,
        map('size', '5', 'name', '"n"') as custom, '{"group_by_dir": true}' as extraction_config,
        named_struct('organization', 'O', 'acl', array('me')) as placement""")
    assert document(df, placement_name="entry") == {
        "dc": {}, "data_sources": ["x"], "test": True, "update": False,
        "entry": {"organization": "O", "acl": ["me"]},
        "custom": {"size": 5, "name": "n"}, "projects": {"partner": False, "publish": {"id": 5}},
        "extraction_config": {"group_by_dir": True}, "no_extract": True,
        "update_metadata_only": False}


def test_metadata_update(spark):
    df = spark.sql("""select array('x') as data_sources, array('t') as tags, true as test,
        map('s', 'true') as services, 'https://e.org' as external_uri, array('g') dataset_acl""")
    update = submission.metadata_update(submission.assemble(df))
    got = json.loads(update.select(submission.submission_json(update)).first()[0])
    assert got == {"dc": {}, "placement": {}, "tags": ["t"], "external_uri": "https://e.org",
                   "dataset_acl": ["g"]}


def test_services(spark):
    df = spark.sql("""select 1 as id, map('a', cast(null as string), 'b', 'false',
        'c', '{"collection_id": 5}') as services""")
    got = submission.service_routes(df, ["id"]).collect()
    assert sorted(map(tuple, got)) == [(1, "a", "true"), (1, "c", '{"collection_id": 5}')]


def test_tests_are_never_public(spark):
    df = spark.sql("""select * from values ('a_v1.1', true, true), ('b_v1.1', false, null),
        ('c_v1.1', false, false) as t(source_id, test, public)""")
    got = submission.route_tests(df, "live", "sandbox").select(
        "routed_id", "search_index", "public").collect()
    assert list(map(tuple, got)) == [("_test_a_v1.1", "sandbox", False), ("b_v1.1", "live", True),
                                     ("c_v1.1", "live", False)]


def test_sinks(spark, tmp_path):
    df = spark.sql("select 'x' as external_uri union all select 'y'")
    write_submissions(submission.assemble(df), str(tmp_path / "json"))
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "json")).collect()]
    assert sorted(d["external_uri"] for d in lines) == ["x", "y"]
    routes = spark.sql("select * from values (1, 'a'), (2, 'a'), (3, 'b') as t(id, service)")
    write_routed(routes, str(tmp_path / "routes"), "service")
    only_a = spark.read.parquet(str(tmp_path / "routes" / "service=a"))
    assert sorted(r["id"] for r in only_a.collect()) == [1, 2]


@pytest.mark.parametrize("text, want", [
    ('{"a": 1}', True), ('{"a": NaN}', False), ('{"a": Infinity}', False), ('{"a": 1e400}', False),
    ('{"a": [0, {"b": -1e999}]}', False), ('{"a": "Infinity"}', True), ('{"a": "NaN"}', True),
    ('{"a": ["Infinity", 1e400]}', False), ('{"a": 1, "a": 2}', True), ("{", False), ("", False),
    ('{"a": 1e308}', True), (None, True),
])
def test_finite_json(rows, text, want):
    assert rows([(text,)], "t string", ok=is_finite_json(F.col("t"))) == [(want,)]


@pytest.mark.parametrize("number, want", [(1.5, True), (float("nan"), False),
                                          (float("-inf"), False), (None, True)])
def test_finite_number(rows, number, want):
    assert rows([(number,)], "x double", ok=is_finite_number(F.col("x"))) == [(want,)]


@pytest.mark.parametrize("text, want", [
    ('"a"', ["a"]), ('["a", "b"]', ["a", "b"]), ("5", ["5"]), ("[]", []), ("null", []),
    (None, None),
])
def test_json_as_list(rows, text, want):
    assert rows([(text,)], "t string", items=json_as_list(F.col("t"))) == [(want,)]


def test_as_list(spark):
    df = spark.sql("select 'a' as s, array('a', 'b') as l, cast(null as string) as n")
    columns = [as_list(F.col(f.name), f.dataType) for f in df.schema]
    assert tuple(df.select(*columns).first()) == (["a"], ["a", "b"], [])


def test_canonical_json(spark):
    df = spark.sql("""select named_struct('z', 1, 'a', array(named_struct('d', 1, 'c', 2))) as b,
        map('y', named_struct('q', 1, 'p', 2), 'x', named_struct('q', 3, 'p', 4)) as a""")
    text = df.select(canonical_json(df.schema, df.columns)).first()[0]
    want = {"a": {"x": {"p": 4, "q": 3}, "y": {"p": 2, "q": 1}},
            "b": {"a": [{"c": 2, "d": 1}], "z": 1}}
    assert text == json.dumps(want, separators=(",", ":"), sort_keys=True)


def test_descriptions_replace_older_ones(spark):
    got = spark.sql("select map('f', 'v', 'g', 'w', 'f_desc', 'old') c, map('f', 'new') d").select(
        with_descriptions(F.col("c"), F.col("d"))).first()[0]
    assert got == {"f": "v", "g": "w", "f_desc": "new"}


def test_rules_together(spark):
    df = spark.sql("""select * from values
        (1, array('t'), array('a'), array('https://a.b/c'), true, map('k', '1', 'k_desc', 'd')),
        (2, null, array(), array('globus://e/p'), false, map('k_desc', 'd')),
        (3, array('t'), array('a'), array('globus://e/p'), null, map('k', '1'))
        as t(id, title, authors, data_sources, no_extract, custom)""")
    checked = validate.with_errors(df, [
        validate.required_arguments(F.col("title"), F.col("authors")),
        validate.required_blocks(F.lit(True), F.col("data_sources"), F.lit(False)),
        validate.custom_keys(F.col("custom")),
        validate.described_fields(F.col("custom")),
        validate.passthrough_sources(F.col("no_extract"), F.col("data_sources")),
        validate.destinations(F.col("data_sources")),
    ])
    errors = {r["id"]: r["errors"] for r in checked.collect()}
    assert [len(errors[n]) for n in (1, 2, 3)] == [2, 2, 0]
    accepted, rejected = validate.split(checked)
    assert [r["id"] for r in accepted.collect()] == [3]
    assert sorted(r["id"] for r in rejected.collect()) == [1, 2]


@pytest.mark.parametrize("has_dc, sources, only, bad", [
    (True, ["x"], False, False), (True, [], False, True), (True, None, False, True),
    (False, ["x"], False, True), (False, None, True, False), (False, None, None, True),
])
def test_required_blocks(rows, has_dc, sources, only, bad):
    (error,), = rows([(has_dc, sources, only)], "d boolean, s array<string>, o boolean",
                     e=validate.required_blocks(F.col("d"), F.col("s"), F.col("o")))
    assert (error is not None) == bad


@pytest.mark.parametrize("action, want", [
    (" Accept ", None), ("REJECT", None), ("maybe", "Verdict 'maybe'"), (None, "Verdict ''")])
def test_verdict_error(rows, action, want):
    (error,), = rows([(action,)], "a string", e=validate.verdict_error(F.col("a")))
    assert error is None if want is None else error.startswith(want)


def test_finite_values_at_any_depth(spark):
    df = spark.sql("""select id, named_struct('x', x, 'in', array(map('k', named_struct('y', y))))
        as block from values (1, 1D, 2F), (2, double('NaN'), 2F), (3, 1D, float('-Infinity')),
        (4, null, null) as t(id, x, y)""")
    error = validate.finite_values("block", F.col("block"), df.schema["block"].dataType)
    assert [r["id"] for r in df.where(error.isNotNull()).collect()] == [2, 3]


def test_catalog_layout(spark, tmp_path):
    df = spark.range(2000).select(
        F.col("id").alias("source_key"), (F.col("id") % 10 == 0).alias("test"),
        F.format_string("n%04d", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))
        .alias("source_name"))
    path = str(tmp_path / "catalog")
    write_catalog(df, path)
    back = spark.read.schema(df.schema).parquet(path)
    assert back.count() == 2000
    plan = back.where("not test and source_name = 'n0007'")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(test" in plan.toString()
    assert "EqualTo(source_name,n0007)" in plan.toString()


def test_rows_of_a_single_file_are_dealt_out(spark, monkeypatch):
    from shelfmark.plans import queries, views
    folder = "/root/testdata/sf0.001"
    whole = sorted(map(str, queries.submission_json(spark, folder).collect()))
    assert views.dc_input(spark, folder).rdd.getNumPartitions() == 1
    monkeypatch.setattr(views, "ROWS_PER_TASK", 20, raising=False)
    dealt = queries.submission_json(spark, folder)
    assert dealt.rdd.getNumPartitions() > 1
    assert sorted(map(str, dealt.collect())) == whole
