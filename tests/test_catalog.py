"""Versions, inheritance, organizations, access and curation on small tables."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import access, catalog, curation

TIME = [datetime(2020, 1, day) for day in (1, 2, 3)]


@pytest.fixture(scope="module")
def subs(spark):
    return spark.createDataFrame(
        [(1, "a", TIME[1], "x", 5), (2, "a", TIME[0], None, 6), (3, "a", TIME[1], "z", None),
         (4, "b", TIME[2], "y", 8)],
        "source_key int, source_name string, submission_time timestamp_ntz, organization string, "
        "size int")


@pytest.mark.parametrize("rows_per_task", [1, 10**6])
def test_versions(subs, rows_per_task):
    got = catalog.with_versions(subs, rows_per_task).select("source_key", "version", "source_id")
    assert sorted(map(tuple, got.collect())) == [
        (1, 2, "a_v2.1"), (2, 1, "a_v1.1"), (3, 3, "a_v3.1"), (4, 1, "b_v1.1")]


def test_latest(subs):
    got = catalog.latest_versions(subs, ["source_key"]).collect()
    assert sorted(map(tuple, got)) == [("a", 3, 3), ("b", 1, 4)]


def test_inherit_and_guard(spark, subs):
    new = spark.sql("""select * from values (1, 'a', 'own', cast(null as int), true),
        (2, 'a', null, 3, false), (3, 'c', null, null, null), (4, 'b', null, null, null)
        as t(k, source_name, organization, size, update)""")
    got = catalog.inherit(new, subs, ["organization", "size"]).select(
        "k", "previous_version", "organization", "size")
    assert sorted(map(tuple, got.collect())) == [
        (1, 3, "own", None), (2, 3, "z", 3), (3, None, None, None), (4, 1, "y", 8)]
    guarded = catalog.resubmission_errors(new, subs).collect()
    assert sorted(r["k"] for r in guarded if r["error"]) == [2, 4] and len(guarded) == 4


def test_metadata_updates(spark):
    entries = spark.sql("""select * from values ('a_v1.1', 7, false, 'SSS', 'old'),
        ('b_v1.1', 7, true, 'SPz', 'old'), ('c_v1.1', 8, false, 'SSF', 'old')
        as t(source_id, owner, active, status_code, title)""")
    updates = spark.sql("""select * from values ('a_v1.1', 7, 1, 'first'), ('a_v1.1', 7, 2, 'last'),
        ('a_v1.1', 9, 3, 'x'), ('b_v1.1', 7, 1, 'x'), ('c_v1.1', 8, 1, 'x')
        as t(source_id, requester, n, title)""")
    allowed = catalog.eligible_updates(updates, entries)
    assert sorted(r["n"] for r in allowed.collect()) == [1, 2]
    last = catalog.last_update(allowed, ["title"], F.col("n"))
    got = catalog.overlay_metadata(entries, last, ["title"]).select("source_id", "title")
    assert sorted(map(tuple, got.collect())) == [
        ("a_v1.1", "last"), ("b_v1.1", "old"), ("c_v1.1", "old")]


def test_organizations(spark, subs):
    registry = spark.sql("select explode(array('x', 'y', 'y')) as organization")
    got = catalog.registered_organizations(subs, registry)
    assert sorted((r["source_key"], r["organization"]) for r in got.collect()) == [
        (1, "x"), (2, None), (3, None), (4, "y")]
    parents = spark.sql("select * from values ('x', 'p'), ('p', 'q'), ('y', 'q') as t(org, parent)")
    got = catalog.with_ancestors(subs, parents)
    assert sorted(map(tuple, got.collect())) == [
        (1, "p"), (1, "q"), (1, "x"), (3, "z"), (4, "q"), (4, "y")]


def test_cycles_and_long_chains_of_parents(spark):
    parents = spark.sql("""select * from values ('x', 'y'), ('y', 'x'), ('a', 'x') as t(org, parent)
        union all select concat('c', id), concat('c', id + 1) from range(150)""")
    got = sorted(map(tuple, catalog.organization_ancestors(parents).collect()))
    assert [r for r in got if not r[0].startswith("c")] == [
        ("a", "x", 1), ("a", "y", 2), ("x", "x", 2), ("x", "y", 1), ("y", "x", 1), ("y", "y", 2)]
    assert len([r for r in got if r[0] == "c0"]) == 150


def walked(parent):
    """Every ancestor that a walk upwards meets before one repeats."""
    for org in parent:
        seen, at = [], parent[org]
        while at is not None and at not in seen:
            seen.append(at)
            at = parent.get(at)
        yield from ((org, a, n + 1) for n, a in enumerate(seen))


@pytest.mark.parametrize("seed", range(6))
def test_ancestors_as_walks_find_them(spark, seed):
    """Chains, trees, and cycles of one to many with tails that lead into them."""
    draw = random.Random(seed)
    n = draw.choice([1, 5, 30, 60])
    parent = {k: draw.choice([None, *range(n + 2)] if seed % 2 else [k + 1, max(0, k - 3)])
              for k in range(n)}
    rows = spark.createDataFrame(list(parent.items()), "org int, parent int")
    got = catalog.organization_ancestors(rows).collect()
    assert sorted(map(tuple, got)) == sorted(walked(parent))


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    rounds, kept = [], catalog.checkpointed

    def counting(df):
        rounds.append(1)
        return kept(df)
    monkeypatch.setattr(catalog, "checkpointed", counting)
    got = catalog.organization_ancestors(spark.range(1200).select(
        F.col("id").alias("org"), (F.col("id") + 1).alias("parent")))
    assert got.count() == 1200 * 1201 // 2 and len(rounds) <= 12
    assert got.agg(F.max("depth")).first()[0] == 1200


def test_lookup_numbers_one_name(spark, subs):
    rows = subs.withColumn("test", F.col("source_key") == 2)
    key = lambda sid: [r["source_key"] for r in catalog.by_source_id(rows, sid).collect()]
    assert key("a_v3.1") == [3] and key("_test_a_v1.1") == [2] and key("_test_a_v2.1") == []
    assert key("a_v9.1") == [] and key("no id") == []


def test_map_columns_pass_joins(spark, subs):
    new = spark.sql("select 1 as k, 'a' as source_name, map('s', 'p') as services, false as update, "
                    "cast(null as string) as organization, cast(null as int) as size")
    assert catalog.resubmission_errors(new, subs).count() == 1
    assert catalog.inherit(new, subs, ["organization", "size"]).first()["services"] == {"s": "p"}
    registry = spark.sql("select 'x' as organization")
    assert catalog.registered_organizations(new, registry).count() == 1


@pytest.fixture(scope="module")
def entries(spark):
    return spark.sql("""select * from values (1, null, null), (2, array('u1'), null),
        (3, array('g1'), array('u1', 'u2')), (4, array('g2'), array('public')), (5, array(), null)
        as t(id, acl, dataset_acl)""")


def test_visibility(spark, entries):
    who = spark.sql("select explode(array('u1', 'g9')) as principal")
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert ids(access.visible_entries(entries, who, "id")) == [1, 2, 3, 4, 5]
    assert ids(access.visible_records(entries, who, "id")) == [1, 2, 5]
    assert ids(access.not_public(entries)) == [2, 3, 4]
    holes = spark.sql("select 1 as id, array('u1', null) as acl, null as dataset_acl")
    assert ids(access.not_public(holes)) == [1]
    assert ids(access.visible_records(holes, who, "id")) == [1]


def test_curators(spark, entries):
    members = spark.sql("""select * from values ('u9', 'g1', 'manager'), ('u9', 'g2', 'member'),
        ('u8', 'g2', 'admin') as t(principal, group, role)""")
    who = spark.sql("select 'u9' as principal")
    identities = access.curation_identities(members, who)
    assert sorted(r[0] for r in identities.collect()) == ["g1", "u9"]
    got = access.curatable(entries, identities, "id")
    assert sorted(r["id"] for r in got.collect()) == [1, 3, 5]


def test_verdicts(spark):
    tasks = spark.sql("select explode(array('a', 'b', 'c')) as source_id")
    verdicts = spark.sql("""select * from values ('a', ' Accept\\n', '', 1), ('a', 'reject', 'no', 2),
        ('b', 'maybe', null, 1), ('c', 'REJECT', ' late ', 1), ('gone', 'accept', null, 1)
        as t(source_id, action, reason, n)""")
    got = curation.apply_verdicts(tasks, verdicts, "n").select("source_id", "action", "reason",
                                                              "outcome")
    assert sorted(map(tuple, got.collect())) == [
        ("a", "accept", "This submission has been accepted because it meets the appropriate "
                        "standards", "continues"),
        ("c", "reject", " late ", "failed")]
    unknown = curation.unknown_verdicts(verdicts, tasks).collect()
    assert [(r["source_id"], r["error"]) for r in unknown] == [("gone", "Curation task not found")]


def test_summary(spark):
    task = spark.sql("""select 'a_v1.1' as source_id, named_struct('submitter', 'Ada') as
        submission_info, timestamp_ntz'2020-02-11 01:00:00' as curation_start_date,
        '3 records' as extraction_summary""")
    assert curation.summaries(task).first()["summary"] == (
        "a_v1.1 by Ada\nWaiting since 2020-02-11T01:00:00Z\n3 records\n")
