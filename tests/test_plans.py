"""What the physical plans of the registered queries must and must not hold."""

import re

import pytest

from shelfmark.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
STREAMS = {"stream_current_status", "stream_fold", "stream_draft"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_slow_nodes(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan
    python = re.findall(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups\w+", plan)
    assert python == (["MapInPandas"] if name in ("index_yaml", "index_by_submission") else [])


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["version_number"](spark, FOLDER))
    assert all(set(re.findall(r"o_\w+", schema)) <= {"o_orderkey", "o_custkey", "o_orderdate"}
               for schema in re.findall(r"ReadSchema: struct<[^>]*>", plan))


def test_filters_on_a_plain_column_are_pushed(spark):
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,250000.0)]" in \
        plan_of(QUERIES["f_gt"](spark, FOLDER))


@pytest.mark.parametrize("name, shuffles", [
    ("f_all", 0), ("status_word", 0), ("dc_block", 0), ("submission_json", 0), ("index_csv", 0),
    ("v_finite", 0), ("fold_last", 1), ("fold_upsert", 1), ("fold_delete", 1),
    ("latest_version", 1), ("group_by_dir", 1), ("service_routing", 1), ("org_registry", 1),
])
def test_number_of_shuffles(spark, name, shuffles):
    df = QUERIES[name](spark, FOLDER)
    assert len(re.findall(r"Exchange (?:hash|range|round)", plan_of(df))) == shuffles


def test_versions_need_one_shuffle_when_no_name_is_heavy(spark):
    df = QUERIES["version_number"](spark, FOLDER)
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 1 and "Join" not in final
