"""Registered queries against SQL where there is any, and their plans."""

import re

import pytest

from check import connect, oracle_rows, rows_of
from shelfmark.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    names, want = oracle_rows(connect(FOLDER), ORACLE[name])
    assert sorted(df.columns) == names
    assert rows_of(df.columns, df.collect()) == want


def test_rules_run_in_the_jvm_alone(spark):
    plan = QUERIES["op3_quality_rules"](spark, FOLDER)._jdf.queryExecution().executedPlan()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan.toString())


@pytest.mark.parametrize("name", ["op1_bpe", "op2_pii", "op5_decontamination", "op7_token_counts"])
def test_row_wise_operators_have_no_shuffle(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
