"""Every registered query against its SQL, and the shape of its plan."""

import re

import oracle
import pytest

import __spark_entry__ as entry
from feedloom.plans.oracles import ORACLES as SQL
from feedloom.plans.queries import QUERIES

WRITERS = {
    "stream_ingest", "rescue_rows", "provenance", "write_monthly", "append_rows", "overwrite_slice", "read_answer_key",
    "log_run", "stream_counts", "header_drift", "distinct_sketches", "merge_candidates_buckets", "sync_decisions_buckets",
    "status_listing", "value_prompts", "propose_run", "dictionary_run", "publish_run", "publish_checks", "parts_by_source",
    "parts_all_dimensions", "parts_loss_ratio_last3m", "parts_top_channel", "view_positions",
}


@pytest.fixture(scope="module")
def connection(sf):
    return oracle.duck(sf)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, connection, sf, name):
    assert oracle.compare(spark, connection, name, QUERIES[name], SQL[name], sf) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_plan_has_no_pair_join_and_no_python(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas|ExistingRDD", plan)


def test_entry_returns_both_countries(spark):
    assert {row["country"] for row in entry.entry(spark).collect()} == {"ES", "IT"}
