"""MERGE semantics against a model on Python dicts."""

import pytest
from helpers import frame, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedloom.operators import merge
from feedloom.operators.merge import merge_rows, s, t, take

SCHEMA = "k string, state string, v int"

KEY = st.sampled_from(["a", "b", "c", "d", None])
STATE = st.sampled_from(["PENDING", "APPROVED", None])
VALUE = st.one_of(st.none(), st.integers(0, 9))
ROW = st.tuples(KEY, STATE, VALUE)


def unique_keys(found):
    keys = [r[0] for r in found if r[0] is not None]
    return len(keys) == len(set(keys))


def model(target, source):
    by_key = {r[0]: r for r in source if r[0] is not None}
    known = {r[0] for r in target if r[0] is not None}
    out = []
    for k, state, v in target:
        new = by_key.get(k) if k is not None else None
        if new and state == "PENDING":
            out.append((k, state, new[2]))
        elif new and v == 0:
            out.append((k, "ZERO", v))
        else:
            out.append((k, state, v))
    out += [r for r in source if r[0] is None or r[0] not in known]
    return sorted(out, key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, max_size=6).filter(unique_keys), st.lists(ROW, max_size=6).filter(unique_keys))
def test_rules_insert_and_null_keys(spark, target, source):
    merged = merge_rows(
        frame(spark, SCHEMA, *target),
        frame(spark, SCHEMA, *source),
        ["k"],
        [(t("state") == "PENDING", take("v")), (t("v") == 0, {"state": F.lit("ZERO")})],
    )
    assert rows(merged) == model(target, source)


def test_two_source_rows_for_a_matched_key_fail(spark):
    merged = merge_rows(
        frame(spark, SCHEMA, ("a", "PENDING", 1)),
        frame(spark, SCHEMA, ("a", "x", 2), ("a", "x", 3)),
        ["k"],
        [(None, take("v"))],
    )
    with pytest.raises(PySparkException, match="several source rows"):
        merged.collect()


def test_two_source_rows_for_a_new_key_are_both_inserted(spark):
    merged = merge_rows(
        frame(spark, SCHEMA, ("a", "PENDING", 1)),
        frame(spark, SCHEMA, ("b", "x", 2), ("b", "x", 3)),
        ["k"],
        [(None, take("v"))],
    )
    assert rows(merged) == [("a", "PENDING", 1), ("b", "x", 2), ("b", "x", 3)]


def test_without_insert_unknown_rows_are_ignored(spark):
    merged = merge_rows(
        frame(spark, SCHEMA, ("a", "P", 1)), frame(spark, SCHEMA, ("a", "Q", 2), ("z", "Q", 3)), ["k"],
        [(None, {"v": s("v")})], insert=False,
    )
    assert rows(merged) == [("a", "P", 2)]


def test_merge_twice_changes_nothing(spark, sf):
    from feedloom.plans.fixtures import frame as derived

    old = derived(spark, sf, "audit_old")
    new = derived(spark, sf, "audit_new")
    once = merge.append_audit(old, new)
    assert rows(merge.append_audit(once, new)) == rows(once)


def test_hot_and_null_keys_plan_without_full_outer_join(spark):
    wide = spark.range(1000).select(F.lit(None).cast("string").alias("k"), F.lit("x").alias("state"), F.col("id").cast("int").alias("v"))
    merged = merge_rows(wide, wide, ["k"], [(None, take("v"))])
    assert "FullOuter" not in merged._jdf.queryExecution().executedPlan().toString()
    assert merged.count() == 2000


QUEUE = (
    "source_system string, local_column_name string, local_data_type string, local_sample_values array<string>, "
    "proposed_global_column_name string, proposed_match_type string, mapping_rationale string, confidence string, "
    "mandatory_flag boolean, mapping_version string, published_at timestamp, updated_at timestamp, "
    "review_status string, final_global_column_name string"
)


def test_upsert_queue_protects_reviewed_rows_and_counts_changes(spark):
    def row(name, status, proposed):
        return ("S", name, "int", ["1"], proposed, "DIRECT", "r", "HIGH", True, "v1", None, None, status, None)

    queue = frame(spark, QUEUE, row("a", "PENDING", "x"), row("b", "APPROVED", "x"))
    staged = frame(spark, QUEUE, *[row(n, None, "y") for n in "abc"]).drop("review_status", "final_global_column_name")
    merged = merge.upsert_queue(queue, staged, change_flag="changed")
    assert rows(merged, "local_column_name", "review_status", "proposed_global_column_name", "changed") == [
        ("a", "PENDING", "y", True), ("b", "APPROVED", "x", False), ("c", "PENDING", "y", True),
    ]


def test_deactivate_stale_with_empty_set_switches_off_the_source_only(spark):
    schema = "source_system string, local_column_name string, active_flag boolean, updated_at timestamp"
    dictionary = frame(spark, schema, ("A", "x", True, None), ("A", "y", False, None), ("B", "x", True, None))
    empty = frame(spark, "source_system string, local_column_name string")
    result = merge.deactivate_stale(dictionary, empty, "A")
    assert rows(result, "source_system", "local_column_name", "active_flag") == [
        ("A", "x", False), ("A", "y", False), ("B", "x", True),
    ]


def test_value_dictionary_keeps_human_entries(spark):
    schema = (
        "source_field string, source_system string, raw_value string, harmonized_value string, approval_status string, "
        "approved_by string, approved_at timestamp, mapping_version string, active_flag boolean, created_at timestamp, "
        "updated_at timestamp"
    )

    def row(raw, value, by):
        return ("f", "S", raw, value, "APPROVED", by, None, "v1", True, None, None)

    old = frame(spark, schema, row("a", "1", "auto:allowed-list"), row("b", "1", "person"), row("c", None, "person"))
    new = frame(spark, schema, *[row(raw, "2", "auto:allowed-list") for raw in "abcd"])
    merged = merge.merge_value_dictionary(old, new)
    assert rows(merged, "raw_value", "harmonized_value") == [("a", "2"), ("b", "1"), ("c", "2"), ("d", "2")]
