"""Decisions, audit, gate and listings on small tables."""

import random

import pytest
from helpers import frame, rows
from pyspark.sql import functions as F

from feedloom.operators import gate, review, summaries

QUEUE = (
    "source_system string, local_column_name string, proposed_global_column_name string, proposed_match_type string, "
    "review_status string, final_global_column_name string, final_match_type string, reviewed_by string, "
    "reviewed_at timestamp, review_comment string, updated_at timestamp, mandatory_flag boolean"
)
DECISION = (
    "source_system string, local_column_name string, seq bigint, action string, action_by string, "
    "final_global string, final_match_type string, comment string"
)


def queued(name, status="PENDING", final=None, proposed="t"):
    return ("S", name, proposed, "DIRECT", status, final, None, None, None, None, None, True)


def decision(name, seq, action, final=None, comment=""):
    return ("S", name, seq, action, "u", final, "DERIVED" if action == "CORRECT" else None, comment)


@pytest.mark.parametrize(
    "action,final,comment,expected",
    [
        ("APPROVE", None, "", ("APPROVED", "t", "DIRECT")),
        ("CORRECT", "other", "", ("CORRECTED", "other", "DERIVED")),
        ("REJECT", None, "why", ("REJECTED", None, None)),
        ("RESET", None, "", ("PENDING", None, None)),
        ("REJECT", None, " \t", ("APPROVED", "old", None)),
        ("CORRECT", None, "", ("APPROVED", "old", None)),
        ("ARCHIVE", None, "", ("APPROVED", "old", None)),
        (None, None, "", ("APPROVED", "old", None)),
    ],
)
def test_state_machine(spark, action, final, comment, expected):
    queue = frame(spark, QUEUE, queued("a", "APPROVED", "old"))
    decisions = frame(spark, DECISION, decision("a", 1, action, final, comment))
    after = review.apply_decisions(queue, decisions)
    assert rows(after, "review_status", "final_global_column_name", "final_match_type") == [expected]
    invalid = expected == ("APPROVED", "old", None)
    assert (review.rejected_decisions(decisions, queue).count() == 1) == invalid
    assert review.audit_rows(queue, decisions).count() == (0 if invalid else 1)


def test_unknown_key_is_not_applied(spark):
    queue = frame(spark, QUEUE, queued("a"))
    decisions = frame(spark, DECISION, decision("z", 1, "APPROVE"))
    assert rows(review.apply_decisions(queue, decisions), "review_status") == [("PENDING",)]
    assert rows(review.rejected_decisions(decisions, queue), "reject_reason") == [("not in the queue",)]
    assert review.audit_rows(queue, decisions).count() == 0


@pytest.mark.parametrize("width", [2, 7, 1000])
def test_audit_equals_one_decision_after_the_other(spark, width):
    rng = random.Random(width)
    names = ["a", "b", "hot"]
    start = {n: ["PENDING", None] for n in names}
    decisions = []
    for seq in range(-5, 60):
        name = rng.choice(["hot", "hot", "hot", "a", "b"])
        action = rng.choice(["APPROVE", "CORRECT", "REJECT", "RESET", "BAD"])
        decisions.append(decision(name, seq, action, f"g{seq}" if rng.random() < 0.8 else None, rng.choice(["", "c"])))
    expected = []
    state = {n: list(v) for n, v in start.items()}
    for _, name, seq, action, _, final, _, comment in decisions:
        if action == "BAD" or (action == "REJECT" and not comment) or (action == "CORRECT" and final is None):
            continue
        status = {"APPROVE": "APPROVED", "CORRECT": "CORRECTED", "REJECT": "REJECTED", "RESET": "PENDING"}[action]
        new = {"APPROVE": "t", "CORRECT": final}.get(action)
        old_status, old_final = state[name]
        expected.append((name, seq, old_status, status, old_final if old_final is not None else "t", new))
        state[name] = [status, new]
    queue = frame(spark, QUEUE, *[queued(n) for n in names])
    batch = frame(spark, DECISION, *decisions)
    audit = review.audit_rows(queue, batch, width=width)
    got = rows(
        audit, "local_column_name", "seq", "old_review_status", "new_review_status", "old_global_column_name",
        "new_global_column_name",
    )
    assert got == sorted(expected, key=repr)
    after = review.apply_decisions(queue, batch)
    assert {r[0]: list(r[1:]) for r in rows(after, "local_column_name", "review_status", "final_global_column_name")} == state


def test_decide_from_key_only_touches_pending(spark):
    queue = frame(spark, QUEUE, queued("same", proposed="T"), queued("other"), queued("none"), queued("done", "APPROVED"))
    key = frame(
        spark, "source_system string, local_column_name string, expected_global_column_name string",
        ("S", "same", "t"), ("S", "other", "x"), ("S", "none", None), ("S", "done", "x"),
    )
    made = review.decide_from_key(queue, key, "reader")
    assert rows(made, "local_column_name", "action", "final_global") == [
        ("none", "REJECT", None), ("other", "CORRECT", "x"), ("same", "APPROVE", None),
    ]
    assert review.rejected_decisions(made, queue).count() == 0


def test_bulk_variants(spark):
    schema = QUEUE + ", ai_error_status string"
    candidates = frame(
        spark, schema, (*queued("ok"), None), (*queued("err"), "AI_ERROR"), (*queued("none", proposed="no_match"), None),
        (*queued("done", "REJECTED"), None),
    )
    strict = review.bulk_approve(candidates, "u")
    loose = review.bulk_approve(candidates, "u", mandatory_only=False)
    one = review.bulk_approve(candidates, "u", only=F.col("local_column_name") == "err")
    approved = lambda df: [r[0] for r in rows(df.filter("review_status = 'APPROVED'"), "local_column_name")]
    assert approved(strict) == ["ok"]
    assert approved(loose) == ["none", "ok"]
    assert approved(one) == ["err"]


GATE = (
    "source_system string, local_column_name string, mandatory_flag boolean, review_status string, "
    "final_global_column_name string"
)


def test_gate_lists_every_reason(spark):
    candidates = frame(
        spark, GATE, ("S", "p", True, "PENDING", None), ("S", "n", True, "APPROVED", "No_Match"),
        ("S", "e", True, "REJECTED", ""), ("S", "ok", True, "APPROVED", "x"), ("S", "opt", False, "PENDING", None),
        ("S", "unflagged", None, "APPROVED", "x"),
    )
    declared = frame(
        spark, "source_system string, local_column_name string", ("S", "p"), ("S", "ok"), ("S", "absent"), ("S", "unflagged")
    )
    assert rows(gate.review_gate(candidates, declared), "local_column_name", "reason") == [
        ("absent", "MISSING"), ("e", "NO_TARGET"), ("n", "NO_TARGET"), ("p", "PENDING"), ("unflagged", "MISSING"),
    ]
    with pytest.raises(gate.GateBlocked, match="5 mandatory columns"):
        gate.enforce_gate(candidates, declared)
    gate.enforce_gate(candidates.filter("local_column_name = 'ok'"), declared.filter("local_column_name = 'ok'"))


def test_publish_ready_is_true_without_mandatory_rows(spark):
    candidates = frame(spark, GATE, ("S", "opt", False, "PENDING", None))
    assert rows(gate.publish_ready(candidates)) == [(True,)]
    assert rows(gate.publish_ready(candidates.limit(0))) == [(True,)]


def test_gate_variants_differ_on_approved_without_target(spark):
    candidates = frame(spark, GATE, ("S", "n", True, "APPROVED", None)).withColumns(
        {c: F.lit(None).cast("string") for c in ("proposed_global_column_name", "confidence", "ai_error_status")}
    )
    assert gate.gate_preview(candidates).count() == 0
    assert gate.gate_no_target(candidates).count() == 1


def test_coverage_of_empty_queue_is_zero(spark):
    empty = frame(spark, GATE)
    assert rows(summaries.review_coverage(empty), "total", "coverage") == [(0, 0.0)]


def test_status_columns_lists_all_names_on_one_row(spark):
    schema = "source_system string, local_column_name string, review_status string, mandatory_flag boolean"
    candidates = frame(spark, schema, *[("S", f"c{i:03}", "PENDING", None) for i in range(200)])
    (listed,) = summaries.status_columns(candidates).collect()
    assert listed["count"] == 200 and listed["columns"] == [f"c{i:03}" for i in range(200)]


def test_view_order_puts_medium_before_low_before_high(spark):
    schema = "mandatory_flag boolean, confidence string, local_column_name string"
    shown = review.in_view_order(
        frame(spark, schema, (True, "HIGH", "a"), (True, "LOW", "b"), (True, "MEDIUM", "c"), (False, "LOW", "d")),
        "pending_view",
    )
    assert [r["local_column_name"] for r in shown.collect()] == ["c", "b", "a", "d"]
