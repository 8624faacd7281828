"""The matcher that learns from approved pairs."""

import pytest
from helpers import frame, rows

from feedloom.operators import learned
from feedloom.operators.learned import NO_MATCH, held_out_accuracy, learned_matches, name_features, shape_features
from feedloom.plans import property_model as M

COLUMNS = "local_column_name string, local_data_type string, sample_values array<string>"
PAIRS = COLUMNS + ", global_column_name string"


def pairs_of(spark, code):
    return frame(spark, PAIRS, *((name, kind.lower(), [], target) for name, kind, target in M.FEEDS[code]))


def no_vowels(name):
    return (name[0] + "".join(c for c in name[1:] if c not in "aeiou")).upper()


def test_features_of_names_and_samples(spark):
    found = frame(spark, "n string, s array<string>", ("Tipo_ab", ["A-12", "bc-3", None]), ("", []), (None, None), ("__", ["é 1"]))
    got = found.select("n", name_features("n").alias("f"), shape_features("s").alias("s")).collect()
    assert sorted(got[0]["f"]) == sorted(["^t", "ti", "ip", "po", "^ti", "tip", "ipo", "~^t", "~tp", "^a", "ab", "^ab", "~^a", "~ab"])
    assert [r["s"] for r in got] == [["#a-9"], [], [], ["#a 9"]]
    assert got[1]["f"] == [] and got[2]["f"] is None and got[3]["f"] == []


@pytest.mark.parametrize("code", ["ES", "IT"])
def test_abbreviated_names_without_a_glossary(spark, code):
    columns = frame(spark, PAIRS, *((no_vowels(n), kind.lower(), [], t) for n, kind, t in M.FEEDS[code]))
    found = learned_matches(columns, pairs_of(spark, code)).collect()
    right = [r for r in found if r["proposed"] == (r["global_column_name"] or NO_MATCH)]
    assert len(found) == 24 and len(right) >= 22


def test_odd_rows(spark):
    pairs = frame(spark, PAIRS, ("prima", "int", ["1"], "premium"), ("prima", "int", ["1"], "premium"), (None, "int", None, "premium"), ("zona", "string", None, None))
    columns = frame(spark, COLUMNS, ("prima", "int", ["7"]), ("prima", "int", ["8"]), (None, "int", None), ("", None, []), ("qqq", "string", None), ("ZONA", None, None))
    got = {(r["local_column_name"], r["proposed"]): r["score"] for r in learned_matches(columns, pairs).collect()}
    assert set(got) == {("prima", "premium"), (None, NO_MATCH), ("", NO_MATCH), ("qqq", NO_MATCH), ("ZONA", NO_MATCH)}
    assert got["prima", "premium"] > 0.7 and got["ZONA", NO_MATCH] > 0.5 and got["qqq", NO_MATCH] == 0.0
    assert learned_matches(columns, pairs).count() == 6
    assert {r["proposed"] for r in learned_matches(columns, pairs.limit(0)).collect()} == {NO_MATCH}
    assert learned_matches(columns.limit(0), pairs).collect() == []


def test_ties_go_to_the_first_target(spark):
    pairs = frame(spark, PAIRS, ("abc", "int", None, "second"), ("abc", "int", None, "first"))
    assert rows(learned_matches(frame(spark, COLUMNS, ("abc", "int", None)), pairs), "proposed") == [("first",)]


def test_a_group_is_not_matched_by_its_own_pairs(spark):
    table = frame(
        spark, "g string, " + PAIRS, ("a", "only_here", "int", None, "x"), ("a", "shared", "int", None, "y"), ("b", "shared", "int", None, "y"),
        ("b", "shared", "int", None, "y"), (None, "null_group", "int", None, "x"), ("b", "null_group", "int", None, "x"),
    )
    got = {r["g"]: (r["n_columns"], r["n_right"]) for r in held_out_accuracy(table, "g").collect()}
    assert got == {"a": (2, 1), "b": (3, 3), None: (1, 0)}


@pytest.mark.parametrize(("code", "other", "plain", "bare"), [("IT", "ES", 19, 18), ("ES", "IT", 21, 19)])
def test_a_source_in_a_language_that_no_pair_knows(spark, code, other, plain, bare):
    targets = frame(spark, PAIRS, *((t[0], t[1].lower(), [], t[0]) for t in M.TARGETS))
    pairs = pairs_of(spark, other).unionByName(targets)
    short = frame(spark, PAIRS, *((no_vowels(n), kind.lower(), [], t) for n, kind, t in M.FEEDS[code]))
    for columns, least in ((pairs_of(spark, code), plain), (short, bare)):
        assert sum(r["proposed"] == (r["global_column_name"] or NO_MATCH) for r in learned_matches(columns, pairs).collect()) >= least


def test_features_are_taken_of_different_names_only(spark, monkeypatch):
    """Rows that repeat a name, family and set of shapes reach the features as one."""
    seen = []
    described = learned._described
    monkeypatch.setattr(learned, "_described", lambda names: seen.append(names) or described(names))
    many = spark.range(400).selectExpr("concat('name_', id % 4) AS local_column_name", "'int' AS local_data_type", "array(cast(id AS string)) AS sample_values", "'t' AS global_column_name", "cast(id % 2 AS string) AS g")
    assert learned_matches(many, many).filter("proposed = 't'").count() == 400
    assert [(r["n_columns"], r["n_right"]) for r in held_out_accuracy(many, "g").collect()] == [(200, 200)] * 2
    assert [n.count() for n in seen] == [4, 4, 4, 4]
    # The features of a row's name are nowhere below a shuffle of rows: the plans read written names.
    assert all("Range" not in n._jdf.queryExecution().executedPlan().toString() for n in seen)
