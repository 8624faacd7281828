"""Matching, values, projection, quality, evaluation, metrics, security: the cases that are easy to get wrong."""

import datetime as dt
import re

import pytest
from helpers import frame, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedloom.functions.text import fill_template
from feedloom.operators import dictionary, evaluate, harmonize, match, metrics, ops, profile, quality, security, values
from feedloom.plans import flows
from feedloom.plans import property_model as M
from feedloom.plans.fixtures import frame as derived
from feedloom.schemas import empty_table, financial_columns, target_model

# Profiling


def smallest(column_values, k):
    return sorted(set(v for v in column_values if v is not None))[:k]


def test_sample_values_are_exact(spark):
    n = 300
    base = spark.range(n, numPartitions=4).select(
        (F.lit(n) - F.col("id")).alias("falling"),
        (F.col("id") % 3).cast("int").alias("few"),
        F.when(F.col("id") == n - 1, "a").otherwise(F.concat(F.lit("v"), (F.col("id") % 10).cast("string"))).alias("text"),
        (F.col("id") / 4).alias("real"),
        F.when(F.col("id") > 5, -0.0).otherwise(0.0).alias("zero"),
        F.lit(None).cast("string").alias("empty"),
        F.date_add(F.lit(dt.date(2025, 1, 1)), F.col("id").cast("int")).alias("day"),
        (F.col("id") % 20).cast("decimal(10,1)").alias("dec"),
    )
    found = {r["column_name"]: r["sample_values"] for r in profile.sample_values(base, 5).collect()}
    assert found["falling"] == ["1", "2", "3", "4", "5"]
    assert found["few"] == ["0", "1", "2"]
    assert found["text"] == ["a", "v0", "v1", "v2", "v3"]
    assert found["real"] == ["0.0", "0.25", "0.5", "0.75", "1.0"]
    assert found["zero"] == ["0.0"]
    assert "empty" not in found
    assert found["day"][:2] == ["2025-01-01", "2025-01-02"]
    assert found["dec"] == smallest([f"{i}.0" for i in range(20)], 5)


def test_inventory_has_gaps_for_metadata_columns(spark):
    df = frame(spark, "a int, _source_file string, b string", (1, "f", None))
    found = profile.inventory_columns(df, "S", "t")
    assert rows(found, "local_column_name", "ordinal_position", "sample_values") == [("a", 1, ["1"]), ("b", 3, [])]


def test_required_profile_exact_and_sketch(spark):
    df = frame(spark, "g string, a int, b string, c double", ("x", 1, "p", None), ("x", 1, "q", 2.0), ("y", None, "q", 2.0))
    exact = profile.required_profile(df, ["a", "b", "c", "absent"], by=["g"])
    assert rows(exact, "g", "row_count", "distinct_a", "distinct_b", "distinct_c") == [("x", 2, 1, 2, 1), ("y", 1, 0, 1, 1)]
    near = profile.required_profile(df, ["a", "b"], by=["g"], approximate=0.05)
    assert rows(near, "g", "row_count", "distinct_b") == [("x", 2, 2), ("y", 1, 1)]


def test_required_profile_counts_few_columns_at_once(spark):
    df = frame(
        spark,
        "g string, b string, n int, c double, d double, e double, f boolean, harmonization_timestamp timestamp",
        ("x", None, 1, 0.0, float("nan"), 1.5, True, dt.datetime(2030, 1, 1)),
        ("x", None, 1, -0.0, float("nan"), None, False, dt.datetime(2030, 1, 3)),
        (None, "p", None, None, 2.0, None, None, None),
        ("y", None, None, None, None, None, None, dt.datetime(2030, 1, 2)),
    ).withColumn("e", F.col("e").cast("float"))
    columns = ["b", "n", "c", "d", "e", "f"]
    found = profile.required_profile(df, columns, by=["g"])
    assert rows(found, "g", "row_count", *[f"distinct_{c}" for c in columns], "latest_harmonization") == sorted(
        [
            ("x", 2, 0, 1, 1, 1, 1, 2, dt.datetime(2030, 1, 3)),
            (None, 1, 1, 0, 0, 1, 0, 0, None),
            ("y", 1, 0, 0, 0, 0, 0, 0, dt.datetime(2030, 1, 2)),
        ],
        key=repr,
    )
    whole = profile.required_profile(df, columns)
    assert rows(whole, "row_count", *[f"distinct_{c}" for c in columns]) == [(4, 1, 1, 1, 2, 1, 2)]
    # A shuffled row holds one value and its column's place, and real numbers are shuffled two columns at a time.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    arrays = re.findall(r"Generate posexplode\(array\((.*)\)\)", plan)
    assert len(arrays) == 4 and "inline" not in plan


def test_required_profile_without_rows(spark):
    empty = frame(spark, "g string, a int, b double")
    assert rows(profile.required_profile(empty, ["a", "b"], by=["g"])) == []
    assert rows(profile.required_profile(empty, ["a", "b"])) == [(None, 0, 0)]


# Matching


def test_template_errors_and_null_text(spark):
    with pytest.raises(ValueError, match="unknown placeholder"):
        fill_template("${nope}", context="", target_columns=[], reply_keys=[])
    with pytest.raises(ValueError, match="built in"):
        fill_template("x", context="", target_columns=[], reply_keys=[], extra={"context": "y"})
    columns = frame(spark, "local_column_name string, local_data_type string, sample_values array<string>",
                    ("it's", "int", ["a", "b"]), ("n", None, []))
    made = match.prompt_text(columns, context="c", target_columns=["t"],
                             template="${local_column_name}|${local_data_type}|${sample_values}|${target_columns}")
    assert rows(made, "prompt") == [("it's|int|a; b|t, NO_MATCH",), (None,)]


@pytest.mark.parametrize(
    "text,target,error",
    [
        ('{"global_column_name": "a", "confidence": "LOW"}', "a", None),
        ('```json\n{"global_column_name": "a"}\n```', "a", None),
        (None, None, "AI_ERROR"),
        ("", None, "AI_ERROR"),
        ("   ", None, "AI_ERROR"),
        ("{broken", None, "AI_ERROR"),
        ('{"global_column_name": "a", oops}', None, "AI_ERROR"),
        ('"text"', None, "AI_ERROR"),
        ('["a"]', None, "AI_ERROR"),
        ('{"confidence": "HIGH"}', None, "AI_ERROR"),
        ('{"global_column_name": null}', None, "AI_ERROR"),
        ('{"global_column_name": ""}', "", "AI_ERROR"),
        ('{"global_column_name": 7}', "7", None),
    ],
)
def test_parse_reply(spark, text, target, error):
    got = rows(match.parse_reply(frame(spark, "reply string", (text,))), "proposed_global_column_name", "ai_error_status")
    assert got == [(target, error)]


def test_matcher_reproduces_the_answer_keys(spark, sf):
    from feedloom.plans.queries import propose_feeds

    found = propose_feeds(spark, sf).collect()
    wrong = [r["local_column_name"] for r in found if not r["correct"]]
    assert len(found) == 48 and wrong == ["codice_agenzia_interno"]
    assert all(r["correct"] for r in found if r["confidence"] != "LOW")


def test_example_of_another_source_is_proposed_without_shared_token(spark):
    inventory = frame(spark, "source_system string, local_column_name string, local_data_type string, sample_values array<string>",
                      ("S", "qqq", "string", []), ("S", "zzz", "string", None), ("S", "CurrencyCode", "string", []))
    examples = frame(spark, "local_column_name string, global_column_name string", ("qqq", "region"))
    got = rows(match.propose_mappings(inventory, M.targets(spark), M.glossary(spark), examples),
               "local_column_name", "proposed_global_column_name", "proposed_match_type")
    assert got == [("CurrencyCode", "currency", "DIRECT"), ("qqq", "region", "SEMANTIC_TRANSLATION"), ("zzz", "NO_MATCH", "NO_MATCH")]


def test_staged_ids_are_stable(spark):
    proposals = frame(spark, "source_system string, local_column_name string", ("S", "a"), ("S", "b"))
    one, two = (match.stage_candidates(proposals.orderBy(F.desc("local_column_name")), ["a"]) for _ in range(2))
    assert rows(one, "candidate_id", "mandatory_flag") == rows(two, "candidate_id", "mandatory_flag")
    assert one.filter("review_status = 'PENDING' AND final_global_column_name IS NULL").count() == 2


# Values


def test_values_outside_the_list_and_bad_replies(spark):
    allowed = frame(spark, "source_field string, allowed_value string", ("f", "A"), ("f", "B"), ("g", "A"))
    replies = frame(spark, "source_field string, reply string", ("f", 'x {"a": "A", "b": "Z", "c": null} y'), ("g", "none"),
                    ("h", '{"a": "A"}'))
    assert rows(values.parse_value_reply(replies, allowed)) == [
        ("f", "a", "A", None), ("f", "b", None, None), ("f", "c", None, None), ("g", None, None, "AI_ERROR"),
        ("h", "a", None, None),
    ]


def test_proposed_codes(spark):
    found = frame(spark, "source_system string, source_field string, raw_value string",
                  ("S", "f", " a "), ("S", "f", "Uno"), ("S", "f", "dos"), ("S", "f", "x"))
    allowed = frame(spark, "source_field string, allowed_value string", ("f", "A"), ("f", "B"))
    glossary = frame(spark, "source_field string, raw_value string, code string", ("f", "uno", "B"), ("f", "dos", "C"))
    staged = values.stage_value_candidates(values.propose_values(found, allowed, glossary))
    assert rows(staged, "raw_value", "final_harmonized_value", "review_status", "confidence", "reviewed_by") == [
        (" a ", "A", "APPROVED", "HIGH", "auto:allowed-list"), ("Uno", "B", "APPROVED", "HIGH", "auto:allowed-list"),
        ("dos", None, "PENDING", "LOW", None), ("x", None, "PENDING", "LOW", None),
    ]
    assert staged.filter("review_status = 'PENDING' AND reviewed_at IS NOT NULL").count() == 0


ENTRY = "source_system string, source_field string, raw_value string, harmonized_value string, active_flag boolean"


def test_translation_changes_only_known_values(spark):
    facts = frame(spark, "source_system string, f string, g string, mapping_status string",
                  ("S", "a", "a", "s"), ("S", "zz", None, "s"), ("T", "a", "b", "s"), (None, "a", "b", "s"))
    entries = frame(spark, ENTRY, ("S", "f", "a", "A", True), ("T", "f", "a", "AT", True), ("S", "g", "a", "G", True),
                    ("S", "f", "zz", "off", False))
    got = values.translate_values(facts, entries, ["f", "g"])
    assert rows(got, "source_system", "f", "g") == [("S", "A", "G"), ("S", "zz", None), ("T", "AT", "b"), (None, "a", "b")]
    assert rows(got, "source_system", "mapping_status") == [("S", "APPROVED_COLUMN_AND_VALUE_MAPPING")] * 2 + [
        ("T", "APPROVED_COLUMN_AND_VALUE_MAPPING"), (None, "s")]
    unchanged = values.translate_values(facts, entries.filter("not active_flag"), ["f"])
    assert rows(unchanged) == rows(facts)


def test_two_codes_for_one_value_fail_where_a_row_holds_it(spark):
    entries = frame(spark, ENTRY, ("S", "f", "a", "A", True), ("S", "f", "a", "B", True), ("S", "f", "b", None, True), ("S", "f", "b", "B", True))
    other = frame(spark, "source_system string, f string", ("S", "b"))
    assert rows(values.translate_values(other, entries, ["f"])) == [("S", "B")]
    with pytest.raises(PySparkException, match="two active translations"):
        values.translate_values(frame(spark, "source_system string, f string", ("S", "a")), entries, ["f"]).collect()


def test_entries_of_one_source_leave_the_other_alone(spark):
    facts = frame(spark, "source_system string, f string, mapping_status string", ("S", "a", "s"), ("T", "a", "s"))
    got = values.translate_values(facts, frame(spark, ENTRY, ("S", "f", "a", "A", True)), ["f"])
    assert rows(got) == [("S", "A", "APPROVED_COLUMN_AND_VALUE_MAPPING"), ("T", "a", "s")]


def test_value_prompt_is_one_row_per_column_with_every_value(spark):
    found = frame(spark, "source_field string, raw_value string", *[("f", f"v{i:03}") for i in range(1000)] * 2)
    allowed = frame(spark, "source_field string, allowed_value string", ("f", "B"), ("f", "A"))
    (prompt,) = values.value_prompt(found, allowed).collect()
    assert "A, B" in prompt["prompt"] and all(prompt["prompt"].count(f"v{i:03}") == 1 for i in range(1000))


def test_values_of_failed_and_partial_replies_stay_candidates(spark):
    columns = "source_system string, source_field string"
    found = frame(spark, columns + ", raw_value string", ("S", "f", "a"), ("S", "f", "b"), ("S", "g", "c"), ("S", "h", "d"))
    replies = frame(spark, columns + ", reply string", ("S", "f", 'x {"a": "A", "made up": "A"}'), ("S", "g", "no object"))
    allowed = frame(spark, "source_field string, allowed_value string", ("f", "A"), ("g", "A"))
    staged = values.stage_value_candidates(values.replied_values(found, replies, allowed))
    assert rows(staged, "source_field", "raw_value", "final_harmonized_value", "review_status", "ai_error_status") == [
        ("f", "a", "A", "APPROVED", None), ("f", "b", None, "PENDING", None),
        ("g", "c", None, "PENDING", "AI_ERROR"), ("h", "d", None, "PENDING", "AI_ERROR"),
    ]


# Projection


def test_projection_rules(spark):
    feed = frame(spark, "b string, a string, unmapped string, _source_file string", ("1", "x", "u", "f"))
    entries = frame(
        spark, "source_system string, local_column_name string, global_column_name string, active_flag boolean",
        ("S", "b", "n", True), ("S", "a", "n", True), ("S", "absent", "m", True), ("S", "unmapped", "no_match", True),
        ("S", "_source_file", "m", True), ("T", "b", "m", True), ("S", "b2", "k", False),
    )
    assert harmonize.resolve_columns(feed, entries, "S") == {"n": "a"}
    model = {"n": "INT", "m": "STRING"}
    with pytest.raises(PySparkException):
        harmonize.project(feed, {"n": "a"}, model).collect()
    soft = harmonize.project(feed, {"n": "a", "extra": "b"}, model, on_error="null")
    assert soft.columns == ["n", "m", "extra"] and rows(soft) == [(None, None, "1")]
    with pytest.raises(ValueError, match="no active"):
        harmonize.harmonize(feed, entries, model, source_country="x", source_system="X", mapping_version="v")


def test_mapping_report_names_every_column(spark):
    inventory = frame(spark, "source_system string, local_column_name string", ("S", "a"), ("S", "b"), ("S", "c"))
    entries = frame(
        spark, "source_system string, local_column_name string, global_column_name string, active_flag boolean",
        ("S", "a0", "n", True), ("S", "a", "n", True), ("S", "b", "n", True),
    )
    assert rows(harmonize.mapping_report(inventory, entries), "local_column_name", "column_status") == [
        ("a", "MAPPED"), ("a0", "NOT_IN_FEED"), ("b", "SKIPPED_DUPLICATE"), ("c", "NOT_MAPPED"),
    ]


def test_corrected_without_final_is_left_out(spark):
    schema = (
        "source_system string, source_table string, local_column_name string, local_data_type string, review_status string, "
        "proposed_global_column_name string, final_global_column_name string, proposed_match_type string, "
        "final_match_type string, reviewed_by string, reviewed_at timestamp, review_comment string"
    )

    def row(name, status, proposed, final):
        return ("S", "t", name, "int", status, proposed, final, "DIRECT", None, None, None, None)

    candidates = frame(spark, schema, row("a", "CORRECTED", "p", None), row("b", "APPROVED", "p", None),
                       row("c", "APPROVED", "p", "NO_match"), row("d", "REJECTED", "p", "x"), row("e", "CORRECTED", "p", "x"))
    staged = dictionary.stage_dictionary(dictionary.resolve_dictionary(candidates), "v1")
    assert rows(staged, "local_column_name", "global_column_name", "approved_by") == [("b", "p", "system"), ("e", "x", "system")]


# Quality


def test_checks_never_count_null_and_survive_broken_rules(spark):
    df = frame(spark, "a int, c string, mapping_status string", (1, "x", None), (None, None, "bad"), (3, "y", "APPROVED_COLUMN_MAPPING"))
    checks = quality.quality_checks(
        df, required=["a", "gone"], allowed={"c": ["x"], "lost": ["p", "q"]},
        rules=[quality.Rule("big", "a > 2", "WARNING"), quality.Rule("broken", "nope > 1"), quality.Rule("number", "a + 1")],
    )
    assert {r[0]: r[1:] for r in rows(checks, "check_name", "check_status", "metric_value")} == {
        "not_null_a": ("FAILED", 1.0), "not_null_gone": ("FAILED", 0.0), "values_in_allowed_list_c": ("WARNING", 1.0),
        "values_in_allowed_list_lost": ("WARNING", 2.0), "big": ("WARNING", 1.0), "broken": ("FAILED", 0.0),
        "number": ("FAILED", 0.0), "column_mapping_version_present": ("WARNING", 1.0),
    }
    with pytest.raises(ValueError):
        quality.Rule("x", "true", "INFO")


def test_rules_that_stop_at_run_time_are_isolated_in_one_pass(spark):
    df = frame(spark, "a int, t string, s string", (0, "x", "S"), (1, "2", "S"), (None, None, "R"))
    rules = [
        quality.Rule("ok", "a > 0"), quality.Rule("cast", "cast(t AS int) > 1"), quality.Rule("unresolved", "zz > 1"),
        quality.Rule("half", "1 / a > 0"), quality.Rule("other_half", "1 / a > 5"), quality.Rule("sum", "a + 2147483647 > 0"),
        quality.Rule("whole", "3 div a > 0"), quality.Rule("decided", "a = 0 OR 1 / a > 5"), quality.Rule("sparing", "a <> 0 AND 1 / a > 5"),
        quality.Rule("raised", "if(a = 0, raise_error('no'), true)"), quality.Rule("place", "element_at(array(1), a + 1) = 1"),
    ]
    assert quality.failing_rules(df, rules) == {"cast": 1, "half": 1, "other_half": 1, "sum": 1, "whole": 1, "raised": 1, "place": 1}
    checks = quality.quality_checks(df, rules=rules, by=["s"], sources=frame(spark, "s string", ("S",), ("R",), ("none",)))
    found = {(r["s"], r["check_name"]): (r["check_status"], r["metric_value"]) for r in checks.collect()}
    for source, violations in (("S", 1.0), ("R", 0.0), ("none", 0.0)):
        assert found[source, "ok"] == ("FAILED" if violations else "PASSED", violations)
        for name in ("cast", "unresolved", "half", "other_half", "sum", "raised", "place"):
            assert found[source, name] == ("FAILED", 0.0)
    fresh = quality.quality_checks(df, rules=rules, by=["s"])
    assert fresh._jdf.queryExecution().executedPlan().toString().count("Scan ") == 1
    text = checks.filter("check_name = 'half' AND s = 'none'").first()["details"]
    assert text == "predicate failed to evaluate: stops on 1 rows"


def test_sums_are_exact_and_free_of_order(spark):
    import math
    import random
    from fractions import Fraction

    from feedloom.operators.metrics import total

    r = random.Random(4)
    groups = {
        "money": [r.uniform(-1e6, 1e6) for _ in range(500)],
        "huge": [9e17] * 200,
        "cancel": [1e25, 0.1, -1e25, 2.0**-20, 3e7, -5.25],
        "negative": [-r.uniform(0, 1e12) for _ in range(99)],
        "one": [-0.3],
        "none": [None],
    }
    data = [(g, x) for g, values in groups.items() for x in values] + [("nan", 1.0), ("nan", float("nan")), ("inf", float("inf")), ("inf", 2.0), ("wild", 1e200), ("wild", 1e200)]
    results = []
    for seed, parts in ((1, 1), (2, 7)):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "g string, x double").repartition(parts)
        results.append({row["g"]: row["s"] for row in df.groupBy("g").agg(F.expr(total("x")).alias("s")).collect()})
    for g, values in groups.items():
        if g != "none":
            exact = float(sum(map(Fraction, values)))
            assert abs(results[0][g] - exact) <= math.ulp(exact)
    assert results[0]["none"] is None and math.isnan(results[0].pop("nan")) and results[0]["inf"] == float("inf") and results[0]["wild"] == 2e200
    assert math.isnan(results[1].pop("nan")) and results[0] == results[1]


def test_all_checks_of_a_table_are_one_aggregate(spark, sf):
    df = derived(spark, sf, "candidates")
    checks = quality.quality_checks(df, required=df.columns[:5], rules=[quality.Rule("r", "candidate_id < 0")])
    plan = checks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("raw,shared,expected", [(3, 3, ("PASSED", 3.0, "raw=3, harmonized=3")),
                                                 (1234, 1, ("FAILED", 1233.0, "MISMATCH: raw=1,234, harmonized=1"))])
def test_row_parity(spark, raw, shared, expected):
    check = quality.check_row_parity(spark.range(raw), spark.range(shared))
    assert rows(check, "check_status", "metric_value", "details") == [expected]


def test_row_parity_per_source_sees_a_missing_source(spark):
    a, b = (frame(spark, "s string", *[(x,) for x in text]) for text in ("AAB", "AA"))
    assert rows(quality.check_row_parity(a, b, ["s"]), "s", "check_status", "metric_value") == [("A", "PASSED", 2.0), ("B", "FAILED", 1.0)]


def test_coverage_check(spark):
    pair = "source_system string, local_column_name string"
    entries = frame(spark, pair + ", active_flag boolean", ("S", "a", True), ("S", "b", False))
    check = quality.check_mapping_coverage(frame(spark, pair, ("S", "a"), ("S", "b"), ("S", "c")), entries)
    assert rows(check, "check_status", "metric_value", "details") == [("WARNING", 33.3, "1/3 mandatory columns have active dict entries")]
    none = quality.check_mapping_coverage(frame(spark, pair), entries)
    assert rows(none, "check_status", "metric_value") == [("PASSED", 100.0)]


def test_a_declared_source_without_rows_gets_all_checks(spark):
    df = frame(spark, "s string, a int", ("A", 1))
    sources = frame(spark, "s string", ("A",), ("B",))
    checks = quality.quality_checks(df, required=["a", "gone"], by=["s"], sources=sources, raw=df.select("s"))
    assert rows(checks.filter("s = 'B'"), "check_name", "check_status", "metric_value") == [
        ("not_null_a", "PASSED", 0.0), ("not_null_gone", "FAILED", 0.0), ("row_count_parity", "PASSED", 0.0)]


def test_sums_are_of_the_values_as_they_are(spark):
    total = lambda *v: frame(spark, "a double", *[(x,) for x in v]).agg(F.expr(metrics.total("a"))).first()[0]
    # The doubles themselves add up, not their shortest decimal forms.
    assert total(0.00004, 0.00004, 0.00004) == 3 * 0.00004
    assert total(1e15, 0.25) == 1e15 + 0.25 and total(None) is None and total(1e30, 1.0) == 1e30
    assert str(total(float("nan"), 1.0)) == "nan"


def test_failed_checks_raise(spark):
    results = frame(spark, "check_name string, check_status string", ("a", "WARNING"), ("b", "FAILED"))
    with pytest.raises(quality.QualityFailed, match="1 checks failed"):
        quality.enforce_quality(results)
    quality.enforce_quality(results.filter("check_status <> 'FAILED'"))


# Evaluation


def test_scoring_edge_cases(spark):
    key = frame(spark, "source_system string, local_column_name string, expected_global_column_name string",
                ("S", "a", "Region"), ("S", "b", None), ("S", "c", ""), ("S", "d", "x"), ("S", "e", "y"))
    proposals = frame(
        spark, "source_system string, local_column_name string, proposed_global_column_name string, confidence string, "
        "ai_error_status string, updated_at timestamp",
        ("S", "a", "old", "LOW", None, dt.datetime(2025, 1, 1)), ("S", "a", "region", "high", None, dt.datetime(2025, 1, 2)),
        ("S", "c", "NO_MATCH", "HIGH", None, None), ("S", "d", "x", "HIGH", "AI_ERROR", None), ("S", "extra", "x", "HIGH", None, None),
    )
    scored = evaluate.score_proposals(key, proposals)
    assert rows(scored, "local_column_name", "band", "correct") == [
        ("a", "HIGH", True), ("b", "UNKNOWN", True), ("c", "HIGH", True), ("d", "HIGH", False), ("e", "UNKNOWN", False),
    ]
    assert rows(evaluate.eval_overall(scored), "accuracy", "auto_accept_rate", "review_load") == [(0.6, 0.4, 0.4)]
    assert rows(evaluate.eval_by_band(scored), "band", "n", "correct", "share") == [
        ("HIGH", 3, 2, 0.6), ("LOW", 0, 0, 0.0), ("MEDIUM", 0, 0, 0.0), ("UNKNOWN", 2, 1, 0.4),
    ]
    metric_rows = rows(evaluate.eval_metric_rows(scored, "r"), "metric_name", "slice", "metric_value")
    assert ("accuracy", "MEDIUM", 0.0) in metric_rows and ("review_load", "ALL", 0.4) in metric_rows and len(metric_rows) == 7
    assert rows(evaluate.eval_errors(scored), "local_column_name") == [("d",), ("e",)]


def test_latest_rows_keeps_ties_and_null_keys(spark):
    schema = "source_system string, evaluated_at int, v int"
    df = frame(spark, schema, ("A", 1, 1), ("A", 2, 2), ("A", 2, 3), (None, 5, 4), (None, 4, 5))
    assert rows(evaluate.latest_rows(df), "v") == [(2,), (3,), (4,)]


# Metrics


def test_ratio_is_of_sums_and_null_for_zero(spark):
    df = frame(
        spark, "g string, gross_claims_incurred_eur double, gross_written_premium_eur double", ("a", 1.0, 10.0), ("a", 9.0, 10.0),
        ("b", 1.0, 0.0), ("c", None, 5.0),
    )
    view = metrics.MetricView({"group": "g"}, {"loss": metrics.ratio(["gross_claims_incurred_eur"], "gross_written_premium_eur")})
    assert rows(view.query(df, ["group"], ["loss"])) == [("a", 0.5), ("b", None), ("c", None)]
    assert rows(view.query(df, [], ["loss"], where="group = 'a'")) == [(0.5,)]
    with pytest.raises(ValueError, match="unknown measures"):
        view.query(df, ["group"], ["nope"])
    with pytest.raises(ValueError, match="unknown dimensions"):
        view.query(df, ["nope"], ["loss"])


def test_policies_change_drops_rows_with_null(spark):
    schema = "source_country string, new_policies_count int, renewed_policies_count int, cancelled_policies_count int"
    df = frame(spark, schema, ("ES", 1, 2, 1), ("ES", 5, None, 0))
    view = metrics.MetricView({"country": "source_country"}, {"x": metrics.PROPERTY_KPIS.measures["policies_in_force_change"]})
    assert rows(view.query(df, ["country"], ["x"])) == [("ES", 2)]


def test_top_keeps_ties_and_last_periods_follow_the_data(spark):
    df = frame(spark, "g string, m double", ("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", None))
    top = metrics.top_by_measure(df, "m")
    assert rows(top, "g") == [("b",), ("c",)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    periods = frame(spark, "y int, m int", (2024, 11), (2024, 12), (2025, 1), (2025, 2))
    assert rows(metrics.last_periods(periods, "y", "m", 3)) == [(2024, 12), (2025, 1), (2025, 2)]


def test_sums_do_not_depend_on_the_order_of_rows(spark, sf):
    view = metrics.MetricView({}, {"s": metrics.total("l_extendedprice")})
    lines = derived(spark, sf, "lineitem")
    found = {view.query(lines.repartition(n), [], ["s"]).first()["s"] for n in (1, 3, 7)}
    assert len(found) == 1


# Security, model, operations


def test_row_filter(spark):
    df = frame(spark, "source_country string, v int", ("ES", 1), ("IT", 2), (None, 3))
    members = frame(spark, "user string, group string", ("u", "st_es"), ("adm", "root"), ("vip", "other"), ("two", "st_es"), ("two", "st_it"))
    granted = security.entitlements_from_groups(members, admin_group="root", prefix="st_", privileged=["vip"])

    def seen(user):
        return [r[0] for r in rows(security.row_filter(df, granted, user), "v")]

    assert (seen("u"), seen("adm"), seen("vip"), seen("two"), seen("x")) == ([1], [1, 2, 3], [1, 2, 3], [1, 2], [])
    alone = security.entitlements_from_groups(members, admin_group="root", prefix="st_", privileged=["nogroup"])
    assert len(rows(security.row_filter(df, alone, "nogroup"))) == 3


def test_target_model_is_checked(spark):
    good = {"name": "a", "type": "INT", "description": "d"}
    assert target_model(spark, "t", [good]).count() == 1
    for wrong in ({**good, "name": "1a"}, {**good, "name": "a b"}, {"name": "a", "type": "INT"}):
        with pytest.raises(ValueError):
            target_model(spark, "t", [wrong])
    with pytest.raises(ValueError, match="twice"):
        target_model(spark, "t", [good, good])


def test_money_columns_of_the_model(spark):
    assert [r[0] for r in rows(financial_columns(M.targets(spark)))] == [
        "claims_reserve_eur", "commissions_eur", "gross_claims_incurred_eur", "gross_written_premium_eur",
        "management_expenses_eur", "net_written_premium_eur",
    ]


def test_run_log_and_usage(spark):
    start, end = dt.datetime(2025, 1, 1, 10, 0, 0), dt.datetime(2025, 1, 1, 10, 1, 30)
    run = ops.log_run(spark, "r", "t", "OK", start, 5, "m", finished_at=end)
    assert rows(ops.recent_runs(run), "task_name", "duration_min") == [("t", 1.5)]
    staged = frame(spark, "source_system string, ai_error_status string, review_status string, confidence string",
                   ("S", None, "PENDING", "low"), ("S", "AI_ERROR", "PENDING", None), ("S", None, "APPROVED", "HIGH"))
    used = ops.usage_metrics(staged, "r")
    assert rows(used, "candidate_rows", "success_rows", "failed_rows", "low_confidence_rows", "estimated_prompt_units") == [(3, 1, 1, 1, 600.0)]


def test_flows_from_feed_to_checked_table(spark, sf):
    from feedloom.operators import gate, review
    from feedloom.operators.merge import sync_decisions

    feeds = {code: derived(spark, sf, f"feed_{code.lower()}") for code in ("ES", "IT")}
    candidates = empty_table(spark, "column_mapping_candidates")
    approved = empty_table(spark, "column_mapping_dictionary")
    for code, feed in feeds.items():
        system = M.SYSTEMS[code]
        candidates = flows.propose(
            feed, system, code, targets=M.targets(spark), glossary=M.glossary(spark), dictionary=approved,
            candidates=candidates, mandatory=M.MANDATORY[code],
        )
        candidates = spark.createDataFrame(candidates.collect(), candidates.schema)
        with pytest.raises(gate.GateBlocked):
            flows.build_dictionary(candidates, M.mandatory(spark), approved, system, "v1")
        made = review.decide_from_key(candidates.filter(F.col("source_system") == system), M.answer_key(spark), "reader")
        queue = review.apply_decisions(candidates, made)
        candidates = sync_decisions(candidates, queue)
        candidates = spark.createDataFrame(candidates.collect(), candidates.schema)
        approved = flows.build_dictionary(candidates, M.mandatory(spark), approved, system, "v1")
        approved = spark.createDataFrame(approved.collect(), approved.schema)
    assert approved.filter("active_flag").count() == 46
    result = flows.publish(
        feeds, M.SYSTEMS, model=M.MODEL, dictionary=approved, mandatory=M.mandatory(spark),
        allowed=spark.createDataFrame([(c, v) for c in M.CATEGORICAL for v in M.ALLOWED[c]], "source_field string, allowed_value string"),
        allow_lists=M.ALLOWED, value_glossary=M.value_glossary(spark),
        value_dictionary=empty_table(spark, "value_mapping_dictionary"), required=M.REQUIRED, rules=M.RULES,
        mapping_version="v1", run_id="run",
    )
    checks = {(r["source_system"], r["check_name"]): r["check_status"] for r in result.checks.collect()}
    assert len(checks) == 62
    failed = {name for (_, name), status in checks.items() if status != "PASSED"}
    assert failed == {"numeric_claims_paid_lte_reported"}


def test_samples_of_later_batches_and_of_nan(spark):
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "3")
    try:
        df = spark.range(20, 0, -1, 1).select(
            "id", F.when(F.col("id") > 3, F.lit(float("nan"))).otherwise(F.col("id").cast("double")).alias("d"),
            F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("s"), (F.col("id") == 2).alias("b"),
        )
        found = profile.sample_values(df, 2)
        assert rows(found, "column_name", "sample_values") == [
            ("b", ["false", "true"]), ("d", ["1.0", "2.0"]), ("id", ["1", "2"]), ("s", ["10", "12"]),
        ]
    finally:
        spark.conf.set(limit, before)
