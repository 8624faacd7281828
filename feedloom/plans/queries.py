"""The registered queries: each operator over inputs from the driver tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.local import local_frame
from ..functions.scratch import scratch_dir, written
from ..operators import dictionary as D
from ..operators import evaluate as E
from ..operators import gate as G
from ..operators import learned, match, merge, ops, profile, quality, review, security, summaries, values
from ..operators import sketches as K
from ..operators.buckets import BucketedTable
from ..operators.expectations import expect_rows, expectation_metrics
from ..operators.harmonize import harmonize, mapping_report, project, resolve_columns
from ..operators.metrics import PROPERTY_KPIS, last_periods, top_by_measure, total
from ..operators.partials import PROPERTY_PARTS, last_stored_periods
from ..schemas import (
    COLUMN_MAPPING_CANDIDATES,
    COLUMN_MAPPING_DICTIONARY,
    DATA_QUALITY_RESULTS,
    WORKFLOW_RUN_METRICS,
    conform,
    empty_table,
    financial_columns,
    struct,
)
from ..schemas import categorical_targets as model_categories
from ..sources import feeds as S
from ..sources import keys, sinks
from ..sources.headers import header_drift as header_drift_of
from ..streaming.ingest import ingest_feeds, ingested_counts, read_ingested
from . import flows
from . import property_model as M
from .fixtures import frame

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
VERSION = "v1"
STAMP = "2030-01-01 00:00:00"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _stamp():
    return F.lit(STAMP).cast("timestamp_ntz")


def _feed(spark: SparkSession, d: str, code: str, *, dirty: bool = False) -> DataFrame:
    return frame(spark, d, f"feed_{code.lower()}{'_dirty' if dirty else ''}")


def _columns_only(spark: SparkSession, d: str) -> DataFrame:
    """Both feeds under the shared schema, category values as delivered."""
    dictionary = M.dictionary(spark)
    es, it = (
        harmonize(
            _feed(spark, d, code), dictionary, M.MODEL, source_country=code, source_system=M.SYSTEMS[code],
            mapping_version=VERSION,
        )
        for code in ("ES", "IT")
    )
    return es.unionByName(it)


def shared(spark: SparkSession, d: str) -> DataFrame:
    """Both feeds under the shared schema with translated values."""
    return values.translate_values(_columns_only(spark, d), M.value_dictionary(spark), M.CATEGORICAL)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


# KPIs

MONEY = ["gross_written_premium", "net_written_premium", "gross_claims_incurred", "commissions", "management_expenses"]


@query
def kpi_combined_ratio_by_source_channel(spark, d):
    kpi = PROPERTY_KPIS.query(shared(spark, d), ["country", "distribution_channel"], ["combined_ratio"])
    return _rounded(kpi, "combined_ratio")


@query
def kpi_by_source(spark, d):
    kpi = PROPERTY_KPIS.query(shared(spark, d), ["country"], list(PROPERTY_KPIS.measures))
    return _rounded(_rounded(kpi, "loss_ratio", "expense_ratio", "combined_ratio"), *MONEY, digits=4)


@query
def kpi_all_dimensions(spark, d):
    dims = list(PROPERTY_KPIS.dimensions)
    kpi = PROPERTY_KPIS.query(
        shared(spark, d), dims, ["gross_written_premium", "claims_reported", "loss_ratio"], where="country IN ('ES', 'IT')"
    )
    return _rounded(_rounded(kpi, "loss_ratio"), "gross_written_premium", digits=4)


@query
def kpi_loss_ratio_last3m(spark, d):
    recent = last_periods(shared(spark, d), "reporting_year", "reporting_month", 3)
    return _rounded(PROPERTY_KPIS.query(recent, ["country"], ["loss_ratio"]), "loss_ratio")


@query
def kpi_top_channel(spark, d):
    kpi = PROPERTY_KPIS.query(shared(spark, d), ["country", "distribution_channel"], ["combined_ratio"])
    return _rounded(top_by_measure(kpi, "combined_ratio", ["country"]), "combined_ratio")


@query
def kpi_gwp_month_source(spark, d):
    kpi = PROPERTY_KPIS.query(shared(spark, d), ["reporting_period", "country"], ["gross_written_premium"])
    return _rounded(kpi, "gross_written_premium", digits=4)


@query
def kpi_claims_month_source(spark, d):
    return PROPERTY_KPIS.query(shared(spark, d), ["country", "reporting_period"], ["claims_reported"])


@query
def kpi_highest_loss_ratio(spark, d):
    kpi = PROPERTY_KPIS.query(shared(spark, d), ["country", "reporting_period"], ["loss_ratio"])
    return _rounded(top_by_measure(kpi, "loss_ratio"), "loss_ratio")


# Projection


@query
def harmonized_rows(spark, d):
    return shared(spark, d).drop("harmonization_timestamp")


@query
def pad_and_cast(spark, d):
    """A feed with few mapped columns: the others become typed NULLs, texts are cast and misfits become NULL."""
    raw = frame(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("id_registro"),
        F.concat(F.year("o_orderdate").cast("string"), F.when(F.col("o_orderstatus") == "P", "?").otherwise("")).alias("anio"),
        F.col("o_orderpriority").alias("canal_distribucion"),
    )
    mapping = resolve_columns(raw, M.dictionary(spark), M.SYSTEMS["ES"])
    return project(raw, mapping, M.MODEL, on_error="null")


@query
def duplicate_target_first_wins(spark, d):
    """Two local columns for one target: the first by name feeds it."""
    raw = frame(spark, d, "orders").select(
        F.col("o_orderstatus").alias("zz_code"), F.col("o_orderpriority").alias("aa_code"), F.col("o_orderkey").alias("id")
    )
    dictionary = local_frame(
        spark,
        [("S", "zz_code", "currency", True), ("S", "aa_code", "currency", True), ("S", "id", "record_id", True),
         ("S", "absent", "region", True)],
        struct("source_system string, local_column_name string, global_column_name string, active_flag boolean"),
    )
    return project(raw, resolve_columns(raw, dictionary, "S"), {"record_id": "BIGINT", "currency": "STRING", "region": "STRING"})


@query
def column_mapping_report(spark, d):
    return mapping_report(frame(spark, d, "inventory_keys"), frame(spark, d, "mapping_dictionary"))


@query
def pending_columns(spark, d):
    return match.pending_columns(frame(spark, d, "inventory_keys"), frame(spark, d, "mapping_dictionary"))


@query
def active_mappings(spark, d):
    return D.active_mappings(frame(spark, d, "mapping_dictionary")).select(
        "source_system", "local_column_name", "global_column_name", "mapping_version"
    )


# Profiling


@query
def inventory_samples(spark, d):
    parts = [
        profile.inventory_columns(_feed(spark, d, code), M.SYSTEMS[code], f"feed_{code.lower()}", k=5)
        for code in ("ES", "IT")
    ]
    both = parts[0].unionByName(parts[1])
    # Engines write fractional numbers in different ways, so these are printed alike.
    numbers = F.transform("sample_values", lambda v: F.format_string("%.6f", v.cast("double") + 0.0))
    text = F.array_join(F.when(F.col("local_data_type") == "double", numbers).otherwise(F.col("sample_values")), "; ")
    return both.select(
        "source_system", "source_table", "local_column_name", "ordinal_position", text.alias("samples")
    )


@query
def required_profile(spark, d):
    prof = profile.required_profile(shared(spark, d), M.REQUIRED, by=["source_country"])
    return prof.drop("latest_harmonization")


@query
def distinct_values(spark, d):
    return profile.distinct_values(_columns_only(spark, d), M.CATEGORICAL, ["source_system"])


@query
def feed_counts(spark, d):
    """Rows and 'files' per feed: the reporting year stands for the file each row came from."""
    es = _feed(spark, d, "ES").select(F.col("anio").cast("string").alias("_source_file"))
    it = _feed(spark, d, "IT").select(F.col("anno_riferimento").cast("string").alias("_source_file"))
    return profile.feed_counts({"es": es, "it": it})


@query
def rows_by_source(spark, d):
    return profile.rows_by_source(shared(spark, d))


# Expectations


@query
def expect_drop(spark, d):
    es = expect_rows(_feed(spark, d, "ES", dirty=True), **M.EXPECTATIONS["ES"])
    it = expect_rows(_feed(spark, d, "IT", dirty=True), **M.EXPECTATIONS["IT"])
    a = es.select(F.lit("es").alias("feed"), F.col("id_registro").alias("id"), F.col("mes").alias("month"),
                  F.col("prima_bruta").alias("premium"))
    b = it.select(F.lit("it").alias("feed"), F.col("id_riga").alias("id"), F.col("mese_riferimento").alias("month"),
                  F.col("premi_lordi_contabilizzati").alias("premium"))
    return a.unionByName(b)


@query
def expect_metrics(spark, d):
    es = expectation_metrics(_feed(spark, d, "ES", dirty=True), **M.EXPECTATIONS["ES"])
    it = expectation_metrics(_feed(spark, d, "IT", dirty=True), **M.EXPECTATIONS["IT"])
    return es.withColumn("feed", F.lit("es")).unionByName(it.withColumn("feed", F.lit("it")))


# Quality


@query
def dq_report(spark, d):
    rows = shared(spark, d)
    by = ["source_system"]
    raw = (
        _feed(spark, d, "ES").select(F.lit(M.SYSTEMS["ES"]).alias("source_system"))
        .unionByName(_feed(spark, d, "IT").select(F.lit(M.SYSTEMS["IT"]).alias("source_system")))
    )
    # One declared source has no rows; one rule can't be resolved, another one stops when it runs.
    sources = local_frame(spark, [(x,) for x in (*M.SYSTEMS.values(), "EMPTY")], struct("source_system string"))
    rules = [
        *M.RULES,
        quality.Rule("broken_rule", "no_such_column > 1", "WARNING", "never"),
        quality.Rule("stopping_rule", "1 / (claims_paid_count * 0) > 1", "WARNING", "never"),
        *(quality.Rule(f"stopping_{name}", predicate, "WARNING", "never") for name, predicate in M.STOPPING.items()),
    ]
    report = quality.quality_report(
        [
            quality.check_mapping_coverage(M.mandatory(spark), M.dictionary(spark), by, sources),
            quality.quality_checks(
                rows,
                required=[*M.REQUIRED, "absent_column"],
                allowed={**M.ALLOWED, "absent_category": ["a", "b"]},
                rules=rules,
                by=by,
                sources=sources,
                raw=raw,
            ),
        ],
        "run",
    )
    broken = F.col("check_name").isin("broken_rule", "stopping_rule", *(f"stopping_{name}" for name in M.STOPPING))
    return report.select(
        "source_system", "check_name", "check_status", "metric_value",
        F.when(broken, F.lit("predicate failed to evaluate")).otherwise(F.col("details")).alias("details"),
    )


@query
def dq_untranslated(spark, d):
    """Checks on the rows before translation: local values outside the allow-lists give warnings."""
    checks = quality.quality_checks(_columns_only(spark, d), allowed=M.ALLOWED, by=["source_country"])
    return quality.quality_totals(checks, ["source_country"])


@query
def dq_mapping_coverage(spark, d):
    return quality.check_mapping_coverage(
        frame(spark, d, "declared_mandatory"), frame(spark, d, "mapping_dictionary"), ["source_system"]
    )


@query
def dq_latest_run(spark, d):
    return ops.latest_dq_run(frame(spark, d, "dq_results")).drop("recorded_at")


@query
def failed_checks_last_run(spark, d):
    return ops.failed_checks_last_run(frame(spark, d, "dq_results")).drop("recorded_at")


@query
def failed_checks_last_failed_run(spark, d):
    return ops.failed_checks_last_failed_run(frame(spark, d, "dq_results")).drop("recorded_at")


# Values


@query
def translate_values(spark, d):
    return shared(spark, d).select("source_country", "record_id", *M.CATEGORICAL, "primary_coverage", "mapping_status")


@query
def translate_values_large(spark, d):
    """A dictionary of one entry per part."""
    return values.translate_values(frame(spark, d, "part_facts"), frame(spark, d, "part_terms"), ["part"])


def _value_candidates(spark, d) -> DataFrame:
    found = profile.distinct_values(_columns_only(spark, d), M.CATEGORICAL + ["region"], ["source_system"])
    allowed = model_categories(M.targets(spark))
    return values.stage_value_candidates(values.propose_values(found, allowed, M.value_glossary(spark)))


@query
def value_candidates(spark, d):
    return _value_candidates(spark, d).select(
        "source_system", "source_field", "raw_value", "proposed_harmonized_value", "confidence", "review_status",
        "final_harmonized_value", "reviewed_by",
    )


@query
def value_prompt(spark, d):
    found = profile.distinct_values(_columns_only(spark, d), M.CATEGORICAL)
    return values.value_prompt(found, model_categories(M.targets(spark)))


@query
def replied_values(spark, d):
    """Candidates from replies: values of failed replies and those left out stay PENDING."""
    found = profile.distinct_values(_columns_only(spark, d), M.CATEGORICAL, ["source_system"])
    replies = local_frame(spark, M.VALUE_REPLIES, struct("source_system string, source_field string, reply string"))
    staged = values.stage_value_candidates(values.replied_values(found, replies, model_categories(M.targets(spark))))
    return staged.select(
        "source_system", "source_field", "raw_value", "final_harmonized_value", "review_status", "ai_error_status"
    )


@query
def propose_flow(spark, d):
    """A whole proposal run for one source with the examples of all others: hundreds of them, none left out."""
    examples = match.approved_examples(frame(spark, d, "mapping_dictionary"), "SYS_0")
    names = frame(spark, d, "example_columns").withColumn("sample_values", F.array().cast("array<string>"))
    found = match.propose_mappings(names, M.targets(spark), M.glossary(spark), examples)
    return found.select("local_column_name", "proposed_global_column_name", "confidence")


@query
def parse_value_reply(spark, d):
    return values.parse_value_reply(frame(spark, d, "value_replies"), model_categories(M.targets(spark)))


# Matching


@query
def prompt_text(spark, d):
    columns = frame(spark, d, "inventory").select(
        "source_system", "ordinal_position", "local_column_name", "local_data_type",
        F.array("sample_a", "sample_b").alias("sample_values"),
    )
    prompts = match.prompt_text(
        columns, context=" monthly feed ", target_columns=M.TARGET_NAMES, examples=[("prima_neta", "net_written_premium_eur")],
        template="Column ${local_column_name} (${local_data_type}), e.g. ${sample_values}. ${context}: ${target_columns}; ${tone}",
        extra={"tone": "it's brief"},
    )
    return prompts.select("source_system", "ordinal_position", "prompt")


@query
def parse_reply(spark, d):
    return match.parse_reply(frame(spark, d, "replies")).drop("reply")


@query
def propose_mappings(spark, d):
    inventory = frame(spark, d, "inventory").withColumn("sample_values", F.array("sample_a", "sample_b"))
    examples = M.dictionary(spark).filter(F.col("source_system") == M.SYSTEMS["IT"])
    proposals = match.propose_mappings(inventory, M.targets(spark), M.glossary(spark), examples)
    return proposals.select(
        "source_system", "ordinal_position", "local_column_name", "proposed_global_column_name", "proposed_match_type",
        "confidence", "score",
    )


def _styled(spark, d) -> DataFrame:
    return frame(spark, d, "styled_columns", spread={"customer": "c_custkey"}).withColumn("sample_values", F.array("sample_value"))


@query
def unseen_names(spark, d):
    """Every column of each style matched by what the other styles teach, without a glossary; rows per style."""
    return learned.held_out_accuracy(_styled(spark, d), "style")


@query
def learned_mappings(spark, d):
    """The abbreviated columns of all sources matched by the pairs of the sources with plain names."""
    columns = _styled(spark, d)
    plain = columns.filter("style = 'plain'")
    found = learned.learned_matches(columns.filter("style in ('no vowels', 'three letters')"), plain)
    return found.select("source_system", "local_column_name", "proposed", "score")


@query
def propose_feeds(spark, d):
    """Both feeds from inventory to staged candidates, scored against the answer keys."""
    es, it = (
        profile.inventory_columns(_feed(spark, d, code), M.SYSTEMS[code], f"feed_{code.lower()}")
        for code in ("ES", "IT")
    )
    proposals = match.propose_mappings(es.unionByName(it), M.targets(spark), M.glossary(spark))
    candidates = match.stage_candidates(proposals, M.mandatory(spark))
    scored = E.score_proposals(M.answer_key(spark), candidates)
    mandatory = candidates.select("source_system", "local_column_name", "mandatory_flag", "proposed_match_type")
    return scored.join(mandatory, ["source_system", "local_column_name"])


@query
def approved_examples(spark, d):
    return match.approved_examples(frame(spark, d, "mapping_dictionary"), "SYS_1", 60)


@query
def stage_candidates(spark, d):
    proposals = match.parse_reply(
        frame(spark, d, "replies").select(
            F.concat(F.lit("SYS_"), (F.col("event_id") % 10).cast("string")).alias("source_system"),
            F.concat(F.lit("col_"), F.col("event_id").cast("string")).alias("local_column_name"), "reply",
        )
    ).drop("reply")
    mandatory = frame(spark, d, "declared_mandatory").select(
        F.regexp_replace("source_system", "^SYS_.*$", "SYS_1").alias("source_system"), "local_column_name"
    )
    return match.stage_candidates(proposals, mandatory).select(
        "source_system", "local_column_name", "proposed_global_column_name", "ai_error_status", "review_status",
        "final_global_column_name", "mandatory_flag",
    )


# Evaluation


def _scored(spark, d) -> DataFrame:
    return E.score_proposals(frame(spark, d, "wide_key"), frame(spark, d, "candidates"))


@query
def eval_overall(spark, d):
    return _rounded(E.eval_overall(_scored(spark, d)), "accuracy", "auto_accept_rate", "review_load")


@query
def eval_by_band(spark, d):
    bands = E.eval_by_band(_scored(spark, d))
    return _rounded(bands, "accuracy", "share")


@query
def eval_errors(spark, d):
    return E.eval_errors(_scored(spark, d))


@query
def eval_metric_rows(spark, d):
    rows = E.eval_metric_rows(_scored(spark, d), "run")
    return _rounded(rows, "metric_value").drop("evaluated_at")


@query
def latest_metric(spark, d):
    return E.latest_metric(frame(spark, d, "eval_results"))


@query
def latest_eval_run(spark, d):
    return E.latest_eval_run(frame(spark, d, "eval_results")).drop("evaluated_at")


# State changes


@query
def merge_model(spark, d):
    old = _model(frame(spark, d, "model_old"))
    new = _model(frame(spark, d, "model_new"))
    return merge.upsert_model(old, new).withColumn("example_values", F.array_join("example_values", "|"))


def _model(df: DataFrame) -> DataFrame:
    return df.withColumn("example_values", F.array("example_text")).drop("example_text")


@query
def merge_candidates(spark, d):
    def listed(df):
        return df.withColumns(
            {"local_sample_values": F.array("local_data_type"), "reviewed_at": F.lit(None).cast("timestamp")}
        )

    merged = merge.merge_candidates(listed(frame(spark, d, "candidates")), listed(frame(spark, d, "staged_candidates")))
    return merged.withColumn("local_sample_values", F.array_join("local_sample_values", "|")).drop("reviewed_at")


@query
def sync_decisions(spark, d):
    return merge.sync_decisions(frame(spark, d, "candidates"), frame(spark, d, "queue_state")).select(
        "source_system", "local_column_name", "proposed_global_column_name", *merge.DECISION_COLUMNS
    )


@query
def append_audit(spark, d):
    return merge.append_audit(frame(spark, d, "audit_old"), frame(spark, d, "audit_new"))


def _staged_dictionary(spark, d) -> DataFrame:
    staged = D.stage_dictionary(D.resolve_dictionary(frame(spark, d, "candidates")), "v9", now=_stamp())
    return staged.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("approved_at", "created_at", "updated_at")})


@query
def merge_dictionary(spark, d):
    return merge.merge_dictionary(frame(spark, d, "mapping_dictionary"), _staged_dictionary(spark, d))


@query
def deactivate_stale(spark, d):
    return merge.deactivate_stale(frame(spark, d, "mapping_dictionary"), _staged_dictionary(spark, d), now=_stamp()).select(
        "source_system", "local_column_name", "active_flag", "updated_at"
    )


@query
def merge_value_dictionary(spark, d):
    stamped = {c: F.lit(None).cast("timestamp") for c in ("approved_at", "created_at", "updated_at")}
    old = frame(spark, d, "value_dict_old").withColumns(stamped)
    new = frame(spark, d, "value_dict_new").withColumns(stamped)
    return merge.merge_value_dictionary(old, new).drop(*stamped)


@query
def upsert_queue(spark, d):
    def listed(df):
        return df.withColumns(
            {"local_sample_values": F.array("local_data_type"), "published_at": _stamp(), "updated_at": _stamp()}
        )

    merged = merge.upsert_queue(listed(frame(spark, d, "queue")), listed(frame(spark, d, "queue_rows")), change_flag="changed")
    return merged.drop("local_sample_values", "published_at", "updated_at")


# Review


@query
def apply_decisions(spark, d):
    queue = frame(spark, d, "queue").withColumns({"reviewed_at": _stamp(), "updated_at": _stamp()})
    return review.apply_decisions(queue, frame(spark, d, "decisions"), now=_stamp()).drop("reviewed_at", "updated_at")


@query
def audit_rows(spark, d):
    rows = review.audit_rows(frame(spark, d, "queue"), frame(spark, d, "decisions"), width=1000)
    return rows.drop("action_at")


@query
def rejected_decisions(spark, d):
    return review.rejected_decisions(frame(spark, d, "decisions"), frame(spark, d, "queue")).select(
        "source_system", "local_column_name", "seq", "action", "reject_reason"
    )


@query
def decide_from_key(spark, d):
    return review.decide_from_key(frame(spark, d, "candidates"), frame(spark, d, "wide_key"), "key-reader")


def _decided(df: DataFrame) -> DataFrame:
    return df.select(
        "source_system", "local_column_name", "review_status", "final_global_column_name", "final_match_type",
        "reviewed_by", "review_comment",
    )


@query
def bulk_approve(spark, d):
    return _decided(review.bulk_approve(frame(spark, d, "candidates"), "steward"))


@query
def bulk_approve_all(spark, d):
    return _decided(review.bulk_approve(frame(spark, d, "candidates"), "steward", mandatory_only=False))


@query
def correct_rows(spark, d):
    candidates = frame(spark, d, "candidates")
    return _decided(review.correct_rows(candidates, F.col("confidence") == "LOW", "region", "steward"))


@query
def reject_rows(spark, d):
    candidates = frame(spark, d, "candidates")
    return _decided(review.reject_rows(candidates, F.col("confidence").isNull(), "steward", "no business field"))


@query
def review_gate(spark, d):
    return G.review_gate(frame(spark, d, "candidates"), frame(spark, d, "declared_mandatory"))


@query
def gate_preview(spark, d):
    return G.gate_preview(frame(spark, d, "candidates"))


@query
def publish_ready(spark, d):
    return G.publish_ready(frame(spark, d, "candidates"), ["source_system"])


@query
def pending_view(spark, d):
    listed = frame(spark, d, "candidates").withColumn("local_sample_values", F.array("local_data_type"))
    return review.pending_view(listed).drop("local_sample_values")


@query
def low_confidence_view(spark, d):
    return review.low_confidence_view(frame(spark, d, "candidates"))


@query
def readiness_view(spark, d):
    return review.readiness_view(frame(spark, d, "candidates"))


@query
def mandatory_status(spark, d):
    return review.mandatory_status(frame(spark, d, "candidates"))


@query
def rejected_report(spark, d):
    return review.rejected_report(frame(spark, d, "candidates"))


@query
def review_queue(spark, d):
    return review.review_queue(frame(spark, d, "queue"), decided_only=True)


@query
def coverage_view(spark, d):
    return review.coverage_view(M.targets(spark), frame(spark, d, "candidates"))


@query
def latest_mapping_summary(spark, d):
    return review.latest_mapping_summary(frame(spark, d, "candidates"), frame(spark, d, "mapping_dictionary"))


@query
def active_dictionary(spark, d):
    return D.active_dictionary(frame(spark, d, "mapping_dictionary"))


@query
def mapping_lineage(spark, d):
    """Which columns of one source feed a target."""
    return D.mapping_lineage(frame(spark, d, "mapping_dictionary"), "SYS_1", "net_written_premium_eur")


@query
def resolve_dictionary(spark, d):
    return _staged_dictionary(spark, d)


# Summaries


@query
def review_summary(spark, d):
    return summaries.review_summary(frame(spark, d, "candidates"))


@query
def status_summary(spark, d):
    return summaries.status_summary(frame(spark, d, "queue"))


@query
def status_columns(spark, d):
    """Counts and whole lists per status."""
    return summaries.status_columns(frame(spark, d, "candidates"))


@query
def queue_counters(spark, d):
    return summaries.queue_counters(frame(spark, d, "candidates"))


@query
def review_coverage(spark, d):
    return summaries.review_coverage(frame(spark, d, "candidates"), ["source_system"])


@query
def confidence_pivot(spark, d):
    return summaries.confidence_pivot(frame(spark, d, "candidates"))


@query
def approved_count(spark, d):
    return summaries.approved_count(frame(spark, d, "candidates"))


# Operations


@query
def usage_metrics(spark, d):
    usage = ops.usage_metrics(frame(spark, d, "candidates"), "run")
    return _rounded(usage, "estimated_cost_eur").drop("recorded_at")


@query
def recent_runs(spark, d):
    return ops.recent_runs(frame(spark, d, "runs")).drop("finished_at")


@query
def recent_usage(spark, d):
    return ops.recent_usage(frame(spark, d, "usage"), "SYS_7")


@query
def log_run(spark, d):
    """Run-log rows from event rows and the row of this run, appended and read back."""
    rows = frame(spark, d, "runs")
    target = scratch_dir(spark, "runs")

    sinks.append_rows(rows, target, WORKFLOW_RUN_METRICS)
    start = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)
    sinks.append_rows(ops.log_run(spark, "this", "log_run", "DONE", start, rows.count(), "logged"), target, WORKFLOW_RUN_METRICS)
    return S.scan(spark, target).select("run_id", "task_name", "task_status", "row_count", "message")


# Security and model


@query
def row_filter(spark, d):
    granted = security.entitlements_from_groups(
        frame(spark, d, "memberships"), admin_group="admins", prefix="stewards_", privileged=["user3"]
    )
    rows = shared(spark, d).select("source_country", "record_id")
    return security.row_filter(rows, granted, "user1")


@query
def row_filter_privileged(spark, d):
    """A privileged user without any group sees all rows."""
    granted = security.entitlements_from_groups(
        frame(spark, d, "memberships"), admin_group="admins", prefix="stewards_", privileged=["auditor"]
    )
    return security.row_filter(shared(spark, d).select("source_country", "record_id"), granted, "auditor")


@query
def translate_one_source(spark, d):
    """Entries for one of two sources: the other one's rows keep their values and their status."""
    one = M.value_dictionary(spark).filter(F.col("source_system") == M.SYSTEMS["ES"])
    rows = values.translate_values(_columns_only(spark, d), one, M.CATEGORICAL)
    return rows.select("source_country", "record_id", *M.CATEGORICAL, "mapping_status")


@query
def small_money(spark, d):
    """A measure over amounts of more than four decimals."""
    rows = frame(spark, d, "lineitem").select("l_returnflag", F.expr("l_extendedprice * (1 - l_discount) * l_tax / 1000").alias("amount"))
    return _rounded(rows.groupBy("l_returnflag").agg(F.expr(total("amount")).alias("amount")), "amount", digits=6)


@query
def row_entitlements(spark, d):
    return security.entitlements_from_groups(
        frame(spark, d, "memberships"), admin_group="admins", prefix="stewards_", privileged=["user3"]
    )


@query
def money_totals(spark, d):
    """Totals of the model's money columns over the shared rows."""
    names = [row[0] for row in financial_columns(M.targets(spark)).collect()]
    sums = shared(spark, d).groupBy("source_country").agg(*[F.expr(total(n)).alias(n) for n in sorted(names)])
    return _rounded(sums, *sorted(names), digits=4)


@query
def exact_sums(spark, d):
    """Sums far beyond the decimal range, of values that cancel, and of groups with a NaN or an infinity, by line number."""
    x = F.col("l_extendedprice")
    wild = F.when(F.col("l_linenumber") == 6, F.when(F.col("l_partkey") % 97 == 0, F.lit(float("nan"))).otherwise(x))
    wild = wild.when(F.col("l_linenumber") == 7, F.when(F.col("l_partkey") % 97 == 0, F.lit(float("inf"))).otherwise(x))
    rows = frame(spark, d, "lineitem").select(
        F.col("l_linenumber").alias("line"),
        # Whole numbers of about 1e18 each.
        (F.floor(x) * F.lit(2.0**40)).alias("huge"),
        # 2**60 and its opposite around small numbers; a plain floating-point sum loses these.
        (F.when(F.col("l_partkey") % 2 == 0, F.lit(2.0**60)).otherwise(F.lit(-(2.0**60)))).alias("cancels"),
        F.floor(x).cast("double").alias("small"),
        wild.alias("wild"),
    )
    both = rows.select("line", "huge", "wild", F.inline(F.array(*(F.struct(v.alias("mixed")) for v in (F.col("cancels"), -F.col("cancels"), F.col("small"))))))
    sums = both.groupBy("line").agg(F.expr(total("huge")).alias("huge"), F.expr(total("mixed")).alias("mixed"), F.expr(total("wild")).alias("wild"))
    kind = F.when(F.isnan("wild"), "nan").when(F.abs("wild") == float("inf"), "inf").when(F.col("wild").isNull(), "none")
    return sums.select("line", (F.col("huge") / F.lit(2.0**40)).alias("huge"), "mixed", kind.alias("wild"))


@query
def categorical_targets(spark, d):
    """Allow-list entries with the number of shared rows that use them."""
    allowed = model_categories(M.targets(spark))
    used = shared(spark, d).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("source_field"), F.col(c).alias("allowed_value")) for c in M.CATEGORICAL]))
    ).groupBy("source_field", "allowed_value").agg(F.count(F.lit(1)).alias("n"))
    return allowed.join(used, ["source_field", "allowed_value"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


# Sources and sinks


@query
def read_answer_key(spark, d):
    """Answer keys written as JSON objects and read back as rows; columns without a target stay NULL."""
    target = scratch_dir(spark, "keys")
    pair = F.create_map("local_column_name", "expected_global_column_name")
    frame(spark, d, "wide_key").select("source_system", pair.alias("mappings")).write.json(target)
    return keys.read_answer_key(spark, target, lines=True)


def _write_csv(spark, d) -> str:
    """Both dirty feeds as gzipped CSV files per month below one folder, with ``n/a`` for some premiums.

    Headers drift: every third month has its columns in reverse, every third one lacks the currency and has a new column in front.
    """
    root = scratch_dir(spark, "landing")
    for code, columns in M.FEEDS.items():
        ids, year, month, premium = (columns[i][0] for i in (0, 1, 2, 8))
        feed = _feed(spark, d, code, dirty=True)
        damaged = feed.withColumn(
            premium, F.when(F.col(ids) % 100 == 0, F.lit("n/a")).otherwise(F.col(premium).cast("string"))
        )
        if code == "ES":
            damaged = damaged.withColumn("fecha_carga", F.date_format("fecha_carga", "yyyy-MM-dd HH:mm:ss"))
        currency, turn = columns[22][0], F.col(month) % 3
        shapes = (
            damaged.filter(turn == 1),
            damaged.filter(turn == 2).select(*reversed(damaged.columns)),
            damaged.filter(turn == 0).select(F.concat(F.lit("n"), F.col(ids)).alias("note"), *[c for c in damaged.columns if c != currency]),
        )
        for shape in shapes:
            sinks.write_monthly(shape, f"{root}/{code.lower()}", year, month, compression="gzip")
    return root


def _feed_schemas() -> dict:
    return {code.lower(): M.feed_schema(code) for code in M.FEEDS}


def _feed_shape(df: DataFrame, code: str) -> DataFrame:
    ids, premium, month = (M.FEEDS[code][i][0] for i in (0, 8, 2))
    rescued = F.get_json_object("_rescued_data", f"$.{premium}")
    return df.select(
        F.lit(code.lower()).alias("feed"), F.col(ids).alias("id"), F.col(month).alias("month"),
        F.col(premium).alias("premium"), rescued.alias("rescued_premium"), F.col(M.FEEDS[code][22][0]).alias("currency"),
        F.get_json_object("_rescued_data", "$.note").alias("rescued_note"),
    )


@query
def rescue_rows(spark, d):
    found = S.read_feeds(spark, _write_csv(spark, d), "ES, it", _feed_schemas())
    return _feed_shape(found["es"], "ES").unionByName(_feed_shape(found["it"], "IT"))


@query
def header_drift(spark, d):
    """Months by how their files' headers differ from the feed's schema."""
    root = _write_csv(spark, d)
    parts = []
    for code, schema in _feed_schemas().items():
        drift = header_drift_of(spark, f"{root}/{code}", schema)
        parts.append(drift.select(F.lit(code).alias("feed"), F.regexp_extract("file", r"yyyymm=(\d{6})", 1).alias("yyyymm"), "missing_columns", "new_columns", "reordered"))
    both = parts[0].unionByName(parts[1]).distinct()
    lists = {c: F.array_join(c, ",") for c in ("missing_columns", "new_columns")}
    return both.withColumns(lists)


@query
def stream_ingest(spark, d):
    """Both feeds as file streams with expectations into Parquet, read back."""
    root, target = _write_csv(spark, d), scratch_dir(spark, "bronze")
    rules = {code.lower(): rule for code, rule in M.EXPECTATIONS.items()}
    for run in ingest_feeds(spark, root, _feed_schemas(), target, f"{target}-checkpoints", rules).values():
        run.awaitTermination()
    es, it = (_feed_shape(read_ingested(spark, f"{target}/{code.lower()}"), code) for code in M.FEEDS)
    return es.unionByName(it)


@query
def stream_counts(spark, d):
    """Expectation counts over everything that the two file streams have written."""
    root, target = _write_csv(spark, d), scratch_dir(spark, "counted")
    rules = {code.lower(): rule for code, rule in M.EXPECTATIONS.items()}
    for run in ingest_feeds(spark, root, _feed_schemas(), target, f"{target}-checkpoints", rules).values():
        run.awaitTermination()
    es, it = (ingested_counts(spark, f"{target}/{code}", **rules[code]).withColumn("feed", F.lit(code)) for code in ("es", "it"))
    return es.unionByName(it)


@query
def provenance(spark, d):
    """Rows per month folder, counted through the file each row was read from."""
    found = S.union_feeds(
        {
            code: rows.select(F.regexp_extract("_source_file", r"yyyymm=(\d{6})", 1).alias("yyyymm"))
            for code, rows in S.read_feeds(spark, _write_csv(spark, d), "es,it", _feed_schemas()).items()
        }
    )
    return found.groupBy("feed", "yyyymm").agg(F.count(F.lit(1)).alias("n"))


@query
def write_monthly(spark, d):
    """Months written in two rounds: the second adds the missing ones and skips those already there."""
    es = _feed(spark, d, "ES").select("id_registro", "anio", "mes", "moneda")
    it = _feed(spark, d, "IT").select("id_riga", "anno_riferimento", "mese_riferimento", "valuta")
    feed = es.union(it)
    target = scratch_dir(spark, "monthly")
    sinks.write_monthly(feed.filter(F.col("anio") < 1998), target, "anio", "mes")
    sinks.write_monthly(feed.withColumn("moneda", F.lit("XXX")), target, "anio", "mes")
    rows = spark.read.option("header", True).csv(target)
    return rows.groupBy(F.col("yyyymm").cast("string").alias("yyyymm"), "moneda").agg(F.count(F.lit(1)).alias("n"))


@query
def append_rows(spark, d):
    """Two appends of the same rows: an append-only table grows."""

    target = scratch_dir(spark, "quality")
    for _ in range(2):
        sinks.append_rows(frame(spark, d, "dq_results"), target, DATA_QUALITY_RESULTS)
    return S.scan(spark, target).groupBy("source_system", "check_status").agg(F.count(F.lit(1)).alias("n"))


@query
def overwrite_slice(spark, d):
    """Both sources written, then ES replaced by itself with translated values; IT stays."""
    target = scratch_dir(spark, "shared")
    sinks.overwrite_slices(_columns_only(spark, d).drop("harmonization_timestamp"), target, ["source_country"])
    es = S.scan(spark, target).filter(F.col("source_country") == "ES")
    translated = values.translate_values(es, M.value_dictionary(spark), M.CATEGORICAL)
    sinks.overwrite_slice(translated, target, "source_country", "ES")
    return S.scan(spark, target).groupBy("source_country", "mapping_status", "risk_type").agg(F.count(F.lit(1)).alias("n"))


@query
def replace_by_key(spark, d):
    old = frame(spark, d, "candidates").select("source_table", "local_column_name", "review_status")
    old = old.withColumn("source_system", F.col("review_status"))
    new = old.filter(F.col("source_system") == "PENDING").withColumn("review_status", F.lit("NEW"))
    return sinks.replace_by_key(old, new, "source_system", "PENDING")


@query
def control_table_schema(spark, d):
    """Candidates written under the fixed control-table schema."""

    return conform(frame(spark, d, "candidates"), COLUMN_MAPPING_CANDIDATES).select(
        "candidate_id", "source_system", "review_status", "mandatory_flag"
    )


# Stored parts


def _stored_parts(spark, d) -> DataFrame:
    """Parts of both sources with their values as delivered, then the slices of one source after the other replaced."""
    path = scratch_dir(spark, "parts")
    PROPERTY_PARTS.refresh(_columns_only(spark, d), path)
    rows = shared(spark, d)
    for code in M.FEEDS:
        PROPERTY_PARTS.refresh(rows.filter(F.col("source_country") == code), path)
    return PROPERTY_PARTS.read(spark, path, PROPERTY_PARTS.parts(rows).schema)


@query
def parts_by_source(spark, d):
    view = PROPERTY_PARTS.view()
    kpi = view.query(_stored_parts(spark, d), ["country"], list(view.measures))
    return _rounded(_rounded(kpi, "loss_ratio", "expense_ratio", "combined_ratio"), *MONEY, digits=4)


@query
def parts_all_dimensions(spark, d):
    view = PROPERTY_PARTS.view()
    measures = ["gross_written_premium", "claims_reported", "loss_ratio"]
    kpi = view.query(_stored_parts(spark, d), list(view.dimensions), measures, where="country IN ('ES', 'IT')")
    return _rounded(_rounded(kpi, "loss_ratio"), "gross_written_premium", digits=4)


@query
def parts_loss_ratio_last3m(spark, d):
    recent = last_stored_periods(_stored_parts(spark, d), 3)
    return _rounded(PROPERTY_PARTS.view().query(recent, ["country"], ["loss_ratio"]), "loss_ratio")


@query
def parts_top_channel(spark, d):
    kpi = PROPERTY_PARTS.view().query(_stored_parts(spark, d), ["country", "distribution_channel"], ["combined_ratio"])
    return _rounded(top_by_measure(kpi, "combined_ratio", ["country"]), "combined_ratio")


@query
def distinct_sketches(spark, d):
    """Stored sketches per source and year, the slices of one source replaced, their union against the exact counts."""
    path = scratch_dir(spark, "sketches")
    by, columns = ["source_country", "reporting_year"], M.REQUIRED
    rows = shared(spark, d)
    stale = rows.withColumn("policy_number", F.concat("policy_number", F.lit("-"), F.col("record_id").cast("string")))
    K.refresh_sketches(stale, path, columns, by)
    for code in M.FEEDS:
        K.refresh_sketches(rows.filter(F.col("source_country") == code), path, columns, by)
    kept = spark.read.schema(K.column_sketches(rows, columns, by).schema).parquet(path)
    found = K.merged_counts(kept, columns, ["source_country"])
    exact = profile.required_profile(rows, columns, by=["source_country"]).drop("latest_harmonization")
    near = [
        (F.abs(F.col(f"f.distinct_{c}") - F.col(f"e.distinct_{c}")) <= F.ceil(F.col(f"e.distinct_{c}") * K.error_bound()))
        .alias(f"near_{c}")
        for c in columns
    ]
    return found.alias("f").join(exact.alias("e"), "source_country").select(
        "source_country", F.col("f.row_count").alias("row_count"), *[F.col(f"e.distinct_{c}") for c in columns], *near
    )


# Tables in buckets


@query
def merge_candidates_buckets(spark, d):
    """The merge of staged candidates into a table with a folder per hash of source and column."""

    def listed(df):
        return df.withColumns(
            {"local_sample_values": F.array("local_data_type"), "reviewed_at": F.lit(None).cast("timestamp")}
        )

    old = listed(frame(spark, d, "candidates"))
    table = BucketedTable(scratch_dir(spark, "candidates"), old.schema, ["source_system", "local_column_name"], 64)
    table.write(old)
    table.merge(listed(frame(spark, d, "staged_candidates")), merge.merge_candidates)
    return table.read(spark).withColumn("local_sample_values", F.array_join("local_sample_values", "|")).drop("reviewed_at")


@query
def sync_decisions_buckets(spark, d):
    """Decisions synced into a table bucketed by the source system."""
    old = frame(spark, d, "candidates")
    table = BucketedTable(scratch_dir(spark, "candidates"), old.schema, ["source_system"], 64)
    table.write(old)
    table.merge(frame(spark, d, "queue_state"), merge.sync_decisions)
    return table.read(spark).select("source_system", "local_column_name", "proposed_global_column_name", *merge.DECISION_COLUMNS)


# Ordered lists


@query
def status_listing(spark, d):
    return summaries.status_listing(frame(spark, d, "candidates"))


@query
def value_prompts(spark, d):
    found = profile.distinct_values(_columns_only(spark, d), M.CATEGORICAL)
    return values.value_prompts(found, model_categories(M.targets(spark)), 2)


@query
def view_positions(spark, d):
    """The order in which reviewers see the open columns, as a column."""
    listed = frame(spark, d, "candidates").withColumn("local_sample_values", F.array("local_data_type"))
    placed = review.with_view_position(review.pending_view(listed), "pending_view")
    return placed.select("source_system", "local_column_name", "mandatory_flag", "confidence", "view_position")


@query
def preview_rejected(spark, d):
    """The first five rejected columns in the order of their view."""
    shown = review.in_view_order(review.rejected_report(frame(spark, d, "candidates")), "rejected_report")
    return review.preview(shown).select("source_system", "local_column_name")


# Case folding


@query
def folded_scores(spark, d):
    """Targets that differ in case only are right, also where the other case of a letter is two letters."""
    rows = frame(spark, d, "cased_targets")
    key = rows.select("source_system", "local_column_name", F.col("expected").alias("expected_global_column_name"))
    proposals = rows.select(
        "source_system", "local_column_name", F.col("proposed").alias("proposed_global_column_name"),
        F.lit("HIGH").alias("confidence"), F.lit(None).cast("string").alias("ai_error_status"),
    )
    return E.score_proposals(key, proposals).select("source_system", "local_column_name", "correct")


# Flows


def _with_slice(table: DataFrame, system: str, merge: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """The table with the rows of one source merged. Only these are joined and written, as all that comes in is of this source."""
    own = F.coalesce(F.col("source_system") == system, F.lit(False))
    return table.filter(~own).unionByName(written(merge(table.filter(own)), name))


def _proposed(spark, d) -> DataFrame:
    """Both feeds proposed, one run each, into the candidates of all other sources."""
    candidates = conform(frame(spark, d, "candidates"), COLUMN_MAPPING_CANDIDATES)
    for code in M.FEEDS:

        def propose(own: DataFrame, code: str = code) -> DataFrame:
            return flows.propose(
                _feed(spark, d, code), M.SYSTEMS[code], f"feed_{code.lower()}", targets=M.targets(spark),
                glossary=M.glossary(spark), dictionary=empty_table(spark, "column_mapping_dictionary"),
                candidates=own, mandatory=M.MANDATORY[code],
            )

        candidates = _with_slice(candidates, M.SYSTEMS[code], propose, "proposed")
    return candidates


def _dictionary(spark, d) -> DataFrame:
    """Proposals of both feeds, a reviewer with the answer key, the gate, and the dictionary of each feed merged."""
    candidates = _proposed(spark, d)
    known = conform(frame(spark, d, "mapping_dictionary"), COLUMN_MAPPING_DICTIONARY)
    for code in M.FEEDS:
        system = M.SYSTEMS[code]

        def review_own(own: DataFrame) -> DataFrame:
            reviewed = review.apply_decisions(own, review.decide_from_key(own, M.answer_key(spark), "reader"))
            return merge.sync_decisions(own, reviewed)

        def build(own: DataFrame, candidates: DataFrame, system: str = system) -> DataFrame:
            return flows.build_dictionary(candidates, M.mandatory(spark), own, system, VERSION)

        candidates = _with_slice(candidates, system, review_own, "reviewed")
        decided = candidates
        known = _with_slice(known, system, lambda own: build(own, decided), "dictionary")
    return known


@query
def propose_run(spark, d):
    return _proposed(spark, d).select(
        "source_system", "local_column_name", "proposed_global_column_name", "proposed_match_type", "confidence",
        "mandatory_flag", "review_status",
    )


@query
def dictionary_run(spark, d):
    return _dictionary(spark, d).select(
        "source_system", "local_column_name", "global_column_name", "approved_by", "mapping_version", "active_flag"
    )


def _published(spark, d) -> flows.Published:
    return flows.publish(
        {code: _feed(spark, d, code) for code in M.FEEDS}, M.SYSTEMS, model=M.MODEL, dictionary=_dictionary(spark, d),
        mandatory=M.mandatory(spark), allowed=model_categories(M.targets(spark)), allow_lists=M.ALLOWED,
        value_glossary=M.value_glossary(spark), value_dictionary=empty_table(spark, "value_mapping_dictionary"),
        required=M.REQUIRED, rules=M.RULES, mapping_version=VERSION, run_id="run",
    )


@query
def publish_run(spark, d):
    """From the feeds to the shared table, through proposals, review, gate, dictionary and value translation."""
    return _published(spark, d).rows.drop("harmonization_timestamp")


@query
def publish_checks(spark, d):
    """The checks of such a run."""
    return _published(spark, d).checks.select("source_system", "check_name", "check_status", "metric_value", "details")
