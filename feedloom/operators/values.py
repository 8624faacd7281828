"""Category values: prompts, replies, proposals, and translation into code lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import folded
from ..functions.text import outermost_object
from ..schemas import AUTO_APPROVER, VALUE_MAPPED, VALUE_MAPPING_CANDIDATES, VALUE_MAPPING_DICTIONARY, conform
from .listing import ordered_listing


def value_prompt(values: DataFrame, allowed: DataFrame) -> DataFrame:
    """One prompt text per category column with its allow-list and its local values in order.

    ``values`` is (source_field, raw_value), ``allowed`` (source_field, allowed_value).
    """
    asked = values.groupBy("source_field").agg(
        F.array_join(F.array_sort(F.collect_set("raw_value")), ", ").alias("_local")
    )
    return _prompted(asked, allowed)


def _prompted(asked: DataFrame, allowed: DataFrame) -> DataFrame:
    """The columns of ``asked`` with its texts of local values put into prompts."""
    lists = allowed.groupBy("source_field").agg(
        F.array_join(F.array_sort(F.collect_set("allowed_value")), ", ").alias("_allowed")
    )
    return asked.join(lists, "source_field").select(
        *[c for c in asked.columns if c != "_local"],
        F.concat(
            F.lit("Give one allowed value for every local value of '"),
            "source_field",
            F.lit("'. Allowed: "),
            "_allowed",
            F.lit(". Local: "),
            "_local",
            F.lit('. Answer with one JSON object from local to allowed value, null where none is safe.'),
        ).alias("prompt"),
    )


def value_prompts(values: DataFrame, allowed: DataFrame, size: int = 200) -> DataFrame:
    """Prompts of at most ``size`` local values each, numbered from 1 per field, as :func:`value_prompt` in order.

    Values get their places by :func:`listing.ordered_listing`, so neither a task nor a
    prompt grows with the values of a field.
    """
    listed = ordered_listing(values.select("source_field", "raw_value").distinct(), ["source_field"], "raw_value")
    part = F.floor((F.col("position") - 1) / size).cast("bigint")
    numbered = listed.select(F.struct("source_field", (part + 1).alias("part")).alias("_f"), "raw_value")
    asked = numbered.groupBy("_f").agg(F.array_join(F.array_sort(F.collect_list("raw_value")), ", ").alias("_local"))
    return _prompted(asked.select("_f.*", "_local"), allowed)


def parse_value_reply(replies: DataFrame, allowed: DataFrame, reply: str = "reply") -> DataFrame:
    """Replies to rows (..., raw_value, proposed_value, ai_error_status).

    A value outside the allow-list becomes NULL. A reply without a JSON object
    gives one row with AI_ERROR and no value.
    """
    others = [c for c in replies.columns if c != reply]
    read = replies.withColumn("_m", F.from_json(outermost_object(reply), "map<string,string>"))
    rows = read.select(
        *others,
        F.when(F.col("_m").isNull(), F.lit("AI_ERROR")).alias("ai_error_status"),
        F.explode_outer("_m").alias("raw_value", "_v"),
    )
    listed = allowed.select("source_field", F.col("allowed_value").alias("_v")).distinct().withColumn("_ok", F.lit(True))
    return rows.join(listed, ["source_field", "_v"], "left").select(
        *others, "raw_value", F.when(F.col("_ok"), F.col("_v")).alias("proposed_value"), "ai_error_status"
    )


def replied_values(values: DataFrame, replies: DataFrame, allowed: DataFrame, reply: str = "reply") -> DataFrame:
    """A proposal for each distinct local value (source_system, source_field, raw_value) from one reply per column.

    A value that a reply leaves out has no proposal, one of a failed or missing
    reply has AI_ERROR besides; values that only a reply names are not taken.
    Of several replies for a column the smallest proposal counts.
    """
    column = ["source_system", "source_field"]
    parsed = parse_value_reply(replies.select(*column, reply), allowed, reply)
    read = parsed.filter("ai_error_status IS NULL")
    found = read.filter("raw_value IS NOT NULL").groupBy(*column, "raw_value").agg(F.min("proposed_value").alias("proposed_value"))
    good = replies.filter(F.from_json(outermost_object(reply), "map<string,string>").isNotNull())
    answered = good.select(*column).distinct().withColumn("_answered", F.lit(True))
    joined = values.select(*column, "raw_value").distinct().join(found, [*column, "raw_value"], "left").join(answered, column, "left")
    return joined.select(
        *column, "raw_value", "proposed_value", F.when(F.col("_answered").isNull(), F.lit("AI_ERROR")).alias("ai_error_status")
    )


def propose_values(values: DataFrame, allowed: DataFrame, glossary: DataFrame) -> DataFrame:
    """A code per distinct local value: the equal code after trim and full case folding, else the glossary's.

    ``glossary`` is (source_field, raw_value, code); a code outside the allow-list is not proposed.
    """
    fold = lambda c: folded(F.trim(c))
    codes = allowed.groupBy("source_field", fold(F.col("allowed_value")).alias("_key")).agg(
        F.min("allowed_value").alias("_same")
    )
    listed = allowed.select("source_field", F.col("allowed_value").alias("code")).distinct()
    terms = (
        glossary.join(listed, ["source_field", "code"], "left_semi")
        .groupBy("source_field", fold(F.col("raw_value")).alias("_key"))
        .agg(F.min("code").alias("_term"))
    )
    keyed = values.withColumn("_key", fold(F.col("raw_value")))
    joined = keyed.join(codes, ["source_field", "_key"], "left").join(terms, ["source_field", "_key"], "left")
    return joined.select(*values.columns, F.coalesce("_same", "_term").alias("proposed_value"))


def stage_value_candidates(proposals: DataFrame, *, now: Column | None = None) -> DataFrame:
    """Proposals as candidate rows: approved at once if there is a code, else PENDING with no reviewer."""
    now = F.current_timestamp() if now is None else now
    approved = F.col("proposed_value").isNotNull()
    failed = F.col("ai_error_status") if "ai_error_status" in proposals.columns else F.lit(None).cast("string")
    staged = proposals.select(
        F.xxhash64("source_system", "source_field", "raw_value").alias("candidate_id"),
        "source_system",
        "source_field",
        "raw_value",
        F.col("proposed_value").alias("proposed_harmonized_value"),
        F.when(approved, F.lit("HIGH")).otherwise(F.lit("LOW")).alias("confidence"),
        failed.alias("ai_error_status"),
        F.when(approved, F.lit("APPROVED")).otherwise(F.lit("PENDING")).alias("review_status"),
        F.col("proposed_value").alias("final_harmonized_value"),
        F.when(approved, F.lit(AUTO_APPROVER)).alias("reviewed_by"),
        F.when(approved, now).alias("reviewed_at"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )
    return conform(staged, VALUE_MAPPING_CANDIDATES)


def stage_value_dictionary(candidates: DataFrame, mapping_version: str, *, now: Column | None = None) -> DataFrame:
    """Approved candidates as dictionary rows, ready for the dictionary merge."""
    now = F.current_timestamp() if now is None else now
    approved = candidates.filter((F.col("review_status") == "APPROVED") & F.col("final_harmonized_value").isNotNull())
    return conform(
        approved.select(
            "source_field",
            "source_system",
            "raw_value",
            F.col("final_harmonized_value").alias("harmonized_value"),
            F.lit("APPROVED").alias("approval_status"),
            F.lit(AUTO_APPROVER).alias("approved_by"),
            now.alias("approved_at"),
            F.lit(mapping_version).alias("mapping_version"),
            F.lit(True).alias("active_flag"),
            now.alias("created_at"),
            now.alias("updated_at"),
        ),
        VALUE_MAPPING_DICTIONARY,
    )


def _active_entries(dictionary: DataFrame) -> DataFrame:
    return dictionary.filter("active_flag").select("source_system", "source_field", "raw_value", "harmonized_value")


def translate_values(
    df: DataFrame, dictionary: DataFrame, fields: Sequence[str], *, source: str = "source_system"
) -> DataFrame:
    """Replace category values by their active translation; values without one stay.

    One left join per field on source and value, with one row per key on the
    dictionary's side; the optimizer broadcasts a dictionary that it knows to be
    small. Two active translations of a value fail the job when a row holds the
    value; a NULL translation beside another one does not count.
    ``mapping_status`` is set for the rows of sources with an active entry for one
    of the fields.
    """
    entries = _active_entries(dictionary).filter(F.col("source_field").isin(list(fields)))
    result = df
    for field in fields:
        own = (
            entries.filter(F.col("source_field") == field)
            .groupBy(F.col("source_system").alias(source), F.col("raw_value").alias(field))
            .agg(F.max("harmonized_value").alias("_code"), F.min("harmonized_value").alias("_other"))
        )
        clash = F.raise_error(F.lit(f"two active translations for one value of {field}"))
        code = F.when(F.col("_code") != F.col("_other"), clash.cast("string")).otherwise(F.col("_code"))
        joined = result.join(own, [source, field], "left")
        result = joined.withColumn(field, F.coalesce(code, F.col(field))).drop("_code", "_other")
    if "mapping_status" in df.columns:
        known = entries.select(F.col("source_system").alias(source)).distinct().withColumn("_known", F.lit(True))
        status = F.when(F.col("_known"), F.lit(VALUE_MAPPED)).otherwise(F.col("mapping_status"))
        result = result.join(known, source, "left").withColumn("mapping_status", status)
    return result.select(*(f"`{c}`" for c in df.columns))
