"""Column matching: pending columns, prompts, replies, and the distributed token matcher."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import is_set, null_of, real_target
from ..functions.text import DEFAULT_TEMPLATE, fill_template, name_tokens, outermost_object, snake, type_family
from ..schemas import COLUMN_MAPPING_CANDIDATES, conform

REPLY_KEYS = ("global_column_name", "match_type", "rationale", "confidence")


def pending_columns(inventory: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Inventory columns without an active dictionary entry of their source."""
    active = dictionary.filter("active_flag").select("source_system", "local_column_name")
    return inventory.join(active, ["source_system", "local_column_name"], "left_anti")


def approved_examples(dictionary: DataFrame, source_system: str, limit: int | None = None) -> DataFrame:
    """Active pairs of the other sources; with ``limit`` a listing of the first ones by local name."""
    found = (
        dictionary.filter(
            (F.col("source_system") != source_system) & F.col("active_flag") & real_target("global_column_name")
        )
        .select("local_column_name", "global_column_name", "source_system")
    )
    return found if limit is None else found.orderBy(*found.columns).limit(limit)


def prompt_text(
    columns: DataFrame,
    *,
    context: str,
    target_columns: Sequence[str],
    template: str = DEFAULT_TEMPLATE,
    examples: Sequence[tuple[str, str]] = (),
    extra: Mapping[str, str] | None = None,
    reply_keys: Sequence[str] = REPLY_KEYS,
    output: str = "prompt",
) -> DataFrame:
    """Add one prompt text per source column; a NULL part makes the text NULL."""
    parts = fill_template(
        template, context=context, target_columns=target_columns, reply_keys=reply_keys, extra=extra
    )
    if examples:
        lines = [f"{local} -> {target}" for local, target in examples]
        parts.append("\n".join(["", "Approved pairs of other sources (local -> target):", *lines]))
    pieces = [F.lit(p) if isinstance(p, str) else p for p in parts] or [F.lit("")]
    return columns.withColumn(output, F.concat(*pieces))


def parse_reply(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Proposal columns from free-text replies; AI_ERROR if there is no object or no target in it."""
    schema = ", ".join(f"{key} string" for key in REPLY_KEYS)
    read = replies.withColumn("_r", F.from_json(outermost_object(reply), schema))
    return read.select(
        *replies.columns,
        F.col("_r.global_column_name").alias("proposed_global_column_name"),
        F.col("_r.match_type").alias("proposed_match_type"),
        F.col("_r.rationale").alias("mapping_rationale"),
        F.col("_r.confidence").alias("confidence"),
        F.when(~is_set("_r.global_column_name"), F.lit("AI_ERROR")).alias("ai_error_status"),
    )


WEIGHTS: Mapping[str, float] = {"name": 0.6, "type": 0.15, "values": 0.15, "example": 0.1}
CUTS: Mapping[str, float] = {"HIGH": 0.65, "MEDIUM": 0.4}


def _name_candidates(names: DataFrame, targets: DataFrame, glossary: DataFrame, examples: DataFrame | None) -> DataFrame:
    """Per distinct column name the targets that share a token or an approved example with it.

    Names meet targets through equal tokens and equal example names, so a name
    never meets a target that it has nothing in common with. The list per name is
    bounded by the number of target columns.
    """
    words = glossary.groupBy("local_token").agg(F.min("global_token").alias("global_token"))
    spelled = names.select("local_column_name", F.explode(name_tokens("local_column_name")).alias("local_token"))
    tokens = (
        spelled.join(words, "local_token", "left")
        .withColumn("token", F.coalesce("global_token", "local_token"))
        .groupBy("local_column_name", "token")
        .agg(F.max(F.coalesce(F.col("global_token") != F.col("local_token"), F.lit(False))).alias("translated"))
    )
    sizes = tokens.groupBy("local_column_name").agg(
        F.count(F.lit(1)).alias("n_local"), F.max("translated").alias("translated")
    )
    model = targets.select(
        "global_column_name",
        "global_data_type",
        "example_values",
        name_tokens("global_column_name").alias("target_tokens"),
    )
    target_tokens = model.select(
        "global_column_name", F.size("target_tokens").alias("n_target"), F.explode("target_tokens").alias("token")
    )
    shared = (
        tokens.join(target_tokens, "token")
        .groupBy("local_column_name", "global_column_name")
        .agg(F.count(F.lit(1)).alias("n_shared"), F.first("n_target").alias("n_target"))
        .join(sizes, "local_column_name")
        .select(
            "local_column_name",
            "global_column_name",
            (F.col("n_shared") / (F.col("n_local") + F.col("n_target") - F.col("n_shared"))).alias("overlap"),
            "translated",
            F.lit(0).alias("example"),
        )
    )
    pairs = shared
    if examples is not None:
        known = (
            examples.select("local_column_name", "global_column_name")
            .distinct()
            .join(names, "local_column_name", "left_semi")
            .select(
                "local_column_name",
                "global_column_name",
                F.lit(0.0).alias("overlap"),
                F.lit(False).alias("translated"),
                F.lit(1).alias("example"),
            )
        )
        pairs = (
            shared.unionByName(known)
            .groupBy("local_column_name", "global_column_name")
            .agg(
                F.max("overlap").alias("overlap"),
                F.max("translated").alias("translated"),
                F.max("example").alias("example"),
            )
        )
    described = pairs.join(model.drop("target_tokens"), "global_column_name")
    return described.groupBy("local_column_name").agg(
        F.collect_list(
            F.struct(
                "global_column_name", "global_data_type", "example_values", "overlap", "translated", "example"
            )
        ).alias("options")
    )


def propose_mappings(
    columns: DataFrame,
    targets: DataFrame,
    glossary: DataFrame,
    examples: DataFrame | None = None,
    *,
    weights: Mapping[str, float] = WEIGHTS,
    cuts: Mapping[str, float] = CUTS,
) -> DataFrame:
    """One proposal per inventory row: target, match type, rationale, confidence, score.

    Score = weighted sum of the token overlap of the names, equal type family,
    share of samples in the target's value list, and an approved example of
    another source. Names are matched once per distinct name; each inventory row
    then picks its best option within the row, ties by target name.
    """
    names = columns.select("local_column_name").distinct()
    options = _name_candidates(names, targets, glossary, examples)
    samples = F.coalesce(F.col("sample_values"), F.array().cast("array<string>"))
    family = type_family("local_data_type")

    def scored(option: Column) -> Column:
        fits = F.when(family == type_family(option["global_data_type"]), F.lit(1.0)).otherwise(F.lit(0.0))
        allowed = F.coalesce(option["example_values"], F.array().cast("array<string>"))
        hits = F.size(F.array_intersect(samples, allowed)) / F.greatest(F.size(F.array_distinct(samples)), F.lit(1))
        score = F.round(
            F.lit(weights["name"]) * option["overlap"]
            + F.lit(weights["type"]) * fits
            + F.lit(weights["values"]) * hits
            + F.lit(weights["example"]) * option["example"],
            6,
        )
        return F.struct(
            (-score).alias("minus"),
            option["global_column_name"].alias("target"),
            option["global_data_type"].alias("data_type"),
            option["overlap"].alias("overlap"),
            option["translated"].alias("translated"),
            option["example"].alias("example"),
            fits.alias("fits"),
            hits.alias("hits"),
        )

    picked = columns.join(options, "local_column_name", "left").withColumn(
        "_b", F.array_min(F.transform("options", scored))
    )
    found = F.col("_b").isNotNull()
    score = F.when(found, -F.col("_b.minus")).otherwise(F.lit(0.0))
    same_name = snake("local_column_name") == F.lower(F.col("_b.target"))
    reason = F.format_string(
        "name overlap %.3f, type match %.0f, sample share %.2f, example %d",
        F.col("_b.overlap"), F.col("_b.fits"), F.col("_b.hits"), F.col("_b.example"),
    )
    return picked.select(
        *columns.columns,
        F.when(found, F.col("_b.target")).otherwise(F.lit("NO_MATCH")).alias("proposed_global_column_name"),
        F.col("_b.data_type").alias("proposed_global_data_type"),
        F.when(~found, F.lit("NO_MATCH"))
        .when(same_name, F.lit("DIRECT"))
        .when(F.col("_b.translated") | (F.col("_b.example") == 1), F.lit("SEMANTIC_TRANSLATION"))
        .otherwise(F.lit("DIRECT"))
        .alias("proposed_match_type"),
        F.when(found, reason).otherwise(F.lit("no shared token and no approved example")).alias("mapping_rationale"),
        F.when(score >= cuts["HIGH"], F.lit("HIGH"))
        .when(score >= cuts["MEDIUM"], F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
        .alias("confidence"),
        null_of().alias("ai_error_status"),
        score.alias("score"),
    )


def stage_candidates(
    proposals: DataFrame, mandatory: DataFrame | Sequence[str] = (), *, now: Column | None = None
) -> DataFrame:
    """Proposals as candidate rows: PENDING, undecided, with a stable id from source and column.

    ``mandatory`` is a list of local names, or a frame (source_system, local_column_name).
    """
    now = F.current_timestamp() if now is None else now
    if isinstance(mandatory, DataFrame):
        keys = ["source_system", "local_column_name"]
        marked = mandatory.select(*keys).distinct().withColumn("_m", F.lit(True))
        flagged = proposals.join(marked, keys, "left").withColumn(
            "mandatory_flag", F.coalesce("_m", F.lit(False))
        )
    else:
        flagged = proposals.withColumn("mandatory_flag", F.col("local_column_name").isin(list(mandatory)))
    if "sample_values" in flagged.columns:
        flagged = flagged.withColumnRenamed("sample_values", "local_sample_values")
    staged = flagged.withColumns(
        {
            "candidate_id": F.xxhash64("source_system", "local_column_name"),
            "review_status": F.lit("PENDING"),
            "created_at": now,
            "updated_at": now,
        }
    )
    return conform(staged.select(*[c for c in staged.columns if c in COLUMN_MAPPING_CANDIDATES.names]), COLUMN_MAPPING_CANDIDATES)
