"""Projection of a feed to the shared schema through its dictionary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import COLUMN_MAPPED
from ..sources.feeds import business_columns
from .dictionary import active_mappings


def first_wins(mappings: DataFrame) -> DataFrame:
    """One local column per source and target: the first by name."""
    return mappings.groupBy("source_system", "global_column_name").agg(
        F.min("local_column_name").alias("local_column_name")
    )


def resolve_columns(feed: DataFrame, dictionary: DataFrame, source_system: str) -> dict[str, str]:
    """Target to local column for the columns this feed has.

    The entries come to the driver because they shape the select list: one per
    target, whatever the number of dictionary rows behind it.
    """
    present = business_columns(feed).columns
    usable = active_mappings(dictionary, source_system).filter(F.col("local_column_name").isin(present))
    rows = first_wins(usable).select("global_column_name", "local_column_name").collect()
    return dict(sorted((row[0], row[1]) for row in rows))


def project(
    feed: DataFrame,
    mapping: Mapping[str, str],
    model: Mapping[str, str],
    *,
    on_error: str = "fail",
) -> DataFrame:
    """Rename, pad and cast in one select; targets outside the model keep their type.

    ``model`` is target name to type. ``on_error="null"`` turns values that do not
    fit into NULL instead of failing.
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', got {on_error!r}")

    def fitted(column: Column, kind: str) -> Column:
        return column.cast(kind) if on_error == "fail" else column.try_cast(kind)

    shaped = [
        (fitted(F.col(f"`{mapping[name]}`"), kind) if name in mapping else F.lit(None).cast(kind)).alias(name)
        for name, kind in model.items()
    ]
    extra = [F.col(f"`{local}`").alias(name) for name, local in sorted(mapping.items()) if name not in model]
    return feed.select(*shaped, *extra)


def stamp_metadata(
    df: DataFrame, source_country: str, source_system: str, mapping_version: str, *, now: Column | None = None
) -> DataFrame:
    """Add source, time, dictionary version and status of the projection."""
    return df.withColumns(
        {
            "source_country": F.lit(source_country),
            "source_system": F.lit(source_system),
            "harmonization_timestamp": F.current_timestamp() if now is None else now,
            "column_mapping_version": F.lit(mapping_version),
            "mapping_status": F.lit(COLUMN_MAPPED),
        }
    )


def harmonize(
    feed: DataFrame,
    dictionary: DataFrame,
    model: Mapping[str, str],
    *,
    source_country: str,
    source_system: str,
    mapping_version: str,
    on_error: str = "fail",
    now: Column | None = None,
) -> DataFrame:
    """A feed under the shared schema: resolved mapping, one narrow select, metadata. No shuffle."""
    mapping = resolve_columns(feed, dictionary, source_system)
    if not mapping:
        raise ValueError(f"no active column mapping for {source_system}")
    return stamp_metadata(
        project(feed, mapping, model, on_error=on_error), source_country, source_system, mapping_version, now=now
    )


def mapping_report(inventory: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Each column of feed or dictionary with what the projection does with it.

    MAPPED, SKIPPED_DUPLICATE (another local column feeds the target), NOT_IN_FEED, NOT_MAPPED.
    """
    keys = ["source_system", "local_column_name"]
    columns = inventory.select(*keys).distinct().withColumn("_feed", F.lit(True))
    active = active_mappings(dictionary).select(*keys, "global_column_name")
    fed = active.join(columns, keys, "left_semi")
    winners = first_wins(fed).withColumn("_wins", F.lit(True))
    rated = active.join(winners, [*keys, "global_column_name"], "left")
    known = columns.join(rated, keys, "left")
    only_mapped = rated.join(columns, keys, "left_anti").withColumn("_feed", F.lit(None).cast("boolean"))
    return known.unionByName(only_mapped).select(
        *keys,
        "global_column_name",
        F.when(F.col("global_column_name").isNull(), F.lit("NOT_MAPPED"))
        .when(F.col("_feed").isNull(), F.lit("NOT_IN_FEED"))
        .when(F.col("_wins"), F.lit("MAPPED"))
        .otherwise(F.lit("SKIPPED_DUPLICATE"))
        .alias("column_status"),
    )
