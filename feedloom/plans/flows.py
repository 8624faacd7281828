"""The two flows over a set of feeds: propose a mapping, and publish the shared table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.local import local_frame
from ..functions.scratch import written
from ..operators import dictionary as D
from ..operators import gate, quality
from ..operators.harmonize import harmonize
from ..operators.match import approved_examples, pending_columns, propose_mappings, stage_candidates
from ..operators.merge import deactivate_stale, merge_candidates, merge_dictionary, merge_value_dictionary
from ..operators.profile import distinct_values, inventory_columns
from ..schemas import struct
from ..operators.values import (
    propose_values,
    stage_value_candidates,
    stage_value_dictionary,
    translate_values,
)


def propose(
    feed: DataFrame,
    source_system: str,
    source_table: str,
    *,
    targets: DataFrame,
    glossary: DataFrame,
    dictionary: DataFrame,
    candidates: DataFrame,
    mandatory: Sequence[str],
) -> DataFrame:
    """Feed to candidates: inventory, pending columns, one proposal each, merged into the candidates."""
    inventory = inventory_columns(feed, source_system, source_table)
    pending = pending_columns(inventory, dictionary)
    examples = approved_examples(dictionary, source_system)
    proposals = propose_mappings(pending, targets, glossary, examples)
    return merge_candidates(candidates, stage_candidates(proposals, mandatory))


def build_dictionary(
    candidates: DataFrame, mandatory: DataFrame, dictionary: DataFrame, source_system: str, mapping_version: str
) -> DataFrame:
    """Gate, then the reviewed candidates of one source merged into the dictionary, stale entries switched off."""
    own = candidates.filter(F.col("source_system") == source_system)
    gate.enforce_gate(own, mandatory.filter(F.col("source_system") == source_system))
    staged = D.stage_dictionary(D.resolve_dictionary(own), mapping_version)
    return deactivate_stale(merge_dictionary(dictionary, staged), staged, source_system)


@dataclass(frozen=True)
class Published:
    """The shared rows, the value candidates and dictionary behind them, and the check results."""

    rows: DataFrame
    value_candidates: DataFrame
    value_dictionary: DataFrame
    checks: DataFrame


def publish(
    feeds: Mapping[str, DataFrame],
    systems: Mapping[str, str],
    *,
    model: Mapping[str, str],
    dictionary: DataFrame,
    mandatory: DataFrame,
    allowed: DataFrame,
    allow_lists: Mapping[str, Sequence[str]],
    value_glossary: DataFrame,
    value_dictionary: DataFrame,
    required: Sequence[str],
    rules: Sequence[quality.Rule],
    mapping_version: str,
    run_id: str,
) -> Published:
    """Feeds to the shared table: projection, value translation, checks per source in one pass.

    ``feeds`` and ``systems`` are keyed by source code. The value dictionary is
    merged from proposals for the distinct values and written, so that the feeds
    are read for it once, and rows are moved by their few category values only if
    it is too large to be broadcast.
    """
    by = ["source_system"]
    shared = reduce(
        DataFrame.unionByName,
        [
            harmonize(
                feed, dictionary, model, source_country=code, source_system=systems[code],
                mapping_version=mapping_version,
            )
            for code, feed in feeds.items()
        ],
    )
    fields = sorted(allow_lists)
    proposals = propose_values(distinct_values(shared, fields, by), allowed, value_glossary)
    candidates = stage_value_candidates(proposals)
    merged = written(merge_value_dictionary(value_dictionary, stage_value_dictionary(candidates, mapping_version)), "values")
    rows = translate_values(shared, merged, fields)
    raw = reduce(
        DataFrame.unionByName, [feed.select(F.lit(systems[code]).alias("source_system")) for code, feed in feeds.items()]
    )
    sources = local_frame(shared.sparkSession, [(systems[code],) for code in feeds], struct("source_system string"))
    checks = quality.quality_report(
        [
            quality.check_mapping_coverage(mandatory, dictionary, by, sources),
            quality.quality_checks(
                rows, required=required, allowed=allow_lists, rules=rules, by=by, sources=sources, raw=raw,
            ),
        ],
        run_id,
    )
    return Published(rows, candidates, merged, checks)
