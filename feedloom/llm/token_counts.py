"""Token counts (operator 3): an exact length histogram that answers for every context limit.

Documents are counted by encoded length. Running sums over the lengths, from both ends, then answer without the documents: how
many tokens there are, which length is at which quantile, and how many tokens are left when texts are cut at a limit.

The sums are two-level (within ranges of ``RANGE`` lengths, and over the ranges' totals), so no task holds all lengths of an
unbounded corpus: a range has at most ``RANGE`` rows, and the totals are one row per range. Null is an empty text of length 0,
which is a length like any other. Ties don't exist (one row per length); repeated rows count each time; an empty table gives an
empty histogram. Null groups are a group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import codec, vocabulary_path
from .shared import stored

RANGE = 4096


def encoded_lengths(docs: DataFrame, text_col: str = "text", group_cols: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Rows (groups, n_tokens, n_docs): lengths counted in each Arrow batch already."""
    path = path or vocabulary_path()
    names = [f"g{k}" for k in range(len(group_cols))]
    source = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(group_cols, names)), F.col(f"`{text_col}`").alias("text"))
    schema = ", ".join([*(f"{n} {kind}" for n, kind in source.dtypes[:-1]), "n_tokens long, n_docs long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            sizes = [len(ids) for ids in coder.encode_batch(t.as_py() for t in batch.column(len(names)))]
            rows = pa.table([*batch.columns[: len(names)], pa.array(sizes, pa.int64())], [*names, "n_tokens"])
            counted = rows.group_by([*names, "n_tokens"]).aggregate([([], "count_all")])
            yield from counted.rename_columns([*names, "n_tokens", "n_docs"]).to_batches()

    return source.mapInArrow(run, schema)


def length_histogram(docs: DataFrame, text_col: str = "text", group_cols: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Per group and length L: n_docs and tokens of that length, docs_upto, docs_from, tokens_upto, tokens_from (L included),
    truncated_total (tokens left at limit L), docs_total, tokens_total and quantile (share of documents of at most L)."""
    names = [f"g{k}" for k in range(len(group_cols))]
    counts = encoded_lengths(docs, text_col, group_cols, path).groupBy(*names, "n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    # Both levels of the sums read the counts; written once, no text is encoded twice.
    counts = stored(counts, "lengths")
    rows = counts.withColumns({"tokens": F.col("n_tokens") * F.col("n_docs"), "range": F.floor(F.col("n_tokens") / RANGE)})
    order = W.partitionBy(*names, "range").orderBy("n_tokens")
    sums = rows.withColumns(
        {
            "docs_in": F.sum("n_docs").over(order),
            "tokens_in": F.sum("tokens").over(order),
        }
    )
    totals = rows.groupBy(*names, "range").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    group = W.partitionBy(*names, F.lit(0))
    before = group.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = totals.withColumns(
        {
            "d_before": F.coalesce(F.sum("d").over(before), F.lit(0)),
            "t_before": F.coalesce(F.sum("t").over(before), F.lit(0)),
            "docs_total": F.sum("d").over(group),
            "tokens_total": F.sum("t").over(group),
        }
    ).select(*(F.col(n).alias(f"r_{n}") for n in names), F.col("range").alias("r"), "d_before", "t_before", "docs_total", "tokens_total")
    same = [F.col(n).eqNullSafe(F.col(f"r_{n}")) for n in names] + [F.col("range") == F.col("r")]
    joined = sums.join(ranges, same)
    upto, tokens_upto = F.col("d_before") + F.col("docs_in"), F.col("t_before") + F.col("tokens_in")
    return joined.select(
        *(F.col(n).alias(c) for n, c in zip(names, group_cols)),
        "n_tokens",
        "n_docs",
        "tokens",
        upto.alias("docs_upto"),
        (F.col("docs_total") - upto + F.col("n_docs")).alias("docs_from"),
        tokens_upto.alias("tokens_upto"),
        (F.col("tokens_total") - tokens_upto + F.col("tokens")).alias("tokens_from"),
        (tokens_upto + F.col("n_tokens") * (F.col("docs_total") - upto)).alias("truncated_total"),
        "docs_total",
        "tokens_total",
        (upto / F.col("docs_total")).alias("quantile"),
    )


def truncated_totals(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """Per limit: (context_limit, total, docs_cut), from an ungrouped histogram alone."""
    asked = F.explode(F.array(*(F.lit(int(x)).cast("long") for x in limits)))
    each = histogram.select(asked.alias("context_limit"), "n_tokens", "n_docs")
    return each.groupBy("context_limit").agg(
        F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("total"),
        F.sum(F.when(F.col("n_tokens") > F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("docs_cut"),
    )


def quantiles(histogram: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Per share: the smallest length that at least this share of the documents doesn't exceed."""
    asked = F.explode(F.array(*(F.lit(float(x)) for x in shares)))
    each = histogram.select(asked.alias("share"), "n_tokens", "quantile").filter("quantile >= share")
    return each.groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
