"""A corpus pipeline of five stages over the documents; each works on all that the one before kept.

Toxicity (documents that it rejects go), exact dedup (of equal texts the smallest id stays), near-dedup (one document of each
component stays), mixing to target weights (a budget of 80 percent of the tokens; at most one epoch, so no document is repeated),
BPE encoding and decoding (the encoded corpus, one row per document). Inputs may have nulls in any column; a document with a null
id is never a near-duplicate of another. Rows that repeat id and text are copies, of which one stays; ties among copies go to the
smallest id, in the mixing to a hash of it. Texts of any length are taken whole. Other columns, whatever their names, are carried
along to the last stage. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import bpe, exact_dedup, mixing, near_dedup, queries, toxicity
from feedloom.llm.shared import stored

MIX_PERCENT = 80


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ship(spark)
    model = toxicity.fit(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ship(spark)
    return exact_dedup.deduped(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ship(spark)
    gone = near_dedup.near_dedup(docs, width=5).filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ship(spark)
    plan = mixing.mix(docs, percent=MIX_PERCENT, weights=queries.WEIGHTS, max_epochs=1)
    # A row's place in the plan is its leaf and its id; the domain follows from the source.
    key = ("doc_id", "lang", "source")
    out = plan.filter("copies = 0").select(*(F.col(c).alias(f"out_{c}") for c in key)).distinct()
    same = [docs[c].eqNullSafe(out[f"out_{c}"]) for c in key]
    return docs.join(out, same, "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ship(spark)
    return bpe.round_trip(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("near_dedup", remove_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
