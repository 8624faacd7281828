"""Mixing sources to target weights (operator 6) by hierarchical budgeting; DataFrame operations only.

The tree is domain > language > source. A node's capacity is what its leaves can give: their tokens times ``max_epochs``. The
token budget goes down the tree: the children of a node share its budget by their weights, none gets more than its capacity,
and what a full child leaves over goes to its siblings by their weights. As a node's share is cut only at the capacity of its
whole subtree, a shortage is met by the siblings first and reaches the ancestors' other children only when these are full.
Shares are whole tokens (integer division; remainders stay unspent), so they do not depend on the order of any sum.

A leaf takes its whole documents as often as its share holds complete epochs, and of the next epoch a prefix: documents in the
order of a hash of seed, epoch and id, up to the last one whose running total of tokens is within the share. The order is found
without a sort of a leaf: tokens are summed by (leaf, one of ``2**BIN_BITS`` hash ranges), running totals over these ranges find
the one where the share ends, and only that range is ordered document by document.

Tokens of a text are its words ``[^\\x20\\x09-\\x0D]+`` (null: none). Null domains, languages and sources are nodes of their own.
A node without a weight has ``default_weight``; a weight of 0 gets nothing. Texts without tokens cost nothing and are taken with
the prefix they fall into. Ties in the hash go by id; rows with equal ids stand at one place and are taken together or not at
all. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import picked, stored

BIN_BITS = 12
LEVELS = ("domain", "lang", "source")


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def number_domain(source: Column, domains: int = 4) -> Column:
    """A domain for the numbered sources of the test tables: the number modulo ``domains``; null without a number."""
    return F.concat(F.lit("domain"), (F.expr("try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') as int)") % domains).cast("string"))


def _weight(level: int, weights: Mapping[Sequence, int], default: int) -> Column:
    """Weights by path, as literals: the mapping is part of the query."""
    out = F.lit(default).cast("long")
    for path, weight in weights.items():
        if len(path) == level + 1:
            same = F.lit(True)
            for name, value in zip(LEVELS, path):
                same = same & F.col(name).eqNullSafe(F.lit(value))
            out = F.when(same, F.lit(int(weight)).cast("long")).otherwise(out)
    return out


def _shared_out(children: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``share`` to rows (keys, budget, weight, capacity): budget by weight, capped, the rest to the siblings.

    In the order of capacity per weight, a child is full when its capacity is at most its part of what all fuller ones left.
    """
    by = W.partitionBy(*keys[:-1])
    order = by.orderBy(F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).asc_nulls_last(), F.col(keys[-1]).asc_nulls_first())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    wide = "decimal(38,0)"
    ranked = children.withColumns(
        {
            "left": F.greatest(F.col("budget") - F.coalesce(F.sum(F.when(F.col("weight") > 0, F.col("capacity"))).over(before), F.lit(0)), F.lit(0)),
            "weights": F.sum("weight").over(by) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "nth": F.row_number().over(order),
        }
    )
    full = (F.col("weight") > 0) & (F.col("capacity").cast(wide) * F.col("weights") <= F.col("left").cast(wide) * F.col("weight"))
    split = ranked.withColumn("full", full).withColumn("first", F.min(F.when(~F.col("full") & (F.col("weight") > 0), F.col("nth"))).over(by))
    is_full = (F.col("weight") > 0) & (F.col("first").isNull() | (F.col("nth") < F.col("first")))
    pivot = split.withColumns({"is_full": is_full}).withColumns(
        {
            "rest": F.max(F.when(F.col("nth") == F.col("first"), F.col("left"))).over(by),
            "among": F.max(F.when(F.col("nth") == F.col("first"), F.col("weights"))).over(by),
        }
    )
    share = F.when(F.col("is_full"), F.col("capacity")).when(
        F.col("weight") > 0, F.expr(f"cast(cast(rest as {wide}) * weight div among as long)")
    )
    return pivot.withColumn("share", F.coalesce(share, F.lit(0).cast("long"))).drop("left", "weights", "nth", "full", "first", "is_full", "rest", "among")


def leaf_shares(leaves: DataFrame, budget: Column, weights: Mapping[Sequence, int], default_weight: int, max_epochs: int) -> DataFrame:
    """Rows (domain, lang, source, tokens) of the leaves to these with ``share``; as small as the tree."""
    caps = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    parent = None
    for level in range(len(LEVELS)):
        keys = LEVELS[: level + 1]
        nodes = caps.groupBy(*keys).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(level, weights, default_weight))
        if parent is None:
            nodes = nodes.withColumn("budget", budget)
        else:
            up = parent.select(*(F.col(k).alias(f"up_{k}") for k in keys[:-1]), F.col("share").alias("budget"))
            same = [nodes[k].eqNullSafe(up[f"up_{k}"]) for k in keys[:-1]]
            nodes = nodes.join(up, same).select(*nodes.columns, "budget")
        parent = _shared_out(nodes, keys).select(*keys, "share")
    tokens = leaves.select(*(F.col(k).alias(f"l_{k}") for k in LEVELS), "tokens")
    same = [parent[k].eqNullSafe(tokens[f"l_{k}"]) for k in LEVELS]
    return parent.join(tokens, same).select(*LEVELS, "tokens", "share")


def _order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """60 bits of an MD5, the same in every SQL engine."""
    text = F.concat_ws(":", F.lit(seed).cast("string"), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    renamed = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    return renamed, [left[c].eqNullSafe(renamed[f"r_{c}"]) for c in names]


def mix(
    docs: DataFrame,
    percent: int = 50,
    weights: Mapping[Sequence, int] | None = None,
    default_weight: int = 1,
    max_epochs: int = 4,
    seed: int = 17,
    domain: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Per row: doc_id, domain, lang, source, tokens, copies (0: left out). The budget is ``percent`` of all tokens."""
    rows = picked(docs, doc_id=id_col, text=text_col, lang=lang_col, source=source_col)
    rows = rows.withColumn("domain", number_domain(F.col("source")) if domain is None else domain)
    rows = stored(rows.select("doc_id", "domain", "lang", "source", tokens_of(F.col("text")).alias("tokens")), "mix-rows")
    leaves = stored(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total")).first()["total"]
    shares = leaf_shares(leaves, F.lit(int(total) * percent // 100).cast("long"), weights or {}, default_weight, max_epochs)
    plan = shares.select(
        *LEVELS,
        F.expr("if(tokens = 0, if(share > 0, 1, 0), share div tokens)").alias("whole"),
        F.expr("if(tokens = 0, 0, share % tokens)").alias("part"),
    )
    plan = stored(plan, "mix-plan")
    right, same = _same(rows, plan, LEVELS)
    planned = rows.join(right, same).select("doc_id", *LEVELS, "tokens", F.col("r_whole").alias("whole"), F.col("r_part").alias("part"))
    keyed = planned.withColumn("at", _order_key(seed, F.col("whole"), F.col("doc_id")))
    keyed = stored(keyed.withColumn("bin", F.shiftright("at", 60 - BIN_BITS)), "mix-keyed")
    bins = keyed.groupBy(*LEVELS, "bin").agg(F.sum("tokens").alias("tokens"), F.first("part").alias("part"))
    running = F.sum("tokens").over(W.partitionBy(*LEVELS).orderBy("bin"))
    edges = bins.withColumn("upto", running)
    # The first range that passes the share, and what is left of the share there; no such range: all of it fits.
    cut = edges.filter("upto > part").groupBy(*LEVELS).agg(F.min("bin").alias("bin"), F.min_by(F.expr("part - (upto - tokens)"), "bin").alias("left"))
    right, same = _same(keyed, stored(cut, "mix-cut"), LEVELS)
    placed = keyed.join(right, same, "left").select(*keyed.columns, F.col("r_bin").alias("cut"), F.col("r_left").alias("left"))
    inside = F.sum("tokens").over(W.partitionBy(*LEVELS).orderBy(F.struct("at", "doc_id")))
    edge = placed.filter("bin = cut").withColumn("extra", (inside <= F.col("left")) & (F.col("part") > 0))
    clear = placed.filter("cut is null or bin <> cut").withColumn("extra", (F.coalesce(F.col("bin") < F.col("cut"), F.lit(True))) & (F.col("part") > 0))
    out = clear.unionByName(edge)
    return out.select("doc_id", *LEVELS, "tokens", (F.col("whole") + F.col("extra").cast("long")).alias("copies"))
