"""Quality classifier (operator 5) by co-training of two views.

The *content* view sees the text (measures of its words, lines, characters and vocabulary), the *metadata* view sees what stands
beside it (language, source, length). Both are logistic regressions over binned features, each with its own features only. A round
fits both on the labelled documents and the pseudo-labels so far, scores all documents with both, and takes what one view is
confident about as a pseudo-label for the *other* view. After ``rounds`` rounds each view is calibrated (Platt) on labelled documents
that no fit has seen, and the calibrated log odds are added (minus the prior that both contain) to score every document.

Everything is a sum over binned features: a document is a short list of bins, documents with equal bins and label are one row with
a count, and a fit is a few Newton-like passes over that table. Content bins are a bounded set; the metadata bins hash the language
and the source into a fixed number of places, so the tables that reach the driver stay bounded however many sources there are. All documents take part in each round.

Labels of one document that disagree count as good if most say so (ties: bad). Null labels and those of unknown documents don't
count. Without labels of both kinds every score is the share of good labels (0.5 without any). Null text is empty; ids may be null
or repeated, each row is scored alone. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks
from .quality_rules import class_counts, rules
from .shared import picked, stored

ROUNDS = 3
#: Probability from which on a view is confident.
SURE = 0.95
SOURCES = 256
LANGS = 16
#: Ends of the bins of each content measure: 124,416 combinations at most.
BINS = {
    "words": [5, 20, 50, 200, 1000],
    "upper": [0.03, 0.1, 0.3],
    "symbol": [0.0005, 0.01, 0.05],
    "digit": [0.01, 0.1],
    "stop": [0.01, 0.06],
    "repeat": [0.1, 0.3],
    "lines": [0.1, 0.3],
    "different": [0.2, 0.5, 0.8],
    "length": [3, 6, 9],
}
#: Lists of at most so many bins, one digit or letter each, are what a document is reduced to.
DIGITS = "0123456789abcdef"


def measures(block: blocks.Texts) -> dict[str, np.ndarray]:
    base, _ = rules(block)
    n = np.maximum(base["n_words"], 1)
    classes = class_counts(block)
    chars = np.maximum(classes.sum(1), 1)
    low = block.lower()
    found = blocks.words(low)
    values, edge = blocks.distinct(blocks.word_hashes(low, found), found.of)
    lines = np.bincount(np.repeat(np.arange(len(block)), np.diff(block.bounds)), block.raw == 10, len(block)) + 1
    punctuated = classes[:, 4]
    return {
        "words": base["n_words"].astype(float),
        "upper": classes[:, 1] / chars,
        "symbol": base["n_symbols"] / chars,
        "digit": classes[:, 2] / chars,
        "stop": punctuated / chars,
        "repeat": base["n_repeat_words"] / n,
        "lines": base["n_dup_lines"] / lines,
        "different": np.diff(edge) / n,
        "length": base["word_chars"] / n,
    }


def content_bins(docs: DataFrame) -> DataFrame:
    """Rows (id, text, ...) with ``text`` replaced by ``content``: one digit per measure."""
    at = docs.columns.index("text")
    names = ["content" if c == "text" else c for c in docs.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.array(list(DIGITS))
        for batch in batches:
            out: list[str] = []
            for block in blocks.texts(batch.column(at)):
                found = measures(block)
                letters = [digits[np.searchsorted(edges, found[name], "right")] for name, edges in BINS.items()]
                out.extend("".join(x) for x in zip(*letters))
            columns = [pa.array(out, pa.string()) if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, ", ".join(f"{n} {kind}" for n, (_, kind) in zip(names, docs.dtypes)))


def _content_features(key: str) -> list[str]:
    return [f"{name}{digit}" for name, digit in zip(BINS, key)]


def _meta_features(key: str) -> list[str]:
    return [f"{kind}{value}" for kind, value in zip(("lang", "source", "chars"), key.split("|"))]


def _log_odds(p: np.ndarray | float) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


class View:
    """A logistic regression over the features of keys, fitted on counts of (key, good, bad)."""

    def __init__(self, features):
        self.features, self.weights, self.bias = features, {}, 0.0

    def fit(self, rows: list[tuple[str, float, float]], ridge: float = 1.0, passes: int = 60) -> "View":
        names = sorted({f for key, _, _ in rows for f in self.features(key)})
        number = {f: k for k, f in enumerate(names)}
        lists = [[number[f] for f in self.features(key)] for key, _, _ in rows]
        row = np.repeat(np.arange(len(rows)), [len(x) for x in lists])
        col = np.array([k for x in lists for k in x], np.int64)
        good, bad = (np.array([r[k] for r in rows], float) for k in (1, 2))
        n = good + bad
        self.bias, w = float(_log_odds((good.sum() + 1) / (n.sum() + 2))), np.zeros(len(names))
        most = max(map(len, lists), default=1)
        for _ in range(passes):
            # Newton steps along each weight at once, damped by the features a row has.
            p = 1 / (1 + np.exp(-np.clip(self.bias + np.bincount(row, w[col], len(rows)), -30, 30)))
            slope, curve = good - n * p, n * p * (1 - p)
            w += (np.bincount(col, slope[row], len(names)) - ridge * w) / (most * np.bincount(col, curve[row], len(names)) + ridge + 1e-9)
            self.bias += slope.sum() / (most * curve.sum() + ridge)
        self.weights = dict(zip(names, w.tolist()))
        return self

    def score(self, key: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in self.features(key))


def _platt(rows: list[tuple[float, float, float]]) -> tuple[float, float]:
    """Slope and offset that make scores log odds of the counts (score, good, bad)."""
    if not rows:
        return 1.0, 0.0
    x, good, bad = (np.array([r[k] for r in rows]) for k in range(3))
    n, a, b = good + bad, 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        slope, curve = good - n * p, n * p * (1 - p)
        g = np.array([(slope * x).sum() - (a - 1), slope.sum() - b])
        h = np.array([[(curve * x * x).sum() + 1, (curve * x).sum()], [(curve * x).sum(), curve.sum() + 1]])
        step = np.linalg.solve(h, g)
        a, b = a + np.clip(step[0], -1, 1), b + np.clip(step[1], -1, 1)
    return max(a, 0.0), b


def _scores(view: View, keys: DataFrame, name: str) -> dict[str, float]:
    return {r[name]: view.score(r[name]) for r in keys.collect()}


def _joined(rows: DataFrame, name: str, scores: dict[str, float], out: str) -> DataFrame:
    spark = rows.sparkSession
    table = spark.createDataFrame(pa.table({name: pa.array(list(scores), pa.string()), out: pa.array(list(scores.values()), pa.float64())}))
    return rows.join(table, name, "left")


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    rounds: int = ROUNDS,
    sure: float = SURE,
    least: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    label_col: str = "quality",
) -> DataFrame:
    """Per row: doc_id, content_score, metadata_score (calibrated probabilities of each view), score (combined), kept."""
    rows = picked(docs, id=id_col, text=text_col, lang=lang_col, source=source_col)
    chars: Column = F.least(F.floor(F.log2(F.coalesce(F.char_length("text"), F.lit(0)) + 1)), F.lit(15)).cast("string")
    # Languages and sources by hash, so that the table of keys is bounded: 65,536 combinations at most.
    hashed = (F.pmod(F.xxhash64(c), F.lit(n)).cast("string") for c, n in (("lang", LANGS), ("source", SOURCES)))
    meta = F.concat_ws("|", *hashed, chars)
    work = content_bins(rows.withColumn("meta", meta).select("id", "text", "meta"))
    marks = picked(labels, id=id_col, good=label_col).filter("id is not null and good is not null")
    marks = marks.groupBy("id").agg((F.avg(F.col("good").cast("int")) > 0.5).cast("int").alias("good"))
    marked = work.join(marks, "id", "left").withColumn("fold", F.when(F.col("good").isNotNull(), F.pmod(F.xxhash64("id"), F.lit(5)) == 0))
    work = stored(marked.select("id", F.col("content"), "meta", "good", "fold"), "quality-bins")
    cells = stored(work.groupBy("content", "meta", "good", "fold").agg(F.count(F.lit(1)).alias("n")), "quality-cells")
    shares = cells.filter("good is not null").agg(F.sum(F.expr("if(good = 1, n, 0)")).alias("good"), F.sum("n").alias("n")).first()
    content, metadata = View(_content_features), View(_meta_features)

    def counts(name: str, extra: DataFrame | None, test: bool = False) -> list[tuple[str, float, float]]:
        own = cells.filter(f"good is not null and fold = {str(test).lower()}").select(name, "good", "n")
        every = own if extra is None else own.unionByName(extra)
        table = every.groupBy(name).agg(F.sum(F.expr("if(good = 1, n, 0)")).alias("g"), F.sum(F.expr("if(good = 0, n, 0)")).alias("b"))
        return [(r[name], r["g"], r["b"]) for r in table.collect()]

    if not shares["n"] or shares["good"] in (0, shares["n"]):
        prior = F.lit(float(shares["good"]) / shares["n"] if shares["n"] else 0.5)
        return work.select(F.col("id").alias("doc_id"), *(prior.alias(c) for c in ("content_score", "metadata_score", "score")), (prior >= least).alias("kept"))
    keys = {name: stored(cells.select(name).distinct(), f"quality-{name}") for name in ("content", "meta")}
    views = {"content": content, "meta": metadata}
    pseudo: dict[str, DataFrame | None] = {"content": None, "meta": None}
    bound = float(_log_odds(sure))
    for _ in range(rounds):
        for name, view in views.items():
            view.fit(counts(name, pseudo[name]))
        for name, other in (("content", "meta"), ("meta", "content")):
            scored = _joined(cells.filter("good is null"), name, _scores(views[name], keys[name], name), "s")
            pseudo[other] = scored.filter(F.abs("s") >= bound).select(other, (F.col("s") > 0).cast("int").alias("good"), "n")
    for name, view in views.items():
        view.fit(counts(name, pseudo[name]))
    prior = float(_log_odds((shares["good"] + 1) / (shares["n"] + 2)))
    out = work.select("id", "content", "meta")
    for name, view in views.items():
        a, b = _platt([(view.score(k), g, bad) for k, g, bad in counts(name, None, test=True)])
        scores = {k: a * s + b for k, s in _scores(view, keys[name], name).items()}
        out = _joined(out, name, scores, f"s_{name}")
    chance = lambda c: 1 / (1 + F.exp(-c))
    both = chance(F.col("s_content") + F.col("s_meta") - F.lit(prior))
    return out.select(
        F.col("id").alias("doc_id"),
        chance(F.col("s_content")).alias("content_score"),
        chance(F.col("s_meta")).alias("metadata_score"),
        both.alias("score"),
        (both >= least).alias("kept"),
    )
