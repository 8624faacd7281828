"""Toxicity (operator 10) by cumulative-link ordinal regression.

Grades 0 (clean) to 3 (severe) are ordered; one weight vector over sparse text features is shared by all thresholds:
``P(grade >= k) = sigmoid(w x - theta_k)`` with ``theta_1 < theta_2 < theta_3``. The expected severity is the sum of the three.

Features are the different words of a text (letters and digits, A-Z lower-cased) and their first 4, 5 and 6 bytes, as 64-bit
hashes. Those in significantly more toxic than clean labelled texts, or the other way round, are kept (z of the log odds, at
most ``most`` of them; the model says how many more there were); the counts behind this cover all labelled documents. Texts are
counted where they are read: two bit tables over places of the ids say who is toxic and who is clean, and only rows whose place
holds ids of different labels, or of none, go through a join. Labels say toxic or not; the grade of a toxic text is
the third of the toxic texts that the sum of its toxic features' z falls into. The regression is fitted on a bounded sample:
``sample`` labelled documents, the smallest by a hash of the id, one row of each. All documents are scored. A text without any kept feature gets
the base rate.

Labels: one document with several labels is toxic if one of them says so; null labels and labels of unknown documents don't
count. Without labels of both kinds nothing is toxic (severity 0). Null text is empty; ids may be null or repeated, each row is
scored alone. Long texts are taken whole, each a run of its own. Other columns play no part, whatever their names. Ties at the
features' limit go by hash. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks
from .shared import picked, stored

#: Features of the model at most, unless ``fit`` is told otherwise.
FEATURES = 4096
#: Least z of a feature's log odds.
LEAST_Z = 3.0
#: Labelled documents that the regression is fitted on at most.
SAMPLE = 20_000
GRADES = 3
#: Places of the two bit tables of labelled ids; what is broadcast of each are at most ``SLOTS / 8`` bytes.
SLOTS = 1 << 27
PREFIXES = (4, 5, 6)


def features(block: blocks.Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature hashes and the texts they stand in, for words and each prefix; a word may repeat."""
    block = block.lower()
    found = blocks.words(block, blocks.LETTERS)
    row, size = found.row(), found.ends - found.starts
    sums = blocks.prefix_sums(block.raw)
    yield blocks.span_hashes(sums, found.starts, found.ends), row
    for n in PREFIXES:
        long = size > n
        starts = found.starts[long]
        yield blocks.mix(blocks.span_hashes(sums, starts, starts + n) + np.uint64(n)), row[long]


def _different(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (row, key) once."""
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
    return rows[new], keys[new]


class Finder:
    """The known ones among many hashes: a bit table first, then a binary search."""

    BITS = 20

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys.astype(np.uint64))
        self.table = np.zeros(1 << self.BITS, bool)
        self.table[self.keys >> np.uint64(64 - self.BITS)] = True

    def __call__(self, block: blocks.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Texts and numbers of their known features, each once."""
        rows, numbers = [], []
        for keys, row in features(block):
            maybe = np.flatnonzero(self.table[keys >> np.uint64(64 - self.BITS)])
            at = np.searchsorted(self.keys, keys[maybe])
            hit = self.keys[np.minimum(at, len(self.keys) - 1)] == keys[maybe] if len(self.keys) else np.zeros(0, bool)
            rows.append(row[maybe][hit])
            numbers.append(at[hit])
        return _different(np.concatenate(rows), np.concatenate(numbers))


@dataclass
class Model:
    """``keys`` are sorted; ``weights`` go with them. ``thetas`` is None if there was nothing to learn from."""

    keys: np.ndarray
    weights: np.ndarray
    thetas: np.ndarray | None
    #: The severity from which on a text counts as toxic: the one with the least errors on the sample, false alarms counted twice.
    least: float = 0.5
    #: Significant features beyond the limit, which the model does not have.
    dropped: int = 0

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        if self.thetas is None:
            return np.zeros((len(scores), GRADES))
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thetas[None, :], -40, 40)))


def regression(rows: np.ndarray, numbers: np.ndarray, grades: np.ndarray, n: int, steps: int = 600, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds that maximise the likelihood of the grades, by Adam on the whole sample."""
    w, first, gaps = np.zeros(n), np.array([1.0]), np.zeros(GRADES - 1)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, first, gaps)]
    for step in range(1, steps + 1):
        thetas = first[0] + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        score = np.bincount(rows, w[numbers], len(grades))
        # Cumulative probabilities; those of the single grades are their differences.
        cum = 1 / (1 + np.exp(-np.clip(score[:, None] - thetas, -40, 40)))
        full = np.concatenate([np.ones((len(grades), 1)), cum, np.zeros((len(grades), 1))], 1)
        at = np.arange(len(grades))
        p = np.maximum(full[at, grades] - full[at, grades + 1], 1e-12)
        slope = cum * (1 - cum)
        upper = np.where(grades > 0, slope[at, grades - 1], 0) / p
        lower = np.where(grades < GRADES, slope[at, np.minimum(grades, GRADES - 1)], 0) / p
        by_score = upper - lower
        to_theta = np.bincount(np.maximum(grades - 1, 0), np.where(grades > 0, -upper, 0), GRADES)
        to_theta += np.bincount(np.minimum(grades, GRADES - 1), np.where(grades < GRADES, lower, 0), GRADES)
        size = len(grades)
        grads = [
            np.bincount(numbers, by_score[rows], n) / size - ridge * w,
            np.array([to_theta.sum() / size]),
            np.array([to_theta[k + 1 :].sum() * math.exp(gaps[k]) / size for k in range(GRADES - 1)]) - ridge * gaps,
        ]
        for p_, g, (m, v) in zip((w, first, gaps), grads, state):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p_ += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w, first[0] + np.concatenate([[0], np.cumsum(np.exp(gaps))])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = FEATURES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model of labelled documents. What reaches the driver: ``most`` rows of counts, and ``sample`` rows of known features."""
    marks = picked(labels, id=id_col, toxic=label_col).filter("id is not null and toxic is not null")
    marks = marks.groupBy("id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    source = picked(docs, id=id_col, text=text_col)
    # All ids of documents, in the documents' own type; labels of absent documents fall out.
    ids = stored(source.select("id").filter("id is not null").distinct().join(marks, "id", "left"), "toxic-ids")
    marks = ids.filter("toxic is not null")
    rows = _labelled(source, ids)
    counts = rows.mapInArrow(_counts, "key long, toxic long, clean long").groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # The key 0 counts the texts themselves.
    counts = stored(counts.filter("key = 0 or toxic + clean > 2"), "toxic-counts")
    total = counts.filter("key = 0").first()
    if total is None or not total["toxic"] or not total["clean"]:
        return Model(np.zeros(0, np.uint64), np.zeros(0), None)
    t, c = total["toxic"], total["clean"]
    odds = f"ln((toxic + 0.5D) / ({t} - toxic + 0.5D)) - ln((clean + 0.5D) / ({c} - clean + 0.5D))"
    error = f"sqrt(1 / (toxic + 0.5D) + 1 / ({t} - toxic + 0.5D) + 1 / (clean + 0.5D) + 1 / ({c} - clean + 0.5D))"
    scored = counts.filter("key <> 0 and toxic + clean > 2").selectExpr("key", f"({odds}) / {error} AS z").filter(f"abs(z) >= {LEAST_Z}")
    best = scored.orderBy(F.abs("z").desc(), "key").limit(most).collect()
    dropped = scored.count() - len(best)
    keys = np.array([r["key"] for r in best], np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, z = keys[order], np.array([r["z"] for r in best])[order]
    finder = Finder(keys)

    # At most ``sample`` short rows, so they can go to every task and no text is shuffled again.
    chosen = marks.orderBy(F.xxhash64("id"), "id").limit(sample)
    # In the order of the ids, so that sums don't depend on the order of tasks.
    picked_rows = sorted(_found(source.join(F.broadcast(chosen), "id"), finder).collect(), key=lambda r: r["id"])
    toxic = np.array([r["toxic"] for r in picked_rows], np.int64)
    row = np.repeat(np.arange(len(picked_rows)), [len(r["found"]) for r in picked_rows])
    number = np.array([x for r in picked_rows for x in r["found"]], np.int64)
    if not len(keys) or not toxic.any() or toxic.all():
        return Model(keys, np.zeros(len(keys)), None, dropped=dropped)
    strength = np.bincount(row, np.maximum(z, 0)[number], len(toxic))
    cuts = np.quantile(strength[toxic == 1], [k / GRADES for k in range(1, GRADES)])
    grades = np.where(toxic == 1, 1 + np.searchsorted(cuts, strength, "right"), 0)
    weights, thetas = regression(row, number, np.minimum(grades, GRADES), len(keys))
    model = Model(keys, weights, thetas, dropped=dropped)
    severity = model.probabilities(np.bincount(row, weights[number], len(toxic))).sum(1)
    values = np.unique(severity)
    cuts = (values[1:] + values[:-1]) / 2
    alarms = 2 * (toxic == 0).sum() - 2 * np.searchsorted(np.sort(severity[toxic == 0]), cuts)
    missed = np.searchsorted(np.sort(severity[toxic == 1]), cuts)
    if len(cuts):
        errors = alarms + missed
        model.least = float(np.mean(cuts[errors == errors.min()]))
    return model


def _labelled(source: DataFrame, ids: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Rows (id, text, toxic) of the labelled documents; ``ids`` are (id, toxic) of all documents, toxic null without a label.

    Ids meet in ``slots`` places by hash. Where all ids of a place have one label, the place alone tells it, and no text is moved.
    The rows of the other places are joined with their labels: about one in ``slots / ids`` while there are fewer ids than places,
    up to all labelled texts, once, when there are far more.
    """
    slot = F.pmod(F.xxhash64("id"), F.lit(slots))
    # 2: an id without a label. Places of such ids only are of no interest.
    places = ids.select(slot.alias("slot"), F.coalesce("toxic", F.lit(2)).alias("toxic")).groupBy("slot").agg(F.min("toxic").alias("least"), F.max("toxic").alias("most")).filter("least < 2")
    part, place = F.bitmap_bucket_number("slot").alias("part"), F.bitmap_bit_position("slot").alias("place")
    bits = places.select(part, place, "least", "most").groupBy("part").agg(
        F.expr("bitmap_construct_agg(place) FILTER (WHERE most > 0)").alias("toxics"),
        F.expr("bitmap_construct_agg(place) FILTER (WHERE least = 0 OR most = 2)").alias("cleans"),
    )

    def is_set(bits: str) -> Column:
        # Byte ``place div 8`` holds the place in its bit ``place % 8``.
        return F.expr(f"getbit(cast(conv(hex(substring({bits}, cast(place div 8 as int) + 1, 1)), 16, 10) as int), cast(place % 8 as int)) = 1")

    rows = source.withColumn("slot", slot).select("id", "text", part, place).join(F.broadcast(bits), "part")
    rows = rows.select("id", "text", is_set("toxics").alias("is_toxic"), is_set("cleans").alias("is_clean"))
    told = rows.filter("is_toxic <> is_clean").select("id", "text", F.col("is_toxic").cast("int").alias("toxic"))
    asked = rows.filter("is_toxic and is_clean").select("id", "text").join(ids.filter("toxic is not null"), "id")
    return told.unionByName(asked.select("id", "text", "toxic"))


def _found(rows: DataFrame, finder: Finder) -> DataFrame:
    """Rows (id, text, toxic) to one row (id, toxic, found) per id; of an id's several texts, the one whose features have the smallest hash."""

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks.texts(batch.column(1)):
                row, number = finder(block)
                sizes = np.bincount(row, minlength=len(block))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(number.astype(np.int32)))
                own = (batch.column(k).slice(block.first, len(block)) for k in (0, 2))
                yield pa.RecordBatch.from_arrays([*own, lists], ["id", "toxic", "found"])

    found = rows.select("id", "text", "toxic").mapInArrow(known, f"id {dict(rows.dtypes)['id']}, toxic int, found array<int>")
    least = F.min(F.struct(F.xxhash64("found").alias("place"), "toxic", "found")).alias("least")
    return found.groupBy("id").agg(least).select("id", "least.toxic", "least.found")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and feature the number of toxic and of clean texts that have it."""
    for batch in batches:
        flags = np.array(batch.column(2).to_pylist(), np.int64)
        parts = [(np.zeros(1, np.uint64), np.array([flags.sum()]), np.array([len(flags) - flags.sum()]))]
        for block in blocks.texts(batch.column(1)):
            found = [*features(block)]
            rows, keys = _different(np.concatenate([r for _, r in found]), np.concatenate([k for k, _ in found]))
            mine = flags[block.first + rows]
            keys, back = np.unique(keys, return_inverse=True)
            parts.append((keys, np.bincount(back, mine, len(keys)), np.bincount(back, 1 - mine, len(keys))))
        keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = [np.bincount(back, np.concatenate([p[k] for p in parts]), len(keys)).astype(np.int64) for k in (1, 2)]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *map(pa.array, sums)], ["key", "toxic", "clean"])


def _scored(docs: DataFrame, model: Model, column: str, schema: str, outputs: list[str]) -> DataFrame:
    finder = Finder(model.keys)
    names = [*docs.columns, *outputs]
    at = docs.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cum = []
            for block in blocks.texts(batch.column(at)):
                row, number = finder(block)
                cum.append(model.probabilities(np.bincount(row, model.weights[number], len(block))))
            cum = np.concatenate(cum) if cum else np.zeros((0, GRADES))
            made = {"severity": cum.sum(1), "grade": (cum >= 0.5).sum(1).astype(np.int32), "p_toxic": cum[:, 0]}
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(made[o]) for o in outputs)], names)

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, model: Model, least: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, severity (expected grade, 0 to 3), grade (the last threshold passed), p_toxic, toxic (severity >= least, the model's own by default)."""
    rows = picked(docs, doc_id=id_col, text=text_col)
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, text string, severity double, grade int, p_toxic double"
    scored = _scored(rows, model, "text", schema, ["severity", "grade", "p_toxic"])
    return scored.select("doc_id", "severity", "grade", "p_toxic", (F.col("severity") >= (model.least if least is None else least)).alias("toxic"))


def without_toxic(docs: DataFrame, model: Model, least: float | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their own columns."""
    own = docs.columns
    plain = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(own)))
    schema = ", ".join([*(f"{n} {kind}" for n, kind in plain.dtypes), "severity double"])
    scored = _scored(plain, model, f"c{own.index(text_col)}", schema, ["severity"])
    return scored.filter(F.col("severity") < (model.least if least is None else least)).select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(own)))
