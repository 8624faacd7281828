"""Quality rules (operator 4): divergence from the language's reference.

Plain rules first (words, word characters, symbols, repeated lines, repeated 8-word windows; see ``rules``). Then a document's
histogram of character classes, and that of the language's common words, is compared with the language's reference by the
Jensen-Shannon distance (base 2, so 0 to 1). A text of fewer than ``least_words`` words is not judged by its histograms.

References are counted over all documents of a language that pass the plain rules; the ``COMMON`` most frequent words of a
language are its common words (ties by hash), all others count as one more bin. Counting is exact: each task sums the words of
its batches, the sums meet by word. Null and unseen languages are the language ''. Null text has no words and fails. A language
without a reference (no document passes the plain rules) judges nothing. Repeated rows count each time; null and repeated ids are
carried along; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import blocks
from .shared import picked, stored

COMMON = 64
#: Words from which on histograms are judged.
LEAST_WORDS = 50
#: Largest distances of a good text.
CLASS_DISTANCE = 0.30
WORD_DISTANCE = 0.48
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
#: Classes of a code point's first byte: lower, upper, digit, white space, punctuation, symbol, beyond ASCII, other.
CLASSES = 8


def _class_table() -> np.ndarray:
    table = np.full(256, 7)
    table[97:123], table[65:91], table[48:58] = 0, 1, 2
    table[[32, 9, 10, 11, 12, 13]] = 3
    table[list(b".,;:!?'\"()-")] = 4
    table[list(SYMBOLS)] = 5
    table[192:256] = 6
    table[128:192] = CLASSES  # later bytes of a code point
    return table


_CLASS = _class_table()
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_SPACES = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return running[bounds[1:]] - running[bounds[:-1]]


def _repeated(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a (row, key) stands there more than once, and whether it stood there before."""
    order = np.lexsort((np.arange(len(keys)), keys, rows))
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = (rows[order][1:] == rows[order][:-1]) & (keys[order][1:] == keys[order][:-1])
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order] = same[:-1]
    twice[order] = same[:-1] | same[1:]
    return twice, later


def rules(block: blocks.Texts) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The plain measures of each text, and whether they fail it."""
    found = blocks.words(block)
    sums = blocks.prefix_sums(block.raw)
    n = np.diff(found.of)
    first_byte = (block.raw & 0xC0) != 0x80
    out = {"n_words": n, "word_chars": _sums(first_byte & ~_SPACES[block.raw], block.bounds), "n_symbols": _sums(_SYMBOL[block.raw], block.bounds)}
    # Lines: after each \n and at each text's begin.
    breaks = np.flatnonzero(block.raw == 10)
    of_break = np.searchsorted(block.bounds, breaks, "right") - 1
    some = np.flatnonzero(np.diff(block.bounds))
    starts = np.concatenate([block.bounds[some], breaks + 1])
    ends = np.concatenate([block.bounds[some + 1], breaks])
    row = np.concatenate([some, of_break])
    order = np.lexsort((starts, row))
    starts, row, ends = starts[order], row[order], np.sort(ends)
    visible = np.concatenate([[0], np.cumsum(~_SPACES[block.raw])])
    worded = visible[ends] > visible[starts]
    _, later = _repeated(row[worded], blocks.span_hashes(sums, starts[worded], ends[worded]))
    out["n_dup_lines"] = np.bincount(row[worded][later], minlength=len(block))
    windows, edge = blocks.shingles(blocks.span_hashes(sums, found.starts, found.ends), found.of, WINDOW, whole=False)
    row = np.repeat(np.arange(len(block)), np.diff(edge))
    twice, _ = _repeated(row, windows)
    begin = (np.arange(len(windows)) - edge[row] + found.of[row])[twice]
    cover = np.zeros(found.of[-1] + 1, np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + WINDOW, -1)
    out["n_repeat_words"] = _sums(np.cumsum(cover)[:-1] > 0, found.of)
    failed = (n < 20) | (100 * out["n_repeat_words"] > 30 * n)
    return out, failed


def class_counts(block: blocks.Texts) -> np.ndarray:
    row = np.repeat(np.arange(len(block)), np.diff(block.bounds))
    return np.bincount(row * (CLASSES + 1) + _CLASS[block.raw], minlength=len(block) * (CLASSES + 1)).reshape(-1, CLASSES + 1)[:, :CLASSES]


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts ``p`` to the counts ``q``; 0 for rows without counts."""
    p = p / np.maximum(p.sum(1, keepdims=True), 1)
    q = np.broadcast_to(q / max(q.sum(), 1), p.shape)
    middle = (p + q) / 2

    def half(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(middle > 0, middle, 1)), 0).sum(1)

    return np.where(p.sum(1) > 0, np.sqrt(np.clip((half(p) + half(q)) / 2, 0, 1)), 0)


def references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """One row per language: lang, classes array<long>, words array<long> (hashes), counts array<long>, rest (other words)."""
    source = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, names = _coded(batch.column(0))
            parts = []
            for block in blocks.texts(batch.column(1)):
                _, failed = rules(block)
                lang = codes[block.first : block.first + len(block)]
                classes = class_counts(block)
                for k in np.unique(lang[~failed]):
                    sums = classes[(lang == k) & ~failed].sum(0)
                    parts.append((np.full(CLASSES, k), np.ones(CLASSES, np.int64), np.arange(CLASSES), sums))
                low = block.lower()
                found = blocks.words(low)
                good = np.repeat(~failed, np.diff(found.of))
                hashes = blocks.word_hashes(low, found).view(np.int64)[good]
                of = np.repeat(lang, np.diff(found.of))[good]
                for k in np.unique(of):
                    keys, counts = np.unique(hashes[of == k], return_counts=True)
                    parts.append((np.full(len(keys), k), np.zeros(len(keys), np.int64), keys, counts))
            if parts:
                lang, kind, key, n = (np.concatenate(x) for x in zip(*parts))
                rows = pa.table({"lang": pa.array(lang), "kind": pa.array(kind), "key": pa.array(key), "n": pa.array(n.astype(np.int64))})
                rows = rows.group_by(["lang", "kind", "key"]).aggregate([("n", "sum")])
                rows = rows.set_column(0, "lang", pa.array(names, pa.string()).take(rows.column("lang").combine_chunks()))
                yield from rows.rename_columns(["lang", "kind", "key", "n"]).combine_chunks().to_batches(200_000)

    counts = stored(source.mapInArrow(run, "lang string, kind long, key long, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "quality-counts")
    classes = counts.filter("kind = 1").groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("m"))
    classes = classes.select("lang", F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), lambda k: F.coalesce(F.col("m")[k.cast("long")], F.lit(0).cast("long"))).alias("classes"))
    words = counts.filter("kind = 0")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.col("n").desc(), "key"))
    top = words.withColumn("rank", rank).filter(F.col("rank") <= COMMON)
    top = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("key", "n"))).alias("top"), F.sum("n").alias("common"))
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    return classes.join(top, "lang").join(total, "lang").select(
        "lang", "classes", F.col("top.key").alias("words"), F.col("top.n").alias("counts"), (F.col("total") - F.col("common")).alias("rest")
    )


def _coded(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def quality(
    docs: DataFrame,
    reference: DataFrame | None = None,
    least_words: int = LEAST_WORDS,
    class_distance: float = CLASS_DISTANCE,
    word_distance: float = WORD_DISTANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, class_distance, word_distance.

    ``reference``: a table of ``references``, by default that of the documents themselves. A distance that is not judged is 0.
    """
    known = stored(references(docs, lang_col, text_col) if reference is None else reference, "quality-references")
    packed = known.select("lang", F.to_json(F.struct("classes", "words", "counts", "rest")).alias("reference"))
    rows = picked(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn("lang", F.coalesce(F.col("lang").cast("string"), F.lit("")))
    kind = dict(rows.dtypes)["doc_id"]
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = f"doc_id {kind}, {', '.join(f'{x} long' for x in numbers)}, base_failed boolean, kept boolean, class_distance double, word_distance double"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        parsed: dict[str, dict] = {}
        for batch in batches:
            codes, refs = _coded(batch.column(2))
            codes = np.where(np.isnan(codes.astype(float)), -1, codes).astype(int)
            for block in blocks.texts(batch.column(1)):
                measures, failed = rules(block)
                mine = codes[block.first : block.first + len(block)]
                classes, low = class_counts(block), block.lower()
                found = blocks.words(low)
                hashes, row = blocks.word_hashes(low, found).view(np.int64), found.row()
                by_class, by_word = np.zeros(len(block)), np.zeros(len(block))
                for k in np.unique(mine[mine >= 0]):
                    ref = parsed.setdefault(refs[k], json.loads(refs[k]))
                    keys = np.array(ref["words"], np.int64)
                    of = np.flatnonzero(mine == k)
                    place = np.full(len(block), -1)
                    place[of] = np.arange(len(of))
                    here = place[row] >= 0
                    at = np.minimum(np.searchsorted(keys, hashes[here]), len(keys) - 1)
                    at = np.where(keys[at] == hashes[here], at, len(keys))
                    width = len(keys) + 1
                    counts = np.bincount(place[row][here] * width + at, minlength=len(of) * width).reshape(-1, width)
                    by_class[of] = distance(classes[of], np.array(ref["classes"]))
                    by_word[of] = distance(counts, np.array([*ref["counts"], ref["rest"]]))
                judged = measures["n_words"] >= least_words
                by_class, by_word = np.where(judged, by_class, 0), np.where(judged, by_word, 0)
                kept = ~failed & (by_class <= class_distance) & (by_word <= word_distance)
                columns = [*(measures[x].astype(np.int64) for x in numbers), failed, kept, by_class, by_word]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, len(block)), *map(pa.array, columns)], names)

    return rows.join(packed, "lang", "left").select("doc_id", "text", "reference").mapInArrow(run, schema)
