"""MinHash near-dedup (operator 7) by min-max hashing.

A document's set is its distinct word shingles (A-Z lower-cased; fewer words than a shingle: the whole sequence; no words: the
empty set, linked with nothing). Every hash function is evaluated once per shingle and gives two signature values, the smallest
and the largest: half the evaluations of plain MinHash, both unbiased for the Jaccard similarity, and negatively correlated, so
of lower variance. Bands of ``rows`` values become bucket keys. With the defaults (90 evaluations, 180 values, 36 bands of 5) a
pair at similarity 0.8 misses all bands with probability 6e-7, a pair at 0.9 with 1e-14.

* Documents with the same set (128-bit sum over it, and its size) are one class from the start; only the smallest id goes on.
* A wide signature keeps one bit of every minimum and maximum of many more hash functions, two from each product. A pair goes on to the full sets only if
  its bits agree as those of a link would (five standard deviations), so few texts are moved.
* Each bucket links its members to its smallest one, so it costs one pair per member and not one per pair of members.
* Members of one bucket that this leaves in different components are compared by their wide signatures inside the join, and a pair
  that may be a link goes on once, however many buckets it shares. So no link between different texts is lost to the choice of the
  smallest member, and what a bucket of merely similar documents costs is bit counting, not rows.
* Every link is confirmed on the full sets.

Rows with a null id are in no component: ``component_id`` null, kept. Rows that share an id are one document: its component is
that of all their texts. Ties go to the smallest id. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks
from .components import components
from .shared import picked, stored

#: Words of a shingle; a contract may say otherwise, as the one of the ``op7_`` query does.
WIDTH = 5
EVALUATIONS = 90
BAND_ROWS = 5
#: Half the bits of the wide signature, four of them from an evaluation, those of the bands among them. A multiple of 32.
WIDE = 1024
#: Places of the table that texts are looked up by before they are shuffled: what is broadcast has at most so many rows.
SLOTS = 1 << 20


def sets_of(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, sorted shingle hashes and their edges, for runs of texts."""
    for block in blocks.texts(column):
        block = block.lower()
        found = blocks.words(block)
        runs, edge = blocks.shingles(blocks.word_hashes(block, found), found.of, width)
        yield block.first, *blocks.distinct(runs, edge)


def signature(values: np.ndarray, edge: np.ndarray, evaluations: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each set: min and max of the first ``evaluations`` hash functions, and ``2 * wide`` bits of minima and maxima.

    An evaluation gives four bits: one of min and max of the whole value, one of min and max of its lower half, which is a hash of
    its own. Values are scrambled already, so what only gives bits takes one product. The empty set has zeros. The bits are packed
    into 64-bit words from the start.
    """
    n = len(edge) - 1
    out, bits = np.zeros((n, 2 * evaluations), np.uint64), np.zeros((n, 2 * wide // 64), np.uint64)
    some = np.flatnonzero(np.diff(edge))
    if not len(some):
        return out, bits
    at = edge[some]
    odd, add = blocks.stream(11, wide + 1) | np.uint64(1), blocks.stream(12, wide)
    for k in range(max(evaluations, wide // 2)):
        hashed = values * odd[k]
        if k < evaluations:
            hashed += add[k]
            hashed ^= hashed >> np.uint64(32)
            hashed *= odd[k + 1]
        low = hashed.astype(np.uint32) if k < wide // 2 else hashed[:0]
        sides = [kind.reduceat(half, at) for half in (hashed, low) if len(half) for kind in (np.minimum, np.maximum)]
        if k < evaluations:
            out[some, 2 * k], out[some, 2 * k + 1] = sides[:2]
        if k < wide // 2:
            for side, found in enumerate(sides):
                word, place = divmod(4 * k + side, 64)
                bits[some, word] |= (blocks.mix(found) & np.uint64(1)) << np.uint64(place)
    return out, bits


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    bands = signatures.shape[1] // rows
    # Values at distance ``bands``: a minimum and a maximum of one function never share a band.
    split = signatures[:, : bands * rows].reshape(-1, rows, bands)
    keys = np.tile(blocks.stream(13, bands), (len(signatures), 1))
    for k in range(rows):
        keys = blocks.mix(keys * np.uint64(0x9E3779B97F4A7C15 | 1) + split[:, k, :])
    return keys


def _bit_words(bits: np.ndarray) -> pa.Array:
    """Rows of 64-bit words as lists."""
    words = bits.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1, dtype=np.int32) * words.shape[1]), pa.array(words.reshape(-1)))


def _alike(wide: int, percent: int) -> Column:
    """Whether ``bits_a`` and ``bits_b`` allow the similarity.

    Bits of a pair differ with probability (1 - J) / 2. The bound is five standard deviations above the mean at just this
    similarity, so one of three million pairs there is lost, and fewer above it.
    """
    n, unlike = 2 * wide, (1 - percent / 100) / 2
    most = int(n * unlike + 5 * (n * unlike * (1 - unlike)) ** 0.5)
    return F.expr(f"{' + '.join(f'bit_count(bits_a[{k}] ^ bits_b[{k}])' for k in range(n // 64))} <= {most}")


def sketches(docs: DataFrame, width: int = WIDTH, evaluations: int = EVALUATIONS, rows: int = BAND_ROWS, wide: int = WIDE) -> DataFrame:
    """Rows (id, text) to (id, n, d1, d2, bands, bits): set size, set digest, bucket keys, wide signature."""
    schema = f"id {dict(docs.dtypes)['id']}, n long, d1 long, d2 long, bands array<long>, bits array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, values, edge in sets_of(batch.column(1), width):
                n = np.diff(edge)
                whole, bits = signature(values, edge, evaluations, wide)
                keys = band_keys(whole, rows)
                sizes = np.where(n > 0, keys.shape[1], 0)
                flat = keys[n > 0].reshape(-1).view(np.int64)
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
                sums = [blocks.per_text(np.add, blocks.mix(values + np.uint64(salt)), edge, 0).view(np.int64) for salt in (0, 0x51ED2701)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(n)), pa.array(n.astype(np.int64)), *map(pa.array, sums), bands, _bit_words(bits)],
                    ["id", "n", "d1", "d2", "bands", "bits"],
                )

    return docs.select("id", "text").mapInArrow(run, schema)


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. ``texts``: (id, text) of all ids in the pairs."""
    kind = dict(pairs.dtypes)["a"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_rows_of(batch.column(k), width) for k in (2, 3))
            good = []
            for x, y in zip(left, right):
                low, high = sorted((len(x), len(y)))
                if 100 * low < percent * high:
                    good.append(False)
                    continue
                both = np.intersect1d(x, y, assume_unique=True).size
                good.append(both > 0 and 100 * both >= percent * (low + high - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    with_a = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    with_b = with_a.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return with_b.select("a", "b", "ta", "tb").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def _rows_of(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    for _, values, edge in sets_of(column, width):
        for a, b in zip(edge[:-1], edge[1:]):
            yield values[a:b]


def _likely(rows: DataFrame, classes: DataFrame, wide: int, percent: int) -> DataFrame:
    """Pairs of one bucket in different components whose wide signatures allow the similarity; each pair once."""
    full = stored(rows.join(classes.select("rep", "bands", "bits"), "rep"), "wide")
    left, right = (full.select("key", *(F.col(c).alias(f"{c}_{side}") for c in ("rep", "n", "head", "root", "bands", "bits"))) for side in ("a", "b"))
    near = left.join(
        right,
        (left["key"] == right["key"])
        & F.expr("rep_a < rep_b and root_a <> root_b and rep_a <> head_a")
        & F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        & _alike(wide, percent)
        # Of the buckets that both are in, the one with the smallest key names the pair.
        & (left["key"] == F.array_min(F.array_intersect("bands_a", "bands_b"))),
    )
    return near.select(F.col("rep_b").alias("a"), F.col("rep_a").alias("b"))


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = 80,
    evaluations: int = EVALUATIONS,
    band_rows: int = BAND_ROWS,
    wide: int = WIDE,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (doc_id = component_id)."""
    source = picked(docs, id=id_col, text=text_col)
    work = stored(sketches(source, width, evaluations, band_rows, wide), "sketches")
    found = work.filter("id is not null and n > 0")
    classes = stored(found.groupBy("d1", "d2", "n").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("bits").alias("bits")), "classes")
    buckets = classes.select("rep", "n", F.explode("bands").alias("key"))
    heads = buckets.groupBy("key").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = stored(buckets.join(heads, "key").select("key", "rep", "n", "head", "members"), "buckets")
    stars = shared.filter("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct()
    for side in ("a", "b"):
        stars = stars.join(classes.select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)
    likely = stars.filter(_alike(wide, percent)).filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    stars = stored(likely.select("a", "b"), "stars")
    first = stored(confirmed(stars, stored(_texts(source, stars), "texts"), width, percent), "links")
    root = components(first)
    # Buckets of three and more members that still hold several components.
    label = root.select(F.col("node").alias("rep"), F.col("root"))
    members = shared.filter("members > 2").join(label, "rep", "left")
    placed = stored(members.select("key", "rep", "n", "head", F.coalesce("root", "rep").alias("root")), "placed")
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key")
    open_rows = stored(placed.join(mixed, "key"), "open")
    rest = stored(_likely(open_rows, classes, wide, percent), "rest")
    second = confirmed(rest, stored(_texts(source, rest), "texts"), width, percent)
    links = stored(first.unionByName(second), "links")
    # Rows of one id with several sets hold these sets together.
    own = found.select("id", "d1", "d2", "n").distinct().join(classes.select("d1", "d2", "n", "rep"), ["d1", "d2", "n"])
    double = own.filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    root = components(links.unionByName(double))
    labels = root.select(F.col("node").alias("id"), F.col("root"))
    rows = work.select("id", "n").join(labels, "id", "left")
    return rows.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("root", "id").alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == F.coalesce("root", "id"))).alias("kept"),
    )


def _texts(source: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts of all ids in the pairs. Ids that fall into no place of a needed one go before the shuffle."""
    needed = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    slot = F.pmod(F.xxhash64("id"), F.lit(SLOTS)).cast("int")
    slots = needed.select(slot.alias("slot")).distinct()
    maybe = source.filter("text is not null").withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi").drop("slot")
    return maybe.join(needed, "id", "left_semi")
