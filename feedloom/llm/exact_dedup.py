"""Exact dedup (operator 9) with a cuckoo-filter index of live digests.

Texts are equal when they are the same after each run of ``[\\x20\\x09-\\x0D]`` became one space; null is ''. A text's digest is
the SHA-256 of its normalised UTF-8 bytes. A task keeps the digests it has met in a ``CuckooIndex``: short fingerprints in two
possible buckets each, next to buckets of stored contents (digest, length, smallest id, copies). A digest whose fingerprint is
absent is new for certain and is inserted without a look at any content; a hit is verified against the stored contents of that
fingerprint's buckets, so a false positive of the filter never joins two texts. When an insertion finds no free place, the
filter grows and is rebuilt from the stored keys. Deletion takes a digest's fingerprint and content out again.

Two levels, so that a text with any number of copies does not gather in one task: each task first merges the copies in its own
rows, then one row per task and digest goes to the digest's shard, where a second index merges them. Copies then meet their
entry by a join on the digest that has one row per digest on one side, so Spark can split a hot digest on the other.

Ids of any orderable type. The smallest id of equal texts stays; null ids are larger than all others. Rows that repeat both id
and text are one document that occurs more than once: they share their fate, and count in ``group_size``. In a group of null
ids only, ``keep_id`` is null and all of them stay. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import picked, stored

#: Digests a map task holds before it hands its entries on; a bound of memory only, as the shards merge all of them.
HELD = 500_000
#: Rows that a shard gets on average.
SHARD_ROWS = 100_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class CuckooIndex:
    """A cuckoo filter over digests, with the stored contents that its hits are verified against.

    ``size`` buckets (a power of two) of ``SLOTS`` 16-bit fingerprints. A fingerprint's other bucket follows from the
    bucket it is in and the fingerprint itself, so entries can move without their keys.
    """

    SLOTS = 4
    KICKS = 200

    def __init__(self, size: int = 1024):
        self.size = 1 << max(1, (size - 1).bit_length())
        self.contents: dict[bytes, list] = {}
        self.resized = self.verified = self.false_hits = 0
        self._clear()

    def _clear(self) -> None:
        self.slots = [[] for _ in range(self.size)]
        self.kept: dict[int, list[bytes]] = {}

    def _place(self, digest: bytes) -> tuple[int, int]:
        mark = int.from_bytes(digest[:2], "little") or 1
        return mark, int.from_bytes(digest[2:8], "little") % self.size

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 % self.size)

    def __len__(self) -> int:
        return len(self.contents)

    def maybe(self, digest: bytes) -> bool:
        """False: the digest is not here. True: its contents decide."""
        mark, bucket = self._place(digest)
        return mark in self.slots[bucket] or mark in self.slots[self._other(bucket, mark)]

    def find(self, digest: bytes) -> list | None:
        """The stored content of a live digest."""
        if not self.maybe(digest):
            return None
        self.verified += 1
        for key in self.kept.get(self._place(digest)[0], ()):
            if key == digest:
                return self.contents[key]
        self.false_hits += 1
        return None

    def insert(self, digest: bytes, content: list) -> None:
        """Takes in a digest that ``find`` doesn't know."""
        self.contents[digest] = content
        self.kept.setdefault(self._place(digest)[0], []).append(digest)
        if not self._put(digest):
            self._grow()

    def delete(self, digest: bytes) -> bool:
        """Whether the digest was live. Equal fingerprints are interchangeable, so any one of the right buckets may go."""
        if self.find(digest) is None:
            return False
        mark, bucket = self._place(digest)
        slots = self.slots[bucket]
        (slots if mark in slots else self.slots[self._other(bucket, mark)]).remove(mark)
        self.kept[mark].remove(digest)
        if not self.kept[mark]:
            del self.kept[mark]
        del self.contents[digest]
        return True

    def _put(self, digest: bytes) -> bool:
        mark, bucket = self._place(digest)
        for b in (bucket, self._other(bucket, mark)):
            if len(self.slots[b]) < self.SLOTS:
                self.slots[b].append(mark)
                return True
        for kick in range(self.KICKS):
            slots = self.slots[bucket]
            slots[kick % self.SLOTS], mark = mark, slots[kick % self.SLOTS]
            bucket = self._other(bucket, mark)
            if len(self.slots[bucket]) < self.SLOTS:
                self.slots[bucket].append(mark)
                return True
        return False

    def _grow(self) -> None:
        """Doubles the filter until every stored key has a place."""
        while True:
            self.size *= 2
            self.resized += 1
            self.slots = [[] for _ in range(self.size)]
            if all(self._put(key) for key in self.contents):
                return


def _smaller(a, b):
    return b if a is None else a if b is None else min(a, b)


def _merge(index: CuckooIndex, rows: Iterable[tuple]) -> None:
    for digest, chars, low, copies in rows:
        digest = bytes(digest)
        content = index.find(digest)
        if content is None:
            index.insert(digest, [chars, low, copies])
        elif content[0] != chars:
            raise ValueError(f"two texts of {content[0]} and {chars} characters have one SHA-256: {digest.hex()}")
        else:
            content[1], content[2] = _smaller(content[1], low), content[2] + copies


def _out(index: CuckooIndex, schema: pa.Schema) -> pa.RecordBatch:
    keys, values = list(index.contents), list(index.contents.values())
    columns = [keys, *([v[k] for v in values] for k in range(3))]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _merging(id_type: T.DataType, held: int | None) -> Callable:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(_entry_schema(id_type))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for batch in batches:
            _merge(index, zip(*(c.to_pylist() for c in batch.columns)))
            if held is not None and len(index) >= held:
                yield _out(index, schema)
                index = CuckooIndex(index.size)
        for batch in [_out(index, schema)]:
            for at in range(0, batch.num_rows, 50_000):
                yield batch.slice(at, 50_000)

    return run


def _entry_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType().add("digest", T.BinaryType()).add("chars", T.LongType()).add("keep_id", id_type).add("group_size", T.LongType())


def shard_count(rows: int) -> int:
    return max(8, -(-rows // SHARD_ROWS))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the binary SHA-256 of the normalised text, and its length in code points."""
    rows = picked(docs, doc_id=id_col, text=text_col).select("doc_id", normalised(F.col("text")).alias("text"))
    return rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.length("text").cast("long").alias("chars"))


def build_index(rows: DataFrame, shards: int) -> DataFrame:
    """The index of ``digests`` rows: one row (digest, chars, keep_id, group_size) per live digest."""
    entry = _entry_schema(rows.schema["doc_id"].dataType)
    one = rows.select("digest", "chars", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return _sharded(one.mapInArrow(_merging(entry["keep_id"].dataType, HELD), entry), shards)


def _sharded(entries: DataFrame, shards: int) -> DataFrame:
    return entries.repartition(shards, "digest").mapInArrow(_merging(entries.schema["keep_id"].dataType, None), entries.schema)


def insert(index: DataFrame, rows: DataFrame, shards: int) -> DataFrame:
    """The index with more ``digests`` rows."""
    return _sharded(index.unionByName(build_index(rows, shards)), shards)


def delete(index: DataFrame, gone: DataFrame, shards: int) -> DataFrame:
    """The index without the digests of ``gone`` (column ``digest``); those it doesn't hold change nothing.

    A text deleted here is new again when it comes back.
    """
    entry = index.schema
    kept = index.select(F.lit(False).alias("gone"), *entry.names)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in entry.fields[1:]]
    both = kept.unionByName(gone.filter(F.col("digest").isNotNull()).select(F.lit(True).alias("gone"), "digest", *missing).distinct())
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(entry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, removed = CuckooIndex(), []
        for batch in batches:
            flags = np.array(batch.column(0).to_pylist(), bool)
            rows = list(zip(*(c.to_pylist() for c in batch.columns[1:])))
            removed += [bytes(r[0]) for r, g in zip(rows, flags) if g]
            _merge(index, (r for r, g in zip(rows, flags) if not g))
        for digest in removed:
            index.delete(digest)
        yield _out(index, schema)

    return both.repartition(shards, "digest").mapInArrow(run, entry)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    rows = stored(digests(docs, id_col, text_col), "digests")
    index = build_index(rows, shard_count(rows.count()))
    copies = index.filter("group_size > 1").select("digest", "keep_id", "group_size")
    joined = rows.join(copies, "digest", "left")
    single = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per different text, with its own columns, whatever their names: of equal texts the one with the smallest id.

    Of rows that share that id (or of texts without any id, of all) the one with the smallest hash over all its columns stays.
    """
    own = docs.columns
    names = [f"c{k}" for k in range(len(own))]
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(own, names)))
    text, doc = names[own.index(text_col)], names[own.index(id_col)]
    found = stored(digests(rows, doc, text), "digests")
    copies = build_index(found, shard_count(found.count())).filter("group_size > 1").select(F.col("digest").alias("copy_of"), "keep_id")
    marked = rows.withColumn("digest", F.unhex(F.sha2(normalised(F.col(text)), 256))).join(copies, F.col("digest") == F.col("copy_of"), "left")
    stays = F.col("copy_of").isNull() | F.col(doc).eqNullSafe(F.col("keep_id"))
    # Written, as both parts below read it: texts are hashed and joined once.
    left = stored(marked.filter(stays).select(*names, "copy_of"), "left")
    single = left.filter("copy_of is null").select(names)
    # What is left of a group are the rows of one id; they are combined in the map tasks already.
    first = left.filter("copy_of is not null").groupBy("copy_of").agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias("row")).select("row.*")
    return single.unionByName(first).select(*(F.col(n).alias(c) for c, n in zip(own, names)))
