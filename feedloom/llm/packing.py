"""Packing (operator 11): shortest pack first over the length histogram.

Every document becomes the ids of a public tokenizer plus an end id. A document longer than a sequence is cut into whole sequences
and a tail. Only the *histogram* of lengths reaches the driver (at most ``size`` rows): lengths are placed longest first, each into
the packs that have the most room left, and what is kept are ranges of packs with equal contents, not packs. Each range remembers
which ranks of a length it took, so documents find their place by their rank among the rows of their length: a running count per
block of a map task and length, summed in two levels, never over documents in one task.

What room is left at the end is filled by cutting: the shortest packs are dissolved, just so many that their tokens fill the room in
the others, and laid out as one stream of tokens over one stream of gaps. Fewer than ``size`` tokens are left over; they become
sequences of powers of two, which need no padding. So there is no padding at all, and only the dissolved packs' documents are cut
beyond what their length needs.

Null text is empty: just the end id. Rows with null or repeated ids are documents of their own. Texts of any length are encoded
whole; ties are ranked by their place in the table. An empty table has no pieces; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import os
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import blocks
from .bpe import vocabulary_path
from .shared import picked, stored
from .words import Known, byte_classes, cut_before, cut_table, flattened, ragged

VOCABULARY = "word_bpe_49k.json"
END = 1
SIZE = 2048
#: Ids from which on a map task begins a new block.
BLOCK = 1 << 22
#: Blocks whose counts are summed within one group of the running count.
RANGE = 1024

_known: dict[str, Known] = {}


def _encoder(path: str) -> Known:
    """Ids by the tokenizers library, one list per piece of a text."""
    if path not in _known:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        coder = Tokenizer.from_file(path)
        coder.no_truncation()
        coder.no_padding()

        def learn(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, None]:
            made = coder.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
            return *flattened([e.ids for e in made]), None

        _known[path] = Known(learn)
    return _known[path]


def _cuts() -> np.ndarray:
    """Where the tokenizer's splitting always ends a piece: letters, single digits and other signs of ASCII never share one.

    The apostrophe may stand in a piece with letters, and what is beyond ASCII may join what is before it, so neither is cut off.
    """
    kind = byte_classes()
    left, right = kind[:, None], kind[None, :]
    return cut_table((left > 0) & (right > 0) & ((left != right) | (left == 2)))


_CUTS = _cuts()


def pieces(block: blocks.Texts) -> tuple[blocks.Texts, blocks.Words]:
    """The text that is hashed, and its pieces without white space, which the splitting drops. Where a special string may stand, only
    white space cuts, and capitals stay; elsewhere A-Z are lower-cased, as the tokenizer does itself."""
    if b"<|" in block.raw.tobytes():
        return block, blocks.words(block)
    block = block.lower()
    inside = blocks.words_flags(block.raw)
    cut = cut_before(block.raw, block.bounds, _CUTS)
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:-1]
    end[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(begin)
    return block, blocks.Words(starts, np.flatnonzero(end) + 1, np.searchsorted(starts, block.bounds))


def token_blocks(column: pa.Array, path: str, end: int = END) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, ids and edges, for runs of texts; each text has the end id behind its own ones."""
    known = _encoder(path)
    for block in blocks.texts(column):
        block, found = pieces(block)
        entries = known(block.raw, found.starts, found.ends, blocks.word_hashes(block, found))
        at, word_edges = ragged(known.edges, entries)
        # Each text's end id goes behind its words' ids.
        ends = word_edges[found.of[1:]]
        ids = np.insert(known.flat[at].astype("<u4"), ends, end)
        yield block.first, ids, np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])


def tokenized(docs: DataFrame, path: str, size: int, end: int = END) -> DataFrame:
    """Rows (id, text) to (id, block, row, n, fulls, tail, ids): the little-endian 32-bit ids of a document and the sequences it fills.

    ``block`` and ``row`` say where the row stands, so each has a place of its own, also with ids that are null or repeat.
    """
    kind = dict(docs.dtypes)["id"]
    names = ["id", "block", "row", "n", "fulls", "tail", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, row, held = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            for first, ids, edges in token_blocks(batch.column(1), path, end):
                n = np.diff(edges)
                if held > BLOCK:
                    block, row, held = block + 1, 0, 0
                rows = row + np.arange(len(n))
                row, held = row + len(n), held + len(ids)
                # Binary columns have 32-bit offsets, so a run of many ids goes out in slices.
                for a, b in _slices(4 * edges):
                    data = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), b - a, [None, pa.py_buffer(np.ascontiguousarray(4 * (edges[a : b + 1] - edges[a]))), pa.py_buffer(ids[edges[a] : edges[b]].tobytes())]
                    ).cast(pa.binary())
                    counts = [np.full(b - a, block), rows[a:b], n[a:b], n[a:b] // size, n[a:b] % size]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first + a, b - a), *(pa.array(c.astype(np.int64)) for c in counts), data], names)

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, block long, row long, n long, fulls long, tail long, ids binary")


def _slices(edges: np.ndarray, most: int = 1 << 26) -> Iterator[tuple[int, int]]:
    first, last = 0, len(edges) - 1
    while first < last:
        to = max(first + 1, int(np.searchsorted(edges, edges[first] + most, "right")) - 1)
        yield first, min(to, last)
        first = min(to, last)


@dataclass
class Plan:
    """Where the documents of each length go.

    ``taken[length]``: sorted (first rank, first pack, offset), each good up to the next one's rank. ``fills``: sorted (first pack,
    fill of that pack and the ones behind it). ``dissolved``: sorted (first pack, behind the last, fill, place of the first in the
    stream). ``gaps``: (place in the stream, first pack, behind the last, fill). ``rest``: (place in the stream, sequence, length).
    """

    size: int
    packs: int = 0
    taken: dict[int, list[tuple[int, int, int]]] = field(default_factory=dict)
    dissolved: list[tuple[int, int, int, int]] = field(default_factory=list)
    gaps: list[tuple[int, int, int, int]] = field(default_factory=list)
    rest: list[tuple[int, int, int]] = field(default_factory=list)
    sequences: int = 0

    def sequence(self, pack: int) -> int:
        """A pack's number without the dissolved ones before it."""
        return pack - sum(min(pack, hi) - lo for lo, hi, _, _ in self.dissolved if lo < pack)

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the document's tail, length, sequence, offset) of the document of this length and rank."""
        segments = self.taken[length]
        first, pack, offset = segments[bisect_right(segments, (rank, self.packs, self.size)) - 1]
        pack += rank - first
        at = bisect_right(self.dissolved, (pack, self.packs + 1, 0, 0)) - 1
        if at < 0 or pack >= self.dissolved[at][1]:
            return [(0, length, self.sequence(pack), offset)]
        lo, _, fill, base = self.dissolved[at]
        return self._cut(base + (pack - lo) * fill + offset, length)

    def _cut(self, place: int, length: int) -> list[tuple[int, int, int, int]]:
        out, start = [], 0
        while start < length:
            here = place + start
            at = bisect_right(self.gaps, (here, self.packs + 1, 0, 0)) - 1
            base, lo, hi, fill = self.gaps[at] if at >= 0 else (0, 0, 0, 0)
            gap = self.size - fill
            if at >= 0 and here < base + (hi - lo) * gap:
                pack, inside = divmod(here - base, gap)
                much, sequence, offset = min(length - start, gap - inside), self.sequence(lo + pack), fill + inside
            else:
                base, sequence, whole = self.rest[bisect_right(self.rest, (here, self.sequences, 0)) - 1]
                offset = here - base
                much = min(length - start, whole - offset)
            out.append((start, much, sequence, offset))
            start += much
        return out


def plan(histogram: dict[int, int], size: int = SIZE) -> Plan:
    """Shortest pack first: lengths longest first, each into the packs with the most room. Lengths are 1 to ``size - 1``."""
    out = Plan(size)
    open_packs: list[tuple[int, int, int]] = []  # (fill, first pack, behind the last)
    closed: list[tuple[int, int, int]] = []
    for length in sorted(histogram, reverse=True):
        left, rank, segments = histogram[length], 0, out.taken.setdefault(length, [])
        while left:
            if open_packs and open_packs[0][0] + length <= size:
                fill, lo, hi = heapq.heappop(open_packs)
                some = min(left, hi - lo)
                if some < hi - lo:
                    heapq.heappush(open_packs, (fill, lo + some, hi))
            else:
                fill, lo, some = 0, out.packs, left
                out.packs += left
            segments.append((rank, lo, fill))
            if fill + length < size:
                heapq.heappush(open_packs, (fill + length, lo, lo + some))
            rank, left = rank + some, left - some
    closed = sorted(open_packs)
    # Dissolve the d shortest packs with the least d whose tokens fill the room in the others.
    tokens, room, cut = 0, sum((size - fill) * (hi - lo) for fill, lo, hi in closed), []
    while tokens < room:
        fill, lo, hi = closed[0]
        # One more dissolved pack adds its fill and takes its room away: size in all.
        some = min(hi - lo, -(-(room - tokens) // size))
        cut.append((lo, lo + some, fill))
        tokens, room = tokens + some * fill, room - some * (size - fill)
        closed[0:1] = [(fill, lo + some, hi)] if some < hi - lo else []
    place = 0
    for lo, hi, fill in cut:
        out.dissolved.append((lo, hi, fill, place))
        place += (hi - lo) * fill
    out.dissolved.sort()
    at = 0
    for fill, lo, hi in closed:
        out.gaps.append((at, lo, hi, fill))
        at += (hi - lo) * (size - fill)
    out.sequences = out.packs - sum(hi - lo for lo, hi, _ in cut)
    for bit in reversed(range((place - at).bit_length())):
        if (place - at) >> bit & 1:
            out.rest.append((at + sum(n for *_, n in out.rest), out.sequences, 1 << bit))
            out.sequences += 1
    return out


def _before(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``first``: the sum of ``value`` over all blocks before this one, per ``keys``; in two levels, so no task holds all blocks of a key."""
    rows = counts.withColumn("range", F.floor(F.col("block") / RANGE))
    inner = W.partitionBy(*keys, "range").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    outer = W.partitionBy(*keys).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = rows.groupBy(*keys, "range").agg(F.sum(value).alias("v")).withColumn("r_first", F.coalesce(F.sum("v").over(outer), F.lit(0))).drop("v")
    inside = rows.withColumn("i_first", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return inside.join(ranges, [*keys, "range"]).select(*keys, "block", (F.col("r_first") + F.col("i_first")).alias("first"))


def pack(docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = END) -> DataFrame:
    """Per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset. Every sequence is full or
    a power of two long."""
    path = path or vocabulary_path(VOCABULARY)
    work = stored(tokenized(picked(docs, id=id_col, text=text_col), path, size, end), "tokens")
    # The ranks of a block's rows: of tails among those of their length, of whole sequences among all.
    tails = work.filter("tail > 0").groupBy("tail", "block").agg(F.count(F.lit(1)).alias("docs"))
    tails = stored(tails, "tails")
    histogram = {r["tail"]: r["docs"] for r in tails.groupBy("tail").agg(F.sum("docs").alias("docs")).collect()}
    packs = plan(histogram, size)
    whole = stored(work.groupBy("block").agg(F.sum("fulls").alias("fulls")).filter("fulls > 0").withColumn("tail", F.lit(0).cast("long")), "fulls")
    firsts = _before(tails, ["tail"], "docs").unionByName(_before(whole, ["tail"], "fulls"))
    # One row per block: its first ranks by length; the lengths are fewer than ``size``.
    firsts = firsts.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("tail", "first"))).alias("firsts"))
    kind = dict(work.dtypes)["id"]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ranks, fulls = None, {}, 0
        for batch in batches:
            out, rows, held = [], [], 0
            at, n = (batch.column(k).to_numpy() for k in (1, 2))
            for i in range(len(batch)):
                if batch.column(4)[i].is_valid:
                    block, ranks = at[i], dict(batch.column(4)[i].as_py())
                    fulls = ranks.pop(0, 0)
                    continue
                assert at[i] == block
                ids, tail = batch.column(3)[i].as_py(), int(n[i] % size)
                cuts = [(k * size, size, packs.sequences + fulls + k, 0) for k in range(n[i] // size)]
                fulls += n[i] // size
                if tail:
                    cuts += [(n[i] - tail + a, b, s, o) for a, b, s, o in packs.pieces(tail, ranks[tail])]
                    ranks[tail] += 1
                for start, length, sequence, offset in cuts:
                    out.append((start, length, ids[4 * start : 4 * (start + length)], n[i], sequence, offset))
                    rows.append(i)
                held += len(ids)
                if held > 1 << 25:
                    yield _pieces(batch.column(0), rows, out, names)
                    out, rows, held = [], [], 0
            if rows:
                yield _pieces(batch.column(0), rows, out, names)

    lists = work.select("block", "row", "id", "n", "ids", F.lit(None).cast("map<bigint,bigint>").alias("firsts"))
    heads = firsts.select("block", F.lit(-1).cast("long").alias("row"), F.lit(None).cast(kind).alias("id"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("binary").alias("ids"), "firsts")
    # A block's ranks come just before its rows.
    both = heads.unionByName(lists).repartition("block").sortWithinPartitions("block", "row")
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return both.select("id", "block", "n", "ids", "firsts").mapInArrow(place, schema)


def _pieces(ids: pa.Array, rows: list[int], out: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names)
