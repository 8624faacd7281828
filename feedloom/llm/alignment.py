"""Cross-tokenizer alignment (operator 12): which tokens of two vocabularies stand for the same bytes, and how often.

Each text, with a space before it, is encoded by a byte-level BPE (A) and a piece BPE with byte fallback (B). Byte offsets where
tokens of both end cut them into groups; every A and B token of one group are a link. The count of an id pair is the number of
documents that hold it linked.

Counting spills. A map task takes a block of texts, writes the block's pairs and the documents' references to them, and
radix-partitions the pairs by their A id into *runs*: sorted pairs with the number of the block's documents, compressed by zstd. Runs
are rows of a table in the shared folder, so a lost executor loses none. A k-way heap merge of a partition's runs counts each pair; at
most ``FAN`` runs meet in one merge, and more are merged over several levels. As the order is by A id first, a pass over the final run
gives every A id's highest count. The runs then stream by once more and get their pairs' counts, which go back to their blocks, where
the documents add them up. So a pair that every document holds costs one record per block, not one per document.

No token of either crosses some places that two bytes tell: before a space that follows no white space, and between letters, digits and
other signs that no piece of B has side by side. The pieces between are therefore encoded on their own, each different one once (``words.Known``), also those of very long texts.

Texts that are null or empty, or whose joined tokens differ from the text (B has no form for U+2581), have no tokens: zeros and ''. Rows
with null or repeated ids are documents of their own. An empty table gives no rows; other columns are ignored, whatever their names.
Ties for the highest count are all best.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .bpe import byte_letters, vocabulary_path
from .shared import picked, stored
from .words import Known, byte_classes, cut_before, cut_table, flattened, ragged

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Radix partitions of the A ids.
PARTS = 64
#: Runs of one merge at most.
FAN = 256
#: Bytes of text in a block.
BLOCK = 1 << 22


class Aligner:
    """Both tokenizers, and what is known of pieces; made once per Python worker."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letters = byte_letters()
        with open(byte_path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.a_bytes = {i: bytes(letters[c] for c in token if c in letters) for token, i in vocabulary.items()}
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ]
        self.a_sizes = np.zeros(1 + max(self.a_bytes), np.int64)
        self.a_sizes[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.step = -(-len(self.a_sizes) // PARTS)
        # B puts a space before a text; a line feed, which is in no token but its byte's, keeps it away from the piece.
        self.lead = self.b.encode("\n")
        self.cuts = self._cuts()
        self.known = Known(self.learn, np.int32 if self.pair(0, 0, top=True) < 1 << 31 else np.int64)

    def _cuts(self) -> np.ndarray:
        """Where tokens of both end in any text: before a space that follows a character, and between letters, digits and other signs
        of ASCII that stand side by side in no token of B. (A's splitting separates these.)"""
        kind = byte_classes()
        left, right = kind[:, None], kind[None, :]
        flags = (left > 0) & (right > 0) & (left != right)
        for token in {t for i, t in enumerate(self.b_bytes) if not self.b.is_control(i)}:
            for x, y in zip(token, token[1:]):
                flags[x, y] = False
        # White space of more than one byte before the space is looked at in ``cut``.
        before = np.ones(256, bool)
        before[[32, *range(9, 14), *range(28, 32)]] = False
        flags[:, 32] = before
        return cut_table(flags)

    def pair(self, a, b, top: bool = False):
        """A number of the pair; by partition, then A id, then B id. With ``top`` one above all numbers."""
        if top:
            return PARTS * self.step * len(self.b_bytes)
        return ((a % PARTS) * self.step + a // PARTS) * len(self.b_bytes) + b

    def part_edges(self) -> np.ndarray:
        return np.arange(PARTS + 1, dtype=np.int64) * self.step * len(self.b_bytes)

    def learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Per piece (right, A tokens, B tokens, groups, links, then pair and links of it ...) and its groups as text."""
        texts = [p.decode() for p in pieces]
        count, length = len(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))
        size_a, a = flattened([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)])
        size_b, b = flattened([x[len(self.lead) :] for x in self.b.encode(["\n" + t for t in texts], num_threads=1)])
        of_a, of_b = np.repeat(np.arange(count), size_a), np.repeat(np.arange(count), size_b)
        # Behind which byte of all pieces together each token ends; pieces whose tokens have other bytes are put right first.
        good = (np.bincount(of_a, self.a_sizes[a], count) == length) & (np.bincount(of_b, self.b_sizes[b], count) == length)
        joined = b"".join(pieces)
        if not good.all() or b"".join([self.a_bytes[i] for i in a.tolist()]) != joined or b"".join([self.b_bytes[i] for i in b.tolist()]) != joined:
            for k, (to_a, to_b) in enumerate(zip(np.cumsum(size_a).tolist(), np.cumsum(size_b).tolist())):
                in_a, in_b = (b"".join([known[i] for i in ids]) for known, ids in ((self.a_bytes, a[to_a - size_a[k] : to_a].tolist()), (self.b_bytes, b[to_b - size_b[k] : to_b].tolist())))
                good[k] = in_a == in_b == pieces[k]
            kept_a, kept_b = good[of_a], good[of_b]
            a, of_a, b, of_b = a[kept_a], of_a[kept_a], b[kept_b], of_b[kept_b]
        size_a, size_b = np.bincount(of_a, minlength=count), np.bincount(of_b, minlength=count)
        end_a, end_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        marks = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(marks, end_a), np.searchsorted(marks, end_b)
        n_groups = np.bincount(of_a[np.searchsorted(end_a, marks)], minlength=count)
        # Each A token meets the B tokens of its group.
        first_b = np.searchsorted(group_b, np.arange(len(marks) + 1))
        at, edges = ragged(first_b, group_a)
        owner = np.repeat(of_a, np.diff(edges))
        pairs = self.pair(np.repeat(a.astype(np.int64), np.diff(edges)), b[at].astype(np.int64))
        n_links = np.bincount(owner, minlength=count)
        top = self.pair(0, 0, top=True)
        key, times = np.unique(owner * top + pairs, return_counts=True)
        owner = key // top
        n_pairs = np.bincount(owner, minlength=count)
        sizes = 5 + 2 * n_pairs
        heads = np.cumsum(sizes) - sizes
        flat = np.zeros(int(sizes.sum()), np.int64)
        for k, value in enumerate((good, size_a, size_b, n_groups, n_links)):
            flat[heads + k] = value
        place = heads[owner] + 5 + 2 * (np.arange(len(key)) - (np.cumsum(n_pairs) - n_pairs)[owner])
        flat[place], flat[place + 1] = key % top, times
        return sizes, flat, self._shown(a, b, group_a, group_b, n_groups)

    @staticmethod
    def _shown(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n_groups: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2`` per piece."""
        groups = int(n_groups.sum())
        shown_a, shown_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        cuts_a, cuts_b = (np.searchsorted(g, np.arange(groups + 1)).tolist() for g in (group_a, group_b))
        each = [
            f"{shown_a[i] if j - i == 1 else ','.join(shown_a[i:j])}|{shown_b[k] if m - k == 1 else ','.join(shown_b[k:m])}"
            for i, j, k, m in zip(cuts_a, cuts_a[1:], cuts_b, cuts_b[1:])
        ]
        last = np.concatenate([[0], np.cumsum(n_groups)]).tolist()
        return [";".join(each[i:j]) for i, j in zip(last, last[1:])]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    if (byte_path, piece_path) not in _aligners:
        _aligners[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _aligners[byte_path, piece_path]


def cut(block: blocks.Texts, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes with a space before each, and the pieces' starts, ends and first numbers per text. Empty texts have none."""
    sizes = np.diff(block.bounds)
    full = sizes > 0
    bounds = np.concatenate([[0], np.cumsum(sizes + full)])
    raw = np.insert(block.raw, block.bounds[:-1][full], 32)
    starts = np.flatnonzero(cut_before(raw, bounds, table)[:-1])
    # A character before a space may be white space of more than one byte: C2 85, C2 A0, or E1, E2, E3 with these last bytes.
    last, mid, first = (raw[np.maximum(starts - k, 0)] for k in (1, 2, 3))
    wide = (mid == 0xC2) & ((last == 0x85) | (last == 0xA0))
    wide |= (first == 0xE1) & (((mid == 0x9A) & (last == 0x80)) | ((mid == 0xA0) & (last == 0x8E)))
    wide |= (first == 0xE2) & (mid == 0x80) & (((last >= 0x80) & (last <= 0x8A)) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF))
    wide |= (first == 0xE2) & (mid == 0x81) & (last == 0x9F)
    wide |= (first == 0xE3) & (mid == 0x80) & (last == 0x80)
    starts = starts[~wide | np.isin(starts, bounds)]
    ends = np.concatenate([starts[1:], [len(raw)]]) if len(starts) else starts
    return raw, starts, ends, np.searchsorted(starts, bounds)


def _packed(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x.nbytes for x in arrays)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(x.tobytes() for x in arrays))


def _unpacked(blob: bytes, *kinds: type) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 8 * (1 + len(kinds)), []
    for kind, size in zip(kinds, np.frombuffer(data, np.int64, len(kinds), 8).tolist()):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


@dataclass
class Rows:
    """What a block says of its texts, and its different pairs."""

    counts: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    holders: np.ndarray
    edges: np.ndarray
    places: np.ndarray
    times: np.ndarray


def aligned(block: blocks.Texts, with_: Aligner) -> Rows:
    known = with_.known
    raw, starts, ends, of = cut(block, with_.cuts)
    entries = known(raw, starts, ends, blocks.span_hashes(blocks.prefix_sums(raw), starts, ends))
    n, text = len(block), np.repeat(np.arange(len(block)), np.diff(of))
    head = known.edges[:-1][entries]
    wrong = np.bincount(text[known.flat[head] == 0], minlength=n) > 0
    good = ~wrong[text]
    entries, text, head = entries[good], text[good], head[good]
    counts = np.stack([np.bincount(text, known.flat[head + k], n).astype(np.int64) for k in range(1, 5)], 1)
    names, last = known.names[entries].tolist(), np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))]).tolist()
    groups = [hashlib.sha256(";".join(names[a:b]).encode()).hexdigest() if a < b else "" for a, b in zip(last, last[1:])]
    at, edges = ragged(known.edges, entries)
    # Behind the five numbers of a piece stand pairs and their links, in turn.
    inner = np.arange(len(at)) - np.repeat(edges[:-1], np.diff(edges))
    at, inner, owner = at[inner >= 5], inner[inner >= 5], np.repeat(text, np.diff(edges) - 5)
    odd = (inner - 5) % 2 == 1
    pairs, places = np.unique(known.flat[at[~odd]].astype(np.int64), return_inverse=True)
    key = owner[~odd] * max(len(pairs), 1) + places
    key, back = np.unique(key, return_inverse=True)
    times = np.bincount(back, known.flat[at[odd]], len(key)).astype(np.int64)
    places = key % max(len(pairs), 1)
    sizes = np.bincount(key // max(len(pairs), 1), minlength=n)
    holders = np.bincount(places, minlength=len(pairs)).astype(np.int64)
    return Rows(counts, groups, pairs, holders, np.concatenate([[0], np.cumsum(sizes)]), places.astype(np.int32), times.astype(np.int32))


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _spilled(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Per block one row of its documents (part -1) and one row per radix partition that it has pairs in, the run."""
    kind = dict(docs.dtypes)["id"]
    names = ["block", "part", "ids", *COUNTS, "groups", "blob"]

    def lists(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_ = aligner(*paths)
        part_edges, block = with_.part_edges(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for texts in blocks.texts(batch.column(1), BLOCK):
                found = aligned(texts, with_)
                ids = batch.column(0).slice(texts.first, len(texts))
                own = [lists(ids), *(lists(pa.array(found.counts[:, k])) for k in range(4)), lists(pa.array(found.groups, pa.string()))]
                refs = _packed(found.edges, found.places, found.times)
                head = [pa.array([block], pa.int64()), pa.array([-1], pa.int32())]
                yield pa.RecordBatch.from_arrays([*head, *own, pa.array([refs], pa.binary())], names)
                at = np.searchsorted(found.pairs, part_edges)
                parts = np.flatnonzero(np.diff(at))
                runs = [_packed(found.pairs[at[p] : at[p + 1]], found.holders[at[p] : at[p + 1]]) for p in parts]
                none = [pa.nulls(len(parts), x.type) for x in own]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), block)), pa.array(parts.astype(np.int32)), *none, pa.array(runs, pa.binary())], names)
                block += 1

    schema = f"block long, part int, ids array<{kind}>, {', '.join(f'{c} array<long>' for c in COUNTS)}, groups array<string>, blob binary"
    return docs.select("id", "text").mapInArrow(run, schema)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Consecutive rows that agree in the first ``keys`` columns."""
    rows = (tuple(c[i].as_py() for c in batch.columns) for batch in batches for i in range(len(batch)))
    return groupby(rows, key=lambda r: r[:keys])


def _run(blob: bytes) -> Iterator[tuple[int, int]]:
    pairs, counts = _unpacked(blob, np.int64, np.int64)
    return zip(pairs.tolist(), counts.tolist())


def merged(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The runs' pairs in order with their summed counts, by a heap over the runs."""
    pairs, counts = [], []
    for pair, same in groupby(heapq.merge(*map(_run, blobs)), key=itemgetter(0)):
        pairs.append(pair)
        counts.append(sum(n for _, n in same))
    return np.array(pairs, np.int64), np.array(counts, np.int64)


def _merge_level(runs: DataFrame, groups: int, best: int = 0) -> DataFrame:
    """Rows (part, block, blob) to one run per part and group of blocks. With ``best`` (the number of B ids) the runs are final, and say
    which pairs have the highest count of their A id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, group), rows in _groups(batches, 2):
            pairs, counts = merged([r[3] for r in rows])
            if best:
                a = pairs // best
                first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
                most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(a))))
                counts = 2 * counts + (counts == most)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([group], pa.int64()), pa.array([_packed(pairs, counts)], pa.binary())], ["part", "block", "blob"])

    dealt = runs.select("part", F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group"), "block", "blob")
    dealt = dealt.repartition("part", "group").sortWithinPartitions("part", "group", "block")
    return dealt.mapInArrow(run, "part int, block long, blob binary")


def _answers(runs: DataFrame, final: DataFrame, salts: int) -> DataFrame:
    """Rows (block, part, blob): the counts of a run's pairs, twice the count and one more for the best ones.

    A partition's final run goes ahead of the runs that it answers, in each of ``salts`` shares of the blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, _), rows in _groups(batches, 2):
            pairs = counts = None
            for *_, block, blob in rows:
                if block < 0:
                    pairs, counts = _unpacked(blob, np.int64, np.int64)
                    continue
                asked, _n = _unpacked(blob, np.int64, np.int64)
                answer = _packed(counts[np.searchsorted(pairs, asked)])
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([part], pa.int32()), pa.array([answer], pa.binary())], ["block", "part", "blob"])

    asked = runs.select("part", F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt"), "block", "blob")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    heads = final.select("part", each.alias("salt"), F.lit(-1).cast("long").alias("block"), "blob")
    dealt = heads.unionByName(asked).repartition("part", "salt").sortWithinPartitions("part", "salt", "block")
    return dealt.mapInArrow(run, "block long, part int, blob binary")


def alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_path: str | None = None, piece_path: str | None = None, fan: int = FAN) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    paths = byte_path or vocabulary_path(BYTE_VOCABULARY), piece_path or vocabulary_path(PIECE_VOCABULARY)
    source = picked(docs, id=id_col, text=text_col)
    work = stored(_spilled(source, paths), "runs")
    runs = work.filter("part >= 0").select("part", "block", "blob")
    final = _counted(work, runs, len(aligner(*paths).b_bytes), fan)
    salts = max(1, -(-work.filter("part < 0").count() // fan))
    answers = _answers(runs, final, salts)
    own = work.filter("part < 0")
    empty = {c: F.lit(None).cast(own.schema[c].dataType) for c in ("ids", *COUNTS, "groups")}
    # Answers come in the order of the parts, so of the pairs; the documents' own row comes last.
    both = answers.withColumns(empty).unionByName(own.withColumn("part", F.lit(PARTS)))
    dealt = both.select("block", "part", "ids", *COUNTS, "groups", "blob").repartition("block").sortWithinPartitions("block", "part")
    names = ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for i in range(len(batch)):
                if batch.column(1)[i].as_py() < PARTS:
                    held += _unpacked(batch.column(8)[i].as_py(), np.int64)
                    continue
                edges, places, times = _unpacked(batch.column(8)[i].as_py(), np.int64, np.int32, np.int32)
                counts = np.concatenate([np.zeros(0, np.int64), *held])[places]
                held = []
                sums = [np.concatenate([[0], np.cumsum(x)])[edges] for x in (times * (counts & 1), times * (counts >> 1))]
                lists = [batch.column(k)[i].values for k in range(2, 8)]
                yield pa.RecordBatch.from_arrays([*lists[:5], *(pa.array(np.diff(s).astype(np.int64)) for s in sums), lists[5]], names)

    kind = dict(source.dtypes)["id"]
    return dealt.mapInArrow(run, f"doc_id {kind}, {', '.join(f'{c} long' for c in names[1:-1])}, groups_sha256 string")


def _counted(work: DataFrame, runs: DataFrame, size_b: int, fan: int) -> DataFrame:
    """The final run of each partition: rows (part, blob)."""
    left = work.filter("part < 0").count()
    while left > fan:
        left = -(-left // fan)
        runs = stored(_merge_level(runs, left), "merged")
    return stored(_merge_level(runs, 1, best=size_b), "counts").select("part", "blob")


def pair_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_path: str | None = None, piece_path: str | None = None, fan: int = FAN) -> DataFrame:
    """Per linked id pair: a_id, b_id, n_docs, best (no other pair of the A id has more)."""
    paths = byte_path or vocabulary_path(BYTE_VOCABULARY), piece_path or vocabulary_path(PIECE_VOCABULARY)
    work = stored(_spilled(picked(docs, id=id_col, text=text_col), paths), "runs")
    with_ = aligner(*paths)
    size_b, step = len(with_.b_bytes), with_.step

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                pairs, counts = _unpacked(blob.as_py(), np.int64, np.int64)
                a = pairs // size_b
                a = a % step * PARTS + a // step
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a, pairs % size_b, counts >> 1, counts & 1 == 1)], ["a_id", "b_id", "n_docs", "best"])

    final = _counted(work, work.filter("part >= 0").select("part", "block", "blob"), size_b, fan)
    return final.select("blob").mapInArrow(run, "a_id long, b_id long, n_docs long, best boolean")
