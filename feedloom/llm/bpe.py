"""BPE encoding and decoding (operator 1): speculate and verify.

Greedy longest match proposes the tokens of a word at once. A proposal is right if and only if each pair of neighbours is
*compatible*, that is, if the merges applied to the two tokens' bytes alone give just these two tokens: merges never cross a
boundary that no pair of neighbours would cross. All different pairs of a batch are tested together with numpy, by undoing the
merges of the two tokens step by step and asking whether an earlier merge would have joined what then meets at the boundary.
Only the words with an incompatible pair are merged exactly, pair by pair.

Results equal the tokenizers library's for a byte-level vocabulary file, ``encode(text, add_special_tokens=False)`` without
truncation and padding: special strings in a text become their ids. Null is an empty text, which has no tokens and decodes to
''. Whole texts are encoded whatever their length; repeated rows and ids are encoded alike, null ids are carried along.
"""

from __future__ import annotations

import hashlib
import heapq
import importlib.util
import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .shared import picked

VOCABULARY = "byte_bpe_50k.json"
#: What GPT-2's public tokenizer splits a text by before merging; a fixed value.
SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Words whose tokens a worker remembers at least; of up to twice as many, those not met lately go. This changes no result.
REMEMBERED = 250_000
#: Letters of these words at most.
REMEMBERED_LETTERS = 1 << 22
#: Bytes from which on a word is merged with a heap.
SHORT = 200


def vocabulary_path(name: str = VOCABULARY, folder: str | None = None) -> str:
    """The file of a public tokenizer; ``folder`` or FEEDLOOM_TOKENIZERS name another place."""
    folder = folder or os.environ.get("FEEDLOOM_TOKENIZERS")
    if folder is None:
        if importlib.util.find_spec("public_tokenizers") is not None:
            import public_tokenizers

            return public_tokenizers.path(name)
        folder = "/opt/tokenizers"
    return os.path.join(folder, name)


def byte_letters() -> dict[str, int]:
    """The visible letter that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    rest = (b for b in range(256) if b not in set(shown))
    return letters | {chr(256 + k): b for k, b in enumerate(rest)}


class Codec:
    """Encodes and decodes with one vocabulary file; made once per Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = byte_letters()
        as_bytes = {token: bytes(letters[c] for c in token) for token in model["model"]["vocab"]}
        self.ids = {as_bytes[token]: i for token, i in model["model"]["vocab"].items()}
        size = 1 + max([*self.ids.values(), *(x["id"] for x in model["added_tokens"])])
        self.bytes: list[bytes] = [b""] * size
        for token, i in self.ids.items():
            self.bytes[i] = token
        self.special = {}
        for extra in model["added_tokens"]:
            self.special[extra["content"]] = extra["id"]
            self.bytes[extra["id"]] = extra["content"].encode()
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("|".join(map(regex.escape, names))) if names else None
        #: The longest token that begins with three given bytes.
        self.reach: dict[bytes, int] = {}
        for token in self.ids:
            self.reach[token[:3]] = max(self.reach.get(token[:3], 0), len(token))
        # Merge r makes token made[r] of left and right; a token that no merge makes keeps itself as both parts.
        self.size = size
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        self.parts = np.tile(np.arange(size, dtype=np.int64)[:, None], (1, 2))
        self.made_at = np.full(size, -1, np.int64)
        for r, pair in enumerate(model["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = self.ids[as_bytes[a]], self.ids[as_bytes[b]]
            token = self.ids[as_bytes[a] + as_bytes[b]]
            self.rank[left * size + right] = r
            self.made.append(token)
            if self.made_at[token] < 0:
                self.made_at[token], self.parts[token] = r, (left, right)
        keys = np.array(list(self.rank), np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(self.rank.values()), np.int64)[order]
        # A token that its own bytes don't merge to can't be proposed.
        self.proposed = {token: i for token, i in self.ids.items() if self.merged(token) == [i]}
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.letters = 0
        self.speculated = self.mended = 0

    # -- one word -----------------------------------------------------------------------------------------------------

    def merged(self, word: bytes) -> list[int]:
        """The exact merges: always the earliest one in the list, the leftmost of equals."""
        token = [self.ids[word[i : i + 1]] for i in range(len(word))]
        if len(token) > SHORT:
            return self._merged_long(token)
        none, found, made, size = len(self.made), self.rank.get, self.made, self.size
        ranks = [found(a * size + b, none) for a, b in zip(token, token[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            token[i] = new = made[best]
            del token[i + 1], ranks[i]
            if i:
                ranks[i - 1] = found(token[i - 1] * size + new, none)
            if i < len(ranks):
                ranks[i] = found(new * size + token[i + 1], none)
        return token

    def _merged_long(self, token: list[int]) -> list[int]:
        """The same with a heap: n log n steps for n bytes."""
        after, before = list(range(1, len(token) + 1)), list(range(-1, len(token) - 1))
        waiting = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(token):
                hit = self.rank.get(token[i] * self.size + token[after[i]])
                if hit is not None:
                    heapq.heappush(waiting, (hit, i, token[i], token[after[i]]))

        for i in range(len(token) - 1):
            offer(i)
        while waiting:
            hit, i, left, right = heapq.heappop(waiting)
            if token[i] != left or (j := after[i]) >= len(token) or token[j] != right:
                continue
            token[i], token[j], after[i] = self.made[hit], -1, after[j]
            if after[j] < len(token):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [t for t in token if t >= 0]

    def proposal(self, word: bytes) -> list[int]:
        """Greedy longest match from the left; how far to look follows from the next three bytes."""
        found, at, known, reach = [], 0, self.proposed, self.reach
        while at < len(word):
            end = min(len(word), at + reach.get(word[at : at + 3], 2))
            while (token := known.get(word[at:end])) is None:
                end -= 1
            found.append(token)
            at = end
        return found

    # -- all pairs of a batch -----------------------------------------------------------------------------------------

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the bytes of two tokens merge to just these two.

        Going back from the finished tokens, the later of the two last merges is undone first. ``limit`` is the rank from
        which on a merge across the boundary would come too late: what stands there now is joined later than that by its own
        side. Equal ranks are decided by position: the left one goes first.
        """
        left, right = left.copy(), right.copy()
        good = np.ones(len(left), bool)
        # Twice the rank, plus one if a merge across of just this rank still comes first.
        limit = np.full(len(left), np.iinfo(np.int64).max)
        live = np.arange(len(left))
        while len(live):
            a, b = left[live], right[live]
            key = a * self.size + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            crossing = np.where(self.pair_keys[at] == key, 2 * self.pair_ranks[at], np.iinfo(np.int64).max)
            lost = crossing < limit[live]
            good[live[lost]] = False
            live, a, b = live[~lost], a[~lost], b[~lost]
            ra, rb = self.made_at[a], self.made_at[b]
            whole = (ra < 0) & (rb < 0)
            live, a, b, ra, rb = (x[~whole] for x in (live, a, b, ra, rb))
            undo_left = ra > rb
            limit[live] = np.where(undo_left, 2 * ra, 2 * rb + 1)
            left[live] = np.where(undo_left, self.parts[a, 1], a)
            right[live] = np.where(undo_left, b, self.parts[b, 0])
        return good

    def learn(self, words: list[str]) -> None:
        """Puts the tokens of new words into the memory."""
        proposals = [self.proposal(word.encode()) for word in words]
        flat = np.fromiter((t for p in proposals for t in p), np.int64)
        sizes = np.fromiter(map(len, proposals), np.int64, len(proposals))
        good = np.ones(len(words), bool)
        if len(flat) > 1:
            of = np.repeat(np.arange(len(words)), sizes)
            inner = of[1:] == of[:-1]
            key, back = np.unique((flat[:-1] * self.size + flat[1:])[inner], return_inverse=True)
            bad = ~self.compatible(key // self.size, key % self.size)[back]
            good[of[1:][inner][bad]] = False
        self.speculated += len(words)
        self.mended += int((~good).sum())
        self.letters += sum(map(len, words))
        for word, tokens, right in zip(words, proposals, good.tolist()):
            self.words[word] = tuple(tokens) if right else tuple(self.merged(word.encode()))

    # -- texts --------------------------------------------------------------------------------------------------------

    def split(self, text: str) -> Iterator[tuple[str, bool]]:
        """Pieces of a text, and whether a piece is a special string."""
        at = 0
        for hit in self.special_pattern.finditer(text) if self.special_pattern else ():
            if at < hit.start():
                yield text[at : hit.start()], False
            yield hit[0], True
            at = hit.end()
        if at < len(text):
            yield text[at:], False

    def pieces(self, text: str) -> list[str]:
        if not any(name in text for name in self.special):
            return SPLIT.findall(text)
        return [p for part, special in self.split(text) for p in ([part] if special else SPLIT.findall(part))]

    def encode_batch(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        """The ids of each text, a few texts at a time so that memory stays bounded."""
        held, size = [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size > 1 << 20:
                yield from self._encode(held)
                held, size = [], 0
        yield from self._encode(held)

    def _encode(self, texts: list[str]) -> Iterator[list[int]]:
        cut = [self.pieces(text) for text in texts]
        if len(self.words) > REMEMBERED or self.letters > REMEMBERED_LETTERS:
            self.words, self.older, self.letters = {}, self.words, 0
        for name, i in self.special.items():
            self.words[name] = (i,)
        new = set().union(*cut).difference(self.words)
        for word in new & self.older.keys():
            self.words[word] = self.older[word]
            self.letters += len(word)
        new.difference_update(self.words)
        if new:
            self.learn(list(new))
        known = self.words
        for pieces in cut:
            yield [t for p in pieces for t in known[p]]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD. An id outside the vocabulary is skipped."""
        return b"".join([self.bytes[i] for i in ids if 0 <= i < self.size]).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row (doc_id, ids array<int>) per row."""
    path = path or vocabulary_path()
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            for first, count, ids in _slices(coder, batch):
                sizes = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.fromiter((t for x in ids for t in x), np.int32, int(sizes[-1]))
                lists = pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, count), lists], ["doc_id", "ids"])

    return picked(docs, doc_id=id_col, text=text_col).mapInArrow(run, schema)


def _slices(coder: Codec, batch: pa.RecordBatch, size: int = 1 << 22) -> Iterator[tuple[int, int, list[list[int]]]]:
    """Rows of a batch with their ids, so many at a time that lists of ids stay small."""
    column, first, ids, held = batch.column(1), 0, [], 0
    for row, mine in enumerate(coder.encode_batch(t.as_py() for t in column)):
        ids.append(mine)
        held += len(mine)
        if held > size:
            yield first, row + 1 - first, ids
            first, ids, held = row + 1, [], 0
    if ids:
        yield first, len(ids), ids


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """One row (doc_id, text) per row; null ids decode to ''."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            out = [coder.decode(x.as_py() or ()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return picked(encoded, doc_id=id_col, ids=ids_col).mapInArrow(run, f"doc_id {dict(encoded.dtypes)[id_col]}, text string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 of the decimal ids joined by commas, decoded_sha256 of the decoded UTF-8 text.

    Encoding and decoding meet in one task, so the ids cross no process border.
    """
    path = path or vocabulary_path()
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        digits = [str(i) for i in range(coder.size)]
        for batch in batches:
            rows = []
            texts = (t.as_py() for t in batch.column(1))
            for text, ids in zip(batch.column(1), coder.encode_batch(texts)):
                decoded = coder.decode(ids)
                joined = ",".join([digits[i] for i in ids])
                same = decoded == (text.as_py() or "")
                rows.append((len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), same))
            n, a, b, same = zip(*rows) if rows else ((),) * 4
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    return picked(docs, doc_id=id_col, text=text_col).mapInArrow(run, schema)
