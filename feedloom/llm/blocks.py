"""Vectorised work on the bytes, words and shingles of whole texts inside Arrow batches.

A column of texts is cut into runs of rows of about ``CHUNK`` bytes (a longer text is a run of its own), so memory follows the
longest text and not the batch. Words are ``[^\\x20\\x09-\\x0D]+``; null counts as an empty text. All hashes are 64 bits wide,
free of seeds that vary by process, and the same on every executor.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21
#: Texts of a run at most, for work that costs memory per text.
ROWS = 8192
_STEP = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_ALL = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit values of a seed."""
    start = np.array([(seed * 0xD1342543DE82EF95) & _ALL], np.uint64)
    return mix(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_STEP))


_LETTERS = stream(1, 256)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Lower-case letters, digits and all bytes of letters beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):
    # Not every C library has it.
    _trim = None
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _grown(name: str, base: int, n: int) -> np.ndarray:
    """Powers of the base; those for longer texts than a run's are not kept."""
    if len(_powers[name]) >= n:
        return _powers[name]
    steps = np.full(max(n, CHUNK + 1), base, np.uint64)
    steps[0] = 1
    powers = np.cumprod(steps, dtype=np.uint64)
    if len(powers) <= CHUNK + 1:
        _powers[name] = powers
    return powers


def release() -> None:
    """Gives memory that is free back to the system; workers live on between tasks, and each would keep its largest batch."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Running sums of a polynomial over the bytes; ``span_hashes`` takes differences of them."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LETTERS[raw] * _grown("up", _BASE, len(raw) + 1)[: len(raw)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, equal for equal bytes wherever they stand."""
    down = _grown("down", _INVERSE, len(sums))
    length = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + length * np.uint64(_STEP))


@dataclass
class Texts:
    """Consecutive rows of a batch: ``raw`` holds their bytes, text ``i`` is ``raw[bounds[i]:bounds[i + 1]]``."""

    first: int
    raw: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def lower(self) -> "Texts":
        return Texts(self.first, _LOWER[self.raw], self.bounds)


@dataclass
class Words:
    """Byte spans of the words; those of text ``i`` have the numbers ``of[i]`` to ``of[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of) - 1), np.diff(self.of))


def texts(column: pa.Array | pa.ChunkedArray, size: int = CHUNK) -> Iterator[Texts]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, places, data = column.buffers()
    places = np.frombuffer(places, np.int64 if wide else np.int32, len(column) + 1, column.offset * (8 if wide else 4))
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(places, int(places[first]) + size, "right")) - 1)
        last = min(last, first + ROWS, len(column))
        part = column.slice(first, last - first)
        if part.null_count:
            # Nothing says what stands in the bytes of a null.
            yield from (Texts(first + t.first, t.raw, t.bounds) for t in texts(part.fill_null(""), size))
        else:
            bounds = places[first : last + 1].astype(np.int64)
            yield Texts(first, data[bounds[0] : bounds[-1]], bounds - bounds[0])
        first = last
    release()


def words_flags(raw: np.ndarray) -> np.ndarray:
    """Whether each byte is none of white space."""
    return ~_SPACE[raw]


def words(block: Texts, inner: np.ndarray = ~_SPACE) -> Words:
    """Maximal runs of bytes that ``inner`` (256 flags) holds; by default all but white space."""
    inside = inner[block.raw]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = block.bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begin)
    return Words(starts, np.flatnonzero(end) + 1, np.searchsorted(starts, block.bounds))


def word_hashes(block: Texts, found: Words) -> np.ndarray:
    return span_hashes(prefix_sums(block.raw), found.starts, found.ends)


def shingles(hashes: np.ndarray, of: np.ndarray, width: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and where those of each text begin.

    With ``whole`` a text of fewer words, but one at least, gets one hash of its whole sequence.
    """
    counts = np.diff(of)
    runs = np.maximum(counts - width + 1, 0)
    short = (counts > 0) & (runs == 0) if whole else np.zeros(len(counts), bool)
    edge = np.concatenate([[0], np.cumsum(runs + short)])
    steps = stream(2, width + 1)
    out = np.empty(edge[-1], np.uint64)
    at = np.repeat(of[:-1] - edge[:-1], runs + short) + np.arange(edge[-1])
    full = np.repeat(~short, runs + short)
    start = at[full]
    total = np.full(len(start), width, np.uint64) * steps[width]
    for k in range(width):
        total += hashes[start + k] * (steps[k] | np.uint64(1))
    out[full] = mix(total)
    for i in np.flatnonzero(short):
        mine = hashes[of[i] : of[i + 1]]
        total = np.array([len(mine)], np.uint64) * steps[width]
        out[edge[i]] = mix(total + (mine * (steps[: len(mine)] | np.uint64(1))).sum(dtype=np.uint64))[0]
    return out, edge


def distinct(values: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different values of each text."""
    out = [np.unique(values[a:b]) for a, b in zip(edge[:-1], edge[1:])]
    sizes = np.array([len(x) for x in out], np.int64)
    return (np.concatenate(out) if out else values[:0]), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def per_text(kind: np.ufunc, values: np.ndarray, edge: np.ndarray, empty) -> np.ndarray:
    """``kind`` over the values of each text; ``empty`` for a text without any."""
    out = np.full(len(edge) - 1, empty, values.dtype)
    some = np.flatnonzero(np.diff(edge))
    if len(some):
        out[some] = kind.reduceat(values, edge[some])
    return out
