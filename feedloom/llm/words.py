"""Values of the distinct pieces of texts, worked out once and remembered by a worker."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np

#: Bytes of values that a worker keeps from one block to the next at most.
LIMIT = 48 << 20


def ragged(edges: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values of ``rows`` in a flat array that is cut at ``edges``, and the edges of the result."""
    sizes = (edges[1:] - edges[:-1])[rows]
    out = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return np.repeat(edges[:-1][rows] - out[:-1], sizes) + np.arange(out[-1]), out


def cut_table(pairs: np.ndarray) -> np.ndarray:
    """A flat table of 256 x 256 flags: whether to cut between two bytes."""
    return np.ascontiguousarray(pairs, bool).reshape(-1)


def cut_before(raw: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Flags, one more than bytes: whether a piece ends before the byte. Texts' edges always cut."""
    out = np.ones(len(raw) + 1, bool)
    if len(raw) > 1:
        out[1:-1] = table[raw[:-1].astype(np.uint16) << 8 | raw[1:]]
    out[bounds] = True
    return out


def byte_classes() -> np.ndarray:
    """1 letters, 2 digits, 3 other ASCII; 0 what may not be cut off: white space, separators, the apostrophe, and all beyond ASCII."""
    kind = np.zeros(256, np.int8)
    kind[33:127] = 3
    kind[48:58] = 2
    kind[65:91] = kind[97:123] = 1
    kind[39] = 0
    return kind


class Known:
    """Maps 64-bit hashes of byte strings to lists of integers (and a text each), which ``learn`` gives for new strings.

    ``learn`` gives the lists' sizes, all their values in turn, and the texts (or None). Only what is not known yet is learnt. When the
    values pass ``limit`` bytes, those that the present block does not use go; this changes no result.
    """

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, Sequence[str] | None]], kind: type = np.int32, limit: int = LIMIT):
        self.learn, self.limit = learn, limit
        self.keys = np.zeros(0, np.uint64)
        self.edges = np.zeros(1, np.int64)
        self.flat = np.zeros(0, kind)
        self.names = np.zeros(0, object)
        self.weight = 0

    def _keep(self, rows: np.ndarray) -> None:
        at, edges = ragged(self.edges, rows)
        self.keys, self.flat, self.edges, self.names = self.keys[rows], self.flat[at], edges, self.names[rows]
        self.weight = self.flat.nbytes + 24 * len(self.keys) + sum(60 + len(x) for x in self.names if x is not None)

    def __call__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The entry of each span; valid until the next call."""
        keys, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        hit = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        hit[inside] = self.keys[at[inside]] == keys[inside]
        new = first[~hit]
        if len(new):
            if self.weight > self.limit:
                self._keep(at[hit])
            data = raw.tobytes()
            sizes, flat, names = self.learn([data[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            self.keys = np.concatenate([self.keys, keys[~hit]])
            self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(sizes)])
            self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])
            fresh = np.empty(len(sizes), object)
            fresh[:] = names
            self.names = np.concatenate([self.names, fresh])
            self._keep(np.argsort(self.keys, kind="stable"))
        return np.searchsorted(self.keys, keys)[back]


def flattened(lists: list[Sequence[int]], kind: type = np.int32) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and values in turn."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return sizes, np.fromiter(chain.from_iterable(lists), kind, int(sizes.sum()))
