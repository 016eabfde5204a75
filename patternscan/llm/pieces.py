"""A bounded memory of token ids by piece, shared by the tokenizing operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from patternscan.llm.textops import prefix_hashes, ragged, span_hashes

#: What an entry of the memory takes beside its characters and ids, about.
_ENTRY_BYTES = 160


class PieceCache:
    """Ids of pieces that a worker has met, by the piece itself.

    Hashes only bring equal pieces of a call together; every piece is compared
    with the one that stands for it, so a collision costs time and no result.
    The memory saves work: beyond about ``limit`` bytes it starts anew.
    """

    def __init__(self, limit: int = 64 << 20):
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.first = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.used = 0
        self.held = 0

    def _grown(self, have: np.ndarray, size: int) -> np.ndarray:
        if size <= len(have):
            return have
        more = np.zeros(max(size, 2 * len(have)), have.dtype)
        more[: len(have)] = have
        return more

    def _add(self, pieces: Sequence[str], ids: Sequence[Sequence[int]]) -> None:
        n, lengths = len(self.index), np.array([len(x) for x in ids], np.int64)
        self.flat = self._grown(self.flat, self.used + int(lengths.sum()))
        self.first = self._grown(self.first, n + len(ids))
        self.length = self._grown(self.length, n + len(ids))
        self.length[n : n + len(ids)] = lengths
        self.first[n : n + len(ids)] = self.used + np.cumsum(lengths) - lengths
        end = self.used + int(lengths.sum())
        self.flat[self.used : end] = np.fromiter((i for x in ids for i in x), np.uint32, end - self.used)
        self.used = end
        self.held += sum(map(len, pieces)) + 4 * int(lengths.sum()) + _ENTRY_BYTES * len(pieces)
        self.index.update(zip(pieces, range(n, n + len(ids))))

    def ids(
        self,
        points: np.ndarray,
        first: np.ndarray,
        end: np.ndarray,
        make: Callable[[list[str]], Sequence[Sequence[int]]],
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces ``points[first:end]`` in order, and how many
        each piece has.  ``make`` gets pieces not known yet and returns their ids.
        """
        if not len(first):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        size = end - first
        _, where, inverse = np.unique(
            span_hashes(prefix_hashes(points), first, end), return_index=True, return_inverse=True
        )
        odd = unlike(points, first, size, where[inverse])
        inverse[odd] = len(where) + np.arange(len(odd))
        where = np.concatenate([where, odd])
        text = points.astype("<u4", copy=False).tobytes().decode("utf-32-le", "surrogatepass")
        pieces = [text[a:b] for a, b in zip(first[where].tolist(), end[where].tolist())]
        if self.held > self.limit:
            self._clear()
        new = list(dict.fromkeys(x for x in pieces if x not in self.index))
        if new:
            self._add(new, make(new))
        at = np.fromiter((self.index[x] for x in pieces), np.int64, len(pieces))[inverse]
        lengths = self.length[at]
        return ragged(self.flat, self.first[at], lengths), lengths


def unlike(points: np.ndarray, first: np.ndarray, size: np.ndarray, rep: np.ndarray) -> np.ndarray:
    """Pieces that are not equal, character by character, to the piece ``rep``."""
    bad = size != size[rep]
    check = np.flatnonzero(~bad & (rep != np.arange(len(rep))))
    if len(check):
        own, other = ragged(points, first[check], size[check]), ragged(points, first[rep[check]], size[check])
        wrong = np.flatnonzero(own != other)
        if len(wrong):
            bad[check[np.searchsorted(np.cumsum(size[check]), wrong, side="right")]] = True
    return np.flatnonzero(bad)
