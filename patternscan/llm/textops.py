"""Texts as arrays of code points or bytes, for work inside Arrow batches.

A chunk of texts is one array with the start of each text, so that a step is a
few passes over the array instead of a loop over words.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np

CHUNK_CHARS = 1 << 20
CHUNK_ROWS = 256

_ODD = 0x9E3779B97F4A7C15
_BASE = 0xD1342543DE82EF95
_POWERS: dict[str, np.ndarray] = {}
_TABLES: dict[str, np.ndarray] = {}


def chunks(texts: Sequence[str], chars: int = CHUNK_CHARS, rows: int = CHUNK_ROWS) -> Iterator[range]:
    """Ranges of rows with so many characters or rows at most, or one text."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and (size + len(text) > chars or i - first >= rows):
            yield range(first, i)
            first, size = i, 0
        size += len(text)
    if len(texts):
        yield range(first, len(texts))


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, and where each text starts (one more at the end)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return points, starts


def utf8_bytes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in UTF-8, and where each text starts."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=starts[1:])
    return np.frombuffer(b"".join(raw), np.uint8), starts


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(name: str, base: int, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        made = np.full(max(n, CHUNK_CHARS + 1), base, np.uint64)
        made[0] = 1
        have = np.multiply.accumulate(made)
        if n <= 4 * CHUNK_CHARS:
            _POWERS[name] = have
    return have[:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Running hash of the array: the hash of any span follows from two entries."""
    out = np.zeros(len(values) + 1, np.uint64)
    x = values.astype(np.uint64)
    x += np.uint64(1)
    x *= np.uint64(_ODD)
    x ^= x >> np.uint64(29)
    x *= _powers("base", _BASE, len(values))
    np.cumsum(x, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans; equal content gives equal hashes anywhere."""
    inverse = _powers("inverse", pow(_BASE, -1, 1 << 64), len(prefix))
    x = (prefix[end] - prefix[first]) * inverse[first]
    return mix(x ^ ((end - first).astype(np.uint64) * np.uint64(_ODD)))


def char_table(name: str, points: np.ndarray) -> np.ndarray:
    """A value for each code point up to the largest one given.

    ``fold``: a letter in lower case, a space for all else.  ``kind``: 1 letter,
    2 number, 3 white space, 0 all else.  ``shape``: 1 upper case, 2 other
    letter, 3 digit, 4 white space, 0 all else.
    """
    top = int(points.max()) + 1 if len(points) else 1
    have = _TABLES.get(name)
    if have is None or len(have) < top:
        size = 0x300 if top <= 0x300 else 0x10000 if top <= 0x10000 else 0x110000
        have = _TABLES[name] = np.array([_ENTRY[name](chr(i)) for i in range(size)], np.uint32)
    return have


def _fold(c: str) -> int:
    if not c.isalpha():
        return 32
    low = c.lower()
    return ord(low) if len(low) == 1 else ord(c)


def is_space(c: str) -> bool:
    """White space as Unicode has it (unlike str.isspace, without U+001C to U+001F)."""
    return c.isspace() and not "\x1c" <= c <= "\x1f"


def _kind(c: str) -> int:
    major = unicodedata.category(c)[0]
    return 3 if is_space(c) else 1 if major == "L" else 2 if major == "N" else 0


def _shape(c: str) -> int:
    if c.isalpha():
        return 1 if c.isupper() else 2
    return 3 if c.isdigit() else 4 if is_space(c) else 0


_ENTRY = {"fold": _fold, "kind": _kind, "shape": _shape}


def words(data: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs inside texts where ``inside`` holds: first, end, index of the text."""
    edge = np.zeros(len(data) + 1, bool)
    if len(data):
        edge[0] = edge[-1] = True
        edge[1:-1] = inside[1:] != inside[:-1]
    edge[starts] = True
    cuts = np.flatnonzero(edge)
    if not len(data):
        cuts = cuts[:0]
    first, end = cuts[:-1], cuts[1:]
    keep = inside[first] if len(first) else np.zeros(0, bool)
    first, end = first[keep], end[keep]
    return first, end, np.searchsorted(starts, first, side="right") - 1


def ragged(values: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``values[first:first + length]``, one after the other."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(lengths)
    at = np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(first, lengths)
    return values[at]
