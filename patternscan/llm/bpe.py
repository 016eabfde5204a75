"""Byte-level BPE: encoding and decoding with a given table of ranks.

A text is cut into pieces, and the bytes of a piece are merged pair by pair,
always the leftmost pair of least rank.  A segment tree over the byte positions
holds that pair at its root; a merge changes the ranks of the two live
neighbours and removes one position, each a point update of logarithmic cost,
so that even a piece of a million bytes takes n log n steps.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patternscan.llm.frames import check_columns
from patternscan.llm.pieces import PieceCache
from patternscan.llm.textops import char_table, chunks, code_points, ragged

_NONE = 1 << 62


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Ranks from a file of lines ``base64 rank``, read by the driver.

    The file is a vocabulary, some 50,000 lines; its size is checked.
    """
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    if len(ranks) > 1 << 20:
        raise ValueError(f"{len(ranks)} ranks are too many to send to every worker")
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"{len(missing)} single bytes have no rank")
    return ranks


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n < 2:
        return [ranks[piece[i : i + 1]] for i in range(n)]
    size = 1 << (n - 1).bit_length()
    end = list(range(1, n + 1))  # of the token that begins at a position
    prev = list(range(-1, n - 1))
    tree = [_NONE] * (2 * size)  # rank * 2**32 + position: the least is the leftmost of least rank
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = (rank << 32) | i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b

    def put(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            least = a if a < b else b
            if tree[k] == least:
                return  # nothing above changes
            tree[k] = least
            k >>= 1

    def key(i: int) -> int:
        j = end[i]
        if j >= n:
            return _NONE
        rank = ranks.get(piece[i : end[j]])
        return _NONE if rank is None else (rank << 32) | i

    while tree[1] != _NONE:
        i = tree[1] & 0xFFFFFFFF
        j = end[i]
        end[i] = end[j]
        if end[i] < n:
            prev[end[i]] = i
        put(j, _NONE)
        put(i, key(i))
        if prev[i] >= 0:
            put(prev[i], key(prev[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def split_pieces(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts begin, and the length of all at the end.

    Pieces are those of the public pattern of byte-level BPE: contractions
    ``'s 't 're 've 'm 'll 'd``; runs of letters, of numbers or of all else with
    one space before; white space, of which the last character before other
    text is a piece of its own, or its space.
    """
    n = len(points)
    if not n:
        return np.zeros(1, np.int64)
    kind = char_table("kind", points)[points]
    edge = np.ones(n + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    text_start = np.zeros(n + 1, bool)
    text_start[starts] = True
    edge |= text_start
    last_space = np.zeros(n, bool)
    last_space[:-1] = (kind[:-1] == 3) & (kind[1:] != 3) & ~text_start[1:-1]
    edge[:-1] |= last_space
    edge[1:] &= ~(last_space & (points == 32))
    i = np.flatnonzero((points[:-1] == 39) & edge[:-2] & edge[1:-1] & (kind[1:] == 1) & ~text_start[1:-1])
    if len(i):
        a = points[i + 1]
        b = np.where((i + 2 < n) & ~text_start[np.minimum(i + 2, n)], points[np.minimum(i + 2, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        edge[i[one | two] + 1] = False
        edge[i[one] + 2] = True
        edge[i[two & ~one] + 3] = True
    return np.flatnonzero(edge)


class ByteBpe:
    """An encoder and decoder for a table of ranks, which workers share."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self._cache: PieceCache | None = None
        self._bytes: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def __getstate__(self):
        return {"ranks": self.ranks}

    def __setstate__(self, state):
        self.__init__(state["ranks"])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if self._cache is None:
            self._cache = PieceCache()
        out: list[np.ndarray] = []
        for part in chunks(texts, chars=1 << 19, rows=1 << 14):
            own = [texts[i] for i in part]
            points, starts = code_points(own)
            cuts = split_pieces(points, starts)
            first, end = cuts[:-1], cuts[1:]
            ids, lengths = self._cache.ids(points, first, end, self._merged)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            out += np.split(ids, ends[np.searchsorted(first, starts[1:-1])])
        return out

    def _merged(self, pieces: list[str]) -> list[list[int]]:
        return [merge(p.encode(), self.ranks) for p in pieces]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each sequence of ids; an id without a rank is an error."""
        if self._bytes is None:
            known = {rank: piece for piece, rank in self.ranks.items()}
            pieces = [known.get(i, b"") for i in range(max(known) + 1)]
            length = np.array([len(p) for p in pieces], np.int64)
            self._bytes = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(length) - length, length
        flat, first, length = self._bytes
        out = []
        for x in ids:
            if len(x) and (int(x.max()) >= len(length) or not length[x].all()):
                raise ValueError("an id is not in the table of ranks")
            out.append(ragged(flat, first[x], length[x]).tobytes())
        return out


def encode_column(spark: SparkSession, bpe: ByteBpe, text: Column) -> Column:
    """Ids of a text column as little-endian unsigned 32-bit integers.

    A null or empty text has no ids.
    """
    shared = spark.sparkContext.broadcast(bpe)

    @F.pandas_udf("binary")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            whole = ["" if t is None else t for t in texts]
            yield pd.Series([x.astype("<u4").tobytes() for x in shared.value.encode(whole)], dtype=object)

    return encode(text.cast("string"))


def decode_column(spark: SparkSession, bpe: ByteBpe, ids: Column) -> Column:
    """The bytes that ids in the form of :func:`encode_column` stand for."""
    shared = spark.sparkContext.broadcast(bpe)

    @F.pandas_udf("binary")
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in parts:
            found = [np.frombuffer(b"" if x is None else x, "<u4") for x in column]
            yield pd.Series(shared.value.decode(found), dtype=object)

    return decode(ids)


def round_trip(docs: DataFrame, bpe: ByteBpe, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, ids, decoded`` for each row: the ids of the whole text and what
    they decode to.  Every row gives one row, repeated ones too; a null or empty
    text has no ids and decodes to no bytes.

    One worker a task does both, so that ranks and tables are held once."""
    check_columns(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    @F.pandas_udf("ids binary, decoded binary")
    def both(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            whole = ["" if t is None else t for t in texts]
            ids, decoded = [], []
            for part in chunks(whole, rows=1 << 14):
                found = shared.value.encode([whole[i] for i in part])
                ids += [x.astype("<u4").tobytes() for x in found]
                decoded += shared.value.decode(found)
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(decoded, dtype=object)})

    coded = docs.select(id_col, both(F.col(text_col).cast("string")).alias("_coded"))
    return coded.select(id_col, "_coded.ids", "_coded.decoded")


def digests(coded: DataFrame) -> DataFrame:
    """Counts and checksums of what :func:`round_trip` returns."""
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
