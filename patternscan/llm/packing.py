"""Packing of documents into sequences of bounded length.

Texts become ids, ids are cut into pieces of one sequence at most, and pieces go
into sequences first-fit decreasing: the longest first, each into the first
sequence with room.  A tournament tree over the free room of the open sequences
finds that one in logarithmic time.  Pieces are dealt into groups at random and
each group is packed on its own, so that no task sees more than a group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from patternscan.llm.frames import check_columns, saved, shared_folder
from patternscan.llm.pieces import PieceCache
from patternscan.llm.textops import char_table, chunks, code_points

PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


@dataclass(frozen=True)
class PackingParams:
    """``group_pieces`` is the number of pieces that one group has on average."""

    capacity: int = 4096
    end_id: int = 2
    group_pieces: int = 4096
    seed: int = 7


class WordTokenizer:
    """Ids of whole texts by a tokenizer file whose pieces end with ``</w>``.

    Texts of code points below U+0300 are cut into the tokenizer's own pieces
    here (lower case, without white space; contractions, letters, single digits,
    all else), and each different piece is tokenized once.  Composition to NFC
    changes nothing below U+0300, so the ids are the same; all other texts go
    through the tokenizer whole.
    """

    simple = 0x300
    batch = 400

    def __init__(self, definition: str):
        self.definition = definition
        self._tokenizer = None

    def __getstate__(self):
        return {"definition": self.definition}

    def __setstate__(self, state):
        self.__init__(state["definition"])

    @classmethod
    def from_file(cls, path: str) -> WordTokenizer:
        """Read by the driver; workers get the text, so that they need no file."""
        with open(path, encoding="utf-8") as f:
            definition = f.read(1 << 26)
            if f.read(1):
                raise ValueError(f"{path} is too large to send to every worker")
        return cls(definition)

    def _load(self) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(self.definition)
        self._tokenizer.encode_special_tokens = True  # their names in a text are text
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self._cache = PieceCache()
        lower = [c.lower() for c in map(chr, range(self.simple))]
        self._lower = np.array([ord(c) if len(c) == 1 else 0 for c in lower], np.uint32)

    def _each(self, pieces: list[str]) -> list[list[int]]:
        """Ids of single pieces; many go through the tokenizer at once."""
        out: list[list[int]] = []
        for k in range(0, len(pieces), self.batch):
            some = pieces[k : k + self.batch]
            ids = np.array(self._tokenizer.encode(" ".join(some), add_special_tokens=False).ids, np.int64)
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) == len(some) and (not len(ids) or ends[-1] == len(ids)):
                out += [x.tolist() for x in np.split(ids, ends[:-1])]
            else:
                out += [self._tokenizer.encode(x, add_special_tokens=False).ids for x in some]
        return out

    def _cuts(self, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end of each piece of simple texts in lower case."""
        n = len(points)
        kind = char_table("kind", points)[points]
        edge = np.ones(n + 1, bool)
        edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        edge[starts] = True
        i = np.flatnonzero((points == 39) & edge[:-1])
        i = i[(i + 1 < n) & edge[np.minimum(i + 1, n)]]
        a = points[i + 1]
        inside = (i + 2 < n) & ~edge[np.minimum(i + 2, n)]
        b = np.where(inside, points[np.minimum(i + 2, n - 1)], 0)
        same = ~np.isin(i + 1, starts)
        one = same & np.isin(a, [ord(c) for c in "stmd"])
        two = same & (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
        edge[i[one | two] + 1] = False
        edge[i[one] + 2] = True
        edge[i[two] + 3] = True
        cuts = np.flatnonzero(edge)
        solid = kind[cuts[:-1]] != 3
        return cuts[:-1][solid], cuts[1:][solid]

    def _simple(self, texts: list[str]) -> list[np.ndarray]:
        points, starts = code_points(texts)
        if not len(points):
            return [np.zeros(0, np.uint32)] * len(texts)
        points = self._lower[points]
        first, end = self._cuts(points, starts)
        ids, lengths = self._cache.ids(points, first, end, self._each)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return np.split(ids, ends[np.searchsorted(first, starts[1:-1])])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self._tokenizer is None:
            self._load()
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        plain = [k for k, t in enumerate(texts) if "İ" not in t and (t.isascii() or max(t) < chr(self.simple))]
        for k in set(range(len(texts))) - set(plain):
            out[k] = np.array(self._tokenizer.encode(texts[k], add_special_tokens=False).ids, np.uint32)
        own = [texts[k] for k in plain]
        for part in chunks(own, chars=1 << 19, rows=1 << 14):
            for k, ids in zip(part, self._simple([own[i] for i in part])):
                out[plain[k]] = ids
        return out


def cut_pieces(
    docs: DataFrame,
    tokenizer: WordTokenizer,
    params: PackingParams = PackingParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``<id>, start, length, ids_crc32, doc_tokens`` (and ``ids``, little-endian
    unsigned 32-bit integers) for each piece.

    A row's ids are those of its whole text and then ``end_id``; they are cut
    every ``capacity`` ids.  A null or empty text has the end id alone.  Every
    row counts, repeated ones and ones without id too.
    """
    check_columns(docs, id_col, text_col)
    p = params
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    fields = PIECE + (", ids binary" if with_ids else "")
    names = [f.name for f in StructType.fromDDL(fields)]

    @F.pandas_udf(ArrayType(StructType.fromDDL(fields)))
    def cut(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in column:
            out = []
            for ids in shared.value.encode(["" if t is None else t for t in batch]):
                ids = np.append(ids, p.end_id).astype("<u4")
                raw = [ids[k : k + p.capacity].tobytes() for k in range(0, len(ids), p.capacity)]
                rows = [(p.capacity * k, len(r) // 4, zlib.crc32(r), len(ids), r) for k, r in enumerate(raw)]
                out.append([dict(zip(names, row)) for row in rows])
            yield pd.Series(out, dtype=object)

    cuts = cut(F.col(text_col).cast("string"))
    return docs.select(id_col, F.explode(cuts).alias("_piece")).select(id_col, "_piece.*")


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset there of each piece.

    Pieces go in falling length, equal ones in the order given.
    """
    n = len(lengths)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    size = 1 << max(0, n - 1).bit_length()
    tree = [capacity] * (2 * size)  # most free room below each node; leaves are sequences
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        node = 1
        while node < size:
            node *= 2
            if tree[node] < need:
                node += 1
        sequence[k], offset[k] = node - size, capacity - tree[node]
        tree[node] -= need
        node >>= 1
        while node:
            most = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == most:
                break
            tree[node] = most
            node >>= 1
    return sequence, offset


def pack(pieces: DataFrame, params: PackingParams = PackingParams()) -> DataFrame:
    """The pieces with ``sequence_id, offset, sequence_tokens``.

    ``pieces`` should be read from a table that is written (see
    :func:`pack_documents`): rows are dealt into groups by a hash of where they
    stand there, which a lost executor does not change and which spreads
    repeated rows too.  Sequences are numbered within their group; the group is
    the upper half of ``sequence_id``.  Without pieces there is no sequence.
    """
    check_columns(pieces, "length")
    p = params
    groups = max(1, -(-pieces.count() // p.group_pieces))
    dealt = pieces.withColumn("_place", F.monotonically_increasing_id()).withColumn(
        "_group", F.pmod(F.xxhash64("_place", F.lit(p.seed)), F.lit(groups))
    )

    def one_group(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_place", kind="stable")
        group = int(frame["_group"].iloc[0])
        sequence, offset = first_fit_decreasing(frame["length"].to_numpy(), p.capacity)
        filled = np.bincount(sequence, weights=frame["length"].to_numpy()).astype(np.int64)
        return frame.drop(columns=["_place", "_group"]).assign(
            sequence_id=(group << 32) + sequence, offset=offset, sequence_tokens=filled[sequence]
        )

    schema = StructType(list(pieces.schema.fields))
    for name in ("sequence_id", "offset", "sequence_tokens"):
        schema.add(name, "long")
    return dealt.groupBy("_group").applyInPandas(one_group, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: WordTokenizer,
    params: PackingParams = PackingParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with the sequence each lies in.

    The pieces are written into the shared folder first, so that texts are
    tokenized once whatever is lost later.  A sequence holds ``capacity`` ids at
    most, without gaps; it is padded to that length by who writes it out, unless
    its length is a power of two.
    """
    cut = cut_pieces(docs, tokenizer, params, id_col, text_col, with_ids)
    return pack(saved(cut, shared_folder(docs.sparkSession), "pieces"), params)
