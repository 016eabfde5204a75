"""Hard negatives for anchors, filtered by rotated one-bit codes.

A vector v is turned by a random rotation into o = P v / |v| and kept as one bit
a dimension, the code b = sign(o) / sqrt(d), with its alignment a = <o, b>.  Of a
query q' = P q, <q', b> comes from popcounts of the code with bit planes of q'.
As o = a b + r with r orthogonal to b and |r| = sqrt(1 - a^2), Cauchy-Schwarz
gives, whatever the vectors,

    | <q', o> - a <q', b> |  <=  sqrt(|q'|^2 - <q', b>^2) sqrt(1 - a^2).

The interval widens by how far the planes are from q'.  Only rows whose interval
reaches what an anchor already has are scored, exactly and in whole numbers.

Anchors are dealt into blocks and rows into slices; a task reads a block of
anchors and then streams its slice past them, keeping the best few of each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patternscan.llm.frames import check_columns, saved, shared_folder
from patternscan.llm.knn import products, whole_components

_LEAST = -(1 << 62)


@dataclass(frozen=True)
class MiningParams:
    """``positives`` per anchor and ``negatives`` per positive at most; a negative
    has ``low`` to ``high`` percent of the positive's score.  ``anchors`` are
    held by a task at a time, ``planes`` are the bits of a query's entry."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    anchors: int = 512
    planes: int = 8
    rows: int = 4096
    seed: int = 11


def rotation(width: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, alignments and lengths of vectors; a vector of zeros has alignment 1."""
    o = x.astype(np.float64) @ turn.T
    norm = np.sqrt((o * o).sum(axis=1))
    aligned = np.abs(o).sum(axis=1) / math.sqrt(max(1, o.shape[1]))
    aligned = np.divide(aligned, norm, out=np.ones_like(norm), where=norm > 0)
    return _words(o >= 0), np.minimum(aligned, 1.0), norm


class Asking:
    """Queries, ready to be compared with codes."""

    def __init__(self, v: np.ndarray, turn: np.ndarray, planes: int):
        q = v.astype(np.float64) @ turn.T
        self.width = max(1, q.shape[1])
        self.low = q.min(axis=1, initial=0.0)
        self.step = (q.max(axis=1, initial=0.0) - self.low) / ((1 << planes) - 1)
        level = np.divide(q - self.low[:, None], self.step[:, None], out=np.zeros_like(q), where=self.step[:, None] > 0)
        level = np.clip(np.rint(level), 0, (1 << planes) - 1).astype(np.int64)
        self.planes = [_words((level >> j) & 1 == 1) for j in range(planes)]
        near = self.low[:, None] + self.step[:, None] * level
        self.sum = near.sum(axis=1)
        self.off = np.abs(q - near).sum(axis=1) / math.sqrt(self.width)  # of <q, b>, at most
        self.norm = np.sqrt((q * q).sum(axis=1))

    def interval(self, codes: np.ndarray, aligned: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest inner product of each query with each vector."""
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.float64)
        inner = self.low[:, None] * ones
        for j, plane in enumerate(self.planes):
            met = np.zeros((len(self.low), len(codes)), np.float64)
            for w in range(codes.shape[1]):
                met += np.bitwise_count(plane[:, w, None] & codes[None, :, w])
            inner += (self.step[:, None] * (1 << j)) * met
        inner = (2 * inner - self.sum[:, None]) / math.sqrt(self.width)
        least = np.maximum(np.abs(inner) - self.off[:, None], 0)
        away = np.sqrt(np.maximum((self.norm**2)[:, None] - least**2, 0)) * np.sqrt(np.maximum(1 - aligned**2, 0))
        far = (aligned * self.off[:, None] + away) * norm + 1e-9 * self.norm[:, None] * norm + 0.5
        middle = aligned * inner * norm
        return middle - far, middle + far


def _exact(anchors: np.ndarray, rows: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that may count, in order of anchor and row, and their scores."""
    at, row = np.nonzero(may)
    if len(at) * 8 > may.size:
        return at, row, products(anchors, rows)[at, row]
    score = np.empty(len(at), np.int64)
    most = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, anchors.shape[1])
    if most >= float(1 << 62):
        raise OverflowError("inner products do not fit 64 bits")
    for k in range(0, len(at), 1 << 16):
        score[k : k + (1 << 16)] = np.einsum("ij,ij->i", anchors[at[k : k + (1 << 16)]], rows[row[k : k + (1 << 16)]])
    return at, row, score


class Best:
    """The ``k`` best of each of some lists, ties to the smaller id."""

    def __init__(self, lists: int, k: int):
        self.k, self.lists = k, lists
        self.at, self.id = np.zeros(0, np.int64), np.zeros(0, object)
        self.row, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.floor = np.full(lists, _LEAST, np.int64)

    def add(self, at: np.ndarray, id: np.ndarray, row: np.ndarray, score: np.ndarray) -> None:
        at, row = np.concatenate([self.at, at]), np.concatenate([self.row, row])
        id, score = np.concatenate([self.id, id]), np.concatenate([self.score, score])
        order = np.lexsort((row, pd.factorize(id, sort=True)[0], -score, at))
        first = np.searchsorted(at[order], np.arange(self.lists))
        order = order[np.arange(len(order)) - first[at[order]] < self.k]
        self.at, self.id, self.row, self.score = at[order], id[order], row[order], score[order]
        full = np.flatnonzero(np.bincount(self.at, minlength=self.lists) == self.k)
        last = np.searchsorted(self.at, full, side="right") - 1
        self.floor[full] = self.score[last]


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _units(anchors: DataFrame, rows: DataFrame, count: int, asking: int, p: MiningParams) -> DataFrame:
    """Anchors and rows of each unit (block of anchors, slice of rows), anchors first."""
    blocks, slices = max(1, -(-asking // p.anchors)), max(1, math.ceil(count**0.5 / 75))
    every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    asks = anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).withColumn("slice", every)
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))
    data = rows.withColumn("slice", F.pmod(F.xxhash64("row", F.lit(p.seed)), F.lit(slices)).cast("int"))
    data = data.withColumn("block", every)
    both = asks.withColumn("kind", F.lit(0)).unionByName(data.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    spread = max(1, min(blocks * slices, 4 * int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return both.repartition(spread, "block", "slice").sortWithinPartitions("block", "slice", "kind", "row")


def _streamed(units: DataFrame, start: Callable, step: Callable, end: Callable, schema: str) -> DataFrame:
    """Over each unit: ``start(anchors)`` makes a state, ``step(state, rows)`` sees
    rows batch after batch, ``end(state)`` gives what is found."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, held, state = None, [], None
        for batch in batches:
            for key, part in batch.groupby(["block", "slice"], sort=False):
                if key != unit:
                    if state is not None:
                        yield end(state)
                    unit, held, state = key, [], None
                asks = part[part["kind"] == 0]
                if len(asks):
                    held.append(asks)
                rows = part[part["kind"] == 1]
                if not len(rows) or not held:
                    continue
                if state is None:
                    state = start(pd.concat(held, ignore_index=True))
                step(state, rows)
        if state is not None:
            yield end(state)

    return units.mapInPandas(run, schema)


def mine(
    df: DataFrame,
    anchors: Column,
    params: MiningParams = MiningParams(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    factor: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for each anchor (rows for which ``anchors`` holds) and each
    of its best other rows of the same label, the best rows of another label with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``.

    Scores are inner products of ``floor(factor * x)``; higher ones come first,
    then smaller ids.  Rows with a null id or label, a null vector or null or
    non-finite components take no part; a shorter vector counts as having zeros
    at its end.  A row that is repeated in full counts once; rows that share an
    id are rows of their own, but never partners of each other.  Anchors without
    positives, and positives without negatives, give no rows.
    """
    check_columns(df, id_col, vector_col, label_col)
    p, folder, spark = params, shared_folder(df.sparkSession), df.sparkSession
    rows = df.select(
        F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"),
        whole_components(F.col(vector_col), factor).alias("v"), anchors.alias("asks"),
    ).filter("id is not null and label is not null and v is not null").dropDuplicates(["id", "label", "v"])
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), folder, "vectors")
    width, count = rows.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    width = max(1, width or 0)
    shared = spark.sparkContext.broadcast(rotation(width, p.seed))  # d x d

    @F.pandas_udf("code binary, aligned double, norm double")
    def coded(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in parts:
            code, aligned, norm = encode(_matrix(column, width), shared.value)
            yield pd.DataFrame({"code": [x.tobytes() for x in code], "aligned": aligned, "norm": norm})

    data = rows.select("row", "id", "label", "v", coded("v").alias("_c"))
    data = saved(data.select("row", "id", "label", "v", "_c.*"), folder, "codes")
    asks = rows.filter("asks").select("row", "id", "label", "v")
    asking = asks.count()
    kind = df.schema[id_col].dataType.simpleString()

    def ready(frame: pd.DataFrame) -> dict:
        v = _matrix(frame["v"], width)
        names = pd.Index(frame["label"].unique())
        return {
            "frame": frame, "v": v, "ask": Asking(v, shared.value, p.planes), "names": names,
            "id": frame["id"].to_numpy(object), "label": names.get_indexer(frame["label"]),
        }

    def batches(state: dict, part: pd.DataFrame) -> Iterator[tuple]:
        for k in range(0, len(part), p.rows):
            some = part.iloc[k : k + p.rows]
            code = np.frombuffer(b"".join(some["code"]), "<u8").reshape(len(some), -1)
            low, high = state["ask"].interval(code, some["aligned"].to_numpy(), some["norm"].to_numpy())
            same = state["label"][:, None] == state["names"].get_indexer(some["label"])[None, :]
            yield some, low, high, same

    # the best rows of the anchor's own label
    def first(frame: pd.DataFrame) -> dict:
        return ready(frame) | {"best": Best(len(frame), p.positives)}

    def same_label(state: dict, part: pd.DataFrame) -> None:
        best = state["best"]
        for some, low, high, same in batches(state, part):
            ids = some["id"].to_numpy(object)
            may = same & (state["id"][:, None] != ids[None, :])
            floor = best.floor.astype(np.float64)
            if len(some) > p.positives:  # rows that surely reach a score
                sure = np.partition(np.where(may, low, -np.inf), -p.positives, axis=1)[:, -p.positives]
                floor = np.maximum(floor, sure)
            at, row, score = _exact(state["v"], _matrix(some["v"], width), may & (high >= floor[:, None]))
            best.add(at, ids[row], some["row"].to_numpy()[row], score)

    def positives(state: dict) -> pd.DataFrame:
        best, frame = state["best"], state["frame"]
        return pd.DataFrame({
            "anchor": frame["row"].to_numpy()[best.at], "anchor_id": state["id"][best.at], "row": best.row,
            "id": best.id, "score": best.score,
        })

    schema = f"anchor long, anchor_id {kind}, row long, id {kind}, score long"
    found = _streamed(_units(asks, data, count, asking, p), first, same_label, positives, schema)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    found = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= p.positives)
    found = saved(found, folder, "positives")

    # for each of these, the best rows of other labels between its limits
    lists = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "row", "id", "score"))).alias("have"))
    again = asks.join(lists, asks["row"] == lists["anchor"]).drop("anchor")  # a few places for each anchor

    def second(frame: pd.DataFrame) -> dict:
        have = [(k, h) for k, x in enumerate(frame["have"]) for h in x]
        score = np.array([h["score"] for _, h in have], np.int64)
        return ready(frame) | {
            "have": have, "of": np.array([k for k, _ in have], np.int64), "score": score,
            "best": Best(len(have), p.negatives),
        }

    def between(state: dict, part: pd.DataFrame) -> None:
        best, of, positive = state["best"], state["of"], state["score"]
        for some, low, high, same in batches(state, part):
            ids, numbers = some["id"].to_numpy(object), some["row"].to_numpy()
            # of each place: what a row must be able to reach, and must be able to stay under
            reach = np.maximum(p.low * positive / 100, best.floor.astype(np.float64))
            for k in range(int(np.bincount(of).max(initial=0))):
                place = np.flatnonzero(np.arange(len(of)) - np.searchsorted(of, of) == k)
                at = of[place]
                other = ~same[at] & (state["id"][at][:, None] != ids[None, :])
                may = other & (high[at] >= reach[place][:, None]) & (low[at] <= (p.high * positive[place] / 100)[:, None])
                i, row, score = _exact(state["v"][at], _matrix(some["v"], width), may)
                i = place[i]
                inside = (p.low * positive[i] <= 100 * score) & (100 * score <= p.high * positive[i])
                best.add(i[inside], ids[row[inside]], numbers[row[inside]], score[inside])

    def negatives(state: dict) -> pd.DataFrame:
        best, frame = state["best"], state["frame"]
        have = [state["have"][i] for i in best.at.tolist()]
        at = state["of"][best.at]
        return pd.DataFrame({
            "anchor": frame["row"].to_numpy()[at], "place": [h["place"] for _, h in have],
            "anchor_id": state["id"][at], "positive_id": [h["id"] for _, h in have],
            "positive_score": state["score"][best.at], "row": best.row, "negative_id": best.id, "negative_score": best.score,
        })

    schema = (
        f"anchor long, place int, anchor_id {kind}, positive_id {kind}, positive_score long, row long, "
        f"negative_id {kind}, negative_score long"
    )
    mined = _streamed(_units(again, data, count, asking, p), second, between, negatives, schema)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id", "row")
    ranked = mined.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= p.negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
