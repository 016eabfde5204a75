"""Exact search for the k largest inner products, as a Voronoi join.

Every vector belongs to the cell of its nearest pivot.  A cell is summed up by
the largest distance r from its pivot p, so that no member x scores more than
``<q, p> + |q| r`` with a query q.  Each query is first answered inside its own
cell, which gives a score it will not fall below; it then goes only to cells
that could hold more.  Cells and query lists are dealt into blocks of bounded
size, so a frequent vector fills many blocks and no task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patternscan.llm.frames import check_columns, saved, shared_folder

_EXACT = float(1 << 53)


@dataclass(frozen=True)
class SearchParams:
    """``pivots`` bounds the sample that the driver holds and workers get;
    ``block`` and ``asking`` the data and query vectors that a task holds."""

    k: int = 5
    pivots: int = 128
    block: int = 4096
    asking: int = 1024


def whole_components(vector: Column, factor: int = 256) -> Column:
    """``floor(factor * x)`` of each component; null for a vector that is null
    or holds a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(factor * x.cast("double"))))


def _matrix(rows: list, width: int) -> np.ndarray:
    """Whole-number vectors as rows; shorter ones have zeros at the end."""
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exact: in floating point where that is, else
    in whole numbers, else an error."""
    a = float(np.abs(left).max(initial=0)) if left.size else 0.0
    b = float(np.abs(right).max(initial=0)) if right.size else 0.0
    most = a * b * max(1, left.shape[1])
    if most < _EXACT:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    if most >= float(1 << 62):
        raise OverflowError("inner products do not fit 64 bits")
    return left @ right.T


def _cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``id, v, cell, far, norm``: the nearest pivot, the distance from it, the length."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots.astype(np.float64))

    @F.pandas_udf("cell int, far double, norm double")
    def place(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = shared.value
        for column in parts:
            cell, far, norm = [], [], []
            for k in range(0, len(column), 2048):
                x = _matrix(column.iloc[k : k + 2048].tolist(), p.shape[1]).astype(np.float64)
                near = ((p * p).sum(axis=1) - 2 * (x @ p.T)).argmin(axis=1)
                cell.append(near)
                far.append(np.sqrt(((x - p[near]) ** 2).sum(axis=1)))
                norm.append(np.sqrt((x * x).sum(axis=1)))
            yield pd.DataFrame({"cell": np.concatenate(cell), "far": np.concatenate(far), "norm": np.concatenate(norm)})

    return vectors.select("id", "v", place("v").alias("_p")).select("id", "v", "_p.*")


def _solve(asking: DataFrame, data: DataFrame, width: int, p: SearchParams) -> DataFrame:
    """``query_id, id, score``: of each query list and data block that share
    ``cell, block, list``, each query's k best that reach its ``floor``."""

    def local(key, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(block):
            block = block.sort_values("id", kind="stable")
            ids = block["id"].to_numpy()
            scores = products(
                _matrix(queries["v"].tolist(), width), _matrix(block["v"].tolist(), width)
            )
            for row, (own, floor) in enumerate(zip(queries["query_id"], queries["floor"])):
                s = scores[row]
                at = np.flatnonzero((s >= floor) & (ids != own))
                at = at[np.argsort(-s[at], kind="stable")[: p.k]]
                found += [(own, ids[j], int(s[j])) for j in at]
        return pd.DataFrame(found, columns=["query_id", "id", "score"])

    key = ["cell", "block", "list"]
    kind = data.schema["id"].dataType.simpleString()
    # both sides come from one table: the alias tells the two vectors apart
    named = asking.select("query_id", F.col("v").alias("v"), "floor", *(F.col(c).alias(f"q_{c}") for c in key))
    return named.groupBy(*(f"q_{c}" for c in key)).cogroup(data.groupBy(*key)).applyInPandas(
        local, f"query_id {kind}, id {kind}, score long"
    )


def _join(asking: DataFrame, data: DataFrame, blocks: DataFrame, width: int, p: SearchParams) -> DataFrame:
    """Solve queries (``query_id, v, floor, cell, block``) against the blocks named."""
    lists = asking.groupBy("cell", "block").agg(F.ceil(F.count(F.lit(1)) / p.asking).cast("int").alias("lists"))
    asked = asking.join(lists, ["cell", "block"]).withColumn(
        "list", F.pmod(F.xxhash64("query_id"), F.col("lists")).cast("int")
    )
    held = data.join(lists, ["cell", "block"]).withColumn(
        "list", F.explode(F.sequence(F.lit(0), F.col("lists") - 1))
    )
    return _solve(
        asked.select("query_id", "v", "floor", "cell", "block", "list"),
        held.select("id", "v", "cell", "block", "list"),
        width,
        p,
    )


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def top_inner_products(
    df: DataFrame,
    queries: Column,
    params: SearchParams = SearchParams(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    factor: int = 256,
) -> DataFrame:
    """``query_id, rank, <id>, score``: the k largest inner products of each query.

    ``queries`` says which rows ask; candidates are all rows but those with the
    query's own id.  Components count as ``floor(factor * x)``.  Vectors that are
    null or hold null or non-finite components take no part, nor do rows without
    id; a shorter vector counts as having zeros at its end, an empty one scores 0.
    A row that is repeated in full counts once.  With fewer candidates than k all
    are returned, without queries or candidates nothing.
    """
    check_columns(df, id_col, vector_col)
    p, folder = params, shared_folder(df.sparkSession)
    vectors = df.select(
        F.col(id_col).alias("id"), whole_components(F.col(vector_col), factor).alias("v"), queries.alias("asks")
    ).filter("id is not null and v is not null")
    vectors = saved(vectors.dropDuplicates(["id", "v"]), folder, "vectors")
    width, count = vectors.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    width = max(1, width or 0)
    cells = min(p.pivots, max(1, int(count**0.5 / 2)))
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(cells).select("v").collect()
    pivots = np.unique(_matrix([r.v for r in sample] or [[]], width), axis=0)

    placed = saved(_cells(vectors.select("id", "v"), pivots), folder, "cells")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / p.block).cast("int").alias("blocks"))
    data = placed.join(F.broadcast(sizes), "cell").withColumn(  # a row for each pivot at most
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    asking = vectors.filter("asks").select("id").distinct().join(placed, "id")
    asking = asking.select(F.col("id").alias("query_id"), "v", "cell", "norm")

    blocks = data.groupBy("cell", "block").agg(F.max("far").alias("far"))
    home = asking.join(blocks.select("cell", "block"), "cell").withColumn("floor", F.lit(-(1 << 62)))
    inside = saved(best(_join(home, data, blocks, width, p), p.k), folder, "inside")
    floors = inside.filter(F.col("rank") == p.k).select("query_id", F.col("score").alias("floor"))

    # each query with every cell: as many rows as pivots, cut down to cells worth a visit
    centre = df.sparkSession.sparkContext.broadcast(pivots.astype(np.float64))

    @F.pandas_udf("array<double>")
    def toward(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in parts:
            x = _matrix(column.tolist(), centre.value.shape[1]).astype(np.float64)
            yield pd.Series(list(x @ centre.value.T), dtype=object)

    bounded = asking.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-(1 << 62))))
    bounded = bounded.withColumn("toward", toward("v")).select(
        "query_id", "v", "norm", "floor", F.col("cell").alias("home"), F.posexplode("toward").alias("cell", "toward")
    )
    slack = 1e-6 * (F.abs("toward") + F.col("norm") * F.col("far") + 1)  # of the rounding of distances
    visits = bounded.join(blocks, "cell").filter(
        (F.col("cell") != F.col("home")) & (F.col("toward") + F.col("norm") * F.col("far") + slack >= F.col("floor"))
    )
    outside = _join(visits.select("query_id", "v", "floor", "cell", "block"), data, blocks, width, p)
    result = best(inside.select("query_id", "id", "score").unionByName(outside), p.k)
    return result.withColumnRenamed("id", id_col)
