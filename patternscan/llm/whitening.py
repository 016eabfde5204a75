"""Whitening of embeddings by shifted CholeskyQR.

The centred rows A (n x d) are never held together.  A Gram pass sums G = Q'Q of
all rows over the cluster; its Cholesky factor R turns Q into Q R^-1, which the
next pass makes on the fly by triangular solves.  The first factors come from
G + sI, so that badly conditioned or dependent columns do not break off; after
two or three passes the columns of Q are orthonormal and A = Q R_k ... R_1.  The
singular values of the composed R (corrected by what is left of G - I) are those
of A, its right vectors the principal components.  Squaring A once, as by an
eigenvalue decomposition of its covariance, would lose half of the digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patternscan.llm.frames import check_columns, saved, shared_folder
from patternscan.llm.knn import whole_components

_UNIT = float(np.finfo(np.float64).eps) / 2


@dataclass(frozen=True)
class WhiteningParams:
    """``components`` at most are kept; entries count as ``floor(factor * c) +
    offset``; ``passes`` bounds the factors; a component whose singular value is
    below ``least`` times the largest is none."""

    components: int = 32
    factor: int = 64
    offset: int = 1_000_000
    passes: int = 4
    least: float = 1e-12


@dataclass(frozen=True)
class Whitening:
    """A fit: ``n`` rows with ``sums`` per dimension; a row of ``components`` is
    a unit vector, ``values`` are the eigenvalues of the covariance, ``total``
    is its trace; ``identity_error`` is measured over the whitened rows."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    total: float
    identity_error: float
    passes: int

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.total if self.total else self.values


def whole_vectors(vector: Column, p: WhiteningParams) -> Column:
    """Entries as whole numbers; null for a vector that takes no part."""
    return F.transform(whole_components(vector, p.factor), lambda x: x + F.lit(p.offset))


def _rows(column: pd.Series, width: int, offset: int) -> np.ndarray:
    """Whole-number rows; a shorter vector counts as having zeros at its end."""
    out = np.full((len(column), width), offset, np.int64)
    for i, x in enumerate(column):
        out[i, : len(x)] = x
    return out


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, with an exact numerator."""
    return (n * x - sums) / n


def divided(a: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``a R_1^-1 ... R_k^-1`` by solving with each upper triangle in turn."""
    for r in factors:
        q = np.empty_like(a)
        for j in range(r.shape[0]):
            q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        a = q
    return a


def _gram(vectors: DataFrame, width: int, offset: int, rows: Callable[[np.ndarray], np.ndarray], k: int) -> np.ndarray:
    """Sum of ``[1, q]' [1, q]`` over all rows ``q = rows(x)`` (k entries each).

    Each task gives one matrix; entries are added over the cluster, so that the
    driver gets (k + 1)^2 numbers whatever the number of tasks.
    """

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros((k + 1, k + 1)), False
        for batch in batches:
            for at in range(0, len(batch), 4096):
                x = _rows(batch["v"].iloc[at : at + 4096], width, offset)
                q = np.concatenate([np.ones((len(x), 1)), rows(x)], axis=1)
                total += q.T @ q
                seen = True
        if seen:
            yield pd.DataFrame({"i": np.arange(k + 1), "g": list(total)})

    entries = vectors.select("v").mapInPandas(part, "i int, g array<double>")
    entries = entries.select("i", F.posexplode("g").alias("j", "g")).groupBy("i", "j").agg(F.sum("g").alias("g"))
    out = np.zeros((k + 1, k + 1))
    for i, j, g in entries.collect():
        out[i, j] = g
    return out


def _factor(g: np.ndarray) -> np.ndarray:
    """The upper Cholesky factor, of a shifted matrix where it needs one."""
    d = len(g)
    low, high = np.linalg.eigvalsh(g)[[0, -1]]
    shift = 0.0 if low > 1e-8 * high else 11 * d * (d + 1) * _UNIT * np.trace(g)
    for _ in range(20):
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, _UNIT * np.trace(g))
    raise ArithmeticError("no Cholesky factor")


def fit(vectors: DataFrame, params: WhiteningParams = WhiteningParams()) -> Whitening:
    """The whitening of all rows of ``vectors`` (``v``, whole numbers).

    Without rows, or where all rows are equal, there is no component.
    """
    p = params
    n, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = width or 0
    sums = np.zeros(width, np.int64)
    found = vectors.select(F.posexplode("v").alias("i", "x")).groupBy("i")
    for i, s, m in found.agg(F.sum("x"), F.count("x")).collect():  # a row for each dimension
        sums[i] = s + (n - m) * p.offset
    none = Whitening(n, sums, np.zeros((0, width)), np.zeros(0), 0.0, 0.0, 0)
    if not n or not width:
        return none

    factors: list[np.ndarray] = []

    def gram() -> np.ndarray:
        made = list(factors)
        return _gram(vectors, width, p.offset, lambda x: divided(centred(x, n, sums), made), width)[1:, 1:]

    g = gram()
    total = float(np.trace(g)) / n
    if total == 0:
        return none
    while len(factors) < p.passes:
        factors.append(_factor(g))
        g = gram()
        if np.abs(g - np.eye(width)).max() < 1e-13:
            break
    composed = np.eye(width)
    for r in factors:
        composed = r @ composed
    left, turn = np.linalg.eigh(g)  # what keeps Q from being orthonormal, such as columns that are none
    _, singular, right = np.linalg.svd((np.sqrt(np.maximum(left, 0))[:, None] * turn.T) @ composed)
    keep = np.flatnonzero(singular > p.least * singular[0])[: p.components]
    components = right[keep]
    largest = np.abs(components).argmax(axis=1)
    components = components * np.where(components[np.arange(len(keep)), largest] < 0, -1.0, 1.0)[:, None]
    values = singular[keep] ** 2 / n
    scale = components.T / np.sqrt(values)
    seen = _gram(vectors, width, p.offset, lambda x: centred(x, n, sums) @ scale, len(keep)) / n
    error = float(np.abs(seen[1:, 1:] - np.outer(seen[0, 1:], seen[0, 1:]) - np.eye(len(keep))).max())
    return Whitening(n, sums, components, values, total, error, len(factors))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """The exact sum over dimensions of ``(n x - S)^2``; an error beyond 64 bits."""
    far = n * x - sums
    if x.shape[1] * float(np.abs(far).max(initial=0)) ** 2 < 2.0**62:
        return (far * far).sum(axis=1).tolist()
    out = [sum(int(v) ** 2 for v in row) for row in far.tolist()]
    if max(out) >= 1 << 63:
        raise OverflowError("a deviation does not fit 64 bits")
    return out


def whiten(
    df: DataFrame,
    params: WhiteningParams = WhiteningParams(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, Whitening]:
    """``<id>, deviation, whitened`` (an array, a number for each component) of
    each row that takes part, and the fit.

    Vectors that are null or hold null or non-finite entries take no part;
    repeated rows count as often as they occur, rows without id like any other;
    a shorter vector counts as having zeros at its end.  Dependent dimensions
    give fewer components; equal rows, one row and empty tables give none, and
    an empty array for each row.
    """
    check_columns(df, id_col, vector_col)
    p = params
    vectors = df.select(F.col(id_col).alias("id"), whole_vectors(F.col(vector_col), p).alias("v"))
    vectors = saved(vectors.filter("v is not null"), shared_folder(df.sparkSession), "vectors")
    model = fit(vectors, p)
    width, n, sums, offset = len(model.sums), model.n, model.sums, p.offset
    scale = model.components.T / np.sqrt(model.values)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _rows(batch["v"], width, offset)
            yield pd.DataFrame(
                {"id": batch["id"], "deviation": deviations(x, n, sums), "whitened": list(centred(x, n, sums) @ scale)}
            )

    kind = df.schema[id_col].dataType.simpleString()
    found = vectors.mapInPandas(project, f"id {kind}, deviation long, whitened array<double>")
    return found.withColumnRenamed("id", id_col), model


def by_component(found: DataFrame, model: Whitening, id_col: str = "vec_id") -> DataFrame:
    """A row for each row and component of :func:`whiten`."""
    explained = F.array(*map(F.lit, model.explained.tolist())) if len(model.values) else F.array(F.lit(0.0))
    rows = found.select(id_col, "deviation", F.posexplode("whitened").alias("i", "whitened"))
    return rows.select(
        id_col,
        (F.col("i") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("i") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
