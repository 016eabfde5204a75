"""Numbering rows by an order column that may be sparse or skewed.

Blocks are cut where equal shares of the rows lie, not where the order column
has round values: packet numbers of one flow are as sparse as traffic likes, and
a flow may own a third of all packets.  No task gets more than a block, however
the keys are spread.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patternscan.functions.views import column_name, keep, let
from patternscan.streaming.chunks import running_totals

BLOCK_ROWS = 1 << 16
MAX_BLOCKS = 4096


def order_bounds(df: DataFrame, order: str, rows: int = BLOCK_ROWS) -> list[int]:
    """Values of ``order`` that cut the table into blocks of about ``rows`` rows.

    Reads that column alone.  The driver gets ``MAX_BLOCKS`` numbers at most; a
    table of more blocks than that has larger ones.
    """
    placed = df.select(F.col(order).cast("long").alias("_at")).filter("_at IS NOT NULL")
    blocks = min(MAX_BLOCKS, -(-placed.count() // rows))
    if blocks < 2:
        return []
    shares = [i / blocks for i in range(1, blocks)]
    cuts = placed.agg(F.percentile_approx("_at", shares, max(10000, 4 * blocks))).first()[0]
    return sorted(set(cuts))


def block_of(order: str, bounds: Sequence[int]) -> Column:
    """The number of bounds at or below the order value: first among the heads of
    groups of bounds, then within one group."""
    if not bounds:
        return F.lit(0)
    width = isqrt(len(bounds)) + 1
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]

    def numbers(values):
        return f"array({', '.join(f'{v}L' for v in values)})"

    at = f"CAST({column_name(order)} AS BIGINT)"
    heads = numbers([g[0] for g in groups])
    listed = f"array({', '.join(map(numbers, groups))})"

    def within(group):
        below = keep(f"element_at({listed}, {group})", lambda b: f"{b} <= {at}")
        return f"CASE WHEN {group} = 0 THEN 0 ELSE ({group} - 1) * {width} + size({below}) END"

    return F.expr(let(f"size({keep(heads, lambda b: f'{b} <= {at}')})", within))


def dense_order(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    name: str,
    bounds: Sequence[int] | None = None,
) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... by ``order`` within each key.

    ``bounds`` are those of a table whose order values include these.  Rows
    without order value come first; equal ones in any order.
    """
    if bounds is None:
        bounds = order_bounds(df, order)
    block = F.coalesce(block_of(order, bounds), F.lit(-1))
    return running_totals(df, keys, order, {name: F.lit(1)}, block=block)
