"""Bounded rules are decided near the text they require.

A match of a rule no wider than ``max_width`` lies within that distance of each
text that it contains.  What is cut out around an occurrence of that text, with
one byte before and ``AFTER`` bytes behind for assertions, tells as much as the
whole text does and is far shorter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patternscan.functions.syntax import LEFTMOST
from patternscan.operators.grams import gram_occurrences
from patternscan.plans.ruleset import MAX_BROADCAST_ROWS

MAX_WIDTH = 512  # bytes; the texts around occurrences of wider rules are no longer short
AFTER = 3  # an end of the data is at most a line end of two bytes away


def is_near() -> Column:
    """Rules of a prepared table that a window decides: over bytes, bounded, and
    without look-around, which leftmost rules may have."""
    bounded = F.coalesce(F.col("max_width") <= MAX_WIDTH, F.lit(False))
    return bounded & ~F.contains("flags", F.lit("8")) & (F.col("kind") != LEFTMOST)


def windows(
    df: DataFrame,
    factors: DataFrame,
    rules: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str],
    max_index_rows: int,
) -> DataFrame:
    """``keys, carry``, the columns of ``rules`` and for each occurrence of one of
    a rule's texts ``_from``, ``_width`` (of that text), ``_window``, ``_lo`` (where
    the window begins) and ``_more`` (whether text follows it).

    ``df`` has the columns ``_raw`` (searched) and ``_bytes`` (cut)."""
    factors = factors.withColumn("_width", F.octet_length("lit"))
    found = gram_occurrences(
        df, factors, keys, "_raw", ["_rid", "_width"], [*carry, "_bytes"], max_index_rows=max_index_rows
    )
    few = rules.count() <= MAX_BROADCAST_ROWS
    found = found.join(F.broadcast(rules) if few else rules, "_rid")
    found = found.withColumn("_lo", F.expr("greatest(0L, _from + _width - max_width - 1)"))
    size = f"CAST(_from + max_width + {AFTER} - _lo AS INT)"
    window = f"decode(substring(_bytes, CAST(_lo + 1 AS INT), {size}), 'ISO-8859-1')"
    more = f"octet_length(_bytes) > _from + max_width + {AFTER}"
    return found.withColumn("_window", F.expr(window)).withColumn("_more", F.expr(more)).drop("_bytes")


def matches_window() -> Column:
    """Does the rule (``forward``) match in its window as it does in the text?
    Where the window is cut, a match may not reach the cut."""
    before = r"CASE WHEN _lo > 0 THEN '(?!\\A)' ELSE '' END"
    after = rf"CASE WHEN _more THEN '(?=[\\s\\S]{{{AFTER}}})' ELSE '' END"
    return F.expr(f"regexp_like(_window, concat({before}, '(?:', forward, ')', {after}))")


def own_ends(end: str) -> str:
    """Is the end (in the window) one of this occurrence's?  Of the occurrences
    that lie before an end, the last one has it: each end is found once."""
    after = "locate(decode(lit, 'ISO-8859-1'), _window, CAST(_from - _lo + 2 AS INT))"
    return (
        f"{end} >= _from - _lo + _width AND {end} <= _from - _lo + max_width"
        f" AND ({after} = 0 OR {end} < {after} - 1 + _width)"
    )
