"""One scan that honours everything a rule set says."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patternscan.functions.syntax import LITERAL, Rule, RuleError
from patternscan.operators.approx import scan_edit_distance, scan_hamming_distance
from patternscan.operators.events import combination_formulas, combine_rules, drop_quiet
from patternscan.operators.scan import scan_exact

DISTANCES = {"edit_distance": scan_edit_distance, "hamming_distance": scan_hamming_distance}


def scan_rule_set(
    df: DataFrame, rules, text: str = "text", keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The events of a list or table of rules: exact rules by ``scan_events``,
    literals with a distance by the approximate scans, formulas (``C``) over the
    events of both, and none of quiet rules (``Q``).

    An approximate rule that is no literal is an error.
    """
    keys = list(keys)
    if isinstance(rules, DataFrame):
        parts = _of_table(df, rules, text, keys)
    else:
        parts = _of_list(df, rules, text, keys)
    if not parts:
        raise RuleError("no rules")
    events = reduce(DataFrame.unionByName, parts)
    formulas = combination_formulas(rules)
    if formulas:
        blocks = df.filter(F.col(text).isNotNull()).select(
            *keys, F.octet_length(text).cast("bigint").alias("n_bytes")
        )
        events = events.unionByName(combine_rules(events, formulas, keys, blocks))
    return drop_quiet(events, rules)


def _of_list(df, rules: Sequence[Rule], text, keys) -> list[DataFrame]:
    parts, plain = [], [r for r in rules if "C" not in r.flags]
    for distance, scan in DISTANCES.items():
        near = [r for r in plain if r.ext.get(distance)]
        plain = [r for r in plain if r not in near]
        for r in near:
            if r.kind != LITERAL:
                raise RuleError(f"rule {r.rule_id}: only literals have an approximate scan")
        if near:
            parts.append(scan(df, near, text=text, keys=keys))
    if plain:
        parts.append(scan_exact(df, plain, text, keys))
    return parts


def _of_table(df, rules: DataFrame, text, keys) -> list[DataFrame]:
    parts = []
    plain = rules.filter(~F.coalesce(F.contains("flags", F.lit("C")), F.lit(False)))
    for distance, scan in DISTANCES.items():
        is_near = F.coalesce(F.col(f"ext.{distance}") > 0, F.lit(False))
        near = plain.filter(is_near)
        plain = plain.filter(~is_near)
        if near.filter(F.col("kind") != LITERAL).limit(1).collect():
            raise RuleError("only literals have an approximate scan")
        if near.limit(1).collect():
            parts.append(scan(df, near, text=text, keys=keys))
    if plain.limit(1).collect():
        parts.append(scan_exact(df, plain, text, keys))
    return parts
