"""How a rule set reaches a scan.

Up to ``MAX_UNROLLED`` rules become literal expressions of one projection: no
join, compiled patterns cached by the JVM.  Larger sets stay a table: it is
prepared by a Spark job and joined, in slices small enough to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patternscan.functions.syntax import (
    ALL_ENDS,
    LEFTMOST,
    Prepared,
    Rule,
    RuleError,
    prepare,
)
from patternscan.plans.shipping import ship_package

MAX_UNROLLED = 128
MAX_BROADCAST_ROWS = 200_000

EXT_KEYS = ("min_offset", "max_offset", "min_length", "edit_distance", "hamming_distance")
EXT_TYPE = (
    "struct<min_offset:bigint,max_offset:bigint,min_length:bigint,"
    "edit_distance:int,hamming_distance:int>"
)
RULES_SCHEMA = (
    f"rule_id int, expression string, flags string, flag_bits int, ext {EXT_TYPE}, kind string"
)

# How the start of an event is found.
START_ZERO, START_FIXED, START_REVERSE, START_WINDOW, START_PREFIX = (
    "zero",
    "fixed",
    "reverse",
    "window",
    "prefix",
)


def start_method(p: Prepared) -> str:
    if not p.wants_start or p.anchored:
        return START_ZERO
    if p.fixed_width:
        return START_FIXED
    if p.max_width is not None:
        return START_WINDOW
    return START_REVERSE if p.one_variable else START_PREFIX


def row_to_rule(row) -> Rule:
    ext = row["ext"].asDict() if hasattr(row["ext"], "asDict") else dict(row["ext"] or {})
    return Rule(
        rule_id=int(row["rule_id"]),
        expression=row["expression"],
        flags=row["flags"] or "",
        ext={k: int(v) for k, v in ext.items() if v is not None and not pd.isna(v)},
        kind=row["kind"] or ALL_ENDS,
    )


@dataclass(frozen=True)
class RuleSet:
    """Either rules known to the driver, or a prepared table of many."""

    prepared: tuple[Prepared, ...] | None = None
    table: DataFrame | None = None


def _exact(rule: Rule) -> None:
    """An exact scan must not pass over a distance in silence."""
    if rule.ext.get("edit_distance") or rule.ext.get("hamming_distance"):
        raise RuleError(
            f"rule {rule.rule_id} is approximate: use scan_edit_distance, scan_hamming_distance"
            " or scan_rule_set"
        )


def reject_set_flags(rules) -> None:
    """A scan of single rules must not pass over what a rule says about the
    whole set: formulas (``C``) and quiet rules (``Q``)."""
    if isinstance(rules, DataFrame):
        flagged = rules.filter(F.coalesce(F.col("flags"), F.lit("")).rlike("[CQ]")).select("rule_id").limit(1).collect()
        named = [r["rule_id"] for r in flagged]
    else:
        listed = [rules] if isinstance(rules, (str, Rule)) else rules if isinstance(rules, (list, tuple)) else []
        named = [r.rule_id for r in listed if isinstance(r, Rule) and set(r.flags) & set("CQ")]
    if named:
        raise RuleError(f"rule {named[0]} is a formula or quiet: use scan_rule_set")


def load_rules(rules, kinds: Iterable[str] | None = None, eod: bool = True) -> RuleSet:
    """Accept one rule, a list of rules, or a rules table of any size.

    Invalid rules raise here; run ``audit_rules`` first to set them aside.
    Combination rules are formulas over other rules and are never scanned.
    """
    if isinstance(rules, RuleSet):
        return rules
    if isinstance(rules, (str, Rule)):
        rules = [rules]
    if isinstance(rules, DataFrame):
        rules = rules.filter(~F.coalesce(F.col("flags"), F.lit("")).contains("C"))
        rows = rules.limit(MAX_UNROLLED + 1).collect()
        if len(rows) > MAX_UNROLLED:
            return RuleSet(table=prepared_table(rules))
        rules = [row_to_rule(r) for r in rows]
    rules = [Rule(0, r) if isinstance(r, str) else r for r in rules]
    rules = [r for r in rules if "C" not in r.flags]
    if not rules:
        raise RuleError("no rules")
    for r in rules:
        _exact(r)
    prepared = tuple(prepare(r, eod) for r in rules)
    for p in prepared:
        if kinds is not None and p.rule.kind not in kinds:
            raise RuleError(f"{p.rule.kind} rule {p.rule_id} cannot be used in this scan")
    return RuleSet(prepared=prepared)


PREPARED_FIELDS = (
    "rule_id int",
    "expression string",
    "flags string",
    "kind string",
    f"ext {EXT_TYPE}",
    "forward string",
    "backward string",
    "min_width bigint",
    "max_width bigint",
    "literal string",
    "start_method string",
    "looks_right boolean",
    "ascii_only boolean",
    "nullable boolean",
    "stack_risk boolean",
    "any_of array<string>",
    "caseless boolean",
)


def over_all_cores(rules: DataFrame) -> DataFrame:
    """Parsing a rule costs far more than moving it."""
    return rules.repartition(rules.sparkSession.sparkContext.defaultParallelism)


def prepared_table(rules: DataFrame, eod: bool = True) -> DataFrame:
    """Prepare a large rules table in a Spark job; a bad rule fails the job.

    A table that fits the driver (it will be broadcast from there anyway) is
    prepared once; a larger one stays a job.
    """
    ship_package(rules.sparkSession)
    names = [f.split()[0] for f in PREPARED_FIELDS]

    def prepared_row(row) -> tuple:
        rule = row_to_rule(row)
        _exact(rule)
        p = prepare(rule, eod)
        return (
            p.rule_id,
            p.rule.expression,
            p.rule.flags,
            p.rule.kind,
            {k: p.rule.ext.get(k) for k in EXT_KEYS},
            p.forward,
            p.backward,
            p.min_width,
            p.max_width,
            p.literal,
            start_method(p),
            p.looks_right,
            p.ascii_only,
            p.nullable,
            p.stack_risk,
            list(p.any_of),
            p.caseless,
        )

    def run(batches):
        for pdf in batches:
            rows = [prepared_row(row) for row in pdf.to_dict("records")]
            yield pd.DataFrame(rows, columns=names).astype({"max_width": "Int64"})

    written = over_all_cores(rules.select("rule_id", "expression", "flags", "ext", "kind"))
    table = written.mapInPandas(run, ", ".join(PREPARED_FIELDS))
    rows = table.limit(MAX_BROADCAST_ROWS + 1).collect()
    if len(rows) <= MAX_BROADCAST_ROWS:
        return rules.sparkSession.createDataFrame(rows, table.schema)
    return table


def worker_rules(table: DataFrame, test: Column) -> tuple[Prepared, ...]:
    """The rules of a prepared table that must run in Python workers."""
    rows = table.filter(test).limit(MAX_BROADCAST_ROWS + 1).collect()
    if len(rows) > MAX_BROADCAST_ROWS:
        raise RuleError("too many rules that cannot run on the JVM")
    return tuple(prepare(row_to_rule(r)) for r in rows)


def broadcast_slices(table: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> list[DataFrame]:
    """Cut a table into parts of about ``limit`` rows, each safe to broadcast."""
    n = table.count()
    parts = max(1, -(-n // limit))
    if parts == 1:
        return [F.broadcast(table)]
    # twice as many parts as needed leaves room for uneven hashing
    parts *= 2
    part = F.pmod(F.xxhash64(*table.columns), F.lit(parts))
    return [F.broadcast(table.filter(part == i)) for i in range(parts)]

