"""Dictionary scans: literal rules, from a handful to millions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patternscan.functions.syntax import LITERAL, Rule
from patternscan.operators.events import single_match
from patternscan.operators.grams import MAX_INDEX_ROWS, fold_ascii, gram_occurrences
from patternscan.operators.scan import scan_events
from patternscan.plans.ruleset import MAX_UNROLLED, row_to_rule
from patternscan.sources.rule_lines import checked_flags

SHORT = 8  # bytes
FEW_SHORT = 8


def scan_literals(
    df: DataFrame,
    rules,
    text: str = "text",
    keys: Sequence[str] = ("doc_id",),
    max_index_rows: int = MAX_INDEX_ROWS,
) -> DataFrame:
    """All occurrences of literal rules, overlaps included, as events.

    A few rules go through ``scan_events``; a dictionary goes through one
    equi-join on byte grams, whatever its size.
    """
    if isinstance(rules, DataFrame):
        rows = rules.limit(MAX_UNROLLED + 1).collect()
        if len(rows) > MAX_UNROLLED:
            return scan_dictionary(df, rules, text, keys, max_index_rows)
        rules = [row_to_rule(r) for r in rows]
    literal = [Rule(r.rule_id, r.expression, r.flags, r.ext, LITERAL) for r in rules]
    return scan_events(df, literal, text, keys)


def scan_dictionary(
    df: DataFrame,
    rules: DataFrame,
    text: str = "text",
    keys: Sequence[str] = ("doc_id",),
    max_index_rows: int = MAX_INDEX_ROWS,
) -> DataFrame:
    """The dictionary path of ``scan_literals`` for a rules table.

    Grams of short literals are taken at every byte of the text, so if only
    a few literals are short they are scanned as expressions instead.
    """
    # one meaning whatever the size of the set: the flags of a list of rules
    empty = F.raise_error(F.lit("Pattern matches empty buffer; a literal must not be empty.")).cast("string")
    rules = rules.withColumn("flags", checked_flags("flags", LITERAL)).withColumn(
        "expression", F.when(F.col("expression") == "", empty).otherwise(F.col("expression"))
    )
    rules = rules.filter(~F.contains("flags", F.lit("C")))
    # Unicode case folding is more than bytes can tell
    wide = F.contains("flags", F.lit("i")) & F.col("flags").rlike("[8W]")
    folded = rules.filter(wide)
    if folded.limit(1).collect():
        parts = [scan_events(df, folded.withColumn("kind", F.lit(LITERAL)), text, keys)]
        rules = rules.filter(~wide)
        if rules.limit(1).collect():
            parts.append(scan_dictionary(df, rules, text, keys, max_index_rows))
        return reduce(DataFrame.unionByName, parts)
    few = rules.filter(F.octet_length("expression") < SHORT).limit(FEW_SHORT + 1).collect()
    if 0 < len(few) <= FEW_SHORT:
        short = [row_to_rule(r) for r in few]
        long = rules.filter(F.octet_length("expression") >= SHORT)
        parts = [scan_literals(df, short, text, keys)]
        if long.limit(1).collect():
            parts.append(_scan_grams(df, long, text, keys, max_index_rows))
        return reduce(DataFrame.unionByName, parts)
    return _scan_grams(df, rules, text, keys, max_index_rows)


def _scan_grams(df, rules, text, keys, max_index_rows) -> DataFrame:
    flags = F.coalesce(F.col("flags"), F.lit(""))
    rules = rules.select(
        "rule_id",
        "expression",
        F.contains(flags, F.lit("i")).alias("caseless"),
        F.contains(flags, F.lit("L")).alias("starts"),
        F.contains(flags, F.lit("H")).alias("single"),
        F.col("ext.min_offset").alias("min_offset"),
        F.col("ext.max_offset").alias("max_offset"),
        F.col("ext.min_length").alias("min_length"),
        F.octet_length("expression").cast("long").alias("width"),
    )
    keep = ["rule_id", "starts", "single", "min_offset", "max_offset", "min_length", "width"]
    parts = []
    kinds = [r["caseless"] for r in rules.select("caseless").distinct().collect()]
    for caseless in kinds:
        fold = fold_ascii if caseless else (lambda c: c)
        raw = df.select(*keys, fold(F.col(text)).cast("binary").alias("_raw"))
        literals = rules.filter(F.col("caseless") == caseless).select(
            *keep, fold(F.col("expression")).cast("binary").alias("lit")
        )
        parts.append(
            gram_occurrences(raw, literals, keys, "_raw", keep, max_index_rows=max_index_rows)
        )
    found = reduce(DataFrame.unionByName, parts)
    end = F.col("_from") + F.col("width")
    found = found.filter(
        (end >= F.coalesce("min_offset", end))
        & (end <= F.coalesce("max_offset", end))
        & (F.col("width") >= F.coalesce("min_length", "width"))
    )
    events = found.select(
        *keys,
        "rule_id",
        F.when(F.col("starts"), F.col("_from")).otherwise(F.lit(0).cast("long")).alias("from_off"),
        end.alias("to_off"),
        F.lit(0).alias("flags"),
        "single",
    )
    columns = [*keys, "rule_id", "from_off", "to_off", "flags"]
    if not rules.filter("single").limit(1).collect():
        return events.select(*columns)
    many = events.filter(~F.col("single")).select(*columns)
    return many.unionByName(single_match(events.filter("single").select(*columns), keys))
