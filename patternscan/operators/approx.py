"""Approximate literal scans.

A literal cut into k + 1 pieces keeps at least one piece intact under k errors
(pigeonhole), so exact occurrences of the pieces are the only places to look.

Distances count bytes.  Caseless UTF-8 rules (``i8``) fold every character whose
other case has as many bytes; the others equal only themselves (the Kelvin sign
is no ``k``, the long s no ``s``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patternscan.functions.syntax import LITERAL, Rule, RuleError, byte_text, check_flags
from patternscan.functions.views import (
    binary_view,
    column_name,
    cut_bytes,
    each,
    keep,
    let,
    positions,
    quote,
    sql_text,
    view_of,
    zipped,
)
from patternscan.operators.events import single_match
from patternscan.operators.grams import fold_ascii, gram_occurrences
from patternscan.operators.scan import NO_EVENTS, bounded_events, event, explode_events
from patternscan.sources.rule_lines import checked_flags

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@cache
def _characters() -> dict[str, str]:
    """Characters and their fold where it is another character of as many bytes,
    so that offsets stay."""
    every = (chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    folds = ((c, c.casefold()) for c in every)
    return {c: f for c, f in folds if c != f and len(f) == 1 and len(c.encode()) == len(f.encode())}


def _folded(text: Column, wide: bool) -> Column:
    """A text in one case: of A to Z, or of all characters."""
    if not wide:
        return fold_ascii(text)
    table = _characters()
    return F.translate(text.cast("string"), "".join(table), "".join(table.values()))


def _pieces(literal: str, k: int) -> list[tuple[int, str]]:
    """(offset, text) of k + 1 pieces of about equal size."""
    if len(literal) <= k:
        raise RuleError("Approximate matching patterns that reduce to vacuous patterns.")
    cuts = [len(literal) * i // (k + 1) for i in range(k + 2)]
    return [(a, literal[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _anchors(view: str, literal: str, k: int) -> str:
    """Where the literal would start if one piece were in place."""

    def shifted(offset, piece):
        return each(positions(view, sql_text(quote(piece))), lambda p: f"{p} - {offset}")

    found = ", ".join(shifted(offset, piece) for offset, piece in _pieces(literal, k))
    return f"array_distinct(flatten(array({found})))"


def _some_piece(view: str, literal: str, k: int) -> str:
    tests = (f"contains({view}, {sql_text(piece)})" for _, piece in _pieces(literal, k))
    return " OR ".join(tests)


def hamming(a: str, b: str) -> str:
    """Number of positions at which two strings of equal length differ."""
    unequal = zipped(f"split({a}, '')", f"split({b}, '')", lambda x, y: f"CAST({x} <> {y} AS INT)")
    return f"aggregate({unequal}, 0, (n, d) -> n + d)"


def _hamming_events(raw: str, view: str, r: Rule, k: int) -> str:
    literal = byte_text(r.expression)
    m = len(literal)
    inside = keep(
        _anchors(view, literal, k), lambda a: f"{a} >= 0 AND {a} + {m} <= octet_length({raw})"
    )
    close = keep(
        inside,
        lambda a: f"{hamming(cut_bytes(raw, a, f'{a} + {m}'), sql_text(literal))} <= {k}",
    )
    return each(close, lambda a: _reported(r, a, f"{a} + {m}"))


def _edit_events(raw: str, view: str, r: Rule, k: int) -> str:
    literal = byte_text(r.expression)
    m = len(literal)
    near = each(
        _anchors(view, literal, k), lambda a: f"sequence({a} + {m - k}, {a} + {m + k})"
    )
    ends = keep(
        f"array_distinct(flatten({near}))",
        lambda e: f"{e} BETWEEN {max(0, m - k)} AND octet_length({raw})",
    )

    def starts(e):
        # the leftmost start is the longest text that is still close enough
        every = f"sequence(greatest(0L, {e} - {m + k}), least({e}, {e} - {m - k}))"
        return keep(
            every,
            lambda s: f"levenshtein({cut_bytes(raw, s, e)}, {sql_text(literal)}, {k}) >= 0",
        )

    def nearest(e):
        return let(
            f"get({starts(e)}, 0)",
            lambda s: f"CASE WHEN {s} IS NOT NULL THEN {_reported(r, s, e)} END",
        )

    return f"array_compact({each(ends, nearest)})"


def _reported(r: Rule, start: str, end: str) -> str:
    return event(end, f"CAST({r.rule_id} AS INT)", start if "L" in r.flags else "0L")


def _scan(df, rules: Sequence[Rule], k, text, keys, build, key: str) -> DataFrame:
    rules = [replace(r, flags=check_flags(r)) for r in rules]
    if any("i" in r.flags for r in rules):
        # the text and the literals in one case (offsets stay): of characters for UTF-8 rules
        parts = []
        for wide in (False, True):
            alike = [r for r in rules if "i" in r.flags and ("8" in r.flags) == wide]
            table = str.maketrans(_characters()) if wide else _LOWER
            folded = [replace(r, flags=r.flags.replace("i", ""), expression=r.expression.translate(table)) for r in alike]
            if folded:
                low = df.select(*keys, _folded(F.col(text), wide).alias(text))
                parts.append(_scan(low, folded, k, text, keys, build, key))
        plain = [r for r in rules if "i" not in r.flags]
        if plain:
            parts.append(_scan(df, plain, k, text, keys, build, key))
        return reduce(DataFrame.unionByName, parts)
    for r in rules:
        _pieces(byte_text(r.expression), r.ext.get(key, k))

    def one(raw, view, r):
        limit = r.ext.get(key, k)
        test = _some_piece(view, byte_text(r.expression), limit)
        # a bound on the length needs the start, shown or not
        tracked = replace(r, flags=r.flags + "L") if "min_length" in r.ext else r
        found = bounded_events(f"sort_array({build(raw, view, tracked, limit)})", r)
        return f"CASE WHEN {test} THEN {found} ELSE {NO_EVENTS} END"

    def every(raw, view):
        return f"sort_array(flatten(array({', '.join(one(raw, view, r) for r in rules)})))"

    raw = f"CAST({column_name(text)} AS BINARY)"
    events = let(view_of(df, text), lambda v: let(raw, lambda b: every(b, v)))
    return explode_events(df, events, keys)


def _scan_table(df, rules: DataFrame, k: int, text, keys, key: str) -> DataFrame:
    """A rules table of any size: its pieces are a dictionary, and only the
    places they point to are compared."""
    keys = list(keys)
    letters = checked_flags("flags", LITERAL)
    caseless, wide = F.contains(letters, F.lit("i")), F.contains(letters, F.lit("8"))
    kinds = {r.wide for r in rules.filter(caseless).select(wide.alias("wide")).distinct().collect()}
    if kinds:  # at most two
        found = _scan_table(df, rules.filter(~caseless), k, text, keys, key)
        for kind in sorted(kinds):
            low = df.select(*keys, _folded(F.col(text), kind).alias(text))
            alike = rules.filter(caseless & (wide == F.lit(kind))).withColumns(
                {"expression": _folded(F.col("expression"), kind), "flags": F.replace(letters, F.lit("i"), F.lit(""))}
            )
            found = found.unionByName(_scan_table(low, alike, k, text, keys, key))
        return found
    rules = rules.withColumn("flags", letters)
    whole = rules.selectExpr(
        "rule_id",
        "contains(flags, 'H') AS _single",
        "ext.min_offset AS _lo",
        "ext.max_offset AS _hi",
        "ext.min_length AS _least",
        "contains(coalesce(flags, ''), 'L') AS _starts",
        "CAST(expression AS BINARY) AS _whole",
        "CAST(octet_length(expression) AS BIGINT) AS _width",
        f"CAST(coalesce(ext.{key}, {k}) AS INT) AS _errors",
    )
    short = whole.filter("_width <= _errors").limit(1).collect()
    if short:
        raise RuleError("Approximate matching patterns that reduce to vacuous patterns.")
    at = "CAST(_width * {} DIV (_errors + 1) AS INT)"
    pieces = whole.select("*", F.expr("explode(sequence(0, _errors)) AS _i")).selectExpr(
        "*",
        f"{at.format('_i')} AS _off",
        f"substring(_whole, {at.format('_i')} + 1,"
        f" {at.format('(_i + 1)')} - {at.format('_i')}) AS lit",
    )
    texts = df.select(*keys, F.col(text).cast("binary").alias("_raw"))
    texts = texts.withColumn("_text", F.col("_raw"))
    bounds = ["_single", "_lo", "_hi", "_least"]
    rule = ["rule_id", "_starts", "_whole", "_width", "_errors", *bounds]
    seeds = gram_occurrences(
        texts, pieces.drop("_i"), keys, "_raw", keep=[*rule, "_off"], carry=["_text"]
    ).withColumn("_a", F.col("_from") - F.col("_off"))
    literal = binary_view("_whole")
    if key == "hamming_distance":
        close = f"{hamming(cut_bytes('_text', '_a', '_a + _width'), literal)} <= _errors"
        found = seeds.filter("_a >= 0 AND _a + _width <= octet_length(_text)").filter(F.expr(close))
        found = found.selectExpr(
            *keys, "rule_id", "_starts", "_a AS _s", "_a + _width AS to_off", *bounds
        )
    else:
        ends = seeds.select(
            *keys,
            *rule,
            "_text",
            F.expr("explode(sequence(_a + _width - _errors, _a + _width + _errors)) AS to_off"),
        ).filter("to_off >= greatest(0L, _width - _errors) AND to_off <= octet_length(_text)")
        starts = keep(
            "sequence(greatest(0L, to_off - _width - _errors),"
            " least(to_off, to_off - _width + _errors))",
            lambda s: f"levenshtein({cut_bytes('_text', s, 'to_off')}, {literal}, _errors) >= 0",
        )
        found = ends.selectExpr(
            *keys, "rule_id", "_starts", f"get({starts}, 0) AS _s", "to_off", *bounds
        )
        found = found.filter("_s IS NOT NULL")
    # several seeds may lead to one event
    events = (
        found.groupBy(*keys, "rule_id", "to_off", "_starts", *bounds)
        .agg(F.min("_s").alias("_s"))
        .withColumn("from_off", F.expr("IF(_starts, _s, 0L)"))
        .filter(
            "to_off >= coalesce(_lo, to_off) AND to_off <= coalesce(_hi, to_off)"
            " AND to_off - _s >= coalesce(_least, to_off - _s)"
        )
        .withColumn("flags", F.lit(0))
    )
    columns = [*keys, "rule_id", "from_off", "to_off", "flags"]
    if not rules.filter("contains(flags, 'H')").limit(1).collect():
        return events.select(*columns)
    first = single_match(events.filter("_single"), keys)
    return events.filter("NOT _single").select(*columns).unionByName(first.select(*columns))


def scan_edit_distance(
    df: DataFrame,
    rules: Sequence[Rule] | DataFrame,
    k: int = 1,
    text: str = "text",
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Every end at which some text is within ``k`` edits of the literal.

    A rule's own ``edit_distance`` overrides ``k``.  Literals only: a list, or
    a rules table of any size.
    """
    if isinstance(rules, DataFrame):
        return _scan_table(df, rules, k, text, keys, "edit_distance")
    return _scan(df, rules, k, text, keys, _edit_events, "edit_distance")


def scan_hamming_distance(
    df: DataFrame,
    rules: Sequence[Rule] | DataFrame,
    k: int = 1,
    text: str = "text",
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Every end at which a text of the literal's length differs from it in at
    most ``k`` bytes.  A rule's own ``hamming_distance`` overrides ``k``."""
    if isinstance(rules, DataFrame):
        return _scan_table(df, rules, k, text, keys, "hamming_distance")
    return _scan(df, rules, k, text, keys, _hamming_events, "hamming_distance")
