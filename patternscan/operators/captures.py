"""Capture groups with offsets, and scans that need a Python worker.

A rule whose every part can be made a group is placed on the JVM: offsets are
sums of the lengths of the parts.  Others, and rules the JVM must not run, go to
workers: rows that cannot match are dropped on the JVM side first; the rest travel
in Arrow batches, one row at a time in memory.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patternscan.functions.matching import Matcher, bounded, byte_offsets
from patternscan.functions.syntax import LEFTMOST, Prepared, Rule, Spans, capture_spans, prepare
from patternscan.functions.views import (
    byte_view,
    column_name,
    each,
    each_indexed,
    inclusive_sums,
    is_binary,
    let,
    running_sums,
    sql_text,
    view_of,
    view_text,
    zipped,
)
from patternscan.operators.scan import RuleSql, any_hit, hit
from patternscan.plans.ruleset import MAX_UNROLLED, load_rules, worker_rules
from patternscan.plans.shipping import ship_package

CAPTURES = "array<struct<from_off:bigint,to_off:bigint,text:string>>"
CAPTURED = f"array<struct<rule_id:int,from_off:bigint,to_off:bigint,captures:{CAPTURES}>>"


def _may_match(df: DataFrame, text: str, prepared: Sequence[Prepared]) -> DataFrame:
    """Drop rows on the JVM that no rule can match."""
    if (
        is_binary(df, text)
        or len(prepared) > MAX_UNROLLED
        or any(p.nullable or (p.stack_risk and not p.literal) for p in prepared)
    ):
        return df
    name = column_name(text)
    tests = [
        f"contains({byte_view(name)}, {sql_text(p.literal)})" for p in prepared if p.stack_risk
    ]
    safe = [p for p in prepared if not p.stack_risk]
    if safe:
        tests.append(any_hit(name, safe))
    return df.filter(F.expr(" OR ".join(tests)))


def _schema(df: DataFrame, keys: Sequence[str], extra: str = "") -> T.StructType:
    schema = T.StructType([df.schema[k] for k in keys])
    tail = T._parse_datatype_string(
        "rule_id int, from_off bigint, to_off bigint, flags int" + extra
    )
    return T.StructType(schema.fields + tail.fields)


def _map_rows(df, prepared, text, keys, schema, emit) -> DataFrame:
    ship_package(df.sparkSession)
    keys = list(keys)
    names = schema.names

    def run(batches):
        matchers = [Matcher.of(p) for p in prepared]
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False, name=None):
                value = row[-1]
                if value is None:
                    continue
                raw = value.encode("utf-8") if isinstance(value, str) else bytes(value)
                chars = value if isinstance(value, str) else raw.decode("latin-1")
                view = raw.decode("latin-1")
                events = []
                for m in matchers:
                    events.extend(emit(m, chars, view, raw))
                events.sort(key=lambda e: (e[2], e[0], e[1]))
                out.extend(row[:-1] + e for e in events)
            yield pd.DataFrame(out, columns=names)

    return df.select(*keys, text).mapInPandas(run, schema)


def scan_in_workers(
    df: DataFrame, prepared: Sequence[Prepared], text: str, keys: Sequence[str]
) -> DataFrame:
    """Events of rules the JVM functions cannot place."""

    def emit(m: Matcher, chars, view, raw):
        subject = chars if "8" in m.rule.flags else view
        if not m.may_match(subject):
            return
        if m.rule.kind == LEFTMOST:
            found = [x.span() for x in m.forward.finditer(subject)]
        else:
            found = m.ends(subject)
        for a, b in bounded(m.rule, byte_offsets(m.rule, subject, found)):
            yield m.rule.rule_id, a, b, 0

    kept = _may_match(df, text, prepared)
    return _map_rows(kept, prepared, text, keys, _schema(df, keys), emit)


def match_in_workers(
    df: DataFrame, prepared: Sequence[Prepared], text: str, keys: Sequence[str]
) -> DataFrame:
    """``keys..., rule_id`` of rules the JVM must not run."""

    def emit(m: Matcher, chars, view, raw):
        subject = chars if "8" in m.rule.flags else view
        if m.may_match(subject) and m.forward.search(subject):
            yield m.rule.rule_id, 0, 0, 0

    kept = _may_match(df, text, prepared)
    hits = _map_rows(kept, prepared, text, keys, _schema(df, keys), emit)
    return hits.select(*keys, "rule_id")


def matches_in_worker(text: str, p: Prepared) -> Column:
    """Yes or no for one rule the JVM must not run; rows without the text it
    requires do not reach the worker's matcher."""
    ship_package(SparkSession.active())

    @F.pandas_udf("boolean")
    def found(texts: pd.Series) -> pd.Series:
        m = Matcher.of(p)

        def one(value):
            if value is None:
                return None
            view = value if "8" in p.rule.flags else value.encode("utf-8").decode("latin-1")
            return m.forward.search(view) is not None

        return texts.map(one)

    if not (p.literal and p.literal.isascii()):
        return found(F.expr(text))
    # a row that lacks the literal is sent as an empty text
    needed = F.expr(f"contains({text}, {sql_text(p.literal)})")
    return needed & found(F.expr(f"IF(contains({text}, {sql_text(p.literal)}), {text}, '')"))


def scan_captures(
    df: DataFrame,
    rules,
    text: str = "text",
    keys: Sequence[str] = ("doc_id",),
    groups: bool = True,
) -> DataFrame:
    """Leftmost-first events with one entry per capture group (0 is the whole
    match); a group that took no part is NULL.  ``groups=False`` leaves the
    captures NULL and stays on the JVM.

    Groups stay on the JVM too unless one repeats, is referred to, stands in a
    look-around or may be empty as well as absent.  A rules table of any size
    is matched on the JVM; its (row, rule) pairs go to workers.
    """
    rule_set = load_rules(rules, (LEFTMOST,))
    if not groups:
        from patternscan.operators.scan import scan_leftmost

        events = scan_leftmost(df, rule_set, text, keys)
        return events.withColumn("captures", F.lit(None).cast(CAPTURES))
    if rule_set.prepared is None:
        return _captures_of_table(df, rule_set.table.filter(F.col("kind") == LEFTMOST), text, keys)
    placed = [(p, _spans(df, p, text)) for p in rule_set.prepared]
    builtin = [(p, s) for p, s in placed if s is not None]
    parts = []
    if builtin:
        raw = column_name(text)

        def events(view):
            each_rule = (_captured(raw if p.has("8") else view, p, s) for p, s in builtin)
            return f"flatten(array({', '.join(each_rule)}))"

        found = df.select(*keys, F.explode(F.expr(let(view_of(df, text), events))).alias("e"))
        offsets = (F.col(f"e.{c}").alias(c) for c in ("rule_id", "from_off", "to_off"))
        parts.append(found.select(*keys, *offsets, F.lit(0).alias("flags"), F.col("e.captures").alias("captures")))
    others = [p for p, s in placed if s is None]
    if others:
        schema = _schema(df, keys, f", captures {CAPTURES}")
        parts.append(_map_rows(_may_match(df, text, others), others, text, keys, schema, _captures))
    return reduce(DataFrame.unionByName, parts)


def _spans(df: DataFrame, p: Prepared, text: str) -> Spans | None:
    """The spans of a rule that the JVM may place in this column."""
    if p.stack_risk or p.nullable or p.rule.ext or is_binary(df, text):
        return None
    return capture_spans(p)


def _captured(subject: str, p: Prepared, spans: Spans) -> str:
    """``CAPTURED`` of one rule: gaps before matches and parts of matches alternate."""
    pattern = sql_text(spans.pattern)
    lists = (f"regexp_extract_all({subject}, {pattern}, {k + 1})" for k in range(spans.parts))
    size = "octet_length" if p.has("8") else "char_length"

    def length(piece):
        return f"CAST({size}({piece}) AS BIGINT)"

    def match(x):
        pieces = f"array({', '.join(f'{x}.`{k}`' for k in range(spans.parts))})"
        return let(pieces, lambda t: f"named_struct('t', {t}, 'at', {inclusive_sums(each(t, length), '0L')})")

    def part(x, start, first, last):
        joined = f"array_join(slice({x}.t, {first + 1}, {last - first}), '')"
        shown = joined if p.has("8") else f"make_valid_utf8({view_text(joined)})"
        ends = ", ".join(f"'{n}', {start} + {x}.at[{k}]" for n, k in (("from_off", first), ("to_off", last)))
        return f"named_struct({ends}, 'text', {shown})"

    def group(x, start, first, last, maybe):
        shown = part(x, start, first, last)
        return f"CASE WHEN {x}.at[{last}] > {x}.at[{first}] THEN {shown} END" if maybe else shown

    def events(found):
        def placed(steps):
            def sums(before):
                def one(x, i):
                    width = f"{x}.at[{spans.parts}]"

                    def shown(start):
                        groups = (group(x, start, *g[1:]) for g in spans.groups)
                        listed = ", ".join((part(x, start, 0, spans.parts), *groups))
                        return (
                            f"named_struct('rule_id', {p.rule_id}, 'from_off', {start}, 'to_off', {start} + {width},"
                            f" 'captures', array({listed}))"
                        )

                    return let(f"get({before}, {i}) + get({steps}, {i}) - {width}", shown)

                return each_indexed(found, one)

            return let(running_sums(steps), sums)

        gaps = each(f"split({subject}, {pattern}, -1)", length)
        return let(zipped(f"slice({gaps}, 1, size({found}))", found, lambda g, x: f"{g} + {x}.at[{spans.parts}]"), placed)

    every = let(each(f"arrays_zip({', '.join(lists)})", match), events)
    wanted = f"slice({every}, 1, 1)" if p.has("H") else every
    return f"CAST(CASE WHEN {hit(subject, RuleSql.of(p))} THEN {wanted} ELSE array() END AS {CAPTURED})"


def _captures(m: Matcher, chars, view, raw):
    """Events with captures of one rule in one text."""
    subject = chars if "8" in m.rule.flags else view
    for x in m.forward.finditer(subject):
        spans = [x.span(i) for i in range(m.forward.groups + 1)]
        taken = [s for s in spans if s[0] >= 0]
        offsets = dict(zip(taken, byte_offsets(m.rule, subject, taken), strict=True))
        captures = []
        for s in spans:
            if s[0] < 0:
                captures.append(None)
                continue
            a, b = offsets[s]
            piece = raw[a:b].decode("utf-8", "replace")
            captures.append({"from_off": a, "to_off": b, "text": piece})
        a, b = offsets[spans[0]]
        if not _within(m.rule.ext, a, b):
            continue
        yield m.rule.rule_id, a, b, 0, captures
        if "H" in m.rule.flags:
            return


def _within(ext: dict, start: int, end: int) -> bool:
    """Does a match keep to the offset bounds of its rule?"""
    if end < ext.get("min_offset", 0) or end - start < ext.get("min_length", 0):
        return False
    return ext.get("max_offset") is None or end <= ext["max_offset"]


def _captures_of_table(df: DataFrame, table: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """Captures of a rule set of any size: (row, rule) pairs that match are found
    on the JVM, and workers place the groups of each pair."""
    from patternscan.operators.prefilter import rule_pairs

    ship_package(df.sparkSession)
    keys, binary = list(keys), is_binary(df, text)
    schema = _schema(df, keys, f", captures {CAPTURES}")
    by_row = F.col("stack_risk") | F.col("nullable")
    risky = worker_rules(table, by_row)
    pairs = rule_pairs(df, table.filter(~by_row), text, keys).select(*keys, "rule_id", "expression", "flags", F.to_json("ext").alias("_ext"), "_text")

    def run(batches):
        @lru_cache(4096)
        def matcher(rule_id, expression, flags, ext):
            return Matcher.of(prepare(Rule(rule_id, expression, flags, json.loads(ext or "{}"), LEFTMOST)))

        for pdf in batches:
            out = []
            for *key, rule_id, expression, flags, ext, value in pdf.itertuples(index=False, name=None):
                raw = value.encode("latin-1" if binary else "utf-8")
                m = matcher(rule_id, expression, flags, ext)
                out.extend((*key, *e) for e in _captures(m, value, raw.decode("latin-1"), raw))
            yield pd.DataFrame(out, columns=schema.names)

    found = pairs.mapInPandas(run, schema)
    if not risky:
        return found
    return found.unionByName(_map_rows(_may_match(df, text, risky), risky, text, keys, schema, _captures))


def group_texts(text: str, rule, group: int = 1) -> Column:
    """Text of one capture group for every match, on the JVM.  A group that
    took no part is an empty string here."""
    (p,) = load_rules(rule, (LEFTMOST,)).prepared
    pattern = sql_text(p.forward)
    if p.has("8"):
        return F.expr(f"regexp_extract_all({text}, {pattern}, {group})")
    pieces = let(byte_view(text), lambda v: f"regexp_extract_all({v}, {pattern}, {group})")
    return F.expr(each(pieces, view_text))

