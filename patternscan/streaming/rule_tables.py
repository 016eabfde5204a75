"""Rule tables of any size over streams.

Runs of chunks are made as for a list of rules, each behind the bytes that
precede it.  A run then is a text like any other: the grams of what a rule
requires pick (run, rule) pairs, each pair once, and a run is fetched for its
candidates.  Rules without a bound on their width need segments between bytes
that they cannot contain; they are scanned in lists of bounded length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patternscan.functions.syntax import ALL_ENDS, LITERAL, Rule, RuleError
from patternscan.functions.views import view_text
from patternscan.operators.scan import table_events
from patternscan.plans.ruleset import MAX_UNROLLED, prepared_table, reject_set_flags, row_to_rule
from patternscan.streaming import chunks as ch

#: What a rule says about the whole stream: it waits until offsets are global.
WAITS = ("_min_to", "_max_to", "_once", "_starts")
_PLACE = ("_run", "base", "resumed", "last", "_c", "_n")


def as_table(rules) -> DataFrame | None:
    """The rules if they are a table too large to unroll."""
    if not isinstance(rules, DataFrame):
        return None
    reject_set_flags(rules)
    return rules if len(rules.limit(MAX_UNROLLED + 1).collect()) > MAX_UNROLLED else None


def stream_table(rules: DataFrame, eod: bool) -> DataFrame:
    """The prepared rules of a stream; ``eod`` as for ``prepare``."""
    table = prepared_table(rules, eod)
    for test, says in (
        (F.contains("flags", F.lit("8")), "UTF-8 rules cannot be scanned as streams: a chunk may cut a character"),
        (~F.col("kind").isin(ALL_ENDS, LITERAL), "only all-ends and literal rules can be scanned as streams"),
    ):
        if table.filter(test).limit(1).collect():
            raise RuleError(says)
    nothing = F.lit(None).cast("bigint")
    return table.select(
        *(c for c in table.columns if c not in ("ext", "flags")),
        F.regexp_replace("flags", "[Ho]", "").alias("flags"),
        F.col("ext").withField("min_offset", nothing).withField("max_offset", nothing).alias("ext"),
        F.col("ext.min_offset").alias("_min_to"),
        F.col("ext.max_offset").alias("_max_to"),
        F.col("flags").rlike("[Ho]").alias("_once"),
        F.col("flags").rlike("[Ll]").alias("_starts"),
    )


def bounded_width(table: DataFrame) -> int | None:
    """The widest match of the bounded rules; None if there are none."""
    return table.filter("max_width IS NOT NULL").agg(F.max("max_width")).first()[0]


def _lists(table: DataFrame, rules: DataFrame) -> Iterator[list[Rule]]:
    """The unbounded rules, some at a time."""
    ids = table.filter("max_width IS NULL").select("rule_id").distinct()
    some: list[Rule] = []
    for row in rules.join(ids, "rule_id", "left_semi").toLocalIterator():
        some.append(row_to_rule(row))
        if len(some) == MAX_UNROLLED:
            yield some
            some = []
    if some:
        yield some


def _events(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, rule_id, from_off, to_off`` of texts ``_raw``, with what waits and
    the matched bytes of rules that know their starts."""
    found = table_events(df, table, "_raw", keys, False, ("_view", *WAITS))
    size = (F.col("to_off") - F.col("from_off")).cast("int")
    text = F.substring("_view", (F.col("from_off") + 1).cast("int"), size)
    return found.withColumn("_text", F.when(F.col("_starts"), text)).drop("_view")


def _moved(events: DataFrame, keys: list[str], shift: str) -> DataFrame:
    """Local offsets to those of the stream."""
    start = F.when(F.col("_starts"), F.col("from_off") + F.expr(shift)).otherwise(F.lit(0).cast("long"))
    return events.select(
        *keys, "rule_id", start.alias("from_off"), (F.col("to_off") + F.expr(shift)).alias("to_off"), "_text", *WAITS
    )


def _run_rows(runs: ch.Runs, keys: list[str]) -> DataFrame:
    rows = runs.bodies.drop("_last_seq").join(
        runs.summary.select(*keys, "_run", "base", "carry", "ahead", "resumed", "last"), [*keys, "_run"], "left"
    )
    return rows.select(
        *keys, "_run", "base", "resumed", "last", "carry",
        F.char_length("carry").cast("long").alias("_c"),
        F.char_length("body").cast("long").alias("_n"),
        F.concat("carry", "body", "ahead").alias("_view"),
    )


def _bytes(view: str):
    return F.encode(F.expr(view), "ISO-8859-1").alias("_raw")


def _late(df: DataFrame, opened: DataFrame, closed: DataFrame, keys: list[str]) -> DataFrame:
    """Events that exist only because the data ends at the end of ``_end``;
    ``_shift`` is where it begins in the stream."""
    place = [*keys, "_shift", "_size"]
    ends = df.select(*keys, "_shift", F.char_length("_end").cast("long").alias("_size"), _bytes("_end"))
    found = [
        _events(ends, t.filter("looks_right"), place).filter("to_off >= _size - 1") for t in (closed, opened)
    ]
    known = found[1].select(*keys, "rule_id", "from_off", "to_off")
    return _moved(found[0].join(known, [*keys, "rule_id", "from_off", "to_off"], "left_anti"), keys, "_shift")


def settled(events: DataFrame, keys: list[str], text: bool) -> DataFrame:
    """Offset bounds and the single-match flag, now that offsets are global."""
    inside = (F.col("to_off") >= F.coalesce("_min_to", "to_off")) & (F.col("to_off") <= F.coalesce("_max_to", "to_off"))
    events = events.filter(inside)
    columns = [*keys, "rule_id", "from_off", "to_off", "_text"]
    first = F.min(F.struct("to_off", "from_off", "_text")).alias("e")
    once = events.filter("_once").groupBy(*keys, "rule_id").agg(first)
    once = once.select(*keys, "rule_id", "e.from_off", "e.to_off", "e._text")
    both = events.filter("NOT _once").select(*columns).unionByName(once)
    shown = [F.expr(view_text("_text")).alias("text")] if text else []
    return both.select(*keys, "rule_id", "from_off", "to_off", F.lit(0).alias("flags"), *shown)


def _without(events: DataFrame, keys: list[str], state: DataFrame | None) -> DataFrame:
    """Without rules that matched before the state was saved, and match once."""
    if state is None or "found" not in state.columns:
        return events
    before = state.select(*keys, F.explode(F.split("found", ",")).alias("_id"))
    before = before.select(*keys, F.col("_id").try_cast("int").alias("rule_id")).filter("rule_id IS NOT NULL")
    return events.join(before, [*keys, "rule_id"], "left_anti").select(*events.columns)


def _no_state(opened: DataFrame, state: DataFrame | None) -> None:
    if state is not None and opened.filter("max_width IS NULL").limit(1).collect():
        raise RuleError("the state of an unbounded rule has no fixed size; scan the whole stream")


def scan(chunks, rules, keys, seq, chunk, state, with_text, close, bucket) -> DataFrame:
    """``scan_stream`` with a rule table."""
    opened = stream_table(rules, False)
    _no_state(opened, state)
    width, parts = bounded_width(opened), []
    bounded = opened.filter("max_width IS NOT NULL")
    if width is not None:
        runs = ch._runs(chunks, keys, seq, chunk, width + 1 + 2 * close, bucket, state)
        rows, place = _run_rows(runs, keys), [*keys, *_PLACE]
        found = _events(rows.select(*place, _bytes("_view")), bounded, place)
        events = [_moved(found.filter("to_off > _c AND to_off <= _c + _n"), keys, "base - _c")]
        right = bounded.filter("looks_right")
        if (state is not None or close) and right.limit(1).collect():
            if state is not None:
                # ends at the saved edge that had to wait for the next byte
                edge = rows.filter("resumed")
                now, then = (
                    _events(edge.select(*place, _bytes(view)), right, place).filter("to_off = _c")
                    for view in ("_view", "carry")
                )
                known = then.select(*keys, "rule_id", "from_off", "to_off")
                new = now.join(known, [*keys, "rule_id", "from_off", "to_off"], "left_anti")
                events.append(_moved(new, keys, "base - _c"))
            if close:
                end = F.right("_view", F.lit(width + 3))
                shift = F.col("base") - F.col("_c") + F.char_length("_view") - F.char_length("_end")
                ends = rows.filter("last").withColumn("_end", end).withColumn("_shift", shift)
                closed = stream_table(rules, True).filter("max_width IS NOT NULL")
                events.append(_late(ends, right, closed, keys))
        parts.append(settled(reduce(DataFrame.unionByName, events), keys, with_text))
    for some in _lists(opened, rules):
        parts.append(ch.scan_stream(chunks, some, keys, seq, chunk, None, with_text, close, bucket))
    return _without(reduce(DataFrame.unionByName, parts), keys, state)


def close(chunks, rules, keys, seq, chunk, state, with_text, bucket) -> DataFrame:
    """``close_streams`` with a rule table."""
    opened = stream_table(rules, False)
    _no_state(opened.filter("looks_right"), state)
    width, parts = bounded_width(opened), []
    if width is not None:
        last = ch._runs(chunks, keys, seq, chunk, width + 3, bucket, state).totals
        ends = last.select(*keys, F.col("tail").alias("_end"), (F.col("total") - F.char_length("tail")).alias("_shift"))
        bounded = "max_width IS NOT NULL"
        late = _late(ends, opened.filter(bounded), stream_table(rules, True).filter(bounded), keys)
        parts.append(settled(late, keys, with_text))
    for some in _lists(opened, rules):
        parts.append(ch.close_streams(chunks, some, keys, seq, chunk, None, with_text, bucket))
    return _without(reduce(DataFrame.unionByName, parts), keys, state)


def stand(chunks, rules, keys, seq, chunk, bucket) -> tuple[int, DataFrame | None]:
    """For ``export_state``: the bytes to keep, and the rules that match once."""
    opened = stream_table(rules, False)
    if opened.filter("max_width IS NULL").limit(1).collect():
        raise RuleError("the state of an unbounded rule has no fixed size")
    single = rules.filter(F.coalesce(F.col("flags"), F.lit("")).rlike("[Ho]"))
    return bounded_width(opened) + 1, single if single.limit(1).collect() else None
