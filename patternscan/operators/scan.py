"""Scans of a text table with a rule set.

A text row is one block.  Every scan is a projection (plus ``explode``) over
the text table: nothing shuffles, and a row never leaves its task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from patternscan.functions.syntax import ALL_ENDS, LEFTMOST, LITERAL, Prepared, Rule, RuleError
from patternscan.functions.views import (
    byte_view,
    bytes_between,
    column_name,
    cut_bytes,
    each,
    each_indexed,
    is_binary,
    keep,
    let,
    positions,
    running_sums,
    sql_text,
    view_of,
    zipped,
)
from patternscan.plans.ruleset import (
    START_FIXED,
    START_PREFIX,
    START_REVERSE,
    START_WINDOW,
    START_ZERO,
    RuleSet,
    load_rules,
    reject_set_flags,
    start_method,
    worker_rules,
)

# what may follow a match at the end of a window: nothing, one or two characters
ENDS_WITH = (r"\z", r"(?=[\s\S]\z)", r"(?=[\s\S]{2}\z)")

NO_EVENTS = "CAST(array() AS ARRAY<STRUCT<to_off: BIGINT, rule_id: INT, from_off: BIGINT>>)"


@dataclass(frozen=True)
class RuleSql:
    """One rule as SQL values: literals, or columns of a joined rules table."""

    rule_id: str
    forward: str
    backward: str
    min_width: str
    max_width: str
    any_of: tuple[str, ...]
    caseless: bool
    min_offset: str | None
    max_offset: str | None
    min_length: str | None
    start: str
    reports_start: bool
    looks_right: bool
    utf8: bool
    single: bool
    ascii_only: bool

    @staticmethod
    def of(p: Prepared) -> RuleSql:
        ext = {k: f"{v}L" for k, v in p.rule.ext.items()}
        return RuleSql(
            rule_id=f"CAST({p.rule_id} AS INT)",
            forward=sql_text(p.forward),
            backward=sql_text(p.backward),
            min_width=f"{p.min_width}L",
            max_width=f"{p.max_width}L",
            any_of=tuple(sql_text(t) for t in p.any_of),
            caseless=p.caseless,
            min_offset=ext.get("min_offset"),
            max_offset=ext.get("max_offset"),
            min_length=ext.get("min_length"),
            start=start_method(p),
            reports_start=p.has("L") or p.rule.kind == LEFTMOST,
            looks_right=p.looks_right,
            utf8=p.has("8"),
            single=p.has("H"),
            ascii_only=p.ascii_only,
        )

    @property
    def any_view(self) -> bool:
        """Yes or no is the same on characters as on bytes, or wants characters."""
        return self.ascii_only or self.utf8


def hit(view: str, r: RuleSql) -> str:
    """Does the rule match at all?  Plain substring tests go first."""
    test = f"regexp_like({view}, {r.forward})"
    if not r.any_of:
        return test
    if r.caseless:
        first = let(f"lower({view})", lambda v: _contains_any(v, r.any_of))
    else:
        first = _contains_any(view, r.any_of)
    return f"({first} AND {test})"


def _contains_any(view: str, texts: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({view}, {t})" for t in texts) + ")"


# --------------------------------------------------------------------------
# yes / no


def match_any(text: str, rule) -> Column:
    """True where the rule matches the text somewhere; NULL for NULL text.

    ``text`` names a string column (or is a SQL expression of one).
    """
    prepared = load_rules(rule).prepared
    if prepared is None:
        raise RuleError("a column holds a rule set up to the unroll limit; use match_rules for a larger table")
    if any(p.stack_risk for p in prepared):
        from patternscan.operators.captures import matches_in_worker

        tests = [
            matches_in_worker(text, p) if p.stack_risk else F.expr(any_hit(text, [p]))
            for p in prepared
        ]
        return reduce(Column.__or__, tests)
    return F.expr(any_hit(text, prepared))


def any_hit(text: str, prepared: Sequence[Prepared]) -> str:
    """Does any of the rules match?"""
    rules = [RuleSql.of(p) for p in prepared]

    def tests(view):
        return " OR ".join(hit(text if r.any_view else view, r) for r in rules)

    if all(r.any_view for r in rules):
        return f"({tests(text)})"
    return let(byte_view(text), lambda v: f"({tests(v)})")


def match_rules(
    df: DataFrame, rules, text: str = "text", keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """One row per (text, rule that matches it): ``keys..., rule_id``."""
    rule_set = load_rules(rules)
    if rule_set.table is not None:
        risky = worker_rules(rule_set.table, F.col("stack_risk"))
        safe = rule_set.table.filter("NOT stack_risk")
        hits = _pairs(df, safe, text, keys, False).select(*keys, "rule_id")
        return _with_worker_hits(hits, df, risky, text, keys)
    risky = [p for p in rule_set.prepared if p.stack_risk]
    safe = [p for p in rule_set.prepared if not p.stack_risk]
    if not safe:
        return _with_worker_hits(None, df, risky, text, keys)
    raw = column_name(text)
    listed = [RuleSql.of(p) for p in safe]

    def ids(view):
        tests = (
            f"CASE WHEN {hit(raw if r.any_view else view, r)} THEN {r.rule_id} END" for r in listed
        )
        return f"array_compact(array({', '.join(tests)}))"

    if is_binary(df, text):
        raw = view_of(df, text)
    found = ids(raw) if all(r.any_view for r in listed) else let(view_of(df, text), ids)
    if risky and not is_binary(df, text):
        # one pass over the table: only rows that may match send their text
        from patternscan.operators.captures import matches_in_worker

        tests = [
            F.when(matches_in_worker(raw, p), F.lit(p.rule_id).cast("int")).alias(f"_w{i}")
            for i, p in enumerate(risky)
        ]
        both = df.select(*keys, F.expr(found).alias("_ids"), *tests)
        ids_of_both = F.concat(
            "_ids", F.array_compact(F.array(*(F.col(f"_w{i}") for i in range(len(risky)))))
        )
        return both.select(*keys, F.explode(ids_of_both).alias("rule_id"))
    hits = df.select(*keys, F.explode(F.expr(found)).alias("rule_id"))
    return _with_worker_hits(hits, df, risky, text, keys)


def _with_worker_hits(hits: DataFrame | None, df, risky, text, keys) -> DataFrame:
    """Adds the hits of rules that would recurse too deeply on the JVM."""
    if not risky:
        return hits
    from patternscan.operators.captures import match_in_workers

    more = match_in_workers(df, risky, text, keys)
    return more if hits is None else hits.unionByName(more)


def _pairs(
    df: DataFrame, table: DataFrame, text: str, keys: Sequence[str], with_text: bool = True
) -> DataFrame:
    # Imported here: the prefilter builds on this module.
    from patternscan.operators.prefilter import rule_pairs

    return rule_pairs(df, table, text, keys, with_text=with_text)


# --------------------------------------------------------------------------
# all ends


def event(to_off: str, rule_id: str, from_off: str) -> str:
    return (
        f"named_struct('to_off', CAST({to_off} AS BIGINT), 'rule_id', {rule_id},"
        f" 'from_off', CAST({from_off} AS BIGINT))"
    )


def _leftmost_start(raw: str, view: str, r: RuleSql, n: str, end: str) -> str:
    """Start of the longest match that ends at ``end``, by a search from the
    left in as much of the text as a match can cover."""
    lo = f"greatest(0L, {end} - {r.max_width} - 1)" if r.start == START_WINDOW else "0L"

    def window(hi):
        if r.utf8:
            return f"substring({view}, CAST({lo} + 1 AS INT), CAST({hi} - {lo} AS INT))"
        return cut_bytes(raw, lo, hi)

    def search(text, tail):
        return f"regexp_instr({text}, concat({r.forward}, {sql_text(tail)}))"

    if not r.looks_right:
        return f"{lo} + {search(window(end), ENDS_WITH[0])} - 1"
    # Two more characters are enough for any assertion at the end.
    after = f"least(2L, {n} - {end})"

    def by_rest(w):
        cases = (f"WHEN {k} THEN {search(w, tail)}" for k, tail in enumerate(ENDS_WITH))
        return f"{lo} - 1 + CASE {after} {' '.join(cases)} END"

    return let(window(f"({end} + {after})"), by_rest)


def _ends(raw: str, view: str, r: RuleSql) -> str:
    """Events of one rule, by ascending end: an end of the rule in the text is
    a start of the reversed rule in the reversed text."""
    n = f"CAST(char_length({view}) AS BIGINT)"

    def build(rev):
        found = positions(rev, r.backward)
        if r.start == START_REVERSE:
            # the reversed rule has one greedy variable part: its first match
            # is its longest, which gives the leftmost start
            texts = f"regexp_extract_all({rev}, concat('(?=(', {r.backward}, '))'), 1)"
            events = zipped(
                found,
                texts,
                lambda at, m: event(f"{n} - {at}", r.rule_id, f"{n} - {at} - char_length({m})"),
            )
        else:

            def one(at):
                end = f"({n} - {at})"
                if r.start == START_ZERO:
                    start = "0L"
                elif r.start == START_FIXED:
                    start = f"{end} - {r.min_width}"
                else:
                    start = _leftmost_start(raw, view, r, n, end)
                return event(end, r.rule_id, start)

            events = each(found, one)
        return f"reverse({events})"

    return let(f"reverse({view})", build)


def _finish(view: str, events: str, r: RuleSql) -> str:
    """Byte offsets, offset bounds and the single-match flag, in that order."""
    if r.utf8:

        def at(position):
            return f"octet_length(substring({view}, 1, CAST({position} AS INT)))"

        events = each(
            events, lambda e: event(at(f"{e}.to_off"), f"{e}.rule_id", at(f"{e}.from_off"))
        )
    if r.min_offset is not None:
        events = keep(events, lambda e: f"{e}.to_off >= {r.min_offset}")
    if r.max_offset is not None:
        events = keep(events, lambda e: f"{e}.to_off <= {r.max_offset}")
    if r.min_length is not None:
        events = keep(events, lambda e: f"{e}.to_off - {e}.from_off >= {r.min_length}")
        if not r.reports_start:
            events = each(events, lambda e: event(f"{e}.to_off", f"{e}.rule_id", "0L"))
    return f"slice({events}, 1, 1)" if r.single else events


def bounded_events(events: str, rule: Rule) -> str:
    """The offset bounds and the single-match flag of a rule over bytes."""
    bounds = {k: f"{rule.ext[k]}L" if k in rule.ext else None for k in ("min_offset", "max_offset", "min_length")}
    flags = {"utf8": False, "reports_start": "L" in rule.flags, "single": "H" in rule.flags}
    return _finish("NULL", events, SimpleNamespace(**bounds, **flags))


def _leftmost(view: str, r: RuleSql) -> str:
    """Non-overlapping leftmost-first events of one rule that is never empty:
    matches and the gaps between them alternate."""
    gaps = f"split({view}, {r.forward}, -1)"

    def lengths(m):
        return zipped(
            f"slice({gaps}, 1, size({m}))",
            m,
            lambda g, x: f"named_struct('gap', CAST(char_length({g}) AS BIGINT),"
            f" 'len', CAST(char_length({x}) AS BIGINT))",
        )

    def build(pairs):
        def place(before):
            def one(p, i):
                start = f"get({before}, {i}) + {p}.gap"
                return event(f"{start} + {p}.len", r.rule_id, start)

            return each_indexed(pairs, one)

        return let(running_sums(each(pairs, lambda p: f"{p}.gap + {p}.len")), place)

    pairs = let(f"regexp_extract_all({view}, {r.forward}, 0)", lengths)
    return let(pairs, build)


def rule_events(text: str, raw: str, view: str, r: RuleSql, leftmost: bool) -> str:
    """The events of one rule in one block."""
    subject = text if r.utf8 else view
    found = _leftmost(subject, r) if leftmost else _ends(raw, subject, r)
    return f"CASE WHEN {hit(subject, r)} THEN {_finish(subject, found, r)} ELSE {NO_EVENTS} END"


def event_array(text: str, rules, view: str | None = None) -> str:
    """All events of one block as an array ordered by (to, rule, from).

    Events that end together have no natural order; this one is total.
    ``rules`` must be known to the driver.
    """
    prepared = load_rules(rules).prepared
    if prepared is None:
        raise ValueError("too many rules for one expression; use scan_events")

    def build(v):
        def with_raw(raw):
            parts = [
                rule_events(text, raw, v, RuleSql.of(p), p.rule.kind == LEFTMOST)
                for p in prepared
            ]
            if len(parts) == 1:
                return parts[0]
            return f"sort_array(flatten(array({', '.join(parts)})))"

        if any(start_method(p) in (START_WINDOW, START_PREFIX) for p in prepared):
            raw = f"CAST({text} AS BINARY)" if view is None else f"encode({v}, 'ISO-8859-1')"
            return let(raw, with_raw)
        return with_raw("NULL")

    return let(byte_view(text) if view is None else view, build)


def explode_events(df: DataFrame, events: str, keys: Sequence[str]) -> DataFrame:
    """Event arrays to the events table."""
    return df.select(*keys, F.explode(F.expr(events)).alias("e")).select(
        *keys,
        F.col("e.rule_id").alias("rule_id"),
        F.col("e.from_off").alias("from_off"),
        F.col("e.to_off").alias("to_off"),
        F.lit(0).alias("flags"),
    )


def _not_null(df: DataFrame, text: str) -> DataFrame:
    raised = F.raise_error(F.lit("block is NULL")).cast(df.schema[text].dataType)
    return df.withColumn(text, F.coalesce(F.col(text), raised))


def scan_events(
    df: DataFrame,
    rules,
    text: str = "text",
    keys: Sequence[str] = ("doc_id",),
    strict: bool = False,
) -> DataFrame:
    """All-ends scan: one event per (rule, end offset).

    ``from_off`` is 0 unless the rule has flag ``L``.  NULL blocks give no
    events, or an error with ``strict``; ``null_blocks`` lists them.  Formulas
    (``C``) and quiet rules (``Q``) are errors here: see ``scan_rule_set``.
    """
    reject_set_flags(rules)
    return scan_exact(df, rules, text, keys, strict)


def scan_exact(
    df: DataFrame, rules, text: str = "text", keys: Sequence[str] = ("doc_id",), strict: bool = False
) -> DataFrame:
    """``scan_events`` for a part of a rule set: quiet rules report, formulas do not."""
    return _scan(df, load_rules(rules, (ALL_ENDS, LITERAL)), text, keys, strict, False)


def scan_leftmost(
    df: DataFrame,
    rules,
    text: str = "text",
    keys: Sequence[str] = ("doc_id",),
    strict: bool = False,
) -> DataFrame:
    """Leftmost-first scan: non-overlapping matches, full offsets."""
    return _scan(df, load_rules(rules, (LEFTMOST,)), text, keys, strict, True)


def _scan(df, rule_set: RuleSet, text, keys, strict, leftmost) -> DataFrame:
    if strict:
        df = _not_null(df, text)
    if rule_set.table is not None:
        return _scan_table(df, rule_set.table, text, keys, leftmost)
    prepared = rule_set.prepared
    by_worker = [p for p in prepared if p.stack_risk or (leftmost and p.nullable)]
    builtin = [p for p in prepared if p not in by_worker]
    parts = []
    if builtin:
        if is_binary(df, text):
            # a rule over characters sees one per byte of a binary payload
            view = view_of(df, text)
            events = let(view, lambda v: event_array(v, RuleSet(tuple(builtin)), view=v))
        else:
            events = event_array(column_name(text), RuleSet(tuple(builtin)))
        parts.append(explode_events(df, events, keys))
    if by_worker:
        # Imported here: captures build on this module.
        from patternscan.operators.captures import scan_in_workers

        parts.append(scan_in_workers(df, by_worker, text, keys))
    return reduce(DataFrame.unionByName, parts)


def _scan_table(df, table: DataFrame, text, keys, leftmost) -> DataFrame:
    """A rule set too large for one expression: find the matching (row, rule)
    pairs first, then build the events of each pair from the rule's columns."""
    wanted = (LEFTMOST,) if leftmost else (ALL_ENDS, LITERAL)
    table = table.filter(F.col("kind").isin(*wanted))
    by_worker = F.col("stack_risk") | (F.col("nullable") & F.lit(leftmost))
    risky = worker_rules(table, by_worker)
    found = table_events(df, table.filter(~by_worker), text, keys, leftmost)
    parts = [found.withColumn("flags", F.lit(0))]
    if risky:
        from patternscan.operators.captures import scan_in_workers

        parts.append(scan_in_workers(df, risky, text, keys))
    return reduce(DataFrame.unionByName, parts)


def table_events(
    df: DataFrame,
    table: DataFrame,
    text: str,
    keys: Sequence[str],
    leftmost: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``keys, rule_id, from_off, to_off`` of the rules of a prepared table, with
    columns ``carry`` of the rule or the pair (``_view`` is the text's)."""
    shape = {
        "start_method": "start_method",
        "looks_right": "looks_right",
        "utf8": "contains(flags, '8')",
        "single": "contains(flags, 'H')",
        "reports": "contains(flags, 'L')",
        "lo": "ext.min_offset IS NOT NULL",
        "hi": "ext.max_offset IS NOT NULL",
        "len": "ext.min_length IS NOT NULL",
    }
    shaped = table.select("*", *(F.expr(e).alias(f"_{n}") for n, e in shape.items()))
    shapes = shaped.select(*(f"_{n}" for n in shape)).distinct().collect()
    if not shapes:  # an empty table: one shape keeps the columns
        shapes = [Row(_start_method=START_ZERO, **{f"_{n}": False for n in shape if n != "start_method"})]
    parts = []
    for s in shapes:  # at most a few dozen exist
        same = reduce(lambda d, n: d.filter(F.col(n) == F.lit(s[n])), s.asDict(), shaped)
        r = RuleSql(
            rule_id="rule_id",
            forward="forward",
            backward="backward",
            min_width="min_width",
            max_width="max_width",
            any_of=(),
            caseless=False,
            min_offset="ext.min_offset" if s["_lo"] else None,
            max_offset="ext.max_offset" if s["_hi"] else None,
            min_length="ext.min_length" if s["_len"] else None,
            start=s["_start_method"],
            reports_start=s["_reports"] or leftmost,
            looks_right=s["_looks_right"],
            utf8=s["_utf8"],
            single=s["_single"],
            ascii_only=False,
        )
        same = same.select(*table.columns)
        if not s["_single"] and not s["_utf8"] and not leftmost:
            near = _near(same)
            if same.filter(near).limit(1).collect():
                parts.append(_window_events(df, same.filter(near), text, keys, r, carry))
                same = same.filter(~near)
                if not same.limit(1).collect():
                    continue
        pairs = _pairs(df, same, text, keys)
        raw = "encode(_view, 'ISO-8859-1')"
        found = let(raw, lambda b, r=r: rule_events("_text", b, "_view", r, leftmost))
        exploded = pairs.select(*keys, *carry, F.explode(F.expr(found)).alias("_e"))
        parts.append(exploded.select(*keys, "_e.rule_id", "_e.from_off", "_e.to_off", *carry))
    return reduce(DataFrame.unionByName, parts)


def _near(table: DataFrame) -> Column:
    """Rules whose events are found around the one literal they require."""
    from patternscan.operators.prefilter import has_literal
    from patternscan.operators.windows import is_near

    return has_literal() & is_near()


def _window_events(df, table, text, keys, r: RuleSql, carry) -> DataFrame:
    """The events of rules of one shape, each from the last occurrence of the
    rule's literal before its end.  No text is copied or shuffled for that."""
    from patternscan.operators.grams import MAX_INDEX_ROWS
    from patternscan.operators.prefilter import literal_windows
    from patternscan.operators.windows import own_ends

    of_text = [c for c in carry if c == "_view"]
    around = literal_windows(df, table, text, keys, of_text, MAX_INDEX_ROWS)
    local = replace(r, min_offset=None, max_offset=None)
    raw = "encode(_window, 'ISO-8859-1')"
    found = let(raw, lambda b: rule_events("_window", b, "_window", local, False))
    own = keep(found, lambda e: own_ends(f"{e}.to_off"))
    shift = "_lo" if r.reports_start and r.start != START_ZERO else "0L"
    ends = around.select(*keys, *carry, "_lo", "ext", F.explode(F.expr(own)).alias("_e")).select(
        *keys,
        "_e.rule_id",
        F.expr(f"_e.from_off + {shift}").alias("from_off"),
        F.expr("_e.to_off + _lo").alias("to_off"),
        *carry,
        "ext",
    )
    if r.min_offset is not None:
        ends = ends.filter("to_off >= ext.min_offset")
    if r.max_offset is not None:
        ends = ends.filter("to_off <= ext.max_offset")
    return ends.drop("ext")


def null_blocks(df: DataFrame, text: str = "text", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Blocks that cannot be scanned."""
    return df.filter(F.col(text).isNull()).select(*keys, F.lit("block is NULL").alias("error"))


# --------------------------------------------------------------------------
# pieces scanned as one text


def scan_vectored(
    df: DataFrame,
    rules,
    pieces: str = "pieces",
    keys: Sequence[str] = ("doc_id",),
    strict: bool = False,
) -> DataFrame:
    """Scan a list of pieces as if concatenated; offsets are in the
    concatenation and matches may span pieces.  A NULL list or a NULL piece
    makes the block NULL."""
    col = F.col(pieces)
    joined = F.when(F.exists(col, lambda x: x.isNull()), F.lit(None)).otherwise(
        F.array_join(col, "")
    )
    return scan_events(df.select(*keys, joined.alias("_text")), rules, "_text", keys, strict)


def piece_index(pieces: str, offset: str) -> Column:
    """0-based piece that holds the byte before ``offset`` (an event's end)."""
    lengths = each(pieces, lambda p: f"CAST(octet_length({p}) AS BIGINT)")
    return F.expr(f"size({keep(running_sums(lengths), lambda b: f'{b} < {offset}')}) - 1")


# --------------------------------------------------------------------------
# find


def coalesced(events: str) -> str:
    """Merge an event into the one before it when rule and start agree and the
    end grows: only the last event of such a run stays."""

    def last_of_runs(arr):
        def grows(e, i):
            nxt = f"get({arr}, {i} + 1)"
            return (
                f"NOT coalesce({nxt}.rule_id = {e}.rule_id AND {nxt}.from_off = {e}.from_off"
                f" AND {nxt}.to_off > {e}.to_off, false)"
            )

        return f"filter({arr}, (e, i) -> {grows('e', 'i')})"

    return let(events, last_of_runs)


def _find(text: str, rules, n: int) -> str:
    prepared = load_rules(rules).prepared
    if prepared is None:
        raise RuleError("a column holds a rule set up to the unroll limit; use scan_events for a larger table")
    if n == 1 and all(p.rule.kind == LEFTMOST and not p.nullable and not p.rule.ext for p in prepared):
        return _first_of(text, prepared)
    found = event_array(text, RuleSet(prepared))
    # leftmost-first matches are never merged
    if not all(p.rule.kind == LEFTMOST for p in prepared):
        found = coalesced(found)
    limited = found if n < 0 else f"slice({found}, 1, {n})"
    return let(limited, lambda a: f"CASE WHEN size({a}) > 0 THEN {a} END")


def _first_of(text: str, prepared: Sequence[Prepared]) -> str:
    """The first leftmost-first event; a rule's text is read up to its first match."""

    def first(view, r):
        subject = text if r.utf8 else view
        size = "octet_length" if r.utf8 else "char_length"

        def placed(at):
            before = f"{size}(substring({subject}, 1, {at} - 1))" if r.utf8 else f"{at} - 1"
            matched = f"{size}(regexp_extract({subject}, {r.forward}, 0))"
            found = event(f"{before} + {matched}", r.rule_id, before)
            return f"CASE WHEN {at} > 0 THEN {found} END"

        return let(f"regexp_instr({subject}, {r.forward})", placed)

    def least(view):
        return f"array_min(array({', '.join(first(view, RuleSql.of(p)) for p in prepared)}))"

    return let(let(byte_view(text), least), lambda e: f"CASE WHEN {e} IS NOT NULL THEN array({e}) END")


def find_all_index(text: str, rules, n: int = -1) -> Column:
    """First ``n`` merged matches as an array of (from_off, to_off, rule_id);
    negative ``n`` gives all, 0 none; NULL when there is none."""

    def shown(e):
        return f"struct({e}.from_off AS from_off, {e}.to_off AS to_off, {e}.rule_id AS rule_id)"

    return F.expr(each(_find(text, rules, n), shown))


def find_first_index(text: str, rules) -> Column:
    """``[from, to]`` of the first merged match, or NULL."""
    return F.get(find_all_index(text, rules, 1), F.lit(0))


def find_all(text: str, rules, n: int = -1) -> Column:
    """Texts of the first ``n`` merged matches."""
    return F.expr(
        each(
            _find(text, rules, n), lambda e: bytes_between(text, f"{e}.from_off", f"{e}.to_off")
        )
    )


def find_first(text: str, rules) -> Column:
    """Text of the first merged match, or NULL."""
    return F.get(find_all(text, rules, 1), F.lit(0))
