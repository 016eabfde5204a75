"""Streams at rest: ordered chunks of one logical text, scanned in batch.

A stream may be far larger than a task can hold and may own a third of all
rows, so nothing is grouped by stream alone.  Chunks are gathered into runs of
``bucket`` sequence numbers; a narrow summary of the runs (length, last bytes)
is ordered per stream and hands each run the bytes before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patternscan.functions.syntax import ALL_ENDS, LITERAL, Prepared, Rule, RuleError, prepare
from patternscan.functions.views import binary_view, each, keep, let, view_of, view_text
from patternscan.operators.events import coalesce_events, limit_events
from patternscan.operators.scan import event, event_array
from patternscan.plans.ruleset import RuleSet, load_rules, reject_set_flags

BUCKET = 256  # chunks per run: about 1 MB of 4 KB chunks
TOTALS_BUCKET = 4096  # rows per run when only numbers are summed
SEED_RUN = -(1 << 62)  # sorts before every run of chunks
MAX_SEGMENT = 1 << 28  # bytes an unbounded rule may need at once

STATE = "tail binary, base bigint, next_seq bigint, state_bytes bigint"


# --------------------------------------------------------------------------
# cutting and counting


def chunk_text(
    df: DataFrame,
    size: int = 4096,
    overlap: int = 0,
    text: str = "text",
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Long texts as ordered chunks of ``size`` bytes: ``keys, seq, start_off,
    chunk`` (binary, because a cut may fall inside a character).  Each chunk
    begins with the last ``overlap`` bytes of the one before it."""
    raw = df.select(*keys, F.col(text).cast("binary").alias("_raw"))
    starts = F.when(
        F.octet_length("_raw") > 0,
        F.sequence(F.lit(0), F.octet_length("_raw") - 1, F.lit(size)),
    )
    cut = raw.select(*keys, "_raw", F.posexplode(starts).alias("_seq", "_at"))
    begin = F.greatest(F.lit(0), F.col("_at") - overlap)
    return cut.select(
        *keys,
        F.col("_seq").cast("long").alias("seq"),
        begin.cast("long").alias("start_off"),
        F.substring("_raw", begin + 1, F.col("_at") - begin + size).alias("chunk"),
    )


def run_of(order: Column, bucket: int) -> Column:
    """First order number of the run of ``bucket`` numbers that holds this one."""
    return order - F.pmod(order, F.lit(bucket))


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: dict[str, Column],
    bucket: int = TOTALS_BUCKET,
    levels: int = 1,
    block: Column | None = None,
) -> DataFrame:
    """``df`` with the sum of each value over the rows before this one.

    Sums run inside (key, run of ``bucket`` order numbers) groups and over the
    run totals, so one long key is spread over many tasks.  More ``levels`` do
    the same to the run totals.  ``block``, which rises with ``order``, is the
    run of a row where order numbers are too sparse for runs of equal width.
    """
    keys = list(keys)
    run = run_of(F.col(order).cast("long"), bucket) if block is None else block
    marked = df.select("*", run.alias("_run"), *(v.alias(f"_v_{n}") for n, v in values.items()))
    totals = marked.groupBy(*keys, "_run").agg(
        *(F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values)
    )
    zero = F.lit(0).cast("long")
    if levels > 1:
        sums = {f"_b_{n}": F.col(f"_t_{n}") for n in values}
        totals = totals.withColumnRenamed("_run", "_at")
        totals = running_totals(totals, keys, "_at", sums, bucket * TOTALS_BUCKET, levels - 1)
        totals = totals.select(*keys, F.col("_at").alias("_run"), *sums)
    else:
        before = Window.partitionBy(*keys).orderBy("_run")
        before = before.rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.select(
            *keys,
            "_run",
            *(F.coalesce(F.sum(f"_t_{n}").over(before), zero).alias(f"_b_{n}") for n in values),
        )
    inside = (
        Window.partitionBy(*keys, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = marked.select(
        *df.columns,
        "_run",
        *(F.coalesce(F.sum(f"_v_{n}").over(inside), zero).alias(f"_l_{n}") for n in values),
    )
    joined = local.join(totals, [*keys, "_run"])
    return joined.select(
        *df.columns, *((F.col(f"_b_{n}") + F.col(f"_l_{n}")).alias(n) for n in values)
    )


# --------------------------------------------------------------------------
# runs with the bytes before and after them


def _views(chunks: DataFrame, keys: list[str], seq: str, chunk: str) -> DataFrame:
    """Chunks as byte views, empty ones left out.

    A chunk needs a stream and a place in it.  Saying so here, and not leaving
    it to the joins further on, keeps the shuffles of both their sides equal,
    so that one is reused for the other.
    """
    placed = reduce(lambda df, c: df.filter(F.col(c).isNotNull()), [*keys, seq], chunks)
    return placed.select(
        *keys, F.col(seq).cast("long").alias("_seq"), F.expr(view_of(chunks, chunk)).alias("_view")
    ).filter("_view != ''")


@dataclass(frozen=True)
class Runs:
    """Runs of chunks: ``body`` rows and their summary."""

    bodies: DataFrame  # keys, _run, body
    summary: DataFrame  # keys, _run, n, base, carry, ahead, last
    totals: DataFrame  # keys, total, tail, next_seq


def _runs(
    chunks: DataFrame,
    keys: list[str],
    seq: str,
    chunk: str,
    width: int,
    bucket: int,
    state: DataFrame | None,
) -> Runs:
    width = max(width, 1)
    view = _views(chunks, keys, seq, chunk)
    bodies = (
        view.groupBy(*keys, run_of(F.col("_seq"), bucket).alias("_run"))
        .agg(F.array_sort(F.collect_list(F.struct("_seq", "_view"))).alias("_c"))
        .select(
            *keys,
            "_run",
            F.element_at("_c", -1)["_seq"].alias("_last_seq"),
            F.array_join(F.transform("_c", lambda c: c["_view"]), "").alias("body"),
        )
    )
    narrow = bodies.select(
        *keys,
        "_run",
        "_last_seq",
        F.char_length("body").cast("long").alias("n"),
        F.right("body", F.lit(width)).alias("tail"),
        F.left("body", F.lit(1)).alias("head"),
    )
    if state is not None:
        # what a stream has seen before counts as a run in front of the others
        seeded = state.select(
            *keys,
            F.lit(SEED_RUN).cast("long").alias("_run"),
            (F.col("next_seq") - 1).alias("_last_seq"),
            F.col("base").alias("n"),
            F.right(F.expr(binary_view("tail")), F.lit(width)).alias("tail"),
            F.lit("").alias("head"),
        )
        narrow = narrow.unionByName(seeded)
    order = Window.partitionBy(*keys).orderBy("_run")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    with_base = narrow.select(
        "*",
        F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("base"),
        F.lag("tail", 1, "").over(order).alias("_before"),
        F.lead("head", 1, "").over(order).alias("ahead"),
        F.lead("_run").over(order).isNull().alias("last"),
        F.coalesce(F.lag("_run").over(order) == SEED_RUN, F.lit(False)).alias("resumed"),
    )
    # Runs that start within ``width`` bytes before this one, and the run that
    # precedes the first of them, hold every byte that is needed.
    near = Window.partitionBy(*keys).orderBy("base").rangeBetween(-width, -1)
    close = F.collect_list(F.struct("base", "_before", "tail")).over(near)
    summary = with_base.withColumn("_near", F.array_sort(close)).select(
        *keys,
        "_run",
        "_last_seq",
        "n",
        "base",
        "tail",
        "ahead",
        "last",
        "resumed",
        F.right(
            F.concat(
                F.coalesce(F.try_element_at("_near", F.lit(1))["_before"], "_before"),
                F.array_join(F.transform("_near", lambda r: r["tail"]), ""),
            ),
            F.lit(width),
        ).alias("carry"),
    )
    totals = summary.filter("last").select(
        *keys,
        (F.col("base") + F.col("n")).alias("total"),
        F.right(F.concat("carry", "tail"), F.lit(width)).alias("tail"),
        (F.col("_last_seq") + 1).alias("next_seq"),
    )
    return Runs(bodies, summary, totals)


# --------------------------------------------------------------------------
# scanning


@dataclass(frozen=True)
class _Local:
    """Rules made ready for scanning a piece of a stream: offsets are local
    there, so bounds on offsets and the single-match flag wait, and the id is
    the rule's place in the list."""

    rules: tuple[Rule, ...]
    open: tuple[Prepared, ...]
    closed: tuple[Prepared, ...]

    @staticmethod
    def of(rules: Sequence[Rule]) -> _Local:
        waits = ("min_offset", "max_offset")
        local = [
            replace(
                r,
                rule_id=i,
                flags=r.flags.replace("H", "").replace("o", ""),
                ext={k: v for k, v in r.ext.items() if k not in waits},
            )
            for i, r in enumerate(rules)
        ]
        return _Local(
            tuple(rules),
            tuple(prepare(r, eod=False) for r in local),
            tuple(prepare(r, eod=True) for r in local),
        )

    def only(self, keep) -> _Local:
        pairs = [(o, c) for o, c in zip(self.open, self.closed, strict=True) if keep(o)]
        return _Local(self.rules, tuple(o for o, _ in pairs), tuple(c for _, c in pairs))

    @property
    def width(self) -> int:
        return max((p.max_width for p in self.open), default=0) + 1


def _stream_rules(rules) -> list[Rule]:
    reject_set_flags(rules)
    loaded = load_rules(rules, (ALL_ENDS, LITERAL))
    if loaded.prepared is None:
        raise ValueError("a stream scan needs a rule set that fits the driver")
    for p in loaded.prepared:
        if p.has("8"):
            raise RuleError("UTF-8 rules cannot be scanned as streams: a chunk may cut a character")
    return [p.rule for p in loaded.prepared]


def _global(
    df: DataFrame, keys: list[str], local: _Local, events: str, shift: str, view: str
) -> DataFrame:
    """Explode local events to global ones; texts come along for rules that
    know their starts."""
    known = [i for i, r in enumerate(local.rules) if "L" in r.flags or "l" in r.flags]
    starts = F.col("e.rule_id").isin(known) if known else F.lit(False)
    size = (F.col("e.to_off") - F.col("e.from_off")).cast("int")
    exploded = df.select(
        *keys,
        F.expr(view).alias("_bytes"),
        F.expr(shift).alias("_shift"),
        F.explode(F.expr(events)).alias("e"),
    )
    return exploded.select(
        *keys,
        F.col("e.rule_id").alias("_i"),
        F.when(starts, F.col("e.from_off") + F.col("_shift"))
        .otherwise(F.lit(0).cast("long"))
        .alias("from_off"),
        (F.col("e.to_off") + F.col("_shift")).alias("to_off"),
        F.when(
            starts, F.substring("_bytes", (F.col("e.from_off") + 1).cast("int"), size)
        ).alias("_text"),
    )


def _settle(events: DataFrame, keys: list[str], rules: Sequence[Rule], text: bool) -> DataFrame:
    """Real rule ids, offset bounds and the single-match flag."""
    ids = F.array(*(F.lit(r.rule_id).cast("int") for r in rules))
    for key, keep in (
        ("min_offset", lambda v: F.col("to_off") >= v),
        ("max_offset", lambda v: F.col("to_off") <= v),
    ):
        for i, r in enumerate(rules):
            if r.ext.get(key) is not None:
                events = events.filter((F.col("_i") != i) | keep(r.ext[key]))
    single = [i for i, r in enumerate(rules) if "H" in r.flags or "o" in r.flags]
    if single:
        once = F.col("_i").isin(single)
        first = (
            events.filter(once)
            .groupBy(*keys, "_i")
            .agg(F.min(F.struct("to_off", "from_off", "_text")).alias("e"))
            .select(*keys, "_i", "e.from_off", "e.to_off", "e._text")
        )
        events = events.filter(~once).unionByName(first)
    shown = [F.expr(view_text("_text")).alias("text")] if text else []
    return events.select(
        *keys,
        F.get(ids, F.col("_i")).alias("rule_id"),
        "from_off",
        "to_off",
        F.lit(0).alias("flags"),
        *shown,
    )


def _scan_runs(
    runs: Runs, keys: list[str], local: _Local, seeded: bool, close: bool
) -> DataFrame:
    """Events of bounded rules: each run is scanned behind the bytes that
    precede it, and reports only the ends inside itself."""
    rows = runs.bodies.drop("_last_seq").join(
        runs.summary.select(*keys, "_run", "base", "carry", "ahead", "resumed", "last"),
        [*keys, "_run"],
        "left",  # every run has a summary; an inner join would filter one side
    )
    rows = rows.select(
        *keys,
        "base",
        "resumed",
        "last",
        "carry",
        F.char_length("carry").cast("long").alias("_c"),
        F.char_length("body").cast("long").alias("_n"),
        F.concat("carry", "body", "ahead").alias("_view"),
    )
    found = event_array("_view", RuleSet(local.open), view="_view")
    inside = keep(found, lambda e: f"{e}.to_off > _c AND {e}.to_off <= _c + _n")
    if seeded and any(p.looks_right for p in local.open):
        # ends at the saved edge that had to wait for the next byte
        known = event_array("carry", RuleSet(local.open), view="carry")
        edge = (keep(events, lambda e: f"{e}.to_off = _c") for events in (found, known))
        inside = (
            f"CASE WHEN resumed THEN concat(array_except({', '.join(edge)}), {inside})"
            f" ELSE {inside} END"
        )
    late = local.only(lambda p: p.looks_right)
    if close and late.open:
        end = f"right(_view, {late.width + 2})"
        before = f"char_length(_view) - char_length({end})"
        closing = each(
            _closing(end, late),
            lambda e: event(
                f"{e}.to_off + {before}", f"{e}.rule_id", f"{e}.from_off + {before}"
            ),
        )
        inside = f"CASE WHEN last THEN concat({inside}, {closing}) ELSE {inside} END"
    return _global(rows, keys, local, inside, "base - _c", "_view")


def _closing(view: str, local: _Local) -> str:
    """Events that exist only because the data ends at the end of ``view``."""

    def late(v, rules):
        events = event_array(v, RuleSet(rules), view=v)
        return keep(events, lambda e: f"{e}.to_off >= char_length({v}) - 1")

    return let(view, lambda v: f"array_except({late(v, local.closed)}, {late(v, local.open)})")


def _segments(
    chunks: DataFrame, keys: list[str], seq: str, chunk: str, fence: str | None, ends: bool
) -> DataFrame:
    """Cut streams at fence bytes, which no match of the rule can contain.

    ``keys, _g, base, view, last``: every segment but the first begins with the
    fence byte that ended the one before, as context.  Without a fence a stream
    is one segment.  ``last`` is known if ``ends`` asks for it.  A segment beyond ``MAX_SEGMENT`` bytes is an error, never
    a silent cut.
    """
    view = _views(chunks, keys, seq, chunk)
    n = F.char_length("_view").cast("long")
    fenced = F.lit(False) if fence is None else F.regexp_like("_view", F.lit(fence))
    totals = running_totals(
        view, keys, "_seq", {"_base": n, "_g": fenced.cast("long")}, bucket=BUCKET
    )

    def part(g, base, text):
        return F.struct(g.alias("g"), base.alias("base"), text.alias("text"))

    whole = F.array(part(F.col("_g"), F.col("_base"), F.col("_view")))
    if fence is None:
        parts = whole
    else:
        inside = "[^" + fence[1:]
        tail = F.regexp_extract("_view", f"{fence}{inside}*\\z", 0)
        cut = F.char_length("_view") - F.char_length("_tail")
        totals = totals.withColumn("_tail", tail)
        head = F.left("_view", cut + 1)
        parts = F.when(
            fenced,
            F.array(
                part(F.col("_g"), F.col("_base"), head),
                part(F.col("_g") + 1, F.col("_base") + cut, F.col("_tail")),
            ),
        ).otherwise(whole)
    pieces = totals.select(*keys, F.explode(parts).alias("p")).select(*keys, "p.*")
    size = F.sum(F.char_length("text"))
    too_long = F.raise_error(
        F.lit("an unbounded rule needs more of one stream than a task can hold")
    ).cast("bigint")
    grouped = pieces.groupBy(*keys, "g").agg(
        F.min("base").alias("base"),
        F.array_sort(F.collect_list(F.struct("base", "text"))).alias("_p"),
        F.when(size > MAX_SEGMENT, too_long).otherwise(size).alias("_size"),
    )
    if ends:
        # a stream has one segment more than chunks with a fence
        last = view.groupBy(*keys).agg(F.sum(fenced.cast("long")).alias("_last"))
        grouped = grouped.join(last, keys)
    is_last = F.col("g") == F.col("_last") if ends else F.lit(False)
    return grouped.filter("_size > 0").select(
        *keys,
        F.col("g").alias("_g"),
        "base",
        F.array_join(F.transform("_p", lambda p: p["text"]), "").alias("_view"),
        is_last.alias("last"),
    )


def _scan_segments(
    segments: DataFrame, keys: list[str], local: _Local, close: bool
) -> DataFrame:
    found = event_array("_view", RuleSet(local.open), view="_view")
    # the first byte of a later segment was scanned in the one before
    inside = keep(found, lambda e: f"_g = 0 OR {e}.to_off > 1")
    late = local.only(lambda p: p.looks_right)
    if close and late.open:
        closing = _closing("_view", late)
        inside = f"CASE WHEN last THEN concat({inside}, {closing}) ELSE {inside} END"
    return _global(segments, keys, local, inside, "base", "_view")


def _no_state(rules: Sequence[Prepared], state) -> None:
    if state is not None and any(p.max_width is None for p in rules):
        raise RuleError("the state of an unbounded rule has no fixed size; scan the whole stream")


def scan_stream(
    chunks: DataFrame,
    rules,
    keys: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    chunk: str = "chunk",
    state: DataFrame | None = None,
    with_text: bool = False,
    close: bool = False,
    bucket: int = BUCKET,
) -> DataFrame:
    """All-ends events of streams of ordered chunks, offsets in the whole
    stream.  The events of its end (see ``close_streams``) are included with
    ``close``.

    ``seq`` orders the chunks of a stream and is unique in it; ``state`` (from
    ``export_state``) continues streams scanned before.
    """
    # Imported here: rule tables build on this module.
    from patternscan.streaming import rule_tables

    keys = list(keys)
    if (table := rule_tables.as_table(rules)) is not None:
        return rule_tables.scan(chunks, table, keys, seq, chunk, state, with_text, close, bucket)
    local = _Local.of(_stream_rules(rules))
    _no_state(local.open, state)
    parts = []
    bounded = local.only(lambda p: p.max_width is not None)
    if bounded.open:
        runs = _runs(chunks, keys, seq, chunk, bounded.width + 2 * close, bucket, state)
        parts.append(_scan_runs(runs, keys, bounded, state is not None, close))
    for fence, group in _by_fence(local):
        ends = close and any(p.looks_right for p in group.open)
        segments = _segments(chunks, keys, seq, chunk, fence, ends)
        parts.append(_scan_segments(segments, keys, group, ends))
    events = _settle(reduce(DataFrame.unionByName, parts), keys, local.rules, with_text)
    return _not_again(events, keys, local.rules, state)


def _not_again(events: DataFrame, keys: list[str], rules: Sequence[Rule], state) -> DataFrame:
    """Without the events of single-match rules that matched before the state
    was saved."""
    if state is None or "found" not in state.columns or not _single(rules):
        return events
    before = state.select(*keys, F.explode(F.split("found", ",")).alias("_id"))
    before = before.select(*keys, F.col("_id").try_cast("int").alias("rule_id")).filter("rule_id IS NOT NULL")
    once = F.col("rule_id").isin([r.rule_id for r in _single(rules)])
    late = events.filter(once).join(before, [*keys, "rule_id"], "left_anti").select(*events.columns)
    return events.filter(~once).unionByName(late)


def _single(rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if "H" in r.flags or "o" in r.flags]


def _by_fence(local: _Local):
    fences = sorted({p.fence for p in local.open if p.max_width is None}, key=str)
    for fence in fences:
        yield fence, local.only(lambda p, f=fence: p.max_width is None and p.fence == f)


def close_streams(
    chunks: DataFrame,
    rules,
    keys: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    chunk: str = "chunk",
    state: DataFrame | None = None,
    with_text: bool = False,
    bucket: int = BUCKET,
) -> DataFrame:
    """The events that streams report when they end: matches that need the end
    of the data, such as those of ``end$``."""
    from patternscan.streaming import rule_tables

    keys = list(keys)
    if (table := rule_tables.as_table(rules)) is not None:
        return rule_tables.close(chunks, table, keys, seq, chunk, state, with_text, bucket)
    local = _Local.of(_stream_rules(rules))
    local = local.only(lambda p: p.looks_right)
    _no_state(local.open, state)
    parts = []
    bounded = local.only(lambda p: p.max_width is not None)
    if bounded.open:
        width = bounded.width + 2  # a final newline and one byte of context
        last = _runs(chunks, keys, seq, chunk, width, bucket, state).totals
        shift = "total - char_length(tail)"
        parts.append(_global(last, keys, bounded, _closing("tail", bounded), shift, "tail"))
    for fence, group in _by_fence(local):
        # a fence byte may be the final newline that ``$`` looks past
        segments = _segments(chunks, keys, seq, chunk, fence, True).filter("last")
        closing = _closing("_view", group)
        parts.append(_global(segments, keys, group, closing, "base", "_view"))
    if not parts:
        columns = T._parse_datatype_string(
            "rule_id int, from_off bigint, to_off bigint, flags int"
            + (", text string" if with_text else "")
        )
        schema = T.StructType([chunks.schema[k] for k in keys] + columns.fields)
        return chunks.sparkSession.createDataFrame([], schema)
    events = _settle(reduce(DataFrame.unionByName, parts), keys, local.rules, with_text)
    return _not_again(events, keys, local.rules, state)


# --------------------------------------------------------------------------
# reset, fork, state


def reset_epochs(
    chunks: DataFrame,
    keys: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    control: str = "control",
) -> DataFrame:
    """Chunks with an ``epoch``: rows whose control is ``reset`` start a new
    one.  Streams are then scanned, and closed, by ``(keys..., epoch)``."""
    is_reset = F.coalesce(F.col(control) == "reset", F.lit(False)).cast("long")
    counted = running_totals(chunks, list(keys), seq, {"epoch": is_reset})
    return counted.filter(F.col(control).isNull())


def fork_streams(
    chunks: DataFrame,
    forks: DataFrame,
    branches: DataFrame,
    rules,
    key: str = "stream_id",
    seq: str = "seq",
    chunk: str = "chunk",
    bucket: int = BUCKET,
) -> DataFrame:
    """Continue one prefix with several suffixes.

    ``forks``: ``branch_id, <key>, fork_seq``; a branch copies the stream as it
    is after chunk ``fork_seq``.  ``branches``: ``branch_id, <seq>, <chunk>``
    with the chunks that follow.  Returns the events after the fork.
    """
    prefix = (
        chunks.join(forks, key)
        .filter(F.col(seq) <= F.col("fork_seq"))
        .select("branch_id", seq, chunk)
    )
    from patternscan.streaming import rule_tables

    if (table := rule_tables.as_table(rules)) is not None:
        bounded = not rule_tables.stream_table(table, False).filter("max_width IS NULL").limit(1).collect()
    else:
        bounded = all(p.max_width is not None for p in _Local.of(_stream_rules(rules)).open)
    if bounded:
        state = export_state(prefix, rules, ("branch_id",), seq, chunk, bucket)
        return scan_stream(branches, rules, ("branch_id",), seq, chunk, state, bucket=bucket)
    # an unbounded rule may reach back through the whole prefix
    start = prefix.groupBy("branch_id").agg(F.sum(F.octet_length(chunk)).alias("_start"))
    last = prefix.groupBy("branch_id").agg((F.max(seq) + 1).alias("_shift"))
    after = branches.join(last, "branch_id", "left").select(
        "branch_id", (F.col(seq) + F.coalesce("_shift", F.lit(0))).alias(seq), chunk
    )
    events = scan_stream(
        prefix.unionByName(after), rules, ("branch_id",), seq, chunk, bucket=bucket
    )
    joined = events.join(start, "branch_id", "left")
    return joined.filter(F.col("to_off") > F.coalesce("_start", F.lit(0))).select(*events.columns)


def export_state(
    chunks: DataFrame,
    rules,
    keys: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    chunk: str = "chunk",
    bucket: int = BUCKET,
) -> DataFrame:
    """Where each stream stands after its last chunk: the bytes a match may
    still begin in, the offset, the next ``seq`` and the size of it all; with
    single-match rules also ``found``, the ids of those that have matched."""
    from patternscan.streaming import rule_tables

    keys = list(keys)
    if (table := rule_tables.as_table(rules)) is not None:
        width, single = rule_tables.stand(chunks, table, keys, seq, chunk, bucket)
    else:
        local = _Local.of(_stream_rules(rules))
        if any(p.max_width is None for p in local.open):
            raise RuleError("the state of an unbounded rule has no fixed size")
        width, single = local.width, _single(local.rules)
    totals = _runs(chunks, keys, seq, chunk, width, bucket, None).totals
    stand = totals.select(
        *keys,
        F.encode("tail", "ISO-8859-1").alias("tail"),
        F.col("total").alias("base"),
        "next_seq",
        (F.char_length("tail") + 16).cast("long").alias("state_bytes"),
    )
    if not single:
        return stand
    seen = scan_stream(chunks, single, keys, seq, chunk, bucket=bucket).groupBy(*keys)
    seen = seen.agg(F.array_join(F.sort_array(F.collect_set("rule_id")).cast("array<string>"), ",").alias("found"))
    return stand.join(seen, keys, "left").withColumn("found", F.coalesce("found", F.lit("")))


# --------------------------------------------------------------------------
# match and find over streams


def stream_match(
    chunks: DataFrame,
    rule,
    keys: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    chunk: str = "chunk",
) -> DataFrame:
    """One row per stream: did the rule match anywhere in it?"""
    keys = list(keys)
    events = scan_stream(chunks, rule, keys, seq, chunk, close=True)
    hit = events.select(*keys).distinct().withColumn("matched", F.lit(True))
    streams = chunks.select(*keys).distinct()
    return streams.join(hit, keys, "left").select(
        *keys, F.coalesce("matched", F.lit(False)).alias("matched")
    )


def stream_find(
    chunks: DataFrame,
    rules,
    n: int = -1,
    keys: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    chunk: str = "chunk",
    with_text: bool = False,
) -> DataFrame:
    """The first ``n`` merged matches of each stream (all if negative), one row
    each; ``with_text`` adds the matched bytes."""
    keys = list(keys)
    from patternscan.streaming import rule_tables

    if (table := rule_tables.as_table(rules)) is not None:
        starts = not rule_tables.stream_table(table, False).filter("NOT _starts").limit(1).collect()
    else:
        starts = all("L" in r.flags for r in _stream_rules(rules))
    attach = with_text and starts
    events = scan_stream(chunks, rules, keys, seq, chunk, with_text=attach, close=True)
    merged = coalesce_events(events, keys)
    if n >= 0:
        merged = limit_events(merged, n, keys).drop("truncated")
    if with_text and not starts:
        merged = stream_text(chunks, merged, keys, seq, chunk)
    return merged


def stream_text(
    chunks: DataFrame,
    events: DataFrame,
    keys: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    chunk: str = "chunk",
    cell: int = 1 << 16,
) -> DataFrame:
    """Adds the bytes between ``from_off`` and ``to_off`` of each event, put
    together from the chunks that hold them.  Chunks and events meet in cells
    of the offset range, so a long stream is spread over tasks."""
    keys = list(keys)
    view = _views(chunks, keys, seq, chunk)
    n = F.char_length("_view").cast("long")
    placed = running_totals(view, keys, "_seq", {"_base": n}, bucket=BUCKET).withColumn("_n", n)

    def cells(lo, hi):
        return F.explode(
            F.sequence(run_of(lo, cell), run_of(hi - 1, cell), F.lit(cell).cast("long"))
        ).alias("_cell")

    have = placed.select(
        *keys, "_base", "_n", "_view", cells(F.col("_base"), F.col("_base") + F.col("_n"))
    )
    want = events.filter("to_off > from_off").select(
        *events.columns, cells(F.col("from_off"), F.col("to_off"))
    )
    lo = F.greatest("from_off", "_base", F.col("_cell"))
    hi = F.least("to_off", F.col("_base") + F.col("_n"), F.col("_cell") + cell)
    pieces = (
        want.join(have, [*keys, "_cell"])
        .withColumn("_lo", lo)
        .filter(F.col("_lo") < hi)
        .withColumn(
            "_piece",
            F.substring(
                "_view", (F.col("_lo") - F.col("_base") + 1).cast("int"), (hi - F.col("_lo")).cast("int")
            ),
        )
    )
    texts = pieces.groupBy(*events.columns).agg(
        F.array_sort(F.collect_list(F.struct("_lo", "_piece"))).alias("_p")
    )
    joined = F.array_join(F.transform("_p", lambda p: p["_piece"]), "")
    return texts.select(
        *events.columns, F.encode(joined, "ISO-8859-1").cast("string").alias("text")
    )
