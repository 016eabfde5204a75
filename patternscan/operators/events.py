"""Operators over the events table ``keys..., rule_id, from_off, to_off, flags``.

Where a hot key (one long stream) could hold much of the table, the work is
cut into (key, offset slot) groups or pre-aggregated; no window ever needs all
events of a key in one task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import groupby, islice
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from patternscan.functions.syntax import RuleError
from patternscan.plans.shipping import ship_package

SLOT = 1 << 20  # bytes of text whose events are handled together
FINE_SLOT = 1 << 12  # the same, where a slot is only counted or numbered
TASK_CUT = 1000  # rows per key up to which the engine cuts a task's own rows

MAX_FORMULAS = 256  # of one projection; more take several

# 2^16 and 2^32 bytes; large keeps every start.
HORIZONS = {"small": 1 << 16, "medium": 1 << 32, "large": None}


def _order() -> Column:
    """The total order of events within one scan."""
    return F.struct("to_off", "rule_id", "from_off")


# --------------------------------------------------------------------------
# merging, first event, starts, offsets


def coalesce_events(
    events: DataFrame, keys: Sequence[str] = ("doc_id",), scope: str = "scan"
) -> DataFrame:
    """Merge an event into the previous one when rule and start are equal and
    the end grows; the last end of a run stays.

    ``scope='scan'`` looks at the previous event of the whole scan, so events
    of another rule in between prevent merging; ``scope='rule'`` looks at the
    previous event of the same rule.
    """
    if scope not in ("scan", "rule"):
        raise ValueError(f"unknown scope {scope!r}")
    keys = list(keys)
    group = keys + (["rule_id"] if scope == "rule" else [])
    order = ("to_off", "rule_id", "from_off")
    slot = F.col("to_off") - F.pmod("to_off", F.lit(SLOT))
    here = Window.partitionBy(*group, "_slot").orderBy(*order)

    def grows(nxt: Column) -> Column:
        """The next event continues this one."""
        return F.coalesce(
            (nxt["rule_id"] == F.col("rule_id"))
            & (nxt["from_off"] == F.col("from_off"))
            & (nxt["to_off"] > F.col("to_off")),
            F.lit(False),
        )

    # First within slots of the text; the first and last events of a slot stay
    # to meet their neighbours in other slots, which are few per key.
    inside = (
        events.withColumn("_slot", slot)
        .withColumn("_next", F.lead(_order()).over(here))
        .withColumn("_first", F.lag("to_off").over(here).isNull())
        .withColumn("_merged", grows(F.col("_next")))
        .filter("NOT _merged OR _first")
        .withColumn("_last", F.col("_next").isNull())
    )
    edge = F.when(~(F.col("_first") | F.col("_last")), F.col("_slot"))
    across = Window.partitionBy(*group, "_edge").orderBy(*order)
    met = inside.withColumn("_edge", edge).withColumn("_next", F.lead(_order()).over(across))
    merged = F.when(F.col("_last"), grows(F.col("_next"))).otherwise(F.col("_merged"))
    return met.filter(~merged).select(*events.columns)


def single_match(events: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """First event of each rule in each scan."""
    first = events.groupBy(*keys, "rule_id").agg(
        F.min(F.struct("to_off", "from_off", "flags")).alias("_e")
    )
    return first.select(*keys, "rule_id", "_e.from_off", "_e.to_off", "_e.flags")


def start_of_match(events: DataFrame, leftmost: Column | bool) -> DataFrame:
    """Hide the start (0) of events whose rule does not track it."""
    flag = F.lit(leftmost) if isinstance(leftmost, bool) else leftmost
    return events.withColumn(
        "from_off", F.when(flag, F.col("from_off")).otherwise(F.lit(0).cast("long"))
    )


def som_horizon(events: DataFrame, horizon: str = "small") -> DataFrame:
    """Forget starts further back than the horizon of a stream scan."""
    if horizon not in HORIZONS:
        raise ValueError(f"unknown horizon {horizon!r}")
    limit = HORIZONS[horizon]
    if limit is None:
        return events
    near = F.col("to_off") - F.col("from_off") <= F.lit(limit)
    return events.withColumn("from_off", F.when(near, F.col("from_off")))


def offset_filter(
    events: DataFrame,
    min_offset: int | None = None,
    max_offset: int | None = None,
    min_length: int | None = None,
) -> DataFrame:
    """Keep events whose end and length lie within bounds."""
    if min_offset is not None:
        events = events.filter(F.col("to_off") >= min_offset)
    if max_offset is not None:
        events = events.filter(F.col("to_off") <= max_offset)
    if min_length is not None:
        events = events.filter(F.col("to_off") - F.col("from_off") >= min_length)
    return events


# --------------------------------------------------------------------------
# combinations


_FORMULA = re.compile(r"\s*(?:(\d+)|([()&|!]))")


def parse_formula(text: str) -> list:
    """A formula of rule ids, ``!``, ``&``, ``|`` and brackets as nested lists."""
    tokens, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = _FORMULA.match(text, at)
        if not m:
            raise RuleError(f"Unknown character at index {at}.")
        tokens.append(int(m[1]) if m[1] else m[2])
        at = m.end()

    def operand():
        if not tokens:
            raise RuleError("Not enough operand.")
        t = tokens.pop(0)
        if t == "!":
            return ["!", operand()]
        if t == "(":
            inner = either()
            if not tokens or tokens.pop(0) != ")":
                raise RuleError("Not enough right parentheses.")
            return inner
        if isinstance(t, int):
            return ["id", t]
        raise RuleError("Not enough operand.")

    def both():
        left = operand()
        while tokens and tokens[0] == "&":
            tokens.pop(0)
            left = ["&", left, operand()]
        return left

    def either():
        left = both()
        while tokens and tokens[0] == "|":
            tokens.pop(0)
            left = ["|", left, both()]
        return left

    tree = either()
    if tokens:
        raise RuleError("Not enough left parentheses.")
    return tree


def _operands(tree) -> set[int]:
    if tree[0] == "id":
        return {tree[1]}
    return set().union(*(_operands(x) for x in tree[1:]))


def _truth(tree, seen: Callable[[int], Column]) -> Column:
    op = tree[0]
    if op == "id":
        return seen(tree[1])
    if op == "!":
        return ~_truth(tree[1], seen)
    left, right = _truth(tree[1], seen), _truth(tree[2], seen)
    return left & right if op == "&" else left | right


def combine_rules(
    events: DataFrame,
    formulas: dict[int, str],
    keys: Sequence[str] = ("doc_id",),
    blocks: DataFrame | None = None,
) -> DataFrame:
    """Events of formulas over the rules seen so far, at the end offset where
    each first becomes true.

    A formula can only change at the first event of one of its operands, so
    those few offsets, found by a plain aggregate, are all that is kept per
    key.  With ``blocks`` (``keys..., n_bytes``) formulas made of negations are
    also reported, at the end of a block in which no operand ever matched.
    """
    keys = list(keys)
    if len(formulas) > MAX_FORMULAS:
        listed = list(formulas.items())
        parts = [
            combine_rules(events, dict(listed[i : i + MAX_FORMULAS]), keys, blocks)
            for i in range(0, len(listed), MAX_FORMULAS)
        ]
        return reduce(DataFrame.unionByName, parts)
    trees = {rule_id: parse_formula(text) for rule_id, text in formulas.items()}
    operands = sorted(set().union(*(_operands(t) for t in trees.values())))
    firsts = (
        events.filter(F.col("rule_id").isin(operands))
        .groupBy(*keys)
        .agg(
            *(F.min(F.when(F.col("rule_id") == k, F.col("to_off"))).alias(f"_{k}") for k in operands)
        )
    )
    if blocks is not None:
        firsts = blocks.select(*keys, "n_bytes").join(firsts, keys, "left")

    def seen_by(offset: Column) -> Callable[[int], Column]:
        return lambda k: F.coalesce(F.col(f"_{k}") <= offset, F.lit(False))

    found = []
    for rule_id, tree in trees.items():
        mine = sorted(_operands(tree))
        true_at = [
            F.when(_truth(tree, seen_by(F.col(f"_{k}"))), F.col(f"_{k}")) for k in mine
        ]
        # nothing seen at all: true only if the formula holds on nothing
        first = F.array_min(F.array(*true_at))
        if blocks is not None:
            none_seen = _truth(tree, lambda k: F.lit(False))
            silent = F.lit(True)
            for k in mine:
                silent = silent & F.col(f"_{k}").isNull()
            first = F.when(silent & none_seen, F.col("n_bytes")).otherwise(first)
        found.append(
            F.struct(
                F.lit(rule_id).cast("int").alias("rule_id"), first.cast("long").alias("to_off")
            )
        )
    return (
        firsts.select(*keys, F.explode(F.array(*found)).alias("e"))
        .filter("e.to_off IS NOT NULL")
        .select(
            *keys,
            F.col("e.rule_id").alias("rule_id"),
            F.lit(0).cast("long").alias("from_off"),
            F.col("e.to_off").alias("to_off"),
            F.lit(0).alias("flags"),
        )
    )


def combination_formulas(rules) -> dict[int, str]:
    """Formulas (flag ``C``) of a list of rules or of a rules table."""
    if isinstance(rules, DataFrame):
        rows = rules.filter(F.contains(F.col("flags"), F.lit("C"))).select("rule_id", "expression")
        return {r["rule_id"]: r["expression"] for r in rows.collect()}
    return {r.rule_id: r.expression for r in rules if "C" in r.flags}


def drop_quiet(events: DataFrame, rules) -> DataFrame:
    """Hide events of quiet rules (flag ``Q``)."""
    if isinstance(rules, DataFrame):
        quiet = rules.filter(F.contains(F.col("flags"), F.lit("Q"))).select("rule_id").distinct()
        # the planner broadcasts the ids when they are few
        return events.join(quiet, "rule_id", "left_anti").select(*events.columns)
    ids = [r.rule_id for r in rules if "Q" in r.flags]
    return events.filter(~F.col("rule_id").isin(ids)) if ids else events


# --------------------------------------------------------------------------
# limits and early stops


def limit_events(
    events: DataFrame, n: int, keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """At most ``n`` events per scan, with ``truncated`` set where more existed.

    Tasks cut their own rows to ``n + 1`` per key before the shuffle, so a hot
    key costs no more than any other.  The engine does so up to ``TASK_CUT``
    rows; for larger ``n`` the events of each offset slot are counted first, and
    slots that begin beyond the limit are left out.  That reads ``events`` twice.
    """
    keys = list(keys)
    if n >= TASK_CUT:
        events = _first_slots(events, n, keys)
    by_key = Window.partitionBy(*keys).orderBy("to_off", "rule_id", "from_off")
    kept = events.withColumn("_rn", F.row_number().over(by_key)).filter(F.col("_rn") <= n + 1)
    all_of_key = Window.partitionBy(*keys)
    marked = kept.withColumn("truncated", F.max("_rn").over(all_of_key) > n)
    return marked.filter(F.col("_rn") <= n).select(*events.columns, "truncated")


def _slots(events: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, _slot, _n, _before``: events of each slot, and of the slots before it."""
    counted = events.groupBy(*keys, _fine_slot().alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")))


def _fine_slot() -> Column:
    return F.expr(f"to_off DIV {FINE_SLOT}")


def _with_slots(events: DataFrame, slots: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Events joined with their slot; null keys are equal."""
    placed = events.withColumn("_slot", _fine_slot())
    named = slots.select("_n", "_before", *(F.col(c).alias(f"_k_{c}") for c in [*keys, "_slot"]))
    same = F.lit(True)
    for c in [*keys, "_slot"]:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return placed.join(named, same, how)


def _first_slots(events: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """The events up to the slot that holds number ``n + 1`` of a key."""
    begun = _slots(events, keys).filter(F.col("_before") <= n)
    return _with_slots(events, begun, keys, "left_semi").select(*events.columns)


def stop_after(
    events: DataFrame, stop: Column, keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """End each scan with the first event for which ``stop`` is true.

    ``events`` is read twice (once for the stops alone); write it out first if
    it comes straight from an expensive scan.  A hot key is only ever joined,
    which the engine can split.
    """
    keys = list(keys)
    stops = events.filter(stop).groupBy(*keys).agg(F.min(_order()).alias("_stop"))
    joined = events.join(stops, keys, "left")
    return joined.filter(F.col("_stop").isNull() | (_order() <= F.col("_stop"))).select(
        *events.columns
    )


def skip_after(
    events: DataFrame, k: int, keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Drop a rule's events after its ``k``-th in each scan."""
    by_rule = Window.partitionBy(*keys, "rule_id").orderBy("to_off", "from_off")
    ranked = events.withColumn("_rn", F.row_number().over(by_rule))
    return ranked.filter(F.col("_rn") <= k).select(*events.columns)


# --------------------------------------------------------------------------
# handlers, records, counts


def apply_handler(
    events: DataFrame,
    handler: Callable,
    schema: str,
    keys: Sequence[str] = ("doc_id",),
    context=None,
) -> DataFrame:
    """Run user code over the ordered events of each scan.

    ``handler(key, events, context)`` gets a pandas frame sorted by
    (to, rule, from) and yields output tuples.  ``context`` is broadcast.  The
    events of a scan are in one task at once, as for the handler they must be:
    keys are blocks, or streams whose events were limited or merged before.
    """
    ship_package(events.sparkSession)
    shared = events.sparkSession.sparkContext.broadcast(context)
    names = [f.split()[0].split(":")[0] for f in schema.split(",")]

    def run(key, pdf):
        import pandas as pd

        ordered = pdf.sort_values(["to_off", "rule_id", "from_off"])
        return pd.DataFrame(list(handler(key, ordered, shared.value)), columns=names)

    return events.groupBy(*keys).applyInPandas(run, schema)


def apply_handler_batches(
    events: DataFrame,
    handler: Callable,
    schema: str,
    keys: Sequence[str] = ("doc_id",),
    context=None,
) -> DataFrame:
    """Run user code over the ordered events of each scan, a batch at a time.

    ``handler(key, batches, context)`` gets an iterator of pandas frames, by
    (to, rule, from) across all of them, and yields output tuples.  When it
    returns before the end, the rest of the scan's events are passed over.  The
    events of a scan go through one task, which sorts them (on disk if need be)
    and holds ``spark.sql.execution.arrow.maxRecordsPerBatch`` of them at once.
    """
    ship_package(events.sparkSession)
    shared = events.sparkSession.sparkContext.broadcast(context)
    columns = T.StructType.fromDDL(schema)
    keys = list(keys)
    dealt = events.repartition(*keys) if keys else events.coalesce(1)

    def run(batches):
        arrow = to_arrow_schema(columns)
        for key, pieces in groupby(_by_key(batches, keys), itemgetter(0)):
            rows = handler(key, (piece.to_pandas() for _, piece in pieces), shared.value)
            yield from _arrow_rows(rows, arrow)

    ordered = dealt.sortWithinPartitions(*keys, "to_off", "rule_id", "from_off")
    return ordered.mapInArrow(run, columns)


def _by_key(batches, keys: list[str]):
    """Arrow batches sorted by key, cut where the key changes: (key, piece)."""
    import pyarrow.compute as pc

    for batch in batches:
        n = batch.num_rows
        cuts = set()
        for name in keys:
            column = batch.column(batch.schema.get_field_index(name))
            ahead, behind = column.slice(1), column.slice(0, max(0, n - 1))
            differ = pc.fill_null(pc.not_equal(ahead, behind), True)
            both_null = pc.and_(ahead.is_null(), behind.is_null())
            changed = pc.and_(differ, pc.invert(both_null))
            cuts.update((changed.to_numpy(zero_copy_only=False).nonzero()[0] + 1).tolist())
        edges = [0, *sorted(cuts), n]
        for start, end in zip(edges, edges[1:]):
            if start < end:
                piece = batch.slice(start, end - start)
                key = tuple(piece.column(piece.schema.get_field_index(c))[0].as_py() for c in keys)
                yield key, piece


def _arrow_rows(rows, schema, size: int = 4096):
    """Tuples as Arrow batches."""
    import pyarrow as pa

    rows = iter(rows)
    while part := list(islice(rows, size)):
        columns = [pa.array(values, field.type) for values, field in zip(zip(*part), schema)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def record_events(
    events: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    blocks: DataFrame | None = None,
) -> DataFrame:
    """All events of a scan as one ordered array, and whether there were any.

    With ``blocks`` scans without events are listed too.
    """
    keys = list(keys)
    recorded = events.groupBy(*keys).agg(
        F.array_sort(
            F.collect_list(F.struct("to_off", "rule_id", "from_off", "flags"))
        ).alias("events")
    )
    if blocks is not None:
        recorded = blocks.select(*keys).join(recorded, keys, "left")
    empty = F.array().cast(recorded.schema["events"].dataType)
    return recorded.select(
        *keys,
        F.coalesce("events", empty).alias("events"),
        F.coalesce(F.size("events") > 0, F.lit(False)).alias("matched"),
    )


def record_segments(
    events: DataFrame, keys: Sequence[str] = ("doc_id",), size: int = 4096
) -> DataFrame:
    """All events of a scan as ordered arrays of ``size`` events: ``keys...,
    segment, events``, segments numbered from 0, the last one shorter.

    An array is a segment and never a scan: events are numbered by the counts of
    the offset slots before theirs and their place in their slot.
    """
    keys = list(keys)
    placed = _with_slots(events, _slots(events, keys), keys, "inner")
    in_slot = Window.partitionBy(*keys, "_slot").orderBy("to_off", "rule_id", "from_off", "flags")
    at = F.col("_before") + F.row_number().over(in_slot) - 1
    numbered = placed.withColumn("_at", at).withColumn("segment", F.floor(F.col("_at") / size))
    event = F.struct("_at", F.struct("to_off", "rule_id", "from_off", "flags").alias("e"))
    segments = numbered.groupBy(*keys, "segment").agg(F.array_sort(F.collect_list(event)).alias("_events"))
    return segments.select(*keys, "segment", F.transform("_events", lambda x: x["e"]).alias("events"))


def count_events(events: DataFrame, by: Sequence[str] = ("rule_id",)) -> DataFrame:
    """Number of events per rule, per scan or in total (``by=()``)."""
    if not by:
        return events.agg(F.count(F.lit(1)).alias("n_matches"))
    return events.groupBy(*by).agg(F.count(F.lit(1)).alias("n_matches"))
