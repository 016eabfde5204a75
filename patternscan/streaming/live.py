"""Streams in motion: the batch stream scan on a Structured Streaming source.

State per stream is bounded by the rules, not by the stream: the last bytes a
match may still begin in, the offset, the next sequence number, and chunks that
arrived before their turn.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from patternscan.functions.matching import Matcher, bounded
from patternscan.functions.syntax import Prepared, Rule, RuleError, prepare
from patternscan.plans.shipping import ship_package
from patternscan.streaming.chunks import _Local, _stream_rules

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
POSITION = "tail binary, base bigint, next_seq bigint, found string"
PENDING_KEY, PENDING = "seq bigint", "chunk binary, control string"


class _Scanner:
    """Compiled rules of one task and the step from one chunk to the next."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = list(rules)
        local = _Local.of(rules)
        self.open = [Matcher.of(p, eod=False) for p in local.open]
        self.closed = [Matcher.of(p, eod=True) for p in local.closed]
        self.width = max(p.max_width for p in local.open) + 1

    def _report(self, i, events, found: set[int]):
        """Global events of rule ``i`` that its bounds and flags let through."""
        r = self.rules[i]
        if "H" in r.flags and r.rule_id in found:
            return
        plain = replace(r, ext={k: v for k, v in r.ext.items() if k != "min_length"})
        for a, b in bounded(plain, events):
            if "H" in r.flags:
                found.add(r.rule_id)
            yield r.rule_id, a, b, 0

    def _kept(self, m: Matcher, events):
        shortest = m.rule.ext.get("min_length")
        return [e for e in events if shortest is None or e[1] - e[0] >= shortest]

    def chunk(self, tail: str, base: int, chunk: str, found: set[int]):
        """Events of the bytes of ``chunk``, which follow ``tail``."""
        view, edge = tail + chunk, len(tail)
        shift = base - edge
        for i, m in enumerate(self.open):
            if m.prepared.looks_right and tail:
                # an end at the edge may have had to wait for this byte
                events = m.ends(view, edge - 1) if edge > 0 else m.ends(view)
                before = {e for e in m.ends(tail, edge - 1) if e[1] == edge}
                events = [e for e in events if e[1] > edge or e not in before]
            else:
                events = [e for e in m.ends(view, edge) if e[1] > edge]
            shifted = [(a + shift, b + shift) for a, b in self._kept(m, events)]
            yield from self._report(i, shifted, found)

    def close(self, tail: str, base: int, found: set[int]):
        """Events that need the end of the data."""
        n, shift = len(tail), base - len(tail)
        for i, (o, c) in enumerate(zip(self.open, self.closed, strict=True)):
            if not o.prepared.looks_right:
                continue
            before = set(o.ends(tail))
            late = [e for e in c.ends(tail) if e[1] >= n - 1 and e not in before]
            shifted = [(a + shift, b + shift) for a, b in self._kept(c, late)]
            yield from self._report(i, shifted, found)


# what a chunk that could not be scanned is reported as
LOST, LOST_FLAG = -1, 1


class StreamScan(StatefulProcessor):
    """Scans each stream in order of ``seq``.

    Control rows: ``close`` and ``reset`` report the events of the end of the
    data; after ``close`` the state is gone, after ``reset`` the next chunk is
    at offset 0 (its ``seq`` goes on).
    """

    def __init__(self, rules: Sequence[Rule], keys: Sequence[str], idle_ms: int | None):
        self.rules, self.keys, self.idle_ms = list(rules), list(keys), idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.scanner = _Scanner(self.rules)
        self.position = handle.getValueState("position", POSITION)
        self.pending = handle.getMapState("pending", PENDING_KEY, PENDING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        tail, base, next_seq, found = self._load()
        waiting = {}
        if self.pending.exists():
            waiting = {k[0]: (v[0], v[1]) for k, v in self.pending.iterator()}
        stored = set(waiting)
        for pdf in rows:
            for seq, chunk, control in zip(pdf["seq"], pdf["chunk"], pdf["control"], strict=True):
                if seq >= next_seq:
                    waiting[int(seq)] = (bytes(chunk or b""), control)
        out, closed = [], False
        while next_seq in waiting and not closed:
            chunk, control = waiting.pop(next_seq)
            next_seq += 1
            if chunk:
                text = chunk.decode("latin-1")
                out.extend(self.scanner.chunk(tail, base, text, found))
                tail, base = (tail + text)[-self.scanner.width :], base + len(text)
            if control in ("close", "reset"):
                out.extend(self.scanner.close(tail, base, found))
                closed = control == "close"
                if closed:
                    out.extend(self._lost(waiting, base))
                tail, base, found = "", 0, set()
        if closed:
            self._clear()
        else:
            for seq in stored - set(waiting):
                self.pending.removeKey((seq,))
            for seq in set(waiting) - stored:
                self.pending.updateValue((seq,), waiting[seq])
            self._save(tail, base, next_seq, found)
            if self.idle_ms is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                now = timerValues.getCurrentProcessingTimeInMs()
                self.handle.registerTimer(now + self.idle_ms)
        yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """An idle stream is closed."""
        tail, base, _, found = self._load()
        out = list(self.scanner.close(tail, base, found))
        if self.pending.exists():
            out.extend(self._lost({k[0] for k, _ in self.pending.iterator()}, base))
        self._clear()
        yield self._frame(key, out)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        row = initialState.iloc[0]
        tail = bytes(row["tail"]).decode("latin-1")
        found = {int(i) for i in (row["found"] or "").split(",") if i}
        self._save(tail, int(row["base"]), int(row["next_seq"]), found)

    def close(self) -> None:
        pass

    def _load(self):
        if not self.position.exists():
            return "", 0, 0, set()
        tail, base, next_seq, found = self.position.get()
        return (
            bytes(tail).decode("latin-1"),
            base,
            next_seq,
            {int(i) for i in found.split(",") if i},
        )

    def _save(self, tail: str, base: int, next_seq: int, found: set[int]) -> None:
        seen = ",".join(str(i) for i in sorted(found))
        self.position.update((tail.encode("latin-1"), base, next_seq, seen))

    def _lost(self, waiting, base: int) -> list[tuple]:
        """A row for each chunk that still waited for an earlier one."""
        return [(LOST, base, base, LOST_FLAG)] * len(waiting)

    def _clear(self) -> None:
        self.position.clear()
        self.pending.clear()

    def _frame(self, key, out) -> pd.DataFrame:
        names = [*self.keys, "rule_id", "from_off", "to_off", "flags"]
        return pd.DataFrame([(*key, *e) for e in out], columns=names)


def scan_stream_live(
    chunks: DataFrame,
    rules,
    keys: Sequence[str] = ("stream_id",),
    seq: str = "seq",
    chunk: str = "chunk",
    control: str | None = None,
    initial_state: DataFrame | None = None,
    idle_ms: int | None = None,
) -> DataFrame:
    """``scan_stream`` on a streaming DataFrame of chunks.

    ``seq`` counts the chunks of a stream from 0 without gaps; chunks may
    arrive in any order.  ``control`` names a column with ``close`` or
    ``reset``; a stream that is idle for ``idle_ms`` is closed.  Chunks that wait
    for an earlier one when their stream closes cannot be scanned: each gives a
    row with ``rule_id`` -1 and ``flags`` 1 at the offset that was reached.
    ``initial_state`` comes from ``export_state``.  The session must use the
    RocksDB state store (``STATE_STORE``).
    """
    keys, listed = list(keys), _stream_rules(rules)
    wide = [prepare(r, eod=False) for r in listed]
    _need_width(wide)
    ship_package(chunks.sparkSession)
    mark = F.col(control) if control else F.lit(None)
    prepared = chunks.select(
        *keys,
        F.col(seq).cast("long").alias("seq"),
        F.col(chunk).cast("binary").alias("chunk"),
        mark.cast("string").alias("control"),
    )
    tail = T._parse_datatype_string("rule_id int, from_off bigint, to_off bigint, flags int")
    schema = T.StructType([chunks.schema[k] for k in keys] + tail.fields)
    start = None
    if initial_state is not None:
        found = "found" if "found" in initial_state.columns else F.lit("").alias("found")
        start = initial_state.select(*keys, "tail", "base", "next_seq", found).groupBy(*keys)
    return prepared.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=StreamScan(listed, keys, idle_ms),
        outputStructType=schema,
        outputMode="append",
        timeMode="none" if idle_ms is None else "processingTime",
        initialState=start,
    )


def export_live_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Where the streams of a live scan stand, read from its checkpoint, in the
    shape of ``export_state``: it can seed a batch or another live scan."""
    stored = (
        spark.read.format("statestore").option("stateVarName", "position").load(checkpoint)
    )
    return stored.select(
        "key.*",
        "value.tail",
        "value.base",
        "value.next_seq",
        (F.octet_length("value.tail") + 16).cast("long").alias("state_bytes"),
        "value.found",
    )


def _need_width(prepared: Sequence[Prepared]) -> None:
    for p in prepared:
        if p.max_width is None:
            raise RuleError(f"rule {p.rule_id} is unbounded and would need unbounded state")
