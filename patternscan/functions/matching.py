"""Rule matching inside a Python worker.

Used only where the JVM functions cannot express the result: capture offsets,
empty matches, rules that would recurse too deeply, and live stream state.  It
mirrors the expressions of ``operators.scan``: ends are starts of the reversed
rule in the reversed text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from patternscan.functions.syntax import (
    LEFTMOST,
    Prepared,
    Rule,
    python_flags,
    python_pattern,
)


@dataclass(frozen=True)
class Matcher:
    """Compiled patterns of one rule; built once per task."""

    prepared: Prepared
    forward: re.Pattern
    backward: re.Pattern | None
    anchored: tuple[re.Pattern, ...]

    @staticmethod
    def of(p: Prepared, eod: bool = True) -> Matcher:
        flags = python_flags(p.rule)
        text = python_pattern(p.rule, eod=eod)
        if p.rule.kind == LEFTMOST:
            return Matcher(p, re.compile(text, flags), None, ())
        back = python_pattern(p.rule, backward=True, eod=eod)
        return Matcher(
            p,
            re.compile(text, flags),
            re.compile(f"(?=({back}))" if p.one_variable else f"(?={back})", flags),
            tuple(re.compile(text + r"(?=[\s\S]{%d}\Z)" % k, flags) for k in range(3)),
        )

    @property
    def rule(self) -> Rule:
        return self.prepared.rule

    def may_match(self, subject: str) -> bool:
        """A cheap test first: the text every match contains."""
        return self.prepared.literal is None or self.prepared.literal in subject

    def ends(self, view: str, after: int = 0):
        """(start, end) of every event with ``end > after``, by ascending end."""
        p, n, found = self.prepared, len(view), []
        for m in self.backward.finditer(view[::-1]):
            end = n - m.start()
            if end < after or (end == after and after > 0):
                break
            if not p.wants_start or p.anchored:
                start = 0
            elif p.fixed_width:
                start = end - p.min_width
            elif p.one_variable:
                start = end - len(m.group(1))
            else:
                start = self._leftmost_start(view, n, end)
            found.append((start, end))
        found.reverse()
        return found

    def _leftmost_start(self, view: str, n: int, end: int) -> int:
        width = self.prepared.max_width
        lo = 0 if width is None else max(0, end - width - 1)
        k = min(2, n - end)
        return lo + self.anchored[k].search(view[lo : end + k]).start()


def bounded(rule: Rule, events):
    """Offset bounds, hidden starts and the single-match flag of a rule."""
    ext = rule.ext
    low, high = ext.get("min_offset"), ext.get("max_offset")
    shortest = ext.get("min_length")
    shown = "L" in rule.flags or rule.kind == LEFTMOST
    for start, end in events:
        if low is not None and end < low:
            continue
        if high is not None and end > high:
            continue
        if shortest is not None and end - start < shortest:
            continue
        yield (start if shown else 0), end
        if "H" in rule.flags:
            return


def byte_offsets(rule: Rule, text: str, events):
    """Character offsets of a UTF-8 rule as byte offsets."""
    if "8" not in rule.flags or text.isascii():
        return events
    at = {0: 0}
    total = 0
    for i, c in enumerate(text, 1):
        total += len(c.encode("utf-8"))
        at[i] = total
    return [(at[a], at[b]) for a, b in events]
