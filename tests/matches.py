"""Plain versions of what scans return."""

import re

from patternscan.functions.syntax import byte_text, python_flags, python_pattern


def all_ends(rule, text):
    """Every (start, end) the definition gives: an end counts if some start
    makes the text between them match in its place."""
    view = text if "8" in rule.flags else byte_text(text)
    found = []
    for end in range(len(view) + 1):
        rest = len(view) - end
        pattern = re.compile(
            "(?:%s)(?=[\\s\\S]{%d}\\Z)" % (python_pattern(rule), rest), python_flags(rule)
        )
        starts = [s for s in range(end + 1) if pattern.match(view, s)]
        if starts:
            found.append((starts[0] if "L" in rule.flags else 0, end))
    if "8" in rule.flags:
        found = [(len(view[:a].encode()), len(view[:b].encode())) for a, b in found]
    return found[:1] if "H" in rule.flags else found


def by_rule(rows, key):
    got = {}
    for r in rows:
        got.setdefault((r[key], r["rule_id"]), []).append((r["from_off"], r["to_off"]))
    return {k: sorted(v, key=lambda e: e[1]) for k, v in got.items()}
