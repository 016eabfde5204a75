import random
import re

import pytest
from pyspark.sql import functions as F

from patternscan.functions.syntax import LEFTMOST, Rule, capture_spans, prepare, python_flags, python_pattern
from patternscan.operators import captures
from patternscan.operators.captures import scan_captures

# on the JVM: nested, optional and alternative groups, flags, look-around in gaps
PLACED = [
    ("(a)(b)?c", ""), ("x(a(b)(c))y", ""), ("(?:(a)x|b(c))d", ""), ("(a)|(b)", ""), ("(a+?)(b*)c?", ""),
    ("((?:ab)+)(c)??", ""), ("(?:x(a(b)c))?d", ""), ("(A)(?i:(b))", ""), ("(a)b", "i"), ("^(a)(.)", "m"),
    ("(é)(.)", "8"), ("(.)(é)", ""), ("(a)\\b(.)", "s"), ("(?=ab)(a)(b)(?!c)", ""), ("()(a)", ""), ("(?<=x)(a)", ""),
    ("(a)(b|c|)d", ""), ("(a)(b)?c", "H"), ("(?P<one>a)(?:b)", ""), ("(?:(a)|(?:(b)(c)?))x", ""),
]
# in workers
OTHERS = [("(a)+b", ""), ("(a)(b?)?c", ""), ("(a)\\1", ""), ("(?=(a))ab", ""), ("(?>(a))b", ""), ("(|a)|b", ""), ("(a)*", "")]


def plain(rule, text):
    view = text if "8" in rule.flags else text.encode().decode("latin-1")
    found = []

    def at(i):
        return len(view[:i].encode()) if "8" in rule.flags else i

    for m in re.compile(python_pattern(rule), python_flags(rule)).finditer(view):
        groups = []
        for g in range(m.re.groups + 1):
            raw = (m.group(g) or "").encode("utf-8" if "8" in rule.flags else "latin-1")
            spot = (at(m.start(g)), at(m.end(g)), raw.decode("utf-8", "replace"))
            groups.append(spot if m.start(g) >= 0 else None)
        found.append((at(m.start()), at(m.end()), groups))
    return found[:1] if "H" in rule.flags else found


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    texts = ["", None, "abc", "é", "xaé", "abx" * 300]
    texts += ["".join(rng.choices("aabbccdxyAB é\n", k=rng.randrange(60))) for _ in range(60)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").cache()


def listed(df):
    got = {}
    for r in df.collect():
        groups = [tuple(c) if c else None for c in r["captures"]]
        got.setdefault((r["doc_id"], r["rule_id"]), []).append((r["from_off"], r["to_off"], groups))
    return {k: sorted(v, key=lambda e: e[:2]) for k, v in got.items()}


def expected(rows, rules):
    want = {}
    for r in rows.collect():
        for rule in rules:
            if r["text"] is not None and (found := plain(rule, r["text"])):
                want[r["doc_id"], rule.rule_id] = found
    return want


def test_groups_are_placed_on_the_jvm(rows):
    rules = [Rule(i, e, f, kind=LEFTMOST) for i, (e, f) in enumerate(PLACED)]
    assert all(capture_spans(prepare(r)) for r in rules)
    found = scan_captures(rows, rules)
    assert "MapInPandas" not in found._jdf.queryExecution().toString()
    assert listed(found) == expected(rows, rules)


def test_other_groups_go_to_workers(rows):
    rules = [Rule(i, e, f, kind=LEFTMOST) for i, (e, f) in enumerate([*OTHERS, *PLACED[:3]])]
    for r in rules[: len(OTHERS)]:
        p = prepare(r)
        assert p.nullable or p.stack_risk or capture_spans(p) is None
    assert listed(scan_captures(rows, rules)) == expected(rows, rules)


def test_bounds_hold_for_captures(rows):
    rule = Rule(1, "(a)(b)?", "", {"min_offset": 5, "max_offset": 20, "min_length": 2}, LEFTMOST)
    got = listed(scan_captures(rows, rule))
    want = {}
    for key, found in expected(rows, [Rule(1, "(a)(b)?", kind=LEFTMOST)]).items():
        if kept := [e for e in found if 5 <= e[1] <= 20 and e[1] - e[0] >= 2]:
            want[key] = kept
    assert got == want and want


def test_captures_of_a_rules_table(spark, rows, monkeypatch):
    rules = [Rule(i, e, f, kind=LEFTMOST) for i, (e, f) in enumerate([*PLACED, *OTHERS])]
    rules += [Rule(100 + i, f"(a)({'abc'[i % 3]}){i}?", kind=LEFTMOST) for i in range(120)]
    table = spark.createDataFrame(
        [(r.rule_id, r.expression, r.flags, None, r.kind) for r in rules],
        "rule_id int, expression string, flags string, ext map<string,bigint>, kind string",
    )
    assert listed(scan_captures(rows, table)) == expected(rows, rules)
    raw = rows.withColumn("text", F.encode("text", "utf-8"))
    plain_bytes = [r for r in rules if "8" not in r.flags]
    got = listed(scan_captures(raw, table.filter("flags NOT LIKE '%8%'")))
    assert got == expected(rows, plain_bytes)
