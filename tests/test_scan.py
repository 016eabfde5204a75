import random
import re

import pytest
from matches import all_ends, by_rule

from patternscan.functions.syntax import (
    LEFTMOST,
    LITERAL,
    Rule,
    byte_text,
    python_flags,
    python_pattern,
)
from patternscan.operators import scan
from patternscan.operators.approx import scan_edit_distance, scan_hamming_distance
from patternscan.operators.captures import group_texts, scan_captures
from patternscan.operators.literals import scan_dictionary, scan_literals
from patternscan.operators.prefilter import prefilter_verify
from patternscan.plans.ruleset import RULES_SCHEMA
from patternscan.plans import ruleset


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")


def spans(df):
    return sorted((r["from_off"], r["to_off"]) for r in df.collect())


def rule_table(spark, rules):
    rows = [(r.rule_id, r.expression, r.flags, 0, None, r.kind) for r in rules]
    return spark.createDataFrame(rows, RULES_SCHEMA)


DIGITS = Rule(0, r"\d+", "L")


@pytest.mark.parametrize(
    "rule, text, expected",
    [
        (DIGITS, "abc123def456", [(3, 4), (3, 5), (3, 6), (9, 10), (9, 11), (9, 12)]),
        (Rule(0, "foo(bar)+", "L"), "hello foobarbar!", [(6, 12), (6, 15)]),
        (Rule(0, "test"), "abctestdef", [(0, 7)]),
        (Rule(0, "test"), "abcdef", []),
        (Rule(0, "test"), "", []),
    ],
)
def test_all_ends(spark, rule, text, expected):
    assert spans(scan.scan_events(texts(spark, text), rule)) == expected


def test_null_blocks(spark):
    df = texts(spark, None, "test")
    assert scan.scan_events(df, "test").count() == 1
    assert [r["doc_id"] for r in scan.null_blocks(df).collect()] == [0]
    with pytest.raises(Exception, match="block is NULL"):
        scan.scan_events(df, "test", strict=True).collect()


def test_binary_payloads(spark):
    df = spark.createDataFrame([(0, bytearray(b"\xff\x00ab\xfeab"))], "doc_id long, text binary")
    rules = [Rule(1, "ab", "L"), Rule(2, r"\xff.", "L"), Rule(3, "[^a]b", "L")]
    found = sorted((r["rule_id"], r["from_off"], r["to_off"]) for r in scan.scan_events(df, rules).collect())
    assert found == [(1, 2, 4), (1, 5, 7), (2, 0, 2)]
    assert sorted(r["rule_id"] for r in scan.match_rules(df, rules).collect()) == [1, 2]


ALL_ENDS_RULES = [
    (r"\d+", "L"), ("ab{1,3}", "L"), ("a.b", "L"), ("a.b", "sL"), (r"\bab", "L"),
    (r"ab?\b", "L"), ("^a", "mL"), ("b$", "L"), ("[bc]$", "mL"), ("(?:a|ab)(?:c|bc)?", "L"),
    ("a+b?", "L"), (r"\ba[bc]{0,2}\b", "L"), (r"(?:ab\b|c)", "L"), ("a*", "VL"),
    ("(a|bc)+", "L"), ("a.*c", "sL"), ("^", "V"), ("a[^b]*c", ""), ("ab", "iL"), ("é", "L"),
    (".", "8L"), ("[^a]b", "8L"), ("a$", "mHL"), (r"\Bb", "L"), (r"a\Z", "L"), (r"b\z", "L"),
    ("a*?b+", "L"), ("^a((c?[ab]+)*)c", "L"), ("(?:a?(bc)+)+", "L"), ("(1?a+)*b", ""), (r"\w+", "WL"), (r"[\w]b", "8WiL"), ("AB|ca", "i"), ("^a[bc]+", "L"), ("(?i:A)b", "L"),
]


def random_texts(seed, n, size, alphabet="aabbcc \n1Aé"):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, size))) for _ in range(n)]


def test_all_ends_against_definition(spark):
    values = random_texts(1, 100, 14)
    rules = [Rule(i, e, f) for i, (e, f) in enumerate(ALL_ENDS_RULES)]
    got = by_rule(scan.scan_events(texts(spark, *values), rules).collect(), "doc_id")
    for i, text in enumerate(values):
        for r in rules:
            assert got.get((i, r.rule_id), []) == all_ends(r, text), (r.expression, text)
    # which rules hit is what the events say
    hits = scan.match_rules(texts(spark, *values), rules).collect()
    assert {(r["doc_id"], r["rule_id"]) for r in hits} == set(got)


def test_offset_bounds_of_a_rule(spark):
    rule = Rule(0, r"\d+", "", {"min_offset": 5, "max_offset": 11, "min_length": 2})
    assert spans(scan.scan_events(texts(spark, "abc123def456"), rule)) == [(0, 5), (0, 6), (0, 11)]


LEFTMOST_RULES = [
    (r"\d+", ""), ("ab{1,3}", ""), ("a.b", "s"), (r"\bab", ""), ("b$", ""), ("b$", "m"),
    ("(?:a|ab)(?:c|bc)?", ""), ("a*", ""), ("(a)(b)?", ""), ("(?<=a)b", ""), (r"(a|b)\1", ""),
    ("[^a]", "8"), ("a+?b", ""), ("(?>a+)b", ""), ("b", "H"),
]


def test_leftmost_against_finditer(spark):
    values = random_texts(2, 100, 14)
    rules = [Rule(i, e, f, kind=LEFTMOST) for i, (e, f) in enumerate(LEFTMOST_RULES)]
    got = by_rule(scan.scan_leftmost(texts(spark, *values), rules).collect(), "doc_id")
    for i, text in enumerate(values):
        for r in rules:
            view = text if "8" in r.flags else byte_text(text)
            want = [m.span() for m in re.finditer(python_pattern(r), view, python_flags(r))]
            if "8" in r.flags:
                want = [(len(view[:a].encode()), len(view[:b].encode())) for a, b in want]
            want = want[:1] if "H" in r.flags else want
            assert got.get((i, r.rule_id), []) == sorted(want, key=lambda e: e[1]), r.expression


def test_long_run_of_matches(spark):
    # more matches than one piece of the running sums holds
    df = texts(spark, "ab" * 700)
    got = spans(scan.scan_leftmost(df, Rule(0, "a", kind=LEFTMOST)))
    assert got == [(i, i + 1) for i in range(0, 1400, 2)]
    assert spans(scan.scan_events(df, Rule(0, "b", "L"))) == [(i - 1, i) for i in range(2, 1401, 2)]


def test_deep_rules_do_not_overflow(spark):
    df = texts(spark, "ab" * 20000 + "c")
    deep = Rule(0, "(?:a|ba?)*c", "L")
    assert spans(scan.scan_events(df, deep)) == [(0, 40001)]
    rules = [deep, Rule(1, "(?:a|ba?)*d"), Rule(2, "bac")]
    assert [r["rule_id"] for r in scan.match_rules(df, rules).collect()] == [0]
    row = df.select(*(scan.match_any("text", r).alias(str(r.rule_id)) for r in rules)).first()
    assert tuple(row) == (True, False, False)
    assert spans(scan.scan_events(df, rule_table(spark, [deep] * 200))) == [(0, 40001)] * 200


def test_nested_repeats_stay_polynomial(spark):
    rule = Rule(0, "^((x?a+)*)@b$", "L")
    assert scan.match_rules(texts(spark, "a" * 2000 + "@"), [rule]).count() == 0
    assert spans(scan.scan_events(texts(spark, "a" * 50 + "@b"), rule)) == [(0, 52)]


def test_captures(spark):
    df = texts(spark, "abctestdeftest")
    rows = scan_captures(df, Rule(0, "(t)(x)?est", kind=LEFTMOST)).orderBy("from_off").collect()
    first = [tuple(c) if c else None for c in rows[0]["captures"]]
    assert first == [(3, 7, "test"), (3, 4, "t"), None]
    assert [(r["from_off"], r["to_off"]) for r in rows] == [(3, 7), (10, 14)]
    plain = scan_captures(df, Rule(0, "test", kind=LEFTMOST), groups=False)
    assert plain.filter("captures IS NULL").count() == 2
    texts_of = df.select(group_texts("text", Rule(0, "(t)e", kind=LEFTMOST)).alias("g")).first()
    assert texts_of["g"] == ["t", "t"]


def test_find_first_of_leftmost_rules(spark):
    rules = [
        Rule(1, "b+", kind=LEFTMOST), Rule(2, "é.", "8", kind=LEFTMOST), Rule(3, "(?<=é)x|$a", "", kind=LEFTMOST),
        Rule(4, "c(?=d)", "i", kind=LEFTMOST),
    ]
    rng = random.Random(3)
    lines = ["".join(rng.choices("abcdéxCD\n", k=rng.randrange(12))) for _ in range(200)] + ["", None]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    for chosen in (rules, rules[1:2], rules[2:]):
        shown = df.select(
            scan.find_first_index("text", chosen).alias("at"), scan.find_first("text", chosen).alias("first"),
            scan.find_all_index("text", chosen).alias("all_at"), scan.find_all("text", chosen).alias("all"),
        ).collect()
        assert any(r["at"] is not None for r in shown)
        for r in shown:
            assert r["at"] == (r["all_at"][0] if r["all_at"] else None)
            assert r["first"] == (r["all"][0] if r["all"] else None)


def test_find(spark):
    def first(column, text="abc123def456"):
        value = texts(spark, text).select(column.alias("v")).first()["v"]
        if isinstance(value, list):
            return [tuple(v)[:2] if not isinstance(v, str) else v for v in value]
        return tuple(value)[:2] if value is not None and not isinstance(value, str) else value

    assert first(scan.find_first_index("text", DIGITS), "123") == (0, 3)
    assert first(scan.find_first_index("text", DIGITS)) == (3, 6)
    assert first(scan.find_all_index("text", DIGITS)) == [(3, 6), (9, 12)]
    assert first(scan.find_all_index("text", DIGITS, 1)) == [(3, 6)]
    assert first(scan.find_all_index("text", DIGITS, 0)) is None
    assert first(scan.find_all("text", DIGITS)) == ["123", "456"]
    assert first(scan.find_first("text", DIGITS), "none") is None
    # without starts a match is everything up to its end, and all ends merge
    assert first(scan.find_all("text", Rule(0, "test")), "abctestdeftest") == ["abctestdeftest"]
    numbers = Rule(0, r"\d+", kind=LEFTMOST)
    assert first(scan.find_all_index("text", numbers)) == [(3, 6), (9, 12)]


@pytest.mark.parametrize(
    "expression, expected", [("foo.*", True), ("bar.*", False), ("SEA", False), ("(?i)SEA", True)]
)
def test_match_any(spark, expression, expected):
    row = texts(spark, "seafood").select(scan.match_any("text", expression).alias("m")).first()
    assert row["m"] is expected


def test_vectored(spark):
    rows = [(0, ["abctestdef", "123test456"]), (1, []), (2, ["", ""]), (3, None), (4, ["te", None])]
    df = spark.createDataFrame(rows, "doc_id long, pieces array<string>")
    assert spans(scan.scan_vectored(df, "test")) == [(0, 7), (0, 17)]
    with pytest.raises(Exception, match="block is NULL"):
        scan.scan_vectored(df, "test", strict=True).collect()
    split = spark.createDataFrame([(0, ["hello fo", "obar", "bar!"])], df.schema)
    events = scan.scan_vectored(split, Rule(0, "foo(bar)+", "L"))
    assert spans(events) == [(6, 12), (6, 15)]
    at = split.select(scan.piece_index("pieces", "12").alias("a"), scan.piece_index("pieces", "13").alias("b"))
    assert tuple(at.first()) == (1, 2)


def dictionary(seed=3):
    rng = random.Random(seed)
    values = random_texts(seed, 50, 90, "abcé")
    lits = {"".join(rng.choice("abcABé") for _ in range(rng.choice((1, 2, 3, 5, 8, 9, 16, 17)))) for _ in range(150)}
    lits |= {t[3:25] for t in values if len(t) > 25} | {t[1:71] for t in values if len(t) > 71}
    rules = [Rule(i, x, rng.choice(("", "L", "iL", "H")), kind=LITERAL) for i, x in enumerate(sorted(lits))]
    want = set()
    for d, text in enumerate(values):
        for r in rules:
            a, b = r.expression.encode(), text.encode()
            if "i" in r.flags:
                a, b = a.lower(), b.lower()
            ends = [p + len(a) for p in range(len(b) - len(a) + 1) if b[p : p + len(a)] == a]
            for end in ends[:1] if "H" in r.flags else ends:
                want.add((d, r.rule_id, end - len(a) if "L" in r.flags else 0, end))
    return values, rules, want


@pytest.mark.parametrize("limit", [1_000_000, 10])
def test_dictionary(spark, limit):
    values, rules, want = dictionary()
    df = texts(spark, *values)
    rows = scan_dictionary(df, rule_table(spark, rules), max_index_rows=limit).collect()
    got = [(r["doc_id"], r["rule_id"], r["from_off"], r["to_off"]) for r in rows]
    assert len(got) == len(want) and set(got) == want
    if limit > 10:
        few = [r for r in rules if r.rule_id < 20]
        rows = scan_literals(df, few).collect()
        assert {tuple(r)[:4] for r in rows} == {w for w in want if w[1] < 20}


@pytest.mark.parametrize("limit", [1_000_000, 10])
def test_rule_tables_equal_unrolled_rules(spark, limit, monkeypatch):
    values, literals, _ = dictionary(4)
    rules = [
        Rule(r.rule_id, r.expression + "[abc]*" + r.expression[:1], "i" if i % 3 == 0 else "L")
        for i, r in enumerate(literals[:40])
    ]
    df = texts(spark, *values)
    want = {tuple(r) for r in scan.scan_events(df, rules).collect()}
    pairs = {(w[0], w[1]) for w in want}
    table = rule_table(spark, rules)
    got = [tuple(r) for r in prefilter_verify(df, table, max_index_rows=limit).collect()]
    assert len(got) == len(pairs) and set(got) == pairs
    monkeypatch.setattr(ruleset, "MAX_UNROLLED", 5)
    got = [tuple(r) for r in scan.scan_events(df, table).collect()]
    assert len(got) == len(want) and set(got) == want


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("k, literal", [(1, "abcab"), (2, "abccbaé"), (1, "aé")])
def test_approximate(spark, k, literal):
    values = random_texts(5, 40, 60, "abcé")
    lit, by_edit, by_hamming = literal.encode(), set(), set()
    for d, text in enumerate(values):
        b = text.encode()
        for end in range(len(b) + 1):
            near = range(max(0, end - len(lit) - k), min(end, end - len(lit) + k) + 1)
            starts = [s for s in near if edits(b[s:end], lit) <= k]
            if starts:
                by_edit.add((d, starts[0], end))
            s = end - len(lit)
            if s >= 0 and sum(x != y for x, y in zip(b[s:end], lit)) <= k:
                by_hamming.add((d, s, end))
    df = texts(spark, *values)
    rule = Rule(0, literal, "L", kind=LITERAL)
    for op, want in ((scan_edit_distance, by_edit), (scan_hamming_distance, by_hamming)):
        got = [(r["doc_id"], r["from_off"], r["to_off"]) for r in op(df, [rule], k).collect()]
        assert len(got) == len(want) and set(got) == want
        rows = op(df, rule_table(spark, [rule]), k).collect()
        assert sorted((r["doc_id"], r["from_off"], r["to_off"]) for r in rows) == sorted(got)
