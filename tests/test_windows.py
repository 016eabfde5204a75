"""Rules of a table that are decided around the texts they require mean what
they mean in a list, where the whole text is read."""

import random

import pytest

from patternscan.functions.syntax import LITERAL, Rule
from patternscan.operators.prefilter import prefilter_verify
from patternscan.operators.scan import match_rules, scan_events
from patternscan.plans.ruleset import RULES_SCHEMA

EXPRESSIONS = [
    "abc", "^abc", "abc$", r"\Aabc", r"abc\z", r"\babc\b", r"\babc[ ,.\n]", "a?abc[cb]{0,4}", "[ab]{0,3}abc$",
    "(?:abc|ABC)[ ,]", "(?:abc|cab)a{0,2}$", "(?:^abc|bca) ", "abcabc.{0,5}", "c{1,3}abcab[^c]", "^.{0,4}abc", "(abc){2,3}$",
]
FLAGS = ["", "L", "i", "iL", "mL", "H", "sL"]
EXTS = [{}, {"min_offset": 5, "max_offset": 60}, {"min_length": 4}]


def rules():
    every = [(x, f, e) for x in EXPRESSIONS for f in FLAGS for e in EXTS]
    some = random.Random(3).sample(every, 8)
    return [Rule(i, x, f, e) for i, (x, f, e) in enumerate(some)] + [Rule(900, "cabc", "L", kind=LITERAL)]


def rule_table(spark, fill=110):
    none = dict.fromkeys(("min_offset", "max_offset", "min_length", "edit_distance", "hamming_distance"))
    filler = [Rule(1000 + i, f"never there {i:04d}", "L") for i in range(fill)]
    rows = [(r.rule_id, r.expression, r.flags, 0, none | r.ext, r.kind) for r in rules() + filler]
    return spark.createDataFrame(rows, RULES_SCHEMA)


@pytest.fixture(scope="module")
def texts(spark):
    chance = random.Random(7)
    made = ["".join(chance.choice(["abc", "ABC", "a", "c", " ", "\n", ",", "é"]) for _ in range(n)) for n in (5, 40, 200)]
    rows = ["abc", "abc\n", "abc\r\n", "xabcabcabc\nabc ", "abcABC, Abc.", "", None, *made, *(m + "\r\n" for m in made)]
    numbered = [(i, t) for i, t in enumerate(rows)]
    again = [(0, "abc"), (3, "abc"), (None, "abc,"), (None, "abc,")]
    return spark.createDataFrame(numbered + again, "doc_id long, text string").repartition(3).cache()


def shown(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_matches_of_a_table_are_those_of_a_list(spark, texts, limit):
    found = prefilter_verify(texts, rule_table(spark, 0), max_index_rows=limit)
    assert shown(found) == shown(match_rules(texts, rules()))


def test_events_of_a_table_are_those_of_a_list(spark, texts):
    assert shown(scan_events(texts, rule_table(spark))) == shown(scan_events(texts, rules()))


def test_texts_stay_where_they_are(spark, texts):
    """Events of bounded rules with a literal were found in joined copies of texts."""
    plan = scan_events(texts, rule_table(spark, 140).filter("rule_id >= 1000"))._jdf.queryExecution().optimizedPlan()
    assert "_window" in plan.toString() and plan.toString().count("InMemoryRelation") == 1
