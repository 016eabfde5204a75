"""Rules without one fixed literal are found by sets of texts, exactly."""

import random

import pytest

from patternscan.functions.syntax import Rule, RuleError, prepare
from patternscan.operators import scan
from patternscan.operators.prefilter import prefilter_verify
from patternscan.plans.ruleset import RULES_SCHEMA
from patternscan.streaming.chunks import scan_stream

STEMS = ["alpha", "Beta", "gamma", "straße", "größe", "license", "KELVIN", "naïve", "delta", "omega"]


def rule_table(spark, rules):
    none = dict.fromkeys(("min_offset", "max_offset", "min_length", "edit_distance", "hamming_distance"))
    rows = [(r.rule_id, r.expression, r.flags, 0, none | r.ext, r.kind) for r in rules]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def some_rules():
    rules = []
    for i, a in enumerate(STEMS):
        for j, b in enumerate(STEMS):
            k = 10 * i + j
            rules.append(Rule(k, f"{a} ?{b}", ["i", "i8", "8", "iL8"][k % 4]))
            rules.append(Rule(1000 + k, f"(?:{a}|{b[:3]}q)[ .]{b[-3:]}", ["", "8", "i"][k % 3]))
    return rules


def some_texts(spark):
    chance = random.Random(4)

    def spelled(word):
        return chance.choice([word, word.upper(), word.lower(), word.title(), word.replace("k", "K").replace("i", "İ")])

    rows = []
    for n in range(120):
        words = [spelled(chance.choice(STEMS)) + chance.choice(["", "", "q"]) for _ in range(chance.randint(0, 12))]
        rows.append((n if n % 7 else None, "".join(w + chance.choice(["", " ", ".", " "]) for w in words)))
    return spark.createDataFrame([*rows, rows[1], rows[7], rows[7], (500, None), (501, "")], "doc_id long, text string")


def test_table_equals_list(spark):
    rules, texts = some_rules(), some_texts(spark)
    table = rule_table(spark, rules)
    few = [r for r in rules if r.rule_id % 5 == 0]
    got = sorted((r.doc_id or -1, r.rule_id) for r in scan.match_rules(texts, table).collect())
    want = sorted((r.doc_id or -1, r.rule_id) for r in scan.match_rules(texts, few).collect())
    assert [g for g in got if g[1] % 5 == 0] == want and len(want) > 40
    events = scan.scan_events(texts, table).collect()
    assert {(r.doc_id or -1, r.rule_id) for r in events} == set(got)


def test_no_rule_with_a_required_text_is_tested_on_each_row(spark):
    rules = [r for r in some_rules() if prepare(r).any_of and min(len(t.encode()) for t in prepare(r).any_of) >= 3]
    assert len(rules) >= 150
    plan = prefilter_verify(some_texts(spark), rule_table(spark, rules))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("expression, flags, has", [
    ("LICENSE", "i8", ("cen",)), ("kiss", "i8", ()), ("kiss", "i", ("kiss",)), ("größe", "i8", ("gr",)),
    ("naïve|größer", "iW", ("na", "gr")), ("straße", "8", ("straße",)),
])
def test_folded_texts(expression, flags, has):
    assert prepare(Rule(1, expression, flags)).any_of == has


def test_whole_set_flags_and_large_tables_are_not_passed_over(spark):
    texts = some_texts(spark)
    for rule in (Rule(1, "alpha", "Q"), Rule(2, "1 & 2", "C")):
        for rules in (rule, [Rule(3, "beta"), rule], rule_table(spark, [Rule(3, "beta"), rule])):
            with pytest.raises(RuleError, match="scan_rule_set"):
                scan.scan_events(texts, rules)
            with pytest.raises(RuleError, match="scan_rule_set"):
                scan_stream(texts.selectExpr("doc_id AS stream_id", "0L AS seq", "text AS chunk"), rules)
    with pytest.raises(RuleError, match="match_rules"):
        scan.match_any("text", rule_table(spark, some_rules()))
    with pytest.raises(RuleError, match="scan_events"):
        scan.find_first("text", rule_table(spark, some_rules()))
