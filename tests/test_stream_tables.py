"""Rule tables of any size over streams equal the same rules as a list."""

import random

import pytest

from patternscan.functions.syntax import Rule, RuleError
from patternscan.operators.scan import scan_events
from patternscan.plans.ruleset import RULES_SCHEMA
from patternscan.streaming import chunks as ch

WORDS = ["alpha", "beta", "gamma", "delta", "omega", "end", "start", "mid", "x1", "zz"]


def some_rules(unbounded):
    rules = [
        Rule(1, "alpha", "L"), Rule(2, r"\bbeta\b", "L"), Rule(3, r"gamma[a-z]{0,3}", ""), Rule(4, "delta$", "L"),
        Rule(5, r"omega\b", "LH"), Rule(6, "start", "L", {"min_offset": 40}), Rule(7, "mid", "", {"max_offset": 300}),
        Rule(8, r"^alpha", "mL"), Rule(9, r"[aeiou]nd", "iL"), Rule(10, r"x1|zz", "H"), Rule(11, "(?:be|de)ta", "L"),
        Rule(12, r"a b", "L", {"min_length": 3}), Rule(13, r"end\z", "L"),
    ]
    rules += [Rule(100 + i, f"{a} {b}[ \\n]", "L") for i, (a, b) in enumerate((a, b) for a in WORDS for b in WORDS)]
    rules += [Rule(300 + i, f"{a}{b}{a}", "L") for i, (a, b) in enumerate((a, b) for a in WORDS for b in WORDS[:5])]
    return rules + ([Rule(20, "alpha[a-z ]*omega", "L"), Rule(21, "zz[ a-z]+x1", "")] if unbounded else [])


def rule_table(spark, rules):
    none = dict.fromkeys(("min_offset", "max_offset", "min_length", "edit_distance", "hamming_distance"))
    rows = [(r.rule_id, r.expression, r.flags, 0, none | r.ext, r.kind) for r in rules]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def some_chunks(spark, seed, streams=4, parts=14):
    chance = random.Random(seed)
    rows = []
    for s in range(streams):
        text = "".join(chance.choice(WORDS) + chance.choice(["", " ", " ", "\n"]) for _ in range(110))
        cuts = sorted(chance.sample(range(1, len(text)), parts - 1))
        for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(text)])):
            rows.append((s, i, text[a:b].encode()))
    return spark.createDataFrame(rows, "stream_id long, seq long, chunk binary")


def told(df):
    return sorted((r.stream_id, r.rule_id, r.from_off, r.to_off) for r in df.collect())


def whole_texts(chunks):
    ordered = chunks.selectExpr("stream_id", "struct(seq, cast(chunk as string) AS c) AS c").groupBy("stream_id")
    joined = "array_join(transform(array_sort(c), x -> x.c), '') AS text"
    return ordered.agg({"c": "collect_list"}).toDF("stream_id", "c").selectExpr("stream_id", joined)


FEW = 15  # rules that are compared as a list: all flags and bounds are among them


def test_table_equals_list_and_whole_texts(spark):
    rules, chunks = some_rules(True), some_chunks(spark, 1)
    rules = rules[-2:] + rules[:-2]
    table, few = rule_table(spark, rules), rules[:FEW]
    ids = {r.rule_id for r in few}
    assert table.count() > 128
    got = told(ch.scan_stream(chunks, table, bucket=3, close=True))
    # the same as the whole text in one block, and as a list of rules
    assert got == told(scan_events(whole_texts(chunks), table, keys=("stream_id",)))
    assert [g for g in got if g[1] in ids] == told(ch.scan_stream(chunks, few, bucket=3, close=True))
    late = told(ch.close_streams(chunks, table, bucket=3))
    assert [g for g in late if g[1] in ids] == told(ch.close_streams(chunks, few, bucket=3))
    assert sorted(set(told(ch.scan_stream(chunks, table, bucket=3))) | set(late)) == got


def test_table_goes_on_from_a_state(spark):
    rules, chunks = some_rules(False), some_chunks(spark, 2)
    table = rule_table(spark, rules)
    first, rest = chunks.filter("seq < 6"), chunks.filter("seq >= 6")
    state = ch.export_state(first, table).cache()
    both = told(ch.scan_stream(first, table)) + told(ch.scan_stream(rest, table, state=state, close=True))
    assert sorted(both) == told(ch.scan_stream(chunks, table, close=True))
    with pytest.raises(RuleError):
        ch.export_state(first, rule_table(spark, some_rules(True)))


def test_table_finds_and_texts(spark):
    rules, chunks = some_rules(False), some_chunks(spark, 3)
    table = rule_table(spark, rules)
    texts = {r.stream_id: r.text for r in whole_texts(chunks).collect()}
    got = ch.stream_find(chunks, table, 7, with_text=True).collect()
    assert len(got) == 28
    assert all(r.text == texts[r.stream_id][r.from_off : r.to_off] for r in got)
    matched = {r.stream_id: r.matched for r in ch.stream_match(chunks, table).collect()}
    assert matched == dict.fromkeys(range(4), True)
    with pytest.raises(RuleError):
        ch.scan_stream(chunks, rule_table(spark, [*rules, Rule(999, "ü", "8")]))
