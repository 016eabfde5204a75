"""The same rules mean the same whatever the size and form of their set."""

import pytest
from pyspark.sql import functions as F

from patternscan.functions.syntax import LITERAL, Rule, RuleError
from patternscan.operators.approx import scan_edit_distance, scan_hamming_distance
from patternscan.operators.events import combine_rules
from patternscan.operators.literals import scan_literals
from patternscan.operators.rule_sets import scan_rule_set
from patternscan.operators.scan import scan_events
from patternscan.plans.ruleset import RULES_SCHEMA
from patternscan.queries import QUERIES

TEXTS = [(1, "Tést TEST test TÉST the license"), (2, "abc LICENCE License lisence"), (3, ""), (4, None)]


def texts(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string")


def rule_table(spark, rules):
    empty = {"min_offset": None, "max_offset": None, "min_length": None, "edit_distance": None, "hamming_distance": None}
    rows = [(r.rule_id, r.expression, r.flags, 0, empty | r.ext, r.kind) for r in rules]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def shown(df):
    return sorted((r.doc_id, r.rule_id, r.from_off, r.to_off) for r in df.collect())


FILLER = [Rule(1000 + i, f"never there {i:04d}", "", kind=LITERAL) for i in range(200)]


@pytest.mark.parametrize(
    "rules",
    [
        [Rule(1, "tést", "8iL", kind=LITERAL)],
        [Rule(1, "test", "il", kind=LITERAL), Rule(2, "lic", "L", kind=LITERAL)],
        [Rule(1, "TEST", "iH", kind=LITERAL), Rule(2, "the license", "LoP", kind=LITERAL)],
        [Rule(1, "test", "iL", {"min_offset": 12}, LITERAL)],
    ],
)
def test_literals_of_any_number(spark, rules):
    few = shown(scan_literals(texts(spark), rule_table(spark, rules)))
    many = shown(scan_literals(texts(spark), rule_table(spark, rules + FILLER)))
    assert few == many == shown(scan_literals(texts(spark), rules)) and few


@pytest.mark.parametrize("bad", [Rule(1, "abc", "z", kind=LITERAL), Rule(1, "", "", kind=LITERAL)])
@pytest.mark.parametrize("filler", [[], FILLER])
def test_bad_literals_are_errors(spark, bad, filler):
    with pytest.raises(Exception):
        scan_literals(texts(spark), rule_table(spark, [bad, *filler])).collect()


def near(spark, rule):
    listed = shown(scan_edit_distance(texts(spark), [rule]))
    assert listed == shown(scan_edit_distance(texts(spark), rule_table(spark, [rule])))
    return listed


def test_flags_and_bounds_of_approximate_rules(spark):
    every = near(spark, Rule(1, "LICENSE", "iL", {"edit_distance": 1}, LITERAL))
    assert {e[0] for e in every} == {1, 2} and len(every) > 4
    assert near(spark, Rule(1, "LICENSE", "L", {"edit_distance": 1}, LITERAL)) == [(2, 1, 4, 11)]
    late = near(spark, Rule(1, "LICENSE", "iL", {"edit_distance": 1, "min_offset": 15}, LITERAL))
    assert late == [e for e in every if e[3] >= 15]
    once = near(spark, Rule(1, "LICENSE", "iLH", {"edit_distance": 1}, LITERAL))
    assert once == [min((e for e in every if e[0] == d), key=lambda e: e[3]) for d in (1, 2)]
    long = near(spark, Rule(1, "LICENSE", "iL", {"edit_distance": 1, "min_length": 8}, LITERAL))
    assert long == [e for e in every if e[3] - e[2] >= 8]


SET = [
    Rule(1, "test", "iQ"),
    Rule(2, "license", "L"),
    Rule(3, "1 & 2", "C"),
    Rule(4, "!1 & !2", "C"),
    Rule(5, "LICENSE", "L", {"edit_distance": 1}, LITERAL),
]


def test_rule_set_as_list_and_table(spark):
    got = shown(scan_rule_set(texts(spark), SET))
    assert got == shown(scan_rule_set(texts(spark), rule_table(spark, SET)))
    assert {r for _, r, _, _ in got} == {2, 3, 4, 5}
    assert (1, 3, 0, 33) in got and (3, 4, 0, 0) in got


def test_distances_are_not_passed_over(spark):
    for kind in (LITERAL, "all_ends"):
        rule = Rule(1, "abc", "", {"edit_distance": 1}, kind)
        with pytest.raises(RuleError):
            scan_events(texts(spark), rule)
    with pytest.raises(RuleError):
        scan_rule_set(texts(spark), [Rule(1, "ab+c", "", {"edit_distance": 1})])
    with pytest.raises(RuleError):
        scan_rule_set(texts(spark), rule_table(spark, [Rule(1, "ab+c", "", {"edit_distance": 1})]))


def test_more_formulas_than_one_projection_takes(spark):
    events = spark.createDataFrame([(1, 7, 0, 3, 0)], "doc_id long, rule_id int, from_off long, to_off long, flags int")
    got = combine_rules(events, {1000 + i: "7 | 8" for i in range(300)})
    assert got.select("rule_id").distinct().count() == 300 and got.filter(F.col("to_off") == 3).count() == 300


@pytest.mark.parametrize("as_table", [False, True])
@pytest.mark.parametrize("scan, bound", [(scan_edit_distance, "edit_distance"), (scan_hamming_distance, "hamming_distance")])
def test_caseless_utf8_rules_fold_characters(spark, as_table, scan, bound):
    docs = spark.createDataFrame([(1, "wörd9x"), (2, "ab WÖRD9x"), (3, "ΣΊΣΥΦΟΣ"), (4, "wrd")], "doc_id long, text string")
    rules = [Rule(1, "WÖRD9Y", "i8L", {bound: 1}, LITERAL), Rule(2, "σίσυφος", "i8L", {bound: 1}, LITERAL), Rule(3, "wÖrd9x", "iL", {bound: 1}, LITERAL)]
    if as_table:
        rules = rule_table(spark, rules)
    got = {(r.doc_id, r.rule_id) for r in scan(docs, rules, 1).collect()}
    # bytes of other letters than A to Z keep their case without flag 8, and differ in one byte here
    assert got >= {(1, 1), (2, 1), (3, 2), (2, 3), (1, 3)} and not {d for d, _ in got} & {4}
    ends = {(r.doc_id, r.from_off, r.to_off) for r in scan(docs, rules, 1).collect() if r.rule_id == 1 and r.doc_id == 2}
    assert (2, 3, 10) in ends


@pytest.mark.parametrize("name, wanted", [("q_combine_and_not", {104, 105, 106}), ("q_quiet", {103})])
def test_queries_scan_quiet_rules_for_their_formulas(spark, tmp_path, name, wanted):
    rows = [(1, "a License of 2024"), (2, "in 1999"), (3, "nothing"), (4, None), (4, "token 1"), (None, "token 1234")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.rule_id for r in QUERIES[name](spark, str(tmp_path)).collect()} == wanted
