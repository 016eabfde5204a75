import re

import pytest

from patternscan.functions.syntax import LEFTMOST, LITERAL, Rule, RuleError, prepare
from patternscan.operators.audit import audit_rules, audit_rejects, valid_rules
from patternscan.operators.scan import scan_events
from patternscan.plans.ruleset import load_rules
from patternscan.sources.rule_lines import (
    append_rules,
    canonical,
    ingest_rules,
    read_rule_lines,
    rules_from_strings,
)


def lines(spark, *text):
    return spark.createDataFrame(list(enumerate(text)), "line_no long, line string")


def shown(rules):
    rows = rules.withColumn("c", canonical(rules)).orderBy("line_no").collect()
    return [r["c"] for r in rows]


@pytest.mark.parametrize(
    "line, text",
    [
        ("/test/im", "/test/im"),
        ("/te/st/im", "/te/st/im"),
        ("te/st", "/te/st/"),
        ("3:/foobar/iu{min_offset=4,min_length=8}", "3:/foobar/8i{min_offset=4,min_length=8}"),
        ("/test/ifemopus", "/test/8HPVWims"),
        ("2:/(hatstand|teakettle)/Hi", "2:/(hatstand|teakettle)/Hi"),
        ("//i", "///i/"),
        ("/a/i{MIN_OFFSET=3,foo=1,bad}", "/a/i{min_offset=3}"),
        ("/a/{max_offset=3}", "/a/{max_offset=3}"),
        ("  0:/x/L\t", "/x/L"),
    ],
)
def test_rule_text(spark, line, text):
    rules, rejects = ingest_rules(lines(spark, line))
    assert shown(rules) == [text]
    assert rejects.count() == 0


def test_feed_with_comments_and_errors(spark):
    feed = lines(
        spark, "# rules", "", "/a/i", "http://x/", "/b/abc", "/c/i{min_offset=x}", "/(d/", "/a/i"
    )
    rules, rejects = ingest_rules(feed, validate=True, dedupe=True)
    assert shown(rules) == ["/a/i"]
    errors = {r["line_no"]: r["error"] for r in rejects.collect()}
    assert set(errors) == {3, 4, 5, 6}
    assert errors[3] == "pattern id `http`"
    assert errors[6].startswith("Missing close parenthesis")
    with pytest.raises(RuleError):
        ingest_rules(feed, strict=True)


def test_rule_file_with_mandatory_ids(spark, tmp_path):
    (tmp_path / "rules").write_text("10002:/google/i\n10001:/foobar/is\nplain\nx:/a/\n")
    feed = read_rule_lines(spark, str(tmp_path / "rules"))
    rules, rejects = ingest_rules(feed, id_required=True)
    got = {(r["rule_id"], r["expression"], r["flags"]) for r in rules.collect()}
    assert got == {(10002, "google", "i"), (10001, "foobar", "is")}
    assert rejects.count() == 2


def test_kinds_have_their_own_flags(spark):
    feed = lines(spark, "/a/i8", "/a/L", "/a/u")
    rules, rejects = ingest_rules(feed, kind=LEFTMOST)
    assert shown(rules) == ["/a/8i"] and rejects.count() == 2
    rules, _ = ingest_rules(lines(spark, "/te?st/im"), kind=LITERAL)
    assert [(r["expression"], r["kind"]) for r in rules.collect()] == [("te?st", "literal")]


def test_strings_are_not_parsed(spark):
    df = spark.createDataFrame([(["a", "/b/i"],)], "e array<string>")
    rules = rules_from_strings(df, "e")
    assert {(r["rule_id"], r["expression"]) for r in rules.collect()} == {(1, "a"), (2, "/b/i")}
    assert append_rules(rules, rules).count() == 4


def test_audit(spark):
    card = (
        r"(?:4[0-9]{12}(?:[0-9]{3})?|5[1-5][0-9]{14}|3[47][0-9]{13}|"
        r"3(?:0[0-5]|[68][0-9])[0-9]{11}|6(?:011|5[0-9]{2})[0-9]{12}|(?:2131|1800|35\d{3})\d{11})"
    )
    rows = [
        (1, "test", "", "all_ends"),
        (2, card, "", "all_ends"),
        (3, "test$", "", "all_ends"),
        (4, "", "", "all_ends"),
        (5, "", "V", "all_ends"),
        (6, "", "", "leftmost"),
        (7, r"\R", "", "all_ends"),
        (8, r"(a)\1", "", "all_ends"),
        (9, r"(a)\1", "", "leftmost"),
        (10, "(?=a)b", "", "all_ends"),
        (11, "a+", "", "all_ends"),
        (12, "(a|bc)*d", "", "all_ends"),
        (13, "(1 & 2) | !11", "C", "all_ends"),
        (14, "(1 &", "C", "all_ends"),
    ]
    df = spark.createDataFrame(rows, "rule_id int, expression string, flags string, kind string")
    df = df.selectExpr(
        "rule_id",
        "expression",
        "flags",
        "0 AS flag_bits",
        "CAST(NULL AS struct<min_offset:bigint,max_offset:bigint,min_length:bigint,"
        "edit_distance:int,hamming_distance:int>) AS ext",
        "kind",
    )
    audited = audit_rules(df)
    got = {r["rule_id"]: r for r in audited.collect()}
    assert (got[1]["min_width"], got[1]["max_width"]) == (4, 4)
    assert (got[2]["min_width"], got[2]["max_width"]) == (13, 16)
    assert [got[3][c] for c in ("unordered", "at_eod", "only_at_eod")] == [True] * 3
    assert not got[4]["valid"] and got[5]["valid"] and got[6]["valid"]
    assert got[7]["error"] == r"\R at index 0 not supported."
    assert not got[8]["valid"] and got[9]["valid"] and not got[10]["valid"]
    assert got[11]["max_width"] is None and got[12]["stack_risk"]
    assert got[13]["valid"] and not got[14]["valid"]
    assert valid_rules(audited).count() + audit_rejects(audited).count() == len(rows)


def test_bad_rules_raise_before_a_scan():
    with pytest.raises(RuleError):
        load_rules([])
    with pytest.raises(RuleError, match="Missing close parenthesis"):
        load_rules("a(b")
    with pytest.raises(RuleError):
        prepare(Rule(1, "a", "o", kind=LEFTMOST))


def test_ends_after_a_free_run_do_not_read_the_text_again(spark):
    """Read backwards, the run reached the start of the text from each end."""
    rules = [r"\A.+[0-9]", r"^.{3,}?b[0-9]", r"\A.*a", r"\A.{2,4}[0-9]", r"(?:\A.+)7"]
    made = [prepare(Rule(i, x, "Ls")) for i, x in enumerate(rules)]
    assert [r"\z" in p.backward for p in made] == [False, False, False, True, False]
    text = "1a\nb2ab7\n\né8b9"
    df = spark.createDataFrame([(1, text), (2, "7"), (3, ""), (4, None), (1, text)], "doc_id long, text string")
    found = sorted(tuple(r) for r in scan_events(df, [p.rule for p in made]).drop("flags").collect())
    raw = {1: text.encode(), 2: b"7"}
    exact = [re.compile(x.encode() + rb"\Z", re.S) for x in rules]
    want = [
        (d, i, 0, e) for d in (1, 1, 2) for i, x in enumerate(exact) for e in range(len(raw[d]) + 1) if x.match(raw[d][:e])
    ]
    assert found == sorted(want)
