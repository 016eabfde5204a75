import random

import pytest
from matches import all_ends, by_rule

from patternscan.functions.syntax import Rule, RuleError, prepare
from patternscan.operators.scan import scan_events
from patternscan.streaming import chunks as ch
from patternscan.streaming.live import export_live_state, scan_stream_live

SCHEMA = "stream_id long, seq long, chunk string, control string"


def table(spark, *rows):
    return spark.createDataFrame([(*r, None)[:4] if len(r) == 3 else r for r in rows], SCHEMA)


def spans(df):
    return sorted((r["from_off"], r["to_off"]) for r in df.collect())


RULES = [
    ("ab{1,3}", "L"), ("a", ""), ("a.{0,4}c", "L"), (r"\bab?", "L"), (r"ab?\b", "L"),
    ("^a", "mL"), ("b$", "mL"), ("b$", "L"), ("[bc]\\Z", "L"), (r"\d+", "L"), ("a[bc]*1", "L"),
    ("(?s)a.*c", "L"), ("a[bc]+$", "L"), ("^ab", "L"), ("b", "LH"),
]


def cut_texts(seed, n=50):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("aabbcc \n1") for _ in range(rng.randint(1, 25))) for _ in range(n)]
    texts += ["xabc\n", "abc", "ab\n\n"]
    rows = []
    for i, text in enumerate(texts):
        at = seq = 0
        while at < len(text):
            step = rng.randint(0, 5)
            rows.append((i, seq, text[at : at + step], None))
            at, seq = at + step, seq + 1
        rows.append((i, seq, "", "close"))
    rng.shuffle(rows)
    return texts, rows


@pytest.mark.parametrize("bucket", [256, 2])
def test_any_cutting_equals_the_whole_text(spark, bucket):
    texts, rows = cut_texts(1)
    rules = [Rule(i, e, f) for i, (e, f) in enumerate(RULES)]
    df = table(spark, *rows)
    events = ch.scan_stream(df, rules, close=True, with_text=True, bucket=bucket).collect()
    got = by_rule(events, "stream_id")
    for i, text in enumerate(texts):
        for r in rules:
            assert got.get((i, r.rule_id), []) == all_ends(r, text), (r.expression, text)
    for e in events:
        if "L" in rules[e["rule_id"]].flags:
            assert e["text"] == texts[e["stream_id"]][e["from_off"] : e["to_off"]]
    if bucket == 2:
        apart = ch.scan_stream(df, rules, bucket=2).unionByName(
            ch.close_streams(df, rules, bucket=2)
        )
        assert by_rule(apart.collect(), "stream_id") == got


@pytest.mark.parametrize(
    "rule, parts, expected",
    [
        (Rule(0, "abc", "L"), ("123a", "b", "c456"), [(3, 6)]),
        (Rule(0, "test"), ("abcte", "stdef"), [(0, 7)]),
        (Rule(0, "foo(bar)+", "L"), ("hello fo", "obarba", "r!"), [(6, 12), (6, 15)]),
    ],
)
def test_matches_cross_chunks(spark, rule, parts, expected):
    df = table(spark, *((0, i, p) for i, p in enumerate(parts)))
    assert spans(ch.scan_stream(df, rule)) == expected


def test_reset_and_close(spark):
    df = table(spark, (0, 0, "abcte", None), (0, 1, "", "reset"), (0, 2, "stdef", None))
    keys = ("stream_id", "epoch")
    epochs = ch.reset_epochs(df)
    assert ch.scan_stream(epochs, "test", keys).count() == 0
    ends = ch.close_streams(epochs, Rule(0, "(te|ef)$", "L"), keys).collect()
    assert {(r["epoch"], r["from_off"], r["to_off"]) for r in ends} == {(0, 3, 5), (1, 3, 5)}


def test_state_continues_a_stream(spark):
    texts, rows = cut_texts(2)
    rules = [Rule(i, e, f) for i, (e, f) in enumerate(RULES) if "H" not in f]
    rules = [r for r in rules if prepare(r).max_width is not None]
    df = table(spark, *rows)
    whole = {tuple(r) for r in ch.scan_stream(df, rules).collect()}
    head, rest = df.filter("seq < 3"), df.filter("seq >= 3")
    state = ch.export_state(head, rules)
    assert state.filter("state_bytes <> octet_length(tail) + 16").count() == 0
    parts = ch.scan_stream(head, rules).unionByName(ch.scan_stream(rest, rules, state=state))
    assert {tuple(r) for r in parts.collect()} == whole
    with pytest.raises(RuleError):
        ch.export_state(df, "a+")


def test_forks(spark):
    df = table(spark, (0, 0, "abcte"), (0, 1, "xx"), (1, 0, "zz"))
    forks = spark.createDataFrame(
        [(10, 0, 0), (11, 0, 0), (12, 0, 1)], "branch_id long, stream_id long, fork_seq long"
    )
    branches = spark.createDataFrame(
        [(10, 1, "stdef"), (11, 1, "st"), (11, 2, "test"), (12, 2, "test")],
        "branch_id long, seq long, chunk string",
    )
    want = {(10, 0, 7), (11, 0, 7), (11, 0, 11), (12, 0, 11)}
    for rule in ("test", "te(st)+"):
        rows = ch.fork_streams(df, forks, branches, rule).collect()
        assert {(r["branch_id"], r["from_off"], r["to_off"]) for r in rows} == want


def test_match_and_find(spark):
    df = table(spark, (0, 0, "foo1"), (0, 1, "23bar4"), (0, 2, "56"), (1, 0, "none"))
    digits = Rule(0, r"\d+", "L")
    found = ch.stream_find(df, digits, with_text=True)
    assert sorted(tuple(r)[2:] for r in found.collect()) == [(3, 6, 0, "123"), (9, 12, 0, "456")]
    assert spans(ch.stream_find(df, digits, 1)) == [(3, 6)]
    assert ch.stream_find(df, digits, 0).count() == 0
    prefix = ch.stream_find(df, Rule(0, "4"), 1, with_text=True).first()
    assert prefix["text"] == "foo123bar4"
    assert {tuple(r) for r in ch.stream_match(df, r"\d").collect()} == {(0, True), (1, False)}
    zeros = table(spark, *((7, i, "\0" * 4096) for i in range(256)), (7, 256, "abctestdef"))
    assert ch.stream_match(zeros, "test").first()["matched"] is True


def test_chunked_documents_equal_whole_ones(spark):
    df = spark.createDataFrame([(0, "é1 22 " * 700), (1, ""), (2, None)], "doc_id long, text string")
    cut = ch.chunk_text(df, size=100)
    assert cut.filter("octet_length(chunk) > 100").count() == 0
    rule = Rule(0, r"\d{2} ", "L")
    whole = scan_events(df, rule)
    assert spans(ch.scan_stream(cut, rule, ("doc_id",), bucket=4)) == spans(whole)
    over = ch.chunk_text(df, size=100, overlap=10).orderBy("seq").collect()
    assert bytes(over[0]["chunk"])[-10:] == bytes(over[1]["chunk"])[:10]


def test_unbounded_rule_on_one_endless_segment_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(ch, "MAX_SEGMENT", 1000)
    df = table(spark, *((0, i, "1" * 100) for i in range(20)))
    with pytest.raises(Exception, match="more of one stream"):
        ch.scan_stream(df, r"\d+").collect()
    spaced = table(spark, *((0, i, "1" * 99 + " ") for i in range(20)))
    assert ch.scan_stream(spaced, r"\d+").count() == 99 * 20


def run_live(spark, tmp_path, rows, name, parts=3, **options):
    source, schema = str(tmp_path / "in"), SCHEMA
    for i in range(parts):
        part = spark.createDataFrame(rows[i::parts], schema).coalesce(1)
        part.write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    rules = options.pop("rules")
    found = scan_stream_live(stream, rules, control="control", **options)
    query = (
        found.writeStream.format("memory")
        .queryName(name)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(240)
    assert query.exception() is None
    return spark.table(name).collect()


def test_live_equals_batch(spark, tmp_path):
    texts, rows = cut_texts(3, 15)
    rules = [Rule(i, e, f) for i, (e, f) in enumerate(RULES)]
    rules = [r for r in rules if prepare(r).max_width is not None]
    live = run_live(spark, tmp_path, rows, "live_batch", rules=rules)
    batch = ch.scan_stream(table(spark, *rows), rules, close=True).collect()
    assert sorted(map(tuple, live)) == sorted(map(tuple, batch))


def test_live_starts_from_saved_state(spark, tmp_path):
    rule = Rule(0, "abc", "L")
    state = ch.export_state(table(spark, (0, 0, "123a")), rule)
    rows = [(0, 2, "c456", None), (0, 1, "b", None)]
    got = run_live(spark, tmp_path, rows, "live_seed", 2, rules=rule, initial_state=state)
    assert [(r["from_off"], r["to_off"]) for r in got] == [(3, 6)]
    saved = export_live_state(spark, str(tmp_path / "checkpoint"))
    assert [(r["stream_id"], r["base"], r["next_seq"]) for r in saved.collect()] == [(0, 9, 3)]
    more = ch.scan_stream(table(spark, (0, 3, "ab"), (0, 4, "c")), rule, state=saved)
    assert spans(more) == [(9, 12)]
    with pytest.raises(RuleError):
        run_live(spark, tmp_path, rows, "live_wide", rules=Rule(0, "a+"))


def test_live_reports_chunks_that_cannot_be_scanned(spark, tmp_path):
    """Chunk 3 waits for chunk 2 when the stream closes."""
    rows = [(0, 0, "xabc", None), (0, 3, "abc", None), (0, 1, "", "close")]
    got = run_live(spark, tmp_path, rows, "live_gap", 1, rules=Rule(0, "abc", "L"))
    assert sorted((r["rule_id"], r["from_off"], r["to_off"], r["flags"]) for r in got) == [(-1, 4, 4, 1), (0, 1, 4, 0)]


def test_single_match_goes_on_from_a_state(spark, tmp_path):
    rules = [Rule(5, "test", "LH"), Rule(6, "late", "LH"), Rule(7, "t", "L")]
    first, rest = table(spark, (0, 0, "a test ")), table(spark, (0, 1, "b test late"))
    state = ch.export_state(first, rules)
    whole = sorted(map(tuple, ch.scan_stream(first.unionByName(rest), rules).collect()))
    parts = ch.scan_stream(first, rules).collect() + ch.scan_stream(rest, rules, state=state).collect()
    assert sorted(map(tuple, parts)) == whole
    rows = [(0, 1, "b test late", None)]
    live = run_live(spark, tmp_path, rows, "live_single", 1, rules=rules, initial_state=state)
    assert sorted(map(tuple, live)) == sorted(map(tuple, ch.scan_stream(rest, rules, state=state).collect()))
