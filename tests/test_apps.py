import random
import re
import time

import pytest
from pyspark.sql import functions as F

from patternscan.functions.presets import preset_rules
from patternscan.functions.syntax import Rule, RuleError
from patternscan.operators import grep
from patternscan.operators import packets as pk
from patternscan.operators.grep import grep_lines, grep_totals
from patternscan.operators.tagging import tag_pii
from patternscan.plans.layout import spread
from patternscan.sources.files import read_files


def test_grep_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("hello foo\nbar foo\nlast fooé")
    (tmp_path / "b.txt").write_text("nothing")
    files = read_files(spark, str(tmp_path / "*.txt"))
    rows = grep_lines(files, "foo", byte_offset=True).orderBy("from_off").collect()
    assert [(r["line_off"], r["line"]) for r in rows] == [
        (0, "hello foo"), (10, "bar foo"), (18, "last fooé"),
    ]
    across = grep_lines(files, "foo.bar").collect()
    assert [r["line"] for r in across] == ["hello foo\nbar foo"]
    totals = grep_totals(files, "foo").first()
    assert tuple(totals) == (2, 35, 1, 3)


@pytest.mark.parametrize("step", [256, 3])
def test_grep_finds_lines_by_index(spark, monkeypatch, step):
    monkeypatch.setattr(grep, "STEP", step)
    rng = random.Random(step)
    texts = ["", "ab", "\n", "ab\n", "\nab", "x" * 600 + "ab" + "y" * 600, "\n" * 300 + "ab" + "\n" * 300]
    texts += ["".join(rng.choices("ab\né" + "c" * rng.randrange(40), k=rng.randrange(1500))) for _ in range(30)]
    texts.append(None)
    df = spark.createDataFrame(list(enumerate(texts)), "file long, content string")
    want = []
    for i, text in enumerate(texts):
        data = (text or "").encode()
        for m in re.finditer(b"a(?=(\nb|b))", data):
            end = m.end(1)
            start = data.rfind(b"\n", 0, m.start()) + 1
            stop = data.find(b"\n", end)
            line = data[start : len(data) if stop < 0 else stop].decode()
            want.append((i, m.start(), end, start, line))
    columns = ("file", "from_off", "to_off", "line_off", "line")
    got = grep_lines(df, "a\\n?b", byte_offset=True).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    raw = df.withColumn("content", F.encode("content", "utf-8"))
    got = grep_lines(raw, "a\\n?b", byte_offset=True).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_grep_is_linear(spark):
    def seconds(n):
        df = spark.createDataFrame([(0, ("ab " + "\n" * (n % 2)) * n)], "file long, content string")
        least = []
        for _ in range(3):
            began = time.perf_counter()
            found = grep_lines(df, "ab", byte_offset=True).agg(F.count("line_off"), F.sum("line_off")).first()
            least.append(time.perf_counter() - began)
            assert found[0] == n
        return min(least)

    seconds(1001)
    assert seconds(160001) < 6 * seconds(40001) + 1


COLUMNS = (
    "seq long, ip_version int, frag_offset int, more_fragments boolean, protocol int,"
    " src_addr string, dst_addr string, src_port int, dst_port int, payload string"
)


@pytest.fixture(scope="module")
def packets(spark):
    def tcp(seq, src, payload, **other):
        row = dict(v=4, frag=0, more=False, proto=6, dst="s", port=1) | other
        return (
            seq, row["v"], row["frag"], row["more"], row["proto"], src, row["dst"], row["port"],
            80, payload,
        )

    rows = [
        tcp(5, "a", "foo"), tcp(6, "b", "xx"), tcp(7, "a", "bar end"), tcp(8, "a", "", v=4),
        tcp(9, "a", "foobar", v=6), tcp(10, "a", "foobar", frag=3), tcp(11, "a", "x", more=True),
        tcp(12, "a", "x", proto=1), tcp(13, "c", "foobar", proto=17), tcp(14, "b", "obar"),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def test_packet_reports(packets):
    eligible = pk.eligible_packets(packets)
    flows = {r["seq"]: r["stream_id"] for r in pk.assign_streams(eligible).collect()}
    assert flows == {5: 0, 6: 1, 7: 0, 13: 2, 14: 1}
    assert tuple(pk.payload_stats(eligible).first()) == (5, 3, 22, 4, 7)
    rules = [Rule(1, "foobar", "L"), Rule(2, "end$", "L")]
    block = {tuple(r)[:4] for r in pk.scan_packets(eligible, rules, "block").collect()}
    assert block == {(13, 1, 0, 6), (7, 2, 4, 7)}
    stream = {tuple(r)[:4] for r in pk.scan_packets(eligible, rules, "STREAM").collect()}
    assert stream == {(0, 1, 0, 6), (2, 1, 0, 6), (0, 2, 7, 10)}
    rates = {r["mode"]: r for r in pk.match_rate(eligible, rules, seconds={"stream": 2.0}).collect()}
    assert rates["stream"]["n_matches"] == 3 and rates["block"]["n_matches"] == 2
    assert rates["stream"]["matches_per_kb"] == pytest.approx(3 / (22 / 1024))
    assert rates["stream"]["megabits_per_sec"] == pytest.approx(22 * 8 / 2 / 1e6)
    assert rates["block"]["megabits_per_sec"] is None
    with pytest.raises(RuleError):
        pk.scan_packets(eligible, rules, "vectored")


def test_tags(spark):
    df = spark.createDataFrame(
        [
            (0, "pay 4111111111111111 now"),
            (1, "at 10.0.0.255, ok"),
            (2, "me@example.com"),
            (3, "write to me@example.com."),
            (4, "x"),
        ],
        "doc_id long, text string",
    )
    plain = {(r["doc_id"], r["tag"]) for r in tag_pii(df).collect()}
    assert {(0, "credit_card"), (1, "ipv4_address"), (2, "email_address")} <= plain
    assert (3, "email_address") not in plain  # the preset wants the whole text
    strict = {(r["doc_id"], r["tag"]) for r in tag_pii(df, strict=True).collect()}
    assert strict == {
        (0, "credit_card"), (1, "ipv4_address"), (1, "float_number"), (2, "email_address"),
        (3, "email_address"),
    }
    assert [r.rule_id for r in preset_rules()] == [1, 2, 3, 4]


def test_spread_leaves_wide_inputs_alone(spark):
    wide = spark.range(0, 100, 1, 16)
    assert spread(wide, "id") is wide
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == cores
