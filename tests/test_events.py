import pytest
from pyspark.sql import functions as F

from patternscan.functions.syntax import Rule, RuleError
from patternscan.operators import events as ev
from patternscan.operators.scan import scan_events


@pytest.fixture(scope="module")
def found(spark):
    texts = ["aab cb aaa", "b", "cccb a", "", "abcabcabc" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rules = [Rule(1, "a+"), Rule(2, "b", "L"), Rule(3, "c+b", "L")]
    return scan_events(df, rules).cache()


def ordered(df):
    return sorted((r["doc_id"], r["to_off"], r["rule_id"], r["from_off"]) for r in df.collect())


@pytest.mark.parametrize("slot", [1 << 20, 7])
@pytest.mark.parametrize("scope", ["scan", "rule"])
def test_coalesce(found, scope, slot, monkeypatch):
    monkeypatch.setattr(ev, "SLOT", slot)
    merged = {}
    for doc, to, rule, start in ordered(found):
        runs = merged.setdefault((doc,) if scope == "scan" else (doc, rule), [])
        if runs and runs[-1][:2] == [rule, start] and runs[-1][2] < to:
            runs[-1][2] = to
        else:
            runs.append([rule, start, to])
    want = sorted((k[0], to, rule, start) for k, v in merged.items() for rule, start, to in v)
    assert ordered(ev.coalesce_events(found, scope=scope)) == want


def test_limits_and_stops(found):
    rows = ordered(found)
    per_doc = {d: [r for r in rows if r[0] == d] for d in {r[0] for r in rows}}
    limited = ev.limit_events(found, 2)
    assert ordered(limited) == sorted(r for v in per_doc.values() for r in v[:2])
    truncated = {r["doc_id"]: r["truncated"] for r in limited.collect()}
    assert truncated == {d: len(v) > 2 for d, v in per_doc.items()}
    assert ev.limit_events(found, 0).count() == 0

    def until_stop(v):
        at = [i for i, r in enumerate(v) if r[2] == 3]
        return v[: at[0] + 1] if at else v

    want = sorted(r for v in per_doc.values() for r in until_stop(v))
    assert ordered(ev.stop_after(found, F.col("rule_id") == 3)) == want
    first = {}
    for r in rows:
        first.setdefault((r[0], r[2]), r)
    assert ordered(ev.single_match(found)) == sorted(first.values())
    assert ordered(ev.skip_after(found, 1)) == sorted(first.values())
    assert ev.skip_after(found, 3).count() == sum(
        min(3, sum(1 for r in rows if (r[0], r[2]) == k)) for k in first
    )


def test_offsets_and_starts(found):
    rows = ordered(found)
    kept = [r for r in rows if 3 <= r[1] <= 8 and r[1] - r[3] >= 2]
    assert ordered(ev.offset_filter(found, 3, 8, 2)) == kept
    assert all(r[3] == 0 for r in ordered(ev.start_of_match(found, False)))
    far = found.withColumn("to_off", F.col("to_off") + 70000)
    assert far.count() == ev.som_horizon(far, "small").filter(
        "from_off IS NULL OR to_off - from_off <= 65536"
    ).count()
    assert ev.som_horizon(far, "medium").filter("from_off IS NULL").count() == 0
    with pytest.raises(ValueError):
        ev.som_horizon(found, "tiny")


def test_combinations(spark):
    rows = [(0, 101, 5), (0, 102, 9), (1, 101, 4), (2, 102, 3), (2, 103, 2)]
    events = spark.createDataFrame(
        [(d, r, 0, t, 0) for d, r, t in rows],
        "doc_id long, rule_id int, from_off long, to_off long, flags int",
    )
    blocks = spark.createDataFrame([(i, 10) for i in range(4)], "doc_id long, n_bytes long")
    formulas = {1: "(101&102)", 2: "101 | 102 & !103", 3: "!101 & !102", 4: "!(102 | 103)"}
    got = ev.combine_rules(events, formulas, blocks=blocks).collect()
    assert {(r["doc_id"], r["rule_id"], r["to_off"]) for r in got} == {
        (0, 1, 9), (0, 2, 5), (1, 2, 4), (3, 3, 10), (3, 4, 10), (1, 4, 10),
    }
    assert ev.combine_rules(events, formulas).filter("rule_id > 2").count() == 0
    for bad in ("(1&", "1 2", "a", "1)", ""):
        with pytest.raises(RuleError):
            ev.parse_formula(bad)


def test_quiet(spark, found):
    rules = [Rule(1, "a", "Q"), Rule(2, "b"), Rule(3, "c")]
    assert ev.drop_quiet(found, rules).filter("rule_id = 1").count() == 0
    table = spark.createDataFrame([(1, "Q"), (2, "L")], "rule_id int, flags string")
    assert ordered(ev.drop_quiet(found, table)) == ordered(ev.drop_quiet(found, rules))


def test_records_counts_handler(spark, found):
    blocks = spark.createDataFrame([(i,) for i in range(5)], "doc_id long")
    recorded = {r["doc_id"]: r for r in ev.record_events(found, blocks=blocks).collect()}
    assert recorded[3]["matched"] is False and recorded[3]["events"] == []
    assert [e["to_off"] for e in recorded[2]["events"]] == [4, 4, 6]
    counts = {r["rule_id"]: r["n_matches"] for r in ev.count_events(found).collect()}
    assert sum(counts.values()) == ev.count_events(found, ()).first()["n_matches"]

    def longest(key, events, context):
        yield key[0], int(events["to_off"].max()) + context

    handled = ev.apply_handler(found, longest, "doc_id long, last long", context=100)
    assert {r["doc_id"]: r["last"] for r in handled.collect()}[0] == 110


@pytest.mark.parametrize("slot", [1 << 12, 5])
def test_limits_beyond_a_tasks_cut(found, slot, monkeypatch):
    monkeypatch.setattr(ev, "FINE_SLOT", slot)
    want = {n: ordered(ev.limit_events(found, n)) for n in (1, 4, 20)}
    keyless = found.withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    flagged = {r["doc_id"]: r["truncated"] for r in ev.limit_events(keyless, 4).collect()}
    monkeypatch.setattr(ev, "TASK_CUT", 1)
    assert {n: ordered(ev.limit_events(found, n)) for n in want} == want
    again = ev.limit_events(keyless, 4)
    assert {r["doc_id"]: r["truncated"] for r in again.collect()} == flagged
    assert again.columns == [*found.columns, "truncated"]
    assert ev.limit_events(found.limit(0), 4).count() == 0


@pytest.mark.parametrize("slot", [1 << 12, 5])
def test_segments(found, slot, monkeypatch):
    monkeypatch.setattr(ev, "FINE_SLOT", slot)
    keyed = found.withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    whole = {r["doc_id"]: r["events"] for r in ev.record_events(keyed).collect()}
    joined = {}
    rows = ev.record_segments(keyed, size=3).collect()
    for r in sorted(rows, key=lambda r: r["segment"]):
        before = joined.setdefault(r["doc_id"], [])
        assert len(before) == 3 * r["segment"] and 1 <= len(r["events"]) <= 3
        before.extend(r["events"])
    assert None in whole and joined == whole
    assert ev.record_segments(keyed.limit(0)).count() == 0


def test_handler_in_batches(spark, found):
    keyed = found.withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    want = {}
    for doc, to, rule, start in sorted(
        ((r["doc_id"], r["to_off"], r["rule_id"], r["from_off"]) for r in keyed.collect()), key=lambda r: r[1:]
    ):
        want.setdefault(doc, []).append((to, rule, start))

    def echo(key, batches, context):
        for i, pdf in enumerate(batches):
            assert len(pdf) <= context
            for e in pdf.itertuples():
                yield key[0], e.to_off, e.rule_id, e.from_off, i

    def first_rule_2(key, batches, context):
        for pdf in batches:
            if (pdf["rule_id"] == 2).any():
                yield key[0], int(pdf["to_off"][pdf["rule_id"] == 2].iloc[0])
                return

    # one task, so that batches hold the end of one key and the start of the next
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        schema = "doc_id long, to_off long, rule_id int, from_off long, batch int"
        rows = ev.apply_handler_batches(keyed, echo, schema, context=7).collect()
        got, batches = {}, {}
        for r in rows:
            got.setdefault(r["doc_id"], []).append((r["to_off"], r["rule_id"], r["from_off"]))
            batches.setdefault(r["doc_id"], []).append(r["batch"])
        assert got == want and None in got
        assert all(b == sorted(b) for b in batches.values()) and max(batches[4]) > 5
        stops = ev.apply_handler_batches(keyed, first_rule_2, "doc_id long, at long").collect()
        firsts = {d: [to for to, rule, _ in v if rule == 2] for d, v in want.items()}
        assert {r["doc_id"]: r["at"] for r in stops} == {d: v[0] for d, v in firsts.items() if v}
        empty = ev.apply_handler_batches(keyed.limit(0), echo, schema, context=7)
        assert empty.count() == 0
        every = ev.apply_handler_batches(found, lambda k, b, c: [(len(k), sum(map(len, b)))], "k int, n long", ())
        assert every.collect() == [(0, found.count())]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
