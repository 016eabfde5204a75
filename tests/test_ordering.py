from bisect import bisect_right
from collections import Counter

import pytest
from pyspark.sql import functions as F

from patternscan.functions.syntax import Rule
from patternscan.operators import packets as pk
from patternscan.streaming import ordering
from patternscan.streaming.ordering import block_of, dense_order, order_bounds


@pytest.mark.parametrize("count", [0, 1, 2, 3, 9, 50])
def test_blocks(spark, count):
    bounds = sorted({(i * i * 37 - 400) for i in range(count)})
    values = sorted({b + d for b in [*bounds, 0] for d in (-1, 0, 1)})
    df = spark.createDataFrame([(v,) for v in values], "`at it` long")
    got = {r[0]: r[1] for r in df.select("at it", block_of("at it", bounds)).collect()}
    assert got == {v: bisect_right(bounds, v) for v in values}


def test_sparse_orders_make_even_blocks(spark):
    # a hot key with two thirds of the rows; order numbers far apart and in bursts
    n = 20000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("key"),
        (F.col("id") * 1000003 + F.when(F.col("id") > n // 2, 10**12).otherwise(0)).alias("seq"),
    )
    bounds = order_bounds(rows, "seq", 1000)
    assert len(bounds) == 19
    sizes = rows.groupBy(block_of("seq", bounds)).count().collect()
    assert len(sizes) == 20 and max(r["count"] for r in sizes) < 1200
    got = dense_order(rows, ("key",), "seq", "place", bounds).collect()
    seen, want = Counter(), {}
    for r in sorted(rows.collect(), key=lambda r: r["seq"]):
        want[r["seq"]] = seen[r["key"]]
        seen[r["key"]] += 1
    assert {r["seq"]: r["place"] for r in got} == want


def test_order_of_nothing_and_of_ties(spark):
    empty = spark.createDataFrame([], "key long, seq long")
    assert order_bounds(empty, "seq") == [] and dense_order(empty, ("key",), "seq", "at").count() == 0
    same = spark.createDataFrame([(1, 5), (1, 5), (1, None), (2, 5), (2, 6)], "key long, seq long")
    bounds = order_bounds(same, "seq", 1)
    got = sorted((r["key"], r["at"]) for r in dense_order(same, ("key",), "seq", "at", bounds).collect())
    assert got == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1)]


def test_packets_of_one_flow_far_apart(spark, monkeypatch):
    monkeypatch.setattr(ordering, "BLOCK_ROWS", 100)
    monkeypatch.setattr(ordering.order_bounds, "__defaults__", (100,))
    packets = spark.range(3000).select(
        (F.col("id") * 999983).alias("seq"),
        F.lit(4).alias("ip_version"),
        F.lit(0).alias("frag_offset"),
        F.lit(False).alias("more_fragments"),
        F.lit(6).alias("protocol"),
        F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("src_addr"),
        F.lit("s").alias("dst_addr"),
        F.lit(1).alias("src_port"),
        F.lit(80).alias("dst_port"),
        F.format_string("%d;", F.col("id")).cast("binary").alias("payload"),
    )
    numbers = {r["src_addr"]: r["stream_id"] for r in pk.assign_streams(packets).collect()}
    text, flows = {}, []
    for r in sorted(packets.collect(), key=lambda r: r["seq"]):
        if r["src_addr"] not in text:
            flows.append(r["src_addr"])
        text[r["src_addr"]] = text.get(r["src_addr"], "") + bytes(r["payload"]).decode()
    assert numbers == {f: i for i, f in enumerate(flows)}
    found = pk.scan_packets(packets, [Rule(1, "1;[0-9]", "L")], "stream").collect()
    got = sorted((r["stream_id"], r["from_off"], r["to_off"]) for r in found)
    want = []
    for flow, all_of in text.items():
        at = all_of.find("1;")
        while at >= 0:
            if at + 2 < len(all_of):
                want.append((numbers[flow], at, at + 3))
            at = all_of.find("1;", at + 1)
    assert got == sorted(want)
