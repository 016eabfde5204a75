"""Reports over a table of captured packets: ``seq, ip_version, frag_offset,
more_fragments, protocol, src_addr, dst_addr, src_port, dst_port, payload``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patternscan.functions.syntax import RuleError
from patternscan.operators.scan import scan_events
from patternscan.streaming.chunks import scan_stream
from patternscan.streaming.ordering import dense_order, order_bounds

# IP protocol numbers.
TCP, UDP = 6, 17
# Columns that make a flow.
FLOW = ("protocol", "src_addr", "dst_addr", "src_port", "dst_port")
# Names of scan modes.
MODES = {"block": "block", "nostream": "block", "stream": "stream", "vectored": "vectored"}


def parse_mode(mode: str) -> str:
    """Canonical scan mode; an unknown one is an error."""
    if mode.lower() not in MODES:
        raise RuleError(f"database mode {mode}, invalid")
    return MODES[mode.lower()]


def eligible_packets(packets: DataFrame) -> DataFrame:
    """IPv4, whole (no fragment), TCP or UDP, with a payload."""
    return packets.filter(
        (F.col("ip_version") == 4)
        & (F.col("frag_offset") == 0)
        & ~F.col("more_fragments")
        & F.col("protocol").isin(TCP, UDP)
        & (F.octet_length("payload") > 0)
    )


def assign_streams(packets: DataFrame) -> DataFrame:
    """Packets with the ``stream_id`` of their directional flow; flows are
    numbered from 0 in order of first appearance.

    Flows are equal when their five columns are.  The numbering runs over the
    flows only, in blocks of equal shares of the packets, and joins back on the
    flow.
    """
    return _flows(packets, order_bounds(packets, "seq"))


def _flows(packets: DataFrame, bounds: list[int]) -> DataFrame:
    flows = packets.groupBy(*FLOW).agg(F.min("seq").alias("_first"))
    # a flow begins with a packet: a block has no more of them than of packets
    numbered = dense_order(flows, (), "_first", "stream_id", bounds)
    numbered = numbered.select("stream_id", *(F.col(c).alias(f"_{c}") for c in FLOW))
    same = F.lit(True)
    for c in FLOW:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return packets.join(numbered, same).select(*packets.columns, "stream_id")


def payload_stats(packets: DataFrame) -> DataFrame:
    """Packets, flows, bytes and whole-number average lengths."""
    per_flow = packets.groupBy(*FLOW).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("payload").cast("long")).alias("b")
    )
    totals = per_flow.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_packets"),
        F.count(F.lit(1)).alias("n_streams"),
        F.coalesce(F.sum("b"), F.lit(0)).cast("long").alias("n_bytes"),
    )

    def average(of: str) -> Column:
        return F.when(F.col(of) > 0, F.expr(f"n_bytes div {of}"))

    return totals.select(
        "n_packets",
        "n_streams",
        "n_bytes",
        average("n_packets").alias("avg_packet_len"),
        average("n_streams").alias("avg_stream_len"),
    )


def scan_packets(packets: DataFrame, rules, mode: str = "block") -> DataFrame:
    """Events of every payload: by packet (``seq``) in block mode, by flow
    (``stream_id``) in stream mode, where the matches that need the end of a
    flow come when it is closed.

    Packet numbers count all flows, so those of one flow lie far apart; a flow's
    packets are numbered anew before they are gathered into runs.
    """
    mode = parse_mode(mode)
    if mode == "vectored":
        raise RuleError("packets are scanned in block or stream mode")
    if mode == "block":
        return scan_events(packets, rules, "payload", ("seq",))
    bounds = order_bounds(packets, "seq")
    chunks = _flows(packets, bounds).select("stream_id", "seq", "payload")
    placed = dense_order(chunks, ("stream_id",), "seq", "_place", bounds)
    return scan_stream(placed, rules, ("stream_id",), "_place", "payload", close=True)


def match_rate(
    packets: DataFrame, rules, modes=("stream", "block"), seconds: dict[str, float] | None = None
) -> DataFrame:
    """Matches and matches per kilobyte for each mode, side by side; megabits
    per second where the duration of a mode is given."""
    parts = None
    for mode in modes:
        counted = scan_packets(packets, rules, mode).agg(F.count(F.lit(1)).alias("n_matches"))
        counted = counted.withColumn("mode", F.lit(parse_mode(mode)))
        parts = counted if parts is None else parts.unionByName(counted)
    size = packets.agg(
        F.coalesce(F.sum(F.octet_length("payload").cast("long")), F.lit(0)).alias("n_bytes")
    )
    # one row against two
    joined = parts.join(F.broadcast(size), F.lit(True))
    rate = F.when(F.col("n_bytes") > 0, F.col("n_matches") / (F.col("n_bytes") / F.lit(1024.0)))
    columns = ["mode", "n_matches", "n_bytes", rate.alias("matches_per_kb")]
    if seconds:
        took = F.create_map(*(F.lit(x) for kv in seconds.items() for x in kv))
        bits = F.col("n_bytes") * 8 / F.try_element_at(took, F.col("mode")) / 1e6
        columns.append(bits.alias("megabits_per_sec"))
    return joined.select(*columns)
