"""Times the headline queries and the throughput of single-rule scans.

Prints one JSON line.  ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and
cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from patternscan.functions.presets import preset_rules  # noqa: E402
from patternscan.functions.syntax import Rule  # noqa: E402
from patternscan.operators.scan import match_any, scan_events  # noqa: E402
from patternscan.queries import QUERIES, table  # noqa: E402

HEADLINE = (
    "q_pii_by_lang",
    "q_match_any_license",
    "q_match_rules_parts",
    "q_prefilter_rules",
    "q_scan_events_digits",
    "q_scan_events_endings",
    "q_scan_leftmost_numbers",
    "q_captures_offsets",
    "q_find_all_3",
    "q_scan_literals_dictionary",
    "q_vectored_lines",
    "q_edit_distance",
    "q_coalesce_rule",
    "q_combine_and_not",
    "q_stream_scan",
    "q_stream_documents",
    "q_stream_find",
    "q_grep_lines",
    "q_scan_packets_stream",
)

# The six patterns of the published throughput table.
PATTERNS = {
    "Easy0": "ABCDEFGHIJKLMNOPQRSTUVWXYZ$",
    "Easy0i": "(?i)ABCDEFGHIJklmnopqrstuvwxyz$",
    "Easy1": "A[AB]B[BC]C[CD]D[DE]E[EF]F[FG]G[GH]H[HI]I[IJ]J$",
    "Medium": "[XYZ]ABCDEFGHIJKLMNOPQRSTUVWXYZ$",
    "Hard": "[ -~]*ABCDEFGHIJKLMNOPQRSTUVWXYZ$",
    "Hard1": "ABCD|CDEF|EFGH|GHIJ|IJKL|KLMN|MNOP|OPQR|QRST|STUV|UVWX|WXYZ",
}
COPIES = 8  # of the documents, so that a scan outlasts the start of a job


def run(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("patternscan-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # a scan costs far more per byte than a shuffle: keep its tasks small
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the executor threads and the Python workers
    run(spark.range(1000).repartition(int(cpus)).mapInPandas(lambda it: it, "id long"))

    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)

    texts = (
        table(spark, sf_dir, "documents")
        .select("doc_id", "text", F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("copy"))
        .repartition(2 * int(cpus), "doc_id", "copy")
        .cache()
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] / 1e6
    speed = {}
    for name, expression in PATTERNS.items():
        found = texts.filter(match_any("text", Rule(1, expression, "m"))).select("doc_id")
        speed[f"match_{name}"] = round(size / min(run(found), run(found)), 1)
    for name, rule in (
        ("scan_digits", Rule(1, r"\d+", "L")),
        ("scan_words", Rule(1, r"\bth[a-z]{1,3}\b", "L")),
        ("scan_card_preset", preset_rules(strict=True)[3]),
    ):
        found = scan_events(texts, rule)
        speed[name] = round(size / min(run(found), run(found)), 1)

    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "throughput_mb_per_s": speed,
                "scanned_mb": round(size, 1),
                "cpus": int(cpus),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
