"""Lines around the matches of a rule in whole files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patternscan.functions.syntax import Rule
from patternscan.functions.views import (
    binary_view,
    column_name,
    cut_bytes,
    each,
    is_binary,
    let,
    running_sums,
    view_of,
    view_text,
    zipped,
)
from patternscan.operators.scan import event_array

STEP = 256  # bytes from one entry of the index of lines to the next


def _events(df: DataFrame, expression: str, content: str) -> str:
    rule = Rule(0, expression, "Ls")
    if is_binary(df, content):
        return let(view_of(df, content), lambda v: event_array(v, rule, view=v))
    return event_array(column_name(content), rule)


def line_index(raw: str) -> str:
    """The lines of a binary value, for look-ups by offset.

    Element ``b`` is the line (``from``, ``to``) that holds offset ``b * STEP``,
    where a newline belongs to the line it ends.  One pass over the bytes, and
    one element for every ``STEP`` of them.
    """

    def places(lengths):
        def held(start, length):
            first, last = f"({start} + {STEP - 1}) DIV {STEP}", f"({start} + {length} - 1) DIV {STEP}"
            line = f"named_struct('from', {start}, 'to', {start} + {length} - 1)"
            return f"CASE WHEN {first} <= {last} THEN array_repeat({line}, CAST({last} - {first} + 1 AS INT)) END"

        lines = zipped(running_sums(lengths), lengths, held)
        return f"flatten(array_compact({lines}))"

    ended = each(f"split({binary_view(raw)}, '\\n', -1)", lambda x: f"CAST(char_length({x}) + 1 AS BIGINT)")
    return let(ended, places)


def grep_lines(
    df: DataFrame,
    expression: str,
    content: str = "content",
    keys: Sequence[str] = ("file",),
    byte_offset: bool = False,
) -> DataFrame:
    """One row per match (every end is one): ``keys..., from_off, to_off, line``
    where ``line`` reaches from the start of the line the match begins in to
    the end of the line it ends in.  ``byte_offset`` adds ``line_off``.

    A dot matches newlines and starts are tracked.  A match looks at less than
    ``STEP`` bytes on either side and then at the index of lines, so the cost is
    linear in the text and in what is returned.
    """
    keys = list(keys)
    raw = df.select(*keys, F.col(content).cast("binary").alias("_raw"), F.expr(_events(df, expression, content)).alias("_found"))
    indexed = raw.filter("size(_found) > 0").withColumn("_lines", F.expr(line_index("_raw")))
    found = indexed.select(*keys, "_raw", "_lines", F.explode("_found").alias("e")).select(
        *keys, "_raw", "_lines", "e.from_off", "e.to_off"
    )
    n = "CAST(octet_length(_raw) AS BIGINT)"
    step_before = f"from_off DIV {STEP}"
    step_after = f"least((to_off DIV {STEP} + 1) * {STEP}, {n})"
    before = cut_bytes("_raw", f"({step_before}) * {STEP}", "from_off")
    after = cut_bytes("_raw", "to_off", step_after)
    near_start = f"from_off - char_length(substring_index({before}, '\\n', -1))"
    near_end = f"to_off + char_length(substring_index({after}, '\\n', 1))"
    starts = f"CASE WHEN contains({before}, '\\n') THEN {near_start} ELSE get(_lines, CAST({step_before} AS INT)).from END"
    ends = f"CASE WHEN contains({after}, '\\n') OR {step_after} = {n} THEN {near_end} ELSE get(_lines, CAST({step_after} DIV {STEP} AS INT)).to END"
    placed = found.withColumns({"line_off": F.expr(starts), "_line_end": F.expr(ends)})
    line = F.expr(view_text(cut_bytes("_raw", "line_off", "_line_end"))).alias("line")
    lines = placed.select(*keys, "from_off", "to_off", "line_off", line)
    return lines if byte_offset else lines.drop("line_off")


def grep_totals(df: DataFrame, expression: str, content: str = "content") -> DataFrame:
    """Files and bytes scanned, files with a match, and matches."""
    hits = F.coalesce(F.size(F.expr(_events(df, expression, content))), F.lit(0))
    return df.select(F.octet_length(content).alias("_n"), hits.alias("_hits")).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_bytes"),
        F.count_if(F.col("_hits") > 0).alias("files_matched"),
        F.coalesce(F.sum("_hits"), F.lit(0)).cast("long").alias("n_matches"),
    )
