"""Tag rows with the ready-made rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patternscan.functions.presets import PRESET_NAMES, preset_rules
from patternscan.operators.scan import match_rules


def tag_pii(
    df: DataFrame,
    text: str = "text",
    keys: Sequence[str] = ("doc_id",),
    strict: bool = False,
) -> DataFrame:
    """``keys..., rule_id, tag`` for every preset that a row matches."""
    hits = match_rules(df, preset_rules(strict), text, keys)
    names = F.create_map(*(F.lit(x) for item in PRESET_NAMES.items() for x in item))
    return hits.select(*keys, "rule_id", F.element_at(names, F.col("rule_id")).alias("tag"))
