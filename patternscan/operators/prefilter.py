"""Cheap superset first, exact check second, for rule sets of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patternscan.functions.views import is_binary, view_of
from patternscan.operators.grams import MAX_INDEX_ROWS, fold_ascii, gram_pairs, pair_rows
from patternscan.operators.windows import is_near, matches_window, windows
from patternscan.plans.ruleset import MAX_BROADCAST_ROWS, broadcast_slices, prepared_table, worker_rules

MIN_LITERAL = 3


def prefilter_verify(
    df: DataFrame,
    rules,
    text: str = "text",
    keys: Sequence[str] = ("doc_id",),
    max_index_rows: int = MAX_INDEX_ROWS,
) -> DataFrame:
    """``keys..., rule_id`` of every match: the literal a rule requires picks
    candidate pairs, the rule itself decides.  A rules table takes the gram
    join at any size; a list is unrolled with a substring test first."""
    from patternscan.operators.scan import _with_worker_hits, match_rules

    if not isinstance(rules, DataFrame):
        return match_rules(df, rules, text, keys)
    table = prepared_table(rules)
    risky = worker_rules(table, F.col("stack_risk"))
    pairs = rule_pairs(df, table.filter("NOT stack_risk"), text, keys, max_index_rows, False)
    return _with_worker_hits(pairs.select(*keys, "rule_id"), df, risky, text, keys)


def rule_pairs(
    df: DataFrame,
    table: DataFrame,
    text: str,
    keys: Sequence[str],
    max_index_rows: int = MAX_INDEX_ROWS,
    with_text: bool = True,
) -> DataFrame:
    """Every (row, rule) that match, with the row's text (``_text``), its byte
    view (``_view``) and the columns of the prepared rule; without the texts if
    nobody asks for them.

    Rules are found by the literal they require, or else by a set of texts of
    which every match contains one, and bounded rules over bytes are decided
    there.  Only rules without any such text of ``MIN_LITERAL`` bytes are
    tested on each row.
    """
    literal, sets_of = has_literal(), has_set(df, table, text)
    sets = with_factors(table)
    wanted = ["_text", "_view"] if with_text else []
    parts = []
    for caseless, these in ((False, literal | (sets_of & ~F.col("caseless"))), (True, sets_of & F.col("caseless"))):
        for near in (True, False):
            same = sets.filter(these).filter(is_near() if near else ~is_near())
            if same.limit(1).collect():
                by = _by_windows if near else _by_factors
                parts.append(by(df, same, table.columns, text, keys, caseless, max_index_rows, wanted))
    others = table.filter(~literal & ~sets_of)
    if others.limit(1).collect() or not parts:
        parts.append(_by_test(df, others, text, keys).select(*keys, *wanted, *table.columns))
    return reduce(DataFrame.unionByName, parts)


def has_literal() -> Column:
    """Rules found by the one literal that they require."""
    return F.coalesce(F.length("literal") >= MIN_LITERAL, F.lit(False)) & ~F.contains("flags", F.lit("8"))


def has_set(df: DataFrame, table: DataFrame, text: str) -> Column:
    """Other rules, found by a set of texts."""
    factors = F.array_min(F.transform(_factors(table), F.char_length))
    sets_of = ~has_literal() & F.coalesce(factors >= MIN_LITERAL, F.lit(False))
    if not is_binary(df, text):
        return sets_of
    # a byte there is a character to a rule over characters
    utf8 = F.contains(F.col("flags"), F.lit("8"))
    return sets_of & (~utf8 | ~F.exists("any_of", lambda t: t.rlike(r"[^\x00-\x7f]")))


def with_factors(table: DataFrame) -> DataFrame:
    """The rules with the texts that find them (``_set``) and a number (``_rid``)."""
    one = F.when(has_literal(), F.array("literal")).otherwise(_factors(table))
    return table.withColumn("_set", one).withColumn("_rid", F.xxhash64(*table.columns))


def _factors(table: DataFrame) -> Column:
    """The texts of ``any_of`` as byte views."""
    wide = F.transform("any_of", lambda t: F.decode(F.encode(t, "UTF-8"), "ISO-8859-1"))
    return F.when(F.contains(F.col("flags"), F.lit("8")), wide).otherwise(F.col("any_of"))


def _factor_rows(sets: DataFrame) -> DataFrame:
    factors = sets.select("_rid", F.explode("_set").alias("_one")).distinct()
    return factors.select("_rid", F.encode("_one", "ISO-8859-1").alias("lit"))


def searched(texts: DataFrame, caseless: bool) -> DataFrame:
    """Texts with the bytes in which factors are looked up (``_raw``) and those that
    are cut (``_bytes``); caseless texts are looked up in the folded row."""
    folded = fold_ascii(F.col("_view")) if caseless else F.col("_view")
    return texts.withColumn("_raw", F.encode(folded, "ISO-8859-1")).withColumn(
        "_bytes", F.encode("_view", "ISO-8859-1") if caseless else F.col("_raw")
    )


def _with_rules(pairs: DataFrame, rules: DataFrame) -> DataFrame:
    few = rules.count() <= MAX_BROADCAST_ROWS
    return pairs.join(F.broadcast(rules) if few else rules, "_rid")


def _by_factors(df, sets, columns, text, keys, caseless, max_index_rows, wanted) -> DataFrame:
    """Rules (with ``_set`` and ``_rid``) on the rows that may hold one of the
    rule's texts."""
    texts = searched(_texts(df, text, keys), caseless)
    pairs = gram_pairs(texts, _factor_rows(sets), keys, "_raw", ["_text", "_view"], max_index_rows)
    found = _with_rules(pairs, sets.select("_rid", *columns))
    subject = F.when(F.contains(F.col("flags"), F.lit("8")), F.col("_text")).otherwise(F.col("_view"))
    return found.filter(F.regexp_like(subject, F.col("forward"))).select(*keys, *wanted, *columns)


def _by_windows(df, sets, columns, text, keys, caseless, max_index_rows, wanted) -> DataFrame:
    """The same for rules that are decided around their texts."""
    texts = searched(_texts(df, text, keys), caseless)
    rules = sets.select("_rid", "forward", "max_width").distinct()
    around = windows(texts, _factor_rows(sets), rules, keys, ["_row"], max_index_rows)
    pairs = pair_rows(texts, around.filter(matches_window()), keys, "_raw", wanted)
    return _with_rules(pairs, sets.select("_rid", *columns)).select(*keys, *wanted, *columns)


def literal_windows(df, table, text, keys, carry, max_index_rows) -> DataFrame:
    """The windows of rules that require one literal (``lit``), with their columns."""
    sets = with_factors(table)
    texts = searched(_texts(df, text, keys), False)
    rules = sets.select("_rid", *table.columns, F.encode("literal", "ISO-8859-1").alias("lit"))
    return windows(texts, _factor_rows(sets), rules, keys, carry, max_index_rows)


def _texts(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    view = F.expr(view_of(df, text))
    return df.select(
        *keys, (view if is_binary(df, text) else F.col(text)).alias("_text"), view.alias("_view")
    )


def _by_test(df, table, text, keys) -> DataFrame:
    """Every rule is tested on every row; the rules are broadcast, in slices if
    there are many."""
    texts = _texts(df, text, keys)
    utf8 = F.contains(F.col("flags"), F.lit("8"))
    subject = F.when(utf8, F.col("_text")).otherwise(F.col("_view"))
    parts = [
        texts.join(rules, F.regexp_like(subject, F.col("forward")))
        for rules in broadcast_slices(table)
    ]
    return reduce(DataFrame.unionByName, parts)
