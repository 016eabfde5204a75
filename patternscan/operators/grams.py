"""Exact literal occurrences by an equi-join on byte grams.

A literal of class k has at least 2^k bytes.  The text gives up one gram of
``q`` bytes at every ``stride``-th position, the dictionary the grams at the
literal's first ``stride`` offsets, with q + stride - 1 = 2^k: every occurrence
meets exactly one of them, so there is one candidate per occurrence and the
text side shrinks by the stride.  All classes share one pass over the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRIDES = {0: 1, 1: 1, 2: 1, 3: 2, 4: 4, 5: 16, 6: 32}
TOP_CLASS = max(STRIDES)
MAX_INDEX_ROWS = 1_000_000  # index rows that may be broadcast, about 100 bytes each


def _gram_length(k: int) -> int:
    return (1 << k) - STRIDES[k] + 1


def _by_class(column: str, value, classes: Iterable[int] = STRIDES) -> str:
    cases = " ".join(f"WHEN {k} THEN {value(k)}" for k in classes)
    return f"CASE {column} {cases} END"


def _gram(raw: str, start: str, k: str = "_k", classes: Iterable[int] = STRIDES) -> str:
    """Hash of the gram at ``start``: a number joins faster than bytes, and
    candidates are compared byte by byte anyway."""
    length = _by_class(k, _gram_length, sorted(classes) or STRIDES)
    return f"xxhash64({k}, substring({raw}, {start} + 1, {length}))"


def fold_ascii(text: Column) -> Column:
    """Lower case for A-Z only: what caseless means for bytes."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def _row_hash(keys: Sequence[str], raw: str) -> Column:
    return F.xxhash64(*keys, raw).alias("_row")


def _same_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for i, k in enumerate(keys):
        df = df.filter(F.col(k).eqNullSafe(F.col(f"_key{i}")))
    return df


def _candidates(
    df: DataFrame, literals: DataFrame, keys: Sequence[str], raw: str, keep: Sequence[str], max_index_rows: int,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``keys, _row, _p, keep, lit, _len, _j``: a gram of the text at ``_p`` that
    equals the literal's gram at ``_j``.

    Grams leave their text behind: carried along, a text would be copied once for
    each of its bytes.  ``_row``, a hash of the row, brings them back to it.
    """
    top = f"CAST(least({TOP_CLASS}, floor(log2(octet_length(lit)))) AS INT)"
    sized = literals.select(
        *keep, "lit", F.expr("octet_length(lit) AS _len"), F.expr(f"{top} AS _k")
    ).filter("_len > 0")
    counts = {r["_k"]: r["count"] for r in sized.groupBy("_k").count().collect()}
    offsets = f"explode(sequence(0, {_by_class('_k', lambda k: STRIDES[k] - 1)}))"
    index = sized.select("*", F.expr(f"{offsets} AS _j")).withColumn(
        "_gram", F.expr(_gram("lit", "_j"))
    )

    # class and position in one number: position * 8 + class
    def cuts(k):
        last, step = f"(octet_length({raw}) - {_gram_length(k)}) * 8L + {k}", STRIDES[k] * 8
        enough = f"octet_length({raw}) >= {_gram_length(k)}"
        nothing = "CAST(array() AS ARRAY<BIGINT>)"
        return f"CASE WHEN {enough} THEN sequence({k}L, {last}, {step}L) ELSE {nothing} END"

    every = ", ".join(cuts(k) for k in sorted(counts)) or "CAST(array() AS ARRAY<BIGINT>)"
    few = sum(n * STRIDES[k] for k, n in counts.items()) <= max_index_rows
    carry = list(carry) if few else []  # within one stage a text is not copied
    # the hash is made before grams are: above them it would be made for each
    wanted = list(dict.fromkeys([*keys, *carry, raw]))
    places = df.select(*wanted, _row_hash(keys, raw)).withColumn("_cut", F.explode(F.expr(f"concat({every})")))
    # places become rows and then grams: inside a lambda a gram costs many times as much
    grams = places.select(
        *dict.fromkeys([*keys, *carry]),
        "_row",
        F.expr(_gram(raw, "CAST(shiftright(_cut, 3) AS INT)", "CAST(_cut & 7 AS INT)", counts)).alias("_gram"),
        F.expr("CAST(shiftright(_cut, 3) AS INT)").alias("_p"),
    )
    index = index.drop("_k")
    candidates = grams.join(F.broadcast(index) if few else index.hint("shuffle_hash"), "_gram")
    return candidates.filter("_p >= _j").drop("_gram")


def gram_occurrences(
    df: DataFrame,
    literals: DataFrame,
    keys: Sequence[str],
    raw: str,
    keep: Sequence[str] = (),
    carry: Sequence[str] = (),
    max_index_rows: int = MAX_INDEX_ROWS,
) -> DataFrame:
    """Every occurrence of every literal.

    ``df`` has ``keys`` and the binary column ``raw``; ``literals`` has the
    binary column ``lit`` and the columns ``keep``.  Returns ``keys``, ``keep``,
    ``_from`` and the text columns ``carry`` of the row; ``_row`` among them is
    a hash of the keys and ``raw``.
    """
    keys, keep, carry = list(keys), list(keep), list(carry)
    told = [c for c in carry if c != "_row"]
    candidates = _candidates(df, literals, keys, raw, keep, max_index_rows, [*told, raw])
    if raw in candidates.columns:
        hits = candidates.filter(F.expr(f"substring({raw}, _p - _j + 1, _len) = lit"))
        return hits.select(*keys, *keep, *carry, F.expr("CAST(_p - _j AS BIGINT) AS _from"))
    # each different row once; rows that repeat one have candidates of their own
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    rows = df.select(*named, *told, raw, _row_hash(keys, raw)).repartition("_row")
    rows = rows.dropDuplicates(["_row", *(f"_key{i}" for i in range(len(keys)))])
    same = F.expr(f"substring({raw}, _p - _j + 1, _len) = lit")
    hits = _same_keys(candidates.join(rows, "_row"), keys).filter(same)
    return hits.select(*keys, *keep, *carry, F.expr("CAST(_p - _j AS BIGINT) AS _from"))


def gram_pairs(
    df: DataFrame,
    factors: DataFrame,
    keys: Sequence[str],
    raw: str,
    carry: Sequence[str],
    max_index_rows: int = MAX_INDEX_ROWS,
) -> DataFrame:
    """``keys, _rid, carry``: each row with each rule (``_rid``, a long) that may
    find one of its texts there, once; whoever asks decides.

    ``factors`` has ``_rid`` and the binary column ``lit``.  Pairs are narrow until
    they are different, and then fetch the columns ``carry`` of their row.
    """
    found = _candidates(df, factors, list(keys), raw, ["_rid"], max_index_rows)
    return pair_rows(df, found, keys, raw, carry)


def pair_rows(df: DataFrame, found: DataFrame, keys: Sequence[str], raw: str, carry: Sequence[str]) -> DataFrame:
    """``keys, _rid, carry``: each row with each rule that ``found`` has for its
    ``_row``, once; rows that are repeated stay so."""
    keys = list(keys)
    found = found.select(*keys, "_row", "_rid").distinct()
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    rows = df.select(*named, *carry, _row_hash(keys, raw))
    return _same_keys(found.join(rows, "_row"), keys).select(*keys, "_rid", *carry)
