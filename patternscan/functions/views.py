"""Expressions over one row, as SQL text: byte view, positions, running sums.

Nothing built from these shuffles.  They are text rather than ``Column``
objects because a scan nests hundreds of calls per rule, and each ``Column``
call is a round trip to the JVM; text is parsed there once.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame

RUN = 128

_names = count()


def sql_text(value: str | None) -> str:
    """A string as a SQL literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column_name(name: str) -> str:
    """A column's name as SQL."""
    return "`" + name.replace("`", "``") + "`"


def each(array: str, body) -> str:
    """``transform``; ``body`` gets the name of the element."""
    x = f"x{next(_names)}"
    return f"transform({array}, {x} -> {body(x)})"


def each_indexed(array: str, body) -> str:
    x, i = f"x{next(_names)}", f"i{next(_names)}"
    return f"transform({array}, ({x}, {i}) -> {body(x, i)})"


def keep(array: str, test) -> str:
    x = f"x{next(_names)}"
    return f"filter({array}, {x} -> {test(x)})"


def zipped(a: str, b: str, body) -> str:
    x, y = f"x{next(_names)}", f"y{next(_names)}"
    return f"zip_with({a}, {b}, ({x}, {y}) -> {body(x, y)})"


def let(value: str, body) -> str:
    """``body(name)`` with ``value`` computed once per row.

    An alias is not enough: the optimizer may copy an aliased expression into
    a lambda, where it would run again for every array element.
    """
    return f"element_at({each(f'array({value})', body)}, 1)"


def byte_view(text: str) -> str:
    """One character per UTF-8 byte, so character positions are byte offsets.

    Text that is all ASCII already is its own byte view.
    """
    return (
        f"CASE WHEN octet_length({text}) = char_length({text}) THEN {text}"
        f" ELSE decode(encode({text}, 'UTF-8'), 'ISO-8859-1') END"
    )


def binary_view(payload: str) -> str:
    """The byte view of a binary value."""
    return f"decode({payload}, 'ISO-8859-1')"


def view_of(df: DataFrame, name: str) -> str:
    """The byte view of a string or binary column."""
    quoted = column_name(name)
    return binary_view(quoted) if is_binary(df, name) else byte_view(quoted)


def is_binary(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() == "binary"


def view_text(view: str) -> str:
    """The text whose bytes a view shows."""
    return f"CAST(encode({view}, 'ISO-8859-1') AS STRING)"


def cut_bytes(raw: str, start: str, end: str) -> str:
    """Bytes ``start .. end`` of a binary value, as a byte view.  Cutting a
    string instead would walk it from its first character."""
    return binary_view(f"substring({raw}, CAST({start} + 1 AS INT), CAST({end} - ({start}) AS INT))")


def bytes_between(text: str, start: str, end: str) -> str:
    """The text between two byte offsets of a string."""
    raw = f"CAST({text} AS BINARY)"
    return (
        f"CAST(substring({raw}, CAST({start} + 1 AS INT), CAST({end} - {start} AS INT)) AS STRING)"
    )


def quote(literal: str) -> str:
    """A string as a regular expression that matches exactly it."""
    return "".join(c if c.isalnum() and c.isascii() else f"\\x{{{ord(c):x}}}" for c in literal)


def inclusive_sums(values: str, start: str) -> str:
    """``[start, start + v1, start + v1 + v2, ...]`` for a short array."""
    a, x = f"a{next(_names)}", f"x{next(_names)}"
    step = f"concat({a}, array(element_at({a}, -1) + {x}))"
    return f"aggregate({values}, array({start}), ({a}, {x}) -> {step})"


def _exclusive(values: str, start: str) -> str:
    return f"slice({inclusive_sums(values, start)}, 1, size({values}))"


def running_sums(values: str) -> str:
    """Exclusive running sums of a bigint array, in time near linear in its
    size.

    Sums run within pieces of ``RUN`` elements and over the piece totals; one
    running concat over the whole array would copy it once per element.
    """

    def pieces(v):
        numbers = f"sequence(0, CAST((size({v}) - 1) DIV {RUN} AS INT))"
        return each(numbers, lambda b: f"slice({v}, {b} * {RUN} + 1, {RUN})")

    def total(p):
        a, x = f"a{next(_names)}", f"x{next(_names)}"
        return f"aggregate({p}, 0L, ({a}, {x}) -> {a} + {x})"

    def shift(parts):
        return let(
            inclusive_sums(each(parts, total), "0L"),
            lambda base: "flatten("
            + each_indexed(parts, lambda p, i: _exclusive(p, f"get({base}, {i})"))
            + ")",
        )

    return let(
        values,
        lambda v: f"CASE WHEN size({v}) = 0 THEN CAST(array() AS ARRAY<BIGINT>)"
        f" WHEN size({v}) <= {RUN} THEN {_exclusive(v, '0L')}"
        f" ELSE {let(pieces(v), shift)} END",
    )


def positions(text: str, pattern: str) -> str:
    """Every 0-based position at which ``pattern`` matches, overlaps included.

    One pass: ``split`` at a look-ahead cuts the text at exactly these
    positions.  It never cuts at position 0, which is asked for separately.
    """
    cut = f"concat('(?=', {pattern}, ')')"
    lengths = each(f"split({text}, {cut}, -1)", lambda p: f"CAST(char_length({p}) AS BIGINT)")
    at_zero = f"regexp_like({text}, concat('\\\\A', {pattern}))"
    return let(
        running_sums(lengths),
        lambda s: f"CASE WHEN {at_zero} THEN {s} ELSE slice({s}, 2, size({s})) END",
    )

