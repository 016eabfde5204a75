"""Rule feeds: text lines or strings to a rules table and a rejects table.

One job of column expressions, so a dictionary of millions of lines is read
like any other table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patternscan.functions.syntax import (
    ALL_ENDS,
    DEPRECATED_FLAGS,
    FLAG_BITS,
    LEFTMOST,
    LEFTMOST_FLAGS,
    LITERAL,
    RuleError,
)
from patternscan.functions.views import each, keep, let
from patternscan.operators.audit import audit_rules
from patternscan.plans.ruleset import EXT_KEYS, EXT_TYPE

SPACE = " \t\n\x0b\f\r"
RULE_COLUMNS = ("rule_id", "expression", "flags", "flag_bits", "ext", "kind")


def read_rule_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rule files as ``line_no, line``; numbers grow within the feed."""
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line")
    )


def _last_slash(s: str) -> str:
    """1-based position of the last slash, 0 if there is none."""
    return f"(CASE WHEN contains({s}, '/') THEN length({s}) - instr(reverse({s}), '/') + 1 ELSE 0 END)"


def _to_int(text: str, kind: str) -> str:
    return f"(CASE WHEN regexp_like({text}, '^[+-]?[0-9]+$') THEN try_cast({text} AS {kind}) END)"


def flag_letters(flags: str, kind: str) -> str:
    """Canonical letters: deprecated ones replaced, sorted, each once."""
    if kind != LEFTMOST:
        old, new = "".join(DEPRECATED_FLAGS), "".join(DEPRECATED_FLAGS.values())
        flags = f"translate({flags}, '{old}', '{new}')"
    # a split at the empty pattern gives the letters, and one '' for no letter
    return f"array_join(sort_array(array_distinct(split({flags}, ''))), '')"


def flag_bits(letters: str) -> str:
    bits = (f"IF(contains({letters}, '{c}'), {bit}, 0)" for c, bit in FLAG_BITS.items())
    return f"({' + '.join(bits)})"


def checked_flags(flags: str, kind: str) -> Column:
    """Canonical letters of a flags column; an unknown letter is an error."""
    letters = F.expr(flag_letters(f"coalesce({flags}, '')", kind))
    unknown = F.regexp_replace(letters, f"[{_known_flags(kind)}]", "")
    message = F.concat(F.lit("flags `"), unknown, F.lit(f"` invalid for {kind} rules"))
    return F.when(unknown != "", F.raise_error(message).cast("string")).otherwise(letters)


def _known_flags(kind: str) -> str:
    if kind == LEFTMOST:
        return LEFTMOST_FLAGS
    return "".join(FLAG_BITS) + "".join(DEPRECATED_FLAGS)


def _ext_pairs(text: str) -> str:
    """``{a=1,b=2}`` as an array of (key, text of the value)."""
    inner = f"substring({text}, 2, length({text}) - 2)"
    parts = keep(f"split({inner}, ',')", lambda p: f"contains({p}, '=')")
    return each(
        parts,
        lambda p: f"named_struct('key', lower(substring_index({p}, '=', 1)),"
        f" 'value', substring({p}, instr({p}, '=') + 1))",
    )


def _ext_struct(text: str) -> str:
    def build(pairs):
        def value(key):
            mine = keep(pairs, lambda p: f"{p}.key = '{key}'")
            return _to_int(f"try_element_at({mine}, -1).value", "BIGINT")

        values = ", ".join(f"'{k}', {value(k)}" for k in EXT_KEYS)
        return f"named_struct({values})"

    filled = let(_ext_pairs(text), build)
    return f"CAST(CASE WHEN {text} IS NOT NULL THEN {filled} END AS {EXT_TYPE})"


def _ext_error(text: str) -> str:
    bad = keep(_ext_pairs(text), lambda p: f"{_to_int(f'{p}.value', 'BIGINT')} IS NULL")
    return f"get({bad}, 0).value"


def _named(**values: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in values.items()) + ")"


def _split_id(s: str) -> str:
    """``id:/...`` to the id's text and the rest; no id if the slash after the
    colon is the only one."""
    at = f"instr({s}, ':/')"
    has_id = f"{at} > 1 AND {_last_slash(s)} > {at} + 1"
    return _named(
        id=f"CASE WHEN {has_id} THEN substring({s}, 1, {at} - 1) END",
        rest=f"CASE WHEN {has_id} THEN substring({s}, {at} + 1) ELSE {s} END",
    )


def _split_expression(rest: str) -> str:
    """``/expression/tail``, up to the last slash, or all of it bare."""
    n = _last_slash(rest)
    quoted = f"startswith({rest}, '/') AND {n} > 2"
    return _named(
        expression=f"CASE WHEN {quoted} THEN substring({rest}, 2, {n} - 2) ELSE {rest} END",
        tail=f"CASE WHEN {quoted} THEN substring({rest}, {n} + 1) ELSE '' END",
    )


def _split_ext(tail: str, kind: str) -> str:
    """Flag letters, and the braces after them; only all-ends rules have any."""
    brace = f"instr({tail}, '{{')"
    has_ext = f"{brace} > 0 AND endswith({tail}, '}}')" if kind == ALL_ENDS else "false"
    return _named(
        flags=f"CASE WHEN {has_ext} THEN substring({tail}, 1, {brace} - 1) ELSE {tail} END",
        ext=f"CASE WHEN {has_ext} THEN substring({tail}, {brace}) END",
    )


def _rule(given: str | None, own: str, expression: str, c: str, kind: str) -> str:
    """The parsed rule, with an error where a part is wrong."""

    def ticked(label: str, value: str) -> str:
        return f"concat('{label} `', {value}, '`')"

    rule_id = _to_int(own, "INT")
    bad_flag = f"regexp_extract({c}.flags, '[^{_known_flags(kind)}]', 0)"
    bad_value = _ext_error(f"{c}.ext")
    errors = [
        (f"{own} IS NOT NULL AND {rule_id} IS NULL", ticked("pattern id", own)),
        (f"{bad_flag} <> ''", ticked("flag", bad_flag)),
        (f"{bad_value} IS NOT NULL", ticked("ext value", bad_value)),
    ]
    if given is not None:
        rule_id = _to_int(given, "INT")
        missing = ticked("missing or bad id", f"coalesce({given}, '')")
        errors.insert(0, (f"{rule_id} IS NULL", missing))
    cases = " ".join(f"WHEN {test} THEN {error}" for test, error in errors)
    return let(
        flag_letters(f"{c}.flags", kind),
        lambda letters: _named(
            rule_id=f"coalesce({rule_id}, 0)",
            expression=expression,
            flags=letters,
            flag_bits=flag_bits(letters),
            ext=_ext_struct(f"{c}.ext"),
            error=f"CASE {cases} END",
        ),
    )


def _parse(df: DataFrame, kind: str, id_required: bool) -> DataFrame:
    """``line_no, line`` and the parsed rule; blank lines and comments go."""
    df = df.withColumn("_s", F.btrim(F.col("line"), F.lit(SPACE)))
    df = df.filter("_s <> '' AND NOT startswith(_s, '#')")

    def parse(s, given=None):
        def with_tail(a):
            return lambda b: let(
                _split_ext(f"{b}.tail", kind),
                lambda c: _rule(given, f"{a}.id", f"{b}.expression", c, kind),
            )

        return let(_split_id(s), lambda a: let(_split_expression(f"{a}.rest"), with_tail(a)))

    if id_required:
        # everything before the first colon, which must be there
        colon = "instr(_s, ':')"
        parsed = let(
            _named(
                given=f"CASE WHEN {colon} > 0 THEN substring(_s, 1, {colon} - 1) END",
                rest=f"CASE WHEN {colon} > 0 THEN substring(_s, {colon} + 1) ELSE '' END",
            ),
            lambda p: parse(f"{p}.rest", f"{p}.given"),
        )
    else:
        parsed = parse("_s")
    # exploding keeps filters on the result from repeating the parse
    return df.select("line_no", "line", F.explode(F.array(F.expr(parsed))).alias("r")).select(
        "line_no",
        "line",
        "r.rule_id",
        "r.expression",
        "r.flags",
        "r.flag_bits",
        "r.ext",
        F.lit(kind).alias("kind"),
        "r.error",
    )


def canonical(rules: DataFrame) -> Column:
    """A rule as text: id if positive, expression, sorted flags, ext."""
    shown = [
        F.when(
            F.col(f"ext.{k}").isNotNull(),
            F.concat(F.lit(f"{k}="), F.col(f"ext.{k}").cast("string")),
        )
        for k in EXT_KEYS
    ]
    ext = F.when(
        F.col("ext").isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *shown), F.lit("}"))
    )
    return F.concat(
        F.when(F.col("rule_id") > 0, F.concat(F.col("rule_id").cast("string"), F.lit(":")))
        .otherwise(F.lit("")),
        F.lit("/"),
        F.col("expression"),
        F.lit("/"),
        F.col("flags"),
        F.coalesce(ext, F.lit("")),
    )


def ingest_rules(
    lines: DataFrame,
    kind: str = ALL_ENDS,
    id_required: bool = False,
    dedupe: bool = False,
    validate: bool = False,
    strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Rule lines (``line``, optionally ``line_no``) to ``(rules, rejects)``.

    Blank lines and ``#`` comments are skipped.  ``dedupe`` keeps the first of
    the lines with equal canonical text.  ``validate`` also rejects expressions
    that do not compile.  ``strict`` raises if any line is rejected.
    """
    if kind not in (ALL_ENDS, LEFTMOST, LITERAL):
        raise RuleError(f"unknown kind {kind!r}")
    if "line_no" not in lines.columns:
        lines = lines.withColumn("line_no", F.monotonically_increasing_id())
    parsed = _parse(lines, kind, id_required)
    good = parsed.filter("error IS NULL").drop("error")
    rejects = parsed.filter("error IS NOT NULL").select("line_no", "line", "rule_id", "error")
    if validate:
        audited = audit_rules(good)
        good = audited.filter("valid").select(*good.columns)
        rejects = rejects.unionByName(
            audited.filter("NOT valid").select("line_no", "line", "rule_id", "error")
        )
    if strict:
        first = rejects.limit(1).collect()
        if first:
            raise RuleError(f"line `{first[0]['line']}`: {first[0]['error']}")
    if dedupe:
        good = (
            good.withColumn("canonical", canonical(good))
            .groupBy("canonical")
            .agg(F.min_by(F.struct(*good.columns), "line_no").alias("r"))
            .select("r.*")
        )
    return good.select("line_no", *RULE_COLUMNS), rejects


def rules_from_strings(
    df: DataFrame, expression: str = "expression", flags: str = "", kind: str = ALL_ENDS
) -> DataFrame:
    """Raw expressions to rules; nothing in them is parsed.

    Ids are positions counted from 1: the position in an array column, or else
    the rank by the column ``position`` of a table (or its ``rule_id`` as is).
    """
    no_ext = F.lit(None).cast(EXT_TYPE)
    letters = flag_letters(f"'{flags}'", kind)
    if df.schema[expression].dataType.typeName() == "array":
        df = df.select(F.posexplode(expression).alias("_at", "expression"))
        rule_id = F.col("_at") + 1
    elif "rule_id" in df.columns:
        rule_id = F.col("rule_id")
    else:
        from patternscan.streaming.chunks import running_totals

        ranked = running_totals(df, (), "position", {"_before": F.lit(1)}, levels=2)
        df, rule_id = ranked, F.col("_before") + 1
    return df.select(
        rule_id.cast("int").alias("rule_id"),
        F.col("expression" if "expression" in df.columns else expression).alias("expression"),
        F.expr(letters).alias("flags"),
        F.expr(flag_bits(letters)).alias("flag_bits"),
        no_ext.alias("ext"),
        F.lit(kind).alias("kind"),
    )


def append_rules(*parts: DataFrame) -> DataFrame:
    """Rule sets one after the other."""
    first, *others = parts
    for other in others:
        first = first.unionByName(other)
    return first
