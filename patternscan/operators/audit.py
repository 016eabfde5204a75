"""Rule validation: is a rule usable, how wide are its matches, does it need
the end of the data."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patternscan.functions.syntax import RuleError, prepare
from patternscan.operators.events import parse_formula
from patternscan.plans.ruleset import over_all_cores, row_to_rule
from patternscan.plans.shipping import ship_package

AUDIT = (
    "valid boolean, error string, min_width long, max_width long, unordered boolean,"
    " at_eod boolean, only_at_eod boolean, required_literal string, stack_risk boolean"
)


def audit_rules(rules: DataFrame) -> DataFrame:
    """The rules table with one verdict per rule.

    ``max_width`` NULL means unbounded.  ``stack_risk`` marks rules that repeat
    a variable part without bound; scans run those in Python workers.  Rules
    with flag ``C`` are formulas and are checked as such.
    """
    ship_package(rules.sparkSession)
    names = T._parse_datatype_string(AUDIT).names

    def verdict(row):
        try:
            if "C" in (row["flags"] or ""):
                parse_formula(row["expression"])
                return (True, None, None, None, False, False, False, None, False)
            p = prepare(row_to_rule(row))
        except RuleError as e:
            return (False, str(e), None, None, None, None, None, None, None)
        return (
            True,
            None,
            p.min_width,
            p.max_width,
            p.at_end,
            p.at_end,
            p.only_at_end,
            p.literal,
            p.stack_risk,
        )

    def run(batches):
        for pdf in batches:
            rows = [verdict(r) for r in pdf.to_dict("records")]
            found = pd.DataFrame(rows, columns=names, index=pdf.index)
            for c in ("min_width", "max_width"):
                found[c] = found[c].astype("Int64")
            for c in ("unordered", "at_eod", "only_at_eod", "stack_risk"):
                found[c] = found[c].astype("boolean")
            yield pd.concat([pdf, found], axis=1)

    schema = T.StructType(rules.schema.fields + T._parse_datatype_string(AUDIT).fields)
    return over_all_cores(rules).mapInPandas(run, schema)


def valid_rules(audited: DataFrame) -> DataFrame:
    """The usable rules of an audit, in the rules schema."""
    return audited.filter("valid").select(
        "rule_id", "expression", "flags", "flag_bits", "ext", "kind"
    )


def audit_rejects(audited: DataFrame) -> DataFrame:
    return audited.filter(~F.col("valid")).select("rule_id", "expression", "error")
