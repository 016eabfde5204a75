"""License scans by ordered signature rules.

A text becomes its words in lower case with one space between them.  Rules are
regular expressions over such words; a rule is tried only on texts that hold its
keyword.  Where detections overlap, one that lies inside another of at least its
priority is suppressed, so that the most specific reading is left.

Everything is DataFrame functions.  Most texts fail a first test for a few
substrings and are only counted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from patternscan.llm.frames import check_columns

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases that always count, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Label, keyword, name in words, versions in words.
FAMILIES = (
    ("mit", "mit", "mit", ()),
    ("apache", "apache", "apache", ("1 0", "1 1", "2 0")),
    ("apache", "apache", "apache software", ("1 1", "2 0")),
    ("gpl", "general", "general public", ("1", "2", "3")),
    ("gpl", "gnu", "gnu general public", ("1", "2", "3")),
    ("gpl", "gpl", "gnu gpl", ("2", "3")),
    ("lgpl", "lesser", "gnu lesser general public", ("2 1", "3")),
    ("lgpl", "lesser", "lesser general public", ("2 1", "3")),
    ("lgpl", "library", "gnu library general public", ("2",)),
    ("agpl", "affero", "gnu affero general public", ("1", "3")),
    ("agpl", "affero", "affero general public", ("1", "3")),
    ("gfdl", "documentation", "gnu free documentation", ("1 1", "1 2", "1 3")),
    ("bsd", "bsd", "bsd", ()),
    ("bsd-2-clause", "bsd", "2 clause bsd", ()),
    ("bsd-3-clause", "bsd", "3 clause bsd", ()),
    ("bsd-2-clause", "simplified", "simplified bsd", ()),
    ("bsd-3-clause", "revised", "revised bsd", ()),
    ("mpl", "mozilla", "mozilla public", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse", "eclipse public", ("1 0", "2 0")),
    ("cddl", "distribution", "common development and distribution", ("1 0", "1 1")),
    ("eupl", "european", "european union public", ("1 1", "1 2")),
    ("osl", "open", "open software", ("2 1", "3 0")),
    ("artistic", "artistic", "artistic", ("1 0", "2 0")),
    ("boost", "boost", "boost software", ("1 0",)),
    ("isc", "isc", "isc", ()),
    ("zlib", "zlib", "zlib", ()),
    ("postgresql", "postgresql", "postgresql", ()),
    ("python", "python", "python software foundation", ("2",)),
    ("ofl", "font", "sil open font", ("1 0", "1 1")),
    ("odbl", "database", "open database", ("1 0",)),
    ("wtfpl", "wtfpl", "wtfpl", ()),
    ("cc0", "cc0", "cc0", ("1 0",)),
    ("cc-by", "by", "cc by", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "sa", "cc by sa", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "nc", "cc by nc", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "nd", "cc by nd", ("2 0", "3 0", "4 0")),
    ("cc-by-nc-sa", "sa", "cc by nc sa", ("2 0", "3 0", "4 0")),
    ("cc-by-nc-nd", "nd", "cc by nc nd", ("2 0", "3 0", "4 0")),
    ("cc-by", "attribution", "creative commons attribution", ("2 0", "3 0", "4 0")),
    ("cc-by-sa", "sharealike", "creative commons attribution sharealike", ("2 0", "3 0", "4 0")),
    ("cc-by-nc", "noncommercial", "creative commons attribution noncommercial", ("2 0", "3 0", "4 0")),
)

#: Label, keyword, expression of texts that name no license.
NOTICES = (
    ("mit", "granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms"),
    ("isc", "permission", "permission to use copy modify and or distribute this software"),
    ("public-domain", "domain", "(?:released into|dedicated to|placed in) the public domain"),
    ("proprietary", "reserved", "copyright (?:[^ ]+ ){1,8}all rights reserved"),
)

SHARE = {1: 0.4, 2: 0.7, 3: 0.9, 4: 1.0}  # how sure a detection of each priority is


@dataclass(frozen=True)
class LicenseRule:
    """An expression over words with single spaces between them, which can only
    match where ``keyword`` is a word of the text.  Later rules of a priority
    give way to earlier ones on the same words."""

    label: str
    priority: int
    keyword: str
    pattern: str


def license_rules() -> list[LicenseRule]:
    """Some hundred rules: each family by name, in phrases, with its versions and
    as an SPDX tag, then notices that name none."""
    rules = []
    under = "(?:licen[cs]ed|released|available|distributed|published|provided) under (?:the )?(?:terms of (?:the )?)?"
    for label, keyword, name, versions in FAMILIES:
        rules.append(LicenseRule(label, 2, keyword, f"{name} (?:public )?licen[cs]e"))
        rules.append(LicenseRule(label, 1, keyword, f"{under}{name}"))
        rules.append(LicenseRule(label, 1, keyword, f"licen[cs]e (?:is )?(?:the )?{name}"))
        for version in versions:
            number = version[:-2] if version.endswith(" 0") else version
            tag = f"{label}-{version.replace(' ', '.')}"
            after = f"(?:version |v )?v?{number}(?: 0)?" if number != version else f"(?:version |v )?v?{version}"
            rules.append(LicenseRule(tag, 3, keyword, f"{name} licen[cs]e {after}"))
            rules.append(LicenseRule(tag, 3, keyword, f"{under}{name} (?:licen[cs]e )?{after}"))
        spdx = label.replace("-", " ")
        rules.append(LicenseRule(label, 4, "spdx", f"spdx licen[cs]e identifier {spdx}"))
        for version in versions:
            tag = f"{label}-{version.replace(' ', '.')}"
            rules.append(LicenseRule(tag, 4, "spdx", f"spdx licen[cs]e identifier {spdx} {version}(?: (?:only|or later))?"))
    rules += [LicenseRule(label, 2, keyword, pattern) for label, keyword, pattern in NOTICES]
    return list(dict.fromkeys(rules))


@dataclass(frozen=True)
class LicenseParams:
    """``gates``: substrings, in lower case, of which every text that a rule or
    a base phrase matches holds one."""

    base: tuple[tuple[str, str], ...] = BASE
    rules: tuple[LicenseRule, ...] = field(default_factory=lambda: tuple(license_rules()))
    gates: tuple[str, ...] = (
        "licen", "released", "available", "distributed", "published", "provided",
        "permission", "redistribution", "domain", "copyright", "spdx",
    )

    def __post_init__(self):
        for phrase, _ in self.base:
            if not any(g in phrase for g in self.gates):
                raise ValueError(f"no gate lets {phrase!r} through")
        if len(self.rules) > 10_000:
            raise ValueError("too many rules to send to every worker")


def normal(text: Column) -> Column:
    """The words of a text in lower case (A to Z), with one space around each."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), _BREAK, " ")), F.lit(" "))


def _places(marked: Column, test: str) -> Column:
    """Indexes of the words of a marked text that begin or end with a mark."""
    words = F.split(F.trim(marked), " ")
    hit = (lambda w: w.startswith("{")) if test == "first" else (lambda w: w.endswith("}"))
    return F.filter(F.transform(words, lambda w, i: F.when(hit(w), i.cast("long"))), lambda i: i.isNotNull())


def rule_table(spark: SparkSession, params: LicenseParams) -> DataFrame:
    rows = [(k, r.label, r.priority, r.keyword, f"(?<= )({r.pattern})(?= )") for k, r in enumerate(params.rules)]
    return spark.createDataFrame(rows, "rule int, label string, priority int, keyword string, pattern string")


def detections(texts: DataFrame, key: list[str], params: LicenseParams = LicenseParams()) -> DataFrame:
    """``key, first, end, label, priority, rule`` of what stands after suppression.

    ``texts`` has ``key`` and ``normal``; rows of one key count as one text.
    ``first`` and ``end`` are the first and last word.  A detection goes if an
    earlier one in the order (first, longest, highest priority, rule) covers it
    with at least its priority.
    """
    rules = rule_table(texts.sparkSession, params)
    keywords = F.array(*(F.lit(k) for k in sorted({r.keyword for r in params.rules})))
    there = F.filter(keywords, lambda k: F.col("normal").contains(F.concat(F.lit(" "), k, F.lit(" "))))
    tried = texts.select(*key, "normal", F.explode(there).alias("keyword")).join(F.broadcast(rules), "keyword")
    marked = tried.withColumn("_marked", F.regexp_replace(F.col("normal"), F.col("pattern"), F.lit("{$1}")))
    marked = marked.filter(F.col("_marked").contains("{"))
    zipped = F.arrays_zip(_places(F.col("_marked"), "first").alias("first"), _places(F.col("_marked"), "end").alias("end"))
    found = marked.select(*key, "rule", "label", "priority", F.explode(zipped).alias("_at")).select(
        *key, "rule", "label", "priority", F.col("_at.first").alias("first"), F.col("_at.end").alias("end")
    ).distinct()  # copies of a row would all be sorted in one task
    before = (
        Window.partitionBy(*key)
        .orderBy("first", F.desc("end"), F.desc("priority"), "rule")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = F.lit(-1)
    for level in sorted({r.priority for r in params.rules}):
        far = F.max(F.when(F.col("priority") >= level, F.col("end"))).over(before)
        reach = F.when(F.col("priority") == level, F.coalesce(far, F.lit(-1))).otherwise(reach)
    return found.withColumn("_reach", reach).filter(F.col("end") > F.col("_reach")).drop("_reach")


def scan_licenses(
    docs: DataFrame,
    params: LicenseParams = LicenseParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``<id>, n_words, n_base, first_word, last_word, base_labels, labels, score``
    for each row.

    ``n_base`` counts the places of base phrases, ``first_word`` and
    ``last_word`` are the smallest and largest word where one begins (null
    without any).  ``labels`` are the base labels and those of the detections
    left, distinct, sorted and joined by commas; ``score`` is how sure the surest
    of them is, 0 without any.  A null or empty text has no words and no labels.
    Every row gives one row, repeated ones and ones without id too.
    """
    check_columns(docs, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    low = F.lower("_text")
    gate = F.lit(False)
    for word in params.gates:
        gate = gate | low.contains(word)
    rows = rows.select(
        "_id",
        F.xxhash64("_text").alias("_hash"),
        F.regexp_count("_text", F.lit(WORD)).cast("bigint").alias("n_words"),
        F.when(gate, normal(F.col("_text"))).alias("normal"),
    )
    phrases = "|".join(phrase for phrase, _ in params.base)
    marked = F.regexp_replace("normal", f"(?<= )({phrases})(?= )", "{$1}")
    base = [F.when(F.col("normal").contains(f" {phrase} "), F.lit(label)) for phrase, label in params.base]
    scanned = rows.select(
        "_id",
        "_hash",
        "n_words",
        F.coalesce(F.when(marked.contains("{"), _places(marked, "first")), F.array().cast("array<bigint>")).alias("_at"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*base)))).alias("_base"),
    )
    left = detections(rows.filter("normal is not null"), ["_id", "_hash"], params)
    share = F.lit(0.0)
    for level, sure in SHARE.items():
        share = F.when(F.col("priority") == level, F.lit(sure)).otherwise(share)
    summed = left.groupBy("_id", "_hash").agg(
        F.collect_set("label").alias("_labels"), F.max(share).alias("_sure")
    ).select(F.col("_id").alias("_other"), F.col("_hash").alias("_same"), "_labels", "_sure")
    joined = scanned.join(
        summed, F.col("_id").eqNullSafe(F.col("_other")) & (F.col("_hash") == F.col("_same")), "left"
    )
    labels = F.array_sort(F.array_union("_base", F.coalesce("_labels", F.array().cast("array<string>"))))
    return joined.select(
        F.col("_id").alias(id_col),
        "n_words",
        F.size("_at").cast("bigint").alias("n_base"),
        F.array_min("_at").alias("first_word"),
        F.array_max("_at").alias("last_word"),
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("_sure", F.lit(0.0)), F.when(F.size("_base") > 0, 0.5).otherwise(0.0)).alias("score"),
    )
