"""One query per operator over the given tables.

Every query reads whole tables and whole texts.  Ids and counts are cast to
bigint so that results compare with other engines.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patternscan.functions.presets import preset_rules
from patternscan.functions.syntax import ALL_ENDS, LEFTMOST, LITERAL, Rule
from patternscan.operators import approx, audit, captures, events, grep, literals, packets, scan
from patternscan.operators.prefilter import prefilter_verify
from patternscan.operators.rule_sets import scan_rule_set
from patternscan.operators.tagging import tag_pii
from patternscan.plans.layout import spread
from patternscan.plans.ruleset import EXT_TYPE
from patternscan.sources import rule_lines
from patternscan.streaming import chunks, live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES["q_" + f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def documents(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def pages(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id")


def big(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


EVENT = ("rule_id", "from_off", "to_off")


def doc_events(df: DataFrame) -> DataFrame:
    return df.select(*big("doc_id", *EVENT))


# --------------------------------------------------------------------------
# rules

PART_LINES = """
CASE p_partkey % 10
  WHEN 0 THEN concat(p_partkey, ':/', p_name, '/i')
  WHEN 1 THEN concat('/', p_name, '/mi')
  WHEN 2 THEN p_name
  WHEN 3 THEN concat(p_partkey, ':/', p_name, '/iu{min_offset=', p_size, ',MIN_LENGTH=8,other=1}')
  WHEN 4 THEN concat('# ', p_name)
  WHEN 5 THEN '   '
  WHEN 6 THEN concat('x', p_partkey, ':/', p_name, '/i')
  WHEN 7 THEN concat('/', p_name, '/iz')
  WHEN 8 THEN concat('/', p_name, '/i{min_offset=x', p_size, '}')
  ELSE concat('  /', p_name, '/', p_brand, '/LoefH  ')
END"""


def part_lines(spark, sf_dir) -> DataFrame:
    """Rule lines of every shape, one per part."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("line_no"), F.expr(PART_LINES).alias("line")
    )


@query
def ingest_rules(spark, sf_dir):
    rules, _ = rule_lines.ingest_rules(part_lines(spark, sf_dir))
    return rules.select(
        *big("line_no", "rule_id"),
        "expression",
        "flags",
        *big("flag_bits"),
        F.col("ext.min_offset").alias("min_offset"),
        F.col("ext.min_length").alias("min_length"),
    )


@query
def rule_rejects(spark, sf_dir):
    _, rejects = rule_lines.ingest_rules(part_lines(spark, sf_dir))
    return rejects.select(*big("line_no", "rule_id"), "error")


@query
def rule_canonical(spark, sf_dir):
    rules, _ = rule_lines.ingest_rules(part_lines(spark, sf_dir), dedupe=True)
    return rules.select(*big("line_no"), rule_lines.canonical(rules).alias("canonical"))


@query
def rule_ids_required(spark, sf_dir):
    lines = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("line_no"),
        F.expr("concat(IF(p_size % 5 = 0, p_brand, string(p_partkey)), ':/', p_name, '/is')").alias("line"),
    )
    rules, _ = rule_lines.ingest_rules(lines, id_required=True)
    return rules.select(*big("line_no", "rule_id"), "expression", "flags")


@query
def rule_audit(spark, sf_dir):
    rules = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("rule_id"),
        F.expr(
            "CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN concat(p_name, 's?')"
            " WHEN 2 THEN concat(p_name, '$') WHEN 3 THEN concat('(', p_name)"
            " WHEN 4 THEN concat('(', p_name, ')+') ELSE concat('(', p_name, ')*') END"
        ).alias("expression"),
        F.lit("").alias("flags"),
        F.lit(0).alias("flag_bits"),
        F.lit(None).cast(EXT_TYPE).alias("ext"),
        F.lit(ALL_ENDS).alias("kind"),
    )
    return audit.audit_rules(rules).select(
        *big("rule_id"),
        "valid",
        *big("min_width", "max_width"),
        "unordered",
        "at_eod",
        "only_at_eod",
    )


SENTENCE = r"[.\n]+ ?"


def widest(df: DataFrame, size: Column) -> int:
    """The largest size, so that ``id * widest + position`` is unique."""
    return df.agg(F.max(size)).first()[0] or 1


def sentences(spark, sf_dir) -> DataFrame:
    """Distinct sentences of ``benchmark``: id of the first one, text."""
    arrays = table(spark, sf_dir, "benchmark").select("item_id", F.split("text", SENTENCE).alias("s"))
    pieces = arrays.select("item_id", F.posexplode("s").alias("pos", "expression"))
    number = F.col("item_id") * widest(arrays, F.size("s")) + F.col("pos")
    return (
        pieces.filter("expression != ''").groupBy("expression").agg(F.min(number).alias("rule_id"))
    )


def sentence_rules(spark, sf_dir, flags: str = "L") -> DataFrame:
    return rule_lines.rules_from_strings(sentences(spark, sf_dir), flags=flags, kind=LITERAL)


@query
def dictionary_rules(spark, sf_dir):
    rules = sentence_rules(spark, sf_dir, "Li")
    return rules.select(*big("rule_id"), "expression", "flags", *big("flag_bits"), "kind")


@query
def rules_from_strings(spark, sf_dir):
    arrays = table(spark, sf_dir, "benchmark").select("item_id", F.split("text", SENTENCE).alias("e"))
    numbered = arrays.select("item_id", F.posexplode("e").alias("_at", "expression"))
    # positions over the whole feed: the array's own position made global
    position = F.col("item_id") * widest(arrays, F.size("e")) + F.col("_at")
    df = numbered.select(position.alias("position"), "expression")
    return rule_lines.rules_from_strings(df).select(*big("rule_id"), "expression", "kind")


# --------------------------------------------------------------------------
# yes / no scans


@query
def pii_by_lang(spark, sf_dir):
    hits = scan.match_rules(
        documents(spark, sf_dir), preset_rules(), keys=("doc_id", "lang")
    )
    counted = events.count_events(hits, ("lang", "rule_id"))
    return counted.select("lang", *big("rule_id", "n_matches"))


@query
def tag_pii_strict(spark, sf_dir):
    return tag_pii(documents(spark, sf_dir), strict=True).select(*big("doc_id", "rule_id"), "tag")


@query
def match_any_license(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.filter(scan.match_any("text", Rule(1, "licen[sc]e", "i"))).select("doc_id", "lang")


PART_RULES = [
    Rule(1, "^red"),
    Rule(2, "gear$"),
    Rule(3, "(small|large) "),
    Rule(4, "BOLT", "i"),
    Rule(5, "[aeiou]{2}"),
    Rule(6, r"\bring\b"),
]


@query
def match_rules_parts(spark, sf_dir):
    hits = scan.match_rules(table(spark, sf_dir, "part"), PART_RULES, "p_name", ("p_partkey",))
    return hits.select(*big("p_partkey", "rule_id"))


FLAG_RULES = [
    Rule(1, r"^[A-Z][a-z]+ [a-z]+", "m", kind=LEFTMOST),
    Rule(2, r"\.$", "m", kind=LEFTMOST),
    Rule(3, r"[a-z]\..[A-Z]", "s", kind=LEFTMOST),
    Rule(4, r"[a-z]\..[A-Z]", "", kind=LEFTMOST),
    Rule(5, "THE [a-z]", "i", kind=LEFTMOST),
]


@query
def flags_multiline_dotall(spark, sf_dir):
    found = scan.scan_leftmost(documents(spark, sf_dir), FLAG_RULES)
    return events.count_events(found, ("doc_id", "rule_id")).select(
        *big("doc_id", "rule_id", "n_matches")
    )


def sentence_patterns(spark, sf_dir) -> DataFrame:
    """A rule per ``benchmark`` sentence: all of it and the sign that ends it."""
    whole = F.concat(F.lit(r"\Q"), "expression", F.lit(r"\E[.\n]")).alias("expression")
    return rule_lines.rules_from_strings(sentences(spark, sf_dir).select("rule_id", whole))


@query
def prefilter_rules(spark, sf_dir):
    hits = prefilter_verify(documents(spark, sf_dir), sentence_patterns(spark, sf_dir))
    return hits.select(*big("doc_id", "rule_id"))


def case_rules(spark, sf_dir) -> DataFrame:
    """A rule per different word of ``benchmark``: caseless, or the word in small
    or large letters, so that no rule requires one fixed text."""
    plain = word_rules(spark, sf_dir, "")
    word = F.regexp_extract("expression", r"^\\b([A-Za-z]+)", 1)
    either = F.concat(F.lit(r"\b(?:"), word, F.lit("|"), F.upper(word), F.lit(r")[ ,.\n]"))
    odd = F.col("rule_id") % 2 == 1
    return plain.withColumn("expression", F.when(odd, either).otherwise(F.col("expression"))).withColumn(
        "flags", F.when(odd, F.lit("")).otherwise(F.lit("i"))
    )


@query
def match_rules_caseless(spark, sf_dir):
    """Hundreds of rules without one fixed text each, found by sets of texts."""
    hits = scan.match_rules(documents(spark, sf_dir), case_rules(spark, sf_dir))
    return hits.select(*big("doc_id", "rule_id"))


# --------------------------------------------------------------------------
# event scans

DIGITS = Rule(1, r"\d+", "L")


@query
def scan_events_digits(spark, sf_dir):
    return doc_events(scan.scan_events(documents(spark, sf_dir), DIGITS))


@query
def flag_allow_empty(spark, sf_dir):
    """A rule that may match nothing: it ends at every position."""
    found = scan.scan_events(pages(spark, sf_dir), Rule(1, "[a-z]*", "VL"), "url", ("page_id",))
    return found.select(*big("page_id", *EVENT))


ENDING = Rule(1, r"(?:ing|tion|ation|ed)[ ,.]", "L")


@query
def scan_events_endings(spark, sf_dir):
    return doc_events(scan.scan_events(documents(spark, sf_dir), ENDING))


@query
def scan_events_no_start(spark, sf_dir):
    rules = [Rule(1, "token"), Rule(2, "License", "H"), Rule(3, "the", "iH")]
    return doc_events(scan.scan_events(documents(spark, sf_dir), rules))


@query
def scan_events_word_end(spark, sf_dir):
    return doc_events(scan.scan_events(documents(spark, sf_dir), Rule(1, r"\bth[a-z]{1,3}\b", "L")))


@query
def scan_events_bounds(spark, sf_dir):
    bounds = {"min_offset": 100, "max_offset": 5000, "min_length": 3}
    return doc_events(scan.scan_events(documents(spark, sf_dir), Rule(1, r"\d+", "L", bounds)))


@query
def scan_events_utf8(spark, sf_dir):
    return doc_events(scan.scan_events(documents(spark, sf_dir), Rule(1, "é.é", "8L")))


@query
def scan_events_rule_table(spark, sf_dir):
    rules = sentence_patterns(spark, sf_dir)
    prepared = scan.scan_events(documents(spark, sf_dir), rules)
    return events.count_events(prepared, ("doc_id", "rule_id")).select(
        *big("doc_id", "rule_id", "n_matches")
    )


NUMBERS = Rule(1, "[0-9]+", kind=LEFTMOST)


@query
def scan_leftmost_numbers(spark, sf_dir):
    return doc_events(scan.scan_leftmost(documents(spark, sf_dir), NUMBERS))


TOKEN = Rule(1, r'token = "([^"]+)"', kind=LEFTMOST)


@query
def captures_token(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = docs.select("doc_id", F.posexplode(captures.group_texts("text", TOKEN)).alias("n", "token"))
    return found.select(*big("doc_id", "n"), "token")


@query
def captures_offsets(spark, sf_dir):
    rule = Rule(1, r"([0-9]{1,3})\.([0-9]{1,3})(\.[0-9]{1,3})?", kind=LEFTMOST)
    found = captures.scan_captures(documents(spark, sf_dir), rule)
    exploded = found.select(
        "doc_id", "from_off", "to_off", F.posexplode("captures").alias("group", "c")
    )
    return exploded.select(
        *big("doc_id", "from_off", "to_off", "group"),
        F.col("c.from_off").alias("group_from"),
        F.col("c.to_off").alias("group_to"),
        F.col("c.text").alias("group_text"),
    )


@query
def captures_rule_table(spark, sf_dir):
    """Groups of hundreds of rules: a sentence and the sign that ends it."""
    whole = F.concat(F.lit(r"(\Q"), "expression", F.lit(r"\E)([.\n])")).alias("expression")
    rules = rule_lines.rules_from_strings(sentences(spark, sf_dir).select("rule_id", whole), kind=LEFTMOST)
    found = captures.scan_captures(documents(spark, sf_dir), rules)
    sentence, sign = (F.get("captures", F.lit(i)) for i in (1, 2))
    return found.groupBy(*big("doc_id", "rule_id")).agg(
        F.count(F.lit(1)).alias("n_matches"),
        F.count_if(sign["text"] == ".").alias("n_stops"),
        F.sum(sentence["to_off"] - sentence["from_off"]).alias("n_bytes"),
        F.sum(sign["from_off"] - F.col("from_off")).alias("sign_after"),
    )


@query
def find_first(spark, sf_dir):
    index = scan.find_first_index("text", DIGITS)
    docs = documents(spark, sf_dir)
    found = docs.select("doc_id", index.alias("i"), scan.find_first("text", DIGITS).alias("text"))
    return found.filter("i IS NOT NULL").select(
        *big("doc_id"), F.col("i.from_off"), F.col("i.to_off"), "text"
    )


@query
def find_all_3(spark, sf_dir):
    index = scan.find_all_index("text", DIGITS, 3)
    texts = scan.find_all("text", DIGITS, 3)
    docs = documents(spark, sf_dir)
    found = docs.select("doc_id", F.posexplode(F.arrays_zip(index.alias("i"), texts.alias("t"))))
    return found.select(
        *big("doc_id"),
        F.col("pos").cast("bigint").alias("n"),
        F.col("col.i.from_off").alias("from_off"),
        F.col("col.i.to_off").alias("to_off"),
        F.col("col.t").alias("text"),
    )


LITERALS = [
    Rule(1, "License", "L", kind=LITERAL),
    Rule(2, 'token = "', "L", kind=LITERAL),
    Rule(3, "...", "L", kind=LITERAL),
]


@query
def scan_literals_small(spark, sf_dir):
    return doc_events(literals.scan_literals(documents(spark, sf_dir), LITERALS))


@query
def scan_literals_dictionary(spark, sf_dir):
    rules = sentence_rules(spark, sf_dir)
    return doc_events(literals.scan_dictionary(documents(spark, sf_dir), rules))


@query
def edit_distance_flags(spark, sf_dir):
    """Caseless, from an offset on, the first one only."""
    rule = Rule(1, "LICENSE", "iHL", {"edit_distance": 1, "min_offset": 200}, LITERAL)
    return doc_events(approx.scan_edit_distance(documents(spark, sf_dir), [rule]))


def lines_of(spark, sf_dir) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", F.split("text", "\n").alias("pieces"))


@query
def vectored_lines(spark, sf_dir):
    rule = Rule(1, r"\.[A-Z][a-z]", "L")
    docs = lines_of(spark, sf_dir)
    found = scan.scan_vectored(docs, rule)
    return doc_events(found)


@query
def edit_distance(spark, sf_dir):
    rule = Rule(1, "License", "L", {"edit_distance": 1}, LITERAL)
    return doc_events(approx.scan_edit_distance(documents(spark, sf_dir), [rule]))


@query
def hamming_distance(spark, sf_dir):
    rule = Rule(1, "License", "L", {"hamming_distance": 2}, LITERAL)
    return doc_events(approx.scan_hamming_distance(documents(spark, sf_dir), [rule]))


# --------------------------------------------------------------------------
# events

NUMBER_RULES = [Rule(1, "[0-9]+", "L"), Rule(2, "[0-9]{4}", "L"), Rule(3, r"\.[0-9]", "L")]


def number_events(spark, sf_dir) -> DataFrame:
    return scan.scan_events(documents(spark, sf_dir), NUMBER_RULES)


@query
def coalesce_scan(spark, sf_dir):
    return doc_events(events.coalesce_events(number_events(spark, sf_dir), scope="scan"))


@query
def coalesce_rule(spark, sf_dir):
    return doc_events(events.coalesce_events(number_events(spark, sf_dir), scope="rule"))


@query
def single_match(spark, sf_dir):
    return doc_events(events.single_match(number_events(spark, sf_dir)))


@query
def start_of_match(spark, sf_dir):
    found = number_events(spark, sf_dir)
    return doc_events(events.start_of_match(found, F.col("rule_id") != 2))


@query
def som_horizon(spark, sf_dir):
    # three times the text, so that matches reach back beyond the horizon
    docs = documents(spark, sf_dir).select("doc_id", F.repeat("text", 3).alias("text"))
    reaching_back = scan.scan_events(docs, Rule(1, r"\A.+[0-9]", "Ls"))
    return doc_events(events.som_horizon(reaching_back, "small"))


@query
def offset_filter(spark, sf_dir):
    return doc_events(events.offset_filter(number_events(spark, sf_dir), 50, 20000, 2))


COMBINED = [
    Rule(101, "License", "Q"),
    Rule(102, "token", "Q"),
    Rule(103, "[0-9]{4}", ""),
    Rule(104, "(101 | 102) & 103", "C"),
    Rule(105, "103 & !101", "C"),
    Rule(106, "!101 & !102 & !103", "C"),
]


@query
def combine_and_not(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = scan.scan_exact(docs, COMBINED)
    blocks = docs.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"))
    formulas = events.combination_formulas(COMBINED)
    return doc_events(events.combine_rules(found, formulas, blocks=blocks))


@query
def quiet(spark, sf_dir):
    found = scan.scan_exact(documents(spark, sf_dir), COMBINED)
    return doc_events(events.drop_quiet(found, COMBINED))


@query
def rule_set(spark, sf_dir):
    """Rules, quiet rules, formulas over them and an approximate rule in one scan."""
    near = Rule(107, "License", "", {"hamming_distance": 2}, LITERAL)
    return doc_events(scan_rule_set(documents(spark, sf_dir), [*COMBINED, near]))


@query
def flag_prefilter_mode(spark, sf_dir):
    """``P`` rules are exact here."""
    return doc_events(scan.scan_events(documents(spark, sf_dir), Rule(1, "License", "LP")))


@query
def flag_unicode_classes(spark, sf_dir):
    rule = Rule(1, r"\bé\w\w\b", "8W", kind=LEFTMOST)
    found = scan.scan_leftmost(documents(spark, sf_dir), rule)
    return events.count_events(found, ("doc_id",)).select(*big("doc_id", "n_matches"))


@query
def stop_after(spark, sf_dir):
    return doc_events(events.stop_after(number_events(spark, sf_dir), F.col("rule_id") == 2))


@query
def skip_after(spark, sf_dir):
    return doc_events(events.skip_after(number_events(spark, sf_dir), 2))


@query
def limit_events(spark, sf_dir):
    found = events.limit_events(number_events(spark, sf_dir), 3)
    return found.select(*big("doc_id", *EVENT), "truncated")


@query
def record_events(spark, sf_dir):
    docs = documents(spark, sf_dir)
    recorded = events.record_events(number_events(spark, sf_dir), blocks=docs)
    ends = F.array_join(F.transform("events", lambda e: e["to_off"].cast("string")), ",")
    return recorded.select(*big("doc_id"), "matched", ends.alias("ends"))


@query
def limit_events_many(spark, sf_dir):
    """A limit beyond what a task cuts by itself: the first orders of each year."""
    by_year = table(spark, sf_dir, "orders").selectExpr(
        "date_format(o_orderdate, 'yyyy') AS doc_id",
        "CAST(o_custkey % 7 AS INT) AS rule_id",
        "0L AS from_off",
        "o_orderkey AS to_off",
        "0 AS flags",
    )
    found = events.limit_events(by_year, 1500)
    return found.select("doc_id", *big("rule_id", "to_off"), "truncated")


@query
def record_segments(spark, sf_dir):
    recorded = events.record_segments(number_events(spark, sf_dir), size=4)
    ends = F.array_join(F.transform("events", lambda e: e["to_off"].cast("string")), ",")
    return recorded.select(*big("doc_id", "segment"), ends.alias("ends"))


def _until(key, batches, context):
    """Events and the last end up to the first event of a rule."""
    n = last = 0
    for pdf in batches:
        stops = (pdf["rule_id"] == context).to_numpy().nonzero()[0]
        seen = pdf.iloc[: stops[0] + 1] if len(stops) else pdf
        n, last = n + len(seen), int(seen["to_off"].iloc[-1])
        if len(stops):
            break
    yield key[0], n, last


@query
def handler_batches(spark, sf_dir):
    """A handler that stops at the first event of rule 2."""
    return events.apply_handler_batches(
        number_events(spark, sf_dir),
        _until,
        "doc_id bigint, n_events bigint, last_off bigint",
        context=2,
    )


def _span(key, pdf, context):
    """Longest distance between neighbouring ends, scaled by the context."""
    gaps = pdf["to_off"].diff().fillna(0)
    yield int(key[0]), len(pdf), int(gaps.max()) * context


@query
def handler(spark, sf_dir):
    return events.apply_handler(
        number_events(spark, sf_dir),
        _span,
        "doc_id bigint, n_events bigint, widest_gap bigint",
        context=2,
    )


@query
def count_events(spark, sf_dir):
    return events.count_events(number_events(spark, sf_dir)).select(*big("rule_id", "n_matches"))


# --------------------------------------------------------------------------
# streams


def conversations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("stream_id"), F.col("turn").alias("seq"), F.col("text").alias("chunk")
    )


def stream_events(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*big(*(keys or ("stream_id",)), *EVENT))


@query
def chunk_text(spark, sf_dir):
    cut = chunks.chunk_text(documents(spark, sf_dir), size=1000, overlap=16)
    return cut.select(
        *big("doc_id", "seq", "start_off"),
        F.octet_length("chunk").cast("bigint").alias("n_bytes"),
        F.md5("chunk").alias("digest"),
    )


# a full stop at the end of a turn meets the capital that starts the next one
ACROSS = Rule(1, r"\.[A-Z][a-z]", "L")
CLOSING = [Rule(1, r"[a-z]\.$", "L"), Rule(2, r"[a-z]+\b", "")]


@query
def stream_scan(spark, sf_dir):
    return stream_events(chunks.scan_stream(conversations(spark, sf_dir), ACROSS))


@query
def stream_scan_unbounded(spark, sf_dir):
    rule = Rule(1, r"\.[A-Z]+[a-z]*,", "L")
    return stream_events(chunks.scan_stream(conversations(spark, sf_dir), rule))


@query
def stream_documents(spark, sf_dir):
    cut = chunks.chunk_text(documents(spark, sf_dir), size=512)
    found = chunks.scan_stream(cut, DIGITS_5, ("doc_id",))
    return doc_events(found)


DIGITS_5 = Rule(1, "[0-9]{5}", "L")


def word_rules(spark, sf_dir, flags: str = "L") -> DataFrame:
    """A rule per different word of ``benchmark`` (five letters or more): the
    word and the sign after it."""
    arrays = table(spark, sf_dir, "benchmark").select("item_id", F.split("text", "[^A-Za-z]+").alias("s"))
    words = arrays.select("item_id", F.posexplode("s").alias("pos", "word"))
    number = F.col("item_id") * widest(arrays, F.size("s")) + F.col("pos")
    first = words.filter("char_length(word) >= 5").groupBy("word").agg(F.min(number).alias("rule_id"))
    whole = F.concat(F.lit(r"\b"), "word", F.lit(r"[ ,.\n]")).alias("expression")
    return rule_lines.rules_from_strings(first.select("rule_id", whole), flags=flags)


@query
def stream_rule_table(spark, sf_dir):
    """Hundreds of rules over documents that are cut inside words."""
    cut = chunks.chunk_text(documents(spark, sf_dir), size=512)
    return doc_events(chunks.scan_stream(cut, word_rules(spark, sf_dir), ("doc_id",), bucket=4))


@query
def stream_close(spark, sf_dir):
    return stream_events(chunks.close_streams(conversations(spark, sf_dir), CLOSING[0]))


def with_resets(spark, sf_dir) -> DataFrame:
    """Conversations with a reset after every turn of the assistant."""
    turns = table(spark, sf_dir, "conversations")
    kept = turns.select(
        F.col("conv_id").alias("stream_id"),
        (F.col("turn") * 2).alias("seq"),
        F.col("text").alias("chunk"),
        F.lit(None).cast("string").alias("control"),
    )
    resets = turns.filter("role = 'assistant'").select(
        F.col("conv_id").alias("stream_id"),
        (F.col("turn") * 2 + 1).alias("seq"),
        F.lit("").alias("chunk"),
        F.lit("reset").alias("control"),
    )
    return kept.unionByName(resets)


@query
def stream_reset(spark, sf_dir):
    epochs = chunks.reset_epochs(with_resets(spark, sf_dir))
    return stream_events(
        chunks.scan_stream(epochs, ACROSS, ("stream_id", "epoch")), "stream_id", "epoch"
    )


@query
def stream_fork(spark, sf_dir):
    """Every turn forks its conversation, and the branch says it again."""
    turns = conversations(spark, sf_dir)
    branch = (F.col("stream_id") * widest(turns, F.col("seq") + 1) + F.col("seq")).alias("branch_id")
    forks = turns.select(branch, "stream_id", F.col("seq").alias("fork_seq"))
    again = turns.select(branch, F.col("seq") + 1, "chunk").toDF("branch_id", "seq", "chunk")
    return stream_events(chunks.fork_streams(turns, forks, again, ACROSS), "branch_id")


@query
def stream_state(spark, sf_dir):
    state = chunks.export_state(conversations(spark, sf_dir), ACROSS)
    return state.select(
        *big("stream_id"), F.hex("tail").alias("tail"), *big("base", "next_seq", "state_bytes")
    )


@query
def stream_seed(spark, sf_dir):
    """Scan the first turn, save, and continue with the others."""
    turns = conversations(spark, sf_dir)
    state = chunks.export_state(turns.filter("seq = 0"), ACROSS)
    rest = chunks.scan_stream(turns.filter("seq > 0"), ACROSS, state=state)
    return stream_events(rest)


ONCE = Rule(1, r"\.[A-Z][a-z]", "LH")


@query
def stream_seed_single(spark, sf_dir):
    """A single-match rule goes on from a saved state: found before, not again."""
    turns = conversations(spark, sf_dir)
    state = chunks.export_state(turns.filter("seq = 0"), ONCE)
    return stream_events(chunks.scan_stream(turns.filter("seq > 0"), ONCE, state=state))


@query
def stream_scan_small_runs(spark, sf_dir):
    """Runs of two turns, so that matches cross them."""
    return stream_events(chunks.scan_stream(conversations(spark, sf_dir), ACROSS, bucket=2))


@query
def stream_match(spark, sf_dir):
    return chunks.stream_match(conversations(spark, sf_dir), ACROSS).select(
        *big("stream_id"), "matched"
    )


@query
def stream_find(spark, sf_dir):
    found = chunks.stream_find(conversations(spark, sf_dir), ACROSS, 2, with_text=True)
    return found.select(*big("stream_id", *EVENT), "text")


@query
def stream_find_prefix(spark, sf_dir):
    """Without starts the first match is everything up to its end."""
    rule = Rule(1, r"\.[A-Z][a-z]", "H")
    found = chunks.stream_find(conversations(spark, sf_dir), rule, 1, with_text=True)
    return found.select(*big("stream_id", *EVENT), F.md5("text").alias("digest"))


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors see: where the cluster wants checkpoints,
    or else beside its tables."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/patternscan-{uuid.uuid4().hex}"


@query
def stream_live(spark, sf_dir):
    """The conversations as files that arrive one after the other."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, live.STATE_STORE)
    try:
        schema = table(spark, sf_dir, "conversations").schema
        source = spark.readStream.schema(schema).parquet(
            os.path.join(sf_dir, "conversations.parquet*")
        )
        found = live.scan_stream_live(source, ACROSS, ("conv_id",), "turn", "text")
        folder = shared_folder(spark)
        running = (
            found.writeStream.format("parquet")
            .option("path", os.path.join(folder, "events"))
            .option("checkpointLocation", os.path.join(folder, "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        running.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
    out = spark.read.schema(found.schema).parquet(os.path.join(folder, "events"))
    return stream_events(out.withColumnRenamed("conv_id", "stream_id"))


# --------------------------------------------------------------------------
# applications


@query
def grep_lines(spark, sf_dir):
    found = grep.grep_lines(pages(spark, sf_dir), "<title>[A-Z]", "html", ("page_id",), byte_offset=True)
    return found.select(*big("page_id", "from_off", "to_off", "line_off"), "line")


@query
def grep_documents(spark, sf_dir):
    found = grep.grep_lines(documents(spark, sf_dir), "License", "text", ("doc_id",), True)
    return found.select(*big("doc_id", "from_off", "to_off", "line_off"), "line")


@query
def grep_totals(spark, sf_dir):
    return grep.grep_totals(pages(spark, sf_dir), "href", "html")


def captured(spark, sf_dir) -> DataFrame:
    """Events in the shape of captured packets."""
    return spread(table(spark, sf_dir, "events"), "event_id").selectExpr(
        "event_id AS seq",
        "IF(event_id % 10 = 0, 6, 4) AS ip_version",
        "IF(event_id % 7 = 0, 8, 0) AS frag_offset",
        "event_id % 11 = 0 AS more_fragments",
        "IF(event_id % 2 = 0, 6, IF(event_id % 5 = 0, 1, 17)) AS protocol",
        "concat('u', user_id) AS src_addr",
        "event_type AS dst_addr",
        "CAST(user_id % 65536 AS INT) AS src_port",
        "443 AS dst_port",
        "props AS payload",
    )


PACKET_RULES = [Rule(1, '"k": 1', "L"), Rule(2, r"\}\{", "L"), Rule(3, r"[0-9]\}$", "L")]


@query
def eligible_packets(spark, sf_dir):
    return packets.eligible_packets(captured(spark, sf_dir)).select(
        *big("seq", "protocol"), "src_addr", "dst_addr", *big("src_port")
    )


@query
def assign_streams(spark, sf_dir):
    flows = packets.assign_streams(packets.eligible_packets(captured(spark, sf_dir)))
    return flows.select(*big("seq", "stream_id"))


@query
def payload_stats(spark, sf_dir):
    stats = packets.payload_stats(packets.eligible_packets(captured(spark, sf_dir)))
    return stats.select(*big(*stats.columns))


@query
def scan_packets_block(spark, sf_dir):
    eligible = packets.eligible_packets(captured(spark, sf_dir))
    return packets.scan_packets(eligible, PACKET_RULES, "BLOCK").select(*big("seq", *EVENT))


@query
def scan_packets_stream(spark, sf_dir):
    eligible = packets.eligible_packets(captured(spark, sf_dir))
    return stream_events(packets.scan_packets(eligible, PACKET_RULES, "STREAM"))


@query
def match_rate(spark, sf_dir):
    eligible = packets.eligible_packets(captured(spark, sf_dir))
    return packets.match_rate(eligible, PACKET_RULES).select(
        "mode", *big("n_matches", "n_bytes"), "matches_per_kb"
    )
