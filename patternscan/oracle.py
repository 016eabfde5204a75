"""What each query must return, as SQL for another engine.

Offsets are in bytes.  ``docs`` holds every text with each byte beyond ASCII
replaced by chr(1), so that positions in it are byte offsets.
"""

from __future__ import annotations

from patternscan.functions import presets

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES["q_" + name] = sql


def bytes_of(column: str) -> str:
    """One ASCII character per byte."""
    sql = column
    for low, high, n in (("80", "7ff", 2), ("800", "ffff", 3), ("10000", "10ffff", 4)):
        filler = " || ".join(["chr(1)"] * n)
        sql = f"regexp_replace({sql}, '[\\x{{{low}}}-\\x{{{high}}}]', {filler}, 'g')"
    return sql


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


DOCS = f"docs AS (SELECT doc_id, lang, text, {bytes_of('text')} AS t FROM documents)"


def leftmost(name: str, regex: str, source: str = "docs", key: str = "doc_id", t: str = "t") -> str:
    """A CTE of non-overlapping matches: key, i, x, from_off, to_off."""
    return f"""{name} AS (
  SELECT {key}, i, x, to_off - strlen(x) AS from_off, to_off FROM (
    SELECT {key}, i, x,
      sum(strlen(gap) + strlen(x)) OVER (PARTITION BY {key} ORDER BY i)::BIGINT AS to_off
    FROM (
      SELECT {key}, unnest(m) AS x, unnest(g[1:len(m)]) AS gap, unnest(range(1, len(m) + 1)) AS i
      FROM (SELECT {key}, regexp_extract_all({t}, {quoted(regex)}) AS m,
                   string_split_regex({t}, {quoted(regex)}) AS g
            FROM {source} WHERE regexp_matches({t}, {quoted(regex)})))))"""


def windows(source: str = "docs", key: str = "doc_id", t: str = "t") -> str:
    """A CTE with the next 64 bytes (or what is left) at every position."""
    return f"""blocks AS (
  SELECT {key}, i, blk, coalesce(lead(blk) OVER (PARTITION BY {key} ORDER BY i), '') AS nxt
  FROM (SELECT {key}, unnest(range(0, len(b))) AS i, unnest(b) AS blk
        FROM (SELECT {key}, regexp_extract_all({t}, '(?s).{{1,64}}') AS b FROM {source}))),
places AS (
  SELECT {key}, i * 64 + j AS p, substr(blk || nxt, j + 1, 64) AS w
  FROM (SELECT {key}, i, blk, nxt, unnest(range(0, strlen(blk))) AS j FROM blocks))"""


def literal_hits(name: str, literal: str, source: str = "docs", key: str = "doc_id") -> str:
    """A CTE of occurrences of a literal that cannot overlap itself."""
    return f"""{name} AS (
  SELECT {key}, to_off - {len(literal)} AS from_off, to_off FROM (
    SELECT {key}, sum(strlen(gap) + {len(literal)}) OVER (PARTITION BY {key} ORDER BY i)::BIGINT
             AS to_off
    FROM (SELECT {key}, unnest(g[1:len(g) - 1]) AS gap, unnest(range(1, len(g))) AS i
          FROM (SELECT {key}, string_split(t, {quoted(literal)}) AS g FROM {source}))))"""


EVENT = "doc_id, rule_id, from_off, to_off"

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

FLAG_VALUES = "MAP {'i':1,'s':2,'m':4,'H':8,'V':16,'8':32,'W':64,'P':128,'L':256,'C':512,'Q':1024}"

PARSED = f"""
lines AS (SELECT p_partkey AS line_no, {PART_LINES} AS line FROM part),
kept AS (SELECT *, trim(line) AS s FROM lines WHERE trim(line) <> '' AND trim(line) NOT LIKE '#%'),
cut AS (
  SELECT line_no, line, s,
    CASE WHEN regexp_matches(s, '^[^/]+:/.*/') THEN regexp_extract(s, '^([^/]+):/', 1) END AS id_text,
    regexp_replace(s, '^[^/]+:(/.*/)', '\\1') AS rest
  FROM kept),
split_up AS (
  SELECT *,
    CASE WHEN regexp_matches(rest, '^/.+/') THEN regexp_extract(rest, '^/(.+)/', 1) ELSE rest END
      AS expression,
    CASE WHEN regexp_matches(rest, '^/.+/') THEN regexp_extract(rest, '^/.+/([^/{{]*)', 1) ELSE '' END
      AS raw_flags,
    nullif(regexp_extract(rest, '\\{{.*\\}}$'), '') AS ext
  FROM cut),
parsed AS (
  SELECT *,
    list_sort(list_distinct(list_filter(
      string_split(translate(raw_flags, 'oeupfl', 'HV8WPL'), ''), lambda x: x <> ''))) AS letters,
    CASE
      WHEN id_text IS NOT NULL AND try_cast(id_text AS INTEGER) IS NULL
        THEN concat('pattern id `', id_text, '`')
      WHEN regexp_matches(raw_flags, '[^ismHV8WPLCQoeupfl]')
        THEN concat('flag `', regexp_extract(raw_flags, '[^ismHV8WPLCQoeupfl]'), '`')
      WHEN regexp_matches(ext, '=[^,}}]*[^0-9,}}]')
        THEN concat('ext value `', regexp_extract(ext, '=([^,}}]*[^0-9,}}][^,}}]*)', 1), '`')
    END AS error,
    coalesce(try_cast(id_text AS INTEGER), 0)::BIGINT AS rule_id,
    try_cast(regexp_extract(lower(ext), 'min_offset=([0-9]+)', 1) AS BIGINT) AS min_offset,
    try_cast(regexp_extract(lower(ext), 'min_length=([0-9]+)', 1) AS BIGINT) AS min_length
  FROM split_up)"""

oracle(
    "ingest_rules",
    f"""WITH {PARSED}
SELECT line_no, rule_id, expression, array_to_string(letters, '') AS flags,
  coalesce(list_sum(list_transform(letters, lambda x: {FLAG_VALUES}[x])), 0)::BIGINT AS flag_bits,
  min_offset, min_length
FROM parsed WHERE error IS NULL""",
)
oracle(
    "rule_rejects",
    f"WITH {PARSED} SELECT line_no, rule_id, error FROM parsed WHERE error IS NOT NULL",
)
oracle(
    "rule_canonical",
    f"""WITH {PARSED}
SELECT min(line_no)::BIGINT AS line_no, canonical FROM (
  SELECT line_no, concat(
    CASE WHEN rule_id > 0 THEN concat(rule_id, ':') ELSE '' END, '/', expression, '/',
    array_to_string(letters, ''),
    CASE WHEN ext IS NOT NULL THEN
      concat('{{', concat_ws(',', 'min_offset=' || min_offset, 'min_length=' || min_length), '}}')
    ELSE '' END) AS canonical
  FROM parsed WHERE error IS NULL)
GROUP BY canonical""",
)
oracle(
    "rule_ids_required",
    """SELECT p_partkey AS line_no, p_partkey AS rule_id, p_name AS expression, 'is' AS flags
FROM part WHERE p_size % 5 <> 0""",
)
oracle(
    "rule_audit",
    """WITH w AS (SELECT p_partkey AS k, length(p_name)::BIGINT AS n FROM part)
SELECT k AS rule_id, k % 6 NOT IN (3, 5) AS valid,
  CASE WHEN k % 6 IN (0, 1, 2, 4) THEN n END AS min_width,
  CASE WHEN k % 6 IN (0, 2) THEN n WHEN k % 6 = 1 THEN n + 1 END AS max_width,
  CASE WHEN k % 6 NOT IN (3, 5) THEN k % 6 = 2 END AS unordered,
  CASE WHEN k % 6 NOT IN (3, 5) THEN k % 6 = 2 END AS at_eod,
  CASE WHEN k % 6 NOT IN (3, 5) THEN k % 6 = 2 END AS only_at_eod
FROM w""",
)

SENTENCES = """sentences AS (
  SELECT min(item_id * widest + pos)::BIGINT AS rule_id, expression FROM (
    SELECT item_id, max(len(s)) OVER () AS widest, unnest(s) AS expression, unnest(range(0, len(s))) AS pos
    FROM (SELECT item_id, string_split_regex(text, '[.\\n]+ ?') AS s FROM benchmark))
  WHERE expression <> '' GROUP BY expression)"""

oracle(
    "dictionary_rules",
    f"""WITH {SENTENCES} SELECT rule_id, expression, 'Li' AS flags, 257::BIGINT AS flag_bits,
  'literal' AS kind FROM sentences""",
)
oracle(
    "rules_from_strings",
    """SELECT row_number() OVER (ORDER BY item_id, pos)::BIGINT AS rule_id, expression,
  'all_ends' AS kind
FROM (SELECT item_id, unnest(s) AS expression, unnest(range(0, len(s))) AS pos
      FROM (SELECT item_id, string_split_regex(text, '[.\\n]+ ?') AS s FROM benchmark))""",
)

# --------------------------------------------------------------------------
# yes / no scans

PLAIN = (
    presets.FLOAT_NUMBER,
    presets.IPV4_ADDRESS,
    presets.EMAIL_ADDRESS,
    presets.CREDIT_CARD,
)
STRICT = (
    presets.FLOAT_NUMBER_STRICT,
    presets.IPV4_ADDRESS_STRICT,
    presets.EMAIL_ADDRESS_STRICT,
    presets.CREDIT_CARD_STRICT,
)


def _each(rules, source: str = "docs", columns: str = "doc_id, lang", t: str = "t") -> str:
    return " UNION ALL ".join(
        f"SELECT {columns}, {i}::BIGINT AS rule_id FROM {source} WHERE regexp_matches({t}, {quoted(r)})"
        for i, r in enumerate(rules, 1)
    )


oracle(
    "pii_by_lang",
    f"""WITH {DOCS}, hits AS ({_each(PLAIN)})
SELECT lang, rule_id, count(*)::BIGINT AS n_matches FROM hits GROUP BY lang, rule_id""",
)
oracle(
    "tag_pii_strict",
    f"""WITH {DOCS}, hits AS ({_each(STRICT)})
SELECT doc_id, rule_id,
  (['float_number', 'ipv4_address', 'email_address', 'credit_card'])[rule_id] AS tag FROM hits""",
)
oracle(
    "match_any_license",
    "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '(?i)licen[sc]e')",
)
PART_REGEXES = ("^red", "gear$", "(small|large) ", "(?i)BOLT", "[aeiou]{2}", r"\bring\b")
oracle("match_rules_parts", _each(PART_REGEXES, "part", "p_partkey", "p_name"))

FLAG_REGEXES = (
    "(?m)^[A-Z][a-z]+ [a-z]+",
    r"(?m)\.$",
    r"(?s)[a-z]\..[A-Z]",
    r"[a-z]\..[A-Z]",
    "(?i)THE [a-z]",
)
oracle(
    "flags_multiline_dotall",
    f"WITH {DOCS} "
    + " UNION ALL ".join(
        f"""SELECT doc_id, {i}::BIGINT AS rule_id,
  len(regexp_extract_all(t, {quoted(r)}))::BIGINT AS n_matches
FROM docs WHERE regexp_matches(t, {quoted(r)})"""
        for i, r in enumerate(FLAG_REGEXES, 1)
    ),
)

SENTENCE_RULES = f"""{SENTENCES}, rules AS (
  SELECT rule_id, expression AS plain, regexp_escape(expression) || '[.\\n]' AS expression FROM sentences)"""

oracle(
    "prefilter_rules",
    f"""WITH {SENTENCE_RULES}
SELECT doc_id, rule_id FROM documents, rules
WHERE contains(text, plain) AND regexp_matches(text, expression)""",
)

# --------------------------------------------------------------------------
# event scans

RUNS = leftmost("runs", "[0-9]+")
RUN_ENDS = """SELECT doc_id, 1::BIGINT AS rule_id, from_off,
  unnest(range(from_off + 1, to_off + 1)) AS to_off FROM runs"""

oracle("scan_events_digits", f"WITH {DOCS}, {RUNS} {RUN_ENDS}")
oracle(
    "scan_events_endings",
    f"""WITH {DOCS}, {windows()}, pairs AS (
  SELECT doc_id, p, p + n AS e FROM (SELECT doc_id, p, w, unnest([3, 4, 5, 6]) AS n FROM places
    WHERE regexp_matches(w, '^(ing|tion|ation|ed)'))
  WHERE regexp_matches(substr(w, 1, n), '^(ing|tion|ation|ed)[ ,.]$') AND strlen(w) >= n)
SELECT doc_id, 1::BIGINT AS rule_id, min(p)::BIGINT AS from_off, e::BIGINT AS to_off
FROM pairs GROUP BY doc_id, e""",
)
oracle(
    "scan_events_no_start",
    f"""WITH {DOCS}, {literal_hits('a', 'token')}, {literal_hits('b', 'License')}
SELECT doc_id, 1::BIGINT AS rule_id, 0::BIGINT AS from_off, to_off FROM a
UNION ALL SELECT doc_id, 2::BIGINT, 0::BIGINT, min(to_off) FROM b GROUP BY doc_id
UNION ALL SELECT doc_id, 3::BIGINT, 0::BIGINT, strlen(regexp_extract(t, '(?is)^.*?the'))
FROM docs WHERE regexp_matches(t, '(?i)the')""",
)
oracle(
    "scan_events_word_end",
    f"""WITH {DOCS}, {leftmost('words', '[A-Za-z0-9_]+')}
SELECT doc_id, 1::BIGINT AS rule_id, from_off, to_off FROM words
WHERE regexp_matches(x, '^th[a-z]{{1,3}}$')""",
)
oracle(
    "scan_events_bounds",
    f"""WITH {DOCS}, {RUNS}, e AS ({RUN_ENDS})
SELECT * FROM e WHERE to_off BETWEEN 100 AND 5000 AND to_off - from_off >= 3""",
)
oracle(
    "scan_events_utf8",
    """WITH p AS (
  SELECT doc_id, text, unnest(range(1, length(text) - 1)) AS i FROM documents
  WHERE contains(text, 'é')),
h AS (SELECT doc_id, text, i FROM p
      WHERE text[i] = 'é' AND text[i + 2] = 'é' AND text[i + 1] <> chr(10))
SELECT doc_id, 1::BIGINT AS rule_id, strlen(text[1:i - 1])::BIGINT AS from_off,
  strlen(text[1:i + 2])::BIGINT AS to_off FROM h""",
)
oracle(
    "scan_events_rule_table",
    f"""WITH {SENTENCE_RULES}, hits AS (
  SELECT doc_id, rule_id, unnest(regexp_extract_all(text, expression)) AS x FROM documents, rules
  WHERE contains(text, plain) AND regexp_matches(text, expression))
SELECT doc_id, rule_id, count(*)::BIGINT AS n_matches FROM hits GROUP BY doc_id, rule_id""",
)
oracle(
    "captures_rule_table",
    f"""WITH {SENTENCE_RULES}, hits AS (
  SELECT doc_id, rule_id, unnest(regexp_extract_all(text, expression)) AS x FROM documents, rules
  WHERE contains(text, plain) AND regexp_matches(text, expression))
SELECT doc_id, rule_id, count(*)::BIGINT AS n_matches,
  count(*) FILTER (x LIKE '%.')::BIGINT AS n_stops,
  sum(strlen(x) - 1)::BIGINT AS n_bytes, sum(strlen(x) - 1)::BIGINT AS sign_after
FROM hits GROUP BY doc_id, rule_id""",
)
oracle(
    "scan_leftmost_numbers",
    f"WITH {DOCS}, {RUNS} SELECT doc_id, 1::BIGINT AS rule_id, from_off, to_off FROM runs",
)
oracle(
    "captures_token",
    """SELECT doc_id, unnest(range(0, len(m))) AS n, unnest(m) AS token
FROM (SELECT doc_id, regexp_extract_all(text, 'token = "([^"]+)"', 1) AS m FROM documents)""",
)
NUMBER_GROUPS = r"([0-9]{1,3})\.([0-9]{1,3})(\.[0-9]{1,3})?"
oracle(
    "captures_offsets",
    f"""WITH {DOCS}, {leftmost('m', NUMBER_GROUPS)}, parts AS (
  SELECT doc_id, from_off, to_off, x, regexp_extract(x, '^([0-9]+)', 1) AS a,
    regexp_extract(x, '^[0-9]+\\.([0-9]+)', 1) AS b,
    regexp_extract(x, '^[0-9]+\\.[0-9]+(\\.[0-9]+)', 1) AS c FROM m)
SELECT doc_id, from_off, to_off, 0::BIGINT AS "group", from_off AS group_from, to_off AS group_to,
  x AS group_text FROM parts
UNION ALL SELECT doc_id, from_off, to_off, 1, from_off, from_off + strlen(a), a FROM parts
UNION ALL SELECT doc_id, from_off, to_off, 2, from_off + strlen(a) + 1,
  from_off + strlen(a) + 1 + strlen(b), b FROM parts
UNION ALL SELECT doc_id, from_off, to_off, 3, CASE WHEN c <> '' THEN to_off - strlen(c) END,
  CASE WHEN c <> '' THEN to_off END, nullif(c, '') FROM parts""",
)
oracle(
    "find_first",
    f"WITH {DOCS}, {RUNS} SELECT doc_id, from_off, to_off, x AS text FROM runs WHERE i = 1",
)
oracle(
    "find_all_3",
    f"""WITH {DOCS}, {RUNS}
SELECT doc_id, i - 1 AS n, from_off, to_off, x AS text FROM runs WHERE i <= 3""",
)
oracle(
    "scan_literals_small",
    f"""WITH {DOCS}, {literal_hits('a', 'License')}, {literal_hits('b', 'token = "')}, {windows()}
SELECT doc_id, 1::BIGINT AS rule_id, from_off, to_off FROM a
UNION ALL SELECT doc_id, 2, from_off, to_off FROM b
UNION ALL SELECT doc_id, 3, p, p + 3 FROM places WHERE substr(w, 1, 3) = '...'""",
)
oracle(
    "scan_literals_dictionary",
    f"""WITH {SENTENCES}, found AS (
  SELECT doc_id, rule_id, strlen(expression) AS n, string_split(text, expression) AS g
  FROM documents, sentences WHERE contains(text, expression)),
hits AS (SELECT doc_id, rule_id, n, unnest(g[1:len(g) - 1]) AS gap, unnest(range(1, len(g))) AS i
         FROM found),
ends AS (SELECT doc_id, rule_id, n, sum(strlen(gap) + n) OVER
           (PARTITION BY doc_id, rule_id ORDER BY i)::BIGINT AS to_off FROM hits)
SELECT doc_id, rule_id, to_off - n AS from_off, to_off FROM ends""",
)
oracle(
    "vectored_lines",
    f"""WITH docs AS (SELECT doc_id, replace({bytes_of('text')}, chr(10), '') AS t FROM documents),
{leftmost('m', '[.][A-Z][a-z]')}
SELECT doc_id, 1::BIGINT AS rule_id, from_off, to_off FROM m""",
)
oracle(
    "edit_distance",
    f"""WITH {DOCS}, {windows()}, pairs AS (
  SELECT doc_id, p, p + n AS e FROM (SELECT doc_id, p, w, unnest([6, 7, 8]) AS n FROM places)
  WHERE strlen(w) >= n AND levenshtein(substr(w, 1, n), 'License') <= 1)
SELECT doc_id, 1::BIGINT AS rule_id, min(p)::BIGINT AS from_off, e::BIGINT AS to_off
FROM pairs GROUP BY doc_id, e""",
)
oracle(
    "hamming_distance",
    f"""WITH {DOCS}, {windows()}
SELECT doc_id, 1::BIGINT AS rule_id, p AS from_off, p + 7 AS to_off FROM places
WHERE strlen(w) >= 7 AND hamming(substr(w, 1, 7), 'License') <= 2""",
)

# --------------------------------------------------------------------------
# events

NUMBERS = f"""{DOCS}, {RUNS}, {leftmost('dots', '[.][0-9]')}, ev AS (
  {RUN_ENDS}
  UNION ALL SELECT doc_id, 2, to_off - 4, to_off FROM (
    SELECT doc_id, unnest(range(from_off + 4, to_off + 1)) AS to_off FROM runs
    WHERE to_off - from_off >= 4)
  UNION ALL SELECT doc_id, 3, from_off, to_off FROM dots)"""

for scope, group in (("scan", "doc_id"), ("rule", "doc_id, rule_id")):
    w = f"OVER (PARTITION BY {group} ORDER BY to_off, rule_id, from_off)"
    oracle(
        f"coalesce_{scope}",
        f"""WITH {NUMBERS}, nxt AS (SELECT *, lead(rule_id) {w} AS r, lead(from_off) {w} AS f,
  lead(to_off) {w} AS e FROM ev)
SELECT {EVENT} FROM nxt
WHERE NOT coalesce(r = rule_id AND f = from_off AND e > to_off, false)""",
    )

RANKED = f"""{NUMBERS}, ranked AS (SELECT *,
  row_number() OVER (PARTITION BY doc_id ORDER BY to_off, rule_id, from_off) AS rn,
  row_number() OVER (PARTITION BY doc_id, rule_id ORDER BY to_off, from_off) AS rule_rn,
  count(*) OVER (PARTITION BY doc_id) AS n FROM ev)"""

oracle("single_match", f"WITH {RANKED} SELECT {EVENT} FROM ranked WHERE rule_rn = 1")
oracle("skip_after", f"WITH {RANKED} SELECT {EVENT} FROM ranked WHERE rule_rn <= 2")
oracle(
    "limit_events", f"WITH {RANKED} SELECT {EVENT}, n > 3 AS truncated FROM ranked WHERE rn <= 3"
)
oracle(
    "stop_after",
    f"""WITH {RANKED}, stops AS (
  SELECT doc_id, min(rn) AS stop FROM ranked WHERE rule_id = 2 GROUP BY doc_id)
SELECT {EVENT} FROM ranked LEFT JOIN stops USING (doc_id) WHERE rn <= coalesce(stop, rn)""",
)
oracle(
    "start_of_match",
    f"""WITH {NUMBERS} SELECT doc_id, rule_id,
  CASE WHEN rule_id <> 2 THEN from_off ELSE 0 END AS from_off, to_off FROM ev""",
)
oracle(
    "som_horizon",
    f"""WITH {DOCS.replace("SELECT doc_id, lang, text, ", "SELECT doc_id, ").replace("(text,", "(repeat(text, 3),")}, {RUNS}, ends AS ({RUN_ENDS})
SELECT doc_id, rule_id, CASE WHEN to_off <= 65536 THEN 0::BIGINT END AS from_off, to_off
FROM ends WHERE to_off >= 2""",
)
oracle(
    "offset_filter",
    f"""WITH {NUMBERS} SELECT * FROM ev
WHERE to_off BETWEEN 50 AND 20000 AND to_off - from_off >= 2""",
)
FIRSTS = f"""{DOCS}, firsts AS (SELECT doc_id, strlen(t)::BIGINT AS n,
  nullif(strlen(regexp_extract(t, '(?s)^.*?License')), 0)::BIGINT AS a,
  nullif(strlen(regexp_extract(t, '(?s)^.*?token')), 0)::BIGINT AS b,
  nullif(strlen(regexp_extract(t, '(?s)^.*?[0-9]{{4}}')), 0)::BIGINT AS c FROM docs)"""
oracle(
    "combine_and_not",
    f"""WITH {FIRSTS}
SELECT doc_id, 104::BIGINT AS rule_id, 0::BIGINT AS from_off,
  greatest(c, least(coalesce(a, b), coalesce(b, a))) AS to_off
FROM firsts WHERE c IS NOT NULL AND coalesce(a, b) IS NOT NULL
UNION ALL SELECT doc_id, 105, 0, c FROM firsts WHERE c < coalesce(a, c + 1)
UNION ALL SELECT doc_id, 106, 0, n FROM firsts WHERE a IS NULL AND b IS NULL AND c IS NULL""",
)
oracle(
    "quiet",
    f"""WITH {DOCS}, {RUNS} SELECT doc_id, 103::BIGINT AS rule_id, 0::BIGINT AS from_off,
  unnest(range(from_off + 4, to_off + 1)) AS to_off FROM runs WHERE to_off - from_off >= 4""",
)
oracle(
    "record_events",
    f"""WITH {NUMBERS}, rec AS (
  SELECT doc_id, string_agg(to_off::VARCHAR, ',' ORDER BY to_off, rule_id, from_off) AS ends
  FROM ev GROUP BY doc_id)
SELECT doc_id, ends IS NOT NULL AS matched, coalesce(ends, '') AS ends
FROM documents LEFT JOIN rec USING (doc_id)""",
)
oracle(
    "limit_events_many",
    """WITH years AS (
  SELECT strftime(o_orderdate, '%Y') AS doc_id, (o_custkey % 7)::BIGINT AS rule_id,
    o_orderkey::BIGINT AS to_off FROM orders),
ranked AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n,
  row_number() OVER (PARTITION BY doc_id ORDER BY to_off, rule_id) AS rn FROM years)
SELECT doc_id, rule_id, to_off, n > 1500 AS truncated FROM ranked WHERE rn <= 1500""",
)
oracle(
    "record_segments",
    f"""WITH {RANKED}
SELECT doc_id, ((rn - 1) // 4)::BIGINT AS segment,
  string_agg(to_off::VARCHAR, ',' ORDER BY rn) AS ends
FROM ranked GROUP BY ALL""",
)
oracle(
    "handler_batches",
    f"""WITH {RANKED}, stops AS (
  SELECT doc_id, min(rn) AS stop FROM ranked WHERE rule_id = 2 GROUP BY doc_id)
SELECT doc_id, count(*)::BIGINT AS n_events, max(to_off)::BIGINT AS last_off
FROM ranked LEFT JOIN stops USING (doc_id) WHERE rn <= coalesce(stop, rn) GROUP BY doc_id""",
)
oracle(
    "handler",
    f"""WITH {NUMBERS}, gaps AS (SELECT doc_id, to_off - lag(to_off) OVER
  (PARTITION BY doc_id ORDER BY to_off, rule_id, from_off) AS gap FROM ev)
SELECT doc_id, count(*)::BIGINT AS n_events, (2 * coalesce(max(gap), 0))::BIGINT AS widest_gap
FROM gaps GROUP BY doc_id""",
)
oracle(
    "count_events",
    f"WITH {NUMBERS} SELECT rule_id, count(*)::BIGINT AS n_matches FROM ev GROUP BY rule_id",
)

# --------------------------------------------------------------------------
# streams

oracle(
    "chunk_text",
    """WITH raw AS (SELECT doc_id, encode(text) AS b, strlen(text) AS n FROM documents),
cuts AS (SELECT doc_id, b, unnest(range(0, n, 1000)) AS pos FROM raw),
parts AS (SELECT doc_id, pos // 1000 AS seq, greatest(0, pos - 16) AS start_off,
            array_slice(b, greatest(0, pos - 16) + 1, pos + 1000) AS chunk FROM cuts)
SELECT doc_id, seq, start_off, octet_length(chunk)::BIGINT AS n_bytes, md5(chunk) AS digest
FROM parts""",
)

TURNS = f"""turns AS (SELECT conv_id AS stream_id, turn, role, text, {bytes_of('text')} AS t
  FROM conversations)"""
WHOLE = f"""{TURNS}, whole AS (SELECT stream_id, string_agg(t, '' ORDER BY turn) AS t,
  string_agg(text, '' ORDER BY turn) AS text FROM turns GROUP BY stream_id)"""
ACROSS = leftmost("m", "[.][A-Z][a-z]", "whole", "stream_id")
STREAM_EVENT = "stream_id, 1::BIGINT AS rule_id, from_off, to_off"

oracle("stream_scan", f"WITH {WHOLE}, {ACROSS} SELECT {STREAM_EVENT} FROM m")
oracle("stream_live", ORACLES["q_stream_scan"])
oracle(
    "stream_scan_unbounded",
    f"""WITH {WHOLE}, {leftmost('m', '[.][A-Z]+[a-z]*,', 'whole', 'stream_id')}
SELECT {STREAM_EVENT} FROM m""",
)
oracle(
    "stream_documents",
    f"""WITH {DOCS}, {RUNS} SELECT doc_id, 1::BIGINT AS rule_id, to_off - 5 AS from_off, to_off
FROM (SELECT doc_id, unnest(range(from_off + 5, to_off + 1)) AS to_off FROM runs
      WHERE to_off - from_off >= 5)""",
)
oracle(
    "stream_close",
    f"""WITH {WHOLE} SELECT stream_id, 1::BIGINT AS rule_id,
  strlen(t) - strlen(regexp_extract(t, '[a-z][.]\\n?$')) AS from_off,
  strlen(t) - strlen(regexp_extract(t, '[a-z][.]\\n?$')) + 2 AS to_off
FROM whole WHERE regexp_matches(t, '[a-z][.]\\n?$')""",
)
oracle(
    "stream_reset",
    f"""WITH {TURNS}, marked AS (SELECT *, coalesce(sum((role = 'assistant')::INT) OVER (
    PARTITION BY stream_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    ::BIGINT AS epoch FROM turns),
whole AS (SELECT stream_id, epoch, string_agg(t, '' ORDER BY turn) AS t
          FROM marked GROUP BY stream_id, epoch),
{leftmost('m', '[.][A-Z][a-z]', 'whole', 'stream_id, epoch')}
SELECT stream_id, epoch, 1::BIGINT AS rule_id, from_off, to_off FROM m""",
)
oracle(
    "stream_fork",
    f"""WITH {TURNS}, prefix AS (
  SELECT b.stream_id * (SELECT max(turn) + 1 FROM turns) + b.turn AS branch_id, b.t AS again,
    string_agg(a.t, '' ORDER BY a.turn) AS head
  FROM turns a JOIN turns b ON a.stream_id = b.stream_id AND a.turn <= b.turn
  GROUP BY b.stream_id, b.turn, b.t),
whole AS (SELECT branch_id, head || again AS t FROM prefix),
{leftmost('m', '[.][A-Z][a-z]', 'whole', 'branch_id')}
SELECT branch_id, 1::BIGINT AS rule_id, from_off, to_off FROM m JOIN prefix USING (branch_id)
WHERE to_off > strlen(head)""",
)
oracle(
    "stream_state",
    f"""WITH {WHOLE}, n AS (SELECT stream_id, max(turn) + 1 AS next_seq FROM turns GROUP BY stream_id)
SELECT stream_id, hex(array_slice(encode(text), greatest(1, strlen(text) - 3), strlen(text))) AS tail,
  strlen(text)::BIGINT AS base, next_seq::BIGINT AS next_seq,
  (least(4, strlen(text)) + 16)::BIGINT AS state_bytes
FROM whole JOIN n USING (stream_id)""",
)
oracle(
    "stream_seed",
    f"""WITH {WHOLE}, {ACROSS}, first_turn AS (SELECT stream_id, strlen(t) AS n FROM turns WHERE turn = 0)
SELECT {STREAM_EVENT} FROM m JOIN first_turn USING (stream_id) WHERE to_off > n""",
)
oracle(
    "stream_match",
    f"""WITH {WHOLE} SELECT stream_id, regexp_matches(t, '[.][A-Z][a-z]') AS matched FROM whole""",
)
oracle(
    "stream_find",
    f"WITH {WHOLE}, {ACROSS} SELECT {STREAM_EVENT}, x AS text FROM m WHERE i <= 2",
)
oracle(
    "stream_find_prefix",
    f"""WITH {WHOLE}, {ACROSS} SELECT stream_id, 1::BIGINT AS rule_id, 0::BIGINT AS from_off, to_off,
  md5(array_slice(encode(text), 1, to_off)) AS digest
FROM m JOIN whole USING (stream_id) WHERE i = 1""",
)

# --------------------------------------------------------------------------
# applications


def _grep(table: str, key: str, column: str, regex: str, unit: str) -> str:
    """Lines of matches that hold no newline: line by line, with offsets."""
    return f"""WITH split AS (SELECT {key}, unnest(s) AS line, unnest(range(1, len(s) + 1)) AS n
  FROM (SELECT {key}, string_split({column}, chr(10)) AS s FROM {table})),
placed AS (SELECT {key}, n, line, {bytes_of('line')} AS t,
  coalesce(sum(strlen(line) + 1) OVER (PARTITION BY {key} ORDER BY n
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS line_off FROM split),
{leftmost('m', regex, 'placed', f'{key}, n')}
SELECT {key}, line_off + from_off AS from_off, line_off + to_off AS to_off, line_off, line
FROM m JOIN placed USING ({key}, n)"""


oracle("grep_lines", _grep("pages", "page_id", "html", "<title>[A-Z]", "page"))
oracle("grep_documents", _grep("documents", "doc_id", "text", "License", "doc"))
oracle(
    "grep_totals",
    """WITH n AS (SELECT strlen(html) AS b, len(string_split(html, 'href')) - 1 AS h FROM pages)
SELECT count(*)::BIGINT AS n_files, sum(b)::BIGINT AS n_bytes,
  count(*) FILTER (h > 0)::BIGINT AS files_matched, sum(h)::BIGINT AS n_matches FROM n""",
)

PACKETS = """packets AS (
  SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN 6 ELSE 17 END::BIGINT AS protocol,
    'u' || user_id AS src_addr, event_type AS dst_addr, (user_id % 65536)::BIGINT AS src_port,
    props AS payload
  FROM events
  WHERE event_id % 10 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0
    AND (event_id % 2 = 0 OR event_id % 5 <> 0) AND strlen(props) > 0),
flows AS (
  SELECT protocol, src_addr, dst_addr, src_port,
    row_number() OVER (ORDER BY min(seq)) - 1 AS stream_id
  FROM packets GROUP BY protocol, src_addr, dst_addr, src_port),
assigned AS (SELECT packets.*, stream_id FROM packets
  JOIN flows USING (protocol, src_addr, dst_addr, src_port)),
whole AS (SELECT stream_id, string_agg(payload, '' ORDER BY seq) AS t FROM assigned
  GROUP BY stream_id)"""


def _packet_events(source: str, key: str, t: str) -> str:
    one = leftmost("m1", '"k": 1', source, key, t)
    two = leftmost("m2", "[}][{]", source, key, t)
    return f"""{one}, {two}, found AS (
  SELECT {key}, 1::BIGINT AS rule_id, from_off, to_off FROM m1
  UNION ALL SELECT {key}, 2, from_off, to_off FROM m2
  UNION ALL SELECT {key}, 3, strlen({t}) - 2, strlen({t}) FROM {source}
    WHERE regexp_matches({t}, '[0-9][}}]$'))"""


oracle(
    "eligible_packets",
    f"WITH {PACKETS} SELECT seq, protocol, src_addr, dst_addr, src_port FROM packets",
)
oracle("assign_streams", f"WITH {PACKETS} SELECT seq, stream_id FROM assigned")
oracle(
    "payload_stats",
    f"""WITH {PACKETS}, s AS (SELECT count(*) AS n, count(DISTINCT stream_id) AS f,
  sum(strlen(payload)) AS b FROM assigned)
SELECT n::BIGINT AS n_packets, f::BIGINT AS n_streams, b::BIGINT AS n_bytes,
  (b // n)::BIGINT AS avg_packet_len, (b // f)::BIGINT AS avg_stream_len FROM s""",
)
oracle(
    "scan_packets_block",
    f"""WITH {PACKETS}, {_packet_events('packets', 'seq', 'payload')}
SELECT seq, rule_id, from_off, to_off FROM found""",
)
oracle(
    "scan_packets_stream",
    f"""WITH {PACKETS}, {_packet_events('whole', 'stream_id', 't')}
SELECT stream_id, rule_id, from_off, to_off FROM found""",
)
oracle(
    "match_rate",
    f"""WITH {PACKETS}, size AS (SELECT sum(strlen(payload))::BIGINT AS b FROM packets),
s AS (WITH {_packet_events('whole', 'stream_id', 't')} SELECT count(*) AS n FROM found),
p AS (WITH {_packet_events('packets', 'seq', 'payload')} SELECT count(*) AS n FROM found)
SELECT 'stream' AS mode, n::BIGINT AS n_matches, b AS n_bytes, n / (b / 1024.0::DOUBLE)
  AS matches_per_kb FROM s, size
UNION ALL SELECT 'block', n, b, n / (b / 1024.0::DOUBLE) FROM p, size""",
)

# --------------------------------------------------------------------------
# rule sets and flags

NEAR_CASELESS = windows().replace("regexp_extract_all(t,", "regexp_extract_all(lower(t),")
oracle(
    "edit_distance_flags",
    f"""WITH {DOCS}, {NEAR_CASELESS}, pairs AS (
  SELECT doc_id, p, p + n AS e FROM (SELECT doc_id, p, w, unnest([6, 7, 8]) AS n FROM places)
  WHERE strlen(w) >= n AND levenshtein(substr(w, 1, n), 'license') <= 1),
ends AS (SELECT doc_id, e, min(p) AS p FROM pairs WHERE e >= 200 GROUP BY doc_id, e)
SELECT doc_id, 1::BIGINT AS rule_id, min_by(p, e)::BIGINT AS from_off, min(e)::BIGINT AS to_off
FROM ends GROUP BY doc_id""",
)
oracle(
    "rule_set",
    f"""WITH {FIRSTS}, {RUNS}, {windows()}
SELECT doc_id, 104::BIGINT AS rule_id, 0::BIGINT AS from_off,
  greatest(c, least(coalesce(a, b), coalesce(b, a))) AS to_off
FROM firsts WHERE c IS NOT NULL AND coalesce(a, b) IS NOT NULL
UNION ALL SELECT doc_id, 105, 0, c FROM firsts WHERE c < coalesce(a, c + 1)
UNION ALL SELECT doc_id, 106, 0, n FROM firsts WHERE a IS NULL AND b IS NULL AND c IS NULL
UNION ALL SELECT doc_id, 103, 0, unnest(range(from_off + 4, to_off + 1)) FROM runs WHERE to_off - from_off >= 4
UNION ALL SELECT doc_id, 107, 0, p + 7 FROM places
WHERE strlen(w) >= 7 AND hamming(substr(w, 1, 7), 'License') <= 2""",
)
oracle(
    "flag_prefilter_mode",
    f"""WITH {DOCS}, {leftmost('m', 'License')} SELECT doc_id, 1::BIGINT AS rule_id, from_off, to_off FROM m""",
)
oracle(
    "flag_unicode_classes",
    """SELECT doc_id, len(m)::BIGINT AS n_matches FROM (
  SELECT doc_id, list_filter(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+'),
    lambda w: length(w) = 3 AND w[1] = 'é') AS m FROM documents) WHERE len(m) > 0""",
)
oracle(
    "stream_seed_single",
    f"""WITH {WHOLE}, {ACROSS}, first_turn AS (SELECT stream_id, strlen(t) AS n FROM turns WHERE turn = 0)
SELECT {STREAM_EVENT} FROM m JOIN first_turn USING (stream_id) WHERE i = 1 AND to_off > n""",
)
ORACLES["q_stream_scan_small_runs"] = ORACLES["q_stream_scan"]
WORDS = """words AS (
  SELECT min(item_id * widest + pos)::BIGINT AS rule_id, w FROM (
    SELECT item_id, max(len(s)) OVER () AS widest, unnest(s) AS w, unnest(range(0, len(s))) AS pos
    FROM (SELECT item_id, string_split_regex(text, '[^A-Za-z]+') AS s FROM benchmark))
  WHERE length(w) >= 5 GROUP BY w)"""
oracle(
    "stream_rule_table",
    f"""WITH {DOCS}, {WORDS}, {leftmost('m', '[0-9A-Za-z_]+')}
SELECT doc_id, rule_id, from_off, to_off + 1 AS to_off
FROM m JOIN words ON x = w JOIN docs USING (doc_id)
WHERE substr(t, to_off + 1, 1) IN (' ', ',', '.', chr(10))""",
)
oracle(
    "match_rules_caseless",
    f"""WITH {DOCS}, {WORDS}, {leftmost('m', '[0-9A-Za-z_]+')}, marked AS (
  SELECT doc_id, x FROM m JOIN docs USING (doc_id) WHERE substr(t, to_off + 1, 1) IN (' ', ',', '.', chr(10)))
SELECT DISTINCT doc_id, rule_id FROM marked, words
WHERE lower(x) = lower(w) AND (rule_id % 2 = 0 OR x = w OR x = upper(w))""",
)
oracle(
    "flag_allow_empty",
    f"""WITH urls AS (SELECT page_id, {bytes_of('url')} AS t FROM pages), ends AS (
  SELECT page_id, t, unnest(range(0, strlen(t) + 1)) AS to_off FROM urls)
SELECT page_id, 1::BIGINT AS rule_id, to_off - strlen(regexp_extract(left(t, to_off), '[a-z]*$')) AS from_off, to_off
FROM ends""",
)
