"""The queries that SQL can express, for another engine."""

from __future__ import annotations

from patternscan.llm import licenses

ORACLES: dict[str, str] = {}

ORACLES["op4_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
    SELECT *,
        length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '[', ''), '<', '')) AS esc_text,
        length(role) + length(role) - length(replace(replace(replace(role, '\', ''), '[', ''), '<', '')) AS esc_role
    FROM turns
), sized AS (
    SELECT *, CASE
        WHEN role = 'user' THEN
            CASE WHEN contains(text, '[/INST]') THEN 14 + esc_text ELSE 13 + length(text) END
        WHEN role = 'assistant' THEN
            CASE WHEN contains(text, '</s>') THEN 10 + esc_text ELSE 9 + length(text) END
        WHEN contains(role, '[SAY]') OR contains(text, '[/ROLE]') THEN 19 + esc_role + esc_text
        ELSE 18 + length(role) + length(text) END AS chars
    FROM marked
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(chars))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLES["op6_jaccard_join"] = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), shingled AS (
    SELECT doc_id, CASE WHEN len(w) >= 3 THEN
        list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM split
), sets AS (
    SELECT doc_id, list_sort(s) AS s, len(s) AS n FROM shingled
), classes AS (
    SELECT min(doc_id) AS rep, s, n FROM sets WHERE n > 0 GROUP BY s, n
), items AS (
    SELECT rep, n, unnest(s) AS g FROM classes
), links AS (
    SELECT a.rep AS a, b.rep AS b
    FROM items a JOIN items b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.rep, b.rep
    HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))
), arcs AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT a AS node, a AS root FROM arcs
    UNION SELECT arcs.b, reach.root FROM reach JOIN arcs ON arcs.a = reach.node
), roots AS (
    SELECT node, min(root) AS root FROM reach GROUP BY node
)
SELECT sets.doc_id, sets.n::BIGINT AS n_shingles,
    coalesce(roots.root, classes.rep, sets.doc_id) AS component_id
FROM sets LEFT JOIN classes ON sets.s = classes.s AND sets.n = classes.n
    LEFT JOIN roots ON roots.node = classes.rep
"""

ORACLES["op9_topk_search"] = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.c, d.c)::BIGINT AS score
    FROM v q JOIN v d ON d.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 5
"""


ORACLES["op12_hard_negatives"] = """
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same, list_dot_product(a.c, d.c)::BIGINT AS score
    FROM v a JOIN v d ON d.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE same
), ranked AS (
    SELECT p.anchor_id, positive_id, positive_score, n.vec_id AS negative_id, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS r
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id
    WHERE place <= 5 AND NOT n.same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE r <= 3
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    """Rules as values.  Words have a space of their own on either side, so that
    a rule's match can begin where another one ends."""
    rules = ",\n".join(
        f"({k}, {_quoted(r.label)}, {r.priority}, {_quoted(r.keyword)}, {_quoted(' (?:' + r.pattern.replace(' ', '  ') + ') ')})"
        for k, r in enumerate(licenses.license_rules())
    )
    base = ", ".join(f"({_quoted(f' {p} '.replace(' ', '  ')[1:-1])}, {_quoted(label)})" for p, label in licenses.BASE)
    share = " ".join(f"WHEN {level} THEN {sure}" for level, sure in licenses.SHARE.items())
    return rf"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
    FROM documents
), norm AS (
    SELECT doc_id, len(w) AS n_words, ' ' || array_to_string(w, '  ') || ' ' AS t FROM split
), rules(rule, label, priority, keyword, pattern) AS (VALUES {rules}
), base(phrase, label) AS (VALUES {base}
), places AS (
    SELECT doc_id, label, string_split(t, phrase) AS g, phrase FROM norm JOIN base ON contains(t, phrase)
), base_gaps AS (
    SELECT doc_id, label, unnest(g[1:len(g) - 1]) AS gap, unnest(range(1, len(g))) AS i, phrase FROM places
), base_found AS (
    SELECT doc_id, label, sum(len(regexp_extract_all(gap, '[^ ]+')) + len(regexp_extract_all(phrase, '[^ ]+')))
        OVER (PARTITION BY doc_id, label ORDER BY i) - len(regexp_extract_all(phrase, '[^ ]+')) AS place
    FROM base_gaps
), based AS (
    SELECT doc_id, count(*) AS n_base, min(place)::BIGINT AS first_word, max(place)::BIGINT AS last_word,
        list(DISTINCT label) AS labels
    FROM base_found GROUP BY doc_id
), hits AS (
    SELECT doc_id, rule, label, priority, regexp_extract_all(t, pattern) AS m, string_split_regex(t, pattern) AS g
    FROM norm JOIN rules ON contains(t, ' ' || keyword || ' ') AND regexp_matches(t, pattern)
), gaps AS (
    SELECT doc_id, rule, label, priority, unnest(m) AS x, unnest(g[1:len(m)]) AS gap, unnest(range(1, len(m) + 1)) AS i
    FROM hits
), counted AS (
    SELECT *, len(regexp_extract_all(x, '[^ ]+')) AS xw, len(regexp_extract_all(gap, '[^ ]+')) AS gw FROM gaps
), found AS (
    SELECT doc_id, rule, label, priority, xw,
        sum(xw + gw) OVER (PARTITION BY doc_id, rule ORDER BY i) - xw AS a
    FROM counted
), kept AS (
    SELECT * FROM found d WHERE NOT EXISTS (
        SELECT 1 FROM found e WHERE e.doc_id = d.doc_id AND e.a <= d.a AND e.a + e.xw >= d.a + d.xw
            AND e.priority >= d.priority
            AND (e.xw > d.xw OR e.priority > d.priority OR e.rule < d.rule))
), summed AS (
    SELECT doc_id, list(DISTINCT label) AS labels, max(CASE priority {share} END) AS sure FROM kept GROUP BY doc_id
)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
    array_to_string(list_sort(coalesce(based.labels, [])), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(based.labels, []), coalesce(summed.labels, [])))), ',')
        AS labels,
    greatest(coalesce(sure, 0.0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score
FROM norm LEFT JOIN based USING (doc_id) LEFT JOIN summed USING (doc_id)
"""


ORACLES["op10_license_scan"] = _license_sql()
