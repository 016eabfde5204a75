"""Occurrences by byte grams: against a search in each text, and how grams are made."""

from patternscan.operators.grams import gram_occurrences

WORDS = ["a", "aa", "abc", "abca", "bcabcab", "cabcabcabcabcabc", "abc" * 12, "abc" * 30]


def found(spark, max_index_rows):
    texts = [(1, "abc" * 40), (1, "abc" * 40), (2, "xxaaxx"), (3, ""), (4, None), (None, "caab")]
    rows = [(d, d, None if t is None else t.encode()) for d, t in texts]
    df = spark.createDataFrame(rows, "_c long, doc long, raw binary")
    literals = spark.createDataFrame([(i, w.encode()) for i, w in enumerate(WORDS)], "rule int, lit binary")
    want = sorted(
        (str(d), i, at)
        for d, t in texts
        for i, w in enumerate(WORDS)
        for at in range(len(t or ""))
        if t.startswith(w, at)
    )
    return gram_occurrences(df, literals, ["_c", "doc"], "raw", ["rule"], max_index_rows=max_index_rows), want


def test_occurrences_of_repeated_and_null_rows(spark):
    for limit in (1_000_000, 0):
        df, want = found(spark, limit)
        assert sorted((str(r["_c"]), r["rule"], r["_from"]) for r in df.collect()) == want


def test_grams_are_not_made_inside_a_lambda(spark):
    df, _ = found(spark, 1_000_000)
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
