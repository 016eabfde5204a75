"""A quality classifier learned without labels.

Several overlapping heuristics each call a text good or bad, or abstain.  How
often each is right is estimated by expectation-maximisation over the counts of
all vote patterns of the corpus; the posterior of a text's pattern is a soft
label.  A linear scorer over hashed features of the text is trained on the soft
labels of a bounded sample and scores every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patternscan.llm.frames import check_columns
from patternscan.llm.textops import char_table, chunks, code_points, mix, prefix_hashes, span_hashes, words

RESULT = "score double, posterior double, bad_votes int, good_votes int, accepted boolean"
_SAMPLE = 1 << 30
_SYMBOLS = np.array([ord(c) for c in "#$%&*~^=<>{}[]\\|_@"], np.uint32)


@dataclass(frozen=True)
class QualityParams:
    """``fit_rows`` bounds the sample whose features the driver holds."""

    dims: int = 2048
    fit_rows: int = 4000
    rounds: int = 60
    steps: int = 300
    rate: float = 0.05
    decay: float = 1e-4
    accept: float = 0.35


@dataclass(frozen=True)
class QualityModel:
    params: QualityParams
    good: float  # share of good texts
    tables: np.ndarray  # labeller x class (bad, good) x vote (-1, 0, 1)
    accuracy: np.ndarray  # of each labeller where it votes
    weights: np.ndarray
    bias: float


class TextFacts:
    """Counts of each text of a chunk, and its words."""

    def __init__(self, texts: list[str]):
        points, starts = code_points(texts)
        shape = char_table("shape", points)[points]
        self.rows = len(texts)

        def per_text(mask: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(mask)])
            return np.diff(total[starts])

        self.chars = np.diff(starts)
        self.upper, self.letters = per_text(shape == 1), per_text((shape == 1) | (shape == 2))
        self.digits = per_text(shape == 3)
        self.symbols = per_text(np.isin(points, _SYMBOLS))
        self.pipes = per_text(points == ord("|"))
        self.shouts = per_text(points == ord("!"))
        self.stops = per_text((points == ord(".")) | (points == ord("?")))
        first, end, self.text = words(points, starts, shape != 4)
        h = span_hashes(prefix_hashes(points), first, end)
        self.words = np.bincount(self.text, minlength=self.rows)
        same_text = np.concatenate([[False], self.text[1:] == self.text[:-1]]) if len(h) else np.zeros(0, bool)
        again = same_text.copy()
        again[1:] &= h[1:] == h[:-1]
        self.adjacent = np.bincount(self.text[again], minlength=self.rows)
        order = np.lexsort((h, self.text))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (self.text[order][1:] != self.text[order][:-1])
        self.distinct = np.bincount(self.text[order][new], minlength=self.rows)
        tail = points[end - 1] if len(end) else points[:0]
        symbol_tail = np.isin(tail, _SYMBOLS) & (end - first > 1)
        self.tailed = np.bincount(self.text[symbol_tail], minlength=self.rows)
        length = end - first
        capital = np.concatenate([[0], np.cumsum(shape == 1)])
        small = np.concatenate([[0], np.cumsum(shape == 2)])
        named = (capital[end] - capital[first]) + (small[end] - small[first])
        self.short = np.bincount(self.text[(named > 0) & (named <= 3)], minlength=self.rows)
        self.named = np.bincount(self.text[named > 0], minlength=self.rows)
        self.lone = np.bincount(self.text[np.isin(tail, _SYMBOLS) & (length == 1)], minlength=self.rows)
        shouted = (capital[end] - capital[first] > 0) & (small[end] == small[first])
        self.shouted = np.bincount(self.text[shouted], minlength=self.rows)
        odd = np.where(tail < 128, tail, 0) * (np.where(len(tail), shape[np.maximum(end - 1, 0)], 0) == 0)
        self.token = mix(
            odd.astype(np.uint64) * np.uint64(64)
            + np.minimum(length, 15).astype(np.uint64) * np.uint64(4)
            + shouted.astype(np.uint64) * np.uint64(2)
            + again.astype(np.uint64)
        )
        self.hash = h


def _vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, -1, np.where(good, 1, 0)).astype(np.int8)


def _labellers(f: TextFacts) -> dict[str, np.ndarray]:
    n, chars, letters = np.maximum(f.words, 1), np.maximum(f.chars, 1), np.maximum(f.letters, 1)
    some, many = f.words >= 8, f.words >= 40
    return {
        "symbols": _vote(f.symbols / n > 0.3, f.symbols / n < 0.03),
        "symbol_tails": _vote(f.tailed / n > 0.3, f.tailed / n < 0.03),
        "plain": _vote(f.letters / chars < 0.6, f.letters / chars > 0.68),
        "capitals": _vote(some & (f.upper / letters > 0.5), f.upper / letters < 0.4),
        "shouted": _vote(some & (f.shouted / n > 0.5), f.shouted / n < 0.4),
        "exclaimed": _vote(f.shouts / n > 0.3, f.shouts / n < 0.1),
        "columns": _vote(f.pipes / n > 0.15, f.pipes == 0),
        "stops": _vote(many & (f.stops / n < 0.005), ~many | (f.stops / n > 0.01)),
        "echo": _vote(some & (f.adjacent / n > 0.3), f.adjacent / n < 0.2),
        "variety": _vote(many & (f.distinct / n < 0.2), ~many | (f.distinct / n > 0.3)),
        "function_words": _vote(many & (f.short < 0.08 * f.named), ~many | (f.short > 0.15 * f.named)),
        "lone_signs": _vote(f.lone / n > 0.15, f.lone / n < 0.05),
    }


LABELLERS = tuple(_labellers(TextFacts([""])))


def votes(texts: list[str]) -> np.ndarray:
    """Votes (-1 bad, 0 none, 1 good), a row for each text."""
    return np.stack(list(_labellers(TextFacts(texts)).values()), axis=1)


def features(texts: list[str], dims: int) -> np.ndarray:
    """Hashed features of whole texts, a row each of length one.

    Words by their shape (length, last sign, capitals, repeated) and by what
    they are; a text's variety and echo as steps of ten.
    """
    f = TextFacts(texts)
    out = np.zeros(f.rows * dims, np.float32)
    for salt, token in ((1, f.token), (2, f.hash)):
        bucket = (mix(token + np.uint64(salt)) % np.uint64(dims)).astype(np.int64)
        counts = np.bincount(f.text * dims + bucket, minlength=len(out)).astype(np.float32)
        per_word = counts.reshape(f.rows, dims) / np.maximum(f.words, 1)[:, None]
        out += np.sqrt(per_word).ravel() * (1.0 if salt == 1 else 0.3)
    out = out.reshape(f.rows, dims)
    n = np.maximum(f.words, 1)
    for salt, share in ((3, f.distinct / n), (4, f.adjacent / n), (5, f.pipes / n), (6, f.symbols / n), (7, f.shouted / n)):
        step = np.minimum(10 * share, 10).astype(np.uint64)
        bucket = (mix(step + np.uint64(1000 * salt)) % np.uint64(dims)).astype(np.int64)
        out[np.arange(f.rows), bucket] += 0.5
    return out


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int) -> tuple[float, np.ndarray, np.ndarray]:
    """The share of good texts, each labeller's table, and the posterior of good
    for each vote pattern, by expectation-maximisation over counted patterns.

    It begins from the balance of votes; tables are smoothed by one vote each.
    """
    bad, good = (patterns < 0).sum(axis=1), (patterns > 0).sum(axis=1)
    q = 1 / (1 + np.exp(np.clip(3.0 * bad - 0.6 * good, -30, 30)))
    share, tables = 0.5, np.zeros((patterns.shape[1], 2, 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - q), counts * q])
        share = float((weight[1].sum() + 1) / (counts.sum() + 2))
        for j in range(patterns.shape[1]):
            for v in (-1, 0, 1):
                tables[j, :, v + 1] = weight[:, patterns[:, j] == v].sum(axis=1) + 1
        tables /= tables.sum(axis=2, keepdims=True)
        q, before = posterior(patterns, share, tables), q
        if np.abs(q - before).max(initial=0) < 1e-6:
            break
    return share, tables, q


def posterior(patterns: np.ndarray, share: float, tables: np.ndarray) -> np.ndarray:
    """The probability of good for each row of votes."""
    at = patterns.astype(int) + 1
    log = np.log(tables)
    odds = np.log(share / (1 - share)) + sum(
        log[j, 1, at[:, j]] - log[j, 0, at[:, j]] for j in range(patterns.shape[1])
    )
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit_scorer(x: np.ndarray, q: np.ndarray, p: QualityParams) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels; both classes weigh the same."""
    weight = np.where(q > 0.5, 0.5 / max((q > 0.5).sum(), 1), 0.5 / max((q <= 0.5).sum(), 1))
    w, b = np.zeros(x.shape[1]), 0.0
    m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for step in range(1, p.steps + 1):
        error = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - q) * weight
        g = np.append(x.T @ error + p.decay * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = p.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def _texts(column: pd.Series) -> list[str]:
    return ["" if t is None else t for t in column]


_PLACES = 3 ** np.arange(len(LABELLERS), dtype=np.int64)


def fit(
    docs: DataFrame,
    params: QualityParams = QualityParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> QualityModel:
    """Learn from all texts how far labellers can be trusted, and the scorer from
    a sample chosen by a hash of the id.

    The driver gets a row for each vote pattern that occurs (at most three to the
    power of the labellers, and in fact some dozens) and the sample.  Null texts
    count as empty ones.  Without rows every text scores one half.
    """
    check_columns(docs, id_col, text_col)
    p = params
    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).cast("string").alias("_text"))

    @F.pandas_udf("long")
    def pattern(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in parts:
            texts = _texts(column)
            found = [votes([texts[i] for i in part]) for part in chunks(texts)]
            yield pd.Series((np.concatenate(found).astype(np.int64) + 1) @ _PLACES if found else [], dtype="int64")

    counted = rows.select(pattern("_text").alias("p")).groupBy("p").count().orderBy("p").collect()
    if not counted:
        empty = np.full((len(LABELLERS), 2, 3), 1 / 3)
        return QualityModel(p, 0.5, empty, np.full(len(LABELLERS), 0.5), np.zeros(p.dims), 0.0)
    patterns = np.array([r.p for r in counted])[:, None] // _PLACES % 3 - 1
    counts = np.array([r["count"] for r in counted], float)
    share, tables, _ = fit_labels(patterns, counts, p.rounds)
    right = share * tables[:, 1, 2] + (1 - share) * tables[:, 0, 0]
    voted = share * (1 - tables[:, 1, 1]) + (1 - share) * (1 - tables[:, 0, 1])

    @F.pandas_udf("q double, x binary")
    def measured(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in parts:
            texts, q, x = _texts(column), [], []
            for part in chunks(texts):
                own = [texts[i] for i in part]
                q += posterior(votes(own), share, tables).tolist()
                x += [row.tobytes() for row in features(own, p.dims).astype(np.float16)]
            yield pd.DataFrame({"q": q, "x": x})

    part = min(_SAMPLE, int(_SAMPLE * p.fit_rows / counts.sum()))
    chosen = rows.filter("_id is not null").filter(F.pmod(F.xxhash64("_id"), F.lit(_SAMPLE)) < part).dropDuplicates(["_id"])
    sample = sorted(chosen.select("_id", measured("_text").alias("m")).select("_id", "m.*").collect())
    x = np.array([np.frombuffer(r.x, np.float16) for r in sample], np.float32).reshape(len(sample), p.dims)
    w, b = fit_scorer(x, np.array([r.q for r in sample]), p)
    return QualityModel(p, share, tables, right / voted, w, b)


def score_texts(texts: list[str], model: QualityModel) -> pd.DataFrame:
    """What :func:`quality_of` returns, for texts in memory."""
    found = []
    for part in chunks(texts):
        own = [texts[i] for i in part]
        cast = votes(own)
        s = 1 / (1 + np.exp(-np.clip(features(own, model.params.dims) @ model.weights + model.bias, -30, 30)))
        s[[not t.strip() for t in own]] = 0.0
        found.append(
            pd.DataFrame(
                {
                    "score": s.astype(float),
                    "posterior": posterior(cast, model.good, model.tables),
                    "bad_votes": (cast < 0).sum(axis=1),
                    "good_votes": (cast > 0).sum(axis=1),
                    "accepted": s >= model.params.accept,
                }
            )
        )
    if not found:
        return pd.DataFrame({"score": [], "posterior": [], "bad_votes": [], "good_votes": [], "accepted": []})
    return pd.concat(found, ignore_index=True)


def quality_of(df: DataFrame, model: QualityModel, text_col: str = "text") -> Column:
    """A struct column ``score, posterior, bad_votes, good_votes, accepted``.

    ``score`` is the scorer's (0 to 1, high is good), ``posterior`` the label
    model's for the text's votes.  A null text, an empty one and one of white
    space score 0 and are not accepted.
    """
    check_columns(df, text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in parts:
            yield score_texts(_texts(column), shared.value)

    return score(F.col(text_col).cast("string"))


def classify(docs: DataFrame, model: QualityModel, id_col: str = "doc_id") -> DataFrame:
    """``<id>, score, posterior, bad_votes, good_votes, accepted`` for each row."""
    check_columns(docs, id_col, "text")
    return docs.select(id_col, quality_of(docs, model).alias("_q")).select(id_col, "_q.*")


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows that are accepted, with the columns they came with."""
    found = docs.withColumn("_llm_quality", quality_of(docs, model))
    return found.filter("_llm_quality.accepted").drop("_llm_quality")
