"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed character n-grams, weighted by TF-IDF and scaled
to length one.  Each language has a few centroids (spherical k-means over its
own texts); the language of the nearest centroid by cosine is the prediction,
and a text too far from its nearest centroid is rejected.  How far that is, each
language's own texts, held apart from the centroids, and those of the other
languages decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patternscan.llm.frames import check_columns
from patternscan.llm.textops import char_table, chunks, code_points

UNKNOWN = "und"
RESULT = "lang_pred string, score double, distance double, accepted boolean"
_SAMPLE = 1 << 30


@dataclass(frozen=True)
class LanguageParams:
    """``fit_rows`` bounds the labelled rows per language that the fit uses.  Of
    more than ``languages`` languages each gives fewer, so that the driver holds
    ``fit_rows * languages`` rows at most, but ``least_rows`` at least: more
    languages than that leaves room for are an error.  Each worker gets
    languages x centroids x dims floats.  ``folds`` is in how many parts the rows
    of a language are held apart, ``tail`` the share of them below their low
    quantile, ``mixed`` the share of another language's rows above its high one
    (texts with passages of two languages), and a cluster of less than ``small``
    of the rows is none.
    ``reject_share`` is the least cosine if no language has two rows."""

    dims: int = 4096
    centroids: int = 4
    fit_rows: int = 400
    languages: int = 64
    rounds: int = 12
    reject_share: float = 0.3
    least_rows: int = 16
    folds: int = 4
    tail: float = 0.01
    mixed: float = 0.05
    small: float = 0.02


@dataclass(frozen=True)
class LanguageModel:
    params: LanguageParams
    languages: list[str]
    idf: np.ndarray  # of each dimension
    centroids: np.ndarray  # a row each, of length one
    owner: np.ndarray  # the language of each centroid
    nearest: np.ndarray  # each centroid's least cosine that is accepted


def gram_counts(texts: list[str], dims: int) -> np.ndarray:
    """Counts of hashed letter n-grams (one to three) of whole texts, a row each.

    Letters are folded to lower case, everything else counts as a space, and a
    text is taken as standing between spaces.
    """
    points, starts = code_points([" " + t + " " for t in texts])
    c = char_table("fold", points)[points].astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), np.diff(starts))
    out = np.zeros(len(texts) * dims, np.int64)
    shift = np.uint64(64 - (dims - 1).bit_length())
    h = np.zeros(len(c), np.uint64)
    blank = np.ones(len(c), bool)
    for n in (1, 2, 3):
        if len(c) < n:
            break
        h = (h[: len(c) - n + 1] + c[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        blank = blank[: len(c) - n + 1] & (c[n - 1 :] == 32)
        same = row[: len(c) - n + 1] == row[n - 1 :]
        keep = same & ~blank
        bucket = ((h[keep] * np.uint64(0xBF58476D1CE4E5B9)) >> shift).astype(np.int64)
        out += np.bincount(row[: len(keep)][keep] * dims + bucket, minlength=len(out))
    return out.reshape(len(texts), dims)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length one."""
    return _unit(np.log1p(counts.astype(np.float32)) * idf)


def _sampled(train: DataFrame, id_col: str, text_col: str, lang_col: str, p: LanguageParams) -> DataFrame:
    """A bounded part of the labelled rows, chosen by a hash of the id: the
    counts read no text, and only chosen texts are used."""
    labelled = train.select(
        F.col(id_col).cast("string").alias("_id"),
        F.col(lang_col).cast("string").alias("_lang"),
        F.col(text_col).cast("string").alias("_text"),
    ).filter("_id is not null and _lang is not null and _text is not null")
    most = p.fit_rows * p.languages // p.least_rows
    sizes = labelled.groupBy("_lang").count().limit(most + 1).collect()
    if len(sizes) > most:
        raise ValueError(f"more than {most} languages in {lang_col}: each needs {p.least_rows} rows of the sample")
    rows = min(p.fit_rows, p.fit_rows * p.languages // max(1, len(sizes)))
    shares = train.sparkSession.createDataFrame(
        [(lang, min(_SAMPLE, _SAMPLE * rows // size)) for lang, size in sizes], "_lang string, _share long"
    )
    chosen = labelled.join(F.broadcast(shares), "_lang").filter(F.pmod(F.xxhash64("_id"), F.lit(_SAMPLE)) < F.col("_share"))
    return chosen.drop("_share").dropDuplicates(["_id"])


def fit(
    train: DataFrame,
    params: LanguageParams = LanguageParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel:
    """Learn centroids from a bounded sample of the labelled rows.

    Rows without id, text or language are not learned from; of rows with one
    id only one is.  Every language is learned.  Without any row the model knows no language and rejects
    every text.  The sample is chosen by a hash of the id, so the same rows
    give the same model.
    """
    check_columns(train, id_col, text_col, lang_col)
    p = params

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["_text"].tolist()
            for part in chunks(texts):
                counts = gram_counts([texts[i] for i in part], p.dims)
                tf = np.log1p(counts.astype(np.float32)).astype(np.float16)
                rows = batch.iloc[part.start : part.stop]
                yield pd.DataFrame(
                    {"_id": rows["_id"], "_lang": rows["_lang"], "_v": [v.tobytes() for v in tf]}
                )

    sample = _sampled(train, id_col, text_col, lang_col, p)
    rows = sorted(sample.mapInPandas(vectors, "_id string, _lang string, _v binary").collect())
    languages = sorted({r._lang for r in rows})
    if not rows:
        return LanguageModel(p, [], np.ones(p.dims, np.float32), np.zeros((0, p.dims), np.float32), np.zeros(0, int), np.zeros(0))
    tf = np.stack([np.frombuffer(r._v, np.float16) for r in rows])
    label = np.array([languages.index(r._lang) for r in rows])
    del rows
    groups = [np.flatnonzero(label == k) for k in range(len(languages))]
    idf = np.log((1 + len(tf)) / (1 + sum((tf[g] > 0).sum(axis=0) for g in groups))).astype(np.float32) + 1
    centroids, owner, apart = [], [], []
    for k, g in enumerate(groups):
        own = _unit(tf[g].astype(np.float32) * idf)
        found = cluster(own, p.centroids, p.rounds, p.small)
        centroids.extend(found)
        owner.extend([k] * len(found))
        apart.append(held_apart(own, p))
    found, owner = np.array(centroids, np.float32), np.array(owner)
    high = np.zeros((len(languages), len(languages)))  # how near the rows of one come to the centroids of another
    first = np.searchsorted(owner, range(len(languages)))
    for k, g in enumerate(groups):
        near = np.maximum.reduceat(_unit(tf[g].astype(np.float32) * idf) @ found.T, first, axis=1)
        high[k] = np.quantile(near, 1 - p.mixed, axis=0)
    np.fill_diagonal(high, -1)
    return LanguageModel(p, languages, idf, found, owner, _limits(apart, high.max(axis=0), p)[owner])


def held_apart(rows: np.ndarray, p: LanguageParams) -> np.ndarray:
    """The cosine of each row with the nearest centroid of the other parts."""
    part = np.arange(len(rows)) % p.folds
    out = [
        (rows[part == f] @ cluster(rows[part != f], p.centroids, p.rounds, p.small).T).max(axis=1)
        for f in range(min(p.folds, len(rows)))
        if (part != f).any()
    ]
    return np.concatenate(out) if out else np.zeros(0, rows.dtype)


def _limits(apart: list[np.ndarray], others: np.ndarray, p: LanguageParams) -> np.ndarray:
    """The least cosine that each language accepts.

    Midway between the low quantile of its rows held apart and the high one of
    the language that comes nearest, but never above the former.  Languages of a
    few rows take the low quantile of all the others' rows.
    """
    known = [a for a in apart if len(a) >= p.least_rows] or apart
    pooled = np.concatenate(known)
    all_low = float(np.quantile(pooled, p.tail)) if len(pooled) else p.reject_share
    low = np.array([float(np.quantile(a, p.tail)) if len(a) >= p.least_rows else all_low for a in apart])
    # one language alone: what is unlike it shows nowhere, a cosine of zero included
    return np.where(others < 0, low, np.minimum(low, (low + others) / 2))


def cluster(rows: np.ndarray, k: int, rounds: int, small: float = 0.0) -> np.ndarray:
    """Spherical k-means: rows are drawn as seeds with a chance that grows with
    their distance from those drawn before, by fixed random numbers, so that a
    few far rows do not take all of them; ties go to the first.  Then clusters of
    less than ``small`` of the rows are dissolved, the smallest first."""
    chance = np.random.default_rng(len(rows))
    seeds = [int((rows @ rows.mean(axis=0)).argmax())]
    while len(seeds) < min(k, len(rows)):
        far = np.clip(1 - (rows @ rows[seeds].T).max(axis=1).astype(float), 0, None)
        far[far < 1e-6] = 0
        if not far.any():
            break
        seeds.append(min(int(np.searchsorted(np.cumsum(far), chance.random() * far.sum(), side="right")), len(rows) - 1))
    centroids = rows[sorted(set(seeds))]
    while True:
        for _ in range(rounds):
            home = (rows @ centroids.T).argmax(axis=1)
            moved = [rows[home == j].sum(axis=0) if (home == j).any() else centroids[j] for j in range(len(centroids))]
            centroids = _unit(np.array(moved, rows.dtype))
        sizes = np.bincount((rows @ centroids.T).argmax(axis=1), minlength=len(centroids))
        if len(centroids) == 1 or sizes.min() >= small * len(rows):
            return centroids
        centroids = np.delete(centroids, sizes.argmin(), axis=0)


def predict_texts(texts: list[str | None], model: LanguageModel) -> pd.DataFrame:
    """What :func:`language_of` returns, for texts in memory."""
    lang = np.full(len(texts), UNKNOWN, object)
    score, accepted = np.zeros(len(texts)), np.zeros(len(texts), bool)
    whole = ["" if t is None else t for t in texts]
    for part in chunks(whole):
        at = np.arange(part.start, part.stop)
        counts = gram_counts([whole[i] for i in part], model.params.dims)
        at, counts = at[counts.any(axis=1)], counts[counts.any(axis=1)]
        if not len(at) or not len(model.owner):
            continue
        cosine = weigh(counts, model.idf) @ model.centroids.T
        best = cosine.argmax(axis=1)
        top = np.clip(cosine[np.arange(len(at)), best].astype(float), 0, 1)
        lang[at] = np.array(model.languages, object)[model.owner[best]]
        score[at] = top
        accepted[at] = top >= model.nearest[best]
    return pd.DataFrame({"lang_pred": lang, "score": score, "distance": 1 - score, "accepted": accepted})


def language_of(df: DataFrame, model: LanguageModel, text_col: str = "text") -> Column:
    """A struct column ``lang_pred, score, distance, accepted`` for a text column.

    ``lang_pred`` is a learned language, or ``und`` for a null text, a text
    without a letter, or a model without languages; those have score 0 and are
    rejected.  ``score`` is the cosine with the nearest centroid, ``distance``
    one less it, and ``accepted`` whether that is near enough.
    """
    check_columns(df, text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield predict_texts(texts.tolist(), shared.value)

    return predict(F.col(text_col).cast("string"))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that a fit must not see: a fifth, by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit_on_rest(docs: DataFrame, params: LanguageParams = LanguageParams()) -> LanguageModel:
    """Fit on the rows of ``documents`` that are not held out."""
    return fit(docs.filter(~held_out()), params)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, distance, accepted`` for each row."""
    check_columns(docs, "doc_id", "text")
    found = docs.select("doc_id", held_out().alias("held_out"), language_of(docs, model).alias("_p"))
    return found.select("doc_id", "held_out", "_p.lang_pred", "_p.score", "_p.distance", "_p.accepted")


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows whose language is accepted, with the columns they came with."""
    found = docs.withColumn("_llm_language", language_of(docs, model))
    return found.filter("_llm_language.accepted").drop("_llm_language")
