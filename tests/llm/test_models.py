import numpy as np
import pytest

from patternscan.llm import language, quality
from patternscan.llm.frames import table

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_DIR, "documents", "doc_id").cache()


def test_language_of_held_out_rows(docs):
    found = language.identify(docs, language.fit_on_rest(docs))
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 150
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert np.mean([r.accepted for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 and abs(r.score + r.distance - 1) < 1e-9 for r in rows)


def test_language_is_not_learned_from_held_out_rows(docs):
    spoiled = docs.withColumn("lang", language.F.when(~language.held_out(), language.F.col("lang")).otherwise("xx"))
    a, b = language.fit_on_rest(docs), language.fit_on_rest(spoiled)
    assert a.languages == b.languages and np.array_equal(a.centroids, b.centroids)


def test_language_is_the_nearest_centroid(docs):
    model = language.fit_on_rest(docs)
    texts = [r.text for r in docs.limit(40).collect()]
    got = language.predict_texts(texts, model)
    for text, lang, score in zip(texts, got["lang_pred"], got["score"]):
        x = language.weigh(language.gram_counts([text], model.params.dims), model.idf)[0]
        cosine = [float(x @ c / np.linalg.norm(c)) for c in model.centroids]
        best = int(np.argmax(cosine))
        assert lang == model.languages[model.owner[best]] and score == pytest.approx(cosine[best], abs=1e-4)


def test_language_rejects_what_is_far(docs):
    model = language.fit_on_rest(docs)
    got = language.predict_texts(["ქართული ენა არის", "Zxqj wvkz qqq"], model)
    assert not got["accepted"].any()


def test_language_of_awkward_rows(awkward, nothing, docs):
    model = language.fit_on_rest(awkward)
    rows = {r.doc_id: r for r in language.identify(awkward, model).collect()}
    assert awkward.count() == language.identify(awkward, model).count()
    for doc_id in (1, 2, 3, 8):
        assert (rows[doc_id].lang_pred, rows[doc_id].score, rows[doc_id].accepted) == ("und", 0.0, False)
    assert not rows[None].held_out and rows[4].lang_pred in ("en", "de")
    kept = language.keep_identified(awkward, language.fit_on_rest(docs))
    assert kept.columns == awkward.columns
    blank = language.fit_on_rest(nothing)
    assert blank.languages == [] and language.identify(nothing, blank).collect() == []
    assert {r.lang_pred for r in language.identify(awkward, blank).collect()} == {"und"}


def test_quality_agrees_with_labels(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents", "doc_id")
    labels = table(spark, "/root/testdata/sf0.1", "labels")
    rows = quality.classify(docs, quality.fit(docs)).join(labels, "doc_id").collect()
    bad = [r.accepted for r in rows if r.quality == 0]
    good = [r.accepted for r in rows if r.quality == 1]
    assert np.mean(bad) < 0.05 and np.mean(good) > 0.98


def test_label_model_finds_accuracies():
    """Votes drawn from known accuracies give them back."""
    chance = np.random.default_rng(3)
    y = chance.random(30_000) < 0.8
    accuracy = np.array([0.95, 0.9, 0.85, 0.8, 0.9])
    right = chance.random((len(y), 5)) < accuracy
    cast = np.where(right == y[:, None], 1, -1) * (chance.random((len(y), 5)) < 0.8)
    patterns, where, counts = np.unique(cast, axis=0, return_inverse=True, return_counts=True)
    share, tables, q = quality.fit_labels(patterns, counts.astype(float), 200)
    got = (share * tables[:, 1, 2] + (1 - share) * tables[:, 0, 0]) / (
        share * (1 - tables[:, 1, 1]) + (1 - share) * (1 - tables[:, 0, 1])
    )
    assert share == pytest.approx(0.8, abs=0.03) and np.abs(got - accuracy).max() < 0.03
    assert np.mean((q[where.ravel()] > 0.5) == y) > 0.95


def test_features_do_not_depend_on_neighbours():
    texts = ["One two two. Three!", "", "### a|b", "ONE TWO"]
    together = quality.features(texts, 512)
    apart = np.concatenate([quality.features([t], 512) for t in texts])
    assert np.allclose(together, apart)
    assert np.array_equal(quality.votes(texts), np.concatenate([quality.votes([t]) for t in texts]))


def test_quality_of_awkward_rows(awkward, nothing):
    model = quality.fit(awkward)
    rows = quality.classify(awkward, model).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert 0 <= r.score <= 1
        if r.doc_id in (1, 2, 3):
            assert r.score == 0 and not r.accepted
    assert len({r.score for r in rows if r.doc_id in (4, 5, None)}) == 1
    assert quality.keep_good(awkward, model).columns == awkward.columns
    assert quality.classify(nothing, quality.fit(nothing)).collect() == []


def test_language_rejects_unlearned_latin_languages(docs):
    """Each language left out in turn is rejected, and the learned ones are not."""
    texts = docs.filter("lang is not null").select("text", "lang", language.held_out().alias("held")).collect()
    for left in ("de", "es", "fr"):
        model = language.fit_on_rest(docs.filter(language.F.col("lang") != left))
        taken = language.predict_texts([r.text for r in texts if r.lang == left], model)["accepted"]
        own = language.predict_texts([r.text for r in texts if r.lang != left and r.held], model)["accepted"]
        assert taken.mean() < 0.05 and own.mean() > 0.97
    found = language.predict_texts(
        [
            "La vita è bella e il sole splende sopra le montagne della nostra città, dove i bambini giocano.",
            "O tempo está muito bom hoje e as crianças brincam no jardim da escola com os seus amigos.",
            "Bugün hava çok güzel ve çocuklar bahçede arkadaşlarıyla birlikte oyun oynuyorlar.",
            "qwx zkvj plmnb qazwsx edcrfv tgbyhn ujmikol pzxcvb nmasdf ghjklq wertyu iopzxc",
        ],
        language.fit_on_rest(docs),
    )
    assert not found["accepted"].any()


def test_language_clusters_are_not_single_outliers():
    chance = np.random.default_rng(1)
    rows = np.abs(chance.normal(1, 0.2, (400, 64))).astype(np.float32)
    rows[:4] = np.eye(64, dtype=np.float32)[:4]
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    found = language.cluster(rows, 4, 12, 0.02)
    assert np.bincount((rows @ found.T).argmax(axis=1)).min() >= 8


def test_every_language_is_learned(spark):
    """More languages than have full samples, and more than have any."""
    rows = [(100 * i + j, f"{chr(0x4E00 + 50 * i) * 3}{chr(0x4E01 + 50 * i)} " * (2 + j), f"l{i:03d}") for i in range(70) for j in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df)
    assert model.languages == sorted({r[2] for r in rows})
    assert language.predict_texts([r[1] for r in rows], model)["lang_pred"].tolist() == [r[2] for r in rows]
    few = language.LanguageParams(fit_rows=32, languages=4, least_rows=16)
    with pytest.raises(ValueError, match="more than 8 languages"):
        language.fit(df, few)
