"""Whitening, hard negatives and SimHash against plain versions of them."""

import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from patternscan.llm import negatives, simhash, whitening
from patternscan.llm.frames import table
from patternscan.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def whole(vector, factor):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(factor * float(np.float32(x))) for x in vector]


def awkward_vectors():
    nan, inf = float("nan"), float("inf")
    rows = [(k, [((k * 37 + j * 11) % 17) / 8 - 1 for j in range(4)], k % 3) for k in range(40)]
    return rows + [
        rows[0], rows[1],  # repeated in full
        (100, None, 1), (101, [1.0, None, 0.0, 0.0], 1), (102, [nan, 0.0, 0.0, 0.0], 1), (103, [inf, 0.0, 0.0, 0.0], 0),
        (None, [0.5, 0.5, 0.5, 0.5], 1), (150, [0.5, 0.25], 2), (200, [0.0] * 4, 0), (250, [0.75, -0.5, 0.25, 1.0], None),
        (300, rows[3][1], 0), (350, [], 1),
    ]


# --- whitening


def plain_whitening(rows, factor=64, offset=1_000_000):
    x = [w for _, v, *_ in rows if (w := whole(v, factor)) is not None]
    width = max(map(len, x))
    x = np.array([[c + offset for c in row + [0] * (width - len(row))] for row in x], object)
    n, sums = len(x), x.sum(axis=0)
    far = n * x - sums
    a = far.astype(float) / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    return n, (far * far).sum(axis=1), a, values[::-1], vectors[:, ::-1].T


def check_whitening(spark, rows):
    df = spark.createDataFrame(rows, VECTORS)
    found, model = whitening.whiten(df)
    n, deviation, a, values, vectors = plain_whitening(rows)
    assert model.n == n and sorted(r.deviation for r in found.collect()) == sorted(map(int, deviation))
    k = len(model.values)
    rank = int((values > 1e-13 * values[0]).sum())  # the plain version squares, and keeps half of the digits
    assert k == min(32, rank)
    assert np.allclose(model.values, values[:k], rtol=1e-8, atol=1e-14 * values[0])
    assert np.isclose(model.total, values.sum(), rtol=1e-9)
    assert model.identity_error < 1e-8
    gap = np.abs(np.diff(np.r_[np.inf, values, -np.inf])) / values[0]
    for c in range(k):
        if min(gap[c], gap[c + 1]) > 1e-6:  # else any turn of the two is right
            assert abs(model.components[c] @ vectors[c]) > 1 - 1e-8, c
    white = {r.vec_id: r.whitened for r in found.collect()}
    want = a @ model.components.T / np.sqrt(model.values)
    ids = [r[0] for r in rows if whole(r[1], 64) is not None]
    for i, row in zip(ids, want):
        assert np.allclose(white[i], row, atol=1e-9)
    return found, model


def test_whitening_of_the_table(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "embeddings").collect()]
    check_whitening(spark, rows)
    got = QUERIES["op11_whitening"](spark, SF_DIR).collect()
    n, deviation, a, values, vectors = plain_whitening(rows)
    assert len(got) == 32 * n and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    by = {(r.vec_id, r.component): r for r in got}
    assert {c for _, c in by} == set(range(1, 33))
    for c in range(1, 33):
        mine = np.array([by[r[0], c].whitened for r in rows])
        want = a @ vectors[c - 1] / math.sqrt(values[c - 1])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-6
        assert math.isclose(by[rows[0][0], c].explained, values[c - 1] / values.sum(), rel_tol=1e-9)
    assert all(by[r[0], 1].deviation == d for r, d in zip(rows, deviation))


def test_whitening_of_badly_conditioned_and_dependent_dimensions(spark):
    chance = np.random.default_rng(3)
    x = chance.normal(size=(400, 6)) * [3000, 400, 30, 2, 0.5, 0.1]
    x = np.c_[x, x[:, 0], np.full(400, 7.0), x[:, 1] + x[:, 2]]  # two dependent columns and a constant
    check_whitening(spark, [(i, v, 0) for i, v in enumerate(x.tolist())])


def test_whitening_of_awkward_rows(spark):
    found, model = check_whitening(spark, [r for r in awkward_vectors() if r[0] is not None])
    df = spark.createDataFrame(awkward_vectors(), VECTORS).selectExpr("*", "'x' AS v", "'x' AS id", "'x' AS whitened")
    found, model = whitening.whiten(df)
    assert model.n == 48 and found.count() == 48  # rows without id too
    for rows in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 3, [(1, None, 0)], [(1, [], 0)]):
        found, model = whitening.whiten(spark.createDataFrame(rows, VECTORS))
        assert whitening.by_component(found, model).collect() == []


# --- hard negatives


def plain_negatives(rows, asks, positives=5, negatives=3):
    seen = {(i, l, tuple(w)) for i, v, l in rows if i is not None and l is not None and (w := whole(v, 256)) is not None}
    rows = sorted(seen, key=repr)
    out = []
    for i, label, v in rows:
        if not asks(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in rows if j != i]
        same = sorted((s, j) for s, j, m in scored if m == label)[:positives]
        for s, j in same:
            far = sorted((t, k) for t, k, m in scored if m != label and 50 * -s <= 100 * -t <= 95 * -s)[:negatives]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(far, 1)]
    return sorted(out)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("params", [negatives.MiningParams(), negatives.MiningParams(anchors=3, rows=16, planes=3)])
def test_negatives_equal_all_pairs(spark, params):
    chance = np.random.default_rng(2)
    middle = chance.normal(size=(4, 70))
    label = chance.integers(0, 4, 300)
    x = middle[label] * chance.uniform(0.3, 1, (300, 1)) + 0.7 * chance.normal(size=(300, 70)) + 0.4
    rows = [(i, v, int(l)) for i, (v, l) in enumerate(zip(x.tolist(), label))]
    rows += [(1000 + i, v, l) for i, v, l in rows[:30]]  # ties
    df = spark.createDataFrame(rows, VECTORS)
    got = negatives.mine(df, df["vec_id"] % 50 == 0, params).collect()
    want = plain_negatives(rows, lambda i: i % 50 == 0)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got) == want and want


def test_negatives_of_awkward_rows(spark):
    rows = awkward_vectors()
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS v", "'x' AS row", "'x' AS code", "'x' AS asks")
    got = negatives.mine(df, df["vec_id"] % 2 == 0).collect()
    want = plain_negatives(rows, lambda i: i % 2 == 0)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got) == want and want
    assert negatives.mine(spark.createDataFrame([], VECTORS), F.col("vec_id") >= 0).collect() == []


def test_intervals_hold():
    """Whatever the vectors, the inner product lies in its interval."""
    chance = np.random.default_rng(6)
    for width in (1, 5, 64, 100):
        turn = negatives.rotation(width, 1)
        assert np.allclose(turn @ turn.T, np.eye(width))
        x = np.r_[chance.integers(-500, 500, (200, width)), np.zeros((1, width), int), np.full((1, width), 3)]
        q = np.r_[chance.integers(-300, 300, (20, width)), x[:5], np.zeros((1, width), int)]
        for planes in (1, 4, 8):
            low, high = negatives.Asking(q, turn, planes).interval(*negatives.encode(x, turn))
            exact = q @ x.T
            assert (low <= exact).all() and (exact <= high).all()
    near = negatives.Asking(x[:1], turn, 8).interval(*negatives.encode(x[:1], turn))
    assert near[1][0, 0] - near[0][0, 0] < 2 * float(x[0] @ x[0])


# --- SimHash


def plain_fingerprint(text, width=4):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    spans = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), seed=42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(prints, radius=4):
    """Component of each key of ``prints`` (key: value), by all pairs."""
    keys, root = sorted(prints), {}
    for k in keys:
        root[k] = k
    find = lambda k: k if root[k] == k else find(root[k])
    for a in keys:
        for b in keys:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("params", [
    simhash.SimHashParams(), simhash.SimHashParams(bits=3, variants=3000, step=7, together=50), simhash.SimHashParams(radius=2),
    simhash.SimHashParams(bits=1, variants=1, step=21),
])
def test_balls_find_all_links(spark, params):
    chance = random.Random(9)
    values = {chance.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1, 1 << 63}
    for v in list(values)[:25]:
        for _ in range(5):  # chains and clusters
            for bit in chance.sample(range(64), chance.randint(1, 6)):
                v ^= 1 << bit
            values.add(v)
    signed = {v - (1 << 64) if v >> 63 else v: v for v in values}
    links = simhash.ball_links(spark.createDataFrame([(s,) for s in signed], "fp long"), params).collect()
    assert all((signed[a] ^ signed[b]).bit_count() <= params.radius for a, b in links)
    want = plain_classes({s: v for s, v in signed.items()}, params.radius)
    root = {s: s for s in signed}
    find = lambda k: k if root[k] == k else find(root[k])
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {s: find(s) for s in signed} == want


def test_simhash_query_equals_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    prints = {i: plain_fingerprint(t) for i, t in docs}
    got = {r.doc_id: r for r in QUERIES["op13_simhash"](spark, SF_DIR).collect()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in got.values())
    assert {i: r.component_id for i, r in got.items()} == plain_classes(prints)


def test_simhash_of_awkward_rows(awkward, nothing):
    got = simhash.near_duplicates(awkward).collect()
    texts = {r.doc_id: r.text for r in awkward.collect()}
    assert len(got) == awkward.count()
    assert all(int(r.fingerprint, 16) == plain_fingerprint(texts[r.doc_id]) for r in got)
    own = {(r.doc_id, r.component_id) for r in got}
    assert {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (None, None)} <= own
    assert simhash.near_duplicates(nothing).collect() == []
