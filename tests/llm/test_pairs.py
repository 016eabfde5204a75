import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from patternscan.llm import fingerprint, jaccard
from patternscan.llm.components import connected_components
from patternscan.llm.frames import shared_folder


def shingle_set(text, width):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1)))


def plain_components(rows, width, percent):
    sets = [(k, shingle_set(t, width)) for k, t in rows if k is not None]
    parent = {k: k for k, _ in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {k: root(k) for k in parent}


def family(chance, words, size, edits):
    """A text and versions of it, each with a few words replaced."""
    base = chance.choices(words, k=size)
    out = [base]
    for _ in range(edits):
        text = list(chance.choice(out))
        for _ in range(chance.randint(0, max(1, size // 25))):
            text[chance.randrange(len(text))] = chance.choice(words)
        if chance.random() < 0.3:
            text = text[: max(1, size - chance.randint(0, size // 8))]
        out.append(text)
    return [" ".join(t) for t in out]


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (1, 70), (2, 100)])
def test_components_equal_all_pairs(spark, words, width, percent):
    chance = random.Random(width)
    texts = []
    for size in (1, 2, 3, 8, 10, 12, 20, 30, 60, 100, 200):
        for _ in range(3):
            texts += family(chance, words, size, 5)
    texts += ["", None, "  ", "A b C", "a B c", "a  b\tc"]
    chance.shuffle(texts)
    rows = list(enumerate(texts))
    params = jaccard.JaccardParams(width=width, percent=percent, block=4)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), params).collect()
    assert {r.doc_id: r.n_shingles for r in got} == {k: len(shingle_set(t, width)) for k, t in rows}
    assert {r.doc_id: r.component_id for r in got} == plain_components(rows, width, percent)


def test_chain_through_a_middle_document(spark):
    """The smallest member of a bucket may link with none of the others."""
    base = [f"w{i}" for i in range(100)]

    def changed(k):
        return " ".join([f"n{i}" for i in range(k)] + base[k:])

    rows = [(0, changed(0)), (9, changed(4)), (5, changed(8)), (7, changed(12))]
    got = jaccard.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), jaccard.JaccardParams(width=1, percent=90)
    )
    assert {r.doc_id: r.component_id for r in got.collect()} == plain_components(rows, 1, 90)


def test_a_slice_always_agrees(words):
    """Whatever two sets that link, they share a bucket (or are equal)."""
    chance = random.Random(8)
    for percent in (80, 90):
        p = jaccard.JaccardParams(width=1, percent=percent)
        for n in [*range(1, 60), 150, 400]:
            a = [f"x{i}" for i in range(n)]
            for extra in range(0, n // 3 + 1, max(1, n // 10)):
                for gone in range(0, n // 3 + 1, max(1, n // 10)):
                    b = a[gone:] + [f"y{i}" for i in range(extra)]
                    linked = 100 * (n - gone) >= percent * (n + extra)
                    if not linked or not b or (not gone and not extra):
                        continue
                    owner, shingle = jaccard.shingles([" ".join(a), " ".join(b)], 1)
                    text, sig = jaccard.slices(owner, shingle, np.bincount(owner), p)
                    assert set(sig[text == 0]) & set(sig[text == 1]), (percent, n, gone, extra)
    assert chance


def test_tree_finds_what_the_bound_allows():
    chance = np.random.default_rng(4)
    p = jaccard.JaccardParams(groups=8)
    counts = chance.poisson(3, (300, 8)) + chance.integers(0, 3, (300, 1))
    counts[100:150] = counts[:50] + chance.integers(0, 2, (50, 8))
    sizes = counts.sum(axis=1)
    tree = jaccard.CountTree(counts, sizes)
    for q in range(300):
        bound = np.minimum(counts, counts[q]).sum(axis=1)
        want = set(np.flatnonzero(190 * bound >= 90 * (sizes + sizes[q])))
        assert set(tree.search(counts[q], int(sizes[q]), p)) == want


def test_bits_show_no_more_than_differs(words):
    """Also between sets of different sizes, whose bits are folded."""
    chance = random.Random(2)
    p = jaccard.JaccardParams(width=1, percent=80)
    for n in (1, 7, 40, 130, 260, 520, 5000):
        rows = [[f"x{i}" for i in range(n)]]
        for changed in (1, n // 12, n // 5, n // 2, n):
            rows.append(rows[0][changed:] + [f"y{chance.random()}" for _ in range(chance.randint(0, 2 * changed))])
        owner, s = jaccard.shingles([" ".join(r) for r in rows], 1)
        bits = jaccard.odd_bits(owner, s, np.bincount(owner, minlength=len(rows)), p)
        pairs = np.array(list(itertools.combinations(range(len(rows)), 2)))
        shown = jaccard.least_differences(bits, pairs[:, 0], pairs[:, 1])
        for (a, b), d in zip(pairs.tolist(), shown.tolist()):
            differ = len(set(rows[a]) ^ set(rows[b]))
            assert d <= differ and d % 2 == differ % 2
            smaller, larger = sorted((len(rows[a]), len(rows[b])))
            most = p.most_difference(np.int64(smaller + larger))
            if differ > 1.5 * most and 40 <= smaller and 80 * larger <= 100 * smaller:
                assert d > most
    none = jaccard.least_differences([b"", bits[1], bits[2]], np.array([0, 1]), np.array([1, 2]))
    assert none[0] == 0 < none[1]


def test_versions_that_do_not_link_are_not_paired(spark, words, monkeypatch):
    """Versions of a text that share buckets but no link made a row for each pair."""
    base = [f"w{i}" for i in range(400)]
    chance, texts = random.Random(11), []
    for k in range(80):
        text = list(base)
        for i in chance.sample(range(0, 400, 5), 7):
            text[i] = f"n{k}x{i}"
        texts.append(" ".join(text))
    asked, verified = [], jaccard._verified

    def counted(pairs, texts, p):
        asked.append(pairs.count())
        return verified(pairs, texts, p)

    monkeypatch.setattr(jaccard, "_verified", counted)
    rows = list(enumerate(texts))
    got = jaccard.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), jaccard.JaccardParams(width=5, percent=80)
    )
    assert {r.doc_id: r.component_id for r in got.collect()} == plain_components(rows, 5, 80)
    assert sum(asked) < 80


def test_jaccard_of_awkward_rows(awkward, nothing):
    rows = jaccard.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in rows}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 3, 4), (5, 3, 4), (None, 3, None)} <= got
    assert jaccard.near_duplicates(nothing).collect() == []


def test_components(spark):
    chance = random.Random(6)
    pairs = [(chance.randrange(300), chance.randrange(300)) for _ in range(200)]
    pairs += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(40)] + [(5, 5), (7, None)]
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in connected_components(links, shared_folder(spark)).collect()}
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    assert got == {k: root(k) for k in parent}
    assert connected_components(links.limit(0), shared_folder(spark)).collect() == []


def bag_likeness(a, b, weight=lambda n: n):
    a, b = Counter(a.split()), Counter(b.split())
    a, b = ({w: weight(n) for w, n in x.items()} for x in (a, b))
    union = sum(max(a.get(w, 0), b.get(w, 0)) for w in a | b)
    return sum(min(a.get(w, 0), b.get(w, 0)) for w in a | b) / union if union else 1.0


def edited(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


@pytest.mark.parametrize("sql, weight", [("tf", lambda n: n), ("1 + ln(tf)", lambda n: 1 + math.log(n))])
def test_fingerprints_estimate_likeness(spark, words, sql, weight):
    chance = random.Random(9)
    rows = [(7 * i**3, " ".join(chance.choices(words[: 40 + i], k=300))) for i in range(60)]
    rows += [(5_000_000_000 + i, rows[0][1]) for i in range(3)]
    params = fingerprint.SketchParams(weight=sql)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprint.fingerprints(df, params).collect()}
    errors = []
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        new, r = edited(text, following), got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        errors += [
            r.near_edited - bag_likeness(text, new, weight),
            r.near_next - bag_likeness(text, following, weight),
        ]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07
    same = [got[rows[0][0]], *(got[5_000_000_000 + i] for i in range(3))]
    assert len({r.fingerprint for r in same}) == 1 and same[1].near_next == 1.0


def test_successors(spark):
    chance = random.Random(3)
    ids = [*range(50), *(chance.randrange(-(1 << 62), 1 << 62) for _ in range(200)), 4095, 4096, 8192, None, 7]
    got = {r.id: r.next_id for r in fingerprint.successors(spark.createDataFrame([(i,) for i in ids], "id long")).collect()}
    order = sorted({i for i in ids if i is not None})
    assert got == dict(zip(order, order[1:] + order[:1]))


def test_fingerprints_of_awkward_rows(awkward, nothing):
    got = fingerprint.fingerprints(awkward).collect()
    assert len(got) == awkward.count()
    rows = {r.doc_id: r for r in got}
    for doc_id in (1, 2, 3):
        assert rows[doc_id].fingerprint == ""
    assert rows[1].near_next == rows[1].near_edited == 1.0 and rows[3].near_next == 0.0
    assert rows[4].fingerprint == rows[5].fingerprint == rows[None].fingerprint != ""
    assert rows[4].near_next == 1.0 and rows[None].near_next == 0.0
    assert rows[7].n_chars == len("mail ann@example.com or ann@example.com 😀 café İstanbul")
    assert fingerprint.fingerprints(nothing).collect() == []


def test_rows_that_repeat_an_id_or_have_none_keep_their_own_fingerprint(spark):
    texts = [(0, "a b c d"), (0, "q r"), (None, "a b c d"), (None, "x y z"), (None, "x y z"), (9, "m n o p"), (9, "m n o p")]
    got = fingerprint.fingerprints(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == sorted((d or -1, len(t)) for d, t in texts)

    def new(doc_id, text):
        following = {0: "m n o p", 9: "q r"}.get(doc_id, "")
        return hashlib.sha256(edited(text, following).encode()).hexdigest()

    assert sorted((str(r.doc_id), r.edited_sha256) for r in got) == sorted((str(d), new(d, t)) for d, t in texts)
    assert all(r.near_next == 0.0 for r in got if r.doc_id is None)
    assert len({r.fingerprint for r in got}) == 4


def test_weights_decide_samples(spark):
    """Texts with the same words, unlike only in their counts, are as like as their counts."""
    rows = [(2 * i, " ".join([f"w{i}"] * 8 + [f"v{i}"] * 2)) for i in range(40)]
    rows += [(2 * i + 1, " ".join([f"w{i}"] * 2 + [f"v{i}"] * 8)) for i in range(40)]
    got = fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    near = [r.near_next for r in got.collect() if r.doc_id % 2 == 0]
    assert abs(np.mean(near) - 4 / 16) < 0.03


def test_copies_of_a_row_are_compared_once(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text)] * 30 + [(2, text + " end")] * 30 + [(2, text + " other")] * 2 + [(3, "far away from all")]
    most, verified = [], jaccard._verified

    def counted(pairs, texts, p):
        most.append(texts.groupBy("node").count().agg({"count": "max"}).first()[0])
        return verified(pairs, texts, p)

    monkeypatch.setattr(jaccard, "_verified", counted)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), jaccard.JaccardParams(width=3, percent=80))
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(1, 1)] * 30 + [(2, 1)] * 32 + [(3, 3)]
    assert max(most) == 2
