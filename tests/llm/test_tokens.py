import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from patternscan.llm import bpe, packing, pieces

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PARTS = st.lists(
    st.sampled_from([*"abst'rvelmdAZ \n\t19é٣Ⅷ中!#\x1c\x85 ’İ́ß", "'s", "'re", "'ll", " '", "  "]) | st.characters(codec="utf-8"),
    max_size=30,
).map("".join)


@pytest.fixture(scope="module")
def ranks(spark):
    return bpe.read_ranks(spark, RANKS)


@pytest.fixture(scope="module")
def public(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder(ranks):
    return bpe.ByteBpe(ranks)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(PARTS, max_size=5))
def test_bpe_equals_public_encoder(texts, coder, public):
    got = coder.encode(texts)
    assert [g.tolist() for g in got] == [public.encode_ordinary(t) for t in texts]
    assert coder.decode(got) == [t.encode() for t in texts]


def test_bpe_of_long_pieces(coder, public):
    chance = random.Random(1)
    for text in ("a" * 20_000, "".join(chance.choice("abcé") for _ in range(20_000)), "=" * 5000):
        assert coder.encode([text])[0].tolist() == public.encode_ordinary(text)


def test_bpe_rejects_unknown_ids(coder):
    with pytest.raises(ValueError):
        coder.decode([np.array([60_000], np.uint32)])


def test_read_ranks_needs_all_bytes(spark, tmp_path):
    path = tmp_path / "some.tiktoken"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(spark, str(path))


def test_bpe_of_awkward_rows(awkward, nothing, coder, public):
    rows = bpe.round_trip(awkward, coder).collect()
    assert len(rows) == awkward.count()
    by_text = {r.doc_id: r.text or "" for r in awkward.select("doc_id", "text").collect()}
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == public.encode_ordinary(by_text[r.doc_id])
        assert bytes(r.decoded) == by_text[r.doc_id].encode()
    assert bpe.digests(bpe.round_trip(nothing, coder)).collect() == []


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(PARTS, max_size=5))
def test_words_equal_public_tokenizer(texts, tokenizers):
    own, public = tokenizers
    want = [public.encode(t, add_special_tokens=False).ids for t in texts]
    assert [g.tolist() for g in own.encode(texts)] == want


@pytest.fixture(scope="module")
def tokenizers():
    public = Tokenizer.from_file(WORDS)
    public.encode_special_tokens = True
    return packing.WordTokenizer.from_file(WORDS), public


def plain_first_fit(lengths, capacity):
    bins, out = [], [None] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        for j, used in enumerate(bins):
            if used + lengths[k] <= capacity:
                break
        else:
            bins.append(0)
            j = len(bins) - 1
        out[k] = (j, bins[j])
        bins[j] += lengths[k]
    return out


@given(st.lists(st.integers(1, 20), max_size=60))
def test_first_fit_decreasing(lengths):
    sequence, offset = packing.first_fit_decreasing(np.array(lengths, np.int64), 20)
    assert list(zip(sequence, offset)) == plain_first_fit(lengths, 20)


def check_packed(rows, texts, public, capacity, end_id):
    """Every id of every row lies in one piece, pieces lie gapless in sequences."""
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == parts[0].sequence_tokens <= capacity
    want = {}
    for doc_id, text in texts:
        ids = np.array(public.encode(text or "", add_special_tokens=False).ids + [end_id], "<u4")
        for start in range(0, len(ids), capacity):
            part = ids[start : start + capacity]
            want.setdefault(doc_id, []).append((start, len(part), zlib.crc32(part.tobytes()), len(ids)))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}


def test_packing_of_awkward_rows(awkward, nothing, tokenizers):
    own, public = tokenizers
    params = packing.PackingParams(capacity=64, group_pieces=200)
    rows = packing.pack_documents(awkward, own, params).collect()
    texts = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    check_packed(rows, texts, public, 64, 2)
    assert len({r.sequence_id >> 32 for r in rows}) > 1
    assert packing.pack_documents(nothing, own, params).collect() == []


def test_packing_keeps_ids(awkward, tokenizers):
    own, _ = tokenizers
    rows = packing.pack_documents(awkward, own, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


def test_packing_pads_little(spark, tokenizers, words):
    own, _ = tokenizers
    chance = random.Random(2)
    rows = [(i, " ".join(chance.choices(words, k=chance.randint(1, 300)))) for i in range(600)]
    packed = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), own)
    filled = [r[0] for r in packed.select("sequence_tokens", "sequence_id").distinct().collect()]
    assert sum(4096 - n for n in filled) < 4096 + 0.02 * sum(filled)


def test_pieces_of_equal_hash_keep_their_own_ids(monkeypatch):
    """A hash that collides everywhere changes nothing."""
    monkeypatch.setattr(pieces, "span_hashes", lambda prefix, first, end: np.zeros(len(first), np.uint64))
    text = "one two tow one abc acb bac one"
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    first = np.array([i for i in range(len(text)) if i == 0 or text[i - 1] == " "])
    end = np.array([len(w) for w in text.split()]) + first
    cache = pieces.PieceCache(limit=300)  # starts anew again and again
    for _ in range(3):
        ids, lengths = cache.ids(points, first, end, lambda new: [[ord(c) for c in x] for x in new])
        assert lengths.tolist() == [3] * 8 and bytes(ids.astype(np.uint8)).decode() == text.replace(" ", "")
