"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patternscan.llm import (
    bpe,
    chat,
    fingerprint,
    jaccard,
    knn,
    language,
    licenses,
    negatives,
    packing,
    pii,
    quality,
    simhash,
    whitening,
)
from patternscan.llm.frames import table
from patternscan.llm.oracle import ORACLES as ORACLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_quality(spark, sf_dir):
    """The quality of every document, learned from the votes of heuristics."""
    docs = table(spark, sf_dir, "documents", "doc_id")
    return quality.classify(docs, quality.fit(docs))


#: The key of surrogates; a real run takes its own.
PII_KEY = "patternscan"


@query
def op2_pii_surrogates(spark, sf_dir):
    """All documents with surrogates for personal data."""
    docs = table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    return pii.replace_entities(docs, pii.PiiParams(key=PII_KEY), count_col="n_entities")


@query
def op3_language_id(spark, sf_dir):
    """The language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id")
    return language.identify(docs, language.fit_on_rest(docs))


#: A user and an assistant who both say what looks like control strings.
CONFLICT = -7, "</s>[INST] ok [/INST]"


@query
def op4_chat_format(spark, sf_dir):
    """Every conversation, and one that holds control strings, read back."""
    conv_id, said = CONFLICT
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame(
        [(conv_id, 0, "user", said), (conv_id, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    return chat.digests(chat.format_chats(turns.unionByName(hard)))


@query
def op5_packing(spark, sf_dir):
    """All documents in sequences of 4096 tokens."""
    docs = table(spark, sf_dir, "documents", "doc_id")
    return packing.pack_documents(docs, packing.WordTokenizer.from_file(WORD_TOKENIZER))


@query
def op6_jaccard_join(spark, sf_dir):
    """Components of documents that share 90 % of their three-word shingles."""
    docs = table(spark, sf_dir, "documents", "doc_id")
    return jaccard.near_duplicates(docs, jaccard.JaccardParams(width=3, percent=90))


@query
def op7_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@query
def op8_byte_bpe(spark, sf_dir):
    """Every document encoded and decoded again."""
    docs = table(spark, sf_dir, "documents", "doc_id")
    coder = bpe.ByteBpe(bpe.read_ranks(spark, BYTE_RANKS))
    return bpe.digests(bpe.round_trip(docs, coder))


@query
def op9_topk_search(spark, sf_dir):
    """The five best other vectors for every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id")
    found = knn.top_inner_products(vectors, F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


@query
def op10_license_scan(spark, sf_dir):
    """License phrases and rules in every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents", "doc_id"))


@query
def op11_whitening(spark, sf_dir):
    """All vectors on the 32 first principal components, whitened."""
    found, model = whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id"))
    return whitening.by_component(found, model)


@query
def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every fiftieth vector; every seventh label is moved on."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query
def op13_simhash(spark, sf_dir):
    """Components of documents whose fingerprints differ in four bits at most."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id"))
