"""Cleans ``documents`` in stages and packs what is left.

Each stage gets what its predecessor kept and returns the same columns; the last
one returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patternscan.llm import jaccard, language, packing, pii, quality
from patternscan.llm.frames import keep_ids, saved, shared_folder, table

#: Near duplicates: five words, a similarity of 0.8.
NEAR = jaccard.JaccardParams(width=5, percent=80)
#: The key of surrogates; a real run takes its own.
PII_KEY = "patternscan"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted.

    The fit sees those that are not held out.  Null texts and texts without a
    letter go; a row without language is judged like any other, and repeated
    rows alike.
    """
    return language.keep_identified(docs, language.fit_on_rest(docs))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null and empty texts go; repeated rows are judged alike.
    """
    return quality.keep_good(docs, quality.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near duplicates.

    Texts without words and rows without id are in no group and stay; rows that
    repeat an id are one document and stay or go together.
    """
    groups = jaccard.near_duplicates(docs, NEAR)
    groups = saved(groups.select("doc_id", "component_id"), shared_folder(spark), "groups")
    return keep_ids(docs, "doc_id", groups.filter("component_id <> doc_id").select("doc_id").distinct(), others=True)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and ``n_chars`` to match.

    Null texts stay null and keep their ``n_chars``.
    """
    out = pii.replace_entities(docs, pii.PiiParams(key=PII_KEY))
    if "n_chars" in docs.columns:
        chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.coalesce(chars, "n_chars"))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    return packing.pack_documents(docs, packing.WordTokenizer.from_file(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("surrogates", surrogates),
    ("pack", pack),
]

#: Models, keyed surrogates and a tokenizer have no SQL; tests hold the stages
#: against plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
