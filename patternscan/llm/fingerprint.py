"""Document fingerprints by consistent weighted sampling.

A text is a bag of words, weighted by their counts.  For a word of weight w and
each round, a hash of word and round gives r and c from a gamma distribution of
shape two and b from a uniform one; ``t = floor(ln w / r + b)`` and
``ln a = ln c - r (t - b + 1)``.  The word with the least a is the sample, and two
bags have the same sample (word and t) with the probability of their generalised
Jaccard similarity ``sum min(w, w') / sum max(w, w')``.  A round deals the words
into a few bins by hash and samples each; with more bins a word is drawn less
often for as many samples, and short texts, whose bins hold few words, are
estimated worse.  A fingerprint holds 16 bits of each sample's least a, which word
and t decide; likeness is the share of equal samples.

Everything is DataFrame functions.  After texts are dealt by row, words are
counted, sampled and gathered in place, without another shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patternscan.llm.frames import check_columns, saved, shared_folder

_FINE = 12  # bits of an id that one window orders: 4096 ids at most
_PART = 8  # rounds that one row draws
_KEY = ("id", "_h1", "_h2")  # a text of an id, by two hashes; no part is null


@dataclass(frozen=True)
class SketchParams:
    """``rounds``: independent draws from a text, a multiple of eight; ``bins``: a
    power of two, into which a round deals the words to sample each (the standard
    error of a likeness p is ``sqrt(p (1 - p) / (rounds * bins))`` if all are
    filled); ``weight``: SQL for the weight of a word that occurs ``tf`` times;
    ``spread``: tasks that count words, as a multiple of
    ``spark.sql.shuffle.partitions``."""

    rounds: int = 16
    bins: int = 8
    weight: str = "tf"
    spread: int = 3


def sample_order(k: int) -> Column:
    """``ln a`` in round ``8 _part + k`` of a word with hash ``_h`` and log weight ``_lw``."""

    def uniform(salt: int, bit: int) -> str:  # 21 bits of a hash
        return f"(((shiftrightunsigned(xxhash64(_h, _part, {2 * k + salt}), {bit}) & 2097151L) + 0.5D) / 2097152D)"

    r = f"(-ln({uniform(0, 0)} * {uniform(0, 21)}))"
    c = f"(-ln({uniform(1, 0)} * {uniform(1, 21)}))"
    b = uniform(0, 42)
    return F.expr(f"ln({c}) - {r} * (floor(_lw / {r} + {b}) - {b} + 1)")


def sketches(texts: DataFrame, key: tuple[str, ...], sides: tuple[str, str], params: SketchParams = SketchParams()) -> DataFrame:
    """``key``, ``own`` and ``changed``: for each of two text columns its sorted
    samples as ``place * 65536 + 16 bits``.

    ``texts`` should be dealt by ``key`` already; keys without any word are
    missing from the result.  A word that weighs the same in both texts is drawn once.
    """
    bags = texts.select(*key, F.posexplode(F.array(*(F.col(c) for c in sides))).alias("_side", "_text"))
    words = bags.select(*key, "_side", F.explode(F.split("_text", r"\s+")).alias("_word")).filter("_word <> ''")
    counted = words.select(*key, "_side", F.xxhash64("_word").alias("_h")).groupBy(*key, "_h").agg(
        F.count_if(F.col("_side") == 0).alias("_n0"), F.count_if(F.col("_side") == 1).alias("_n1")
    )
    alike = F.col("_n0") == F.col("_n1")
    drawn = F.explode(
        F.array(
            F.struct(F.col("_n0").alias("tf"), F.lit(True).alias("own"), alike.alias("changed")),
            F.struct(F.when(alike, 0).otherwise(F.col("_n1")).alias("tf"), F.lit(False).alias("own"), F.lit(True).alias("changed")),
        )
    )
    weighed = counted.select(*key, "_h", drawn.alias("_d")).filter("_d.tf > 0").select(*key, "_h", "_d.*")
    weighed = weighed.withColumn("_w", F.expr(params.weight).cast("double")).filter("_w > 0")
    # eight rounds a row: few enough for a method that the JVM compiles, and an eighth of the rows
    part = F.explode(F.sequence(F.lit(0), F.lit(params.rounds // _PART - 1)))
    terms = weighed.select(*key, "_h", F.log("_w").alias("_lw"), "own", "changed", part.alias("_part"))
    place = F.col("_part") * params.bins + F.xxhash64("_h", "_part").bitwiseAND(F.lit(params.bins - 1)).cast("int")
    tried = terms.select(*key, place.alias("_place"), "own", "changed", *(sample_order(k).alias(f"_a{k}") for k in range(_PART)))
    least = tried.groupBy(*key, "_place").agg(
        *(F.min(F.when(F.col(side), F.col(f"_a{k}"))).alias(f"_{side}{k}") for side in ("own", "changed") for k in range(_PART))
    )

    def packed(side: str) -> Column:
        short = [F.xxhash64(f"_{side}{k}").bitwiseAND(F.lit(65535)).cast("int") for k in range(_PART)]
        placed = F.array(*((F.col("_place") * _PART + k) * 65536 + x for k, x in enumerate(short)))
        return F.sort_array(F.flatten(F.collect_list(F.when(F.col(f"_{side}0").isNotNull(), placed)))).alias(side)

    return least.groupBy(*key).agg(packed("own"), packed("changed"))


def likeness(a: str, b: str) -> Column:
    """The share of equal samples among places that either fills; 1 if neither fills any."""
    places = F.array_union(F.transform(a, lambda x: F.shiftright(x, 16)), F.transform(b, lambda x: F.shiftright(x, 16)))
    equal = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(F.size(places) == 0, F.lit(1.0)).otherwise(equal / F.size(places))


def as_text(samples: str) -> Column:
    """A fingerprint as text: six hexadecimal digits for each place that is filled."""
    return F.array_join(F.transform(samples, lambda x: F.lpad(F.hex(x), 6, "0")), "")


def successors(ids: DataFrame, col: str = "id") -> DataFrame:
    """``id, next_id``: the next larger id, after the largest the smallest.

    Ids are ordered in windows of 4096 values, and so are the windows, as often
    as the range of ids needs: no task orders more than that, however many ids
    there are and wherever they cluster.  Null ids are left out.
    """
    ids = ids.select(F.col(col).cast("bigint").alias("id")).filter("id is not null").distinct()
    low, high = ids.agg(F.min("id"), F.max("id")).first()
    if low is None:
        return ids.withColumn("next_id", F.col("id"))

    def after(keys: DataFrame, low: int, high: int) -> DataFrame:
        last = high - low < 1 << _FINE
        window = F.lit(0) if last else F.shiftright("id", _FINE)
        parted = keys.withColumn("_w", window)
        order = Window.partitionBy("_w").orderBy("id")
        parted = parted.withColumn("next_id", F.lead("id").over(order))
        if last:
            return parted.drop("_w")
        first = keys.groupBy(window.alias("id")).agg(F.min("id").alias("_first"))
        chain = after(first.select("id"), low >> _FINE, high >> _FINE)
        onward = chain.join(first.withColumnRenamed("id", "next_id"), "next_id").select(
            F.col("id").alias("_w"), "_first"
        )
        joined = parted.join(onward, "_w", "left")
        return joined.select("id", F.coalesce("next_id", "_first").alias("next_id"))

    return after(ids, low, high).withColumn("next_id", F.coalesce("next_id", F.lit(low)))


def fingerprints(
    docs: DataFrame,
    params: SketchParams = SketchParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``<id>, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` for each row.

    The edited text has the last half of the code points (rounded down) replaced
    by the first as many of the next document, by rising id, or by all of it if
    it is shorter; after the last document comes the first, and a single one is
    its own next.  A null text counts as empty; an empty text has an empty
    fingerprint, which is like another empty one and unlike all else.  Rows that
    repeat an id are fingerprinted each; as the next document of others, an id
    stands for the smallest of its texts (by length, then by hash).  Rows without
    id have no next document: their edited text is their first half and their
    ``near_next`` is 0.
    """
    check_columns(docs, id_col, text_col)
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    parts = params.spread * int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(id_col).cast("bigint").isNull().alias("_lost"),
    ).withColumns({"_h1": F.xxhash64("text"), "_h2": F.xxhash64("text", F.when(F.col("_lost"), 2).otherwise(1))})
    dealt = plain.repartition(parts, *_KEY)

    # rows by key without their texts, and the text by which an id is a next document
    size = F.char_length("text").alias("n_chars")
    rows = saved(plain.filter("not _lost").select(*_KEY, size).distinct(), folder, "rows")
    stands = rows.groupBy("id").agg(
        F.min(F.struct("n_chars", "_h1", "_h2")).alias("_least"), F.max(F.floor(F.col("n_chars") / 2)).cast("int").alias("half")
    )
    follow = successors(stands.select("id"))
    to = stands.select(F.col("id").alias("next_id"), F.col("_least._h1").alias("_n1"), F.col("_least._h2").alias("_n2"))
    follow = saved(follow.join(stands.select("id", "half"), "id").join(to, "next_id"), folder, "next")

    # an id asks the next one once for as many characters as its longest text replaces
    asked = follow.select(
        F.col("id").alias("for_id"), "half", F.col("next_id").alias("id"), F.col("_n1").alias("_h1"), F.col("_n2").alias("_h2")
    )
    texts = dealt.groupBy(*_KEY, "_lost", "text").agg(F.count(F.lit(1)).alias("_n"))
    given = texts.join(asked.repartition(parts, *_KEY), list(_KEY)).select(
        F.col("for_id").alias("id"), F.expr("substring(text, 1, half)").alias("head")
    )
    to_rows = rows.filter("n_chars > 1").select(*_KEY, F.floor(F.col("n_chars") / 2).cast("int").alias("half")).join(given, "id")
    heads = to_rows.select(*_KEY, F.expr("substring(head, 1, half)").alias("head")).repartition(parts, *_KEY)
    kept = "substring(text, 1, char_length(text) - cast(floor(char_length(text) / 2) as int))"
    edited = texts.join(heads, list(_KEY), "left").select(
        *_KEY, "_lost", "_n", "text", F.concat(F.expr(kept), F.coalesce("head", F.lit(""))).alias("edited")
    )
    made = _drawn(edited, params, folder)

    own = made.select(
        F.col("id").alias("next_id"), F.col("_h1").alias("_n1"), F.col("_h2").alias("_n2"), F.col("own").alias("next_own")
    )
    after = follow.select("id", "next_id", "_n1", "_n2").join(own, ["next_id", "_n1", "_n2"]).select(
        "id", "next_own", F.lit(True).alias("_has_next")
    )
    told = made.join(after, "id", "left").select(
        F.when(~F.col("_lost"), F.col("id")).alias(id_col),
        "n_chars",
        "edited_sha256",
        as_text("own").alias("fingerprint"),
        as_text("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        F.when(F.col("_has_next") & ~F.col("_lost"), likeness("own", "next_own")).otherwise(F.lit(0.0)).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_copy"),
    )
    return told.drop("_copy")


def _drawn(edited: DataFrame, params: SketchParams, folder: str) -> DataFrame:
    """Facts and samples of texts and of their edited texts, a row for each key."""
    facts = edited.select(
        *_KEY,
        "_lost",
        "_n",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
    )
    drawn = sketches(edited, _KEY, ("text", "edited"), params)
    empty = F.array().cast("array<int>")
    made = facts.join(drawn, list(_KEY), "left").withColumns({n: F.coalesce(n, empty) for n in ("own", "changed")})
    return saved(made, folder, "sketches")
