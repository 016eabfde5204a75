"""Exact Jaccard join of documents by their word shingles.

A document is a set of shingles, and the set is a point: its shingles are hashed
into ``groups`` and the point has the count of each group.  The overlap of two
sets is at most the sum of the smaller counts, and for a box of points (a node
of an R-tree) at most the sum with the largest counts in the box.  What differs
on both sides cancels out in a group, so a point also has a row of bits, many
more than it has groups: each says whether an odd number of shingles falls on it.
A shingle in which two sets differ changes one bit, so that sets differ in no
fewer shingles than bits.

Points must first meet on one machine.  Two sets that are similar enough differ
in at most t shingles.  The hash space is cut into more than t + 1 slices, and a
document is sent to a bucket for the content of each slice in which it has a
shingle.  If one of the two has t + 1 such slices or more, one of them has the
same shingles in the other, and no link is lost; sets that have fewer are sliced
again by another hash, and after some rounds go by their t + 1 smallest hashes.
No bucket stands for an empty slice, which unlike texts would share.

1. Equal sets are one class; its smallest id stands for all.
2. The smallest member of a bucket, its hub, asks an R-tree over the points of
   all that share a bucket with it; what the bound leaves is compared exactly.
   This joins most members of large buckets in linear work.
3. Buckets whose members are still apart are searched with an R-tree, in blocks,
   for pairs of different components that the bound does not exclude.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from patternscan.llm.components import connected_components
from patternscan.llm.frames import MOST_BROADCAST_IDS, check_columns, keep_ids, saved, shared_folder
from patternscan.llm.textops import chunks, mix, prefix_hashes, span_hashes, utf8_bytes, words

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


#: Characters that are hashed at a time: some 100 bytes of arrays for each.
_TOGETHER = 1 << 18
#: Pairs whose bits are compared at a time.
_ROWS = 1 << 12


@dataclass(frozen=True)
class JaccardParams:
    """Shingles of ``width`` words; a link needs
    ``100 * intersection >= percent * union``.

    ``groups`` is the number of coordinates of a point, ``block`` the number of
    points in one tree, ``together`` about the number that a task holds, ``step``
    the ratio of the sizes at the ends of a level (sets of a level are sliced
    alike)."""

    width: int = 3
    percent: int = 90
    groups: int = 128
    block: int = 1024
    together: int = 20_000
    step: float = 1.5

    def __post_init__(self):
        if not 50 <= self.percent <= 100 or self.width < 1:
            raise ValueError("percent must be 50 to 100 and width at least 1")

    def least_overlap(self, sizes: np.ndarray) -> np.ndarray:
        """The least intersection of a link between sets of so many shingles together."""
        return -(-self.percent * sizes // (100 + self.percent))

    def most_difference(self, sizes: np.ndarray) -> np.ndarray:
        """The most shingles in which linked sets of so many shingles together differ."""
        return sizes - 2 * self.least_overlap(sizes)

    def odd_sizes(self, n: np.ndarray) -> np.ndarray:
        """Bits of sets with ``n`` shingles, powers of two from 64: four for each
        shingle up to 2048, then as many as tell unrelated sets apart (unlike
        sets differ in half of all bits)."""
        least = np.maximum(np.minimum(4 * n, 2048), 9 * self.most_difference(2 * n) // 4)
        return np.int64(1) << np.ceil(np.log2(np.maximum(least, 64))).astype(np.int64)

    def levels(self, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each level: its first size, the slices that a set needs (one more
        than the shingles in which linked sets differ), the slices that are cut.

        The smaller set of a link has a size in the level; the other one is at
        most 100 / percent times that.
        """
        first = [1]
        while first[-1] <= largest:
            first.append(max(first[-1] + 1, int(first[-1] * self.step)))
        last = np.array(first[1:], np.int64) - 1
        both = last + 100 * last // self.percent
        need = (100 - self.percent) * both // (100 + self.percent) + 1
        cuts = [_cuts(f, k) for f, k in zip(first, need.tolist())]
        return np.array(first[:-1], np.int64), need, np.array(cuts, np.int64)


def _cuts(size: int, need: int) -> int:
    """Slices, so that ``size`` shingles most often fill ``need`` of them."""
    for cuts in range(need, 2 * need + 1):
        empty = cuts * (1 - 1 / cuts) ** size
        if cuts - empty - 2 * empty**0.5 >= need:
            return cuts
    return need + max(1, need // 4)


def shingles(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of texts: index of the text (rising), 64-bit hash.

    Words are runs of bytes that are not ASCII white space, A to Z in lower
    case.  A text with fewer words than ``width`` has all of them as its one
    shingle, a text without words has none.
    """
    data, starts = utf8_bytes(texts)
    data = _LOWER[data]
    first, end, text = words(data, starts, ~_SPACE[data])
    h = span_hashes(prefix_hashes(data), first, end)
    count = np.bincount(text, minlength=len(texts))
    start = np.cumsum(count) - count
    taken = np.minimum(count, width)
    pos = np.arange(len(h)) - start[text]
    begin = np.flatnonzero(pos <= np.maximum(count - width, 0)[text])
    owner = text[begin]
    s = np.zeros(len(begin), np.uint64)
    for k in range(width):
        there = k < taken[owner]
        at = np.minimum(begin + k, max(len(h) - 1, 0))
        s = mix(s * np.uint64(0xD1342543DE82EF95) + np.where(there, h[at] if len(h) else 0, np.uint64(k)))
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], s[new]


def _wrapped_sums(key: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of 64-bit values by key, modulo 2**64."""
    out = np.zeros(size, np.uint64)
    for shift in (0, 22, 44):
        part = ((values >> np.uint64(shift)) & np.uint64((1 << 22) - 1)).astype(np.float64)
        out += np.bincount(key, weights=part, minlength=size).astype(np.uint64) << np.uint64(shift)
    return out


def points(owner: np.ndarray, s: np.ndarray, n: np.ndarray, p: JaccardParams) -> tuple[np.ndarray, list[bytes]]:
    """Of each text with ``n`` shingles: their counts by group, and a 128-bit
    fingerprint of the set."""
    group = ((s >> np.uint64(32)) * np.uint64(p.groups) >> np.uint64(32)).astype(np.int64)
    counts = np.bincount(owner * p.groups + group, minlength=len(n) * p.groups)
    halves = [_wrapped_sums(owner, mix(s + np.uint64(k)), len(n)) for k in (1, 2)]
    prints = np.stack(halves, axis=1).astype("<u8")
    return counts.reshape(len(n), p.groups), [x.tobytes() for x in prints]


def odd_bits(owner: np.ndarray, s: np.ndarray, n: np.ndarray, p: JaccardParams) -> list[bytes]:
    """Of each text with ``n`` shingles: bits that are set where the number of
    shingles is odd."""
    size = p.odd_sizes(n)
    base = np.cumsum(size) - size
    place = base[owner] + (s & (size[owner] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits(np.bincount(place, minlength=int(size.sum())) & 1, bitorder="little")
    return [packed[b : b + k].tobytes() for b, k in zip(base // 8, size // 8)]


def _folded(bits: bytes, size: int) -> np.ndarray:
    """The bits as a row of ``size`` bytes would have them: odd and odd is even."""
    row = np.frombuffer(bits, np.uint8)
    while len(row) > size:
        row = row[: len(row) // 2] ^ row[len(row) // 2 :]
    return row


def least_differences(bits: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of each pair of rows: differing shingles that their bits show.  A row
    without bits may be like any other."""
    size = np.array([len(b) for b in bits], np.int64)
    common = np.minimum(size[left], size[right])
    out = np.zeros(len(left), np.int64)
    for k in np.unique(common).tolist():
        at = np.flatnonzero(common == k)
        sides = []
        for ends in (left[at], right[at]):
            rows, place = np.unique(ends, return_inverse=True)
            sides.append((np.stack([_folded(bits[r], k) for r in rows.tolist()]), place))
        (a, i), (b, j) = sides
        for part in range(0, len(at) if k else 0, _ROWS):
            here = slice(part, part + _ROWS)
            out[at[here]] = np.bitwise_count(a[i[here]] ^ b[j[here]]).sum(axis=1, dtype=np.int64)
    return out


def _content(
    owner: np.ndarray, s: np.ndarray, level: np.ndarray, cuts: np.ndarray, use: np.ndarray, salt: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slices with a shingle: index of the text, hash of the content; and how
    many of them each text has."""
    k = np.where(use, cuts, 0)
    base = np.cumsum(k) - k
    mine = use[owner]
    h, o = s[mine], owner[mine]
    seed = mix(level[o].astype(np.uint64) * np.uint64(16) + np.uint64(77 + salt))
    where = (mix(h ^ seed) >> np.uint64(32)) * k[o].astype(np.uint64) >> np.uint64(32)
    place = base[o] + where.astype(np.int64)
    sums = _wrapped_sums(place, mix(h + np.uint64(3)), int(k.sum()))
    full = np.flatnonzero(np.bincount(place, minlength=len(sums)))
    text = np.repeat(np.arange(len(use)), k)[full]
    number = (full - base[text]).astype(np.uint64) + np.uint64(salt << 28)
    tag = mix((level[text].astype(np.uint64) << np.uint64(32)) + number)
    return text, mix(sums[full] ^ tag).view(np.int64), np.bincount(text, minlength=len(use))


#: Rounds of slices before the smallest hashes.
ROUNDS = 4


def slices(owner: np.ndarray, s: np.ndarray, n: np.ndarray, p: JaccardParams) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of texts with ``n`` shingles each: index of the text, key."""
    if not len(s):
        return owner, s.astype(np.int64)
    first, needs, cuts = p.levels(int(n.max()))
    low = -(-p.percent * n // 100)  # the smallest partner
    found_text, found = [owner[:0]], [s[:0].view(np.int64)]
    level_of = np.searchsorted(first, n, side="right") - 1
    lowest = np.searchsorted(first, np.maximum(low, 1), side="right") - 1
    start = np.cumsum(n) - n
    for back in range(int((level_of - lowest).max()) + 1):
        level = level_of - back
        at = np.maximum(level, 0)
        # where no shingle may differ, links join equal sets, which are one class
        use = (n > 0) & (level >= lowest) & (needs[at] > 1)
        for salt in range(ROUNDS):
            if not use.any():
                break
            text, key, filled = _content(owner, s, level, cuts[at], use, salt)
            found_text.append(text)
            found.append(key)
            use &= filled < needs[at]
        taken = np.where(use, np.minimum(needs[at], n), 0)  # shingles of a text are in order of their hash
        text = np.repeat(np.arange(len(n)), taken)
        number = np.arange(len(text)) - (np.cumsum(taken) - taken)[text]
        tag = mix((level[text].astype(np.uint64) << np.uint64(32)) + np.uint64(0xFFFFFFFF))
        found_text.append(text)
        found.append(mix(s[start[text] + number] ^ tag).view(np.int64))
    return np.concatenate(found_text), np.concatenate(found)


def overlaps(left: list[str], right: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Intersection and union of each pair of texts."""
    both = [t for pair in zip(left, right) for t in pair]
    owner, s = shingles(both, width)
    pair = owner // 2
    total = np.bincount(pair, minlength=len(left))
    order = np.lexsort((s, pair))
    s, pair = s[order], pair[order]
    again = np.zeros(len(s), bool)
    again[1:] = (s[1:] == s[:-1]) & (pair[1:] == pair[:-1])
    common = np.bincount(pair[again], minlength=len(left))
    return common, total - common


class CountTree:
    """An R-tree over count vectors: points sorted into boxes by the widest
    coordinate, each node with the largest count of each group in its box and
    the least number of shingles."""

    leaf = 32

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.counts, self.sizes = counts, sizes
        self.nodes: list[tuple[np.ndarray, int, list[int], np.ndarray]] = []
        self.root = self._build(np.arange(len(sizes))) if len(sizes) else -1

    def _build(self, at: np.ndarray) -> int:
        box = self.counts[at].max(axis=0)
        children: list[int] = []
        if len(at) > self.leaf:
            spread = self.counts[at].max(axis=0) - self.counts[at].min(axis=0)
            at = at[np.argsort(self.counts[at, int(spread.argmax())], kind="stable")]
            half = len(at) // 2
            children = [self._build(at[:half]), self._build(at[half:])]
        self.nodes.append((box, int(self.sizes[at].min()), children, at))
        return len(self.nodes) - 1

    def search(self, counts: np.ndarray, size: int, p: JaccardParams) -> np.ndarray:
        """Points whose overlap with a given one may be large enough for a link."""
        found, open_nodes = [], [self.root] if self.root >= 0 else []
        while open_nodes:
            box, least, children, at = self.nodes[open_nodes.pop()]
            if np.minimum(box, counts).sum() < p.least_overlap(np.int64(least + size)):
                continue
            if children:
                open_nodes += children
            else:
                bound = np.minimum(self.counts[at], counts).sum(axis=1)
                found.append(at[bound >= p.least_overlap(self.sizes[at] + size)])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def exact_sets(text: str, width: int) -> set:
    """The shingles of a text, as tuples of words."""
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER.tobytes()).split()
    return {tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1))} if found else set()


def linked(left: list[str], right: list[str], p: JaccardParams) -> np.ndarray:
    """Which pairs of texts link.  Sets are compared by 64-bit hashes; pairs so
    near to the limit that a collision could matter are compared by words."""
    keep = np.zeros(len(left), bool)
    for part in chunks([range(len(x) + len(y)) for x, y in zip(left, right)], _TOGETHER):  # only lengths count
        common, union = overlaps(left[part.start : part.stop], right[part.start : part.stop], p.width)
        margin = 100 * common - p.percent * union
        for k in np.flatnonzero(np.abs(margin) <= 4 * (100 + p.percent)).tolist():
            a, b = (exact_sets(side[part.start + k], p.width) for side in (left, right))
            margin[k] = 100 * len(a & b) - p.percent * len(a | b)
        keep[part.start : part.stop] = margin >= 0
    return keep


#: Members that are compared with one copy of their hub's text.
COMPARED = 64


def _dealt(pairs: DataFrame, per: int) -> DataFrame:
    """``a, unit, node``: the members of each hub in units of some ``per``, and
    the hub itself in each.  Only hubs of more members are counted by a join, and
    no task gets all members of one."""
    units = F.ceil(F.count(F.lit(1)) / per).cast("int").alias("units")
    folder = shared_folder(pairs.sparkSession)
    many = saved(pairs.groupBy("a").agg(units).filter("units > 1"), folder, "many")
    few = many.count() <= MOST_BROADCAST_IDS
    own = F.pmod(F.xxhash64("b"), F.coalesce("units", F.lit(1))).cast("int")
    members = pairs.join(F.broadcast(many) if few else many, "a", "left").select("a", own.alias("unit"), "b")
    hubs = members.select("a", "unit").distinct().withColumn("node", F.col("a"))
    return members.withColumnRenamed("b", "node").unionByName(hubs)


def _verified(pairs: DataFrame, texts: DataFrame, p: JaccardParams) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough; ``texts`` has ``node, text``.

    Each ``a`` meets its partners in units of some ``COMPARED``, so that its text
    travels once a unit; a task reads unit after unit and holds one text.
    """
    dealt = _dealt(pairs, COMPARED).withColumn("side", (F.col("node") != F.col("a")).cast("int"))
    dealt = saved(dealt, shared_folder(pairs.sparkSession), "units")
    few = dealt.count() <= MOST_BROADCAST_IDS  # narrow rows: then texts are not shuffled to find their units
    rows = texts.join(F.broadcast(dealt) if few else dealt, "node")
    rows = rows.select("a", "unit", "side", "node", "text").repartition("a", "unit")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, hub = None, []
        for batch in batches:
            found, left, right, ends = [], [], [], []
            for a, k, side, node, text in batch.itertuples(index=False, name=None):
                if (a, k) != unit:
                    unit, hub = (a, k), []
                if side == 0:
                    hub.append(text)
                    continue
                for other in hub:
                    left.append(other)
                    right.append(text)
                    ends.append((a, node))
                if len(ends) >= 256:
                    found += [e for e, k in zip(ends, linked(left, right, p)) if k]
                    left, right, ends = [], [], []
            found += [e for e, k in zip(ends, linked(left, right, p)) if k]
            yield pd.DataFrame(found, columns=["a", "b"])

    found = rows.sortWithinPartitions("a", "unit", "side").mapInPandas(verify, pairs.select("a", "b").schema)
    return found.distinct()


def _hub_pairs(stars: DataFrame, chosen: DataFrame, p: JaccardParams) -> DataFrame:
    """Pairs ``a, b`` of hub and member that the bound does not exclude.

    The members of a hub are dealt into blocks; the hub asks the R-tree of each.
    """
    bins = max(1, -(-stars.count() // p.together))
    rows = _dealt(stars, p.block).join(chosen, "node")

    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["a", "unit"], kind="stable", ignore_index=True)
        counts = np.array(frame["counts"].tolist(), np.int64).reshape(len(frame), p.groups)
        sizes = frame["n"].to_numpy(np.int64)
        unit = frame.groupby(["a", "unit"], sort=False).ngroup().to_numpy()
        asks = (frame["node"] == frame["a"]).to_numpy()
        hub = np.full(int(unit[-1]) + 1, -1)
        hub[unit[asks]] = np.flatnonzero(asks)
        there = np.flatnonzero(~asks & (hub[unit] >= 0))
        size = np.bincount(unit[there], minlength=len(hub))
        small = there[size[unit[there]] <= CountTree.leaf]  # a tree of one leaf
        bound = np.minimum(counts[small], counts[hub[unit[small]]]).sum(axis=1)
        found = [small[bound >= p.least_overlap(sizes[small] + sizes[hub[unit[small]]])]]
        for u in np.flatnonzero(size > CountTree.leaf).tolist():
            at = there[unit[there] == u]
            found.append(at[CountTree(counts[at], sizes[at]).search(counts[hub[u]], int(sizes[hub[u]]), p)])
        near = np.concatenate(found)
        other = hub[unit[near]]
        differ = least_differences(frame["odd"].tolist(), near, other)
        kept = frame.iloc[near[differ <= p.most_difference(sizes[near] + sizes[other])]]
        return pd.DataFrame({"a": kept["a"], "b": kept["node"]})

    binned = rows.withColumn("bin", F.pmod(F.xxhash64("a", "unit"), F.lit(bins)))
    return binned.groupBy("bin").applyInPandas(ask, stars.select("a", "b").schema)


def _search(members: DataFrame, chosen: DataFrame, p: JaccardParams, folder: str) -> DataFrame:
    """Pairs ``a, b`` of different components in buckets (``sig, node, root,
    size``) that neither bound excludes.

    A bucket larger than a block is dealt into blocks, and each pair of blocks is
    a unit; a task gets units of some ``together`` points at a time.  Most members
    of a large bucket that are still apart link with none of it, so that nearly
    all their pairs have to go before they are rows.
    """
    blocks = F.ceil(F.col("size") / p.block).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("block", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "sig", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "node", "root",
    )

    dealt = saved(dealt, folder, "blocks")  # narrow: points join it on its way to a task
    bins = max(1, -(-dealt.count() // p.together))

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        for (_, i, j), unit in frame.groupby(["sig", "i", "j"], sort=False):
            counts = np.array(unit["counts"].tolist(), np.int64).reshape(len(unit), p.groups)
            sizes, root = unit["n"].to_numpy(np.int64), unit["root"].to_numpy()
            block, node, odd = unit["block"].to_numpy(), unit["node"].to_numpy(), unit["odd"].tolist()
            indexed = np.flatnonzero(block == i)
            tree = CountTree(counts[indexed], sizes[indexed])
            for q in np.flatnonzero(block == j).tolist():
                near = indexed[tree.search(counts[q], int(sizes[q]), p)]
                near = near[(root[near] != root[q]) & ((i < j) | (near < q))]
                differ = least_differences(odd, near, np.full(len(near), q))
                near = near[differ <= p.most_difference(sizes[near] + sizes[q])]
                found += [(node[k], node[q]) for k in near.tolist()]
        out = pd.DataFrame(found, columns=["x", "y"], dtype=frame["node"].dtype)
        out = pd.DataFrame({"a": out[["x", "y"]].min(axis=1), "b": out[["x", "y"]].max(axis=1)})
        return out.drop_duplicates()  # long texts may share hundreds of buckets

    node = members.schema["node"].dataType
    binned = dealt.join(chosen, "node").withColumn("bin", F.pmod(F.xxhash64("sig", "i", "j"), F.lit(bins)))
    pairs = binned.groupBy("bin").applyInPandas(join, StructType([StructField("a", node), StructField("b", node)]))
    return pairs.distinct()


def near_duplicates(
    docs: DataFrame,
    params: JaccardParams = JaccardParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``<id>, n_shingles, component_id`` for every row.

    ``component_id`` is the smallest id that links reach from the row, its own
    included.  A null text, an empty one and one without words have 0 shingles
    and link with nothing.  A row without id counts its shingles, links with
    nothing and has a null component.  Ids should be unique; a repeated row gives
    the same result again.  Whole texts are compared and every link is found;
    pairs near the limit are compared word by word, and a 128-bit hash stands for
    a set only where equal sets are brought together.
    """
    check_columns(docs, id_col, text_col)
    p, spark = params, docs.sparkSession
    folder = shared_folder(spark)
    plain = docs.select(F.col(id_col).alias("node"), F.col(text_col).cast("string").alias("text"))

    @F.pandas_udf("n long, print binary, counts array<int>, odd binary, sigs array<long>")
    def measure(column: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in column:
            texts = ["" if t is None else t for t in batch]
            n, counts, prints, odd, sigs = [], [], [], [], []
            for part in chunks(texts, _TOGETHER):
                owner, s = shingles(texts[part.start : part.stop], p.width)
                size = np.bincount(owner, minlength=len(part)).astype(np.int64)
                point = points(owner, s, size, p)
                n += size.tolist()
                counts += list(point[0].astype(np.int32))
                prints += point[1]
                odd += odd_bits(owner, s, size, p)
                text, sig = slices(owner, s, size, p)
                ends = np.cumsum(np.bincount(text, minlength=len(part)))
                sigs += np.split(sig[np.argsort(text, kind="stable")], ends[:-1])
            point = {"n": n, "print": prints, "counts": counts, "odd": odd}
            yield pd.DataFrame(point | {"sigs": pd.Series(sigs, dtype=object)})

    measured = plain.select("node", measure("text").alias("_p"))
    rows = saved(measured.select("node", "_p.n", "_p.print", "_p.counts", "_p.odd", "_p.sigs"), folder, "points")
    full = rows.filter("n > 0 and node is not null")
    classes = full.groupBy("n", "print").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    several = saved(classes.filter("lo < hi").select("n", "print", F.col("lo").alias("stands")), folder, "classes")
    few = several.count() <= MOST_BROADCAST_IDS
    own = F.when((F.col("n") > 0) & F.col("node").isNotNull(), F.coalesce("stands", "node"))
    classed = rows.join(F.broadcast(several) if few else several, ["n", "print"], "left").withColumn("class_node", own)
    placed = saved(classed.select("node", "n", "class_node"), folder, "placed")
    chosen = classed.filter("node = class_node")

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    sent = chosen.select("node", F.explode("sigs").alias("sig"))
    sent = sent.repartition(parts, "sig").dropDuplicates(["sig", "node"])  # one shuffle for both sides below
    met = sent.groupBy("sig").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("hub"))
    members = saved(sent.join(met.filter("size > 1"), "sig"), folder, "members")

    # points and texts that may be compared, fetched once
    asked = saved(members.select("node").distinct(), folder, "asked")
    chosen = keep_ids(chosen, "node", asked).select("node", "n", "print", "counts", "odd")
    texts = keep_ids(plain.filter("node is not null and text is not null"), "node", asked)
    again = placed.filter("class_node is not null").groupBy("node").count().filter("count > 1").select("node")
    again = saved(again, folder, "again")
    if not again.isEmpty():  # copies of a row would multiply its pairs
        sets = keep_ids(full, "node", again).groupBy("node").agg(F.min("print").alias("lo"), F.max("print").alias("hi"))
        unlike = sets.filter("lo <> hi").select("node", F.lit(True).alias("unlike"))  # bits of one set say nothing of others
        chosen = chosen.join(unlike, "node", "left").withColumn("odd", F.when(F.col("unlike").isNull(), F.col("odd")).otherwise(F.lit(b"")))
        copies = keep_ids(texts, "node", again).dropDuplicates(["node", "text"])
        texts = keep_ids(texts, "node", again, others=True).unionByName(copies)
    texts = saved(texts, folder, "texts")
    chosen = saved(chosen.select("node", "n", "counts", "odd").dropDuplicates(["node"]), folder, "chosen")
    stars = members.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    stars = saved(stars, folder, "stars")
    near = saved(_hub_pairs(stars, chosen, p), folder, "star-pairs")
    links = saved(_verified(near, texts, p), folder, "star-links")
    roots = saved(connected_components(links, f"{folder}/star"), folder, "star-roots")

    joined = members.join(roots, "node", "left").select(
        "sig", "node", F.coalesce("root", "node").alias("root"), "size"
    )
    apart = joined.groupBy("sig", "size").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"),
        F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("all"),
    ).filter("lo <> hi")
    once = apart.groupBy("size", "all").agg(F.min("sig").alias("sig")).select("sig")  # a bucket's members once
    left = joined.join(once, "sig", "leftsemi")
    pairs = saved(_search(left, chosen, p, folder), folder, "pairs")
    final = roots
    if not pairs.isEmpty():
        more = saved(_verified(pairs, texts, p), folder, "pair-links")
        final = saved(connected_components(links.unionByName(more), f"{folder}/all"), folder, "roots")

    end = final.select(F.col("node").alias("class_node"), "root")
    found = placed.join(end, "class_node", "left")
    component = F.when(F.col("node").isNotNull(), F.coalesce("root", "class_node", "node"))
    return found.select(F.col("node").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
