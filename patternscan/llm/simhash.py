"""Near duplicates by SimHash fingerprints, met in the middle of their distance.

Two 64-bit fingerprints that differ in r bits at most have a value between them
that differs from either in half of r at most.  So every fingerprint emits all
variants within half the radius, and fingerprints that emit the same variant
link; as both are within half the radius of it, so are all that emit it, and a
variant's smallest fingerprint stands for the others.

With radius 4 a fingerprint has 2081 variants.  They are not shuffled one by
one: the first ``bits`` bits of a variant say where it goes, so a fingerprint is
sent once for each way to change those bits (56 for 10 bits), with the number of
changes left for the rest, and the rest is written out where it arrives.  Groups
that get too many are dealt again by more bits, to the last.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patternscan.llm.components import connected_components
from patternscan.llm.frames import MOST_BROADCAST_IDS, check_columns, keep_ids, saved, shared_folder

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SEED = 42


@dataclass(frozen=True)
class SimHashParams:
    """Shingles of ``width`` words; fingerprints link at ``radius`` or fewer
    different bits.

    ``bits`` is the least number of bits that deal variants out (more where
    there are more fingerprints), ``variants`` what a group may write out before
    it is dealt again by ``step`` more bits, ``together`` about the rows of a
    task."""

    width: int = 4
    radius: int = 4
    bits: int = 10
    variants: int = 1 << 21
    step: int = 6
    together: int = 200_000

    def __post_init__(self):
        if not 0 <= self.radius <= 6 or self.width < 1 or not 1 <= self.bits <= 64:
            raise ValueError("radius must be 0 to 6, width at least 1 and bits 1 to 64")


def fingerprint(text: str | None, width: int = 4) -> int:
    """The SimHash of a text: a bit is 1 if it is set in over half the hashes of
    its shingles, each as often as it occurs.

    Words are runs of bytes that are not ASCII white space, A to Z in lower case;
    with fewer words than ``width`` all are one shingle, without words it is 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    n = max(1, len(words) - width + 1)
    first, last = (end - size + 1)[:n].tolist(), end[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        spans = zip(first[k : k + (1 << 16)], last[k : k + (1 << 16)])
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def changes(width: int, most: int) -> list[tuple[int, int]]:
    """All values of ``width`` bits with ``most`` bits set at most, and how many are set."""
    return [
        (sum(1 << i for i in at), k) for k in range(min(most, width) + 1) for at in itertools.combinations(range(width), k)
    ]


@functools.lru_cache(maxsize=256)
def _masks(width: int, most: int) -> np.ndarray:
    return np.array([m for m, _ in changes(width, most)], np.uint64)


def _costs(width: int, most: int) -> list[int]:
    """How many values of ``width`` bits have 0, 1, ... ``most`` bits set at most."""
    return [sum(math.comb(width, k) for k in range(r + 1)) for r in range(most + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _dealt(rows: DataFrame, depth: int, step: int, half: int) -> DataFrame:
    """``key, fp, left`` by ``step`` more bits: the first bits of variants, and
    the changes that the rest may still have."""
    low = 64 - depth - step
    masks = [F.struct(F.lit(_signed(m << low)).alias("mask"), F.lit(k).alias("k")) for m, k in changes(step, half)]
    rows = rows.select("key", "fp", "left", F.explode(F.array(*masks)).alias("m")).filter(F.col("m.k") <= F.col("left"))
    changed = F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("m.mask")), low)
    own = changed.bitwiseAND(F.lit(_signed((1 << step) - 1)))
    key = F.shiftleft("key", step).bitwiseOR(own) if depth else own
    return rows.select(key.alias("key"), "fp", (F.col("left") - F.col("m.k")).alias("left"))


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of links, as many as tie the same fingerprints together."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        i, j = root(x), root(y)
        if i != j:
            parent[max(i, j)] = min(i, j)
            kept.append((x, y))
    return kept


def _meet(key: np.ndarray, depth: np.ndarray, fp: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of fingerprints that emit the same variant: the least one and another."""
    variants, owners = [], []
    for d, r in sorted(set(zip(depth.tolist(), left.tolist()))):
        at = np.flatnonzero((depth == d) & (left == r))
        low = 64 - d
        masks = _masks(low, r)
        rest = fp[at].view(np.uint64) & np.uint64((1 << low) - 1)
        base = (key[at].view(np.uint64) << np.uint64(low) if low < 64 else np.uint64(0)) | rest
        variants.append((base[:, None] ^ masks).ravel())
        owners.append(np.repeat(at, len(masks)))
    v, owner = np.concatenate(variants), np.concatenate(owners)
    s = np.sort(v)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return fp[:0], fp[:0]
    place = np.minimum(np.searchsorted(twice, v), len(twice) - 1)
    hit = np.flatnonzero(twice[place] == v)
    place, met = place[hit], fp[owner[hit]]
    order = np.lexsort((met, place))
    place, met = place[order], met[order]
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    hub = met[np.flatnonzero(new)][np.cumsum(new) - 1]
    links = np.unique(np.stack([hub, met])[:, ~new], axis=1)
    return links[0], links[1]


def ball_links(prints: DataFrame, params: SimHashParams = SimHashParams(), folder: str | None = None) -> DataFrame:
    """``a, b``: links that tie together all of ``prints`` (different values
    ``fp``, a long) within ``radius`` bits of each other, directly or by others.

    Each link is between fingerprints that differ in ``radius`` bits at most.  A
    group emits no more links than it has members, so large clusters of close
    fingerprints cost linear work.
    """
    p, half = params, params.radius // 2
    if p.radius % 2:
        raise ValueError("the radius must be even")
    count = prints.count()
    ball = sum(math.comb(64, k) for k in range(half + 1))
    depth = min(64, max(p.bits, math.ceil(math.log2(4 * ball * max(1, count) / p.variants))))  # a quarter on average
    rows = prints.select(F.lit(0).cast("long").alias("key"), "fp", F.lit(half).alias("left"))
    rows = _dealt(rows, 0, depth, half)
    ready, last = None, None
    while True:
        if depth >= 64:
            last = rows
            break
        costs = F.array(*(F.lit(c).cast("long") for c in _costs(64 - depth, half)))
        sizes = rows.groupBy("key").agg(F.sum(F.get(costs, F.col("left"))).alias("size"))
        many = sizes.filter(F.col("size") > p.variants).select("key")
        many = saved(many, folder or shared_folder(prints.sparkSession), f"many-{depth}")
        crowded = not many.isEmpty()
        some = keep_ids(rows, "key", many, others=True) if crowded else rows
        some = some.withColumn("depth", F.lit(depth))
        ready = some if ready is None else ready.unionByName(some)
        if not crowded:
            break
        step = min(p.step, 64 - depth)
        rows, depth = _dealt(keep_ids(rows, "key", many), depth, step, half), depth + step

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["depth", "key"], kind="stable")
        depth, key = frame["depth"].to_numpy(), frame["key"].to_numpy(np.int64)
        fp, left = frame["fp"].to_numpy(np.int64), frame["left"].to_numpy()
        cost = np.zeros(len(frame), np.int64)
        for d, r in set(zip(depth.tolist(), left.tolist())):
            cost[(depth == d) & (left == r)] = _costs(64 - d, r)[r]
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (depth[1:] != depth[:-1])])
        before = np.r_[np.cumsum(cost) - cost, cost.sum()]
        edge, a, b = [0], [fp[:0]], [fp[:0]]
        for start, end in zip(new.tolist(), [*new[1:].tolist(), len(frame)]):
            if start > edge[-1] and before[end] - before[edge[-1]] > p.variants:
                edge.append(start)
        for start, end in zip(edge, [*edge[1:], len(frame)]):
            at = slice(start, end)
            x, y = _meet(key[at], depth[at], fp[at], left[at])
            a.append(x)
            b.append(y)
        return pd.DataFrame(_forest(np.concatenate(a), np.concatenate(b)), columns=["a", "b"], dtype=np.int64)

    found = None
    if ready is not None:
        ways = len(changes(depth if last is None else p.bits, half))
        bins = max(1, -(-count * ways // p.together))
        binned = ready.withColumn("bin", F.pmod(F.xxhash64("depth", "key"), F.lit(bins)))
        found = binned.groupBy("bin").applyInPandas(solve, "a long, b long")
    if last is not None:  # all bits are dealt: a key is one variant
        least = last.groupBy("key").agg(F.min("fp").alias("a"))
        ends = last.join(least, "key").select("a", F.col("fp").alias("b")).filter("a <> b")
        found = ends if found is None else found.unionByName(ends)
    return found.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= p.radius).distinct()


def near_duplicates(
    docs: DataFrame,
    params: SimHashParams = SimHashParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``<id>, fingerprint, component_id`` for every row.

    ``fingerprint`` is 16 lowercase hex digits, ``component_id`` the smallest id
    that links reach from the row, its own included.  A null text, an empty one
    and one without words have fingerprint 0, which links like any other.  A row
    without id has a fingerprint, links with nothing and has a null component.
    Repeated rows give the same result again; rows that share an id are separate
    rows, and the id is in the component of each.  An empty table gives none.
    """
    check_columns(docs, id_col, text_col)
    p, folder = params, shared_folder(docs.sparkSession)

    @F.pandas_udf("long")
    def measure(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([_signed(fingerprint(t, p.width)) for t in texts], dtype=np.int64)

    rows = docs.select(F.col(id_col).alias("node"), measure(F.col(text_col).cast("string")).alias("fp"))
    rows = saved(rows, folder, "rows")
    prints = rows.filter("node is not null").groupBy("fp").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    prints = saved(prints, folder, "prints")
    links = saved(ball_links(prints.select("fp"), p, folder), folder, "links")
    roots = connected_components(links, f"{folder}/roots").select(F.col("node").alias("fp"), "root")
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = saved(rooted, folder, "rooted")
    groups = rooted.groupBy("root").agg(F.min("lo").alias("least"), F.max("hi").alias("most")).filter("least < most")
    several = saved(rooted.join(groups, "root").select("fp", "least"), folder, "several")
    few = several.count() <= MOST_BROADCAST_IDS
    found = rows.join(F.broadcast(several) if few else several, "fp", "left")
    return found.select(
        F.col("node").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("node").isNotNull(), F.coalesce("least", "node")).alias("component_id"),
    )
