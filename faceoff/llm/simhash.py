"""SimHash near-duplicates found by meet-in-the-middle ball hashing.

A fingerprint is linked to every other one within ``max_distance`` differing
bits.  Each distinct fingerprint stands for all variants within half that
radius; two fingerprints that are close enough share a variant.  The variants
are dealt out by their leading bits: a fingerprint is sent to every bucket that
one of its variants falls in, and the bucket's task writes out the rest of the
variant, sorts, and links the fingerprints that collide.  This is the same join
on variants, with a few dozen rows shuffled per fingerprint in place of
thousands.

Defined results: null or empty text has fingerprint zero, linked like any
other; rows with the same id or the same text are rows of their own; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import ceil, log2
from typing import Any

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faceoff.llm.common import fresh, written
from faceoff.llm.components import components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
_CHUNK = 1 << 16
# Variants that one step of a bucket's task holds at once; more are done in slices.
STEP_VARIANTS = 1 << 22
# Aimed at distinct fingerprints that share the same leading bits.
BUCKET_FINGERPRINTS = 1 << 11


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a text as an unsigned 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle_words, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def _fingerprint_udf(shingle_words: int):
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = [fingerprint(t, shingle_words) for t in texts]
        return pd.Series(np.array(values, np.uint64).view(np.int64))

    return of


@lru_cache(maxsize=None)
def _masks(bits: int, weight: int) -> np.ndarray:
    """All words of ``bits`` bits with ``weight`` ones."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(bits), weight)], np.uint64)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node reachable from each of ``n`` nodes over the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for side in (root[a], root[b], a, b):
            np.minimum.at(new, side, low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _collisions(fps, used, bits, near, far):
    """Links (i, j) of fingerprints that share a variant in the lowest ``bits`` bits.

    ``used`` counts the bits already flipped above.  A variant flips at most
    ``far`` bits in all; of the fingerprints on a variant, one that flips at most
    ``near`` is the centre, so that centre and other are within near + far.
    """
    per_left = [sum(len(_masks(bits, w)) for w in range(left + 1)) for left in range(far + 1)]
    if bits > 8 and sum(int((used == far - left).sum()) * n for left, n in enumerate(per_left)) > STEP_VARIANTS:
        low = bits - 4
        part = (fps >> np.uint64(low)) & np.uint64(15)
        for value in range(16):
            d = used + np.bitwise_count(part ^ np.uint64(value))
            here = np.flatnonzero(d <= far)
            if len(here) > 1:
                for i, j in _collisions(fps[here], d[here], low, near, far):
                    yield here[i], here[j]
        return
    tail = fps & np.uint64((1 << bits) - 1) if bits < 64 else fps
    values, owners, flips = [], [], []
    for weight in range(far + 1):
        here = np.flatnonzero(used + weight <= far)
        masks = _masks(bits, weight)
        values.append((tail[here, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(here.astype(np.int32), len(masks)))
        flips.append(np.repeat((used[here] + weight).astype(np.int8), len(masks)))
    values, owners, flips = np.concatenate(values), np.concatenate(owners), np.concatenate(flips)
    ordered = np.sort(values)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return
    # a table over 16 bits of the variant leaves few to compare with the shared ones
    fold = lambda v: ((v ^ (v >> np.uint64(17)) ^ (v >> np.uint64(31))) & np.uint64(0xFFFF)).astype(np.int64)
    maybe = np.zeros(1 << 16, bool)
    maybe[fold(shared)] = True
    at = np.flatnonzero(maybe[fold(values)])
    at = at[np.isin(values[at], shared)]
    values, owners, outer = values[at], owners[at], flips[at] > near
    order = np.lexsort((owners, outer, values))
    values, owners, outer = values[order], owners[order], outer[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    sizes = np.diff(np.append(first, len(values)))
    centre, linked = np.repeat(owners[first], sizes), ~np.repeat(outer[first], sizes)
    i, j = owners[linked], centre[linked]
    pairs = np.unique(np.stack([i, j], 1)[i != j], axis=0)
    if len(pairs):
        yield pairs[:, 0], pairs[:, 1]


def forest(fps: np.ndarray, bucket: int, lead: int, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) links of one bucket: the tree of all links found in it."""
    near, far = max_distance // 2, (max_distance + 1) // 2
    fps = np.unique(fps.astype(np.int64)).view(np.uint64)
    used = np.zeros(len(fps), np.int64)
    if lead:
        used = np.bitwise_count((fps >> np.uint64(64 - lead)) ^ np.uint64(bucket)).astype(np.int64)
    links = list(_collisions(fps, used, 64 - lead, near, far))
    if not links:
        return fps[:0].view(np.int64), fps[:0].view(np.int64)
    a, b = (np.concatenate(x) for x in zip(*links))
    close = np.bitwise_count(fps[a] ^ fps[b]) <= max_distance  # verify
    root = _roots(len(fps), a[close], b[close])
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return fps[moved].view(np.int64), fps[root[moved]].view(np.int64)


def links(fingerprints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(u, v) links between distinct fingerprints (column ``fp``) whose components are
    those of all links within ``max_distance`` bits."""
    far = (max_distance + 1) // 2
    n = fingerprints.count()
    lead = min(32, max(0, ceil(log2(max(n, 1) / BUCKET_FINGERPRINTS))))
    flips = [int(m) for w in range(min(far, lead) + 1) for m in _masks(lead, w)] if lead else [0]
    top = F.shiftrightunsigned("fp", 64 - lead) if lead else F.lit(0).cast("long")
    dealt = fingerprints.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in flips])).alias("flip"))
    dealt = dealt.select("fp", top.bitwiseXOR(F.col("flip")).alias("bucket"))

    def of(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        u, v = forest(rows["fp"].to_numpy(), int(key[0]), lead, max_distance)
        return pd.DataFrame({"u": u, "v": v})

    return dealt.groupBy("bucket").applyInPandas(of, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per row of ``docs``: (id, text_key, fp, root, component_id).

    ``component_id`` is the smallest id reachable over links (null if all are
    null), ``root`` the component's least fingerprint and ``text_key`` a hash
    of the text that tells rows of one id apart.
    """
    spread = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(text_col).alias("text_key"),
        _fingerprint_udf(shingle_words)(F.col(text_col)).alias("fp"),
    )
    rows = written(spread, "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("_id").alias("least"))
    roots = components(links(classes.select("fp"), max_distance))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = written(rooted, "roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.join(least, "root").select("fp", "root", "component_id")
    return rows.join(of_fp, "fp").select(F.col("_id").alias(id_col), "text_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: its smallest id, and of the rows
    of that id the one with the smallest hash of its text (null ids: one
    row of a component in which no row has an id)."""
    found = near_duplicates(docs, id_col, text_col, shingle_words, max_distance)
    kept_id, kept_key, text_key = (fresh(docs.columns, c) for c in ("kept_id", "kept_key", "text_key"))
    kept = (
        found.filter(F.col(id_col).eqNullSafe(F.col("component_id")))
        .groupBy("root", F.col(id_col).alias(kept_id))
        .agg(F.min("text_key").alias(kept_key))
        .drop("root")
    )
    # rows repeated with id and text are one: combined before the shuffle, however many
    once = docs.withColumn(text_key, F.xxhash64(text_col)).dropDuplicates([id_col, text_key])
    same = F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.col(text_key) == F.col(kept_key))
    return once.join(kept, same, "left_semi").select(*docs.columns)
