"""Near-duplicate documents by SimHash fingerprints, joined through vantage-point trees.

Trees. Two fingerprints within ``distance`` bits agree to ``distance // 3`` bits in one of three bit blocks. For each
block there is a tree whose nodes hold a vantage point v and a radius t: fingerprints at up to t + r bits from v (r is
the block's share) go to the inner side and those at over t to the outer side, so that by the triangle inequality no
pair within r is parted, and only fingerprints at the boundary go both ways. Vantage points are drawn from the
node's number, so that no tree is built or sent anywhere. One tree over all 64 bits would prune nothing: with r = 4
half of all fingerprints lie at a boundary, and both sides together have more pairs than the node. In a block of 21 bits
with r = 1, a sixth do, and the work grows as the number of fingerprints to the power 1.3.

Shards. The leaves are the shards; in each, fingerprints are compared in all 64 bits, and it gives a spanning forest of
its links, never all pairs. Equal fingerprints are one fingerprint before anything is compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import saved
from gaugeline.llm.components import connected_components, part_pairs

SHINGLE = 4
DISTANCE = 4
BLOCKS = ((0, 22), (22, 21), (43, 21))  # first bit and width
LEAF = 1_000  # fingerprints a leaf should have
MOST = 50_000  # larger leaves are cut into pairs of parts of this size

_BYTE_BITS = np.unpackbits(np.arange(256, dtype="u1")[:, None], axis=1, bitorder="little").astype("i8")
_ROW = (np.arange(8) * 256)[None, :]


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of a text; 0 if it has no word.

    Words are cut at ASCII white space after lower-casing A-Z; each run of ``shingle`` words (all words if there are
    fewer), joined by spaces, has an XXH64 hash with seed 42. A bit is set if over half the hashes have it.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), "<u8", n).view("u1").reshape(n, 8)
    # How often each value occurs in each of the eight bytes, then bits by value.
    seen = np.zeros(2048, "i8")
    for begin in range(0, n, 1 << 16):
        seen += np.bincount((hashes[begin : begin + (1 << 16)] + _ROW).ravel(), minlength=2048)
    bits = (seen.reshape(8, 256) @ _BYTE_BITS).ravel() * 2 > n
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([simhash(t) for t in texts], dtype="int64")


def fingerprint(text: Column) -> Column:
    """The fingerprint as a signed 64-bit number."""
    return F.pandas_udf(_fingerprints, T.LongType())(F.coalesce(text.cast("string"), F.lit("")))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers, by multiplication and shifts."""
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def leaves(prints: np.ndarray, block: int, depth: int, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Every leaf that each fingerprint visits in a block's tree: places in ``prints``, leaf numbers."""
    first, width = BLOCKS[block]
    r = distance // len(BLOCKS)
    t = (width - r) // 2
    mask = np.uint64((1 << width) - 1)
    value = (prints >> np.uint64(first)) & mask
    which, node = np.arange(len(prints)), np.ones(len(prints), "u8")
    for _ in range(depth):
        vantage = _mixed(node * np.uint64(len(BLOCKS)) + np.uint64(block)) & mask
        away = np.bitwise_count(value[which] ^ vantage)
        inner, outer = away <= t + r, away > t
        which = np.concatenate([which[inner], which[outer]])
        node = np.concatenate([node[inner] << np.uint64(1), (node[outer] << np.uint64(1)) | np.uint64(1)])
    return which, (node.astype("i8") << 2) | block


def tree_depth(n: int, leaf: int = LEAF) -> int:
    """Levels after which leaves have about ``leaf`` of ``n`` fingerprints; a level keeps 0.584 of a node."""
    return min(48, max(0, math.ceil(math.log(max(n, 1) / leaf) / -math.log(0.584))))


def forest(prints: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what links within ``distance`` connect: (member, its group's first), without loops.

    Takes 64 fingerprints at a time against all that are left; from any that has a link, its whole group is
    followed and taken out, so that a group of n costs n steps over what is left and gives n - 1 links.
    """
    left = np.unique(prints)
    members, firsts = [], []
    while len(left) > 1:
        some = left[:64]
        near = np.bitwise_count(some[:, None] ^ left[None, :]) <= distance
        linked = some[near.sum(axis=1) > 1]
        left = left[64:] if not len(linked) else left
        for first in linked:
            at = np.searchsorted(left, first)
            if at >= len(left) or left[at] != first:
                continue
            left = np.delete(left, at)
            queue = [first]
            while queue and len(left):
                hits = np.bitwise_count(left ^ queue.pop()) <= distance
                if hits.any():
                    found = left[hits]
                    left = left[~hits]
                    queue.extend(found)
                    members.append(found)
                    firsts.append(np.full(len(found), first))
        if len(linked):
            left = left[~np.isin(left, some)]
    empty = np.zeros(0, "u8")
    return (np.concatenate(members), np.concatenate(firsts)) if members else (empty, empty)


def linked_fingerprints(prints: DataFrame, distance: int = DISTANCE, leaf: int = LEAF, most: int = MOST) -> DataFrame:
    """(v, root): fingerprints of ``prints`` (column fp, distinct) that links within ``distance`` bits connect to others."""
    depth = tree_depth(prints.count(), leaf)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                values = batch.column(0).slice(begin, 4096).to_numpy(zero_copy_only=False)
                for block in range(len(BLOCKS)):
                    which, leaf_no = leaves(values.view("u8"), block, depth, distance)
                    yield pa.RecordBatch.from_arrays([pa.array(leaf_no), pa.array(values[which])], names=["leaf", "fp"])

    def compare(group: pa.Table) -> pa.Table:
        a, b = forest(group.column("fp").to_numpy().view("u8"), distance)
        return pa.table({"a": pa.array(a.view("i8")), "b": pa.array(b.view("i8"))})

    shards = saved(prints.select("fp").mapInArrow(route, "leaf long, fp long"), "simhash-shards")
    links = part_pairs(shards, "leaf", "fp", most).groupBy("leaf", "first", "second").applyInArrow(compare, "a long, b long")
    return connected_components(links)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row per document: key, fp (signed fingerprint), component_id (least key that links reach, its own included).

    Null and empty texts have fingerprint 0 and are linked like any other. Rows that share a key are kept as they are. Null
    keys are never a component's least key unless it has no other: then component_id is null. Other columns of ``docs`` are
    not looked at. An empty table gives no rows.
    """
    found = saved(docs.select(F.col(key).alias("k"), fingerprint(F.col(text)).alias("fp")), "simhash-prints")
    return with_components(found, distance).select(F.col("k").alias(key), "fp", "component_id")


def with_components(found: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``found`` (k, fp, ...) with group (a fingerprint that names the component) and component_id (its least k)."""
    prints = saved(found.groupBy("fp").agg(F.min("k").alias("least")), "simhash-distinct")
    linked = saved(linked_fingerprints(prints, distance), "simhash-linked")
    members = prints.join(linked, F.col("fp") == F.col("v")).select("fp", "root", "least")
    least = members.groupBy("root").agg(F.min("least").alias("group_least"))
    renamed = members.join(least, "root").select(F.col("fp").alias("v"), "root", "group_least")
    groups = prints.join(renamed, F.col("fp") == F.col("v"), "left").select(
        F.col("fp").alias("g"), F.coalesce("root", "fp").alias("group"),
        F.when(F.col("v").isNull(), F.col("least")).otherwise(F.col("group_least")).alias("component_id"))
    return found.join(groups, F.col("fp") == F.col("g")).drop("g")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """The documents with one row of each near-duplicate component: that with the least key, nulls last.

    Among rows of that key, the one with the least hash of all its columns stays; of wholly equal rows, one.
    All columns stay.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(F.col("k").isNull().alias("null"), F.col("k").alias("k"), F.col("h").alias("h"))
    slim = saved(docs.select(F.col(key).alias("k"), fingerprint(F.col(text)).alias("fp"), row.alias("h")), "simhash-prints")
    best = with_components(slim, distance).groupBy("group").agg(F.min(order).alias("w")).select("w.k", "w.h")
    same = slim.join(best, slim.k.eqNullSafe(best.k) & (slim.h == best.h), "left_semi").groupBy("k", "h").count()
    same = saved(same.select(F.struct("*").alias("_kept")), "simhash-kept")

    def rows(kept: DataFrame) -> DataFrame:
        return docs.join(kept, docs[key].eqNullSafe(F.col("_kept.k")) & (row == F.col("_kept.h")), "left_semi")

    return rows(same.where("_kept.count = 1")).unionByName(rows(same.where("_kept.count > 1")).dropDuplicates())
