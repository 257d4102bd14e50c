"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors of cosine c lie at squared distance 2 - 2c. A fixed rotation (sign flips and a Hadamard transform, so that
every task gets the same bits) spreads each vector over ``BLOCKS`` blocks of coordinates; a pair within squared distance
s is within s times its share of the coordinates in one block at least. Each block is a range join of its own: a tree of
cuts at medians of a bounded sample sends every vector to the leaves that its range may meet, sides overlapping by the
range. In a leaf, pairs in range are verified over the whole vectors.

Each pair counts once: in the first block where it is in range, in the leaf where both would stand if every cut sent
pairs to its lower side whenever that has both. So links are counted where they are found, and a leaf
gives one row per vector, with its count and a vector it is connected to, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import saved
from gaugeline.llm.components import connected_components, part_pairs

COSINE = 0.95
BLOCKS = 8
LEAF = 16_384  # vectors a leaf should have: smaller ones save comparisons, but each level sends a third of the vectors twice
SAMPLE = 20_000  # vectors from which cuts are taken; any cuts give the same result
LEAST_SAMPLE = 32  # a leaf of so few sampled vectors is not cut further
MOST = 32_768  # larger leaves are cut into pairs of parts of this size
TILE = 1_024


def unit_vectors(values: list[bytes], dims: int) -> np.ndarray:
    """Vectors of 32-bit floats, as bytes, as unit vectors in double precision, zeros added up to ``dims``."""
    out = np.zeros((len(values), dims))
    sizes = set(map(len, values))
    if len(sizes) == 1:
        n = sizes.pop() // 4
        out[:, :n] = np.frombuffer(b"".join(values), "<f4").reshape(-1, n)
    else:
        for i, v in enumerate(values):
            x = np.frombuffer(v, "<f4")
            out[i, : len(x)] = x
    return out / np.sqrt((out * out).sum(axis=1))[:, None]


def rotated(units: np.ndarray) -> np.ndarray:
    """Random signs, then a Hadamard transform: sums of two terms at a time, alike for every batch."""
    n, dims = units.shape
    x = units * np.where(np.random.default_rng(7).random(dims) < 0.5, -1.0, 1.0)
    step = 1
    while step < dims:
        pairs = x.reshape(n, dims // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, dims)
        step *= 2
    return x / np.sqrt(dims)


@dataclass
class Node:
    """A cut of one block, or a leaf: vectors up to cut + half go low, those above cut - half go high."""

    leaf: int = -1
    axis: int = 0
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None
    turns: list[tuple[int, float]] = field(default_factory=list)  # of a leaf: (axis, cut + half) of each high turn


def grow(sample: np.ndarray, n: float, half: float, leaf: int, made: list[Node], turns: list) -> Node:
    """A tree over a block's coordinates; ``n`` is how many vectors the node stands for."""
    if n > leaf and len(sample) > LEAST_SAMPLE:
        axis = int(np.argmax(sample.std(axis=0)))
        cut = float(np.median(sample[:, axis]))
        low, high = sample[sample[:, axis] <= cut + half], sample[sample[:, axis] > cut - half]
        if max(len(low), len(high)) < 0.9 * len(sample):
            share = n / len(sample)
            return Node(axis=axis, cut=cut, low=grow(low, share * len(low), half, leaf, made, turns),
                        high=grow(high, share * len(high), half, leaf, made, [*turns, (axis, cut + half)]))
    made.append(Node(leaf=len(made), turns=turns))
    return made[-1]


class Forest:
    """One tree per block, and what a block's range is."""

    def __init__(self, sample: np.ndarray, n: int, squared: float, leaf: int = LEAF):
        self.dims = sample.shape[1]
        self.blocks = min(BLOCKS, self.dims)
        self.width = self.dims // self.blocks
        self.budget = squared / self.blocks * (1 + 1e-9) + 1e-12
        self.half = float(np.sqrt(self.budget)) / 2 * (1 + 1e-9)
        self.leaves: list[list[Node]] = [[] for _ in range(self.blocks)]
        self.roots = [grow(self.part(sample, b), n, self.half, leaf, self.leaves[b], []) for b in range(self.blocks)]

    def part(self, x: np.ndarray, block: int) -> np.ndarray:
        return x[:, block * self.width : (block + 1) * self.width]

    def route(self, x: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(block, leaf, places in x) for every leaf that is visited."""
        for block in range(self.blocks):
            part = self.part(x, block)
            todo = [(self.roots[block], np.arange(len(x)))]
            while todo:
                node, which = todo.pop()
                if node.leaf >= 0:
                    yield block, node.leaf, which
                    continue
                value = part[which, node.axis]
                todo += [(node.low, which[value <= node.cut + self.half]), (node.high, which[value > node.cut - self.half])]


def compare(x: np.ndarray, units: np.ndarray, copies: np.ndarray, part: np.ndarray, both: bool, forest: Forest,
            block: int, leaf: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of the vectors of one leaf, each counted once over all blocks and leaves.

    Returns per vector how many vectors (copies included) it is linked to, and the place of one that it is
    connected to. ``both``: only pairs of different parts count.
    """
    n, turns = len(x), forest.leaves[block][leaf].turns
    counts, label = np.zeros(n, "i8"), np.arange(n)
    own = forest.part(x, block)
    lengths = (own * own).sum(axis=1)
    # Minus half the squared distance as one product.
    left = np.column_stack([own, np.ones(n), -lengths / 2]).astype("f4")
    right = np.column_stack([own, -lengths / 2, np.ones(n)]).astype("f4")
    least = -forest.budget / 2 - 1e-5
    for p in range(0, n, TILE):
        for q in range(p, n, TILE):
            near = left[p : p + TILE] @ right[q : q + TILE].T >= least
            if p == q:
                near = np.triu(near, 1)
            places = np.flatnonzero(near)
            for at in range(0, len(places), 32_768):
                i, j = np.divmod(places[at : at + 32_768], near.shape[1])
                i, j = i + p, j + q
                if both:
                    apart = part[i] != part[j]
                    i, j = i[apart], j[apart]
                for other in range(block + 1):  # in range here, and in no earlier block
                    coordinates = forest.part(x, other)
                    d = coordinates[i] - coordinates[j]
                    within = (d * d).sum(axis=1) <= forest.budget
                    ok = within if other == block else ~within
                    i, j = i[ok], j[ok]
                for axis, bound in turns:
                    ok = np.maximum(own[i, axis], own[j, axis]) > bound
                    i, j = i[ok], j[ok]
                ok = (units[i] * units[j]).sum(axis=1) >= cosine
                i, j = i[ok], j[ok]
                if len(i):
                    counts += np.bincount(i, copies[j], n).astype("i8") + np.bincount(j, copies[i], n).astype("i8")
                    label = unite(label, i, j)
    return counts, label


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component labels (least member) after joining i with j."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j = i[apart], j[apart]
        low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        np.minimum.at(label, high, low)
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter


def usable(vector: Column) -> Column:
    """Neither null nor all zero, every component finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def linked_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
                   leaf: int = LEAF, sample: int = SAMPLE, most: int = MOST) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Vectors link at a cosine of ``cosine`` or more in double precision; equal vectors are compared as one and linked.
    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing. A vector shorter than
    others is taken as if zeros followed. component_id is the least key that links reach, its own included; null keys
    are never that unless a component has no other. Rows that share a key are rows of their own; an empty table gives no rows.
    """
    spark = rows.sparkSession
    # -0.0 + 0.0 is 0.0, so that equal vectors have equal bits.
    plain = F.transform(F.col(vector), lambda x: x.cast("float") + F.lit(0.0).cast("float"))
    given = saved(rows.select(F.col(key).alias("k"), F.when(usable(F.col(vector)), plain).alias("v")), "vectors")
    uniform = saved(
        given.where("v is not null").groupBy("v").agg(F.min("k").alias("least"), F.count("*").alias("copies"))
        .withColumn("uid", F.monotonically_increasing_id()), "vectors-distinct")
    facts = uniform.agg(F.count("*"), F.max(F.size("v"))).head()
    if not facts[0]:
        return given.select(F.col("k").alias(key), F.lit(0).cast("long").alias("n_links"),
                            F.col("k").alias("component_id"), F.col("k").isNotNull().alias("kept"))
    dims = 1 << max(0, int(facts[1]) - 1).bit_length()
    some = uniform.select("uid", "v").orderBy(F.xxhash64("uid")).limit(sample).collect()
    picked = rotated(unit_vectors([np.array(r.v, "<f4").tobytes() for r in some], dims))
    shared = spark.sparkContext.broadcast(Forest(picked, facts[0], 2 - 2 * cosine, leaf))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 2_048):
                piece = batch.slice(begin, 2_048)
                values = [np.array(v, "<f4").tobytes() for v in piece.column(1).to_pylist()]
                uid, copies = piece.column(0).to_numpy(), piece.column(2).to_numpy()
                packed = pa.array(values, pa.binary())
                for block, leaf_no, which in forest.route(rotated(unit_vectors(values, dims))):
                    if len(which):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(which), leaf_no * BLOCKS + block)), pa.array(uid[which]),
                            pa.array(copies[which]), packed.take(pa.array(which))], names=["leaf", "uid", "copies", "v"])

    def links(group: pa.Table) -> pa.Table:
        group = group.sort_by("uid")
        units = unit_vectors(group.column("v").to_pylist(), dims)
        leaf_no, block = divmod(group.column("leaf")[0].as_py(), BLOCKS)
        both = group.column("first")[0].as_py() != group.column("second")[0].as_py()
        counts, label = compare(
            rotated(units), units, group.column("copies").to_numpy(), group.column("part").to_numpy(), both, shared.value,
            block, leaf_no, cosine)
        uid = group.column("uid").to_numpy()
        some = counts > 0
        return pa.table({"a": uid[some], "b": uid[label[some]], "links": counts[some]})

    routed = saved(uniform.select("uid", "v", "copies").mapInArrow(route, "leaf long, uid long, copies long, v binary"), "vectors-routed")
    found = saved(
        part_pairs(routed, "leaf", "uid", most).groupBy("leaf", "first", "second")
        .applyInArrow(links, "a long, b long, links long"), "vectors-linked")
    counts = found.groupBy("a").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select("a", "b"))
    named = (
        uniform.select("uid", F.col("v").alias("value"), "least", "copies").join(counts, F.col("uid") == F.col("a"), "left")
        .join(groups, F.col("uid") == F.col("v"), "left")
        .select("value", "least", F.coalesce("root", "uid").alias("root"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    named = saved(named, "vectors-named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    whole = named.join(least, "root").select("value", "n_links", "component_id")
    out = given.join(whole, F.col("v") == F.col("value"), "left")
    component = F.when(F.col("value").isNull(), F.col("k")).otherwise(F.col("component_id"))
    return out.select(
        F.col("k").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("k") == component, F.lit(False)).alias("kept"))
