"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A rotation is learned on a bounded sample (about ``SAMPLE`` vectors, those with the smallest hash, or all up to twice that):
principal axes first, then turns between the signs and the rotation that meets them best. All vectors get
the signs as a code. The code is cut into groups of bits; vectors whose bits agree in a group, up to its
radius, are candidates, and their cosine in double precision decides. Number and radius of the groups are the
cheapest whose recall for pairs right at the threshold is ``RECALL``; closer pairs fare better. The recall is that
of pairs built at the threshold around sampled vectors, as a mean and rotation learned from others code them: after the mean is taken
off, pairs are further apart than their cosine says.

Equal vectors are one class with a size, so copies of one vector never meet each other.

Defined results: a vector that is null, empty, zero, or that holds a null or a component that is not finite
links with nothing, as does one without an id; it is kept. Vectors link with those of their own length, each
length is learned and searched by itself. Repeated rows link with each other. Columns besides id and vector play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import ship, written
from .hamming import Group, linked

COSINE = 0.9
SAMPLE = 8192
ROUNDS = 40
RECALL = 0.93
#: What a row of a Hamming table costs, in candidates.
ROW_COST = 200.0
GROUP_COUNTS = (1, 2, 3, 4, 5, 6, 8, 10, 12, 16)
#: Codes of a pair at the threshold differ in far fewer bits, of 64, unless the built pairs say otherwise.
MOST_SHARE = 0.45
PAIRS_AT_ONCE = 20_000
#: Pairs at the threshold that the groups are planned with.
PLANNED_PAIRS = 8192


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of unit length, in double precision."""
    n = len(column)
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    with np.errstate(over="ignore"):
        largest = np.abs(x).max(axis=1, keepdims=True) if n else x[:, :1]
    x = x / largest
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def learn(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): bits are the signs of ``(x - mean) @ projection``."""
    mean = x.mean(axis=0)
    centred = x - mean
    values, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, np.argsort(-values)][:, : min(64, x.shape[1])]
    v = centred @ axes
    rotation, _ = np.linalg.qr(np.random.default_rng(7).normal(size=(v.shape[1],) * 2))
    for _ in range(ROUNDS):
        signs = np.where(v @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ v)
        rotation = (left @ right).T
    return mean, axes @ rotation


def codes(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    bits = ((x - mean) @ projection >= 0).astype(np.uint8)
    full = np.zeros((len(x), 64), np.uint8)
    full[:, : bits.shape[1]] = bits
    return np.packbits(full, axis=1, bitorder="little").view(np.uint64).ravel()


def apart(x: np.ndarray, cosine: float, pairs: int = PLANNED_PAIRS) -> np.ndarray:
    """Bits that differ between vectors of ``x`` and others at this cosine, in any direction from them.

    Every second vector is learned from, for this only, and the pairs are built around the others: the signs of
    vectors that were learned from are steadier than those of the rest.
    """
    mean, projection = learn(x[::2])
    x = x[1::2] if len(x) > 1 else x
    x = x[np.arange(pairs) % len(x)]
    side = np.random.default_rng(11).normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-300)
    return codes(x, mean, projection) ^ codes(cosine * x + math.sqrt(1 - cosine**2) * side, mean, projection)


def met(differ: np.ndarray, groups: list[Group]) -> float:
    """Share of the pairs with these differing bits that meet in some group."""
    found = np.zeros(len(differ), bool)
    for g in groups:
        found |= np.bitwise_count(differ & g.mask(1)[0]) <= g.radius
    return float(found.mean())


def tables(n: int, bits: int, differ: np.ndarray, recall: float = RECALL) -> list[Group]:
    """The cheapest groups of bits in which the wanted share of pairs at the threshold (see ``apart``) meets."""
    best = None
    for m in (m for m in GROUP_COUNTS if m <= bits):
        widths = [bits // m + (i < bits % m) for i in range(m)]
        ends = np.cumsum(widths).tolist()
        for radius in range(4):
            cost = 0.0
            for w in widths:
                ball = sum(math.comb(w, t) for t in range(min(radius, w) + 1))
                cost += n * (1 + (ball - 1) / 2) * ROW_COST + n * n / 2 * ball / 2**w
            groups = [Group(tuple(range(e - w, e)), radius) for w, e in zip(widths, ends)]
            if (best is None or cost < best[0]) and met(differ, groups) >= recall:
                best = (cost, groups)
    return best[1] if best else [Group((), 0)]  # no group sorts out enough: all meet


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept."""
    ship(vectors.sparkSession)
    whole = vectors.select(F.col(key).cast("bigint").alias("key"), F.col(vector).alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    nonzero = F.exists("vector", lambda v: v != 0)
    usable = whole.where(F.col("key").isNotNull() & F.col("vector").isNotNull() & finite & nonzero)
    lengths = sorted(r.d for r in usable.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).where("n > 1").collect())
    named = [_named(usable.where(F.size("vector") == d), cosine, sample) for d in lengths]
    if not named:
        return whole.select(
            F.col("key").alias(key),
            F.lit(0).cast("bigint").alias("n_links"),
            F.col("key").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    # Every usable vector is in a class, but for those alone with their length; the others are in none.
    joined = whole.join(reduce(DataFrame.unionByName, named), (F.col("vector") == F.col("v")) & F.col("key").isNotNull(), "left")
    return joined.select(
        F.col("key").alias(key),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "key").alias("component_id"),
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _named(usable: DataFrame, cosine: float, sample: int) -> DataFrame:
    """(v, links, component_id) of each distinct vector among vectors of one length."""
    # Classes of equal vectors; the numbers are made once, in the written table.
    classes = usable.groupBy("vector").agg(F.min("key").alias("smallest"), F.count("*").alias("size"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    n = classes.count()
    # With fewer than a few samples' worth of vectors the share may be chance: then all of them are taken.
    limit = int((1.0 if n <= 2 * sample else sample / n) * (1 << 62)) - 1
    mean, projection, differ = _learned(classes.where(F.shiftrightunsigned(F.xxhash64("vector"), 2) <= limit), cosine)
    bits = projection.shape[1]
    groups = tables(n, bits, differ)
    most = max(1, int(MOST_SHARE * bits), int(np.bitwise_count(differ).max()))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = codes(matrix(b.column("vector")), mean, projection)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(c.view(np.int64))], names=[*b.schema.names, "code"])

    slim = classes.select("node", "size", "vector")
    kind = slim.schema["vector"].dataType.simpleString()
    items = slim.mapInArrow(coded, f"node bigint, size bigint, vector {kind}, code bigint")

    def rerank(columns: dict[str, pa.Array]):
        x = matrix(columns["vector"])

        def test(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            out = np.empty(len(i), bool)
            for k in range(0, len(i), PAIRS_AT_ONCE):
                a, b = i[k : k + PAIRS_AT_ONCE], j[k : k + PAIRS_AT_ONCE]
                out[k : k + PAIRS_AT_ONCE] = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
            return out

        return test

    links = written(linked(items, groups, most, rerank), "vector-links")
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    found = components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.select("node", "vector", "smallest", "size").join(counted, "node", "left").join(found, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    return named.join(least, "component").select(
        F.col("vector").alias("v"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"), "component_id"
    )


def _learned(chosen: DataFrame, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, projection and the bits of ``apart``, learned in one task over the bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [matrix(b.column("vector")) for b in batches if len(b)]
        if parts:
            x = np.concatenate(parts)
            x = x[np.lexsort(x.T)]  # whatever order they come in
            mean, projection = learn(x)
            flat = np.concatenate([mean, projection.ravel()])
            differ = apart(x, cosine).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(mean)], pa.int32()), pa.array([flat], pa.list_(pa.float64())), pa.array([differ], pa.list_(pa.int64()))], names=["d", "w", "differ"]
            )

    row = chosen.select("vector").repartition(1).mapInArrow(run, "d int, w array<double>, differ array<bigint>").collect()
    d, w = row[0].d, np.array(row[0].w)
    return w[:d], w[d:].reshape(d, -1), np.array(row[0].differ, np.int64).view(np.uint64)
