"""Pairs of codes of 64 bits, or of several such words, that agree, up to a few bits, in one of several groups of bits.

Every code goes to the bucket of its bits in each group, and as a guest to the buckets that differ in up to
the group's radius (upwards only, so a pair meets once). Buckets are shuffled and sorted; a task walks over
them in runs of rows and tests the pairs of a bucket in numpy. What leaves a task is at most one row for each
row that came in: links as a spanning forest, and the number of links. A pair counts in the first group in
which it meets, so it counts once.

A bucket above ``BUCKET_ROWS`` rows is cut into blocks; each two blocks meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import ship

BUCKET_ROWS = 4096
PAIRS_AT_ONCE = 1_000_000
#: Pairs that a test sees before those joined meanwhile are left out, where only the joining counts.
TESTED_AT_ONCE = 4096
#: Most oversized buckets whose list is broadcast; a longer list is joined by a shuffle.
LISTED_BUCKETS = 100_000


@dataclass(frozen=True)
class Group:
    """Bit positions and the number of them that may differ; -1: the group is not looked at."""

    bits: tuple[int, ...]
    radius: int

    def mask(self, words: int) -> np.ndarray:
        out = [0] * words
        for b in self.bits:
            out[b >> 6] |= 1 << (b & 63)
        return np.array(out, np.uint64)

    def values(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes), np.int64)
        for i, b in enumerate(self.bits):
            out |= ((codes[:, b >> 6] >> np.uint64(b & 63)) & np.uint64(1)).astype(np.int64) << i
        return out

    def flips(self) -> list[int]:
        wide = range(len(self.bits))
        return [sum(1 << i for i in c) for k in range(1, self.radius + 1) for c in combinations(wide, k)]


def codes_of(column: pa.Array) -> np.ndarray:
    """Codes as rows of 64-bit words; the column holds whole numbers, or binary values of one length."""
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, 1)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def bits_set(words: np.ndarray) -> np.ndarray:
    if words.shape[1] == 1:
        return np.bitwise_count(words[:, 0])
    return np.bitwise_count(words).sum(axis=1, dtype=np.int64)


def merged(n: int, left: np.ndarray, right: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Smallest reachable row of each row, after adding these links to what ``label`` joins already."""
    while len(left):
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            break
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(label, high, low)
        while True:
            jump = label[label]
            if (jump == label).all():
                break
            label = jump
    return label


def tested(label: np.ndarray, left: np.ndarray, right: np.ndarray, test: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """``label`` after adding the pairs that pass the test; a pair that is joined already needs none."""
    while len(left):
        apart = label[left] != label[right]
        left, right = left[apart], right[apart]
        i, j = left[:TESTED_AT_ONCE], right[:TESTED_AT_ONCE]
        left, right = left[TESTED_AT_ONCE:], right[TESTED_AT_ONCE:]
        if len(i):
            good = test(i, j)
            label = merged(len(label), i[good], j[good], label)
    return label


def bucket_rows(items: DataFrame, groups: list[Group]) -> DataFrame:
    """Rows (part, bucket, home, and the item's columns) for each bucket an item is in."""
    ship(items.sparkSession)
    names = items.columns
    looked = [(p, g) for p, g in enumerate(groups) if g.radius >= 0]
    flips = {p: g.flips() for p, g in looked}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), 2000):
                batch = whole.slice(begin, 2000)
                codes = codes_of(batch.column("code"))
                for p, g in looked:
                    home = g.values(codes)
                    at = [np.arange(len(codes))]
                    bucket = [home]
                    for f in flips[p]:
                        up = np.flatnonzero((home ^ f) > home)
                        at.append(up)
                        bucket.append(home[up] ^ f)
                    rows = pa.array(np.concatenate(at))
                    is_home = np.arange(len(rows)) < len(codes)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), p, np.int32)),
                            pa.array(np.concatenate(bucket)),
                            pa.array(is_home),
                            *[c.take(rows) for c in batch.columns],
                        ],
                        names=["part", "bucket", "home", *names],
                    )

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema)
    return items.mapInArrow(run, f"part int, bucket bigint, home boolean, {kept}")


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows with the two blocks (low, high) that meet, and the row's own block; 0 where a bucket is small."""
    large = rows.groupBy("part", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_ROWS)
    large = large.select("part", "bucket", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("blocks"))
    short = large.limit(LISTED_BUCKETS + 1).count()
    if short == 0:
        zero = F.lit(0)
        return rows.select("*", zero.alias("block"), zero.alias("low"), zero.alias("high"))
    side = F.broadcast(large) if short <= LISTED_BUCKETS else large
    cut = rows.join(side, ["part", "bucket"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = cut.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.withColumns({"low": F.least("block", "met"), "high": F.greatest("block", "met")}).drop("blocks", "met")


def linked(
    items: DataFrame,
    groups: list[Group],
    most_bits: int,
    verify: Callable[[dict[str, pa.Array]], Callable[[np.ndarray, np.ndarray], np.ndarray]] | None = None,
) -> DataFrame:
    """(node, other, links): each node with a link to one row's ``other`` and its part of the link count.

    ``items`` has ``node`` and ``code`` (whole numbers), ``size`` (how many it stands for) and what ``verify``
    reads: given the columns of a run of rows it returns a test of row numbers against row numbers. Rows of one
    node must be summed over; the pairs (node, other) join all that is linked.
    """
    return linked_in_buckets(_blocks(bucket_rows(items, groups)), groups, most_bits, verify)


def linked_in_buckets(
    rows: DataFrame,
    groups: list[Group],
    most_bits: int,
    verify: Callable[[dict[str, pa.Array]], Callable[[np.ndarray, np.ndarray], np.ndarray]] | None = None,
    forest: bool = False,
) -> DataFrame:
    """As ``linked``, of rows that have their bucket and blocks. With ``forest`` the links are not counted, and
    only pairs that are not joined yet are tested."""
    keys = ["part", "bucket", "low", "high"]

    def compare(table: pa.Table) -> pa.RecordBatch | None:
        part, bucket, low, high = (table.column(k).to_numpy() for k in keys)
        n = len(part)
        change = (part[1:] != part[:-1]) | (bucket[1:] != bucket[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        start = np.append(0, np.flatnonzero(change) + 1)
        size = np.diff(np.append(start, n))
        later = np.repeat(start + size, size) - np.arange(n) - 1  # rows after each row in its bucket
        home = table.column("home").to_numpy(zero_copy_only=False)
        block = table.column("block").to_numpy()
        node = table.column("node").to_numpy()
        weight = table.column("size").to_numpy()
        codes = codes_of(table.column("code").combine_chunks())
        words = codes.shape[1]
        masks = [(g.mask(words), g.radius) for g in groups]
        at_once = PAIRS_AT_ONCE // words
        test = verify({c: table.column(c).combine_chunks() for c in table.column_names}) if verify else None
        label, links = np.arange(n), np.zeros(n, np.int64)
        total = np.cumsum(later)
        begin = 0
        while begin < n:
            before = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + at_once, "right")))
            count = later[begin:end]
            i = np.repeat(np.arange(begin, end), count)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
            begin = end
            good = (home[i] | home[j]) & ((low[i] == high[i]) | (block[i] != block[j]))
            i, j = i[good], j[good]
            apart = codes[i] ^ codes[j]
            good = bits_set(apart) <= most_bits
            i, j, apart = i[good], j[good], apart[good]
            good = np.ones(len(i), bool)
            for p, (mask, radius) in enumerate(masks):  # met before in an earlier group
                if radius >= 0:
                    good &= ~((part[i] > p) & (bits_set(apart & mask) <= radius))
            i, j = i[good], j[good]
            if forest:
                label = tested(label, i, j, test)
                continue
            if test is not None and len(i):
                good = test(i, j)
                i, j = i[good], j[good]
            if len(i):
                links += np.bincount(i, weight[j], n).astype(np.int64) + np.bincount(j, weight[i], n).astype(np.int64)
                label = merged(n, i, j, label)
        if forest:
            links += label != np.arange(n)
        out = np.flatnonzero(links > 0)
        if not len(out):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(node[out]), pa.array(node[label[out]]), pa.array(links[out])], names=["node", "other", "links"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            ends = [table.column(k).to_numpy() for k in keys]
            last = np.ones(table.num_rows, bool)
            for x in ends:
                last &= x == x[-1]
            cut = table.num_rows - int(last.sum())  # the last bucket may go on in the next batch
            if cut:
                made = compare(table.slice(0, cut))
                if made is not None:
                    yield made
            rest = table.slice(cut).combine_chunks()
        if rest is not None and rest.num_rows:
            made = compare(rest)
            if made is not None:
                yield made

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "node bigint, other bigint, links bigint")
