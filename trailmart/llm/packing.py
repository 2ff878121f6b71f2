"""Best-fit packing by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens. How many pieces there are of each length is a table
of ``capacity`` numbers at most, whatever the number of documents, and that is all the packing needs to see:
for each bin a bitset subset-sum over the lengths still available, the longest one always included, finds the
fullest combination; the combination is used as often as its lengths last, so each step uses up a length and
there are at most ``capacity`` steps or so. What comes out is a list of patterns with counts.

Pieces of one length are alike, so each takes a place of its length by its rank among them. Ranks are given
in chunks of bounded size, so a length that a third of all pieces share is numbered by many tasks.

Defined results: null and empty texts are one end token; null or repeated keys are packed like others; an
empty table gives no rows. Input columns besides key and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .flat import slices
from .frames import ship, written

CAPACITY = 2048
END = 0
CHUNK_ROWS = 50_000


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, vocab: str | None = None, key: str = "doc_id", text: str = "text", ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids): each document with its end token, cut to size."""
    ship(docs.sparkSession)
    path = vocab or bpe.vocabulary()
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(path)
        for batch in batches:
            for rows in slices(batch, "text"):
                flat_ids, at = enc.encode_texts(rows.column("text"))
                flat_ids = np.insert(flat_ids, at[1:], END)
                at = at + np.arange(len(at))
                count = -(-np.diff(at) // capacity)
                owner = np.repeat(np.arange(len(count)), count)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                begin = at[owner] + number * capacity
                end = np.minimum(begin + capacity, at[owner + 1])
                words = flat_ids.astype("<u4")
                crcs = [bpe.crc32(words[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
                arrays = [rows.column("key").take(pa.array(owner)), number.astype(np.int32), begin - at[owner], end - begin, crcs]
                names = ["key", *[n for n, _ in fields]]
                made = [arrays[0], *[pa.array(x, kind) for x, (_, kind) in zip(arrays[1:], fields)]]
                if ids:
                    cuts = np.append(begin, len(flat_ids))
                    made.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat_ids, pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(made, names=names)

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if ids else "")
    return rows.mapInArrow(run, schema)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The combination of available lengths, the longest one among them, that leaves the least slack.

    Bit s of a set says that sum s can be reached. Each length is added in lots of 1, 2, 4, ... pieces;
    the sets after each lot lead back from the best sum to the lots.
    """
    lengths = sorted(counts, reverse=True)
    first = lengths[0]
    room = capacity - first
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for n in lengths:
        left = min(counts[n] - (n == first), room // n)
        lot = 1
        while left > 0 and not reach >> room & 1:
            take = min(lot, left)
            grown = (reach | reach << take * n) & full
            if grown != reach:
                steps.append((n, take, reach))
                reach = grown
            left -= take
            lot *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used = {first: 1}
    for n, take, before in reversed(steps):
        if not before >> total & 1:  # only with this lot
            used[n] = used.get(n, 0) + take
            total -= n * take
    return used


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(pieces of each length in a bin, number of such bins), until every piece has its place."""
    left = {n: c for n, c in counts.items() if c > 0}
    out = []
    while left:
        used = fullest(left, capacity)
        times = min(left[n] // k for n, k in used.items())
        out.append((used, times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return out


def places(made: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, first sequence, pieces per sequence, offset) for each pattern."""
    rows, rank, sequence = [], {}, 0
    for used, times in made:
        offset = 0
        for n, k in sorted(used.items(), reverse=True):
            first = rank.get(n, 0)
            rows.append((n, first, first + k * times, sequence, k, offset))
            rank[n] = first + k * times
            offset += n * k
        sequence += times
    return rows


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (with ``key, piece, length``) with sequence_id and offset."""
    spark = rows.sparkSession
    total = rows.count()
    chunks = max(1, -(-total // CHUNK_ROWS))
    placed = rows.withColumn("chunk", F.pmod(F.xxhash64("key", "piece", "ids_crc32"), F.lit(chunks)).cast("int"))
    sizes = placed.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    # One number for each possible length.
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(patterns(counts, capacity))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "chunk").orderBy("key", "piece", "ids_crc32")
    ranked = placed.withColumn("nth", F.row_number().over(order)).join(offsets, ["length", "chunk"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("nth") - 1)
    # The places of a length, as one array per length: at most ``capacity`` rows, a few thousand places.
    side = (
        spark.createDataFrame(table, "length bigint, low bigint, high bigint, sequence bigint, per bigint, at bigint")
        .groupBy("length")
        .agg(F.array_sort(F.collect_list(F.struct("low", "high", "sequence", "per", "at"))).alias("places"))
    )
    found = ranked.join(F.broadcast(side), "length").withColumn(
        "p", F.expr("element_at(filter(places, p -> rank >= p.low and rank < p.high), 1)")
    )
    k = F.col("rank") - F.col("p.low")
    return found.select(
        *rows.columns,
        (F.col("p.sequence") + F.floor(k / F.col("p.per"))).cast("bigint").alias("sequence_id"),
        (F.col("p.at") + k % F.col("p.per") * F.col("length")).cast("bigint").alias("offset"),
    )


def packed(docs: DataFrame, capacity: int = CAPACITY, vocab: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and its place there. Ids are made once, their digests kept."""
    cut = written(pieces(docs, capacity, vocab, key, text), "pieces")
    out = pack(cut, capacity)
    return out.withColumnRenamed("key", key)


def sequences(docs: DataFrame, capacity: int = CAPACITY, vocab: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (the pieces' ids in order), doc_ids."""
    cut = written(pieces(docs, capacity, vocab, key, text, ids=True), "pieces")
    by_place = F.array_sort(F.collect_list(F.struct("offset", "ids", "key")))
    rows = pack(cut, capacity).groupBy("sequence_id").agg(by_place.alias("parts"))  # at most ``capacity`` parts
    return rows.select(
        "sequence_id",
        F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p["key"]).alias("doc_ids"),
    )
