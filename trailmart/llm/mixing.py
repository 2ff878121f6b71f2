"""Mixing sources to target weights: fixed-length blocks, multinomial draws per shard, index permutations.

The words of a source, document after document, are cut into blocks of ``block`` words. The mix is a row of output
shards of ``slots`` blocks. Each shard draws how many of its slots go to each source from a multinomial with the
sources' shares; running totals over the shards number the slots of a source, and number ``i`` takes the block that
a pseudorandom permutation of the source's blocks has at ``i`` (a new permutation in each pass over the source).
Blocks and slots meet in a join by source and block number.

Draws scatter around the shares, so a source's slots may end before or after its target. Slots drawn beyond a
source's last one go to the sources that fell short, in order; the last block of a source is cut. So a source
gives exactly its target, rounded to whole words, and never more than ``cap`` passes over any document.

The sources and their weights are the configuration of a mix: the driver holds one row per source, and nothing
else that grows. A shard's draw depends on the seed and its number, a permutation on the seed, the source's name and
the pass: reruns agree whatever the cluster.

Defined results: a null text has no words; a null source is a source of its own and the last; a source without
words has target 0; null keys come first in their source; rows equal in source, key, size and text hash are laid
out one after the other, and which of them a cut block meets is not told apart. An empty table gives no rows. Other
columns are not read. A source with a third of all rows, or a third of all rows alike, is no task's own: see
``running``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .flat import SPACED, boundaries, flat
from .frames import ship, written
from .running import copies, offsets

BLOCK = 256
SLOTS = 1024
SEED = 20240501
#: Weights of the sources in order of their names, over and over; passes over a source at most.
WEIGHTS = (1, 2, 3)
CAP = 3
ROUNDS = 6

BLANKS = " \t\n\x0b\x0c\r"
IDENTITY = ("_source", "_key", "_size", "_hash")


def word_count(text: Column) -> Column:
    """Number of runs of other characters than ``[\\x20\\x09-\\x0D]``: each becomes one letter first."""
    start = F.ltrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(BLANKS))
    return F.length(F.regexp_replace(start, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")).cast("bigint")


def targets(sizes: Sequence[int], weights: Sequence[int], cap: int = CAP) -> list[Fraction]:
    """Shares of the whole size by weight; what a source cannot give ``cap`` times is shared out again."""
    left, free = Fraction(sum(sizes)), list(range(len(sizes)))
    out = [Fraction(0)] * len(sizes)
    while free:
        level = left / sum(weights[i] for i in free)
        full = {i for i in free if weights[i] * level > cap * sizes[i]}
        if not full:
            for i in free:
                out[i] = weights[i] * level
            break
        for i in full:
            out[i] = Fraction(cap * sizes[i])
            left -= out[i]
        free = [i for i in free if i not in full]
    return out


class Permutation:
    """A pseudorandom order of ``0 .. n - 1``: a Feistel network whose outputs beyond ``n`` go round again."""

    def __init__(self, n: int, key: int):
        self.n, self.half = n, max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = np.random.Generator(np.random.Philox(key=key)).integers(0, 1 << 63, ROUNDS, dtype=np.uint64)

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x ^ key) * np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        return (x >> np.uint64(33)) & np.uint64((1 << self.half) - 1)

    def _pass(self, x: np.ndarray, back: bool) -> np.ndarray:
        half = np.uint64(self.half)
        a, b = x >> half, x & np.uint64((1 << self.half) - 1)
        for key in self.keys[::-1] if back else self.keys:
            a, b = (b ^ self._round(a, key), a) if back else (b, a ^ self._round(b, key))
        return (a << half) | b

    def __call__(self, at: np.ndarray, back: bool = False) -> np.ndarray:
        out = self._pass(np.asarray(at, np.uint64), back)
        while len(far := np.flatnonzero(out >= self.n)):
            out[far] = self._pass(out[far], back)
        return out.astype(np.int64)


def _key(seed: int, *parts: object) -> int:
    return xxhash.xxh64_intdigest("|".join(map(str, parts)).encode(), seed)


@dataclass(frozen=True)
class Source:
    """A source's part of the mix. ``name`` is ``=`` and the name, or ``~`` for null: it sorts as sources do."""

    name: str
    size: int
    target: Fraction
    block: int
    seed: int

    @property
    def blocks(self) -> int:
        return -(-self.size // self.block)

    def order(self, turn: int) -> Permutation:
        return Permutation(self.blocks, _key(self.seed, self.name, turn))

    def length(self, block: np.ndarray) -> np.ndarray:
        return np.minimum(self.block, self.size - block * self.block)

    def slots(self) -> tuple[int, int]:
        """(slots, words of the last one) that give the target in whole words."""
        words = round(self.target)
        if not words:
            return 0, 0
        turns, rest = divmod(words, self.size)
        if not rest:
            slots = turns * self.blocks
            return slots, int(self.length(self.taken(np.array([slots - 1])))[0])
        # The rest of a pass: full blocks, but for the source's short one if it comes that early.
        at = int(self.order(turns)(np.array([self.blocks - 1]), back=True)[0])
        short = self.block - int(self.length(np.array(self.blocks - 1)))
        if rest > (at + 1) * self.block - short:
            rest += short
        elif rest > at * self.block:
            return turns * self.blocks + at + 1, rest - at * self.block
        n = -(-rest // self.block)
        return turns * self.blocks + n, rest - (n - 1) * self.block

    def taken(self, at: np.ndarray) -> np.ndarray:
        """Block of each slot number."""
        out = np.empty(len(at), np.int64)
        turn, place = np.divmod(at, self.blocks)
        for t in np.unique(turn):
            here = turn == t
            out[here] = self.order(int(t))(place[here])
        return out


def sized(docs: DataFrame, key: str, text: str, source: str, keep: bool = False) -> DataFrame:
    """(_source, _key, _size, _hash) of every document, and its ``_text`` if it is to be kept."""
    # '=' sorts before '~': the null source is the last.
    name = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("~"))
    body = F.col(text).cast("string")
    columns = [name.alias("_source"), F.col(key).alias("_key"), word_count(body).alias("_size"), F.xxhash64(body).alias("_hash")]
    return docs.select(*columns, *([body.alias("_text")] if keep else []))


def plan(rows: DataFrame, block: int = BLOCK, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> list[Source]:
    found = rows.groupBy("_source").agg(F.sum("_size").alias("size")).collect()  # one row per source
    found.sort(key=lambda r: r["_source"])
    sizes = [r["size"] for r in found]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], cap)
    return [Source(r["_source"], r["size"], t, block, seed) for r, t in zip(found, wanted)]


def laid_out(rows: DataFrame) -> DataFrame:
    """Place of every document among its source's words; equal rows are one with a number ``_n``."""
    folded = rows.where("_size > 0").groupBy(*IDENTITY).agg(F.count("*").alias("_n"))
    return offsets(folded, "_source", ["_key", "_size", "_hash"], F.col("_n") * F.col("_size"), "_start")


def pieces(places: DataFrame, block: int = BLOCK) -> DataFrame:
    """What each document puts into each block: (identity, _copy, _block, _first, _in, _words).

    ``_first`` is the piece's first word in the document, ``_in`` its place in the block.
    """
    rows = copies(places.withColumn("_copy", F.lit(0).cast("bigint")), "_n", "_copy")
    rows = rows.withColumn("_start", F.col("_start") + F.col("_copy") * F.col("_size"))
    end = F.col("_start") + F.col("_size")
    spans = F.sequence(F.floor(F.col("_start") / block), F.floor((end - 1) / block))
    rows = rows.select("*", F.explode(spans).alias("_block"))
    begin = F.greatest(F.col("_start"), F.col("_block") * block)
    return rows.select(
        *IDENTITY,
        "_copy",
        "_block",
        (begin - F.col("_start")).alias("_first"),
        (begin - F.col("_block") * block).alias("_in"),
        (F.least(end, (F.col("_block") + 1) * block) - begin).alias("_words"),
    )


def sources_table(spark: SparkSession, sources: list[Source]) -> DataFrame:
    """One written row per source: (_source, source_size, target, _slots)."""
    rows = [(s.name, s.size, float(s.target), s.slots()[0]) for s in sources]
    return written(spark.createDataFrame(rows, "_source string, source_size long, target double, _slots long"), "sources")


def drawn(spark: SparkSession, sources: list[Source], slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """Slots of the mix: (_shard, _place, _source, _block, _take); ``_take`` words of the block are used."""
    schema = "_shard long, _place int, _source string, _block long, _take long"
    names = [s.name for s in sources]
    counts, last = np.array([s.slots() for s in sources], np.int64).reshape(-1, 2).T
    total = int(counts.sum())
    if not total:
        return spark.createDataFrame([], schema)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                rng = np.random.Generator(np.random.Philox(key=_key(seed, "shard", shard)))
                n = rng.multinomial(min(slots, total - shard * slots), counts / total)
                some = np.flatnonzero(n)
                columns = [np.full(len(some), shard), np.array(names, object)[some], n[some], (np.cumsum(n) - n)[some]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_shard", "_source", "_n", "_before"])

    ship(spark)
    draws = spark.range(-(-total // slots)).mapInArrow(draw, "_shard long, _source string, _n long, _before long")
    draws = written(offsets(draws, "_source", ["_shard"], F.col("_n"), "_start"), "draws")
    ends = {r["_source"]: r["end"] for r in draws.groupBy("_source").agg(F.sum("_n").alias("end")).collect()}  # a row per source
    ended = np.array([ends.get(n, 0) for n in names], np.int64)
    missing = np.maximum(counts - ended, 0)
    before = np.cumsum(missing) - missing

    # Slots beyond their source's last one are numbered over all shards, and dealt to the sources that fell short.
    limits = sources_table(spark, sources).select("_source", "_slots")
    beyond = F.least("_n", F.greatest(F.col("_start") + F.col("_n") - F.col("_slots"), F.lit(0)))
    draws = draws.join(limits, "_source").withColumn("_beyond", beyond).withColumn("_all", F.lit(""))
    over = offsets(draws.where("_beyond > 0"), "_all", ["_shard", "_source"], F.col("_beyond"), "_moved")
    draws = draws.where("_beyond = 0").withColumn("_moved", F.lit(0).cast("bigint")).unionByName(over)
    number = {n: i for i, n in enumerate(names)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            n, own = row["_n"], row["_n"] - row["_beyond"]
            source, at = np.full(n, number[row["_source"]]), row["_start"] + np.arange(n)
            moved = row["_moved"] + np.arange(n - own)
            source[own:] = np.searchsorted(before + missing, moved, "right")
            at[own:] = ended[source[own:]] + moved - before[source[own:]]
            block, take = np.empty(n, np.int64), np.empty(n, np.int64)
            for s in np.unique(source):
                here = source == s
                block[here] = sources[s].taken(at[here])
                take[here] = sources[s].length(block[here])
                take[here & (at == counts[s] - 1)] = last[s]
            order = Permutation(min(slots, total - row["_shard"] * slots), _key(seed, "places", row["_shard"]))
            spots = order(row["_before"] + np.arange(n)).astype(np.int32)
            columns = [np.full(n, row["_shard"]), spots, np.array(names, object)[source], block, take]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_shard", "_place", "_source", "_block", "_take"])

    return draws.drop("_slots", "_all").mapInArrow(place, schema)


def taken(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    block: int = BLOCK, slots: int = SLOTS, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: int = SEED,
) -> DataFrame:
    """One row per document: key, size, source_size, target (its source's), taken (words the mix takes)."""
    spark = docs.sparkSession
    rows = written(sized(docs, key, text, source), "sizes")
    sources = plan(rows, block, weights, cap, seed)
    met = pieces(laid_out(rows), block).join(drawn(spark, sources, slots, seed), ["_source", "_block"], "left")
    words = F.greatest(F.least("_words", F.col("_take") - F.col("_in")), F.lit(0))
    used = met.groupBy(*IDENTITY, "_copy").agg(F.sum(F.when(F.col("_take").isNotNull(), words).otherwise(0)).alias("taken"))
    empty = rows.where("_size = 0").select(*IDENTITY, F.lit(0).cast("bigint").alias("taken"))
    out = used.drop("_copy").unionByName(empty).join(sources_table(spark, sources), "_source")
    return out.select(F.col("_key").alias(key), F.col("_size").alias("size"), "source_size", "target", "taken")


def mixed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    block: int = BLOCK, slots: int = SLOTS, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: int = SEED,
) -> DataFrame:
    """The mix itself, one row per piece of a document in a slot: (shard, place, at, key, first, words, text).

    ``at`` is the piece's place in its slot, ``first`` its first word in the document. The text is as it stands
    there from its first word to its last; where the last block of a source is cut, its words are joined by blanks.
    """
    spark = docs.sparkSession
    rows = written(sized(docs, key, text, source), "sizes")
    sources = plan(rows, block, weights, cap, seed)
    texts = sized(docs, key, text, source, keep=True).where("_size > 0").groupBy(*IDENTITY).agg(F.first("_text").alias("_text"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"t.{c}")) for c in IDENTITY]
    places = laid_out(rows).alias("p").join(texts.alias("t"), same).select("p._source", "p._key", "p._size", "p._n", "p._start", "t._text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat(batch.column("_text"))
            starts, ends, text_of = boundaries(SPACED[data], at)
            first_word = np.searchsorted(text_of, np.arange(len(batch)))
            for row, name, size, n, start, word in zip(
                range(len(batch)), *(batch.column(c).to_pylist() for c in ("_source", "_size", "_n", "_start")), first_word.tolist()
            ):
                for begin in range(start, start + n * size, size):
                    edges = np.r_[begin, np.arange((begin // block + 1) * block, begin + size, block), begin + size]
                    a, b = edges[:-1], edges[1:]
                    spans = zip((starts[word + a - begin]).tolist(), (ends[word + b - 1 - begin]).tolist())
                    columns = [
                        pa.array([name] * len(a)), pa.array(a // block), pa.array(a % block), pa.array(a - begin), pa.array(b - a),
                        batch.column("_key").take(pa.array([row] * len(a))), pa.array([data[i:j].tobytes().decode() for i, j in spans]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["_source", "_block", "_in", "_first", "_words", "_key", "_text"])

    kind = rows.schema["_key"].dataType.simpleString()
    ship(spark)
    cuts = places.mapInArrow(cut, f"_source string, _block long, _in long, _first long, _words long, _key {kind}, _text string")
    met = cuts.join(drawn(spark, sources, slots, seed), ["_source", "_block"])
    used = F.least(F.col("_words"), F.col("_take") - F.col("_in"))
    whole = F.array_join(F.slice(F.split("_text", r"[\x20\x09-\x0D]+"), 1, used.cast("int")), " ")
    return met.where(used > 0).select(
        F.col("_shard").alias("shard"),
        F.col("_place").alias("place"),
        F.col("_in").alias("at"),
        F.col("_key").alias(key),
        F.col("_first").alias("first"),
        used.alias("words"),
        F.when(used < F.col("_words"), whole).otherwise(F.col("_text")).alias("text"),
    )
