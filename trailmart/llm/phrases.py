"""Phrase collocations by dynamic itemset counting.

The documents are dealt to a few shards, which are scanned in turn, round and round. Words are counted from the
first scan on. As soon as both phrases of ``k - 1`` words inside a phrase of ``k`` words have reached the threshold,
in the scans so far, the longer one is active from the next scan on, is counted in one full cycle of shards, and then
has its exact count. So lengths interleave: no length waits until the one before it is complete.

A scan looks up when the shorter phrases were reached in a table of one byte for each of a fixed number of slots a length,
by hash, that every task has. Phrases that share a slot count from the scan in which the first of them was reached on. That
can only make a longer phrase active too early, and always in the same scan: it is still counted in exactly one cycle,
so all counts are exact whatever the hashes do, and with more reached phrases than slots more phrases are counted in
vain. Counts are summed in each task, then over all tasks, and added to the state, a table; phrases that complete
their cycle below the threshold leave it. Whatever the number of shards, the counts are those of the whole table.

Nearly all phrases that are counted stay below the threshold, so the scans count hashes of 64 bits and move no text.
Phrases with one hash count together there, which never takes one below its own count. One last scan of all shards
counts the phrases in reached slots by their words; only its counts are returned, and no hash decides them.

Defined results: a null language is ``und``; a null text has no words; phrases end at ``[.,;:!?\\x0A-\\x0D]`` and at the
end of a text, words at ``[\\x20\\x09]``; repeated rows count each time; an empty table, or one without a phrase at the
threshold, gives no rows. Ties in the score go to the larger count, then to the phrase in UTF-8 order. Other columns
are not read. A very long text is counted in one piece of memory of some twenty bytes for each of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .flat import boundaries, byte_table, flat, hashes, mixed
from .frames import ship, written

THRESHOLD = 100
LONGEST = 5
TOP = 2000
#: Shards of a cycle.
SHARDS = 3
#: Text bytes counted at a time in a task.
CHUNK = 2_000_000
#: Slots of the table of reached phrases for each length: a power of two, one byte each.
SLOTS = 1 << 22
#: No scan: there are fewer than 255.
NEVER = 255
#: Parts that are ranked by themselves before a language's first rows are.
RANK_PARTS = 64

PIECE_ENDS = b".,;:!?\n\v\f\r"
WORDS = byte_table(PIECE_ENDS + b" \t")
ENDS = np.isin(np.arange(256), list(PIECE_ENDS))
HASHED = "k int, hash long, active int, n long"
COUNTED = "lang string, k int, phrase string, active int, n long"


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    data, at = flat(langs)
    coded = np.append(data, 0).astype(np.uint16) + 1
    # Mixed once more: a language named like a word must not have that word's hash.
    return mixed(~hashes(coded, at[:-1], at[1:]))


def _longer(shorter: np.ndarray, words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of ``k`` words from each place, from those of ``k - 1`` words and of single words."""
    n = max(0, len(words) - k + 1)
    return mixed(shorter[:n] * np.uint64(0x9E3779B97F4A7C15) + words[k - 1 : k - 1 + n])


class Chunk:
    """The words of some texts: hashes, and how many follow in the same piece."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        data, at = flat(texts)
        coded = WORDS[data]
        starts, ends, text = boundaries(coded, at)
        self.langs = langs.dictionary_encode()
        self.lang = self.langs.indices.to_numpy(zero_copy_only=False)[text]
        self.numbered: pa.DictionaryArray | None = None
        self.coded, self.lengths = coded, ends - starts
        self.hash = mixed(hashes(coded, starts, ends) + _lang_hashes(self.langs.dictionary)[self.lang])
        # Words up to the end of the piece, from each word on, counted up to LONGEST.
        passed = np.zeros(len(data) + 1, np.int32)
        np.cumsum(ENDS[data], out=passed[1:])
        piece = passed[starts]
        goes_on = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
        self.room = np.ones(len(starts), np.int8)
        for k in range(2, LONGEST + 1):
            n = len(starts) - k + 1
            if n > 0:
                self.room[:n] += goes_on[k - 2 :] & (self.room[:n] == k - 1)

    @cached_property
    def words(self) -> pa.Array:
        spelled = (self.coded[self.coded != 0] - 1).astype(np.uint8)
        offsets = np.zeros(len(self.lengths) + 1, np.int64)
        np.cumsum(self.lengths, out=offsets[1:])
        return pa.Array.from_buffers(pa.large_string(), len(self.lengths), [None, pa.py_buffer(offsets), pa.py_buffer(spelled)])

    def phrases(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length: hashes of the phrases from each word on, and whether the piece goes on that far."""
        whole = self.hash
        for k in range(1, longest + 1):
            whole = _longer(whole, self.hash, k) if k > 1 else whole
            yield k, whole, self.room[: len(whole)] >= k

    def totals(self) -> pa.RecordBatch:
        n = np.bincount(self.lang, minlength=len(self.langs.dictionary))
        return _counted(self.langs.dictionary, 0, pa.array([""] * len(n)), np.zeros(len(n), np.int32), n)

    def counts(self, k: int, places: np.ndarray, keys: np.ndarray, active: np.ndarray) -> pa.RecordBatch:
        """Number of each phrase of ``k`` words at ``places``; ``keys`` are the phrases' hashes."""
        if self.numbered is None and k > 1 and len(places) < len(self.words) // 4:
            needed = np.zeros(len(self.words), bool)
            for j in range(k):
                needed[places + j] = True
            words = self.words.filter(pa.array(needed)).dictionary_encode()
            number = words.indices.to_numpy(zero_copy_only=False)[np.cumsum(needed, dtype=np.int32) - 1]
        else:
            words = self.numbered = self.words.dictionary_encode() if self.numbered is None else self.numbered
            number = words.indices.to_numpy(zero_copy_only=False)
        rows = [self.lang[places], *(number[places + j] for j in range(k))]
        which = pa.array(keys).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        n = np.bincount(which)
        first = np.empty(len(n), np.int64)
        first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        if not all((r[first][which] == r).all() for r in rows):  # two phrases with one hash
            _, first, n = np.unique(np.stack(rows), axis=1, return_index=True, return_counts=True)
        parts = [words.dictionary.take(pa.array(r[first])) for r in rows[1:]]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if k > 1 else parts[0]
        return _counted(self.langs.dictionary.take(pa.array(rows[0][first])), k, phrase, active[first], n)


def _hashed(k: int, keys: np.ndarray, active: int) -> pa.RecordBatch:
    found = pc.value_counts(pa.array(keys.view(np.int64)))
    same = [pa.array(np.full(len(found), v, np.int32)) for v in (k, active)]
    return pa.RecordBatch.from_arrays([same[0], found.field("values"), same[1], found.field("counts")], ["k", "hash", "active", "n"])


def _counted(lang: pa.Array, k: int, phrase: pa.Array, active: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [lang.cast(pa.string()), pa.array(np.full(len(n), k, np.int32)), phrase.cast(pa.string()), pa.array(active), pa.array(n)]
    return pa.RecordBatch.from_arrays(columns, ["lang", "k", "phrase", "active", "n"])


class Reached:
    """In which scan the first phrase of each slot reached the threshold; ``NEVER`` before that. Every length has its slots.

    A slot keeps its first scan for good, so what is looked up for a phrase never changes once it is there.
    """

    def __init__(self, slots: int):
        self.slots = slots
        self.scan = np.full(LONGEST * slots, NEVER, np.uint8)

    def __getstate__(self) -> tuple:
        at = np.flatnonzero(self.scan != NEVER)
        return (self.slots, at.astype(np.uint32), self.scan[at])

    def __setstate__(self, state: tuple) -> None:
        self.__init__(state[0])
        self.scan[state[1]] = state[2]

    def of(self, k: int, h: np.ndarray) -> np.ndarray:
        return self.scan[(k - 1) * self.slots : k * self.slots][h & np.uint64(self.slots - 1)]

    def add(self, state: DataFrame, scan: int) -> None:
        """Slots of the phrases that ``state`` has as reached in ``scan``."""
        new = state.where(F.col("reached") == scan)
        at = new.select((F.col("hash").bitwiseAND(F.lit(self.slots - 1)) + (F.col("k") - 1).cast("bigint") * self.slots).alias("at"))
        rows = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(at & 63))")).alias("bits"))
        table = rows.toArrow()  # at most one row for 64 slots
        bits = table.column("bits").to_numpy().view(np.uint64)
        at = table.column("word").to_numpy()[:, None] * 64 + np.arange(64)
        at = at[((bits[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(bool)]
        self.scan[at[self.scan[at] == NEVER]] = scan


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    def chunk(held: list[pa.RecordBatch]) -> Chunk:
        table = pa.Table.from_batches(held).combine_chunks()
        return Chunk(table.column("lang").combine_chunks(), table.column("text").combine_chunks())

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK:
            yield chunk(held)
            held, size = [], 0
    if held:
        yield chunk(held)


def _by_hash(chunk: Chunk, step: int, shards: int, reached: Reached, lengths: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """(k, hash, active, n): words in the first cycle, and the phrases active in scan ``step``."""
    shorter = chunk.hash
    for k, whole, fits in chunk.phrases(max(lengths, default=1)):
        if k == 1 and step < shards:
            yield _hashed(1, whole, 0)
        if k in lengths and len(whole):
            scan = reached.of(k - 1, shorter[: len(whole) + 1])
            later = np.where(fits, np.maximum(scan[:-1], scan[1:]), NEVER)
            # Active from the scan after the later one of both shorter phrases, for one cycle. Each such scan has rows of its
            # own, so that phrases with one hash have whole cycles.
            for since in range(max(0, step - shards), step):
                keys = whole[later == since]
                if len(keys):
                    yield _hashed(k, keys, since + 1)
        shorter = whole


def _by_words(chunk: Chunk, reached: Reached) -> Iterator[pa.RecordBatch]:
    """(lang, k, phrase, active, n): all words of each language, and the phrases in reached slots."""
    yield chunk.totals()
    for k, whole, fits in chunk.phrases(LONGEST):
        places = np.flatnonzero(fits & (reached.of(k, whole) != NEVER))
        if len(places):
            yield chunk.counts(k, places, whole[places], np.zeros(len(places), np.int32))


def _scan(shard: DataFrame, step: int, shards: int, reached: Broadcast, lengths: Sequence[int]) -> DataFrame:
    """(k, hash, active, n), several rows a hash: words in the first cycle, and the phrases active in this scan.

    ``lengths`` are those that can be active.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            yield from _by_hash(chunk, step, shards, reached.value, lengths)

    return shard.mapInArrow(count, HASHED)


def _exact(dealt: DataFrame, reached: Broadcast, threshold: int) -> DataFrame:
    """(lang, k, phrase, n) of the phrases that reach the threshold, and of all words as ``k`` 0: counted by words, not hashes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            yield from _by_words(chunk, reached.value)

    counts = dealt.select("lang", "text").mapInArrow(count, COUNTED).groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
    return counts.where((F.col("k") == 0) | (F.col("n") >= threshold))


def _part(phrase: Column, words: Column) -> Column:
    """The first ``words`` words of a phrase; the last ones where ``words`` is negative."""
    return F.call_function("substring_index", phrase, F.lit(" "), words)


def _next_state(state: DataFrame, found: DataFrame, step: int, threshold: int, shards: int) -> DataFrame:
    """The state after scan ``step``: counts added, what is reached now, without what has failed."""
    new = found.select("k", "hash", "active", F.lit(None).cast("int").alias("reached"), "n")
    rows = state.unionByName(new).groupBy("k", "hash", "active").agg(F.max("reached").alias("reached"), F.sum("n").alias("n"))
    rows = rows.withColumn("reached", F.coalesce("reached", F.when(F.col("n") >= threshold, F.lit(step))))
    stays = (F.col("active") + (shards - 1) > step) | F.col("reached").isNotNull()
    return rows.where(stays).select("k", "hash", "active", "reached", "n")


def frequent(
    docs: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD, shards: int = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """Phrases of up to ``LONGEST`` words with their exact counts, ``(lang, k, phrase, n)``; ``k`` 0 is all words of a language."""
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    rows.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")).write.partitionBy("shard").parquet(path)
    dealt = spark.read.schema("lang string, text string, shard int").parquet(path)
    ship(spark)
    state = spark.createDataFrame([], "k int, hash long, active int, reached int, n long")
    reached, lengths, step = Reached(slots), [], 0
    # A phrase reached in scan r makes longer ones active from r + 1 to r + shards.
    while step < shards or lengths:
        shard = dealt.where(F.col("shard") == step % shards).select("lang", "text")
        found = _scan(shard, step, shards, spark.sparkContext.broadcast(reached), lengths)
        state = written(_next_state(state, found, step, threshold, shards), "state")
        reached.add(state, step)
        step += 1
        recent = state.where((F.col("reached") >= step - shards) & (F.col("k") < LONGEST)).select("k").distinct()
        lengths = sorted(r.k + 1 for r in recent.collect())
    return written(_exact(dealt, spark.sparkContext.broadcast(reached), threshold), "counts")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, k, phrase, a, l, r, n, score) of every phrase of two words or more: its worst cut, the first of equal ones.

    Products are whole decimals of up to 38 digits.
    """
    phrases = counts.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))
    cut = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    for name, part in (("l", _part(F.col("phrase"), F.col("cut"))), ("r", _part(F.col("phrase"), F.col("cut") - F.col("k")))):
        side = counts.where("k > 0").select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("n").alias(name))
        cut = cut.join(side, (F.col("lang") == F.col("_lang")) & (part == F.col("_phrase"))).drop("_lang", "_phrase")
    totals = written(counts.where("k = 0").select("lang", "n"), "word-totals")
    cut = cut.join(totals, "lang")
    score = F.expr("(cast(a * 1000 as decimal(20)) * cast(n as decimal(18))) div (cast(l as decimal(18)) * cast(r as decimal(18)))")
    worst = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("worst")
    best = cut.groupBy("lang", "k", "phrase", "a", "n").agg(worst)
    return best.select("lang", "k", "phrase", "a", "worst.l", "worst.r", "n", "worst.score")


def without_parts(phrases: DataFrame) -> DataFrame:
    """Phrases that have more occurrences than every longer phrase they are part of."""
    inside = F.expr(
        "explode(flatten(transform(sequence(2, k - 1), m -> transform(sequence(0, k - m), "
        "at -> substring_index(substring_index(phrase, ' ', at + m), ' ', -m)))))"
    )
    longer = phrases.where("k > 2").select("lang", inside.alias("phrase"), F.col("a").alias("_longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    return phrases.join(longer, ["lang", "phrase"], "left").where("_longer is null or _longer < a").drop("_longer")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD, top: int = TOP, shards: int = SHARDS
) -> DataFrame:
    """Each language's first phrases by score: (lang, rank, phrase, a, l, r, n, score)."""
    rows = without_parts(written(scored(frequent(docs, text, lang, threshold, shards)), "scored"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold nearly all phrases: its first rows are among the first of each part.
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    rows = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
