"""Exact deduplication by two-pass Bloom filtering, in DataFrame operations only.

Pass one sets two bits per digest and keeps those positions that were hit at least twice: a Bloom filter
of what may be repeated. Pass two tests every digest against it. Rows that fail are alone for certain and
pass straight through; only the others shuffle, and an exact grouping decides about them. The filter has a
fixed number of bits, so its broadcast is bounded: at most ``bits / 64`` words of 16 bytes. With more rows
than it has bits for, more rows shuffle; the result stays exact.

Defined results: a null text counts as empty; empty texts equal each other; a null key sorts after all
others, and rows that share both text and key stay or go together, since nothing tells them apart. A text that
a third of all rows share is one row per task where it is counted; where its rows meet their group, adaptive
joins split it. ``decisions`` reads key and text only; ``deduplicated`` carries all columns as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import fresh, written

FILTER_BITS = 1 << 26


def normalised(text: Column) -> Column:
    """Each run of blanks, tabs and line ends becomes one blank. A lone blank needs no replacing."""
    blank = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), blank, " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def _positions(sha: Column, bits: int) -> tuple[Column, Column]:
    h = F.xxhash64(sha)
    return h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))


def repeated_filter(digests: DataFrame, sha: str, bits: int = FILTER_BITS) -> DataFrame:
    """64-bit words of the filter of positions that were hit more than once (only words with a bit set)."""
    hits = digests.select(F.explode(F.array(*_positions(F.col(sha), bits))).alias("at"))
    twice = hits.groupBy("at").agg(F.count("*").alias("n")).where("n > 1")
    return twice.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")
    )


def split_by_filter(rows: DataFrame, sha: str, words: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows alone for certain, rows possibly repeated)."""
    names = [fresh(rows, n) for n in ("_w1", "_b1", "_w2", "_b2")]
    tested = rows
    hit = F.lit(True)
    for at, word, mask in zip(_positions(F.col(sha), bits), names[::2], names[1::2]):
        side = words.select(F.col("word").alias(word), F.col("bits").alias(mask))
        tested = tested.join(F.broadcast(side), F.shiftright(at, 6) == F.col(word), "left")
        bit = F.call_function("shiftrightunsigned", F.col(mask), at.bitwiseAND(F.lit(63)).cast("int"))
        hit = hit & (F.coalesce(bit, F.lit(0)).bitwiseAND(F.lit(1)) == 1)
    return tested.where(~hit).drop(*names), tested.where(hit).drop(*names)


def _groups(maybe: DataFrame, sha: str, key: str) -> DataFrame:
    """Smallest key and size of each text; summed in each task before the shuffle."""
    return maybe.groupBy(F.col(sha).alias("_sha")).agg(F.min(key).alias("_keep"), F.count("*").alias("_n"))


def decisions(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, text_sha256. The texts are read once."""
    digests = written(docs.select(F.col(key), digest(F.col(text)).alias("_text")), "digests")
    sure, maybe = split_by_filter(digests, "_text", repeated_filter(digests, "_text", bits), bits)
    joined = maybe.join(_groups(maybe, "_text", key), F.col("_text") == F.col("_sha"))
    return _outcome(sure, F.col(key), F.lit(1).cast("bigint"), key).unionByName(
        _outcome(joined, F.col("_keep"), F.col("_n"), key)
    )


def _outcome(rows: DataFrame, keep: Column, size: Column, key: str) -> DataFrame:
    return rows.select(
        F.col(key),
        keep.alias("keep_id"),
        size.alias("group_size"),
        F.col(key).eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("_text")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """The rows that stay, with all their columns. Whole rows shuffle only where the filter fires."""
    sha = fresh(docs, "_text")
    digests = written(docs.select(F.col(key).alias("_key"), digest(F.col(text)).alias("_text")), "digests")
    words = repeated_filter(digests, "_text", bits)
    _, maybe = split_by_filter(digests, "_text", words, bits)
    smallest = _groups(maybe, "_text", "_key").select(F.col("_sha").alias("_s"), F.col("_keep").alias("_k"))
    names = [fresh(docs, n) for n in ("_s", "_k")]
    smallest = smallest.toDF(*names)
    rows = docs.withColumn(sha, digest(F.col(text)))
    sure, possible = split_by_filter(rows, sha, words, bits)
    stays = possible.join(smallest, F.col(sha).eqNullSafe(F.col(names[0])) & F.col(key).eqNullSafe(F.col(names[1])))
    return sure.select(*docs.columns).unionByName(stays.select(*docs.columns))
