"""N-gram language model: counts over all training texts, kept in Elias-Fano coded tries, one per shard.

A bigram is stored under its last word. Level one holds the words (sorted 64-bit hashes), their running counts
and the pointers to their children; level two holds, relative to the word, the 32-bit fingerprints of the words
before it, and one byte each: the quantised share of the word's occurrences that follow this context. All
sequences are monotone and Elias-Fano coded. A trie is one binary value whose arrays are used in place.

The model is a Dirichlet-smoothed bigram, p(w|u) = (c(uw) + k p(w)) / (c(u) + k), with the add-one unigram p(w)
below it. Its logarithm falls into a term of w, a term of u and, for a bigram that was seen, a term that needs
only c(uw) and c(w). As every token is once a word and once a context, everything a token adds to its text is
found in the shard of the word itself: texts are scored by one exchange, without any table of all words in a task.

Tokens travel as sorted arrays, one per shard and run of documents, so counts are summed before they move.
Words with a large share of all tokens are dealt by word and context; only their counts are broadcast, and
there are at most ``4 * shards`` of them.

Defined results: a null or empty text is its end token; a null id counts as an empty one for the split; rows
repeat as they come; without training texts every count is 0. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .elias_fano import EliasFano, pack, unpack
from .flat import SPACED, boundaries, flat, hashes, mixed, slices
from .frames import ship, written

SHARD_BYTES = 24_000_000
RUN_BYTES = 6_000_000
KAPPA = 200.0
STEPS = 1 << 16
END = np.uint64(0x243F6A8885A308D3)
ROW = "shard int, kind int, run bigint, body binary"


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, word before, text) of every token; each text ends in ``END`` and starts after one."""
    data, at = flat(texts)
    n = len(at) - 1
    coded = SPACED[data]
    starts, ends, owner = boundaries(coded, at)
    words = np.bincount(owner, minlength=n)
    last = np.cumsum(words + 1) - 1
    word = np.full(len(owner) + n, END, np.uint64)
    inner = np.ones(len(word), bool)
    inner[last] = False
    word[inner] = hashes(coded, starts, ends)
    before = np.empty_like(word)
    before[:1] = END
    before[1:] = word[:-1]  # after an end token comes the start of the next text
    return word, before, np.repeat(np.arange(n, dtype=np.int32), words + 1)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """Tokens of runs of documents of about ``RUN_BYTES``, with a number that no other run has."""
    number = TaskContext.get().partitionId() << 32
    held: list[tuple] = []
    size = 0

    def joined():
        docs = pa.Table.from_batches([h[0] for h in held])
        shift = np.cumsum([0] + [len(h[0]) for h in held])
        text = np.concatenate([h[3] + np.int32(s) for h, s in zip(held, shift)])
        word, before = (np.concatenate([h[i] for h in held]) for i in (1, 2))
        held.clear()
        return number, docs, word, before, text

    for batch in batches:
        for part in slices(batch, "text"):
            word, before, text = tokens(part.column("text"))
            held.append((part.drop_columns(["text"]), word, before, text))
            size += part.column("text").nbytes
            if size >= RUN_BYTES:
                yield joined()
                number, size = number + 1, 0
    if held:
        yield joined()


def contexts(before: np.ndarray) -> np.ndarray:
    return (before >> np.uint64(32)).astype(np.uint32)


def routed(word: np.ndarray, before: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each token: of its word, or of word and context for a hot word."""
    deal = lambda h: ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    out = deal(word)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, word), len(hot) - 1)
        spread = np.flatnonzero(hot[at] == word)
        out[spread] = deal(mixed(word[spread] ^ contexts(before[spread]).astype(np.uint64)))
    return out


def sorted_tokens(word: np.ndarray, before: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, distinct words, rank of each token's word) with the order by shard, word and context."""
    distinct = np.unique(word)
    rank = np.searchsorted(distinct, word)
    key = (rank.astype(np.uint64) << np.uint64(32)) | contexts(before)
    order = np.argsort(key)
    del key
    return order[np.argsort(shard[order].astype(np.int32), kind="stable")], distinct, rank.astype(np.int32)


def _input(docs: DataFrame, key: str, text: str, modulus: int, remainder: int) -> DataFrame:
    spelled = F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")
    held = F.crc32(spelled) % modulus == remainder
    return docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"), held.alias("held_out"))


def heavy_words(rows: DataFrame, shards: int) -> np.ndarray:
    """Sorted hashes of words with more than a quarter of a shard's tokens (at most 4 for each shard)."""

    def run(batches):
        for _, _, word, _, _ in runs(batches):
            distinct, count = np.unique(word, return_counts=True)
            large = count * 16 * shards >= len(word)
            # The last row carries the run's number of tokens.
            arrays = [np.append(distinct[large].view(np.int64), 0), np.append(count[large], 0), np.zeros(int(large.sum()) + 1, np.int64)]
            arrays[2][-1] = len(word)
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["word", "n", "total"])

    sums = rows.mapInArrow(run, "word bigint, n bigint, total bigint")
    total = sums.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("t")).first().t
    found = sums.groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") > 0) & (F.col("n") * 4 * shards >= total)).collect()
    return np.sort(np.array([r.word for r in found], np.int64).view(np.uint64))


def build(words: np.ndarray, sizes: np.ndarray, context: np.ndarray, count: np.ndarray, hot: np.ndarray) -> bytes:
    """One shard's trie from its distinct words, children per word, and sorted contexts with their counts."""
    first = np.cumsum(sizes) - sizes
    total = np.add.reduceat(count, first) if len(words) else np.zeros(0, np.int64)
    share = np.log10(count / (np.repeat(total, sizes) + 1.0)) if len(words) else np.zeros(0)
    # Equal steps from the smallest to the largest value.
    low, high = (share.min(), share.max()) if len(share) else (0.0, 0.0)
    step = max(high - low, 1e-9) / (STEPS - 1)
    code = np.rint((share - low) / step).astype(np.uint16)
    children = (np.repeat(np.arange(len(words), dtype=np.uint64), sizes) << np.uint64(32)) | context.astype(np.uint64)
    is_hot = np.isin(words, hot)
    return pack(
        {
            **EliasFano.of(words).arrays("words"),
            **EliasFano.of(np.cumsum(total)).arrays("counts"),
            **EliasFano.of(np.append(0, np.cumsum(sizes))).arrays("pointers"),
            **EliasFano.of(children).arrays("children"),
            "codes": code,
            "scale": np.array([low, step]),
            "hot": words[is_hot],
            "hot_counts": total[is_hot],
            "figures": np.array([int((~is_hot).sum()), int(total.sum())], np.int64),
        }
    )


class Trie:
    """Views of one shard's levels."""

    def __init__(self, buffer):
        a = unpack(buffer)
        self.words, self.counts, self.pointers, self.children = (
            EliasFano.view(a, n) for n in ("words", "counts", "pointers", "children")
        )
        self.codes, self.low, self.step = a["codes"], *a["scale"].tolist()

    def count(self, at: np.ndarray) -> np.ndarray:
        """Occurrences of the words at these places (0 for -1)."""
        safe = np.maximum(at, 0)
        if not self.counts.n:
            return np.zeros(len(at))
        upto = self.counts[safe].astype(np.int64)
        earlier = np.where(safe > 0, self.counts[np.maximum(safe - 1, 0)].astype(np.int64), 0)
        return np.where(at >= 0, upto - earlier, 0).astype(np.float64)

    def share(self, at: np.ndarray, context: np.ndarray) -> np.ndarray:
        """log10 of the quantised c(uw) / (c(w) + 1), nan where the bigram was not seen."""
        out = np.full(len(at), np.nan)
        have = np.flatnonzero(at >= 0)
        if len(have):
            p = at[have]
            low, high = (self.pointers[p + i].astype(np.int64) for i in (0, 1))
            found = self.children.find((p.astype(np.uint64) << np.uint64(32)) | context[have], low, high)
            out[have] = np.where(found >= 0, self.low + self.step * self.codes[np.maximum(found, 0)], np.nan)
        return out


def train(rows: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """The written table of tries (shard, body) of all rows of ``rows``."""

    def counted(batches):
        for number, _, word, before, _ in runs(batches):
            shard = routed(word, before, hot, shards)
            order, distinct, rank = sorted_tokens(word, before, shard)
            r, u, s = rank[order], contexts(before)[order], shard[order]
            del word, before, shard, order, rank
            new = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (u[1:] != u[:-1]) | (s[1:] != s[:-1])))
            n = np.diff(np.append(new, len(r))).astype(np.uint32)
            r, u, s = r[new], u[new], s[new]
            yield from _by_shard(number, s, distinct, r, {"context": u, "n": n})

    def built(batches):
        held: list[dict] = []
        current = None

        def made():
            word = np.concatenate([np.repeat(h["word"], h["size"]) for h in held])
            u = np.concatenate([h["context"] for h in held])
            n = np.concatenate([h["n"] for h in held]).astype(np.int64)
            held.clear()
            distinct = np.unique(word)
            key = (np.searchsorted(distinct, word).astype(np.uint64) << np.uint64(32)) | u
            del word, u
            order = np.argsort(key)
            key, n = key[order], n[order]
            new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            n, key = np.add.reduceat(n, new), key[new]
            sizes = np.bincount((key >> np.uint64(32)).astype(np.int64), minlength=len(distinct))
            body = build(distinct, sizes, (key & np.uint64(0xFFFFFFFF)).astype(np.uint32), n, hot)
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([body], pa.binary())], names=["shard", "body"])

        for batch in batches:
            for i in range(len(batch)):
                shard = batch.column("shard")[i].as_py()
                if held and shard != current:
                    yield made()
                current = shard
                held.append({k: v.copy() for k, v in unpack(batch.column("body")[i].as_buffer()).items()})
        if held:
            yield made()

    moved = rows.mapInArrow(counted, ROW).repartition(2 * shards, "shard").sortWithinPartitions("shard")
    return written(moved.mapInArrow(built, "shard int, body binary"), "trie")


def _by_shard(number: int, shard: np.ndarray, distinct: np.ndarray, rank: np.ndarray, arrays: dict[str, np.ndarray]):
    """One row for each shard: its words, the number of entries of each, and the entries' arrays."""
    cuts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard)) if len(shard) else np.zeros(1, int)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        r = rank[a:b]
        first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        parts = {"word": distinct[r[first]], "size": np.diff(np.append(first, b - a)).astype(np.uint32)}
        parts |= {k: v[a:b] for k, v in arrays.items()}
        yield _row(int(shard[a]), 1, number, pack(parts))


def _row(shard: int, kind: int, number: int, body: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), pa.array([kind], pa.int32()), pa.array([number], pa.int64()), pa.array([body], pa.binary())],
        names=["shard", "kind", "run", "body"],
    )


def figures(tries: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Training tokens, distinct training words, and the counts of the hot words: sums over the shards."""

    def run(batches):
        for batch in batches:
            for body in batch.column("body"):
                a = unpack(body.as_buffer())
                words = np.append(a["hot"].view(np.int64), [0, 0])
                kind = np.append(np.zeros(len(a["hot"]), np.int32), [1, 2]).astype(np.int32)
                n = np.append(a["hot_counts"], a["figures"])
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(words), pa.array(n)], names=["kind", "word", "n"])

    sums = tries.mapInArrow(run, "kind int, word bigint, n bigint").groupBy("kind", "word").agg(F.sum("n").alias("n")).collect()
    hot = {r.word: r.n for r in sums if r.kind == 0}
    cold, total = (sum(r.n for r in sums if r.kind == k) for k in (1, 2))
    return total, cold + len(hot), hot


def score(rows: DataFrame, tries: DataFrame, shards: int, hot: np.ndarray, kappa: float = KAPPA) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    total, vocabulary, hot_counts = figures(tries)
    z = float(total + vocabulary + 1)
    hot_words = np.sort(np.array(list(hot_counts), np.int64).view(np.uint64))
    hot_n = np.array([hot_counts[w] for w in hot_words.view(np.int64).tolist()], np.float64)

    def asked(batches):
        for number, docs, word, before, text in runs(batches):
            shard = routed(word, before, hot, shards)
            order, distinct, rank = sorted_tokens(word, before, shard)
            arrays = {"context": contexts(before)[order], "text": text[order].astype(np.uint16 if len(docs) < 1 << 16 else np.uint32)}
            yield from _by_shard(number, shard[order], distinct, rank[order], arrays)
            key = docs.column("key").combine_chunks()
            facts = {
                "key": key.fill_null(0).to_numpy(),
                "known_key": key.is_valid().to_numpy(zero_copy_only=False),
                "held_out": docs.column("held_out").to_numpy(),
                "tokens": np.bincount(text, minlength=len(docs)),
            }
            yield _row(number % shards, 2, number, pack(facts))

    def answered(batches):
        trie, current = None, None
        for batch in batches:
            for i in range(len(batch)):
                shard, kind = batch.column("shard")[i].as_py(), batch.column("kind")[i].as_py()
                number, buffer = batch.column("run")[i].as_py(), batch.column("body")[i].as_buffer()
                if kind == 0:
                    trie, current = Trie(buffer.to_pybytes()), shard
                    continue
                if kind == 2:
                    yield _row(0, 0, number, buffer.to_pybytes())
                    continue
                if shard != current:  # no training token came here
                    trie, current = Trie(build(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3, hot)), shard
                a = unpack(buffer)
                at = trie.words.find(a["word"])
                here = trie.count(at)
                count = here.copy()
                if len(hot_words):
                    h = np.minimum(np.searchsorted(hot_words, a["word"]), len(hot_words) - 1)
                    count = np.where(hot_words[h] == a["word"], hot_n[h], count)
                base = np.log10((count + 1) / z)
                alone = np.log10(kappa) + base - np.log10(count + kappa)
                scale = np.log10((here + 1) / (count + 1)) + np.log10(z / kappa)
                size = a["size"].astype(np.int64)
                seen = trie.share(np.repeat(at, size), a["context"]) + np.repeat(scale, size)
                gain = np.where(np.isnan(seen), 0.0, np.log10(1 + 10.0 ** np.nan_to_num(seen)))
                text = a["text"].astype(np.int64)
                low = int(text.max()) + 1
                sums = [np.bincount(text, weights=w, minlength=low) for w in (np.repeat(base, size), np.repeat(alone, size) + gain, np.repeat(count > 0, size))]
                some = np.flatnonzero(np.bincount(text, minlength=low))
                body = {"text": some.astype(np.uint32), "base": sums[0][some], "score": sums[1][some], "known": sums[2][some].astype(np.uint32)}
                yield _row(0, 1, number, pack(body))

    def summed(batches):
        held: dict[str, np.ndarray] = {}
        current = None

        def made():
            keys = pa.array(held["key"], pa.int64(), mask=~held["known_key"])
            n = len(keys)
            return pa.RecordBatch.from_arrays(
                [
                    keys, pa.array(held["held_out"]), pa.array(held["tokens"]), pa.array(held["known"].astype(np.int64)),
                    pa.array(np.full(n, total)), pa.array(held["base"]), pa.array(held["score"]),
                ],
                names=["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

        for batch in batches:
            for i in range(len(batch)):
                number, a = batch.column("run")[i].as_py(), unpack(batch.column("body")[i].as_buffer())
                if batch.column("kind")[i].as_py() == 0:  # a run's facts come before its sums
                    if current is not None:
                        yield made()
                    current, held = number, {k: v.copy() for k, v in a.items()}
                    held |= {k: np.zeros(len(held["key"])) for k in ("known", "base", "score")}
                    continue
                for k in ("known", "base", "score"):
                    held[k][a["text"]] += a[k]
        if current is not None:
            yield made()

    stored = tries.select("shard", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("run"), "body")
    both = rows.mapInArrow(asked, ROW).unionByName(stored)
    answers = both.repartition(2 * shards, "shard").sortWithinPartitions("shard", "kind").mapInArrow(answered, ROW)
    back = answers.repartition("run").sortWithinPartitions("run", "kind")
    out = "key bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return back.mapInArrow(summed, out)


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text", modulus: int = 7, remainder: int = 2, kappa: float = KAPPA, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Learn from the rows whose ``crc32(key) mod modulus`` is not ``remainder`` and score all rows."""
    ship(docs.sparkSession)
    rows = _input(docs, key, text, modulus, remainder)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("s")).first().s
    shards = max(1, -(-size // shard_bytes))
    learning = rows.where(~F.col("held_out"))
    hot = heavy_words(learning, shards)
    tries = train(learning, shards, hot)
    return score(rows, tries, shards, hot, kappa).withColumnRenamed("key", key)
