"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has a bit set where more than half of the shingles' hashes have it. Equal fingerprints are one
class, so copies cost nothing further. The 64 bits are dealt into groups of correlated bits, and each group i
gets a threshold t_i of its own with sum(t_i) = limit - groups + 1: two fingerprints within the limit then
differ in at most t_i bits in some group i, whatever the groups. A dynamic programme gives the thresholds the
least expected work: rows to probe with plus candidates to verify, estimated from all fingerprints by the
number of equal values in each group and the odds of each of its bits. The number of groups is the one whose
work is least, so the groups get wider as the corpus grows.

Defined results: a null or empty text has no shingles and the fingerprint zero, which links like any other;
fewer words than a shingle has give one shingle of all words; repeated rows are in one class; a document
without an id gets the component of the others with its fingerprint, or none. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .flat import BASE, SPACED, boundaries, flat, mixed, ragged, slices
from .frames import ship, written
from .hamming import Group, codes_of, linked, linked_in_buckets

SHINGLE = 4
MOST_BITS = 4
SEED = 42
GROUP_COUNTS = (2, 3, 4, 5)
#: What a row to probe with costs, in verified candidates.
PROBE_COST = 30.0
RECALL = 0.995
#: Words of the fingerprints that estimate a similarity, and those of them that the search looks at.
WORDS = 8
SEARCHED_WORDS = 4
#: Standard errors beyond the similarity up to which a pair is a candidate.
CANDIDATE_ERRORS = 4.0
#: Members of a candidate component in a block, as long as there are few blocks, and most shingles in one.
BLOCK_ROWS, SPREAD_BLOCKS, BLOCK_SHINGLES = 256, 16, 1_000_000
SHINGLES_AT_ONCE = 1_000_000


def shingle_bytes(texts: pa.Array, k: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Normalised words joined by blanks, start and end of each shingle in them, and shingles per text."""
    data, at = flat(texts)
    coded = SPACED[data]
    starts, ends, owner = boundaries(coded, at)
    length = ends - starts
    place = np.cumsum(length + 1) - length - 1
    joined = np.full(int(length.sum()) + len(length), 32, np.uint8)
    joined[ragged(np.arange(len(joined)), place, length)] = ragged(coded, starts, length) - 1
    words = np.bincount(owner, minlength=len(at) - 1)
    count = np.where(words > 0, np.maximum(words - k + 1, 1), 0)
    text = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = (np.cumsum(words) - words)[text] + nth
    last = first + np.minimum(words[text], k) - 1
    return joined.tobytes(), place[first], place[last] + length[last], count


def shingles_of(texts: pa.Array, k: int, distinct: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles, text after text, and their number per text; with ``distinct`` each once, sorted."""
    joined, start, end, count = shingle_bytes(texts, k)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(start.tolist(), end.tolist())], np.uint64)
    if distinct and len(h):
        text = np.repeat(np.arange(len(count)), count)
        order = np.lexsort((h, text))
        h, text = h[order], text[order]
        new = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))
        h, count = h[new], np.bincount(text[new], minlength=len(count))
    return h, count


def fingerprints_of(texts: pa.Array, k: int = SHINGLE, words: int = 1, distinct: bool = False) -> np.ndarray:
    """Fingerprints as rows of ``words`` 64-bit words; with ``distinct`` a repeated shingle counts once."""
    return folded(*shingles_of(texts, k, distinct), words)


def folded(h: np.ndarray, count: np.ndarray, words: int = 1) -> np.ndarray:
    """Fingerprints of the hashes of ``shingles_of``."""
    out = np.zeros((len(count), words), np.uint64)
    some = np.flatnonzero(count)
    if len(some):
        begin = (np.cumsum(count) - count)[some]
        for word in range(words):
            own = mixed(h + np.uint64(word * BASE % (1 << 64))) if word else h  # further words: the hash mixed anew
            bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
            set_bits = (2 * ones > count[some, None]).astype(np.uint8)
            out[some, word] = np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def sums_of(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One number for each set of hashes, which tells it from other sets; 0 for none."""
    total = np.append(np.uint64(0), np.cumsum(mixed(h ^ np.uint64(BASE)), dtype=np.uint64))
    ends = np.cumsum(count)
    return (total[ends] - total[ends - count]).view(np.int64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, words: int = 1, distinct: bool = False) -> DataFrame:
    """(key, code): the fingerprint of each whole text, a number, or bytes if it has several words."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                codes = fingerprints_of(part.column("text"), k, words, distinct)
                column = pa.array(codes[:, 0].view(np.int64)) if words == 1 else pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("key"), column], names=["key", "code"])

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key bigint, code {'bigint' if words == 1 else 'binary'}")


def _together(items: DataFrame, bits: int = 64) -> tuple[int, np.ndarray]:
    """Number of codes, and how often each two bits are both set: one sum for each pair of bits."""
    ship(items.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((bits, bits))
        for batch in batches:
            raw = codes_of(batch.column("code")).view(np.uint8)[:, : bits // 8]
            for begin in range(0, len(raw), 20_000):
                some = np.unpackbits(raw[begin : begin + 20_000], axis=1, bitorder="little").astype(np.float32)
                total += some.T @ some
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(bits * bits)), pa.array(total.ravel().astype(np.int64))], names=["at", "n"])

    sums = items.select("code").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(bits * bits)
    for r in sums.collect():
        out[r["at"]] = r.n
    return items.count(), out.reshape(bits, bits)


def correlated_groups(n: int, both: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Bits dealt into ``parts`` groups of nearly equal width, each filled with the bits most like its first."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    like = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(like, 0)
    left, out = list(range(len(both))), []
    for p in range(parts):
        width = len(both) // parts + (p < len(both) % parts)
        group = [max(left, key=lambda b: (like[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < width:
            best = max(left, key=lambda b: (like[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        out.append(tuple(sorted(group)))
    return out


def odds_within(differ: np.ndarray, most: int) -> np.ndarray:
    """P(at most t of these bits differ) for t = 0..most, bits taken as independent."""
    p = np.zeros(most + 2)
    p[0] = 1.0
    for d in differ:
        p[1:] = p[1:] * (1 - d) + p[:-1] * d
        p[0] *= 1 - d
    return np.cumsum(p[: most + 1])


def allot(work: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 up, one per group, that sum to ``total`` with the least work: ``work[i][t + 1]``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for costs in work:
        grown: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t1, c in enumerate(costs):  # t1 = t + 1
                entry = (cost + c, [*chosen, t1 - 1])
                if used + t1 not in grown or entry < grown[used + t1]:
                    grown[used + t1] = entry
        best = grown
    return best[total + len(work)]


def plan(items: DataFrame, limit: int = MOST_BITS, counts: tuple[int, ...] = GROUP_COUNTS) -> list[Group]:
    """Groups and thresholds for these codes, from figures over all of them."""
    n, both = _together(items)
    share = np.diag(both) / max(n, 1)
    differ = 2 * share * (1 - share)
    options = [correlated_groups(n, both, parts) for parts in counts if parts <= limit + 1]
    flat_groups = [g for groups in options for g in groups]
    values = F.array(
        *[
            F.struct(F.lit(i).alias("g"), sum((F.shiftleft(F.shiftrightunsigned("code", b).bitwiseAND(F.lit(1)), j) for j, b in enumerate(g)), F.lit(0).cast("bigint")).alias("v"))
            for i, g in enumerate(flat_groups)
        ]
    )
    equal = items.select(F.explode(values).alias("x")).groupBy("x").agg(F.count("*").alias("n")).where("n > 1")
    pairs = {r.g: r.pairs for r in equal.groupBy("x.g").agg(F.sum(F.expr("n * (n - 1.0D) / 2")).alias("pairs")).collect()}
    choices, first = [], 0
    for groups in options:
        work = []
        for i, g in enumerate(groups, first):
            odds = odds_within(differ[list(g)], limit)
            costs, ball = [0.0], 0.0
            for t in range(limit + 1):
                ball += float(_choose(len(g), t))
                met = max(pairs.get(i, 0.0), n * n / 2 * odds[0]) * odds[t] / max(odds[0], 1e-300)
                costs.append(min(met, n * n / 2) + PROBE_COST * n * (1 + (ball - 1) / 2))
            work.append(costs)
        first += len(groups)
        cost, radii = allot(work, limit - len(groups) + 1)
        choices.append((cost, [Group(g, r) for g, r in zip(groups, radii)]))
    return min(choices, key=lambda c: c[0])[1]


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def grouped(codes: DataFrame, groups_of, most_bits: int) -> DataFrame:
    """(key, code, component) of written (key, code) rows; ``groups_of`` plans the search over the classes."""
    classes = codes.groupBy("code").agg(F.min("key").alias("node")).where("node is not null")
    classes = written(classes.select("node", "code", F.lit(1).cast("bigint").alias("size")), "classes")
    links = linked(classes, groups_of(classes), most_bits)
    found = components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.join(found, "node", "left").select(F.col("code"), F.coalesce("component", "node").alias("component"))
    return codes.join(named, "code", "left")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, limit: int = MOST_BITS) -> DataFrame:
    """(key, code, component): fingerprint and smallest key reachable over links of at most ``limit`` bits."""
    codes = written(fingerprints(docs, key, text, k), "fingerprints")
    return grouped(codes, lambda classes: plan(classes, limit), limit).select(F.col("key").alias(key), "code", "component")


def odds_of_bit(similarity: float) -> float:
    """Chance that a bit differs between two sets of shingles with this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def plan_for_similarity(items: DataFrame, words: int, similarity: float, recall: float = RECALL) -> list[Group]:
    """Groups and thresholds that find a pair right at the similarity with the chance ``recall``.

    A pair as far apart as that would need too many bits for the pigeonhole to be certain, so here the same
    dynamic programme deals out thresholds until the odds that all groups miss are small enough.
    """
    n, both = _together(items, 64 * words)
    share = np.diag(both) / max(n, 1)
    differ = 2 * share * (1 - share)
    p = odds_of_bit(similarity)
    unit = 0.02
    wanted = math.ceil(-math.log(1 - recall) / unit)
    choices = []
    for parts in (c * words for c in (4, 5, 6, 8)):
        groups = correlated_groups(n, both, parts)
        # best[s]: least work and thresholds of the groups so far with strength s, in units of -log(odds of a miss).
        best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for g in groups:
            met, found = odds_within(differ[list(g)], 1), odds_within(np.full(len(g), p), 1)
            options = [(0, 0.0, -1)]
            for t in (0, 1):
                probes = 1 + t * len(g) / 2
                options.append((round(-math.log(1 - found[t]) / unit), n * n / 2 * met[t] + PROBE_COST * words * n * probes, t))
            grown: dict[int, tuple[float, list[int]]] = {}
            for s, (cost, chosen) in best.items():
                for gain, work, t in options:
                    at = min(wanted, s + gain)
                    entry = (cost + work, [*chosen, t])
                    if at not in grown or entry < grown[at]:
                        grown[at] = entry
            best = grown
        if wanted in best:
            choices.append((best[wanted][0], [Group(g, r) for g, r in zip(groups, best[wanted][1])]))
    return min(choices, key=lambda c: c[0])[1]


def set_rows(docs: DataFrame, key: str, text: str, k: int, words: int = 0) -> DataFrame:
    """(key, code, shape) of each whole text, or without ``words`` (key, shape, shingles).

    ``shape`` stands for the set of distinct shingles, whose hashes are in ``shingles``.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, count = shingles_of(part.column("text"), k, distinct=True)
                columns = {"key": part.column("key"), "shape": pa.array(sums_of(h, count))}
                if words:
                    columns["code"] = pa.array([c.tobytes() for c in folded(h, count, words)], pa.binary())
                else:
                    at = pa.array(np.append(0, np.cumsum(count)).astype(np.int32))
                    columns["shingles"] = pa.ListArray.from_arrays(at, pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "key bigint, shape bigint, " + ("code binary" if words else "shingles array<bigint>"))


def overlapping(similarity: float) -> Callable[[dict[str, pa.Array]], Callable[[np.ndarray, np.ndarray], np.ndarray]]:
    """A test of rows against rows: the exact Jaccard similarity of their ``shingles`` reaches ``similarity``."""

    def verify(columns: dict[str, pa.Array]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        sets = columns["shingles"]
        size = sets.value_lengths().to_numpy().astype(np.int64)
        known, ids = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        row = np.repeat(np.arange(len(size)), size)
        placed = np.sort(row * len(known) + ids)  # sorted within each row, rows in turn
        ids = placed - row * len(known)
        first = np.cumsum(size) - size

        def test(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            out = np.zeros(len(i), bool)
            small = np.where(size[i] <= size[j], i, j)
            large = i + j - small
            total = np.cumsum(size[small])
            begin = 0
            while begin < len(i):
                before = total[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(total, before + SHINGLES_AT_ONCE, "right")))
                a, b = small[begin:end], large[begin:end]
                asked = ragged(ids, first[a], size[a]) + np.repeat(b * len(known), size[a])
                at = np.minimum(np.searchsorted(placed, asked), len(placed) - 1)
                common = np.bincount(np.repeat(np.arange(len(a)), size[a]), placed[at] == asked, len(a))
                out[begin:end] = common / np.maximum(size[a] + size[b] - common, 1) >= similarity
                begin = end
            return out

        return test

    return verify


def _meeting(members: DataFrame) -> DataFrame:
    """The members of each candidate component cut into blocks; each two blocks meet in one place."""
    held = members.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.size("shingles")).alias("load"))
    spread = F.least(F.ceil(F.col("n") / BLOCK_ROWS), F.lit(SPREAD_BLOCKS))
    held = held.select("bucket", F.greatest(spread, F.ceil(F.col("load") / BLOCK_SHINGLES), F.lit(1)).cast("int").alias("blocks"))
    cut = members.join(held, "bucket").withColumn("block", F.pmod(F.xxhash64("node", "shape"), F.col("blocks")).cast("int"))
    met = cut.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumns({"low": F.least("block", "met"), "high": F.greatest("block", "met")})
    return met.select(F.lit(0).alias("part"), "bucket", F.lit(True).alias("home"), "node", "code", "size", "shingles", "block", "low", "high")


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, similarity: float = 0.8, words: int = WORDS, searched: int = SEARCHED_WORDS) -> DataFrame:
    """(key, code, component) over links of texts whose distinct shingles have a Jaccard similarity of ``similarity`` or more.

    Texts with the same set of shingles are one class. Fingerprints have ``64 * words`` bits over the distinct
    shingles; the first ``searched`` words serve the search. Classes that meet there and differ in at most the
    bits that ``similarity`` stands for and ``CANDIDATE_ERRORS`` standard errors are candidates. Of the members
    of each component of candidates the shingles are brought together, once, and decide each pair exactly; the
    links that hold make the components of the result.
    """
    bits = 64 * words
    p = odds_of_bit(similarity)
    most = math.floor(bits * p + CANDIDATE_ERRORS * math.sqrt(bits * p * (1 - p)))
    codes = written(set_rows(docs, key, text, k, words), "fingerprints")
    classes = codes.groupBy("code", "shape").agg(F.min("key").alias("node")).where("node is not null")
    classes = written(classes.select("node", "code", "shape", F.lit(1).cast("bigint").alias("size")), "classes")
    met = linked(classes, plan_for_similarity(classes, searched, similarity), most)
    near = components(met.select(F.col("node").alias("a"), F.col("other").alias("b")))
    sets = set_rows(docs.join(near.select(F.col("node").alias(key)), key, "left_semi"), key, text, k).withColumnRenamed("key", "node")
    members = classes.join(near.withColumnRenamed("component", "bucket"), "node").join(sets.dropDuplicates(["node", "shape"]), ["node", "shape"])
    members = written(members, "candidates")
    links = linked_in_buckets(_meeting(members), [], most, overlapping(similarity), forest=True)
    found = components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.join(found, "node", "left").select("code", "shape", F.coalesce("component", "node").alias("component"))
    return codes.join(named, ["code", "shape"], "left").select(F.col("key").alias(key), "code", "component")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the smallest key. Rows without a key stay.

    Only the keys that go are joined; their list is broadcast when adaptive planning finds it small.
    """
    gone = similar(docs, key, text, k, similarity).where(F.col(key) != F.col("component"))
    gone = written(gone.select(F.col(key).alias("_gone")).distinct(), "near-copies")
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")


def spelled(code: Column) -> Column:
    """Sixteen hexadecimal digits."""
    return F.lower(F.lpad(F.hex(code), 16, "0"))
