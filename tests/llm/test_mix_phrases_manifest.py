"""Mixing, phrases and the manifest: against plain Python and SQL."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from compare import compare, duck
from conftest_llm import ODD
from pyspark.sql import functions as F

from trailmart.llm import merkle, mixing, phrases, queries, running
from trailmart.llm.frames import written

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Mixing


def test_targets_share_what_capped_sources_cannot_give():
    assert mixing.targets([10, 1000, 1000], [1, 2, 3]) == [30, 792, 1188]
    assert mixing.targets([0, 5], [1, 2]) == [0, 5] and mixing.targets([], []) == []
    sizes, weights = [3, 50, 7, 900, 20], [1, 2, 3, 1, 2]
    got = mixing.targets(sizes, weights)
    assert sum(got) == sum(sizes) and all(t <= 3 * s for t, s in zip(got, sizes))
    levels = {t / w for t, s, w in zip(got, sizes, weights) if t < 3 * s}
    assert len(levels) == 1 and all(3 * s / w <= max(levels) for t, s, w in zip(got, sizes, weights) if t == 3 * s)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000])
def test_permutation_and_its_inverse(n):
    order = mixing.Permutation(n, 7)
    got = order(np.arange(n))
    assert sorted(got.tolist()) == list(range(n))
    assert order(got, back=True).tolist() == list(range(n))


@pytest.mark.parametrize("size, words", [(1000, 999), (1000, 2999), (1030, 517), (1030, 1029), (5, 7), (256, 3), (4099, 4098), (4099, 5000), (7, 0), (7, 21)])
def test_slots_give_exactly_the_target(size, words):
    for seed in range(8):
        source = mixing.Source("=a", size, mixing.Fraction(words), 256, seed)
        slots, last = source.slots()
        lengths = source.length(source.taken(np.arange(slots)))
        assert sum(lengths[:-1]) + (last if slots else 0) == words
        assert not slots or 0 < last <= lengths[-1]


def checked_mix(rows, got, **columns):
    """The contract, for (key, source, text) rows."""
    sizes = collections.Counter()
    for _, source, text in rows:
        sizes[source] += len(WORD.findall(text or ""))
    assert sorted((str(r[0]), len(WORD.findall(r[2] or ""))) for r in rows) == sorted((str(r.doc_id), r.size) for r in got)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    names = sorted(sizes, key=lambda s: (s is None, s))
    wanted = dict(zip(names, mixing.targets([sizes[s] for s in names], [1 + i % 3 for i in range(len(names))])))
    assert collections.Counter((float(wanted[s]), sizes[s]) for _, s, _ in rows) == collections.Counter((r.target, r.source_size) for r in got)
    by_target = collections.defaultdict(int)
    for r in got:
        by_target[r.target, r.source_size] += r.taken
    same = collections.Counter((float(wanted[s]), sizes[s]) for s in names)
    for s in names:
        place = float(wanted[s]), sizes[s]
        assert abs(by_target[place] - same[place] * place[0]) <= same[place]


def test_mix_of_a_table_and_its_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.collect()
    got = queries.op11_mixing(spark, SMALL).collect()
    checked_mix([(r.doc_id, r.source, r.text) for r in rows], got)
    again = mixing.taken(docs.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    texts, used, places = {r.doc_id: WORD.findall(r.text or "") for r in rows}, collections.Counter(), collections.defaultdict(int)
    for r in mixing.mixed(docs).collect():
        assert WORD.findall(r.text) == texts[r.doc_id][r.first : r.first + r.words]
        used[r.doc_id] += r.words
        places[r.shard, r.place] += r.words
    assert all(used[r.doc_id] == r.taken for r in got)
    # Every place is there once, and all but the ends of sources are full.
    assert sorted(p for s, p in places) == list(range(len(places))) and sum(n != 256 for n in places.values()) < 3 * 20 + 20


def test_mix_of_odd_rows(spark, documents):
    docs = documents(ODD).selectExpr("* except (source)", "case when doc_id > 6 then 'b' when doc_id > 2 then '' end as source", "'q' as _text", "1 as _size")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    got = mixing.taken(docs, block=4, slots=16).collect()
    checked_mix(rows, got)
    mix = mixing.mixed(docs, block=4, slots=16).collect()
    assert sum(r.words for r in mix) == sum(r.taken for r in got)
    assert mixing.taken(documents([])).count() == 0 and mixing.mixed(documents([])).count() == 0
    assert [(r.taken, r.target) for r in mixing.taken(documents([(1, None), (2, " ")])).collect()] == [(0, 0.0)] * 2


def test_a_third_of_all_rows_alike_and_one_hot_source(spark):
    rows = [(5, "a b c", "x", "hot", 5)] * 400 + [(i, f"w{i} " * (i % 9), "x", f"s{i % 5}" if i % 3 else "hot", 1) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    checked_mix([(r[0], r[3], r[1]) for r in rows], mixing.taken(docs, block=8, slots=32).collect())


# Running totals


def test_running_totals(spark):
    rng = np.random.default_rng(1)
    rows = [("a" if rng.random() < 0.7 else "b", int(rng.integers(50)) if rng.random() < 0.9 else None, i, int(rng.integers(5))) for i in range(600)]
    got = running.offsets(spark.createDataFrame(rows, "g string, x int, y int, w int").repartition(9), "g", ["x", "y"], F.col("w"), "o").collect()
    assert len(got) == 600
    for g in "ab":
        total = 0
        for r in sorted((r for r in got if r.g == g), key=lambda r: (r.x is not None, r.x or 0, r.y)):
            assert r.o == total
            total += r.w


def test_copies(spark):
    rows = spark.createDataFrame([(1, 9000, 5), (2, 1, 7)], "i int, n long, at long")
    got = [r.at for r in running.copies(rows, "n", "at").orderBy("i", "at").collect()]
    assert got == [*range(5, 9005), 7]


# Phrases


def brute_phrases(rows, threshold, top):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= threshold}
        gone = {p[i:j] for p, a in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and a >= c[p[i:j]]}
        scored = []
        for p, a in found.items():
            score, k = min((1000 * a * totals[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            if p not in gone:
                scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, r, totals[lang], -s) for i, (s, a, p, x, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_phrases_equal_brute_force(spark, shards):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.collect()]
    got = phrases.collocations(docs, threshold=12, top=300, shards=shards).collect()
    assert sorted(map(tuple, got)) == brute_phrases(rows, 12, 300) and len(got) > 300


def test_phrases_equal_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(spark, duck(folder), "op12_phrases", folder) is None


def test_phrases_of_odd_rows(spark, documents):
    rows = [(i, "The  Quick\tbrown,fox jumps. the quick BROWN\nfox É\x0bé a a a a a a a") for i in range(30)]
    rows += [(100 + i, t) for i, (_, t) in enumerate(ODD)] + [(None, "x\x00y \x1c z ~" * 40), (None, "late comers come late " * 3)] * 8
    docs = documents(rows).selectExpr("* except (lang)", "case when doc_id % 2 = 0 then lang end as lang", "1 as k", "2 as n", "3 as phrase", "4 as shard_", "5 as _part")
    got = phrases.collocations(docs, threshold=5, top=40).collect()
    assert sorted(map(tuple, got)) == brute_phrases([(r.lang, r.text) for r in docs.collect()], 5, 40)
    assert phrases.collocations(documents([])).count() == 0
    assert phrases.collocations(documents([(1, None), (2, "")])).count() == 0


@pytest.mark.parametrize("slots", [1, 64])
def test_crowded_slots_change_no_count(spark, slots):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    got = phrases.frequent(docs, threshold=9, shards=2, slots=slots)
    got = phrases.without_parts(phrases.scored(got)).select("lang", "phrase", "a", "l", "r", "n", "score").collect()
    want = [w[:1] + w[2:] for w in brute_phrases([(r.lang, r.text) for r in docs.collect()], 9, 10**6)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_phrases_with_one_hash_are_told_apart(spark):
    import pyarrow as pa

    chunk = phrases.Chunk(pa.array(["en", "de"]), pa.array(["b a b a", "a b"]))
    got = chunk.counts(2, np.array([0, 1, 2, 4]), np.zeros(4, np.uint64), np.zeros(4, np.int32)).to_pylist()
    assert sorted((r["lang"], r["phrase"], r["n"]) for r in got) == [("de", "a b", 1), ("en", "a b", 1), ("en", "b a", 2)]


def test_scans_move_numbers_only(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(phrases, "written", lambda df, name: (seen.append((name, df.dtypes)), written(df, name))[1])
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    assert phrases.frequent(docs, threshold=9, shards=2).where("k > 1").count() > 0
    states = [types for name, types in seen if name == "state"]
    assert len(states) > 4 and {kind for types in states for _, kind in types} <= {"int", "bigint"}


def test_phrases_with_one_hash_are_counted_by_words():
    import pyarrow as pa

    chunk = phrases.Chunk(pa.array(["en", "de"]), pa.array(["b a b a. b", "a b"]))
    chunk.hash[:] = 0
    reached = phrases.Reached(1)
    reached.scan[0] = 0
    rows = [r for batch in phrases._by_hash(chunk, 1, 1, reached, [2]) for r in batch.to_pylist()]
    assert [(r["k"], r["active"], r["n"]) for r in rows] == [(2, 1, 4)]
    reached.scan[1] = 1
    got = [r for batch in phrases._by_words(chunk, reached) for r in batch.to_pylist()]
    want = [("de", 0, "", 2), ("de", 1, "a", 1), ("de", 1, "b", 1), ("de", 2, "a b", 1)]
    want += [("en", 0, "", 5), ("en", 1, "a", 2), ("en", 1, "b", 3), ("en", 2, "a b", 1), ("en", 2, "b a", 2)]
    assert sorted((r["lang"], r["k"], r["phrase"], r["n"]) for r in got) == want


def test_long_counts_are_exact(spark):
    rows = [("en", 0, "", 9_000_000_000_000_000), ("en", 1, "a", 3_000_000_000_000), ("en", 1, "b", 2_000_000_000_001), ("en", 2, "a b", 1_999_999_999_999)]
    got = phrases.scored(spark.createDataFrame(rows, "lang string, k int, phrase string, n long")).first()
    assert got.score == 1000 * 1_999_999_999_999 * 9_000_000_000_000_000 // (3_000_000_000_000 * 2_000_000_000_001)


# Manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def beside(tree, i):
        out = []
        for level in tree[:-1]:
            out.append((i % 2 == 1, level[i ^ 1]) if i ^ 1 < len(level) else None)
            i //= 2
        return out

    def leaf(r, add=0):
        values = (r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + add, r.text)
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r.lang].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
    trees = {g: levels([leaf(r) for r in groups[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    root, out = top[-1][0], []
    for at, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            path = beside(trees[g], i) + beside(top, at)
            node = leaf(r, 1 if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 else 0)
            for s in path:
                node = digest(node) if s is None else digest(s[1], node) if s[0] else digest(node, s[1])
            out.append((r.doc_id, leaf(r), trees[g][-1][0], root, digest(*[s[1] for s in path if s]), node, node == root))
    return sorted(out, key=str)


def test_manifest_of_a_table(spark):
    for folder in (SMALL, "/root/testdata/sf0.01"):
        got = queries.op13_merkle(spark, folder).collect()
        assert sorted(map(tuple, got), key=str) == brute_manifest(spark.read.parquet(f"{folder}/documents.parquet").collect())
        assert 0.8 < sum(r.verified for r in got) / len(got) < 0.92


def test_manifest_sql(spark):
    assert compare(spark, duck(SMALL), "op13_merkle", SMALL) is None


@pytest.mark.parametrize("langs", [1, 3, 300])
def test_manifest_of_odd_rows(spark, documents, langs):
    rows = [(*r, f"l{i % langs}" if i % 7 else None, "s" if i % 3 else None, None if i % 5 == 0 else i) for i, r in enumerate(ODD)]
    rows += [(5, "copy", "l0", None, 3)] * 300 + [(i, f"text é {i}", f"l{i % langs}" if i % 4 else "l0", "", i) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").selectExpr("*", "1 as _at", "2 as leaf", "3 as _key")
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.verified(merkle.manifest(docs, changed={"n_chars": F.col("n_chars") + 1}, when=picked)).collect()
    assert sorted(map(tuple, got), key=str) == brute_manifest(docs.collect())


def test_manifest_of_few_rows(spark, documents):
    assert merkle.verified(merkle.manifest(documents([]))).count() == 0
    for n in (1, 2, 3):
        docs = documents([(i, "x") for i in range(n)])
        got = merkle.verified(merkle.manifest(docs)).collect()
        assert [r.folded_root for r in got] == [r.root for r in got] and all(r.verified for r in got)
        assert sorted((r.leaf, r.proof_sha256) for r in got) == sorted((w[1], w[4]) for w in brute_manifest(docs.collect()))
