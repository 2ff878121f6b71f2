"""Packing, language model, sharding, embeddings, SimHash and the pipeline against brute force."""

import collections
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest_llm import ODD
from tokenizers import Tokenizer

import corpus_pipeline
from trailmart.llm import bpe, itq, ngram, packing, queries, sharding, simhash, toxicity
from trailmart.llm.components import components
from trailmart.llm.elias_fano import EliasFano, pack, unpack
from trailmart.llm.frames import written
from trailmart.llm.hamming import Group, linked, merged

SMALL = "/root/testdata/sf0.001"


def texts_of(folder=SMALL):
    return dict(duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet'").fetchall())


# Packing


def check_packing(rows, texts, capacity=2048):
    library = Tokenizer.from_file(bpe.vocabulary())
    bins, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for i, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [p.piece for p in own] == list(range(-(-len(ids) // capacity)))
        for p in own:
            assert p.start == capacity * p.piece and p.length == min(capacity, len(ids) - p.start)
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    return len(bins), -(-sum(r.length for r in rows) // capacity)


def test_packing_is_whole_and_tight(spark):
    used, bound = check_packing(queries.op1_packing(spark, SMALL).collect(), texts_of())
    assert used <= bound + 1


def test_packing_odd_rows(spark, documents):
    rows = packing.packed(documents(ODD)).collect()
    assert sum(r.length for r in rows if r.doc_id in (2, 3, 4)) == 3 and sum(r.doc_id == 5 for r in rows) == 2
    assert max(r.piece for r in rows if r.doc_id == 8) == 14
    assert packing.packed(documents([])).count() == 0
    whole = packing.sequences(documents(ODD)).collect()
    assert max(len(r.ids) for r in whole) <= 2048 and sum(len(r.ids) for r in whole) == sum(r.length for r in rows)


@pytest.mark.parametrize("seed", range(5))
def test_fullest_combination_equals_exhaustive_search(seed):
    rng = np.random.default_rng(seed)
    counts = {int(n): int(rng.integers(1, 3)) for n in rng.integers(1, 40, 6)}
    items = [n for n, c in counts.items() for _ in range(c)]
    items.remove(max(items))
    capacity = 50
    best = max(
        s for s in (max(counts) + sum(x for b, x in enumerate(items) if m >> b & 1) for m in range(1 << len(items))) if s <= capacity
    )
    used = packing.fullest(counts, capacity)
    assert sum(n * k for n, k in used.items()) == best and all(k <= counts[n] for n, k in used.items())


def test_patterns_use_every_piece_once():
    counts = {2048: 7, 1500: 400, 548: 390, 700: 1000, 3: 100_000}
    made = packing.patterns(counts)
    total = collections.Counter()
    for used, times in made:
        assert sum(n * k for n, k in used.items()) <= 2048
        total.update({n: k * times for n, k in used.items()})
    assert total == counts
    bound = -(-sum(n * c for n, c in counts.items()) // 2048)
    assert sum(t for _, t in made) <= 1.02 * bound


# Language model


def reference_scores(texts, kappa):
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    one, two = collections.Counter(), collections.Counter()
    for i, words in tokens.items():
        if not held[i]:
            one.update(words)
            two.update(zip([None, *words[:-1]], words))
    total, z = sum(one.values()), sum(one.values()) + len(one) + 1
    for i, words in tokens.items():
        base = sum(math.log10((one[w] + 1) / z) for w in words)
        score = sum(math.log10((two[u, w] + kappa * (one[w] + 1) / z) / (one[u] + kappa)) for u, w in zip([None, *words[:-1]], words))
        yield i, held[i], len(words), sum(one[w] > 0 for w in words), total, base, score


@pytest.mark.parametrize("shard_bytes", [50_000, 32_000_000])  # many shards with heavy words, and one
def test_language_model_equals_brute_force(spark, shard_bytes):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3)
    got = {r.doc_id: r for r in ngram.scored(docs, shard_bytes=shard_bytes).collect()}
    gain = tokens = 0
    for i, held, n, known, total, base, score in reference_scores(texts_of(), ngram.KAPPA):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, abs=1e-3 * n)
        if held:
            gain, tokens = gain + score - base, tokens + n
    assert len(got) == len(texts_of()) and gain / tokens > 0.1  # the model tells more than its base


def test_language_model_on_odd_rows(documents):
    rows = ngram.scored(documents(ODD)).collect()
    assert len(rows) == len(ODD) and {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert ngram.scored(documents([])).count() == 0
    unseen = ngram.scored(documents([(9, "a b")]), remainder=zlib.crc32(b"9") % 7).first()  # nothing to learn from
    assert (unseen.held_out, unseen.n_known, unseen.train_tokens) == (True, 0, 0) and unseen.base_score == 0.0


@pytest.mark.parametrize("top", [1, 50, 1 << 20, (1 << 64) - 1])
def test_elias_fano(top):
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, top, 500, dtype=np.uint64, endpoint=True))
    arrays = unpack(pack(EliasFano.of(values).arrays("x")))
    ef = EliasFano.view(arrays, "x")
    assert (ef[np.arange(len(values))] == values).all()
    asked = np.concatenate([values, rng.integers(0, top, 500, dtype=np.uint64, endpoint=True)])
    assert (ef.successor(asked) == np.searchsorted(values, asked)).all()
    at = ef.find(asked)
    assert ((at >= 0) == np.isin(asked, values)).all() and (values[at[at >= 0]] == asked[at >= 0]).all()
    low, high = np.full(len(asked), 3), np.full(len(asked), max(3, len(values) - 5))
    inside = np.clip(np.searchsorted(values, asked), low, high)
    assert (ef.successor(asked, low, high) == inside).all()


def test_elias_fano_with_repeats_and_none():
    values = np.array([0, 0, 5, 5, 5, 9, 1000], np.uint64)
    assert (EliasFano.of(values)[np.arange(7)] == values).all()
    assert EliasFano.of(np.zeros(0, np.uint64)).find(np.array([1], np.uint64)).tolist() == [-1]


# Sharding


def check_shards(rows, texts, shards=40):
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(size) == set(range(shards))
    return max(size.values()) - min(size.values())


def test_shards_are_near_equal(spark):
    folder = "/root/testdata/sf0.1"
    texts = texts_of(folder)
    rows = queries.op3_shards(spark, folder).collect()
    assert len(rows) == len(texts) and {r.law for r in rows} == {"bytes"}
    assert check_shards(rows, texts) <= 2 * max(len((t or "").encode()) for t in texts.values())


def test_shards_split_one_value_and_number_in_chunks(spark, documents, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 20)
    rows = sharding.shards(documents([(i, "same text") for i in range(1000)]), leaves=7).collect()
    count = collections.Counter(r.shard for r in rows)
    assert max(count.values()) - min(count.values()) <= 4
    for s in count:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(count[s]))


def test_shards_on_odd_rows(documents):
    rows = sharding.shards(documents(ODD), leaves=3).collect()
    assert len(rows) == len(ODD) and sum(r["size"] == 16 for r in rows) == 3
    assert sharding.shards(documents([]), leaves=3).count() == 0
    assert {r.shard for r in sharding.shards(documents(ODD), target_bytes=10**9).collect()} == {0}


def cut_in_turn(rows, leaves, widths, first=0):
    """Leaf of every row by exact weighted medians: rows are (place in each dimension, size)."""
    if leaves == 1 or not rows:
        return dict.fromkeys(rows, first)
    spread = [(max(r[0][i] for r in rows) - min(r[0][i] for r in rows)) / w for i, w in enumerate(widths)]
    d = spread.index(max(spread))
    weight = collections.Counter()
    for at, size in rows:
        weight[at[d]] += size
    half = leaves // 2
    wanted, below = sum(weight.values()) * half / leaves, 0
    for place in sorted(weight):
        if below + weight[place] >= wanted:
            break
        below += weight[place]
    cut = place if wanted - below < below + weight[place] - wanted else place + 1
    low, high = [r for r in rows if r[0][d] < cut], [r for r in rows if r[0][d] >= cut]
    return cut_in_turn(low, half, widths, first) | cut_in_turn(high, leaves - half, widths, first + half)


@pytest.mark.parametrize("leaves", [2, 5, 40])
def test_tree_equals_cuts_in_turn(spark, monkeypatch, leaves):
    monkeypatch.setattr(sharding, "TOLERANCE", 0.0)
    monkeypatch.setattr(sharding, "BINS", 8)
    rng = np.random.default_rng(leaves)
    at = np.stack([rng.integers(0, 10, 600) * 1000 + np.arange(600), (rng.pareto(1, 600) * 1000).astype(int) % 10**9], 1)
    rows = [(tuple(map(int, a)), int(w)) for a, w in zip(at, rng.integers(1, 100, 600))]
    df = spark.createDataFrame([(*a, w, 0) for a, w in rows], "d0 long, d1 long, size long, node long")
    widths = [max(1.0, float(np.ptp(at[:, i]))) for i in range(2)]
    found = {((r.d0, r.d1), r["size"]): r.node for r in sharding.tree(df, 2, leaves).collect()}
    assert found == cut_in_turn(rows, leaves, widths)


def test_tree_splits_the_widest_dimension(spark):
    rows = spark.range(4000).selectExpr("id as key", "id % 10 as d0", "id * 1000 as d1", "1L as size", "0L as node", "4L as leaves")
    root = sharding.medians(rows, 2, [9.0, 3999000.0]).collect()
    assert len(root) == 1 and root[0].dimension == 0 and root[0].half == 2
    root = sharding.medians(rows, 2, [90.0, 3999000.0]).collect()
    assert root[0].dimension == 1
    placed = sharding.tree(rows.drop("leaves"), 2, 4).groupBy("node").count().collect()
    assert len(placed) == 4 and max(r["count"] for r in placed) <= 1500


def test_tree_of_many_leaves(documents):
    rows = sharding.shards(documents([(i, "word " * (i % 37)) for i in range(1000)]), leaves=400).collect()
    size = collections.Counter()
    for r in rows:
        size[r.shard] += r["size"]
    assert len(rows) == 1000 and set(size) <= set(range(400)) and len(size) > 380
    assert max(size.values()) <= 3 * sum(size.values()) / 400


def test_written_shards_hold_every_row(spark, documents, tmp_path):
    docs = documents(ODD + [(3, "other"), (None, "a b")])
    sharding.write_shards(docs, str(tmp_path / "out"), leaves=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == set(docs.columns)
    assert collections.Counter((r.doc_id, r.text) for r in back.collect()) == collections.Counter((r.doc_id, r.text) for r in docs.collect())
    assert {r.shard for r in back.select("shard").distinct().collect()} <= {0, 1, 2}  # one text is most of the bytes


# Embeddings


def brute_links(ids, x, least=0.9):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(x @ x.T >= least, 1))
    links = np.bincount(a, minlength=len(x)) + np.bincount(b, minlength=len(x))
    order = np.argsort(ids)
    rank = np.empty(len(ids), int)
    rank[order] = np.arange(len(ids))
    return links, ids[order][merged(len(ids), rank[a], rank[b], np.arange(len(ids)))[rank]]


def test_embeddings_recall_on_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x = np.concatenate([base, 0.902 * base + (1 - 0.902**2) ** 0.5 * side])
    rows = itq.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    ids = np.arange(len(x))
    links, _ = brute_links(ids, x)
    got = np.array([r.n_links for r in sorted(rows, key=lambda r: r.vec_id)])
    assert (got <= links).all() and got.sum() / links.sum() >= 0.9


@pytest.mark.parametrize("n", [20_000, 1_000_000])
@pytest.mark.parametrize("norm", [0.0, 0.45, 0.71, 0.9])
def test_embeddings_tables_with_a_common_direction(norm, n):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12_000, 64))
    x[:, 0] = 0
    x *= (1 - norm**2) ** 0.5 / np.linalg.norm(x, axis=1, keepdims=True)
    x[:, 0] = norm
    mean, projection = itq.learn(x[:8000])
    groups = itq.tables(n, 64, itq.apart(x[:8000], 0.9))
    base, side = x[8000:], rng.normal(size=(4000, 64))
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    near = itq.codes(base, mean, projection) ^ itq.codes(0.9 * base + 0.19**0.5 * side, mean, projection)
    found = np.any([np.bitwise_count(near & g.mask(1)[0]) <= g.radius for g in groups], axis=0)
    assert found.mean() >= 0.92


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_embeddings_query_equals_brute_force(spark, folder):
    rows = {r.vec_id: r for r in queries.op4_embeddings(spark, folder).collect()}
    got = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    ids, x = got.vec_id.to_numpy(), np.array(got.embedding.tolist(), float)
    links, component = brute_links(ids, x)
    found = np.array([rows[i].n_links for i in ids])
    assert (found <= links).all() and found.sum() >= 0.99 * links.sum()
    assert np.mean([rows[i].component_id == c for i, c in zip(ids, component)]) > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows.values())


def test_embeddings_odd_rows(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, v), (2, v), (2, v), (3, [2.0, 4.0, 6.0, 8.0]), (4, None), (5, []), (6, [0.0] * 4), (7, [1.0, None, 0.0, 0.0]),
        (8, [float("nan"), 1.0, 1.0, 1.0]), (9, [float("inf"), 1.0, 1.0, 1.0]), (10, [1.0, 2.0]), (None, v), (11, [-1.0, -2.0, -3.0, -4.0]),
        (12, [1e300, 2e300, 3e300, 4e300]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as node", "2 as size", "3 as code")
    out = itq.near_duplicates(df).collect()
    assert len(out) == len(rows)
    alone = {r.vec_id for r in out if r.n_links == 0}
    assert alone == {4, 5, 6, 7, 8, 9, 10, 11, None}
    assert {(r.n_links, r.component_id) for r in out if r.vec_id in (1, 2, 3, 12)} == {(4, 1)}
    assert itq.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_of_several_lengths(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4 + 4 * (i % 2)).tolist()) for i in range(40)]
    rows += [(100 + i, [2 * c for c in v]) for i, v in rows] + [(200, [1.0, 2.0])]
    out = {r.vec_id: r for r in itq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), cosine=0.999).collect()}
    assert len(out) == 81 and out[200].n_links == 0 and out[200].kept
    assert all(out[i].n_links >= 1 and out[i].component_id == out[100 + i].component_id for i in range(40))


def test_rotation_balances_bits():
    x = np.random.default_rng(2).normal(size=(2000, 16)) * np.linspace(3, 0.5, 16) + 1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes = itq.codes(x, *itq.learn(x))
    bits = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :16]
    assert np.abs(bits.mean(axis=0) - 0.5).max() < 0.12


# SimHash


def reference_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(ids, codes, most):
    order = np.argsort(ids)
    ids, codes = ids[order], codes[order]
    label = np.arange(len(ids))
    for a in range(len(ids)):
        b = np.flatnonzero(np.bitwise_count(codes[a] ^ codes[a + 1 :]) <= most) + a + 1
        label = merged(len(ids), np.full(len(b), a), b, label)
    return dict(zip(ids.tolist(), ids[label].tolist()))


def test_simhash_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op8_simhash(spark, folder).collect()
    texts = texts_of(folder)
    assert len(rows) == len(texts) and all(int(r.fingerprint, 16) == reference_fingerprint(texts[r.doc_id]) for r in rows)
    ids, codes = np.array([r.doc_id for r in rows]), np.array([int(r.fingerprint, 16) for r in rows], np.uint64)
    wanted = brute_components(ids, codes, 4)
    assert {r.doc_id: r.component_id for r in rows} == wanted and len(set(wanted.values())) < len(set(codes.tolist()))


def test_simhash_odd_rows(spark, documents):
    rows = simhash.near_duplicates(documents(ODD)).collect()
    assert len(rows) == len(ODD)
    assert {r.component for r in rows if r.doc_id in (1, 5)} == {1} and {r.component for r in rows if r.doc_id in (2, 3, 4)} == {2}
    assert simhash.near_duplicates(documents([])).count() == 0
    assert sorted(r.doc_id or 0 for r in simhash.deduplicated(documents(ODD)).collect()) == [0, 0, 1, 2, 7, 8, 9]


def near_codes(n, rng):
    base = rng.integers(0, 1 << 63, n // 10, dtype=np.uint64)
    out = np.repeat(base, 10)
    for _ in range(3):
        out ^= np.uint64(1) << rng.integers(0, 64, len(out), dtype=np.uint64)
    return np.unique(out)


@pytest.mark.parametrize("radii", [(0, 0, 0, 1), (1, 1, 0, -1), (2, 0, 0, -1)])
@pytest.mark.parametrize("bucket", [4096, 16])  # whole buckets, and buckets cut into blocks
def test_every_threshold_vector_finds_every_link(spark, monkeypatch, radii, bucket):
    monkeypatch.setattr("trailmart.llm.hamming.BUCKET_ROWS", bucket)
    codes = np.append(near_codes(600, np.random.default_rng(4)), 7 + np.arange(40, dtype=np.uint64))
    codes = np.unique(codes)
    ids = np.arange(len(codes))
    groups = [Group(tuple(range(16 * i, 16 * i + 16)), r) for i, r in enumerate(radii)]
    items = spark.createDataFrame([(int(i), int(c.view(np.int64)), 1) for i, c in zip(ids, codes)], "node long, code long, size long")
    rows = linked(items, groups, 4).collect()
    count = collections.Counter()
    for r in rows:
        count[r.node] += r.links
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4
    assert [count[i] for i in ids] == (near.sum(axis=1) - 1).tolist()
    label = merged(len(ids), np.array([r.node for r in rows]), np.array([r.other for r in rows]), ids.copy())
    assert dict(zip(ids.tolist(), label.tolist())) == brute_components(ids, codes, 4)


def test_thresholds_have_the_least_work():
    work = [[0, 5, 9, 30], [0, 1, 50, 60], [0, 7, 8, 9]]
    best = min(
        (work[0][a] + work[1][b] + work[2][c], [a - 1, b - 1, c - 1]) for a in range(4) for b in range(4) for c in range(4) if a + b + c == 4
    )
    assert simhash.allot(work, 1) == best


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(5)
    bits = (rng.random((4000, 64)) < 0.5).astype(float)
    bits[:, 40] = bits[:, 3]
    bits[:, 41] = 1 - bits[:, 3]
    groups = simhash.correlated_groups(4000, bits.T @ bits, 4)
    assert sorted(b for g in groups for b in g) == list(range(64)) and any({3, 40, 41} <= set(g) for g in groups)


def test_similar_texts_join_and_others_do_not(spark, documents):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(5000)]
    rows = []
    for i in range(40):
        text = rng.choice(words, 300).tolist()
        rows.append((10 * i, " ".join(text)))
        near = list(text)
        near[150] = "changed"
        rows.append((10 * i + 1, " ".join(near)))
        far = list(text)
        for k in rng.choice(300, 60, replace=False):
            far[k] = "other"
        rows.append((10 * i + 2, " ".join(far)))
    got = {r.doc_id: r.component for r in simhash.similar(documents(rows)).collect()}
    assert all(got[10 * i + 1] == 10 * i and got[10 * i + 2] == 10 * i + 2 for i in range(40))


def jaccard(a, b, k=5):
    a, b = ({tuple(t[i : i + k]) for i in range(max(1, len(t) - k + 1))} for t in (a, b))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("blocks", [(256, 1_000_000), (3, 2000)])  # whole components, and components cut into blocks
def test_links_of_similar_texts_equal_brute_force(spark, documents, monkeypatch, blocks):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(simhash, "BLOCK_SHINGLES", blocks[1])
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(5000)]
    texts = {}
    for i in range(100):  # pairs from 0.65 to 0.95
        text = rng.choice(words, 200).tolist()
        near = list(text)
        for at in range(1 + i % 9):
            near[10 + 20 * at] = f"x{i}"
        texts |= {10 * i: text, 10 * i + 1: near}
    text = rng.choice(words, 200).tolist()
    for n in range(40):  # a chain whose ends differ, and members that differ from the first by little
        text = list(text)
        text[5 * n] = "y"
        texts[5000 + n] = text
    links = [(a, b) for a in texts for b in texts if a < b and (a // 10 == b // 10 or a >= 5000 <= b) and jaccard(texts[a], texts[b]) >= 0.8]
    some = [round(jaccard(texts[10 * i], texts[10 * i + 1]), 2) for i in range(9)]
    assert min(some) < 0.67 and max(some) > 0.94
    ids = sorted(texts)
    place = {d: n for n, d in enumerate(ids)}
    label = merged(len(ids), np.array([place[a] for a, _ in links]), np.array([place[b] for _, b in links]), np.arange(len(ids)))
    got = {r.doc_id: r.component for r in simhash.similar(documents([(d, " ".join(t)) for d, t in texts.items()])).collect()}
    wanted = {d: ids[n] for d, n in zip(ids, label.tolist())}
    assert all(wanted[d] == wanted[component] for d, component in got.items())  # no false link, no false chain
    assert sum(got[d] != wanted[d] for d in ids) <= 1  # the search is one by chance


def test_short_and_equal_sets(spark, documents):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (3, "a b c d e f g h i j k"), (4, ""), (5, None), (6, "x"), (6, "y"), (None, "x")]
    got = simhash.similar(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.component) for r in got) == [(0, 6), (1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (6, 6), (6, 6)]


def test_components(spark):
    chain = [(i + 1, i) for i in range(200)]
    star = [(1000, x) for x in range(1001, 1300)]
    links = spark.createDataFrame([*chain, *star, *star, (5000, 5000), (None, 3), (7001, 7000)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}, 7000: 7000, 7001: 7000}
    assert components(links.limit(0)).count() == 0


# Pipeline


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = written(stage(spark, docs, folder), name)
        assert docs.columns == before.columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    texts = texts_of(folder)
    rejected = {r.doc_id for r in toxicity.judged(spark.read.parquet(f"{folder}/documents.parquet"), labels).collect() if r.rejected}
    assert set(kept["toxicity"]) == set(texts) - rejected
    first = {}
    for i in sorted(kept["toxicity"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i] or ""), i)
    assert set(kept["exact_dedup"]) == set(first.values())
    assert set(kept["simhash_dedup"]) <= set(kept["exact_dedup"]) and set(kept["secrets"]) == set(kept["simhash_dedup"])
    assert any("<secret>" in t for t in kept["secrets"].values())
    rows = corpus_pipeline.pack(spark, docs, folder).collect()
    check_packing(rows, kept["secrets"])


def test_pipeline_takes_empty_and_odd_documents(spark, documents, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (ODD, []):
        docs = documents(rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        assert (docs.count() > 0) == bool(rows)


def test_no_text_is_cut_into_slices_wrongly():
    from trailmart.llm.flat import slices

    batch = pa.record_batch([pa.array(["x" * 10, None, "", "y" * 100, "z"])], names=["t"])
    parts = list(slices(batch, "t", 20))
    assert sum(len(p) for p in parts) == 5 and [v for p in parts for v in p.column(0).to_pylist()] == batch.column(0).to_pylist()
