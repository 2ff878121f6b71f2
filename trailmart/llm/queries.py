"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact, itq, licences, merkle, mixing, ngram, packing, phrases, secrets_scan, sharding, simhash, toxicity
from .frames import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.scored(table(spark, sf_dir, "documents"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"), leaves=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.decisions(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.spelled(F.col("code")).alias("fingerprint"), F.col("component").alias("component_id"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    docs = table(spark, sf_dir, "documents")
    return merkle.verified(merkle.manifest(docs, changed={"n_chars": F.col("n_chars") + 1}, when=picked))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_language_model": op2_language_model,
    "op3_shards": op3_shards,
    "op4_embeddings": op4_embeddings,
    "op5_bpe": op5_bpe,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_secrets": op9_secrets,
    "op10_licences": op10_licences,
    "op11_mixing": op11_mixing,
    "op12_phrases": op12_phrases,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)
    """,
    "op12_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), words AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
        ), grams AS (
            SELECT lang, len(g) AS k, array_to_string(g, ' ') AS phrase, count(*) AS n
            FROM (SELECT lang, unnest(flatten(list_transform(range(1, 6), lambda k: list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])))) AS g FROM words)
            GROUP BY ALL
        ), totals AS (SELECT lang, sum(n)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
        many AS (SELECT * FROM grams WHERE n >= 100),
        cuts AS (
            SELECT m.lang, m.k, m.phrase, m.n AS a, c,
                   array_to_string(string_split(m.phrase, ' ')[:c], ' ') AS head, array_to_string(string_split(m.phrase, ' ')[c + 1:], ' ') AS tail
            FROM many m, range(1, 5) r(c) WHERE c < m.k
        ), scores AS (
            SELECT x.*, h.n AS l, t.n AS r, totals.n AS n, (1000::HUGEINT * a * totals.n // (h.n::HUGEINT * t.n))::BIGINT AS score
            FROM cuts x JOIN many h ON h.lang = x.lang AND h.phrase = head JOIN many t ON t.lang = x.lang AND t.phrase = tail
            JOIN totals ON totals.lang = x.lang
        ), worst AS (
            SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
        ), inside AS (
            SELECT lang, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2),
                   lambda i: array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' '))))) AS phrase, n
            FROM many WHERE k > 2
        ), longer AS (SELECT lang, phrase, max(n) AS n FROM inside GROUP BY ALL)
        SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank, w.phrase, a, l, r, w.n, score
        FROM worst w LEFT JOIN longer g ON g.lang = w.lang AND g.phrase = w.phrase
        WHERE g.n IS NULL OR 100 * g.n < 100 * a
        QUALIFY rank <= 2000
    """,
    "op13_merkle": r"""
        WITH RECURSIVE fields AS (
            SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(text) || ':' || text, '-') AS tail,
                   xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), lambda c, b:
                       list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) AS crc
            FROM documents
        ), leaves AS (
            SELECT doc_id, lang, sha256(head || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                   CASE WHEN crc % 7 = 0 THEN sha256(head || coalesce(length((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS found
            FROM fields
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS size FROM leaves
        ), nodes AS (
            SELECT 0 AS level, lang, pos, size, leaf AS h FROM placed
            UNION ALL
            SELECT level + 1, lang, pos // 2, (size + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE size > 1 GROUP BY level, lang, pos // 2, size
        ), roots AS (
            SELECT lang, h, level AS depth, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM nodes WHERE size = 1
        ), upper AS (
            SELECT 0 AS level, pos, size, h FROM roots
            UNION ALL
            SELECT level + 1, pos // 2, (size + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM upper WHERE size > 1 GROUP BY level, pos // 2, size
        ), docs AS (
            SELECT p.*, r.h AS subroot, r.depth, r.pos AS place, u.h AS root, u.level AS height, row_number() OVER () AS row
            FROM placed p JOIN roots r ON r.lang IS NOT DISTINCT FROM p.lang, upper u WHERE u.size = 1
        ), steps AS (
            SELECT row, d.depth + d.height AS steps, n.level AS step, n.pos % 2 = 0 AS first, n.h
            FROM docs d JOIN nodes n ON n.lang IS NOT DISTINCT FROM d.lang AND n.level < d.depth AND n.pos = xor(d.pos >> n.level, 1)
            UNION ALL
            SELECT row, d.depth + d.height, d.depth + u.level, u.pos % 2 = 0, u.h
            FROM docs d JOIN upper u ON u.level < d.height AND u.pos = xor(d.place >> u.level, 1)
        ), folds AS (
            SELECT row, 0 AS step, depth + height AS steps, coalesce(found, leaf) AS h FROM docs
            UNION ALL
            SELECT f.row, f.step + 1, f.steps, sha256(CASE WHEN s.first THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END)
            FROM folds f LEFT JOIN steps s ON s.row = f.row AND s.step = f.step WHERE f.step < f.steps
        ), proofs AS (SELECT row, sha256(string_agg(h, '' ORDER BY step)) AS proof FROM steps GROUP BY row)
        SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
        FROM docs d JOIN folds f ON f.row = d.row AND f.step = f.steps LEFT JOIN proofs p ON p.row = d.row
    """,
}
