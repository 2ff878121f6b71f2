"""Toxicity by a classifier chain.

Categories come one after the other. Each has a linear model over the words of a text and over the chances
of the categories before it. While training, those chances are out-of-fold: every labelled text gets them
from a model that has not seen it, so a later link learns how far to trust an earlier one. The links that
score are fitted on all folds.

Words are runs of letters, lower-cased, known by 64-bit hashes. Features are the ``WORDS_PER_CATEGORY`` words
whose presence tells most about each category, out of those in ``LEAST_TEXTS`` labelled texts or more; the
value is log(1 + count).

The models are fitted on a bounded sample: about ``SAMPLE`` labelled rows, those with the smallest hash of
their key. All documents are scored, over their whole texts.

Defined results: null and empty texts have no words and get the chances of the intercepts, but are never
rejected; null or repeated keys are scored each; without labels of both kinds nothing is rejected and all
chances are the share of positives. Columns named like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import LETTERS, boundaries, flat, hashes, slices
from .frames import fresh, ship

SAMPLE = 8_000
WORDS_PER_CATEGORY = 100
LEAST_TEXTS = 3
FOLDS = 3
PENALTY = 0.3
REJECT = 0.5
MOST_ROUNDS = 25


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the text it is in."""
    data, at = flat(texts)
    coded = LETTERS[data]
    starts, ends, owner = boundaries(coded, at)
    return hashes(coded, starts, ends), owner


def features(hashed: np.ndarray, owner: np.ndarray, rows: int, vocabulary: np.ndarray, count: np.ndarray | None = None) -> np.ndarray:
    """log(1 + count) of each word of the vocabulary (sorted hashes), one row per text."""
    n = len(vocabulary)
    if not n or not len(hashed):
        return np.zeros((rows, n))
    at = np.minimum(np.searchsorted(vocabulary, hashed), n - 1)
    hit = vocabulary[at] == hashed
    weights = None if count is None else count[hit]
    return np.log1p(np.bincount(owner[hit] * n + at[hit], weights, rows * n)).reshape(rows, n)


def telling(hashed: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The words whose presence says most about a category (likelihood ratio), as sorted hashes.

    Every text names each of its words once.
    """
    if not len(hashed):
        return np.empty(0, np.uint64)
    word, where = np.unique(hashed, return_inverse=True)
    texts = np.bincount(where)
    chosen = np.zeros(len(word), bool)
    n = len(labels)

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    for c in range(labels.shape[1]):
        y = labels[:, c]
        with_word = np.bincount(where, weights=y[owner])
        share = y.mean()
        gain = sum(
            part(seen, size * chance)
            for seen, size, chance in (
                (with_word, texts, share), (texts - with_word, texts, 1 - share),
                (y.sum() - with_word, n - texts, share), (n - texts - y.sum() + with_word, n - texts, 1 - share),
            )
        )
        gain[texts < LEAST_TEXTS] = 0
        best = np.argsort(-gain, kind="stable")[:WORDS_PER_CATEGORY]
        chosen[best[gain[best] > 0]] = True
    return word[chosen]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Penalised logistic regression by Newton steps: the weights of the columns, then the intercept."""
    n, k = x.shape
    x = np.column_stack([x, np.ones(n)])
    share = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    w = np.append(np.zeros(k), np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return np.append(np.zeros(k), -35.0)
    penalty = np.append(np.full(k, PENALTY), 1e-9)
    for _ in range(MOST_ROUNDS):
        p = sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (p - y) + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def chances(x: np.ndarray, links: list[np.ndarray]) -> np.ndarray:
    """Chance of each category in turn, earlier ones fed to later ones."""
    words = x.shape[1]
    for w in links:
        x = np.column_stack([x, sigmoid(x @ w[:-1] + w[-1])])
    return x[:, words:]


def fit_chain(x: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The links fitted on all rows, and the out-of-fold chances that trained them."""
    links, words = [], x.shape[1]
    for c in range(labels.shape[1]):
        y = labels[:, c]
        held = np.full(len(x), y.mean() if len(y) else 0.0)
        for f in range(FOLDS):
            out, inside = fold == f, fold != f
            if out.any() and inside.any():
                w = fit(x[inside], y[inside])
                held[out] = sigmoid(x[out] @ w[:-1] + w[-1])
        links.append(fit(x, y))
        x = np.column_stack([x, held])
    return links, x[:, words:]


def train(docs: DataFrame, labels: DataFrame, categories: list[str], key: str = "doc_id", text: str = "text", sample: int = SAMPLE):
    """(vocabulary, links, held-out accuracies). The fit is one task over the bounded sample; its weights reach the driver."""
    ship(docs.sparkSession)
    chosen = labels.select(F.col(key).alias("key"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(categories)])
    chosen = chosen.dropna().dropDuplicates(["key"])
    n = max(1, chosen.count())
    limit = int(min(1.0, sample / n) * ((1 << 62) - 1))
    chosen = chosen.where(F.shiftrightunsigned(F.xxhash64("key"), 2) <= limit)
    # About ``sample`` rows of numbers.
    known = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), "key")
    fields = [f"c{i}" for i in range(len(categories))]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct words of each labelled text with their counts, in place of the text."""
        for batch in batches:
            for part in slices(batch, "text"):
                h, owner = words(part.column("text"))
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))[: len(h)])
                count = np.diff(np.append(first, len(h)))
                at = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=len(part)))]), pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (h[first].view(np.int64), count)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").cast(pa.string()), *lists, *[part.column(c) for c in fields]],
                    names=["key", "words", "counts", *fields],
                )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches), schema=schema).combine_chunks()
        got = got.take(pa.array(np.argsort(np.array(got.column("key").to_pylist(), str), kind="stable")))
        lists = got.column("words").combine_chunks()
        owner = np.repeat(np.arange(got.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        h = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        count = got.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        y = np.column_stack([got.column(c).to_numpy() for c in fields]) if got.num_rows else np.zeros((0, len(fields)))
        vocabulary = telling(h, owner, y)
        x = features(h, owner, got.num_rows, vocabulary, count)
        fold = np.arange(got.num_rows) % FOLDS
        links, held = fit_chain(x, y, fold)
        weights = pa.array([w for w in links], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(links)), pa.int32()),
                weights,
                pa.array([vocabulary.view(np.int64)] * len(links), pa.list_(pa.int64())),
                pa.array([float(((held[:, c] >= REJECT) == y[:, c]).mean()) if len(y) else None for c in range(len(links))], pa.float64()),
            ],
            names=["link", "weights", "vocabulary", "held_out_accuracy"],
        )

    schema = pa.schema([("key", pa.string()), ("words", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), *[(c, pa.float64()) for c in fields]])
    sql = "key string, words array<bigint>, counts array<bigint>, " + ", ".join(f"{c} double" for c in fields)
    model = (
        known.mapInArrow(counted, sql)
        .repartition(1)
        .mapInArrow(fitted, "link int, weights array<double>, vocabulary array<bigint>, held_out_accuracy double")
        .orderBy("link")
        .collect()
    )
    if not model:
        return np.empty(0, np.uint64), [np.append(np.zeros(i), -35.0) for i in range(len(categories))], []
    vocabulary = np.array(model[0].vocabulary, np.int64).view(np.uint64)
    return vocabulary, [np.array(r.weights) for r in model], [r.held_out_accuracy for r in model]


def score(docs: DataFrame, vocabulary: np.ndarray, links: list[np.ndarray], categories: list[str], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the chance ``p_<category>`` of each, and ``rejected`` by the last."""
    ship(docs.sparkSession)
    names = [f"p_{c}" for c in categories] + ["rejected"]
    taken = {n.lower() for n in names}
    carried = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
    read = fresh(docs, "_scored")
    rows = docs.select(*carried, F.col(text).cast("string").alias(read))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, read):
                h, owner = words(part.column(read))
                p = chances(features(h, owner, len(part), vocabulary), links)
                some = np.bincount(owner, minlength=len(part)) > 0
                made = [pa.array(p[:, i]) for i in range(p.shape[1])] + [pa.array((p[:, -1] >= REJECT) & some)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*carried, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carried).schema)
    schema = ", ".join([*([schema] if schema else []), *[f"`{n}` double" for n in names[:-1]], "rejected boolean"])
    return rows.mapInArrow(run, schema)


#: Kinds of toxic texts that the label table tells apart, then toxic texts of any kind.
CHAIN = ["toxic_prose", "toxic_junk", "toxic"]


def kinds(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The chain's categories from the columns ``toxic`` and ``quality``."""
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    return labels.where("toxic is not null").select(
        key,
        (toxic & F.coalesce(good, F.lit(True))).cast("int").alias("toxic_prose"),
        (toxic & ~F.coalesce(good, F.lit(True))).cast("int").alias("toxic_junk"),
        toxic.cast("int").alias("toxic"),
    )


def judged(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, key: str = "doc_id", text: str = "text", among: DataFrame | None = None) -> DataFrame:
    """Fit the chain on labelled documents (of ``among``, by default ``docs``) and score ``docs``."""
    vocabulary, links, _ = train(docs if among is None else among, kinds(labels, key), CHAIN, key, text)
    return score(docs, vocabulary, links, CHAIN, text, keep)
