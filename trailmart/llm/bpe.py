"""BPE encoding and decoding by batched numpy merge rounds.

The distinct white-space chunks of a batch are found by their hashes, the unknown ones are cut into
pre-tokens, and the symbols of all those words lie in one flat array. Each round finds the rank of every
adjacent pair by binary search over the sorted pair keys and merges, in each word, its lowest-ranked pair.
A bounded table of chunks already seen serves the following batches of the same worker.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .flat import SPACED, boundaries, flat, hashes, ragged, slices
from .frames import ship

#: Most chunks kept per worker; the table starts anew beyond that.
KEPT_CHUNKS = 800_000


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Encoder:
    """A BPE vocabulary with end-of-word symbols, read from a ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + suffix] for c in letters], np.int64)
        self.size = 1 + max([*vocab.values(), *added.values()])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        into = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys, rank = left * self.size + right, np.arange(len(pairs))
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.into = keys[order], rank[order], into
        # A merge may be applied to all its places of a word at once if no pair with its result ranks lower.
        lowest = np.full(self.size, len(pairs), np.int64)
        np.minimum.at(lowest, left, rank)
        np.minimum.at(lowest, right, rank)
        self.together = lowest[into] > rank
        self.special = {k.encode(): v for k, v in added.items()}
        self.special_at = regex.compile(b"|".join(map(regex.escape, self.special)) or b"(?!)")
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}") + "|\n")
        self.tokens = {v: k for k, v in {**vocab, **added}.items()}
        texts = [self.tokens.get(i, "").encode() for i in range(self.size)]
        self.token_bytes = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
        self.token_length = np.array([len(t) + 1 for t in texts], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.known_start = np.empty(0, np.int64)
        self.known_length = np.empty(0, np.int64)
        self.known_ids = np.empty(0, np.int32)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols of words given as a flat symbol array and word lengths."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        word = np.arange(len(lengths))
        n = lengths.copy()
        while len(symbols):
            owner = np.repeat(np.arange(len(n)), n)
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(hit, self.rank[at], len(self.rank)), len(self.rank))
            start = np.cumsum(n) - n
            best = np.minimum.reduceat(rank, start)
            over = best == len(self.rank)
            if over.any():  # these words have no pair left
                gone = np.repeat(over, n)
                done.append((word[over], n[over], symbols[gone]))
                symbols, rank, owner = symbols[~gone], rank[~gone], None
                word, n, best = word[~over], n[~over], best[~over]
                if not len(symbols):
                    break
                owner, start = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
            place = np.flatnonzero(rank == best[owner])
            w = owner[place]
            first = np.append(True, w[1:] != w[:-1])
            # Of touching places only every second one counts, from the left.
            fresh_run = first | (np.append(0, np.diff(place)) != 1)
            run = np.cumsum(fresh_run) - 1
            even = (np.arange(len(place)) - np.flatnonzero(fresh_run)[run]) % 2 == 0
            place = place[(even & self.together[best[w]]) | first]
            symbols = symbols.copy()
            symbols[place] = self.into[rank[place]]
            n = n - np.bincount(owner[place], minlength=len(n))
            symbols = np.delete(symbols, place + 1)
        if not done:
            return np.empty(0, np.int32), np.zeros(len(lengths), np.int64)
        words = np.concatenate([d[0] for d in done])
        counts = np.concatenate([d[1] for d in done])
        ids = np.concatenate([d[2] for d in done])
        order = np.argsort(words)
        out = ragged(ids, (np.cumsum(counts) - counts)[order], counts[order]).astype(np.int32)
        full = np.zeros(len(lengths), np.int64)
        full[words] = counts
        return out, full

    def pretokens(self, chunks: list[bytes]) -> list[str]:
        """Normalised words of all chunks in turn, a line feed after each chunk but the last."""
        joined = b"\n".join(chunks).decode()
        if joined.isascii():
            return self.words.findall(joined.lower())
        # Letter by letter: a sigma at the end of a word is lowered like any other.
        joined = unicodedata.normalize("NFC", joined).replace("\u03a3", "\u03c3").lower()
        newer = {c for c in set(joined) if unicodedata.category(c) == "Cn"}
        if not newer:
            return self.words.findall(joined)
        # Characters that Python does not know yet: the library says what they are.
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        joined = joined.translate({ord(c): library.normalizer.normalize_str(c) for c in newer})
        pieces = lambda t: len(library.pre_tokenizer.pre_tokenize_str(t))
        kind = {
            ord(c): "a" if pieces("a" + c) == 1 else "0" if pieces(c + c) == 2 else "\ue000"
            for c in set(joined)
            if unicodedata.category(c) == "Cn"
        }
        return [joined[m.start() : m.end()] for m in self.words.finditer(joined.translate(kind))]

    def _learn(self, keys: np.ndarray, chunks: list[bytes]) -> None:
        """Add the ids of chunks not met before; ``keys`` are in order."""
        words = self.pretokens(chunks)
        index = dict.fromkeys(["\n", *words])
        index = dict(zip(index, range(len(index))))
        word = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        chunk = np.cumsum(word == 0)[word != 0]
        word = word[word != 0] - 1
        spelled = [w.encode() for w in index][1:]
        lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
        raw = np.frombuffer(b"".join(spelled), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[raw[ends]]
        ids, counts = self.merge(symbols, lengths)
        flat_ids = ragged(ids, (np.cumsum(counts) - counts)[word], counts[word])
        total = np.bincount(chunk, weights=counts[word], minlength=len(chunks)).astype(np.int64)
        start = np.cumsum(total) - total + len(self.known_ids)
        at = np.searchsorted(self.known, keys)
        self.known_ids = np.concatenate([self.known_ids, flat_ids])
        self.known = np.insert(self.known, at, keys)
        self.known_start = np.insert(self.known_start, at, start)
        self.known_length = np.insert(self.known_length, at, total)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the offset of each text's ids."""
        coded = SPACED[data]
        starts, ends, owner = boundaries(coded, at)
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(at), np.int64)
        unique, where, back = np.unique(hashes(coded, starts, ends), return_index=True, return_inverse=True)
        pos = np.searchsorted(self.known, unique)
        new = np.append(self.known, np.uint64(0))[pos] != unique if len(self.known) else np.ones(len(unique), bool)
        new |= pos >= len(self.known)
        if new.any():
            raw = data.tobytes()
            if len(self.known) + int(new.sum()) > KEPT_CHUNKS:  # the table starts anew with this batch's chunks
                self._forget()
                new = np.ones(len(unique), bool)
            w = where[new]
            self._learn(unique[new], [raw[s:e] for s, e in zip(starts[w].tolist(), ends[w].tolist())])
            pos = np.searchsorted(self.known, unique)
        length, begin = self.known_length[pos][back], self.known_start[pos][back]
        ids = ragged(self.known_ids, begin, length)
        per_text = np.bincount(owner, weights=length, minlength=len(at) - 1).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_text)])

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``; special tokens written in a text become their ids, as the library has it."""
        data, at = flat(texts)
        if not self.special or not self.special_at.search(data):
            return self.encode(data, at)
        pieces, marks, bounds = [], [], []  # texts cut at special tokens, and the ids between the cuts
        raw = data.tobytes()
        for i in range(len(at) - 1):
            text, end = raw[at[i] : at[i + 1]], 0
            for m in self.special_at.finditer(text):
                pieces.append(text[end : m.start()])
                marks.append(self.special[m.group()])
                end = m.end()
            pieces.append(text[end:])
            marks.append(-1)
            bounds.append(len(pieces))
        ends = np.cumsum([len(p) for p in pieces])
        ids, cut = self.encode(np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], ends]))
        marks = np.array(marks)
        have = marks >= 0
        ids = np.insert(ids, cut[1:][have], marks[have])
        after = cut[1:] + np.cumsum(have)
        return ids, np.concatenate([[0], after[np.array(bounds) - 1]])

    def decoded(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of ids: their tokens joined by blanks (the vocabulary names no decoder)."""
        return ragged(self.token_bytes, self.token_start[ids], self.token_length[ids]).tobytes()[:-1]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def per_slice(path: str, text: str, make: Callable) -> Callable:
    """A ``mapInArrow`` function that calls ``make(encoder, rows, ids, offsets)`` on bounded runs of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for rows in slices(batch, text):
                yield make(enc, rows, *enc.encode_texts(rows.column(text)))

    return run


def with_columns(df: DataFrame, **added: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in added.items()]])


def encode(docs: DataFrame, vocab: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text as an array column ``ids`` (replaced if there is one)."""
    ship(docs.sparkSession)
    rest = docs.drop(ids)
    schema = with_columns(rest, **{ids: T.ArrayType(T.IntegerType())})

    def make(enc, rows, flat_ids, at):
        array = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat_ids, pa.int32()))
        return pa.RecordBatch.from_arrays([*rows.columns, array], names=[*rows.schema.names, ids])

    return rest.mapInArrow(per_slice(vocab or vocabulary(), text, make), schema)


def decode(rows: DataFrame, vocab: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of the ids; null ids give an empty text."""
    ship(rows.sparkSession)
    rest = rows.drop(text)
    if ids not in rest.columns:
        raise ValueError(f"no column {ids}")
    path = vocab or vocabulary()

    def run(batches):
        enc = encoder(path)
        for b in batches:
            made = [enc.decoded(np.array(x or [], np.int64)).decode() for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], names=[*b.schema.names, text])

    return rest.mapInArrow(run, with_columns(rest, **{text: T.StringType()}))


def digests(docs: DataFrame, vocab: str | None = None) -> DataFrame:
    """One row per document: number of ids, and digests of the ids and of the decoded text.

    Null and empty texts have no ids; repeated rows give repeated rows; other columns are not read.
    """
    ship(docs.sparkSession)

    def make(enc, rows, ids, at):
        words = ids.astype("<u4")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        spans = list(zip(at[:-1].tolist(), at[1:].tolist()))
        return pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"),
                pa.array(np.diff(at), pa.int64()),
                pa.array([sha(words[a:b]) for a, b in spans], pa.string()),
                pa.array([sha(enc.decoded(ids[a:b])) for a, b in spans], pa.string()),
            ],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        per_slice(vocab or vocabulary(), "text", make),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )


def crc32(words: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(words.astype("<u4")))
