"""Many texts as one flat byte array: word boundaries and word hashes without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1_000_000
#: An odd multiplier, its inverse modulo 2^64, and the finishing constants of a 64-bit mixer.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)

_powers: dict[str, np.ndarray] = {}


def byte_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """Per byte: 0 for a separator, else one more than the byte, A-Z lowered."""
    out = np.arange(1, 257, dtype=np.uint16)
    if lower:
        out[65:91] += 32
    out[list(separators)] = 0
    return out


#: ``[\x20\x09-\x0D]`` separates.
SPACED = byte_table(b" \t\n\v\f\r")
#: Only ASCII letters and the bytes of other characters are kept.
LETTERS = byte_table(bytes(b for b in range(128) if not chr(b).isalpha()))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each text; a null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` text bytes; one longer text is a run of its own."""
    _, at = flat(batch.column(column))
    begin = 0
    while begin < len(batch):
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + size, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def boundaries(coded: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the text it is in. Words never reach over the end of a text."""
    inside = coded != 0
    first = np.zeros(len(coded) + 1, bool)
    first[at] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 4 * SLICE_BYTES:
            _powers[str(base)] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(MIX[0])
    h ^= h >> np.uint64(33)
    h *= np.uint64(MIX[1])
    return h ^ (h >> np.uint64(33))


def hashes(coded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a polynomial by prefix sums, shifted to the word's start, then mixed."""
    total = np.empty(len(coded) + 1, np.uint64)
    total[0] = 0
    np.cumsum(coded.astype(np.uint64) * _power(BASE, len(coded)), out=total[1:])
    return mixed((total[ends] - total[starts]) * _power(INVERSE, len(coded))[starts])


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[i] : starts[i] + lengths[i]]`` one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return values[np.arange(total) + shift]
