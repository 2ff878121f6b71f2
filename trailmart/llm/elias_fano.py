"""Elias-Fano coded sorted whole numbers, and a container whose arrays are read where they lie."""

from __future__ import annotations

import json

import numpy as np


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays one after the other, each at a multiple of eight bytes, behind a header that lists them."""
    head, body, at = [], [], 0
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        head.append((name, a.dtype.str, len(a), at))
        raw = a.tobytes()
        body.append(raw + b"\0" * (-len(raw) % 8))
        at += len(body[-1])
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return np.array([len(text)], "<u8").tobytes() + text + b"".join(body)


def unpack(buffer) -> dict[str, np.ndarray]:
    """Views into ``buffer`` (bytes, an Arrow buffer or a memory map); nothing is copied."""
    size = int(np.frombuffer(buffer, "<u8", 1)[0])
    head = json.loads(bytes(memoryview(buffer)[8 : 8 + size]))
    return {n: np.frombuffer(buffer, np.dtype(d), k, 8 + size + at) for n, d, k, at in head}


class EliasFano:
    """A sorted sequence: ``width`` low bits of each value in words, the high parts in unary."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        ones = np.flatnonzero(np.unpackbits(high, bitorder="little"))[:n]
        self.upper = (ones - np.arange(n)).astype(np.uint64)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        width = max(0, int(values[-1]).bit_length() - n.bit_length()) if n else 0
        low = np.zeros((n * width >> 6) + 2, np.uint64)
        if width:
            rest = values & np.uint64((1 << width) - 1)
            bit = np.arange(n, dtype=np.uint64) * np.uint64(width)
            word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
            np.add.at(low, word, rest << shift)  # no two values share a bit
            over = np.flatnonzero(shift + np.uint64(width) > 64)
            np.add.at(low, word[over] + 1, rest[over] >> (np.uint64(64) - shift[over]))
        marks = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(marks[-1]) + 1 if n else 0, np.uint8)
        bits[marks] = 1
        return cls(n, width, low, np.packbits(bits, bitorder="little"))

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.n": np.array([self.n, self.width]), f"{name}.low": self.low, f"{name}.high": self.high}

    @classmethod
    def view(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, width = arrays[f"{name}.n"].tolist()
        return cls(n, width, arrays[f"{name}.low"], arrays[f"{name}.high"])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.uint64) * np.uint64(self.width)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        # Two shifts: one by 64 is not defined.
        value = (self.low[word] >> shift) | (self.low[word + 1] << (np.uint64(63) - shift) << np.uint64(1))
        return value & np.uint64((1 << self.width) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return (self.upper[i] << np.uint64(self.width)) | self._low(i)

    def successor(self, x: np.ndarray, low: np.ndarray | None = None, high: np.ndarray | None = None) -> np.ndarray:
        """Place of the first value not below ``x``, looked for in places ``low`` to ``high`` only."""
        x = x.astype(np.uint64)
        part = x >> np.uint64(self.width)
        a = np.searchsorted(self.upper, part, "left")
        b = np.searchsorted(self.upper, part, "right")
        if low is not None:
            a, b = np.maximum(a, low), np.minimum(np.maximum(b, low), high)
            a = np.minimum(a, high)
        rest = x & np.uint64((1 << self.width) - 1)
        open_ = np.flatnonzero(a < b)
        while len(open_):
            middle = (a[open_] + b[open_]) >> 1
            less = self._low(middle) < rest[open_]
            a[open_] = np.where(less, middle + 1, a[open_])
            b[open_] = np.where(less, b[open_], middle)
            open_ = open_[a[open_] < b[open_]]
        return a

    def find(self, x: np.ndarray, low: np.ndarray | None = None, high: np.ndarray | None = None) -> np.ndarray:
        """Place of each ``x``, -1 where it is absent."""
        if not self.n:
            return np.full(len(x), -1)
        at = self.successor(x, low, high)
        end = np.full(len(x), self.n) if high is None else high
        inside = at < end
        safe = np.where(inside, at, 0)
        return np.where(inside & (self[safe] == x.astype(np.uint64)), at, -1)
