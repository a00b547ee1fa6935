"""Words and word sequences of a whole Arrow column at once, as arrays of byte positions and 64-bit hashes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd factors of the rolling hashes (bytes within a word, words within a sequence).
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


@lru_cache(maxsize=None)
def classes(kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, its value) for the 256 bytes. ``alnum``: digits, letters in lower case and all beyond ASCII.
    ``space`` and ``space_lower``: everything but the six white space characters of ASCII."""
    b = np.arange(256)
    value = b.astype(np.uint8)
    if kind != "space":
        value[65:91] += 32
    if kind == "alnum":
        word = ((b >= 48) & (b <= 57)) | ((b >= 65) & (b <= 90)) | ((b >= 97) & (b <= 122)) | (b >= 128)
    else:
        word = (b != 32) & ((b < 9) | (b > 13))
    return word, value


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n, grown as needed."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        both = []
        for x in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, x, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[base] = tuple(both)
    p, q = _powers[base]
    return p[:n], q[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, null as empty, and the offset of each row."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


class Words:
    """Words of the rows of a string column. ``first[i]:first[i+1]`` are row i's words."""

    def __init__(self, column: pa.Array, kind: str):
        word, value = classes(kind)
        data, offsets = text_bytes(column)
        self.bytes = value[data]
        w = word[data]
        before, after = np.zeros(len(w), bool), np.zeros(len(w), bool)
        before[1:], after[:-1] = w[:-1], w[1:]
        cut = offsets[(offsets > 0) & (offsets < len(w))]
        before[cut] = False
        after[cut - 1] = False
        self.start, self.end = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def text(self, i: int, j: int) -> list[bytes]:
        b = self.bytes
        return [b[s:e].tobytes() for s, e in zip(self.start[i:j].tolist(), self.end[i:j].tolist())]

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one space after each, and where each begins and ends there."""
        size = self.end - self.start
        start = np.cumsum(size + 1) - size - 1
        out = np.full(int(size.sum()) + len(size), 32, np.uint8)
        from_start = np.repeat(self.start - start, size)
        at = np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)
        out[at] = self.bytes[at + from_start]
        return out.tobytes(), start, start + size

    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        p, q = _power(BYTE_BASE, len(self.bytes) + 1)
        total = np.zeros(len(self.bytes) + 1, np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * p[:-1], out=total[1:])
        return total, q

    def hashes(self) -> np.ndarray:
        total, q = self._sums()
        return mix((total[self.end] - total[self.start]) * q[self.start])

    def parts(self, sizes: tuple[int, ...]) -> list[np.ndarray]:
        """Hashes of the words, then for each size of their first bytes; a word that is no longer has its own hash there."""
        total, q = self._sums()
        out = [mix((total[self.end] - total[self.start]) * q[self.start])]
        for k in sizes:
            longer = self.start + k < self.end
            cut = mix((total[np.minimum(self.start + k, self.end)] - total[self.start]) * q[self.start] + np.uint64(k))
            out.append(np.where(longer, cut, out[0]))
        return out


def sums(h: np.ndarray) -> np.ndarray:
    """Running sums from which :func:`gram` takes the hash of any sequence of words."""
    p, _ = _power(WORD_BASE, len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * p[:-1], out=total[1:])
    return total


def gram(total: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Hashes of the sequences of words i to j, whatever their place."""
    _, q = _power(WORD_BASE, len(total))
    return mix((total[j] - total[i]) * q[i])


def sequence_hash(words: list[bytes]) -> int:
    """The same hash of a list of words (lower case where the class asks for it)."""
    if not words:
        return 0
    joined = Words(pa.array([b"\x20".join(words).decode("utf-8", "surrogateescape")]), "space")
    return int(gram(sums(joined.hashes()), np.array([0]), np.array([len(joined)]))[0])
