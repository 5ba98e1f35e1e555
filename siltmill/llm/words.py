"""Words, word hashes and k-grams of many texts at once, in numpy.

Texts stay one UTF-8 byte buffer. Word classes are decided by byte, which is
exact for both word definitions used here, because every byte of a non-ASCII
character is 0x80 or more. A word's hash is a polynomial over its lower-cased
bytes modulo 2**64, taken from prefix sums, then mixed; equal words have equal
hashes on every machine and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
#: Texts are handled in runs of about so many bytes; a longer text is a run of its own.
CHUNK = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_Q = U(0xD6E8FEB86659FD93)

#: Classes of bytes: ``alnum`` is [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing, ``space`` is [^\x20\x09-\x0D].
CLASSES = {
    "alnum": np.array([b >= 128 or chr(b).isalnum() for b in range(256)]),
    "space": np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)]),
}
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finaliser)."""
    x = np.asarray(x, dtype=U)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_VALUE = mix(LOWER.astype(U) + U(1))
_RAW_VALUE = mix(np.arange(256, dtype=U) + U(1))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U), np.ones(1, U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**0..P**n and their inverses; kept, but for lengths that only one long text needs."""
    global _powers
    if len(_powers[0]) > n:
        return _powers
    size = max(n + 1, CHUNK + (CHUNK >> 1))
    made = []
    for p in (_P, _P_INV):
        out = np.full(size, U(p))
        out[0] = 1
        made.append(np.multiply.accumulate(out))
    if size <= 4 * CHUNK:
        _powers = (made[0], made[1])
    return made[0], made[1]


@dataclass
class Words:
    """Words of a run of texts: byte ranges, hashes and, per text, the range of its words."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # per text, index of its first word; one more entry at the end
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def string(self, i: int) -> str:
        return LOWER[self.buf[self.start[i] : self.end[i]]].tobytes().decode("utf-8", "replace")


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def _sum_of(value, lo: int, hi: int) -> int:
    """The polynomial of one long range, block by block."""
    total, factor = 0, 1
    for a in range(lo, hi, CHUNK):
        v = value(a, min(a + CHUNK, hi))
        total += factor * int((v * powers(len(v))[0][: len(v)]).sum(dtype=U))
        factor = factor * pow(_P, len(v), 1 << 64) % (1 << 64)
    return total % (1 << 64)


def range_hashes(value, n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of ranges of the n values that ``value(lo, hi)`` gives. A range's hash doesn't depend on where it stands,
    so prefix sums are taken over pieces, and memory is that of a piece however long a text is."""
    if n <= 2 * CHUNK:
        up, down = powers(n)
        total = np.zeros(n + 1, U)
        np.cumsum(value(0, n) * up[:n], out=total[1:])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(U))
    out = np.empty(len(start), U)
    order = np.argsort(start, kind="stable")
    a, b = start[order], end[order]
    reach = np.maximum.accumulate(b) if len(b) else b
    i = 0
    while i < len(a):
        lo = int(a[i])
        j = max(i + 1, int(np.searchsorted(reach, lo + CHUNK, "right")))
        hi = int(b[i:j].max())
        if hi - lo > CHUNK:
            out[order[i]] = mix(np.array([(_sum_of(value, lo, hi) + hi - lo) % (1 << 64)], U))[0]
        else:
            up, down = powers(hi - lo)
            total = np.zeros(hi - lo + 1, U)
            np.cumsum(value(lo, hi) * up[: hi - lo], out=total[1:])
            s, e = a[i:j] - lo, b[i:j] - lo
            out[order[i:j]] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U))
        i = j
    return out


def hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray = _VALUE) -> np.ndarray:
    """Mixed 64-bit hashes of byte ranges."""
    return range_hashes(lambda lo, hi: value[buf[lo:hi]], len(buf), start, end)


def split(buf: np.ndarray, offsets: np.ndarray, kind: str) -> Words:
    """The words of the texts that ``offsets`` cuts ``buf`` into."""
    n, found = len(buf), []
    for lo in range(0, n, 4 * CHUNK):  # in pieces, for the flags of one
        hi = min(n, lo + 4 * CHUNK)
        inside = np.zeros(hi - lo + 2, bool)
        a, b = max(lo - 1, 0), min(hi + 1, n)
        inside[a - lo + 1 : b - lo + 1] = CLASSES[kind][buf[a:b]]
        cut = np.zeros(hi - lo + 1, bool)
        cut[offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi, "right")] - lo] = True
        found.append((np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1])) + lo, np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + lo + 1))
    start, end = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    return Words(buf, start, end, hashes(buf, start, end), np.searchsorted(start, offsets), offsets)


def runs(texts: pa.Array, kind: str, chunk: int = CHUNK) -> Iterator[tuple[int, int, Words]]:
    """(first row, row behind the last, words) of runs of at most about ``chunk`` bytes."""
    buf, offsets = buffer_of(texts)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + chunk, "right")) - 1)
        yield i, j, split(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], kind)
        i = j


def kgrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive words at every place where k words remain."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out = h[k - 1 : k - 1 + n].copy()
    for j in range(k - 2, -1, -1):
        out *= _Q
        out += h[j : j + n]
    return mix(out)


def expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, x) for every x of lo[i]..hi[i]-1."""
    n = hi - lo
    i = np.repeat(np.arange(len(lo)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
