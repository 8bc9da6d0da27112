"""Compact cells: what one batch of documents sends to one hash bucket, packed into a single binary value.

A shuffle row per token costs some forty bytes. A cell holds a batch's sorted 40-bit keys of one bucket as differences in
byte planes (high planes are nearly all zero, which the shuffle's compression removes), and side columns as planes too.
"""

from __future__ import annotations

import ctypes
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KEY_BITS = 40
KEY_MASK = np.uint64((1 << KEY_BITS) - 1)


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of unsigned values, one plane per byte."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data[: n * width], np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def pack(keys: np.ndarray, columns: list[tuple[np.ndarray, int]]) -> bytes:
    """Sorted keys and side columns (values, bytes each)."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return b"".join([len(keys).to_bytes(4, "little"), planes(steps, 5), *[planes(v, w) for v, w in columns]])


def unpack(data: bytes, widths: list[int]) -> list[np.ndarray]:
    n, held, at = int.from_bytes(data[:4], "little"), memoryview(data), 4
    out = [np.cumsum(from_planes(held[at:], n, 5), dtype=np.uint64)]
    at += 5 * n
    for w in widths:
        out.append(from_planes(held[at:], n, w))
        at += w * n
    return out


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket per 64-bit hash, from bits that the 40-bit key doesn't hold, so that bucket and key together tell more."""
    return ((hashes >> np.uint64(KEY_BITS)) % np.uint64(buckets)).astype(np.int64)


def batch_name(partition: int, number: int, ids: list) -> int:
    """Names a batch by its place and its ids: a scan that runs again gives the same name only with the same rows."""
    told = hashlib.blake2b(repr((partition, number, ids)).encode(), digest_size=8).digest()
    return int.from_bytes(told, "little") >> 1


def slices(batch: pa.RecordBatch, most_rows: int, most_bytes: int):
    """Consecutive parts of an Arrow batch of at most that many rows and (but for a single long text) text bytes."""
    sizes = [0 if x is None else x for x in pc.binary_length(batch["text"]).to_pylist()]
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= most_rows or total + size > most_bytes):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield batch.slice(start)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give memory of finished batches back to the machine; a worker lives through many tasks and stages.

    Arrow's pool and, where the C library can (glibc), the free pages of its heap, which holds texts and arrays.
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def geometric(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers modulo 2**64."""
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class Rolling:
    """Prefix polynomial hashes modulo 2**64 over random byte values: the hash of any stretch in constant time.

    Long stretches of a doubling structure (Thue-Morse words and their complements, from about 1,000 bytes) have equal
    hashes under every base; use it for short ones, and ``Blended`` for others.
    """

    BASE = np.uint64(0x9E3779B97F4A7C15)
    INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    VALUES = np.random.default_rng(2024).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    #: A power is the product of one below ``NEAR`` and one of a multiple of it, so a worker keeps no table as long as its data.
    NEAR_BITS = 12
    NEAR = 1 << NEAR_BITS
    AT_ONCE = 16 * NEAR
    _near: dict[np.uint64, np.ndarray] = {}
    _far: dict[np.uint64, np.ndarray] = {}

    @classmethod
    def _grow(cls, n: int) -> None:
        for base in (cls.BASE, cls.INVERSE):
            if base not in cls._near:
                cls._near[base] = geometric(base, cls.NEAR)
            if base not in cls._far or len(cls._far[base]) <= n >> cls.NEAR_BITS:
                far = np.uint64(pow(int(base), cls.NEAR, 1 << 64))
                cls._far[base] = geometric(far, max(64, 2 * (n >> cls.NEAR_BITS) + 2))

    def __init__(self, data: np.ndarray):
        self._sum(len(data), lambda a, b: self.VALUES[data[a:b]])

    def _sum(self, n: int, values) -> None:
        """Prefix sums of ``n`` values, of which ``values(a, b)`` gives a stretch."""
        self._grow(n)
        self.prefix = np.zeros(n + 1, np.uint64)
        near, far = self._near[self.BASE], self._far[self.BASE]
        for a in range(0, n, self.AT_ONCE):
            b = min(a + self.AT_ONCE, n)
            of_far = far[a >> self.NEAR_BITS : ((b - 1) >> self.NEAR_BITS) + 1]
            powers = near[: b - a] if b <= self.NEAR else (of_far[:, None] * near).ravel()[: b - a]
            np.cumsum(values(a, b) * powers, out=self.prefix[a + 1 : b + 1])
            self.prefix[a + 1 : b + 1] += self.prefix[a]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of [start, end), equal for equal bytes wherever they are."""
        out = self.prefix[end] - self.prefix[start]
        if len(self.prefix) <= self.NEAR:
            return out * self._near[self.INVERSE][start]
        out *= self._near[self.INVERSE][start & (self.NEAR - 1)]
        out *= self._far[self.INVERSE][start >> self.NEAR_BITS]
        return out


class Blended(Rolling):
    """The same over mixed numbers of eight neighbouring bytes, for stretches of eight bytes or more.

    The numbers of a word and of its complement differ in no pattern, so doubling structures don't cancel.
    """

    WIDTH = 8
    SALT = np.uint64(0xD6E8FEB86659FD93)

    def __init__(self, data: np.ndarray):
        data = np.ascontiguousarray(data)
        n = max(0, len(data) - self.WIDTH + 1)
        eight = np.ndarray((n,), "<u8", buffer=data, strides=(1,)) if n else np.empty(0, np.uint64)
        self._sum(n, lambda a, b: mix(eight[a:b] ^ self.SALT))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return super().of(start, end - (self.WIDTH - 1))


def of_long(data: np.ndarray, least: int) -> Rolling:
    """Hashes of stretches of ``least`` bytes or more."""
    return Blended(data) if least >= Blended.WIDTH else Rolling(data)
