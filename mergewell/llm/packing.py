"""Sorted 64-bit keys packed for a shuffle, and how a block's keys are dealt to buckets."""

from __future__ import annotations

import ctypes
import zlib
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def squeeze(numbers: np.ndarray) -> bytes:
    """Numbers by byte position, compressed, behind their count."""
    planes = numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unsqueeze(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences."""
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data, np.uint64), dtype=np.uint64)


def pack_runs(numbers: np.ndarray) -> bytes:
    """Numbers that change seldom: each run's number and length."""
    first = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]])) if len(numbers) else np.zeros(0, np.int64)
    values = squeeze(np.ascontiguousarray(numbers[first], np.int64))
    return len(values).to_bytes(8, "little") + values + squeeze(np.diff(np.append(first, len(numbers))).astype(np.uint32))


def unpack_runs(data: bytes) -> np.ndarray:
    at = 8 + int.from_bytes(data[:8], "little")
    return np.repeat(unsqueeze(data[8:at], np.int64), unsqueeze(data[at:], np.uint32))


def tidy() -> None:
    """Gives memory that is free back to the system, which shares it with the JVM and with other workers."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_keys(texts: list[str | None], keys: dict[bytes, int], chars: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all words of the texts in lower case (A-Z), and how many each text has.

    Texts are split a few at a time, so that words are not all held at once.
    """
    size, flat, part, waiting = np.zeros(len(texts), np.int64), [np.zeros(0, np.uint64)], [], 0
    for k, text in enumerate(texts):
        words = (text or "").encode().lower().split()
        size[k] = len(words)
        part.append(words)
        waiting += len(text or "")
        if waiting > chars or k == len(texts) - 1:
            flat.append(np.fromiter((h for w in part for h in map(keys.__getitem__, w)), np.uint64, sum(map(len, part))))
            part, waiting = [], 0
    return np.concatenate(flat), size


def bounds(buckets: int) -> np.ndarray:
    """The first key of each bucket after bucket 0: equal ranges of the key space."""
    return np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)


def aside(block: int) -> int:
    """The bucket below 0 that takes a block's own row past the buckets of keys.

    Block numbers are a partition's number in the high bits and a small one in the
    low bits; a hash spreads them over the tasks, where a remainder would put most
    into a few.
    """
    return -1 - (zlib.crc32(block.to_bytes(8, "little")) >> 1)


def bucket_count(docs: DataFrame, bytes_each: int) -> int:
    """Buckets by the size that the plan states; by its partitions where it states none."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = docs.rdd.getNumPartitions()
    return max(8, min(-(-size // bytes_each) if size < 1 << 50 else 4 * parts, 200_000))
