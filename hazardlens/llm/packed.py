"""Sorted integer sets as compact blobs, for exchanges of very many short keys.

A set of uint32 keys travels as the byte planes of its successive differences.
The upper planes are nearly constant, so Spark's shuffle compression removes
them; no row is made per key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import SparkSession


def parallelism(spark: SparkSession) -> int:
    """The session's shuffle partitions: the one measure of cluster and input
    size that groups and buckets are derived from."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucket_bits(spark: SparkSession) -> int:
    """Bits of a key that name its bucket: at least one bucket per shuffle partition."""
    return max(1, (parallelism(spark) - 1).bit_length())


def pack_keys(keys: np.ndarray) -> bytes:
    """Blob of sorted uint32 keys."""
    steps = np.diff(keys, prepend=np.uint32(0)).astype("<u4")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack_keys(blob) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(4, -1)
    steps = np.ascontiguousarray(planes.T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32)


def pack_hashes(hashes: np.ndarray) -> bytes:
    """Blob of sorted uint64 hashes: byte planes of their differences."""
    steps = np.diff(hashes, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_hashes(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte per count; those of 255 and more follow in full."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def unpack_counts(blob: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(blob, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(blob, "<i8", offset=n)
    return out


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def bucket_edges(buckets: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the 2^bits buckets begins in a sorted array of bucket numbers."""
    return np.searchsorted(buckets, np.arange((1 << bits) + 1, dtype=buckets.dtype))


def binary(values: list) -> pa.Array:
    return pa.array(values, pa.binary())


def squeezed(blobs: list[bytes]) -> pa.Array:
    """Blobs under zstd, for values of few bits that the exchange's own compression leaves at a byte each."""
    return binary([zstandard.compress(x, 1) for x in blobs])


def unsqueezed(column) -> list[bytes]:
    return [zstandard.decompress(x) for x in column.to_pylist()]
