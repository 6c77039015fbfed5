"""Arrays that travel between tasks: packed lists of numbers, and the ranges that keys are dealt over."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text (bytes) that one range of keys stands for: the number of ranges follows the input, their size does not.
RANGE_BYTES = 8 << 20


def narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    if x.dtype.kind not in "iu" or not len(x):
        return x
    low, high = int(x.min()), int(x.max())
    return x.astype(np.result_type(np.min_scalar_type(low), np.min_scalar_type(high)) if low < 0 else np.min_scalar_type(high))


def pack(*arrays: np.ndarray) -> bytes:
    """One-dimensional arrays as bytes. The bytes of a number are kept apart, first bytes first: small numbers then pack well."""
    parts = [(x.dtype.str, len(x), np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()) for x in map(narrow, arrays)]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts, 5))


def unpack(blob: bytes) -> list[np.ndarray]:
    """The arrays; whole numbers come back as int64."""
    out = []
    for kind, n, raw in pickle.loads(zstandard.ZstdDecompressor().decompress(blob)):
        dtype = np.dtype(kind)
        x = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, n).T).view(dtype).ravel()
        out.append(x.astype(np.int64) if dtype.kind in "iu" else x)
    return out


def word_arrays(words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and bytes of a list of words, to be packed."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return np.diff(offsets), data


def words_of_arrays(lengths: np.ndarray, data: np.ndarray) -> pa.BinaryArray:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data.astype(np.uint8))])


def steps(ascending: np.ndarray) -> np.ndarray:
    """Ascending numbers as differences, which pack well; ``np.cumsum`` undoes it."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def ranges_for(docs: DataFrame, text: str) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    return max(1, math.ceil(size / RANGE_BYTES))


def tasks_for(ranges: int) -> int:
    """Tasks that ranges are dealt over: they grow with the input, whatever the session's number, and each writes one file of a few ranges."""
    return -(-ranges // 4)


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct numbers, ascending."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers, ascending, and the place among them of each."""
    order = np.argsort(x)
    ordered = x[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(x) else np.zeros(0, bool)
    place = np.empty(len(x), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], place


def joint(*columns: np.ndarray) -> np.ndarray:
    """One number for each row of some columns of numbers from 0 on, equal for equal rows."""
    key = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        c = numbered(c)[1] if len(c) and int(c.max()) >= 1 << 31 else c
        key = numbered(key * (int(c.max(initial=0)) + 1) + c)[1]
    return key


def by_range(place: np.ndarray, ranges: int) -> Iterator[tuple[int, np.ndarray]]:
    """(range, indices of its members, ascending) of each range that has any."""
    # Small numbers are sorted by their digits.
    order = np.argsort(place.astype(np.uint16) if ranges <= 1 << 16 else place, kind="stable")
    edges = np.searchsorted(place[order], np.arange(ranges + 1))
    for r in np.flatnonzero(np.diff(edges)).tolist():
        yield r, order[edges[r] : edges[r + 1]]
