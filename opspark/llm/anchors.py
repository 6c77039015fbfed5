"""Winnowed anchors: how equal windows of different texts meet, for the two exact substring operators.

A text is a sequence of units (bytes or words). Every window of ``length`` units is assigned to its anchor, the leftmost
smallest hash of the grams inside it. Equal windows have equal anchors at equal places, so they meet under the anchor's
hash. Neighbouring windows with the same anchor form a segment; a segment's text is the union of its windows.

Equal segments are counted before any text moves: a passage in a million copies is one distinct segment. Only the
distinct segments of anchors that occur more than once are then cut out of one of their texts.

Texts are known by a 128-bit key, so null and repeated document ids need no care here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, LongType, StructField, StructType

from .texts import map_texts, release, slices

#: Windows handled at once; positions inside such a part fit into POSITION_BITS.
PART, POSITION_BITS = 1 << 22, 24

MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x *= MIX[1]
    x ^= x >> np.uint64(32)
    return x


class Bytes:
    """A text as UTF-8 bytes; grams of 64 for long windows, else of 16.

    Common phrases make short grams of texts meet that share no window, and such neighbourhoods would be sorted in vain.
    """

    def __init__(self, text: str | None):
        self.raw = (text or "").encode()
        self.n = len(self.raw)

    @staticmethod
    def gram(length: int) -> int:
        return 64 if length >= 256 else 16

    def grams(self, gram: int) -> np.ndarray:
        x = np.ndarray((self.n - 7,), "<u8", self.raw, strides=(1,))
        g, done = x[:-8] * MIX[0] + mixed(x[8:]), 16
        while done < gram:
            g = g[:-done] * MIX[0] + g[done:]
            done *= 2
        return mixed(g)

    def part(self, start: int, n: int) -> bytes:
        return self.raw[start : start + n]


class Words:
    """A text as its words (unchanged, cut at ASCII white space); grams of 10."""

    def __init__(self, text: str | None):
        self.words = (text or "").encode().split()
        self.n = len(self.words)
        self.line = b" ".join(self.words)
        self.ends = np.cumsum(np.fromiter(map(len, self.words), np.int64, self.n) + 1) - 1

    @staticmethod
    def gram(length: int) -> int:
        return 10

    def grams(self, gram: int) -> np.ndarray:
        digest = xxhash.xxh64_intdigest
        x = np.fromiter(map(digest, self.words), np.uint64, self.n)
        g, m = x[: self.n - gram + 1].copy(), self.n - gram + 1
        for i in range(1, gram):
            g = g * MIX[2] + x[i : i + m]
        return mixed(g)

    def part(self, start: int, n: int) -> bytes:
        first = int(self.ends[start - 1]) + 1 if start else 0
        return self.line[first : int(self.ends[start + n - 1])]


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` grams the place of its leftmost smallest gram."""
    total = len(grams) - width + 1
    places = []
    for at in range(0, total, PART):
        g = grams[at : min(at + PART, total) + width - 1]
        # The place breaks ties towards the left, and comes back with the minimum.
        key = (g >> np.uint64(POSITION_BITS) << np.uint64(POSITION_BITS)) | np.arange(len(g), dtype=np.uint64)
        blocks = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max)
        blocks[: len(key)] = key
        blocks = blocks.reshape(-1, width)
        before = np.minimum.accumulate(blocks, axis=1).ravel()
        after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(g) - width + 1
        least = np.minimum(after[:n], before[width - 1 : width - 1 + n])
        places.append((least & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64) + at)
    return np.concatenate(places)


def segments(units: Bytes | Words, length: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, first window, number of windows, place of the anchor in the segment) of each segment of a text."""
    if units.n < length:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    gram = units.gram(length)
    grams = units.grams(gram)
    place = winnow(grams, length - gram + 1)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    count = np.diff(first, append=len(place))
    return grams[place[first]], first, count, place[first] - first


def text_key(text: str) -> tuple:
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return F.xxhash64(t), F.xxhash64(F.lit("second"), t)


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    k1, k2 = text_key(text)
    return docs.select(F.col(f"`{doc_id}`").alias("doc"), k1.alias("k1"), k2.alias("k2"), F.col(f"`{text}`").cast("string").alias("text"))


ANCHORS: list[tuple[str, DataType]] = [(n, ArrayType(LongType())) for n in ("h", "s1", "s2")] + [
    (n, ArrayType(IntegerType())) for n in ("first", "windows", "place")
]


def anchor_table(texts: DataFrame, units: type, length: int) -> DataFrame:
    """A row for each segment of each row of ``keyed``: anchor ``h``, segment hash (``s1``, ``s2``), document and place."""

    def make() -> Callable:
        def run(part: list[str | None]) -> list[pa.Array]:
            columns: list[list[np.ndarray]] = [[] for _ in ANCHORS]
            for t in part:
                u = units(t)
                h, first, count, place = segments(u, length)
                digest = xxhash.xxh3_128_digest
                s = b"".join([digest(u.part(a, n + length - 1)) for a, n in zip(first.tolist(), count.tolist())])
                s = np.frombuffer(s, "<i8").reshape(-1, 2)
                for c, v in zip(columns, (h.view(np.int64), s[:, 0], s[:, 1], first, count, place)):
                    c.append(v)
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in columns[0]]))).astype(np.int32))
            types = [pa.int64()] * 3 + [pa.int32()] * 3
            return [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c)).cast(t)) for c, t in zip(columns, types)]

        return run

    lists = map_texts(texts, "text", ["doc", "k1", "k2"], ANCHORS, make)
    each = F.inline(F.arrays_zip(*[n for n, _ in ANCHORS]))
    return lists.where("size(h) > 0").select("doc", "k1", "k2", each)


def cut_out(texts: DataFrame, wanted: DataFrame, units: type, length: int) -> DataFrame:
    """The texts of ``wanted`` segments (doc, k1, k2, first, windows and more columns): those columns and ``segment``.

    The places wanted of a text travel as one list to its row; among copies the row of the named document serves.
    """
    extra = [c for c in wanted.columns if c not in ("doc", "k1", "k2")]
    lists = wanted.groupBy(F.col("doc").alias("w_doc"), F.col("k1").alias("w1"), F.col("k2").alias("w2")).agg(F.collect_list(F.struct(*extra)).alias("w"))
    on = (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2"))
    rows = texts.join(lists, on).where(F.col("doc").eqNullSafe(F.col("w_doc"))).select("text", "w")
    schema = StructType([wanted.schema[c] for c in extra] + [StructField("segment", BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in slices(batch.column(0)):
                places = batch.column(1).slice(start, len(part))
                flat = places.flatten()
                n, at, out = places.value_lengths().to_numpy(), 0, []
                first, windows = (flat.field(flat.type.get_field_index(c)).to_pylist() for c in ("first", "windows"))
                for t, m in zip(part, n):
                    u = units(t)
                    out += [u.part(a, b + length - 1) for a, b in zip(first[at : at + m], windows[at : at + m])]
                    at += m
                columns = [flat.field(flat.type.get_field_index(c)) for c in extra]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], names=schema.names)
        release()

    return rows.mapInArrow(cut, schema)
