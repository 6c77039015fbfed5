"""Token counts without ids: pieces per distinct pre-token, joined to the pre-token frequencies of each document.

1. A scan cuts each text into pre-tokens. The documents a task reads form blocks of bounded size; a block numbers its
   distinct pre-tokens and keeps, for each document, the numbers and how often they occur.
2. The pre-tokens of all blocks meet by their text, and each distinct one is merged once to count its pieces. A block
   contributes a pre-token once, so the most frequent one brings as many rows as there are blocks.
3. The counts return to their blocks and are joined to the frequencies; a document's count is their scalar product.

Special strings inside texts are one token each and end the pre-tokens around them, as in the library. A null text
counts as empty, with no tokens. Rows are independent, so repeated rows, null ids and equal ids change nothing.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ..session import cut_lineage
from .bpe import Coder
from .texts import slices

#: A block ends with the slice of texts in which it reaches so many distinct pre-tokens or characters.
BLOCK_TOKENS, BLOCK_CHARS = 500_000, 64 << 20

#: Rows that step 2 gathers before it sends them back in one piece for each block.
SEND = 500_000


def pack(numbers: np.ndarray) -> bytes:
    """Non-negative numbers below 2**32 as byte planes, which compress well when most are small."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its id, ``n_bytes`` (UTF-8) and ``n_tokens``. ``vocabulary``: content of a byte-level BPE file."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, Coder(vocabulary).by_rank))
    id_type = docs.schema[doc_id].dataType
    blocks = StructType(
        [
            StructField("kind", StringType()),
            StructField("block", LongType()),
            StructField("token", StringType()),
            StructField("number", IntegerType()),
            StructField("doc", id_type),
            StructField("n_bytes", LongType()),
            StructField("n_special", LongType()),
            StructField("numbers", BinaryType()),
            StructField("counts", BinaryType()),
        ]
    )
    arrow = [pa.string(), pa.int64(), pa.string(), pa.int32(), None, pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*shared.value)
        numbers: defaultdict[str, int] = defaultdict(count().__next__)
        # A block is known by a random number: a repeated task writes its rows anew, all under another one.
        block, chars = int.from_bytes(os.urandom(8)) >> 1, 0

        def tokens() -> Iterator[pa.RecordBatch]:
            found = list(numbers)
            for at in range(0, len(found), 50_000):
                part = found[at : at + 50_000]
                n = len(part)
                rows = [["tok"] * n, [block] * n, part, np.arange(at, at + n, dtype=np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[i], arrow[i]) if i < 4 else pa.nulls(n, arrow[i] or id_arrow) for i in range(9)], names=blocks.names
                )

        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for start, part in slices(batch.column(1)):
                out: list[tuple] = []
                for t in part:
                    t = t or ""
                    pieces, special = [t], 0
                    if coder.any_special is not None and any(s in t for s in coder.special):
                        pieces = coder.any_special.split(t)
                        special = len(pieces) // 2
                        pieces = pieces[::2]
                    found = [x for p in pieces for x in coder.pre_tokens(p)] if len(pieces) > 1 else coder.pre_tokens(pieces[0])
                    used, n = np.unique(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)), return_counts=True)
                    out.append((len(t.encode()), special, pack(np.diff(used, prepend=0)), pack(n)))
                    chars += len(t)
                n = len(part)
                cols = [pa.array(["doc"] * n), pa.array([block] * n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32())]
                cols += [batch.column(0).slice(start, n)] + [pa.array(v, arrow[5 + i]) for i, v in enumerate(zip(*out))]
                yield pa.RecordBatch.from_arrays(cols, names=blocks.names)
                if len(numbers) >= BLOCK_TOKENS or chars >= BLOCK_CHARS:
                    yield from tokens()
                    numbers = defaultdict(count().__next__)
                    block, chars = int.from_bytes(os.urandom(8)) >> 1, 0
        if numbers:
            yield from tokens()

    cutted = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(cut, blocks)
    stored = cut_lineage(cutted, by="kind", codec="zstd")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by token: a distinct token is merged once, and the counts go to its blocks."""
        coder = Coder(*shared.value)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        last, size, waiting = None, 0, 0

        def send() -> Iterator[pa.RecordBatch]:
            block, number, n = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((number, block))
            block, number, n = block[order], number[order], n[order]
            starts = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
            parts = list(zip(starts, [*starts[1:], len(block)]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block[starts]),
                    pa.array([pack(np.diff(number[a:b], prepend=0)) for a, b in parts], pa.binary()),
                    pa.array([pack(n[a:b]) for a, b in parts], pa.binary()),
                ],
                names=["block", "numbers", "pieces"],
            )

        for batch in batches:
            sizes = []
            for token in batch.column(0).to_pylist():
                if token != last:
                    last, size = token, len(coder.piece(token.encode()))
                sizes.append(size)
            held.append((batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.int64), np.array(sizes, np.int64)))
            waiting += len(sizes)
            if waiting >= SEND:
                yield from send()
                held, waiting = [], 0
        if held:
            yield from send()

    sent = StructType([StructField("block", LongType()), StructField("numbers", BinaryType()), StructField("pieces", BinaryType())])
    pieces = (
        stored.where("kind = 'tok'").select("token", "block", "number").repartition("token").sortWithinPartitions("token").mapInArrow(measure, sent)
    )
    result = StructType([StructField(doc_id, id_type), StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        sizes = np.zeros(0, np.int64)
        if len(right):
            at = [np.cumsum(unpack(x).astype(np.int64)) for x in right.column("numbers").to_pylist()]
            sizes = np.zeros(max(int(x[-1]) for x in at) + 1, np.int64)
            for i, n in zip(at, right.column("pieces").to_pylist()):
                sizes[i] = unpack(n)
        total = [
            s + int(sizes[np.cumsum(unpack(i).astype(np.int64))] @ unpack(n).astype(np.int64)) if i else s
            for s, i, n in zip(*(left.column(c).to_pylist() for c in ("n_special", "numbers", "counts")))
        ]
        return pa.table([left.column("doc"), left.column("n_bytes"), pa.array(total, pa.int64())], names=result.names)

    rows = stored.where("kind = 'doc'").select("block", "doc", "n_bytes", "n_special", "numbers", "counts")
    return rows.groupBy("block").cogroup(pieces.groupBy("block")).applyInArrow(add_up, result)
