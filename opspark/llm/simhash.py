"""SimHash near-duplicates: 64-bit fingerprints, compared exactly tile by tile.

A fingerprint's bit is set if more than half of the XXH64 hashes of the text's word shingles have it set. The distinct
fingerprints are sorted by population count and cut into tiles of one count; two tiles are compared only if their counts
differ by no more than the radius, and only if the counts of their four 16-bit quarters can be so close (each differing
bit changes one quarter's count by one). A task compares two tiles by exclusive-or and bit counts in numpy and returns a
spanning forest of the links it found, so a group of many near copies costs as many edges as it has members. Distributed
star contraction turns the edges into components.

A null text and a text without words have fingerprint zero, which links like any other. Fewer words than a shingle make
one shingle. Equal texts share a fingerprint, hence a component. The component's id is its smallest document id; it is
null if all its ids are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ..session import cut_lineage
from .components import smallest_labels
from .texts import free_name, map_texts

SEED, TILE = 42, 8192

#: Rows and columns of a tile compared at once: some MB of temporaries.
ROWS, COLUMNS = 64, 4096


def fingerprint(text: str | None, shingle: int) -> int:
    """Bytes are lower-cased (A-Z only) and split at ASCII white space, as the word pattern says."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        places = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(line[a:b], SEED) for a, b in places), np.uint64, len(words) - shingle + 1)
    set_ = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_ += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_ > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", keep: list[str] | None = None, name: str = "fp") -> DataFrame:
    """The kept columns and the fingerprint as a signed 64-bit number."""

    def make() -> Callable:
        return lambda texts: [pa.array(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))]

    return map_texts(docs, text, keep if keep is not None else docs.columns, [(name, LongType())], make)


def quarters(fps: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters."""
    return np.bitwise_count(fps.astype("<u8").view("<u2").reshape(-1, 4)).astype(np.int16)


TILES = StructType(
    [StructField("tile", StringType()), StructField("bits", IntegerType())]
    + [StructField(f"{side}{i}", IntegerType()) for side in ("low", "high") for i in range(4)]
    + [StructField("fps", BinaryType())]
)


def tiles(distinct: DataFrame) -> DataFrame:
    """Tiles of the distinct fingerprints ``fp``: one population count each, ``TILE`` numbers at most."""
    parts = [F.bit_count(F.expr(f"shiftrightunsigned(fp, {16 * i}) & 65535")) for i in range(4)]
    keys = distinct.select(F.bit_count("fp").alias("bits"), *[p.alias(f"q{i}") for i, p in enumerate(parts)], "fp")
    names = ["bits", "q0", "q1", "q2", "q3", "fp"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tile(fps: np.ndarray) -> tuple:
            q = quarters(fps)
            return (f"{int(fps[0]):016x}", int(np.bitwise_count(fps[:1])[0]), *q.min(axis=0).tolist(), *q.max(axis=0).tolist(), fps.tobytes())

        held = np.zeros(0, np.uint64)
        for batch in batches:
            held = np.concatenate((held, batch.column(5).to_numpy().view(np.uint64)))
            done = []
            while len(held):
                bits = np.bitwise_count(held[: TILE + 1])
                end = int(np.searchsorted(bits, bits[0], side="right"))
                if end <= TILE and end == len(held):
                    break
                end = min(end, TILE)
                done.append(tile(held[:end]))
                held = held[end:]
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(TILES.names, t)) for t in done], schema=arrow)
        if len(held):
            yield pa.RecordBatch.from_pylist([dict(zip(TILES.names, tile(held)))], schema=arrow)

    arrow = pa.schema([(f.name, pa.string() if f.dataType == StringType() else pa.binary() if f.dataType == BinaryType() else pa.int32()) for f in TILES])
    ranged = keys.repartitionByRange(*names).sortWithinPartitions(*names)
    return ranged.mapInArrow(cut, TILES)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the links between the fingerprints ``a`` and ``b``: (member, smallest member)."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def links(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within the radius, one of each tile (or both of one, if they are the same)."""
    qa, qb = quarters(a), quarters(b)
    us, vs, held = [], [], 0
    for i in range(0, len(a), ROWS):
        low, high = qa[i : i + ROWS].min(axis=0), qa[i : i + ROWS].max(axis=0)
        apart = (np.maximum(low - qb, 0) + np.maximum(qb - high, 0)).sum(axis=1)
        near = np.flatnonzero(apart <= radius)
        if same:
            near = near[near >= i]
        for j in range(0, len(near), COLUMNS):
            part = near[j : j + COLUMNS]
            x, y = np.nonzero(np.bitwise_count(a[i : i + ROWS, None] ^ b[part][None, :]) <= radius)
            x, y = x + i, part[y]
            if same:
                x, y = x[y > x], y[y > x]
            us.append(a[x])
            vs.append(b[y])
            held += len(x)
        if held > 2_000_000:
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            us, vs, held = [u], [v], len(u)
    return forest(np.concatenate(us), np.concatenate(vs)) if held else (a[:0], a[:0])


def edges(distinct: DataFrame, radius: int) -> DataFrame:
    """(u, v): edges that connect exactly the fingerprints ``fp`` which chains of links within the radius connect."""
    cut = cut_lineage(tiles(distinct))
    meta = cut.drop("fps")
    left = meta.select(*[F.col(c).alias(f"a_{c}") for c in meta.columns], F.explode(F.sequence(F.col("bits"), F.col("bits") + radius)).alias("bits"))
    gap = sum((F.greatest(F.lit(0), F.col(f"a_low{i}") - F.col(f"high{i}"), F.col(f"low{i}") - F.col(f"a_high{i}")) for i in range(4)), F.lit(0))
    ordered = (F.col("a_bits") < F.col("bits")) | (F.col("a_tile") <= F.col("tile"))
    # Pairs of tiles, not of rows; their members come in by two joins on the tile.
    pairs = left.join(meta, "bits").where(ordered & (gap <= radius)).select("a_tile", "tile")
    members = cut.select("tile", "fps")
    filled = pairs.join(members.select(F.col("tile").alias("a_tile"), F.col("fps").alias("a_fps")), "a_tile").join(members, "tile")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[i].as_py(), np.uint64) for c in (2, 3))
                u, v = links(a, b, radius, batch.column(0)[i].as_py() == batch.column(1)[i].as_py())
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return filled.select("a_tile", "tile", "a_fps", "fps").mapInArrow(compare, "u long, v long")


def components(marked: DataFrame, radius: int) -> DataFrame:
    """(named_fp, label, component_id) of each distinct fingerprint of (doc_id, fp): smallest linked fingerprint and document."""
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    labels = smallest_labels(edges(distinct.select("fp"), radius))
    labelled = distinct.join(labels, distinct["fp"] == labels["node"], "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    labelled = cut_lineage(labelled)
    component = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    return labelled.join(component, "label").select(F.col("fp").alias("named_fp"), "label", "component_id")


def groups(docs: DataFrame, shingle: int, radius: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its id, ``fp``, ``label`` (smallest linked fingerprint) and ``component_id``."""
    marked = cut_lineage(fingerprints(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), shingle, keep=["doc_id"]))
    named = cut_lineage(components(marked, radius))
    return marked.join(named, marked["fp"] == named["named_fp"]).select("doc_id", "fp", "label", "component_id")


def one_of_each(docs: DataFrame, shingle: int, radius: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents, but of each component only the row with the smallest id (of repeated rows one, ids before nulls)."""
    row, fp, chosen_row = free_name(docs, "row_number"), free_name(docs, "fp"), free_name(docs, "chosen_row")
    # Written with its row numbers, which hold only for one reading of the input.
    marked = cut_lineage(fingerprints(docs.withColumn(row, F.monotonically_increasing_id()), shingle, text, keep=[*docs.columns, row], name=fp))
    narrow = marked.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(row).alias("row"), F.col(fp).alias("fp"))
    named = cut_lineage(components(narrow, radius))
    placed = narrow.join(named, narrow["fp"] == named["named_fp"])
    chosen = placed.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best")).select(F.col("best.row").alias(chosen_row))
    # One chosen row for each component: a side that grows with the table, so a shuffle at every size.
    kept = marked.join(cut_lineage(chosen).hint("merge"), marked[row] == F.col(chosen_row), "left_semi")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
