"""Vectors written once to shared storage and searched where they lie, for searches that are repeated among parts of them.

A task writes its vectors as parts of bounded size, each an index of its own: pivots, and the distinct vectors by cell. Frames hold
only where a vector lies (part, row), so what a search sends between tasks is narrow, whatever the length of a vector and the number of
parts it meets. A search deals its queries over tiles of bounded size. A tile reads one part after the other and, of those that are
searched, the rows that count now; a query is compared with the cells it can reach (see ``nearest``), or, where it reaches most of them,
with the vectors of an earlier time.
"""

from __future__ import annotations

import io
import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import cut_lineage, drop, scratch
from .nearest import CUTS, SLACK, THRESHOLD, TILE_BYTES, TILE_ROWS, WORTH

#: Queries and vectors that are compared at once; the share of reached vectors from which a part is compared by time and not by cell.
QUERIES, VECTORS, DENSE = 512, 2048, 0.5


class Store(NamedTuple):
    """``rows``: the columns that were kept, with the hash of a vector as ``same`` and its place as ``part`` and ``row``; a vector without a direction has no place."""

    rows: DataFrame
    path: str


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Norms, summed in the order of the numbers, as Spark does."""
    total = np.zeros(len(vectors))
    for x in vectors.T:
        total += x * x
    return np.sqrt(total)


def _with_direction(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows whose vector can be similar to one, and these vectors."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    flat, start = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
    found = []
    for n in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == n)
        vectors = flat[start[rows][:, None] + np.arange(n)]
        length = _lengths(vectors)
        some = (length > 0) & (length < np.inf)
        if some.any():
            found.append((rows[some], vectors[some]))
    if len(found) > 1:
        raise ValueError("vectors of different lengths")
    return found[0] if found else (np.zeros(0, np.int64), np.zeros((0, 0)))


class Part(NamedTuple):
    """``raw[start[i]:start[i + 1]]`` are the vectors of cell i, around ``pivots[i]`` with ``radius[i]``; ``length`` are their norms."""

    pivots: np.ndarray
    radius: np.ndarray
    start: np.ndarray
    length: np.ndarray
    raw: np.ndarray


def _part_of(vectors: np.ndarray, same: np.ndarray) -> tuple[Part, np.ndarray]:
    """A part, and the row in it of each vector; equal vectors share one."""
    _, first, of = np.unique(same, return_index=True, return_inverse=True)
    if not (vectors[first][of] == vectors).all():
        first = of = np.arange(len(vectors))
    vectors = vectors[first]
    length = _lengths(vectors)
    unit = vectors / length[:, None]
    # In the order of their hashes, so the first are as good as chosen by lot.
    pivots = unit[: 2 * math.isqrt(len(unit))]
    cell, angle = np.empty(len(unit), np.int64), np.empty(len(unit))
    for s in range(0, len(unit), VECTORS):
        a = np.arccos(np.clip(unit[s : s + VECTORS] @ pivots.T, -1.0, 1.0))
        cell[s : s + VECTORS] = a.argmin(axis=1)
        angle[s : s + VECTORS] = a.min(axis=1)
    order = np.argsort(cell, kind="stable")
    at = np.empty(len(order), np.int32)
    at[order] = np.arange(len(order))
    radius = np.zeros(len(pivots))
    np.maximum.at(radius, cell, angle)
    raw = vectors[order]
    short = raw.astype(np.float32)
    start = np.searchsorted(cell[order], np.arange(len(pivots) + 1))
    return Part(pivots, radius, start, length[order], short if (short == raw).all() else raw), at[of]


def _read(fs: pafs.FileSystem, path: str) -> Part:
    with fs.open_input_stream(path, compression=None) as f:
        data = io.BytesIO(f.read())
    return Part(*(np.load(data, allow_pickle=False) for _ in Part._fields))


def _shape(head: bytes) -> tuple[int, ...]:
    """Of the first array of a file."""
    data = io.BytesIO(head)
    np.lib.format.read_magic(data)
    return np.lib.format.read_array_header_1_0(data)[0]


def store(rows: DataFrame, vector: str) -> Store:
    """Stores the vectors of ``rows`` once; numbers that are whole in single precision are stored so."""
    path = scratch(rows.sparkSession, "vectors")
    v = F.col(vector).cast("array<double>")
    rows = rows.withColumn("same", F.xxhash64(v)).withColumn(vector, v)
    kept = [c for c in rows.columns if c != vector]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(path)
        fs.create_dir(root, recursive=True)
        held, size, n = [], 0, 0

        def flushed() -> Iterator[pa.RecordBatch]:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            at, vectors = _with_direction(batch.column(vector))
            # A name that no other attempt has.
            name = TaskContext.get().taskAttemptId() << 20 | n
            part, row = np.full(len(batch), name), np.zeros(len(batch), np.int32)
            if len(at):
                made, row[at] = _part_of(vectors, batch.column("same").to_numpy()[at])
                with fs.open_output_stream(f"{root}/{name}", compression=None) as f:
                    for x in made:
                        data = io.BytesIO()
                        np.save(data, x, allow_pickle=False)
                        f.write(data.getbuffer())
            none = np.ones(len(batch), bool)
            none[at] = False
            places = [pa.array(part, pa.int64(), mask=none), pa.array(row, pa.int32(), mask=none)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *places], names=[*kept, "part", "row"])

        for batch in batches:
            if len(batch):
                held.append(batch)
                size += batch.column(vector).nbytes
                if size >= TILE_BYTES:
                    yield from flushed()
                    held, size, n = [], 0, n + 1
        if held:
            yield from flushed()

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != vector)
    return Store(cut_lineage(rows.mapInArrow(run, f"{schema}, part bigint, row int")), path)


def _written(path: str, to: str, among: DataFrame) -> list[tuple[int, str, int, int]]:
    """Writes the entries that a search looks among, as a file for each part; of equal vectors the first one. The parts, with file, least order and dimensions."""
    entries = among.where("part is not null and ord is not null").groupBy("part", "row").agg(F.min(F.struct("ord", "id")).alias("e"))
    entries = entries.select("part", "row", "e.ord", "e.id")

    def write(rows: pa.Table) -> pa.Table:
        (fs, root), (_, target) = _filesystem(path), _filesystem(to)
        fs.create_dir(target, recursive=True)
        part, name = rows["part"][0].as_py(), uuid.uuid4().hex
        kept, packed = rows.select(["row", "ord", "id"]).sort_by("row"), pa.ipc.IpcWriteOptions(compression="zstd")
        with fs.open_output_stream(f"{target}/{name}", compression=None) as f, pa.ipc.new_stream(f, kept.schema, options=packed) as out:
            out.write_table(kept)
        with fs.open_input_stream(f"{root}/{part}", compression=None) as f:
            dimensions = _shape(f.read(256))[1]
        return pa.table({"part": [part], "name": [name], "least": [pc.min(rows["ord"]).as_py()], "dimensions": [dimensions]})

    found = entries.groupBy("part").applyInArrow(write, "part bigint, name string, least bigint, dimensions bigint").collect()
    if len({r["dimensions"] for r in found}) > 1:
        raise ValueError("vectors of different lengths")
    return sorted((r["part"], r["name"], r["least"], r["dimensions"]) for r in found)


def _search(stored: Store, queries: DataFrame, among: DataFrame, threshold: float, best: bool, tile_rows: int) -> DataFrame:
    """(id, hit, similarity, ord) of the best entry for each query; unless ``best`` some entry for each query that has one."""
    spark, path, theta = queries.sparkSession, stored.path, math.acos(threshold) + SLACK
    to = scratch(spark, "entries")
    id_type, hit_type = dict(queries.dtypes)["id"], dict(among.dtypes)["id"]
    schema = f"id {id_type}, hit {hit_type}, similarity double, ord bigint"
    hit_arrow = to_arrow_type(among.schema["id"].dataType)
    parts = _written(path, to, among)
    asked = queries.where("part is not null and ord is not null").select("id", "part", "row", "ord")
    n = asked.count() if parts else 0
    if not n:
        return spark.createDataFrame([], schema)
    most = max(1, min(tile_rows, TILE_BYTES // (8 * parts[0][3]), max(WORTH, -(-n // (2 * CUTS)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if len(b)]
        if not batches:
            return
        (fs, root), (_, target) = _filesystem(path), _filesystem(to)
        q = pa.Table.from_batches(batches).sort_by([("ord", "ascending"), ("part", "ascending"), ("row", "ascending")]).combine_chunks()
        q_time, q_part, q_row = (q[c].to_numpy() for c in ("ord", "part", "row"))
        qv = None
        for p in np.unique(q_part).tolist():
            at, part = np.flatnonzero(q_part == p), _read(fs, f"{root}/{p}")
            if qv is None:
                qv = np.empty((len(q), part.raw.shape[1]))
            if part.raw.shape[1] != qv.shape[1]:
                raise ValueError("vectors of different lengths")
            qv[at] = part.raw[q_row[at]] / part.length[q_row[at], None]
        if qv.shape[1] != parts[0][3]:
            raise ValueError("vectors of different lengths")
        short_q = qv.astype(np.float32)
        low = threshold - (qv.shape[1] + 6) * 2.0**-23
        score, when = np.full(len(q), -np.inf), np.zeros(len(q), np.int64)
        hit = np.empty(len(q), object)
        near_order = None

        def angles(r: np.ndarray, pivots: np.ndarray) -> np.ndarray:
            return np.arccos(np.clip(qv[r] @ pivots.T, -1.0, 1.0))

        for p, name, least, _ in parts:
            # The queries are in the order of time.
            open_ = np.arange(int(np.searchsorted(q_time, least, "right")), len(q))
            open_ = open_ if best else open_[score[open_] < threshold]
            if not len(open_):
                continue
            part = _read(fs, f"{root}/{p}")
            with fs.open_input_stream(f"{target}/{name}", compression=None) as f:
                entries = pa.ipc.open_stream(f).read_all()
            cell = np.searchsorted(part.start, entries["row"].to_numpy(), "right") - 1
            entries = entries.append_column("cell", pa.array(cell))
            kinds, counts = np.unique(cell, return_counts=True)
            reach = part.radius[kinds] + theta + SLACK
            sample = open_[:: -(-len(open_) // QUERIES)]
            dense = ((angles(sample, part.pivots[kinds]) <= reach) @ counts).mean() >= DENSE * len(cell)
            entries = entries.sort_by([(c, "ascending") for c in ([] if dense else ["cell"]) + ["ord", "id"]]).combine_chunks()
            c_row, c_time, c_id = entries["row"].to_numpy(), entries["ord"].to_numpy(), entries["id"]
            short_c = (part.raw[c_row] / part.length[c_row, None]).astype(np.float32)

            def compared(r: np.ndarray, x: int, y: int) -> None:
                """Of queries r with entries x to y."""
                sims = short_q[r] @ short_c[x:y].T  # noqa: B023
                some = np.flatnonzero(sims.max(axis=1) >= low)
                if not len(some):
                    return
                r = r[some]
                c = x + np.flatnonzero(sims[some].max(axis=0) >= low)
                at = c_row[c]  # noqa: B023
                sims = qv[r] @ (part.raw[at] / part.length[at, None]).T  # noqa: B023
                sims[c_time[c][None, :] >= q_time[r, None]] = -2.0  # noqa: B023
                k = sims.argmax(axis=1)
                s, k = sims[np.arange(len(r)), k], c[k]
                better = (s >= threshold) & ((s > score[r]) | ((s == score[r]) & (c_time[k] < when[r])))  # noqa: B023
                for i in np.flatnonzero((s >= threshold) & (s == score[r]) & (c_time[k] == when[r])):  # noqa: B023
                    better[i] = c_id[int(k[i])].as_py() < hit[r[i]]  # noqa: B023
                r, k = r[better], k[better]
                score[r], when[r] = s[better], c_time[k]  # noqa: B023
                hit[r] = c_id.take(pa.array(k)).to_pylist()  # noqa: B023

            if dense:
                for s in range(0, len(open_), QUERIES):
                    r = open_[s : s + QUERIES]
                    end = int(np.searchsorted(c_time, q_time[r[-1]]))
                    for x in range(0, end, VECTORS):
                        compared(r, x, min(end, x + VECTORS))
                        r = r if best else r[score[r] < threshold]
                        if not len(r):
                            break
                continue
            if near_order is None:
                # Queries near the same pivots reach the same cells, of any part.
                near_order = np.concatenate([angles(np.arange(s, min(len(q), s + QUERIES)), part.pivots).argmin(axis=1) for s in range(0, len(q), QUERIES)])
            open_ = open_[np.argsort(near_order[open_], kind="stable")]
            edges = np.concatenate(([0], np.cumsum(counts)))
            for s in range(0, len(open_), QUERIES):
                chunk = open_[s : s + QUERIES]
                near = angles(chunk, part.pivots[kinds]) <= reach
                for i in np.flatnonzero(near.any(axis=0)).tolist():
                    r = chunk[near[:, i]]
                    for x in range(edges[i], edges[i + 1], VECTORS):
                        r = r if best else r[score[r] < threshold]
                        if not len(r):
                            break
                        compared(r, x, min(int(edges[i + 1]), x + VECTORS))
        some = np.flatnonzero(score >= threshold)
        if len(some):
            found = [q["id"].combine_chunks().take(pa.array(some)), pa.array(hit[some].tolist(), hit_arrow), pa.array(score[some]), pa.array(when[some])]
            yield pa.RecordBatch.from_arrays(found, names=["id", "hit", "similarity", "ord"])

    found = asked.repartition(-(-n // most)).mapInArrow(run, schema)
    found = cut_lineage(found if best else found.select("id"))
    drop(spark, to)
    return found


def with_earlier(stored: Store, queries: DataFrame, among: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(id) of the ``queries`` that have a similar vector of a smaller order ``among`` others; both have (id, part, row, ord)."""
    return _search(stored, queries, among, threshold, False, tile_rows).select("id")


def best_earlier(stored: Store, queries: DataFrame, among: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(id, hit, similarity): of each query the most similar vector of a smaller order ``among`` others, at or above ``threshold``.

    Equal similarities go to the smallest (order, id). Both frames have (id, part, row, ord).
    """
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "ord", "hit")).alias("_b")
    found = _search(stored, queries, among, threshold, True, tile_rows).groupBy("id").agg(best)
    return found.select("id", F.col("_b.hit").alias("hit"), (-F.col("_b.s")).alias("similarity"))
