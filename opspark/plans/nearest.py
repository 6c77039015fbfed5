"""Exact best match by cosine similarity above a threshold, without comparing everything with everything.

Vectors are compared as unit vectors, where the angle is a metric. Every cached vector goes to its nearest
pivot; a query needs only the cells it can reach: angle(query, pivot) <= cell radius + threshold angle.

What travels are blocks, not cells: neighbouring cells share a block of some ten thousand vectors, a crowded cell is dealt over
several, and a query goes once to each block that has a cell it can reach. Blocks meet tiles of queries, also of bounded size. The task of a
tile compares each query with the cells it reaches, at first in short numbers with a margin for their rounding, and returns only the best match
of each of its queries, never the pairs it looked at. A table is cut into ``CUTS`` blocks until these are full, so copies grow with the table
and not with its pairs or cells; beyond, a vector is copied once for each full block or tile of the other side that it meets.

The number of pivots is the square root of the number of vectors: cells then grow no faster than the pivots, which are what
every task holds. An index stores pivots and cells; later entries join the cells of the pivots that are there, until the
table has grown ``REBUILD`` times and new pivots are chosen.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import norm, normalised
from ..session import cut_lineage
from ..sources.literals import literal_table

THRESHOLD = 0.92
SLACK = 1e-6
REBUILD = 4

#: Most vectors of a block or tile, and their most bytes; the blocks a table is cut into before these are full, and the fewest vectors worth a block.
TILE_ROWS, TILE_BYTES, CUTS, WORTH = 65_536, 32 << 20, 8, 1024

#: Bytes of vectors that travel as one row, and similarities a task holds at once.
PACK, MATRIX = 4 << 20, 1 << 22


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1.0, 1.0))


def _unit(df: DataFrame, key: str, vector: str, order: str | None) -> DataFrame:
    rank = F.col(order).cast("bigint") if order else F.lit(0).cast("bigint")
    v = F.col(vector)
    return df.where((F.size(v) > 0) & (norm(v) > 0)).select(
        F.col(key).alias("id"), normalised(v).alias("v"), rank.alias("ord")
    )


class Index(NamedTuple):
    """``cells``: (v, id, ord, cell, angle) of distinct vectors, each as its first entry. ``pivots``: one unit vector a cell."""

    cells: DataFrame
    pivots: np.ndarray
    id_type: str


def entries_of(cached: DataFrame, cached_id: str, vector: str = "vector", order: str | None = None) -> DataFrame:
    """(v, id, ord) of the distinct unit vectors, each as its first entry."""
    found = _unit(cached, cached_id, vector, order).groupBy("v").agg(F.min(F.struct("ord", "id")).alias("_first"))
    return found.select("v", F.col("_first.id").alias("id"), F.col("_first.ord").alias("ord"))


def _chosen(entries: DataFrame, pivots: int | None) -> np.ndarray:
    """Pivots, chosen by hash so that the choice is repeatable. Their number is the root of the number of vectors."""
    n = entries.count()
    wanted = max(1, math.isqrt(n)) if pivots is None else max(1, min(pivots, n))
    rows = entries.orderBy(F.xxhash64("v"), "id").limit(wanted).select("v").collect() if n else []
    return np.asarray([r["v"] for r in rows], dtype=float)


def _in_cells(entries: DataFrame, centre: np.ndarray) -> DataFrame:
    id_type = dict(entries.dtypes)["id"]

    def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                angle = _angles(np.stack(rows["v"].to_numpy()), centre)
                cell = angle.argmin(axis=1)
                yield rows.assign(cell=cell.astype("int32"), angle=angle[np.arange(len(rows)), cell])

    return entries.mapInPandas(to_cells, f"v array<double>, id {id_type}, ord bigint, cell int, angle double")


def build_index(entries: DataFrame, pivots: int | None = None) -> Index:
    """An index of the rows of ``entries_of``."""
    entries = cut_lineage(entries)
    centre = _chosen(entries, pivots)
    return Index(cut_lineage(_in_cells(entries, centre)) if len(centre) else entries, centre, dict(entries.dtypes)["id"])


def store_index(index: Index, path: str) -> None:
    """Writes an index: its pivots, and its cells as the first part."""
    spark = index.cells.sparkSession
    rows = literal_table(spark, list(enumerate(index.pivots.tolist())), "cell int, v array<double>")
    rows.write.mode("overwrite").parquet(f"{path}/pivots")
    index.cells.write.mode("overwrite").parquet(f"{path}/cells/part=0")


def open_index(spark: SparkSession, path: str) -> Index:
    pivots = spark.read.parquet(f"{path}/pivots").orderBy("cell").collect()
    cells = spark.read.parquet(f"{path}/cells").drop("part")
    return Index(cells, np.asarray([r["v"] for r in pivots], dtype=float), dict(cells.dtypes)["id"])


def extend_index(spark: SparkSession, path: str, entries: DataFrame, part: int) -> None:
    """Adds later entries to a stored index, as one part that a repeated call replaces. Vectors that are there stay as they were first.

    Only the new entries are compared with pivots, until there are ``REBUILD`` times as many vectors as pivots are meant for.
    """
    index = open_index(spark, path)
    known = spark.read.parquet(f"{path}/cells").where(F.col("part") != part).drop("part")
    fresh = cut_lineage(entries.join(known.select(F.col("v").alias("_v")), F.col("v") == F.col("_v"), "left_anti"))
    if not len(index.pivots) or known.count() + fresh.count() > REBUILD * (len(index.pivots) + 1) ** 2:
        together = cut_lineage(known.select("v", "id", "ord").unionByName(fresh))
        for old in spark.read.parquet(f"{path}/cells").select("part").distinct().collect():
            if old["part"]:
                known.limit(0).write.mode("overwrite").parquet(f"{path}/cells/part={old['part']}")
        store_index(build_index(together), path)
    else:
        _in_cells(fresh, index.pivots).write.mode("overwrite").parquet(f"{path}/cells/part={part}")


def best_match(
    queries: DataFrame,
    cached: DataFrame,
    query_id: str,
    cached_id: str,
    query_vector: str = "vector",
    cached_vector: str = "vector",
    threshold: float = THRESHOLD,
    query_order: str | None = None,
    cached_order: str | None = None,
    cached_column: str | None = None,
    pivots: int | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(query_id, cached_id, similarity) of the best cached vector at or above ``threshold`` per query.

    ``cached_column`` is the column of ids where the result should give them another name.
    With both orders given, only cached vectors of a smaller order count. Equal similarities go to the
    smallest (order, id). Identical cached vectors are searched once, as their first entry. Queries
    without a match are left out.
    """
    index = build_index(entries_of(cached, cached_column or cached_id, cached_vector, cached_order), pivots)
    return search_index(index, queries, query_id, cached_id, query_vector, threshold, query_order, by_time=bool(query_order and cached_order), tile_rows=tile_rows)


class Layout(NamedTuple):
    """How the cells of an index are dealt over blocks, and the queries over tiles.

    ``cells``: the cells by number, with their ``radius`` and ``sizes``; the parts of cell i are ``block[first[i]:first[i + 1]]``, the block of each.
    ``tiles``: the tiles of queries that each block meets; the tasks of a block follow those of the blocks before.
    """

    cells: np.ndarray
    pivots: np.ndarray
    radius: np.ndarray
    sizes: np.ndarray
    first: np.ndarray
    block: np.ndarray
    tiles: np.ndarray


def _rows_of_tile(rows: int, dimensions: int, tile_rows: int) -> int:
    return max(1, min(tile_rows, TILE_BYTES // (8 * max(1, dimensions)), max(WORTH, -(-rows // CUTS))))


def _cells_of(index: Index) -> Layout:
    """The cells that have vectors; one row for each pivot."""
    found = index.cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()
    stats = sorted((r["cell"], r["radius"], r["n"]) for r in found)
    cells = np.array([s[0] for s in stats], np.int64)
    radius, sizes = np.array([s[1] for s in stats], float), np.array([s[2] for s in stats], np.int64)
    none = np.zeros(0, np.int64)
    return Layout(cells, index.pivots[cells], radius, sizes, none, none, none)


def _in_blocks(known: Layout, tile_rows: int) -> Layout:
    most = _rows_of_tile(int(known.sizes.sum()), known.pivots.shape[1], tile_rows)
    parts = -(-known.sizes // most)
    first = np.concatenate(([0], np.cumsum(parts)))
    block = np.empty(first[-1], np.int64)
    # Cells near the same one of some pivots are neighbours.
    near = _angles(known.pivots, known.pivots[: max(1, int(known.sizes.sum()) // most)]).argmin(axis=1)
    b, held = 0, 0
    for i in np.argsort(near, kind="stable").tolist():
        size = -(-int(known.sizes[i]) // int(parts[i]))
        for p in range(first[i], first[i + 1]):
            if held and held + size > most:
                b, held = b + 1, 0
            block[p], held = b, held + size
    return known._replace(first=first, block=block)


def _reach(known: Layout, vectors: np.ndarray, theta: float) -> np.ndarray:
    return _angles(vectors, known.pivots) <= known.radius + theta + SLACK


def _laid_out(index: Index, asked: DataFrame, theta: float, tile_rows: int) -> tuple[Layout, DataFrame]:
    """The layout, and the queries with the blocks they can reach."""
    known = _in_blocks(_cells_of(index), tile_rows)
    id_type = dict(asked.dtypes)["id"]
    of_cell = np.zeros((len(known.cells), int(known.block.max()) + 1), np.float32)
    of_cell[np.repeat(np.arange(len(known.cells)), np.diff(known.first)), known.block] = 1

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                met = _reach(known, np.stack(rows["v"].to_numpy()), theta).astype(np.float32) @ of_cell > 0
                yield rows.assign(blocks=[np.flatnonzero(m) for m in met])

    reached = cut_lineage(asked.mapInPandas(reach, f"id {id_type}, v array<double>, ord bigint, blocks array<int>"))
    # One row for each block.
    visits = {r["b"]: r["count"] for r in reached.select(F.explode("blocks").alias("b")).groupBy("b").count().collect()}
    most = _rows_of_tile(max(visits.values(), default=0), known.pivots.shape[1], tile_rows)
    tiles = np.array([-(-visits.get(b, 0) // most) for b in range(of_cell.shape[1])], np.int64)
    return known._replace(tiles=tiles), reached


def compared_share(index: Index, queries: DataFrame, query_id: str, query_vector: str = "vector", threshold: float = THRESHOLD) -> float:
    """The share of all (query, vector) pairs that a search compares."""
    known, theta = _cells_of(index), math.acos(threshold) + SLACK

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                reached = _reach(known, np.stack(rows["v"].to_numpy()), theta)
                yield pd.DataFrame({"rows": [len(rows)], "pairs": [int((reached @ known.sizes).sum())]})

    asked = _unit(queries, query_id, query_vector, None).select("v")
    rows, compared = asked.mapInPandas(pairs, "rows bigint, pairs bigint").agg(F.sum("rows"), F.sum("pairs")).first()
    return (compared or 0) / max(1, (rows or 0) * int(known.sizes.sum()))


def search_index(
    index: Index,
    queries: DataFrame,
    query_id: str,
    cached_id: str,
    query_vector: str = "vector",
    threshold: float = THRESHOLD,
    query_order: str | None = None,
    by_time: bool = False,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``best_match`` on an index."""
    theta = math.acos(threshold) + SLACK
    asked = _unit(queries, query_id, query_vector, query_order)
    id_type, cid_type = dict(asked.dtypes)["id"], index.id_type
    if not len(index.pivots):
        return queries.sparkSession.createDataFrame([], f"{query_id} {id_type}, {cached_id} {cid_type}, similarity double")
    layout, reached = _laid_out(index, asked, theta, tile_rows)
    found = _compared(layout, reached, index.cells, threshold, by_time)
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "ord", "hit")).alias("_b")
    return found.groupBy("id").agg(best).select(
        F.col("id").alias(query_id), F.col("_b.hit").alias(cached_id), (-F.col("_b.s")).alias("similarity")
    )


def _packed(rows: DataFrame, routed: Callable[[pa.RecordBatch], Iterator[tuple[list[int], np.ndarray]]]) -> DataFrame:
    """A row for each pack of vectors and tile. ``routed`` tells where rows of (id, v, ord, place, h) go, as tiles and the rows for these."""
    id_type = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packs() -> Iterator[pa.RecordBatch]:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            vectors = _matrix(batch.column(1))
            for tiles, at in routed(batch):
                of = lambda c: pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), c.take(pa.array(at)))  # noqa: B023, E731
                cell = batch.column(3) if pa.types.is_integer(batch.column(3).type) else pa.array(np.zeros(len(batch), "int32"))
                columns = [pa.array([tiles], pa.list_(pa.int64())), pa.array([vectors[at].tobytes()], pa.binary()), *map(of, (batch.column(0), batch.column(2), cell))]
                yield pa.RecordBatch.from_arrays(columns, names=["tiles", "v", "id", "ord", "cell"])

        for batch in batches:
            if len(batch):
                held.append(batch)
                size += batch.column(1).nbytes
                if size >= PACK * CUTS:
                    yield from packs()
                    held, size = [], 0
        if held:
            yield from packs()

    packs = rows.mapInArrow(run, f"tiles array<bigint>, v binary, id array<{id_type}>, ord array<bigint>, cell array<int>")
    return packs.select(F.explode("tiles").alias("tile"), "v", "id", "ord", "cell")


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    if len(set(np.diff(vectors.offsets.to_numpy()).tolist())) > 1:
        raise ValueError("vectors of different lengths")
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _groups(key: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(key, kind="stable")
    kinds, start = np.unique(key[order], return_index=True)
    yield from zip(kinds.tolist(), np.split(rows[order], start[1:]))


def _unpacked(rows: pa.Table) -> tuple[np.ndarray, pa.Table]:
    """The vectors of some packs, and a table of their (id, ord, cell)."""
    columns = {c: pa.chunked_array([x.flatten() for x in rows[c].chunks]).combine_chunks() for c in ("id", "ord", "cell")}
    table = pa.table(columns)
    vectors = np.frombuffer(b"".join(x.as_buffer() for c in rows["v"].chunks for x in c), float)
    return vectors.reshape(len(table), -1), table


def _compared(layout: Layout, reached: DataFrame, cells: DataFrame, threshold: float, by_time: bool) -> DataFrame:
    """(id, hit, similarity, ord): of each query and tile that it goes to, the best vector there at or above the threshold.

    ``reached`` and ``cells`` are rows of those the layout was made for.
    """
    id_type, cid_type = dict(reached.dtypes)["id"], dict(cells.dtypes)["id"]
    theta = math.acos(threshold) + SLACK
    start = np.cumsum(layout.tiles) - layout.tiles
    tasks = max(1, int(layout.tiles.sum()))

    def of_queries(batch: pa.RecordBatch) -> Iterator[tuple[list[int], np.ndarray]]:
        blocks, h = batch.column(3), batch.column(4).to_numpy()
        rows = np.repeat(np.arange(len(batch)), np.diff(blocks.offsets.to_numpy()))
        b = blocks.flatten().to_numpy().astype(np.int64)
        for tile, at in _groups(start[b] + h[rows] % layout.tiles[b], rows):
            yield [tile], at

    def of_cells(batch: pa.RecordBatch) -> Iterator[tuple[list[int], np.ndarray]]:
        cell = np.searchsorted(layout.cells, batch.column(3).to_numpy())
        part = layout.first[cell] + batch.column(4).to_numpy() % np.diff(layout.first)[cell]
        for b, at in _groups(layout.block[part], np.arange(len(batch))):
            if layout.tiles[b]:
                yield list(range(start[b], start[b] + layout.tiles[b])), at

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        if not len(q) or not len(c):
            return pa.table([pa.array([], t) for t in (q["id"].type.value_type, c["id"].type.value_type, pa.float64(), pa.int64())], names=["id", "hit", "similarity", "ord"])
        (qv, q), (cv, c) = _unpacked(q), _unpacked(c)
        c = c.append_column("row", pa.array(np.arange(len(c)))).sort_by([("cell", "ascending"), ("ord", "ascending"), ("id", "ascending")])
        cv = cv[c["row"].to_numpy()]
        rank = np.empty(len(c), np.int64)
        rank[pc.sort_indices(c, [("ord", "ascending"), ("id", "ascending")]).to_numpy()] = np.arange(len(c))
        when = lambda t: pc.fill_null(t["ord"], np.iinfo(np.int64).max).to_numpy()
        if by_time:
            order = np.argsort(when(q), kind="stable")
            qv, q = qv[order], q.take(pa.array(order))
        q_time, c_time = when(q), when(c)
        short_q, short_c = qv.astype(np.float32), cv.astype(np.float32)
        margin = (qv.shape[1] + 4) * 2.0**-23
        best, hit = np.full(len(qv), -np.inf), np.full(len(qv), -1)

        def similar(left: np.ndarray, right: np.ndarray, r: np.ndarray, x: int, y: int, z: int) -> np.ndarray:
            """Of queries r and vectors x to z; those from y on may be too late for some of the queries."""
            sims = left[r] @ right[x:z].T
            if y < z:
                sims[:, y - x :][c_time[None, y:z] >= q_time[r, None]] = -2.0
            return sims

        kinds, edges = np.unique(c["cell"].to_numpy(), return_index=True)
        at = np.searchsorted(layout.cells, kinds)
        near = _angles(qv, layout.pivots[at]) <= layout.radius[at] + theta + SLACK
        for k, (x, end) in enumerate(zip(edges.tolist(), [*edges[1:].tolist(), len(cv)])):
            rows, step = np.flatnonzero(near[:, k]), max(1, MATRIX // (end - x))
            for s in range(0, len(rows), step):
                r, y, z = rows[s : s + step], end, end
                if by_time:
                    y, z = (x + int(np.searchsorted(c_time[x:end], q_time[r[i]])) for i in (0, -1))
                if x == z:
                    continue
                r = r[similar(short_q, short_c, r, x, y, z).max(axis=1) >= threshold - margin]
                if not len(r):
                    continue
                sims = similar(qv, cv, r, x, y, z)
                found = sims.argmax(axis=1)
                score, found = sims[np.arange(len(r)), found], x + found
                better = (score >= threshold) & ((score > best[r]) | ((score == best[r]) & (rank[found] < rank[hit[r]])))
                best[r[better]], hit[r[better]] = score[better], found[better]
        some = np.flatnonzero(hit >= 0)
        of = c.take(pa.array(hit[some]))
        return pa.table([q["id"].take(pa.array(some)), of["id"], pa.array(best[some]), of["ord"]], names=["id", "hit", "similarity", "ord"])

    h = F.xxhash64("id", "v").alias("h")
    if by_time:
        reached, cells = reached.where("ord is not null"), cells.where("ord is not null")
    left = _packed(reached.select("id", "v", "ord", "blocks", h), of_queries).repartition(tasks, "tile")
    right = _packed(cells.select("id", "v", "ord", "cell", h), of_cells).repartition(tasks, "tile")
    return left.groupBy("tile").cogroup(right.groupBy("tile")).applyInArrow(search, f"id {id_type}, hit {cid_type}, similarity double, ord bigint")
