"""Byte substring dedup with suffix arrays of bounded shards.

Every window of ``length`` bytes is assigned to a winnowed anchor (``anchors.py``), and what an anchor that occurs more
than once has around it goes to the shard of the anchor's hash: all places of a repeated window meet in one shard. Text
whose anchors are unique has no repeated window and never moves. Equal neighbourhoods are counted first, so a shard
holds each of them once, with its number of copies.

A shard is sorted by Larsson-Sadakane refinement, and Kasai's common prefixes of neighbouring suffixes tell which windows
are equal (``suffixes.py``). A window is repeated if it starts in two places of the shard, or in one that has copies.

An anchor with more than ``HOT`` distinct neighbourhoods is dealt over many shards. Each such shard then sorts
the fingerprints of its distinct windows and cuts them into ranges; a range meets the same range of the other shards,
where the sorted lists are merged by binary search, and a window that two shards have is repeated as well.

A null text is empty. Rows are places of their own: repeated rows are copies of each other, whatever their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from ..session import cut_lineage
from .anchors import Bytes, anchor_table, cut_out, keyed
from .suffixes import equal_groups
from .texts import release, slices

#: Bytes of a shard (what is sorted should stay in a processor's cache), shards of a task, distinct neighbourhoods of an anchor
#: that stay in one shard, windows that meet in a merging task.
SHARD, SHARDS, HOT, MERGE = 1 << 20, 12, 512, 500_000

FOUND = StructType(
    [StructField(n, LongType()) for n in ("h", "s1", "s2")]
    + [StructField("t0", IntegerType()), StructField("t1", IntegerType())]
    + [StructField("range", IntegerType()), StructField("prints", BinaryType()), StructField("refs", BinaryType())]
)
ARROW = pa.schema([(f.name, {LongType(): pa.int64(), IntegerType(): pa.int32(), BinaryType(): pa.binary()}[f.dataType]) for f in FOUND])

PRINT = np.dtype([("a", "<u8"), ("b", "<u8")])
REF = np.dtype([("h", "<i8"), ("s1", "<i8"), ("s2", "<i8"), ("t", "<i4"), ("many", "?")])


def found_table(columns: dict[str, np.ndarray | list]) -> pa.Table:
    n = len(next(iter(columns.values())))
    return pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in ARROW], schema=ARROW)


def runs_of(flags: np.ndarray, segment: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first, last) of the runs of flagged windows; windows are in order, segment by segment."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(segment[at]) != 0)))
    first = at[new]
    last = np.append(at[np.flatnonzero(new)[1:] - 1], at[-1])
    return segment[first], t[first], t[last]


def sorted_shard(table: pa.Table, length: int, ranges: int) -> pa.Table:
    """The repeated windows of a shard's segments, and the sorted distinct windows of its dealt-out anchors."""
    h, s1, s2, copies, windows, hot = (table.column(c).to_numpy() for c in ("h", "s1", "s2", "copies", "windows", "hot"))
    parts = table.column("segment").to_pylist()
    data = np.frombuffer(b"".join(parts), np.uint8)
    begin = np.concatenate(([0], np.cumsum([len(p) for p in parts])))[:-1]
    segment = np.repeat(np.arange(len(parts)), windows)
    t = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = begin[segment] + t
    group = equal_groups(data, starts, length)
    weight = np.bincount(group, weights=copies[segment].astype(float))
    repeated = weight[group] > 1
    seg, first, last = runs_of(repeated, segment, t)
    out = [found_table({"h": h[seg], "s1": s1[seg], "s2": s2[seg], "t0": first, "t1": last})]
    if hot.any():
        dealt = np.flatnonzero(hot[segment])
        dealt = dealt[np.unique(group[dealt], return_index=True)[1]]
        raw = data.tobytes()
        digest = xxhash.xxh3_128_digest
        prints = np.frombuffer(b"".join([digest(raw[a : a + length]) for a in starts[dealt].tolist()]), PRINT)
        refs = np.zeros(len(dealt), REF)
        for name, v in (("h", h[segment[dealt]]), ("s1", s1[segment[dealt]]), ("s2", s2[segment[dealt]]), ("t", t[dealt]), ("many", repeated[dealt])):
            refs[name] = v
        order = np.lexsort((prints["b"], prints["a"]))
        prints, refs = prints[order], refs[order]
        # The ranges are equal parts of the first half of the fingerprint; binary search finds their ends.
        cuts = (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(np.uint64)
        ends = [0, *np.searchsorted(prints["a"], cuts).tolist(), len(prints)]
        rows = [(i, prints[a:b].tobytes(), refs[a:b].tobytes()) for i, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
        number, p, r = zip(*rows)
        out.append(found_table({"range": list(number), "prints": list(p), "refs": list(r)}))
    return pa.concat_tables(out)


def merged_pair(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted lists as one: binary search finds where the second list's windows come in."""
    at = np.searchsorted(left[0]["a"], right[0]["a"])
    return np.insert(left[0], at, right[0]), np.insert(left[1], at, right[1])


def merged_range(table: pa.Table) -> pa.Table:
    """Of one range of all shards, the windows that two shards have and that their own shard did not find repeated."""
    lists = [(np.frombuffer(p, PRINT), np.frombuffer(r, REF)) for p, r in zip(table.column("prints").to_pylist(), table.column("refs").to_pylist())]
    # A tournament: lists of about one length meet, so each window moves as often as the number of lists can be halved.
    while len(lists) > 1:
        lists = [merged_pair(*lists[k : k + 2]) if k + 1 < len(lists) else lists[k] for k in range(0, len(lists), 2)]
    merged, refs = lists[0]
    # Equal first halves are neighbours now; in the rare run of more than one print, the second half orders it.
    order = np.lexsort((merged["b"], merged["a"]))
    merged, refs = merged[order], refs[order]
    same = (merged["a"][1:] == merged["a"][:-1]) & (merged["b"][1:] == merged["b"][:-1])
    twice = (np.append(same, False) | np.concatenate(([False], same))) & ~refs["many"]
    hit = refs[twice]
    return found_table({"h": hit["h"], "s1": hit["s1"], "s2": hit["s2"], "t0": hit["t"], "t1": hit["t"]})


def repeated_runs(texts: DataFrame, length: int) -> DataFrame:
    """(k1, k2, start, end): the bytes (end exclusive) of a text that a repeated window covers, one row for each run of windows."""
    anchors = cut_lineage(anchor_table(texts, Bytes, length))
    shared = cut_lineage(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    found = cut_lineage(anchors.join(shared, "h"))
    distinct = found.groupBy("h", "s1", "s2").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "k1", "k2", "first", "windows")).alias("at")
    )
    distinct = cut_lineage(distinct.select("h", "s1", "s2", "copies", "at.*"))
    hot = cut_lineage(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > HOT).select("h", F.lit(True).alias("hot")))
    flagged = distinct.join(hot, "h", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    total = flagged.agg(
        F.coalesce(F.sum(F.col("windows") + (length - 1)), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(F.when(F.col("hot"), F.col("windows"))), F.lit(0)).alias("dealt"),
    ).first()
    shards, ranges = max(1, -(-total["bytes"] // SHARD)), max(1, -(-total["dealt"] // MERGE))
    parts = cut_out(texts, flagged, Bytes, length)
    shard = F.pmod(F.xxhash64("h", F.when(F.col("hot"), F.col("s1")).otherwise(F.lit(0))), F.lit(shards))
    sorted_ = cut_lineage(
        parts.withColumn("shard", shard).repartition(-(-shards // SHARDS), "shard").groupBy("shard").applyInArrow(lambda table: sorted_shard(table, length, ranges), FOUND)
    )
    crossing = sorted_.where("range is not null").select("range", "prints", "refs").repartition(ranges, "range").groupBy("range").applyInArrow(merged_range, FOUND)
    runs = sorted_.where("range is null").unionAll(crossing) if total["dealt"] else sorted_
    runs = cut_lineage(runs.select(F.col("h").alias("rh"), F.col("s1").alias("r1"), F.col("s2").alias("r2"), "t0", "t1"))
    places = cut_lineage(found.select("k1", "k2", "h", "s1", "s2", "first").distinct())
    on = (F.col("h") == F.col("rh")) & (F.col("s1") == F.col("r1")) & (F.col("s2") == F.col("r2"))
    return places.join(runs, on).select("k1", "k2", (F.col("first") + F.col("t0")).alias("start"), (F.col("first") + F.col("t1") + length).alias("end"))


def dedup(docs: DataFrame, length: int = 400, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the remaining bytes)."""
    texts = keyed(docs, text, doc_id)
    runs = cut_lineage(repeated_runs(texts, length))
    lists = cut_lineage(runs.groupBy(F.col("k1").alias("r1"), F.col("k2").alias("r2")).agg(F.collect_list(F.struct("start", "end")).alias("runs")))
    joined = texts.join(lists, (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2")), "left").select("doc", "text", "runs")
    schema = StructType(
        [StructField(doc_id, docs.schema[doc_id].dataType)]
        + [StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
        + [StructField("kept", BinaryType())]
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in slices(batch.column(1)):
                ids = batch.column(0).slice(start, len(part))
                out = []
                for t, places in zip(part, batch.column(2).slice(start, len(part)).to_pylist()):
                    raw, spans = (t or "").encode(), []
                    for a, b in sorted((p["start"], p["end"]) for p in places or ()):
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], b)
                        else:
                            spans.append([a, b])
                    ends = [0, *(x for s in spans for x in s), len(raw)]
                    kept = b"".join([raw[a:b] for a, b in zip(ends[::2], ends[1::2])])
                    out.append((len(raw), len(raw) - len(kept), len(spans), kept))
                columns = [pa.array(c, pa.binary() if i == 3 else pa.int64()) for i, c in enumerate(zip(*out))]
                yield pa.RecordBatch.from_arrays([ids, *columns], names=schema.names)
        release()

    return joined.mapInArrow(remove, schema)
