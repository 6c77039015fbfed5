"""Substring dedup of word windows: seed and extend.

Seeds are winnowed anchors (``anchors.py``): every window of ``length`` words holds one, and equal windows hold the same
one. Documents are joined on the anchors they share. Among the occurrences of an anchor, equal neighbourhoods are first
counted together, with their smallest document; each distinct neighbourhood is then extended from the anchor to the left
and right against those of smaller documents, and the extended match is a maximal repeat there. Where it spans the
length, its windows are known to start in that smaller document. Occurrences that neighbouring anchors find join up to
maximal runs of removed words.

An anchor with more than ``PAIRS`` distinct neighbourhoods is not compared pair by pair: its windows are hashed and
grouped, with the smallest document of each, by a shuffle that combines on the map side. This is exact as well.

Definitions: a null text has no words. Equal documents ids are not smaller than each other. A null id is larger than any
other, so of copies with and without an id the one with it stays whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..session import cut_lineage
from .anchors import Words, anchor_table, cut_out, keyed
from .texts import release, slices

#: Distinct neighbourhoods of an anchor that are compared pair by pair.
PAIRS = 48

#: Stands for a null document id, larger than any other.
NO_ID = np.iinfo(np.int64).max


def extended(group: list[tuple[int, int, int, list[bytes]]], length: int) -> list[list[tuple[int, int, int]]]:
    """For each neighbourhood (smallest document, place of the anchor, windows, words): runs (first, last window, document)
    of windows with the smallest document they start in. The group is sorted by document."""
    ids: dict[bytes, int] = {}
    words = [np.array([ids.setdefault(w, len(ids)) for w in g[3]], np.int64) for g in group]
    out = []
    for x, (doc, place, windows, _) in enumerate(group):
        least = np.full(windows, doc, np.int64)
        for y in range(x - 1, -1, -1):
            # From larger to smaller documents, so that the smallest remains.
            doc_y, place_y = group[y][:2]
            if doc_y == doc:
                continue
            a, b = words[x], words[y]
            left = min(place, place_y)
            differ = np.flatnonzero(a[place - left : place][::-1] != b[place_y - left : place_y][::-1])
            left = int(differ[0]) if len(differ) else left
            right = min(len(a) - place, len(b) - place_y)
            differ = np.flatnonzero(a[place : place + right] != b[place_y : place_y + right])
            right = int(differ[0]) if len(differ) else right
            if left + right >= length:
                least[max(place - left, 0) : max(place + right - length + 1, 0)] = doc_y
        edge = np.flatnonzero(np.diff(least, prepend=-1, append=-1))
        out.append([(int(a), int(b) - 1, int(least[a])) for a, b in zip(edge, edge[1:])])
    return out


RUNS = StructType(
    [StructField(n, LongType()) for n in ("h", "s1", "s2")] + [StructField("t0", IntegerType()), StructField("t1", IntegerType()), StructField("least", LongType())]
)


def extend(parts: DataFrame, length: int) -> DataFrame:
    """Runs of windows with their smallest document, for rows (h, s1, s2, windows, place, least, segment) of small groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def finish() -> list[tuple]:
            group = [(r[5], r[4], r[3], r[6].split(b" ")) for r in held]
            return [(*r[:3], a, b, doc) for r, runs in zip(held, extended(group, length)) for a, b, doc in runs]

        def table(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

        for batch in batches:
            # Some hundred rows at a time as Python objects, whatever the size of a batch.
            for at in range(0, batch.num_rows, 512):
                out: list[tuple] = []
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns)):
                    if held and held[0][0] != row[0]:
                        out += finish()
                        held = []
                    held.append(row)
                if out:
                    yield table(out)
        if held:
            yield table(finish())
        release()

    arrow = pa.schema([(f.name, pa.int64() if f.dataType == LongType() else pa.int32()) for f in RUNS])
    rows = parts.select("h", "s1", "s2", "windows", "place", "least", "segment").repartition("h").sortWithinPartitions("h", "least", "s1", "s2")
    return rows.mapInArrow(run, RUNS)


def by_window(parts: DataFrame, length: int) -> DataFrame:
    """The same runs for anchors with many neighbourhoods: windows grouped by a 128-bit hash."""
    schema = StructType([*RUNS.fields[:3], StructField("t", IntegerType()), StructField("w1", LongType()), StructField("w2", LongType()), StructField("least", LongType())])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, s1, s2, windows, least = (batch.column(c).to_numpy() for c in range(5))
            for at in range(0, batch.num_rows, 256):
                digests, ts, rows = [], [], []
                for i in range(at, min(at + 256, batch.num_rows)):
                    units = Words(batch.column(5)[i].as_py().decode())
                    n = int(windows[i])
                    digests += [xxhash.xxh3_128_digest(units.part(t, length)) for t in range(n)]
                    ts.append(np.arange(n, dtype=np.int32))
                    rows.append(np.full(n, i))
                r = np.concatenate(rows)
                w = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                columns = [h[r], s1[r], s2[r], np.concatenate(ts), w[:, 0].copy(), w[:, 1].copy(), least[r]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)
        release()

    each = cut_lineage(parts.select("h", "s1", "s2", "windows", "least", "segment").mapInArrow(explode, schema))
    least = cut_lineage(each.groupBy("w1", "w2").agg(F.min("least").alias("found"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    rows = each.join(least, ["w1", "w2"], "left")
    return rows.select("h", "s1", "s2", F.col("t").alias("t0"), F.col("t").alias("t1"), F.coalesce("found", "least").alias("least"))


def repeated_runs(texts: DataFrame, length: int) -> DataFrame:
    """(k1, k2, start, end, least): runs of words (end exclusive) of a text whose windows also start in document ``least``."""
    anchors = cut_lineage(anchor_table(texts, Words, length))
    doc = F.coalesce("doc", F.lit(NO_ID))
    shared = cut_lineage(anchors.groupBy("h").agg(F.min(doc).alias("low"), F.max(doc).alias("high")).where("low < high").select("h"))
    found = cut_lineage(anchors.join(shared, "h"))
    # The distinct neighbourhoods of each shared anchor, each with its smallest document and one place of it.
    distinct = found.groupBy("h", "s1", "s2").agg(
        F.min(F.struct(doc.alias("least"), "k1", "k2", "first", "windows", "place")).alias("at"), F.max(doc).alias("most")
    )
    distinct = cut_lineage(distinct.select("h", "s1", "s2", "most", "at.*"))
    sizes = cut_lineage(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))
    several = distinct.join(sizes, "h").withColumn("doc", F.when(F.col("least") < NO_ID, F.col("least")))
    parts = cut_lineage(cut_out(texts, several.drop("most"), Words, length))
    alone = distinct.join(sizes, "h", "left_anti").select("h", "s1", "s2", F.lit(0).alias("t0"), (F.col("windows") - 1).alias("t1"), "least")
    runs = extend(parts.where(F.col("kinds") <= PAIRS), length).unionAll(by_window(parts.where(F.col("kinds") > PAIRS), length)).unionAll(alone)
    runs = cut_lineage(runs.select(F.col("h").alias("rh"), F.col("s1").alias("r1"), F.col("s2").alias("r2"), "t0", "t1", "least"))
    # Copies share a text key; only runs that some document of the text loses go on.
    places = cut_lineage(found.groupBy("k1", "k2", "h", "s1", "s2", "first").agg(F.max(doc).alias("top")))
    on = (F.col("h") == F.col("rh")) & (F.col("s1") == F.col("r1")) & (F.col("s2") == F.col("r2"))
    hit = places.join(runs, on).where("least < top")
    return hit.select("k1", "k2", (F.col("first") + F.col("t0")).alias("start"), (F.col("first") + F.col("t1") + length).alias("end"), "least")


KEPT = [("n_words", LongType()), ("n_removed", LongType()), ("kept", StringType())]


def dedup(docs: DataFrame, length: int = 50, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_removed`` and ``kept``, its remaining words joined by one space."""
    texts = keyed(docs, text, doc_id)
    runs = cut_lineage(repeated_runs(texts, length))
    lists = runs.groupBy(F.col("k1").alias("r1"), F.col("k2").alias("r2")).agg(F.collect_list(F.struct("start", "end", "least")).alias("runs"))
    joined = texts.join(cut_lineage(lists), (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2")), "left").select("doc", "text", "runs")
    schema = StructType([StructField(doc_id, docs.schema[doc_id].dataType)] + [StructField(n, t) for n, t in KEPT])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in slices(batch.column(1)):
                ids = batch.column(0).slice(start, len(part))
                out = []
                for t, doc, runs in zip(part, ids.to_pylist(), batch.column(2).slice(start, len(part)).to_pylist()):
                    words = (t or "").encode().split()
                    gone = np.zeros(len(words) + 1, np.int64)
                    doc = NO_ID if doc is None else doc
                    lost = [(r["start"], r["end"]) for r in runs or () if r["least"] < doc]
                    if lost:
                        a, b = np.array(lost).T
                        np.add.at(gone, a, 1)
                        np.add.at(gone, b, -1)
                        stay = np.cumsum(gone[:-1]) == 0
                        kept = [w for w, s in zip(words, stay.tolist()) if s]
                    else:
                        kept = words
                    out.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
                columns = [pa.array(c, pa.string() if i == 2 else pa.int64()) for i, c in enumerate(zip(*out))]
                yield pa.RecordBatch.from_arrays([ids, *columns], names=schema.names)
        release()

    return joined.mapInArrow(remove, schema)
