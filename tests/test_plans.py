"""Shapes of physical plans that matter at scale."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opspark.operators import corpus, demand, features, ledger
from opspark.plans import nearest
from opspark.sources.literals import literal_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "fact")
    start = dt.datetime(2024, 1, 1)
    rows = [(z, start + dt.timedelta(minutes=15 * i), i % 7, 0) for z in range(3) for i in range(200)]
    literal_table(spark, rows, "zone_id bigint, time_bucket timestamp_ntz, trip_count bigint, is_holiday int").write.parquet(path)
    return spark.read.parquet(path)


def test_literal_tables_have_a_known_size(spark):
    assert "LocalTableScan" in plan(literal_table(spark, [(1, "a")], "x int, y string"))


def test_profile_takes_one_shuffle(fact):
    assert plan(demand.demand_profile(fact)).count("Exchange hashpartitioning") == 1


def test_history_features_take_one_shuffle(fact):
    out = plan(features.with_lags_and_rolling(fact))
    assert out.count("Exchange hashpartitioning") == 1 and "chunk" in out


def test_ranking_limits_groups_before_the_shuffle(spark, fact):
    zones = literal_table(spark, [(0, "a", "b")], "zone_id bigint, name string, borough string")
    out = plan(demand.zone_ranking(demand.demand_profile(fact), zones, 5))
    assert out.count("WindowGroupLimit") == 2 and "NestedLoop" not in out and "Cartesian" not in out


def test_lookup_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "people")
    literal_table(spark, [(1, "Ann", 3.0)], "id bigint, name string, salary double").write.parquet(path)
    out = plan(corpus.find_entity(spark.read.parquet(path).select("id", "name"), entity_id=1))
    assert "EqualTo(id,1)" in out and "ReadSchema: struct<id:bigint,name:string>" in out


def test_spike_threshold_is_one_scalar_row(spark, tmp_path):
    path = str(tmp_path / "ledger")
    literal_table(spark, [(i, float(i)) for i in range(10)], "id bigint, total_cost double").write.parquet(path)
    out = plan(ledger.cost_spikes(spark.read.parquet(path)))
    assert "Subquery" in out and "Join" not in out


def test_new_rows_filter_is_pushed(fact):
    from opspark.operators import drift

    out = plan(drift.windows(fact, "2024-01-02", "2024-01-02", "2024-01-03").select("trip_count", "is_new"))
    assert "PushedFilters: [" in out and "LessThan(time_bucket" in out


def test_no_broadcast_hint_or_cross_join_in_the_library():
    import pathlib

    root = pathlib.Path(__file__).parents[1] / "opspark"
    for file in root.rglob("*.py"):
        if "llm" in file.parts:  # its broadcasts are of checked or bounded size, which its own tests look at
            continue
        text = file.read_text()
        assert "F.broadcast(" not in text and "crossJoin" not in text and "localCheckpoint" not in text, file


def test_count_of_windows_is_bounded_by_the_chunk(fact):
    sizes = features.in_chunks(fact).groupBy("zone_id", "chunk").agg(F.count("*").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= features.CHUNK_SLOTS + features.HALO_SLOTS


def clustered(spark, n, clusters, seed):
    """Unit vectors around as many centres, each with its own small spread."""
    rng = np.random.default_rng(seed)
    centre = np.random.default_rng(1).normal(size=(clusters, 16))
    v = centre[rng.integers(0, clusters, n)] + 0.05 * rng.normal(size=(n, 16))
    return spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "vector": list(v)}), "vec_id bigint, vector array<double>"), v


def test_the_share_of_pairs_compared_does_not_grow(spark):
    """Pivots follow the table, so a cell stays a small part of it at ten and a hundred times the size."""
    shares, pivots = [], []
    for n in (200, 2000, 20_000):
        rows, _ = clustered(spark, n, 40, n)
        index = nearest.build_index(nearest.entries_of(rows, "vec_id"))
        pivots.append(len(index.pivots))
        shares.append(nearest.compared_share(index, rows.limit(400), "vec_id"))
    assert pivots == [14, 44, 141]
    assert shares[2] <= shares[1] <= shares[0] and shares[2] < 0.1


def test_a_stored_index_is_extended_and_rebuilt(spark, tmp_path):
    rows, v = clustered(spark, 600, 12, 3)
    path = str(tmp_path / "index")
    nearest.store_index(nearest.build_index(nearest.entries_of(rows.where("vec_id < 30"), "vec_id")), path)
    first = len(nearest.open_index(spark, path).pivots)
    for part, (a, b) in enumerate([(30, 90), (90, 140), (90, 140), (140, 600)], 1):
        part = 2 if part == 3 else part
        nearest.extend_index(spark, path, nearest.entries_of(rows.where(f"vec_id >= {a} and vec_id < {b}"), "vec_id"), part)
    index = nearest.open_index(spark, path)
    assert index.cells.count() == index.cells.select("id").distinct().count() == 600 and len(index.pivots) > first
    asked, q = clustered(spark, 50, 12, 9)
    got = {r.query_id: (r.vec_id, round(r.similarity, 9)) for r in nearest.search_index(index, asked.withColumnRenamed("vec_id", "query_id"), "query_id", "vec_id", tile_rows=64).collect()}
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = unit(q) @ unit(v).T
    want = {i: (int(s.argmax()), round(float(s.max()), 9)) for i, s in enumerate(sims) if s.max() >= nearest.THRESHOLD}
    assert got == want and want


def test_an_empty_index(spark):
    none = spark.createDataFrame([], "vec_id bigint, vector array<double>")
    assert nearest.search_index(nearest.build_index(nearest.entries_of(none, "vec_id")), none, "vec_id", "hit").count() == 0


def unstructured(spark, n, seed):
    v = np.random.default_rng(seed).normal(size=(n, 64))
    return spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "vector": list(v)}), "vec_id bigint, vector array<double>")


def test_copies_of_vectors_without_structure_grow_with_the_table(spark):
    """Every query reaches every cell here: what travels is a vector for each block it meets, whatever the number of cells and pairs."""
    for n in (1500, 6000):
        rows = unstructured(spark, n, n)
        index = nearest.build_index(nearest.entries_of(rows, "vec_id"))
        asked = nearest._unit(rows, "vec_id", "vector", None)
        layout, reached = nearest._laid_out(index, asked, 0.4, nearest.TILE_ROWS)
        blocks = int(layout.block.max()) + 1
        assert blocks <= nearest.CUTS + 1 and layout.tiles.max() <= nearest.CUTS
        assert reached.selectExpr("max(size(blocks))").first()[0] <= blocks < len(index.pivots) / 4
        # The blocks hold each vector once.
        assert layout.sizes.sum() == n and set(layout.block.tolist()) == set(range(blocks))


@pytest.mark.parametrize("ordered", [False, True])
def test_matches_across_blocks_and_tiles(spark, ordered):
    """Neighbours of many blocks, a cell dealt over several, equal vectors in different blocks, and rows without an order."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(9, 12))[rng.integers(0, 9, 400)] + rng.normal(size=(400, 12)) * 0.2
    v[50:150] = v[50] + rng.normal(size=(100, 12)) * 1e-3
    when = [None if i % 37 == 5 else i for i in range(400)]
    rows = spark.createDataFrame([(i, [float(x) for x in u], t) for i, (u, t) in enumerate(zip(v, when))], "cid bigint, vector array<double>, t bigint")
    order = {"query_order": "t", "cached_order": "t"} if ordered else {}
    got = {r.qid: (r.cid, r.similarity) for r in nearest.best_match(rows.withColumnRenamed("cid", "qid"), rows, "qid", "cid", pivots=20, tile_rows=8, **order).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    sims = unit @ unit.T
    for q in range(400):
        allowed = [c for c in range(400) if not ordered or (when[q] is not None and when[c] is not None and c < q)]
        best = max((sims[q, c] for c in allowed), default=-1)
        assert (q in got) == (best >= nearest.THRESHOLD)
        if q in got:
            assert got[q][0] in allowed and abs(got[q][1] - best) < 1e-9 and abs(sims[q, got[q][0]] - best) < 1e-9
