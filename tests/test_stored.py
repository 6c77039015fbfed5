"""Stored vectors and the replay that searches them."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from opspark.operators import ledger
from opspark.plans import catalog, log_queries, stored
from opspark.session import checkpoint_dir

HYBRID = ["cache_hybrid", "cache_impact_hybrid", "cache_outcomes", "eval_report_hybrid"]


def table(spark, vectors, parts=5):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id bigint, v array<double>").repartition(parts)


def placed(spark, vectors):
    made = stored.store(table(spark, vectors).withColumn("ord", F.col("id")), "v")
    return made, made.rows.select("id", "part", "row", "ord")


@pytest.mark.parametrize("spread", [0.02, 0.3, 5.0])
def test_searches_of_stored_vectors_against_brute_force(spark, spread, monkeypatch):
    """Tight clusters are searched by cell, loose vectors by time; tiles, chunks and parts are many."""
    monkeypatch.setattr(stored, "QUERIES", 32)
    monkeypatch.setattr(stored, "VECTORS", 16)
    monkeypatch.setattr(stored, "WORTH", 20)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(15, 8))[rng.integers(0, 15, 400)] + rng.normal(size=(400, 8)) * spread
    vectors[200:260] = vectors[7] * np.linspace(1, 3, 60)[:, None]
    made, rows = placed(spark, vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    sims = unit @ unit.T
    asked, among = rows.where("id % 3 <> 0"), rows.where("id % 2 = 0")
    best = {r.id: (r.hit, r.similarity) for r in stored.best_earlier(made, asked, among, tile_rows=40).collect()}
    some = [r.id for r in stored.with_earlier(made, asked, among, tile_rows=40).collect()]
    assert sorted(some) == sorted(best)
    for q in range(400):
        most = max((sims[q, c] for c in range(0, q, 2)), default=-1) if q % 3 else -1
        if q in best:
            assert best[q][0] < q and best[q][0] % 2 == 0
            assert best[q][1] == pytest.approx(most, abs=1e-9)
            assert sims[q, best[q][0]] == pytest.approx(most, abs=1e-9)
        else:
            assert most < 0.92 + 1e-9


def test_stored_vectors_without_direction_and_of_other_lengths(spark):
    rows = [(0, [1.0, 0.1]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, []), (5, [float("nan"), 1.0]), (6, [1.0, 0.1]), (7, [0.0])]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    made = stored.store(df.withColumn("ord", F.col("id")).coalesce(1), "v")
    assert sorted(r.id for r in made.rows.where("part is not null").collect()) == [0, 6]
    rows = made.rows.select("id", "part", "row", "ord")
    assert [(r.id, r.hit) for r in stored.best_earlier(made, rows, rows).collect()] == [(6, 0)]
    assert stored.with_earlier(made, rows, rows.where("id > 6")).count() == 0
    for parts in (1, 2):
        mixed = spark.createDataFrame([(0, [1.0, 0.1]), (1, [1.0, 0.1, 0.2])], "id bigint, v array<double>").repartition(parts, "id").withColumn("ord", F.col("id"))
        with pytest.raises(Exception, match="vectors of different lengths"):
            made = stored.store(mixed, "v")
            rows = made.rows.select("id", "part", "row", "ord")
            stored.with_earlier(made, rows, rows).collect()


def size_of(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)


def test_a_replay_keeps_one_copy_of_the_vectors(spark, monkeypatch):
    """Whatever the rounds, the vectors are on disk once, and afterwards not at all."""
    rng = np.random.default_rng(8)
    n, d = 2000, 64
    vectors = rng.normal(size=(n, d))
    log = spark.createDataFrame([(i, f"q{i}", f"a{i}", v.tolist()) for i, v in enumerate(vectors)], "query_id long, query string, answer string, v array<double>")
    folder = checkpoint_dir(spark).removeprefix("file:")
    before, stores = size_of(folder), []
    monkeypatch.setattr(ledger, "drop", lambda s, path, drop=ledger.drop: (stores.append(size_of(path.removeprefix("file:"))), drop(s, path)))
    out = ledger.hybrid_replay(log, F.col("v"))
    assert out.groupBy("outcome").count().collect() == [("miss", n)]
    assert size_of(folder) - before < n * d * 8 / 2
    assert n * d * 8 <= stores[0] < n * d * 8 * 1.4
    halves = log.withColumn("v", F.transform("v", lambda x: F.floor(x * 64) / 64))
    ledger.hybrid_replay(halves, F.col("v"), responses=False)
    assert stores[1] < n * d * 4 * 1.8


def test_a_replay_without_responses_has_the_same_outcomes(spark):
    """Also where ids come twice: each row of an entry answers."""
    a, b = [1.0, 0.0], [1.0, 0.2]
    rows = [(0, "x", "A", a), (0, "x", "A", a), (1, "y", "B", b), (2, " X", "C", a), (3, None, "D", None)]
    log = spark.createDataFrame(rows, "query_id long, query string, answer string, v array<double>")
    out = ledger.hybrid_replay(log, F.col("v")).select("query_id", "outcome", "cached_response", "hit").collect()
    want = [(0, "miss", None, False)] * 2 + [(1, "semantic_hit", "A", True)] * 2 + [(2, "exact_hit", "A", True), (3, "miss", None, False)]
    assert sorted(map(tuple, out)) == want
    less = ledger.hybrid_replay(log, F.col("v"), responses=False)
    assert "cached_response" not in less.columns
    assert sorted(map(tuple, less.select("query_id", "outcome", "hit").collect())) == [(i, o, h) for i, o, _, h in want]


@pytest.mark.parametrize("name", HYBRID)
def test_hybrid_queries_leave_no_vectors_on_disk(spark, name, tmp_path):
    """What is left of a query's frames is smaller than half a copy of the vectors that ask."""
    n, d = 2000, 64
    vectors = np.random.default_rng(9).normal(size=(n, d))
    rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int")
    rows.write.parquet(f"{tmp_path}/embeddings.parquet")
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = size_of(folder)
    assert catalog.QUERIES[name](spark, str(tmp_path)).count() > 0
    assert size_of(folder) - before < len(log_queries.STEPS) * n * d * 8 / 2
