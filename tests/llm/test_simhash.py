import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opspark.llm import simhash
from opspark.llm.components import smallest_labels

from . import cases


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def expected(rows, shingle, radius):
    fps = [cases.simhash(r[1], shingle) for r in rows]
    label = cases.clusters(fps, radius)
    out = []
    for r, f, g in zip(rows, fps, label):
        ids = [x[0] for x, other in zip(rows, label) if other == g and x[0] is not None]
        out.append((r[0], signed(f), min(ids, default=None)))
    return out


@pytest.mark.parametrize(("radius", "tile"), [(2, 8192), (12, 5)])
def test_groups(spark, monkeypatch, radius, tile):
    """With radius 12 chains of links run through many documents and tiles."""
    monkeypatch.setattr(simhash, "TILE", tile)
    got = simhash.groups(cases.frame(spark, extra=True), shingle=3, radius=radius)
    cases.same(got.select("doc_id", "fp", "component_id"), expected(cases.rows(), 3, radius))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40), st.integers(0, 3), st.randoms(use_true_random=False))
def test_links_connect_what_is_near(base, radius, rnd):
    fps = {*base, *(b ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for b in base)}
    fps = np.array(sorted(fps, key=lambda x: (x.bit_count(), x)), np.uint64)
    u, v = simhash.links(fps, fps, radius, True)
    label = {int(f): int(f) for f in fps}
    for _ in range(len(fps)):
        for a, b in zip(u.tolist(), v.tolist()):
            label[a] = label[b] = min(label[a], label[b])
    want = cases.clusters([int(f) for f in fps], radius)
    groups: dict = {}
    assert all(groups.setdefault(w, label[int(f)]) == label[int(f)] for f, w in zip(fps, want))
    assert len(set(groups.values())) == len(groups)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.label for r in smallest_labels(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


def test_one_of_each(spark):
    rows = cases.rows()
    got = sorted(r.doc_id if r.doc_id is not None else -1 for r in simhash.one_of_each(cases.frame(spark, extra=True), 3, 2).collect())
    ids = {c if c is not None else -1 for _, _, c in expected(rows, 3, 2)}
    assert got == sorted(ids)


def test_empty(spark):
    empty = cases.frame(spark, [])
    assert simhash.groups(empty, 3, 2).count() == 0
    assert simhash.one_of_each(empty, 3, 2).count() == 0


def test_fingerprint_of_no_words():
    assert simhash.fingerprint(None, 3) == simhash.fingerprint(" \n", 3) == 0


def test_tiles_hold_one_population_count(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 7)
    fps = [signed(x) for x in np.random.default_rng(5).integers(0, 2**64, 500, dtype=np.uint64).tolist()]
    tiles = simhash.tiles(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()
    found = [int(x) for t in tiles for x in np.frombuffer(t.fps, "<i8")]
    assert sorted(found) == sorted(fps)
    for t in tiles:
        assert {int(x).bit_count() for x in np.frombuffer(t.fps, "<u8")} == {t.bits}
        assert len(t.fps) <= 56


