import math
import zlib
from collections import Counter

import numpy as np
import pytest

from opspark.llm import pitmanyor, queries

from . import cases


def held(doc: int | None) -> bool:
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1


def tokens(text: str | None) -> list[str]:
    return cases.words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [" end"]


def base(data: list[tuple]) -> list[tuple]:
    c = Counter(w for r in data if not held(r[0]) for w in tokens(r[1]))
    n, v = sum(c.values()), len(c)
    out = []
    for r in data:
        t = tokens(r[1])
        out.append((r[0], held(r[0]), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)))
    return out


def scored(spark, data, tmp_path, extra=False):
    cases.frame(spark, data, extra).write.parquet(f"{tmp_path}/documents.parquet")
    return queries.op11_lm_scoring(spark, str(tmp_path)).collect()


def as_base(rows) -> list[tuple]:
    return sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows], key=cases.key)


@pytest.fixture(scope="module")
def small(spark):
    sf = "/root/testdata/sf0.001"
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    return data, queries.op11_lm_scoring(spark, sf).collect()


def test_counts_and_base_score(small):
    data, rows = small
    assert as_base(rows) == sorted(base(data), key=cases.key)


def test_perplexity_of_held_out_texts(small):
    _, rows = small
    unseen = [r for r in rows if r.held_out]
    n = sum(r.n_tokens for r in unseen)
    assert sum(r.score for r in unseen) / n > sum(r.base_score for r in unseen) / n + 0.2
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)


def test_every_case(spark, tmp_path):
    data = cases.rows()
    rows = scored(spark, data, tmp_path, extra=True)
    assert as_base(rows) == sorted(base(data), key=cases.key)
    by_text: dict = {}
    for r in rows:
        if r.doc_id in (40, 41, None):
            by_text.setdefault(r.n_tokens, set()).add(round(r.score, 9))
    # Equal texts have equal scores, whichever rows they are; a null text is its end alone.
    assert all(len(s) == 1 for s in by_text.values())


def test_no_rows_and_no_training(spark, tmp_path):
    assert scored(spark, [], tmp_path / "none") == []
    ids = [i for i in range(60) if held(i)]
    rows = scored(spark, [(i, "some words here", "en", "s") for i in ids], tmp_path / "held")
    assert len(rows) == len(ids) and {(r.n_known, r.train_tokens, r.base_score, r.score) for r in rows} == {(0, 0, 0.0, 0.0)}


def test_kept_columns_replace_nothing_but_results(spark):
    from pyspark.sql import functions as F

    docs = cases.frame(spark, [(1, "a b", "en", "s"), (1, "a b", "en", "s")]).select("*", F.lit(5).alias("block"), F.lit("x").alias("score"), F.lit(7).alias("train_row"))
    rows = pitmanyor.score(docs, F.lit(True)).collect()
    assert len(rows) == 2 and all(r.block == 5 and r.train_row == 7 and isinstance(r.score, float) for r in rows)


def test_predictive_probabilities_sum_to_one(spark):
    """Texts of up to two words give the transition matrix up to a change of scale of its states, so its largest eigenvalue must be 1.

    An unknown word stands for the one class of all others; the end of a text leads back to its start.
    """
    from pyspark.sql import functions as F

    train = [(i, t, "en", "s") for i, t in enumerate(["a b a c", "a b", "c a b a", "b b b", "a", "", "a b c a b"])]
    states = ["a", "b", "c", "zz"]
    probes = ["", *states, *[f"{x} {y}" for x in states for y in states]]
    rows = pitmanyor.score(cases.frame(spark, train + [(100 + i, t, "en", "s") for i, t in enumerate(probes)]), F.col("doc_id") < 100).collect()
    p = {r.text: 10**r.score for r in rows if r.doc_id >= 100}
    k = np.ones((5, 5))
    k[0, 0] = p[""]
    for i, x in enumerate(states, 1):
        k[i, 0] = p[x]
        for j, y in enumerate(states, 1):
            k[i, j] = p[f"{x} {y}"] / p[y]
    assert abs(np.abs(np.linalg.eigvals(k)).max() - 1) < 1e-9


def test_sampler_agrees_with_exact_enumeration():
    """The number of tables of single cells, against its exact distribution x^t S(c, t) by generalised Stirling numbers."""
    d, theta, prior, others, c = 0.4, 1.0, 0.3, 5, 4
    stirling = {(0, 0): 1.0}
    for n in range(1, c + 1):
        for t in range(1, n + 1):
            stirling[n, t] = stirling.get((n - 1, t - 1), 0.0) + (n - 1 - d * t) * stirling.get((n - 1, t), 0.0)
    weight, total = {}, 1.0
    for t in range(1, c + 1):
        total *= (theta + d * (others + t - 1)) * prior
        weight[t] = total * stirling[c, t]
    exact = np.array([weight[t] for t in range(1, c + 1)]) / sum(weight.values())
    m, rng = 40_000, np.random.default_rng(5)
    cells = np.full(m, c)
    seats = pitmanyor.Seats.start(cells, np.full(m, 0.5), d, rng)
    for _ in range(12):
        seats = seats.reseat(cells, np.full(m, prior), others + seats.n, theta, d, rng)
        assert seats.sizes.sum() == c * m and (seats.sizes > 0).all()
    got = np.bincount(seats.n, minlength=c + 1)[1:] / m
    assert np.abs(got - exact).max() < 0.012


def test_hot_cells_keep_their_customers():
    rng = np.random.default_rng(1)
    c = np.array([1_000_000, 2, 50_000, 3])
    seats = pitmanyor.Seats.start(c, np.full(4, 2.0), 0.5, rng)
    for _ in range(3):
        seats = seats.reseat(c, np.full(4, 0.1), np.full(4, 100), 1.0, 0.5, rng)
    edges = np.concatenate(([0], np.cumsum(seats.n)))
    assert [int(seats.sizes[a:b].sum()) for a, b in zip(edges[:-1], edges[1:])] == c.tolist()
    assert seats.n[0] > seats.n[2] > 1


@pytest.mark.parametrize("c, passes", [(9, 2), (400, 2), (3000, 12)])
def test_customers_beyond_a_scan_move_too(c, passes):
    """Cells of more customers than a pass reseats one by one: the number of tables, against its exact distribution. Small ones begin with one table."""
    d, theta, prior, others, most = 0.4, 1.0, 0.3, 5, min(c, 200)
    t = np.arange(1, most + 1)
    stirling = np.concatenate(([0.0], np.full(most, -np.inf)))
    for n in range(c):
        with np.errstate(divide="ignore"):
            stirling[1:] = np.logaddexp(stirling[:-1], np.log(np.maximum(0, n - d * t)) + stirling[1:])
        stirling[0] = -np.inf
    log = np.cumsum(np.log((theta + d * (others + t - 1)) * prior)) + stirling[1:]
    exact = np.exp(log - log.max())
    exact /= exact.sum()
    m, rng = 4_000, np.random.default_rng(6)
    cells = np.full(m, c)
    seats = pitmanyor.Seats(np.ones(m, np.int64), cells.copy()) if c < 1000 else pitmanyor.Seats.start(cells, np.full(m, (theta + d * others) * prior), d, rng)
    for _ in range(passes):
        seats = seats.reseat(cells, np.full(m, prior), others + seats.n, theta, d, rng)
        assert seats.sizes.sum() == c * m and (seats.sizes > 0).all()
    mean = float((t * exact).sum())
    got = np.bincount(seats.n, minlength=most + 1)[1 : most + 1] / m
    assert abs(seats.n.mean() - mean) < (0.03 if c < 1000 else 0.06) * mean, (seats.n.mean(), mean)
    assert np.abs(got - exact).max() < 0.03
