import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opspark.llm import periodic, queries

from . import cases


def brute_runs(words: list, shortest: int = 6, repeats: int = 4) -> list[tuple[int, int, int]]:
    """Every run by trying each period, smallest first."""
    out: list[tuple[int, int, int]] = []
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            inside = any(a <= i and i + length <= a + n and q % p == 0 for a, n, p in out)
            if j > i and length >= max(shortest, repeats * q) and not inside:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def contract(doc: int | None, text: str | None) -> tuple:
    w = cases.words(text)
    n = len(w)
    if doc is not None and n:
        h = zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for a, length, q in found for i in range(a + q, a + length)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc, len(found), *best, milli, cases.sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), cases.sha(kept))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 8), st.integers(0, 30))
def test_runs_equal_brute_force(head, period, more):
    words = head + [head[i % period] if i % period < len(head) else 7 + i % period for i in range(more)]
    got = periodic.runs(np.array(words, np.int64))
    assert list(zip(*(x.tolist() for x in got))) == brute_runs(words)


def test_texts_of_a_slice_do_not_touch():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 30))) for _ in range(200)]
    for t, (w, found) in zip(texts, periodic._slice(texts, 6, 4)):
        assert w == t.encode().split() and [tuple(r) for r in found.tolist()] == brute_runs(t.split())


def test_long_runs_take_no_quadratic_time():
    for period in (1, 3, 70_001):
        start, length, q = periodic.runs(np.arange(300_000) % period)
        assert (start.tolist(), length.tolist(), q.tolist()) == ([0], [300_000], [period])


def test_few_repeats_are_refused():
    with pytest.raises(ValueError):
        periodic.runs(np.zeros(5, np.int64), repeats=3)


def query(spark, data, tmp_path, extra=False):
    cases.frame(spark, data, extra).write.parquet(f"{tmp_path}/documents.parquet")
    return queries.op12_periodic_runs(spark, str(tmp_path))


def test_query_equals_brute_force_on_every_case(spark, tmp_path):
    data = cases.rows()
    data = [r for r in data if r[0] != 59] + [(100 + i, cases.prose(20 + i, i), "en", "s") for i in range(80)]
    cases.same(query(spark, data, tmp_path, extra=True), [contract(r[0], r[1]) for r in data])


def test_empty_table(spark, tmp_path):
    assert query(spark, [], tmp_path).count() == 0


def test_kept_columns_and_clashing_names(spark):
    docs = cases.frame(spark, [(1, "a b a b a b a b c", "en", "s")]).select("*", F.lit(1).alias("runs"), F.lit(2).alias("n_words"), F.lit(3).alias("best"))
    row = periodic.find(docs).first()
    assert row.best == 3 and row.n_words == 9 and [tuple(r) for r in row.runs] == [(0, 8, 2)] and row.collapsed == "a b c"


def test_small_scale_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    cases.same(queries.op12_periodic_runs(spark, sf), [contract(r[0], r[1]) for r in rows])


def test_checking_sql_equals_brute_force(spark, tmp_path):
    import duckdb

    data = [r for r in cases.rows() if r[0] != 59] + [(100 + i, cases.prose(20 + i, i), "en", "s") for i in range(80)]
    rnd = random.Random(9)
    data += [(300 + i, " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 60))), "en", "s") for i in range(120)]
    cases.frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = con.execute(periodic.checking_sql()).fetchall()
    assert sorted(got, key=cases.key) == sorted([contract(r[0], r[1]) for r in data], key=cases.key)
