import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa

from opspark.llm import collocations, queries

from . import cases


def brute(data: list[tuple], least: int, nested: int, top: int) -> list[tuple]:
    counts: dict[str, Counter] = {}
    for _, text, lang, _ in data:
        own = counts.setdefault(lang if lang is not None else "und", Counter())
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            own.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {part for p, a in candidates.items() if len(p) == 3 for part in (p[:2], p[1:]) if 100 * a >= nested * f[part]}
        rows = []
        for p, a in candidates.items():
            score, _, l, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            if p not in gone:
                rows.append((" ".join(p), a, l, r, score))
        rows.sort(key=lambda x: (-x[4], -x[1], x[0].encode()))
        out += [(lang, i, p, a, l, r, n, s) for i, (p, a, l, r, s) in enumerate(rows[:top], 1)]
    return out


def awkward() -> list[tuple]:
    data = cases.rows()
    data += [(200 + i, "New York, new york City! it is. " * (i + 1) + "a\tb  a b\x0bc d\x00e", ["en", None, "und", "x\ny"][i % 4], "s") for i in range(9)]
    data += [(300, "z z z z z z z", "en", "s"), (301, "ü ß ü ß ü ß É É", "und", "s")]
    return data


def test_equals_brute_force_on_every_case(spark):
    data = awkward()
    for least, nested, top in ((1, 50, 7), (3, 50, 2000), (2, 101, 2000)):
        got = collocations.collocations(cases.frame(spark, data, extra=True), least=least, nested=nested, top=top)
        cases.same(got, brute(data, least, nested, top))


def test_empty_tables(spark):
    assert collocations.collocations(cases.frame(spark, [])).count() == 0
    assert collocations.collocations(cases.frame(spark, [(1, None, "en", "s"), (2, "", None, "s")])).count() == 0


def test_query_equals_sql(spark, tmp_path):
    data = awkward()
    cases.frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(queries.ORACLES["op13_collocations"]).fetchall()
    got = queries.op13_collocations(spark, str(tmp_path))
    cases.same(got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), want)
    assert want


def test_union_of_blocks_is_the_block_of_all():
    data = awkward()
    block = collocations._Block()
    block.add([r[2] or "und" for r in data], [r[1] for r in data])
    (_, whole), = block.transducers(1)
    parts = []
    for r in data:
        one = collocations._Block()
        one.add([r[2] or "und"], [r[1]])
        parts += [b for _, b in one.transducers(1)]
    merged, totals = collocations.union(parts)
    assert merged.blob() == whole
    assert sum(totals.values()) == int(merged.root[1].sum())
    # Over several ranges each phrase is counted in exactly one.
    block.add([r[2] or "und" for r in data], [r[1] for r in data])
    split = [collocations.paths(collocations.Transducer.load(b)) for _, b in block.transducers(5)]
    one, two, three = collocations.paths(merged)
    assert sum(len(p[0][0]) for p in split) == len(one[0]) and sum(len(p[1][0]) for p in split) == len(two[0])
    assert sum(int(p[2][2].sum()) for p in split) == int(three[2].sum())


def test_equal_states_are_shared():
    # Two contexts followed by the same words with the same counts lead to one state.
    words = pa.array([b"en\n" + w for w in (b"a", b"b", b"c", b"d")])
    one = (np.arange(4), np.full(4, 9))
    two = (np.array([0, 1, 2]), np.array([2, 2, 3]), np.array([5, 5, 5]))
    three = (np.array([0, 0, 1, 1]), np.array([0, 3, 0, 3]), np.array([2, 3, 2, 3]))
    t = collocations.build(words, one, two, three)
    assert len(t.third[0]) - 1 == 2 and len(t.second[0]) - 1 == 2
    for got, want in zip(collocations.paths(t), (one, two, three)):
        assert all((g == w).all() for g, w in zip(got, want))


def test_composition_finds_what_both_have():
    words = pa.array([b"en\na", b"en\nb", b"en\nc"])
    none = np.zeros(0, np.int64)
    counts = collocations.build(words, (np.array([0, 2]), np.array([7, 8])), (np.array([0, 1]), np.array([1, 2]), np.array([3, 4])), (none, none, none))
    asked = collocations.build(pa.array([b"en\na", b"en\nb", b"en\nx"]), (np.array([0, 1, 2]), np.ones(3, np.int64)), (np.array([0, 0, 1, 2]), np.array([1, 2, 0, 0]), np.ones(4, np.int64)), (none, none, none))
    single, pair = collocations.compose(asked, counts)
    assert single.tolist() == [7, 0, 0] and pair.tolist() == [3, 0, 0, 0]


def test_scores_beyond_64_bits(spark):
    n = 900000000000
    exact = collocations.exact_score("a", "l", "r")
    row = spark.createDataFrame([(n, n + 1, n + 7)], "a long, l long, r long").select(exact.alias("x")).first()
    assert row.x == 1000000 * n * n // ((n + 1) * (n + 7))
