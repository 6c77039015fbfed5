"""Periodic runs of words, by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q and a length of at least ``repeats`` * q (and ``shortest``) words that
cannot be extended to either side. Every factor of a power-of-two length gets a number, from the numbers of its two halves
(Karp, Miller and Rosenberg); a factor that occurs once is not looked at again. If a factor of length m recurs at i, i + q
and i + 2q within twice its length, its successor occurrences form an arithmetic progression that proposes q; neighbouring
proposals of the same q are one stretch, which is extended while words q apart agree. A run with at least four repeats
is proposed at the smallest power of two that is not below q: there its rotations differ, so the successor is q words ahead.
The same run comes from several lengths and is kept once.

The texts of a slice are handled together: words are numbered for each text apart, so nothing recurs across texts, and the
number of numpy steps follows the longest text's logarithm. A task holds one slice, a text is never split.

A null text has no words and no runs. Rows, repeated or without id, are handled one by one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .packs import numbered as distinct_numbers
from .texts import map_texts

#: Shortest run in words, and how often its period must fit.
SHORTEST, REPEATS = 6, 4

RUN = StructType([StructField(c, IntegerType()) for c in ("start", "length", "period")])


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in a row, each text with numbers of its own, and where each text begins (and the last ends)."""
    at, out = 0, []
    for words in texts:
        own: dict[bytes, int] = {}
        out.append(np.fromiter([own.setdefault(w, len(own)) for w in words], np.int64, len(words)) + at)
        at += len(own)
    first = np.concatenate(([0], np.cumsum([len(w) for w in texts], dtype=np.int64)))
    return np.concatenate(out) if out else np.zeros(0, np.int64), first


def runs(words: np.ndarray, shortest: int = SHORTEST, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of a row of word numbers, by start and period. ``repeats`` is 4 at least."""
    if repeats < 4:
        raise ValueError("runs of fewer than four repeats are not proposed at every period")
    n = len(words)
    found: list[np.ndarray] = []
    # Places of factors that occur more than once, ascending, and their numbers.
    at, name, length = np.arange(n), words, 1
    while len(at):
        order = np.argsort(name, kind="stable")
        place, ordered = at[order], name[order]
        same = ordered[1:] == ordered[:-1]
        ahead = np.zeros(n, np.int64)
        gap = np.diff(place)
        near = same & (gap <= length)
        ahead[place[:-1][near]] = gap[near]
        found.append(_proposed(ahead, length))
        several = np.concatenate((same, [False])) | np.concatenate(([False], same))
        at, name, length = _doubled(place[several], ordered[several], n, length)
    starts, stops, periods = np.unique(np.concatenate([_extended(words, f) for f in found] or [np.zeros((0, 3), np.int64)]), axis=0)[:, [0, 1, 2]].T
    long = stops - starts >= np.maximum(shortest, repeats * periods)
    starts, stops, periods = starts[long], stops[long], periods[long]
    order = np.lexsort((periods, starts))
    return starts[order], (stops - starts)[order], periods[order]


def _proposed(ahead: np.ndarray, length: int) -> np.ndarray:
    """(start, stop, period) of the stretches whose factors recur at one distance, three times in progression at least."""
    change = np.flatnonzero(np.diff(ahead, prepend=-1))
    last = np.append(change[1:], len(ahead)) - 1
    q = ahead[change]
    good = (q > 0) & (last - change >= q)
    return np.stack((change[good], last[good] + length + q[good], q[good]), axis=1)


def _extended(words: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The stretches, extended to both sides as long as words one period apart agree."""
    start, stop, q = found.T.copy()
    n = len(words)
    moving = np.arange(len(q))
    while len(moving):
        a, d = start[moving], q[moving]
        moving = moving[(a > 0) & (words[np.maximum(a - 1, 0)] == words[np.maximum(a - 1, 0) + d])]
        start[moving] -= 1
    moving = np.arange(len(q))
    while len(moving):
        z, d = stop[moving], q[moving]
        moving = moving[(z < n) & (words[np.minimum(z, n - 1)] == words[np.minimum(z, n - 1) - d])]
        stop[moving] += 1
    return np.stack((start, stop, q), axis=1)


def _doubled(place: np.ndarray, name: np.ndarray, n: int, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The factors of twice the length: places whose two halves both recur, with a number for each pair of halves."""
    number = np.full(n + length, -1, np.int64)
    number[place] = name
    at = np.sort(place)
    second = number[at + length]
    at, second = at[second >= 0], second[second >= 0]
    _, name = distinct_numbers(number[at] * (n + 1) + second)
    return at, name, 2 * length


def _slice(texts: list[str | None], shortest: int, repeats: int) -> list[tuple[list[bytes], np.ndarray]]:
    """Words and runs (rows of start, length, period) of each text."""
    split = [(t or "").encode().split() for t in texts]
    words, first = numbered(split)
    start, length, period = runs(words, shortest, repeats)
    edges = np.searchsorted(start, first)
    rows = np.stack((start, length, period), axis=1)
    return [(w, rows[a:z] - [f, 0, 0]) for w, a, z, f in zip(split, edges[:-1], edges[1:], first)]


def collapsed(words: list[bytes], found: np.ndarray) -> bytes:
    """The text with each run cut down to its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 0] + found[:, 1], -1)
    keep = np.cumsum(gone)[:-1] == 0
    return b" ".join([w for w, k in zip(words, keep.tolist()) if k])


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None, shortest: int = SHORTEST, repeats: int = REPEATS) -> DataFrame:
    """Adds ``n_words``, ``runs`` (array of start, length, period in words, by start and period) and ``collapsed`` (the text without repeats)."""

    def make() -> Callable:
        def run(texts: list[str | None]) -> list[pa.Array]:
            found = _slice(texts, shortest, repeats)
            offsets = np.concatenate(([0], np.cumsum([len(r) for _, r in found])))
            flat = np.concatenate([r for _, r in found]).astype(np.int32)
            entries = pa.StructArray.from_arrays([pa.array(c) for c in flat.T.copy()], names=RUN.names)
            return [
                pa.array([len(w) for w, _ in found], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), entries),
                pa.array([collapsed(w, r).decode() for w, r in found], pa.string()),
            ]

        return run

    return map_texts(docs, text, keep if keep is not None else docs.columns, [("n_words", LongType()), ("runs", ArrayType(RUN)), ("collapsed", StringType())], make)


def strongest(runs_: Column) -> Column:
    """The run with the greatest length / period, of equal ones that of the smallest start and then period; null without runs. Compared exactly."""

    def better(best: Column, x: Column) -> Column:
        return F.when(best.isNull() | (x["length"].cast("long") * best["period"] > best["length"].cast("long") * x["period"]), x).otherwise(best)

    return F.aggregate(runs_, F.lit(None).cast(RUN), better)


def listed(runs_: Column) -> Column:
    """``start,length,period`` and a line feed for each run."""
    return F.concat_ws("", F.transform(runs_, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))


def echoed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) with the repeats of the contract: in one of ten texts, by crc32 of the id, words from ``a`` on repeat the first ``p`` of them."""
    h = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    a = F.pmod("g", F.size("w"))
    p = F.floor((F.size("w") - F.col("a")) / (3 + F.col("g") % 8)) + 1
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), h.alias("h"))
    chosen = (F.col("h") % 10 == 0) & F.col("text").isNotNull()
    rows = rows.withColumn("w", F.when(chosen, F.filter(words, lambda x: x != ""))).withColumn("g", g)
    rows = rows.withColumn("a", F.when(n > 0, a)).withColumn("p", p)
    spoken = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(spoken, " ")).otherwise(F.col("text")).alias("text"))


#: The unsigned CRC-32 of the decimal document number, bit by bit (fixed: the polynomial).
CRC_SQL = """case when doc_id is not null then xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(cast(doc_id as varchar), ''), lambda x: ascii(x)::bigint)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) end"""


def checking_sql(levels: int = 16) -> str:
    """The same in DuckDB: factors numbered by doubling, and islands of places whose successor is one distance ahead.

    Runs of periods up to 2^(levels - 1) words are found; a run of four repeats needs a text of four times that.
    """
    steps, found = [], []
    for k in range(levels):
        m = 1 << k
        if k:
            steps.append(f"l{k} as materialized (select a.id, a.i, hash(a.h, b.h) as h from l{k - 1} a join l{k - 1} b on b.id = a.id and b.i = a.i + {m // 2} where a.many and b.many)")
            steps[-1] = steps[-1].replace("as h from", "as h0 from").replace("(select a.id", "(select id, i, h0 as h, count(*) over (partition by id, h0) > 1 as many from (select a.id") + ")"
        found.append(f"select id, i, d, {m} as m from (select id, i, lead(i) over (partition by id, h order by i) - i as d from l{k} where many) where d <= {m} and 2 * d > {m}")
    return f"""
with r as (select row_number() over () as id, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w, {CRC_SQL} as h from documents),
     g as (select *, len(w) as n, h // 10 as g from r),
     a as (select *, case when h % 10 = 0 and n > 0 then g % n end as a, case when n > 0 then 1 + (n - g % n) // (3 + g % 8) end as p from g),
     t as materialized (select id, word, i - 1 as i from (select id, unnest(w) as word, generate_subscripts(w, 1) as i from a where a is null)
           union all select id, list_extract(w, cast(case when i < a then i else a + (i - a) % p end + 1 as bigint)), i from (select *, unnest(range(n)) as i from a where a is not null)),
     l0 as materialized (select id, i, hash(word) as h, count(*) over (partition by id, hash(word)) > 1 as many from t),
     {", ".join(steps)},
     f as ({" union all ".join(found)}),
     e as (select id, d, m, i - row_number() over (partition by id, m, d order by i) as island, i from f),
     runs as materialized (select distinct id, s, l, q from (select id, min(i) as s, max(i) - min(i) + m + d as l, d as q from e group by id, m, d, island) where l >= greatest(6, 4 * q)),
     best as (select id, count(*) as n_runs, arg_min(struct_pack(s := s, l := l, q := q), (-(l / q), s, q)) as b,
                     sha256(string_agg(s || ',' || l || ',' || q || chr(10), '' order by s, q)) as d from runs group by id),
     gone as (select distinct id, unnest(range(s + q, s + l)) as i from runs),
     kept as (select t.id, string_agg(word, ' ' order by t.i) as k from t anti join gone on gone.id = t.id and gone.i = t.i group by t.id)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, (b.s)::bigint as start, (b.l)::bigint as length, (b.q)::bigint as period, (1000 * b.l // b.q)::bigint as exponent_milli,
       coalesce(d, sha256('')) as runs_sha256, sha256(coalesce(k, '')) as collapsed_sha256
from r left join best on best.id = r.id left join kept on kept.id = r.id"""
