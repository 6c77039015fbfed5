"""A hierarchical Pitman-Yor language model of word pairs, trained and applied as Spark jobs.

Every context (the word before; the start of a text is one too) is a restaurant whose customers are the words that follow it. A
table's first customer is also a customer of the shared parent, the restaurant without context, whose own tables come from a uniform
choice among the known words and one unknown word. The seating is sampled by Gibbs: a customer leaves its table, then joins a
table of its dish with weight size - d or opens one with weight (theta + d * tables) * P_parent(word). The predictive probability

    P(w | u) = (c_uw - d * t_uw) / (theta + c_u) + (theta + d * t_u) / (theta + c_u) * P_parent(w)

is averaged over the seatings of ``ROUNDS`` rounds, and the score of a text is the sum of its log10.

How it is spread: texts are tokenised once, into blocks of some million tokens. A block asks for its distinct words and word pairs,
not for its tokens. Words and pairs are dealt over ranges by hash, so a frequent word or context is one entry of a block like any
other, and no restaurant ever sits in one task: a range seats its own pairs (cells), and the counts of tables of contexts and words
travel between ranges once a round, as in other synchronous distributed samplers. A cell of one customer has one table, so only
cells with more are sampled. In a round every cell has ``SWEEPS`` passes. A cell of ``EXACT``
customers at most draws its number of tables anew from its whole distribution, summed over all seatings with that many tables (generalised Stirling
numbers), so all its customers are reseated at once. A larger cell reseats ``SCAN`` customers drawn at random and has ``REGROUP`` moves of whole tables:
two customers are drawn, their table is split or their tables are merged, and the move is accepted by its exact Metropolis-Hastings ratio.
That reaches all its customers, however many there are, and leaves the same stationary seating.

Discounts follow from the numbers of pairs and words seen once and twice (n1 / (n1 + 2 n2)), the strength is ``THETA``.
A null or empty text is its end token alone. Rows, repeated or without id, are scored one by one; without training rows
every word is unknown and each token has probability 1. Word pairs are 64-bit keys made of two word numbers, so up to 2^32 distinct words
are possible; more raise an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..session import cut_lineage
from .anchors import MIX, mixed
from .packs import by_range, distinct, numbered, pack, ranges_for, steps, tasks_for, unpack, word_arrays, words_of_arrays
from .texts import free_name, release, slices

#: Tokens after which a block is closed, rounds of the sampler, passes in a round, strength.
BLOCK_TOKENS, ROUNDS, SWEEPS, THETA = 2_000_000, 3, 1, 1.0

#: Customers of a cell whose number of tables is drawn as a whole; customers and moves of tables in a pass of larger cells.
EXACT, SCAN, REGROUP = 512, 6, 64

#: Words that no text has, as these hold a space: end and start of a text, with their numbers in a block.
RESERVED = (b" end", b" start")
END, START = 0, 1

#: Numbers of a matrix of tables that is handled at once.
MATRIX = 1 << 20


# Blocks of texts


class _Block:
    """Texts of one task: kept columns, token numbers, and the distinct words with their training counts."""

    def __init__(self):
        self.number: dict[bytes, int] = {w: i for i, w in enumerate(RESERVED)}
        self.ids: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.train: list[bool] = []
        self.kept: list[pa.RecordBatch] = []
        self.tokens = 0

    def add(self, texts: list[str | None], train: list[bool], kept: pa.RecordBatch) -> None:
        number = self.number
        for t in texts:
            words = (t or "").encode().lower().split()
            ids = np.fromiter([number.setdefault(w, len(number)) for w in words] + [END], np.int32, len(words) + 1)
            self.ids.append(ids)
            self.lengths.append(len(ids))
            self.tokens += len(ids)
        self.train += train
        self.kept.append(kept)

    def row(self, block: int, ranges: int) -> dict:
        ids, lengths, train = np.concatenate(self.ids), np.array(self.lengths), np.array(self.train, bool)
        words = list(self.number)
        kinds = pa.array(words, pa.binary())
        place = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) % np.uint64(ranges)
        counts = np.bincount(ids, np.repeat(train, lengths), minlength=len(words)).astype(np.int64)
        parts = [{"range": r, "words": pack(*word_arrays(kinds.take(pa.array(at))), counts[at])} for r, at in by_range(place.astype(np.int64), ranges)]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.kept[0].schema) as w:
            for b in self.kept:
                w.write_batch(b)
        return {"block": block, "kept": sink.getvalue().to_pybytes(), "tokens": pack(ids, lengths, train, place.astype(np.int64)), "parts": parts}


BLOCKS = "block long, kept binary, tokens binary, parts array<struct<range: int, words: binary>>"
BLOCKS_ARROW = pa.schema({"block": pa.int64(), "kept": pa.binary(), "tokens": pa.binary(), "parts": pa.list_(pa.struct([("range", pa.int32()), ("words", pa.binary())]))})


def blocks(docs: DataFrame, train: Column, text: str, keep: list[str], ranges: int) -> DataFrame:
    flag, words = free_name(docs, "train_row"), free_name(docs, "text_of_row")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(train, F.lit(False)).alias(flag), F.col(f"`{text}`").cast("string").alias(words))
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, block = TaskContext.get().partitionId() << 32, 0, _Block()
        for batch in batches:
            for start, texts in slices(batch.column(n_keep + 1)):
                flags = batch.column(n_keep).slice(start, len(texts)).to_pylist()
                # Copied, as a slice would keep the whole batch with its texts.
                own = pa.array(np.arange(start, start + len(texts)))
                block.add(texts, flags, batch.select(range(n_keep)).take(own))
                if block.tokens >= BLOCK_TOKENS:
                    yield pa.RecordBatch.from_pylist([block.row(base + made, ranges)], BLOCKS_ARROW)
                    made, block = made + 1, _Block()
        if block.lengths:
            yield pa.RecordBatch.from_pylist([block.row(base + made, ranges)], BLOCKS_ARROW)
        release()

    return rows.mapInArrow(run, BLOCKS)


def word_table(stored: DataFrame, ranges: int) -> DataFrame:
    """A row for each block and range with the numbers and counts of the block's words, and one of each range with all its counts."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        r = key[0].as_py()
        asked = [unpack(x) for x in rows["words"].to_pylist()]
        coded = pa.concat_arrays([words_of_arrays(lengths, data) for lengths, data, _ in asked]).dictionary_encode()
        found = coded.dictionary
        rank = np.empty(len(found), np.int64)
        rank[pc.array_sort_indices(found).to_numpy()] = np.arange(len(found))
        if len(found) * ranges >= 1 << 32:
            raise ValueError("more than 2^32 distinct words")
        own = rank[coded.indices.to_numpy()]
        n = np.concatenate([x for _, _, x in asked])
        total = np.zeros(len(found), np.int64)
        np.add.at(total, own, n)
        edges = np.cumsum([0, *(len(x) for _, _, x in asked)])
        out = [(b, r, pack(own[x:y] * ranges + r, total[own[x:y]]), None, None) for b, x, y in zip(rows["block"].to_pylist(), edges[:-1], edges[1:])]
        out.append((None, r, pack(total), int((total > 0).sum()), int(total.sum())))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()))], names=["block", "range", "words", "distinct", "tokens"])

    parts = stored.select("block", F.explode("parts").alias("p")).select("block", "p.*")
    return parts.repartition(tasks_for(ranges), "range").groupBy("range").applyInArrow(run, "block long, range int, words binary, distinct long, tokens long")


class _Pairs:
    """The distinct word pairs of a block, dealt over the ranges, and where each token's pair is among them."""

    def __init__(self, tokens: bytes, answers: Iterator[tuple[int, bytes]], ranges: int):
        self.ids, self.lengths, self.train, self.place = unpack(tokens)
        self.members = dict(by_range(self.place, ranges))
        self.number = np.empty(len(self.place), np.int64)
        self.count = np.empty(len(self.place), np.int64)
        for r, blob in answers:
            self.number[self.members[r]], self.count[self.members[r]] = unpack(blob)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.before = np.empty_like(self.ids)
        self.before[1:] = self.ids[:-1]
        self.before[self.first] = START
        number = self.number.astype(np.uint64)
        self.keys, self.pair = numbered((number[self.before] << np.uint64(32)) | number[self.ids])

    def ranges(self, ranges: int) -> list[tuple[int, np.ndarray]]:
        return list(by_range(cell_range(self.keys, ranges), ranges))


def cell_range(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (mixed(keys * MIX[0]) % np.uint64(ranges)).astype(np.int64)


def pair_parts(stored: DataFrame, words: DataFrame, ranges: int) -> DataFrame:
    """A row for each block and range: the block's pairs of that range, with their training counts."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left):
            p = _Pairs(left["tokens"][0].as_py(), zip(right["range"].to_pylist(), right["words"].to_pylist()), ranges)
            n = np.bincount(p.pair, np.repeat(p.train, p.lengths), minlength=len(p.keys)).astype(np.int64)
            block = left["block"][0].as_py()
            out = [(block, r, pack(steps(p.keys[at]), n[at])) for r, at in p.ranges(ranges)]
        columns = list(zip(*out)) or [[], [], []]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary()))], names=["block", "range", "pairs"])

    answers = words.where("block is not null").select("block", "range", "words")
    return together(stored.select("block", "tokens"), answers, "block", "block", ranges).applyInArrow(run, "block long, range int, pairs binary")


def cell_table(parts: DataFrame, ranges: int) -> DataFrame:
    """A row for each range. A cell is a pair of the training texts; ``cells`` holds those of several customers, by key, and their counts.

    ``asks`` tells each block of its pairs whether they are no cell, a cell of one customer or which of ``cells``. ``totals`` and ``reports``
    go to the ranges of words: what the range's cells add to the words' counts, and the words of ``cells``.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        asked = [unpack(x) for x in rows["pairs"].to_pylist()]
        sizes = [len(k) for k, _ in asked]
        keys, at = numbered(np.concatenate([np.cumsum(k.astype(np.uint64), dtype=np.uint64) for k, _ in asked]))
        c = np.bincount(at, np.concatenate([n for _, n in asked]), minlength=len(keys)).astype(np.int64)
        several = c > 1
        kind, place = np.minimum(c, 2), np.cumsum(several) - 1
        edges = np.cumsum([0, *sizes])
        asks = []
        for b, x, y in zip(rows["block"].to_pylist(), edges[:-1], edges[1:]):
            own = kind[at[x:y]]
            asks.append({"block": b, "pairs": pack(own, place[at[x:y][own == 2]])})
        u, w = words_of(keys[c > 0])
        one, zero = np.ones(len(u), np.int64), np.zeros(len(u), np.int64)
        ids, *sums = _sums(np.concatenate((u, w)), np.concatenate((c[c > 0], zero)), np.concatenate((one, zero)), np.concatenate((zero, one)))
        totals = [{"range": r, "totals": pack(steps(ids[m]), *[x[m] for x in sums])} for r, m in by_range(ids % ranges, ranges)]
        row = {"range": key[0].as_py(), "cells": pack(steps(keys[several]), c[several]), "asks": asks, "totals": totals}
        row |= {"reports": _reports(keys[several], zero[:0], ranges), "once": int((c == 1).sum()), "twice": int((c == 2).sum())}
        return pa.Table.from_pylist([row], CELLS_ARROW)

    return parts.repartition(tasks_for(ranges), "range").groupBy("range").applyInArrow(run, CELLS)


def _list_of(**fields: pa.DataType) -> pa.DataType:
    return pa.list_(pa.struct(list(fields.items())))


REPORT = "array<struct<range: int, more: binary>>"
CELLS = f"range int, cells binary, asks array<struct<block: long, pairs: binary>>, totals array<struct<range: int, totals: binary>>, reports {REPORT}, once long, twice long"
REPORT_ARROW = _list_of(range=pa.int32(), more=pa.binary())
CELLS_ARROW = pa.schema(
    {
        "range": pa.int32(),
        "cells": pa.binary(),
        "asks": _list_of(block=pa.int64(), pairs=pa.binary()),
        "totals": _list_of(range=pa.int32(), totals=pa.binary()),
        "reports": REPORT_ARROW,
        "once": pa.int64(),
        "twice": pa.int64(),
    }
)


def _reports(keys: np.ndarray, more: np.ndarray, ranges: int) -> list[dict]:
    """For each range of words: the words of some cells, with the tables beyond the first of their restaurants and their dishes."""
    u, w = words_of(keys)
    more, zero = more if len(more) else np.zeros(len(u), np.int64), np.zeros(len(u), np.int64)
    ids, as_context, as_word = _sums(np.concatenate((u, w)), np.concatenate((more, zero)), np.concatenate((zero, more)))
    return [{"range": r, "more": pack(steps(ids[at]), as_context[at], as_word[at])} for r, at in by_range(ids % ranges, ranges)]


def cells_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    k, c = unpack(blob)
    return np.cumsum(k.astype(np.uint64), dtype=np.uint64), c


def words_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the context and of the word of each pair."""
    return (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


# Seating


@lru_cache(2)
def _stirling(d: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: of c customers at t tables, the sum over all seatings."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(1, EXACT + 1)
    for n in range(EXACT):
        with np.errstate(divide="ignore"):
            out[n + 1, 1:] = np.logaddexp(out[n, :-1], np.log(np.maximum(0, n - d * t)) + out[n, 1:])
    return out


def drawn_tables(c: np.ndarray, weight: np.ndarray, growth: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Numbers of tables of cells of ``EXACT`` customers at most, from their distribution; a table opens with ``weight``, and ``growth`` more for each of the cell."""
    out, power = np.ones(len(c), np.int64), np.ceil(np.log2(np.maximum(c, 1))).astype(np.int64)
    for e in np.flatnonzero(np.bincount(power, minlength=1)[1:]) + 1:
        members, k = np.flatnonzero(power == e), min(1 << int(e), EXACT)
        for at in range(0, len(members), max(1, MATRIX // k)):
            cells = members[at : at + max(1, MATRIX // k)]
            log = np.log(np.maximum(weight[cells, None] + growth[cells, None] * np.arange(k), 1e-300)).cumsum(axis=1)
            log += _stirling(d)[c[cells], 1 : k + 1]
            upto = np.exp(log - log.max(axis=1, keepdims=True)).cumsum(axis=1)
            out[cells] = 1 + (upto <= (rng.random(len(cells)) * upto[:, -1])[:, None]).sum(axis=1)
    return out


def first_tables(c: np.ndarray, weight: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """A number of tables to begin with for cells of ``c`` customers that open a table with ``weight``: ``EXACT`` are drawn, later arrivals jump to the next opening."""
    arrived = np.minimum(c, EXACT).astype(float)
    t = drawn_tables(np.minimum(c, EXACT), weight, np.zeros(len(c)), d, rng)
    open_ = np.flatnonzero(c > EXACT)
    while len(open_):
        busy = arrived[open_] - d * t[open_]
        with np.errstate(over="ignore", divide="ignore"):
            nxt = d * t[open_] + busy * rng.random(len(open_)) ** (-1 / np.maximum(weight[open_], 1e-300))
        go = np.maximum(nxt, arrived[open_] + 1) <= c[open_]
        open_, nxt = open_[go], nxt[go]
        arrived[open_] = np.maximum(np.ceil(nxt), arrived[open_] + 1)
        t[open_] += 1
    return t


class Seats:
    """Table sizes of many cells, as lists in one array."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray):
        self.n, self.sizes = n, sizes

    @classmethod
    def start(cls, c: np.ndarray, weight: np.ndarray, d: float, rng: np.random.Generator) -> Seats:
        t = first_tables(c, weight, d, rng)
        seats, large = cls._sized(c, t), c > EXACT
        # Given their number, the tables of a large cell are about one that holds most customers and others with sizes of Sibuya's law.
        first = np.cumsum(t) - t
        other = np.repeat(large, t)
        other[first] = False
        owner = np.repeat(np.arange(len(c)), t)[other]
        with np.errstate(over="ignore", divide="ignore"):
            size = np.floor((rng.random(len(owner)) * math.gamma(1 - d)) ** (-1 / d))
        seats.sizes[other] = np.clip(size, 1, (c // t)[owner])
        seats.sizes[first] = c - np.bincount(owner, seats.sizes[other] - 1, minlength=len(c)).astype(np.int64) - (t - 1)
        return seats

    @classmethod
    def _sized(cls, c: np.ndarray, t: np.ndarray) -> Seats:
        """Cells at ``t`` tables, all but the first with one customer: the sizes matter to the moves of large cells only."""
        sizes = np.ones(int(t.sum()), np.int64)
        sizes[np.cumsum(t) - t] = c - t + 1
        return cls(t, sizes)

    def reseat(self, c: np.ndarray, prior: np.ndarray, tables: np.ndarray, theta: float, d: float, rng: np.random.Generator) -> Seats:
        """One pass: customers leave and sit down again. ``prior`` is the parent's probability of the cell's word, ``tables`` the tables of its restaurant."""
        small, large = np.flatnonzero(c <= EXACT), np.flatnonzero(c > EXACT)
        weight = (theta + d * (tables - self.n)) * prior
        drawn = Seats._sized(c[small], drawn_tables(c[small], weight[small], d * prior[small], d, rng))
        if not len(large):
            return drawn
        offset = np.cumsum(self.n) - self.n
        power = np.ceil(np.log2(self.n + SCAN + REGROUP)).astype(np.int64)
        n, sizes, order = [drawn.n], [drawn.sizes], [small]
        for e in distinct(power[large]).tolist():
            members, k = large[power[large] == e], 1 << e
            for at in range(0, len(members), max(1, MATRIX // k)):
                cells = members[at : at + max(1, MATRIX // k)]
                m = np.zeros((len(cells), k), np.int64)
                own = self.n[cells]
                used = np.arange(k) < own[:, None]
                m[used] = self.sizes[np.repeat(offset[cells] - (np.cumsum(own) - own), own) + np.arange(own.sum())]
                for _ in range(SCAN):
                    _move(m, c[cells], prior[cells], tables[cells] - own, theta, d, rng)
                for _ in range(REGROUP):
                    _regroup(m, c[cells], prior[cells], tables[cells] - own, theta, d, rng)
                n.append((m > 0).sum(axis=1))
                sizes.append(m[m > 0])
                order.append(cells)
        cells, n, sizes = np.concatenate(order), np.concatenate(n), np.concatenate(sizes)
        back = np.argsort(cells)
        start = (np.cumsum(n) - n)[back]
        n = n[back]
        return Seats(n, sizes[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())])


def _move(m: np.ndarray, c: np.ndarray, prior: np.ndarray, others: np.ndarray, theta: float, d: float, rng: np.random.Generator) -> None:
    """One customer of each row of table sizes leaves and sits down again, in place; ``others`` are the tables of other cells of the restaurant."""
    rows = np.arange(len(m))
    leaves = (np.cumsum(m, axis=1) <= (rng.random(len(m)) * c).astype(np.int64)[:, None]).sum(axis=1)
    m[rows, leaves] -= 1
    taken = np.cumsum(np.where(m > 0, m - d, 0.0), axis=1)
    new = (theta + d * (others + (m > 0).sum(axis=1))) * prior
    draw = rng.random(len(m)) * (taken[:, -1] + new)
    joins = (taken <= draw[:, None]).sum(axis=1)
    fresh = joins >= m.shape[1]
    joins[fresh] = np.argmin(m[fresh], axis=1)
    m[rows, joins] += 1


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by Stirling's series eight places further on."""
    y, below = x + 8, np.ones_like(x)
    for i in range(8):
        below = below * (x + i)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(below)


def _regroup(m: np.ndarray, c: np.ndarray, prior: np.ndarray, others: np.ndarray, theta: float, d: float, rng: np.random.Generator) -> None:
    """Two customers of each row of table sizes are drawn: their table is split between them, or their two tables merged, in place.

    In a split the other customers of the table choose by an urn, each table with weight size - d. The ratio of the seatings' probabilities
    to those of the proposals then depends on the number of customers alone.
    """
    rows = np.arange(len(m))
    x, y = (rng.random(len(m)) * c).astype(np.int64), (rng.random(len(m)) * (c - 1)).astype(np.int64)
    upto = np.cumsum(m, axis=1)
    a, b = ((upto <= k[:, None]).sum(axis=1) for k in (x, y + (y >= x)))
    split = a == b
    n = m[rows, a] + np.where(split, 0, m[rows, b])
    new = (theta + d * (others + (m > 0).sum(axis=1) - ~split)) * prior
    constant = _log_gamma(np.array([1 - d, 2 - 2 * d]))
    gain = np.log(new) + _log_gamma(n - 2 * d) - _log_gamma(n - d) + constant[0] - constant[1]
    taken = np.log(1 - rng.random(len(m))) < np.where(split, gain, -gain)
    r = np.flatnonzero(taken & ~split)
    m[r, a[r]], m[r, b[r]] = n[r], 0
    r = np.flatnonzero(taken & split)
    apart = 1 + rng.binomial(n[r] - 2, rng.beta(1 - d, 1 - d, len(r)))
    free = np.argmin(m[r], axis=1)
    m[r, a[r]], m[r, free] = n[r] - apart, apart


def together(left: DataFrame, right: DataFrame, left_key: str, right_key: str, ranges: int) -> PandasCogroupedOps:
    """Both frames dealt over the same tasks."""
    tasks = tasks_for(ranges)
    return left.repartition(tasks, left_key).groupBy(left_key).cogroup(right.repartition(tasks, right_key).groupBy(right_key))


# Exchange between the ranges of cells and the ranges of words


def _sums(words: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    ids, at = numbered(words)
    return ids, *[np.bincount(at, v, minlength=len(ids)).astype(np.int64) for v in values]


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(schema), schema.types)], names=schema.names)


def word_totals(cells: DataFrame, ranges: int) -> DataFrame:
    """For each range of words: customers and kinds of customers of each word's restaurant, and the number of contexts that have the word."""

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in rows["totals"].to_pylist()]
        ids = np.concatenate([np.cumsum(p[0]) for p in parts])
        ids, *sums = _sums(ids, *[np.concatenate([p[k] for p in parts]) for k in (1, 2, 3)])
        contexts = sums[2]
        row = (key[0].as_py(), pack(steps(ids), *sums), int((contexts == 1).sum()), int((contexts == 2).sum()), int(contexts.sum()), int((contexts > 0).sum()))
        return pa.Table.from_batches([_rows(BASE, [row])])

    sent = cells.select(F.inline("totals"))
    return sent.repartition(tasks_for(ranges), "range").groupBy("range").applyInArrow(add, "range int, totals binary, once long, twice long, customers long, tables long")


BASE = pa.schema([("range", pa.int32()), ("totals", pa.binary()), *[(c, pa.int64()) for c in ("once", "twice", "customers", "tables")]])

STATE = pa.schema([("range", pa.int32()), ("src", pa.int32()), ("answer", pa.binary()), ("customers", pa.int64()), ("tables", pa.int64())])


def parent_state(base: DataFrame, sent: DataFrame, ranges: int, known: int, tables: int, d: float, seed: int) -> DataFrame:
    """Seats the parent restaurant, word by word, and answers the ranges of cells. Rows without ``src`` hold a range's whole state.

    A word's customers there are the tables of its cells. ``tables``: of the whole parent, as known before.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.Table.from_batches([_rows(STATE, [])])
        r = left["range"][0].as_py()
        k, customers, t, c0 = unpack(left["totals"][0].as_py())
        ids = np.cumsum(k)
        asked = []
        for blob in right["more"].to_pylist():
            k, as_context, as_word = unpack(blob)
            at = np.searchsorted(ids, np.cumsum(k))
            t[at] += as_context
            c0[at] += as_word
            asked.append(at)
        rng = np.random.default_rng([seed, r])
        some = np.flatnonzero(c0)
        c, prior, all_ = c0[some], np.full(len(some), 1 / (known + 1)), np.full(len(some), tables)
        seats = Seats.start(c, (THETA + d * tables) * prior, d, rng)
        for _ in range(SWEEPS):
            before = seats.n
            seats = seats.reseat(c, prior, all_, THETA, d, rng)
            all_ = all_ + (seats.n.sum() - before.sum())
        t0 = np.zeros(len(ids), np.int64)
        t0[some] = seats.n
        out = [(r, src, pack(customers[at], t[at], c0[at], t0[at]), None, None) for src, at in zip(right["src"].to_pylist(), asked)]
        out.append((r, None, pack(steps(ids), customers, t, c0, t0), int(c0.sum()), int(t0.sum())))
        return pa.Table.from_batches([_rows(STATE, out)])

    return together(base.select("range", "totals"), sent, "range", "range", ranges).applyInArrow(run, "range int, src int, answer binary, customers long, tables long")


def parent_probability(c0: np.ndarray, t0: np.ndarray, customers: int, tables: int, known: int, d: float) -> np.ndarray:
    """Of words with ``c0`` customers at ``t0`` tables of the parent, which has ``customers`` and ``tables`` in all."""
    return (c0 - d * t0 + (THETA + d * tables) / (known + 1)) / (THETA + customers)


SEATING = pa.schema({"range": pa.int32(), "seats": pa.binary(), "sum": pa.binary(), "reports": REPORT_ARROW})


def next_seating(cells: DataFrame, seating: DataFrame | None, answers: DataFrame, ranges: int, totals: tuple[int, int], known: int, d: tuple[float, float], seed: int) -> DataFrame:
    """A round of the sampler: every cell is reseated given the tables of its context and the parent's probability of its word.

    The first round has no seating yet. ``sum`` adds up the tables of each cell over the rounds.
    """
    right = answers.withColumn("sum", F.lit(None).cast("binary"))
    if seating is not None:
        right = right.unionByName(seating.select(F.col("range").alias("src"), F.lit(-1).alias("range"), F.col("seats").alias("answer"), "sum"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.Table.from_pylist([], SEATING)
        src = left["range"][0].as_py()
        keys, c = cells_of(left["cells"][0].as_py())
        u, w = words_of(keys)
        ids = distinct(np.concatenate((u, w)))
        members = dict(by_range(ids % ranges, ranges))
        tables, c0, t0 = (np.zeros(len(ids), np.int64) for _ in range(3))
        seats, total = None, np.zeros(len(c), np.int64)
        for r, answer, before in zip(right["range"].to_pylist(), right["answer"].to_pylist(), right["sum"].to_pylist()):
            if r < 0:
                seats, total = Seats(*unpack(answer)), unpack(before)[0]
            else:
                _, tables[members[r]], c0[members[r]], t0[members[r]] = unpack(answer)
        u, w = np.searchsorted(ids, u), np.searchsorted(ids, w)
        prior = parent_probability(c0, t0, *totals, known, d[0])[w]
        rng = np.random.default_rng([seed, src])
        if seats is None:
            seats = Seats.start(c, (THETA + d[1] * tables[u]) * prior, d[1], rng)
            np.add.at(tables, u, seats.n - 1)
        for _ in range(SWEEPS):
            before = seats.n
            seats = seats.reseat(c, prior, tables[u], THETA, d[1], rng)
            np.add.at(tables, u, seats.n - before)
        total = total + seats.n
        row = {"range": src, "seats": pack(seats.n, seats.sizes), "sum": pack(total), "reports": _reports(keys, seats.n - 1, ranges)}
        return pa.Table.from_pylist([row], SEATING)

    return together(cells.select("range", "cells"), right, "range", "src", ranges).applyInArrow(run, f"range int, seats binary, sum binary, reports {REPORT}")


# Scores


def _discount(once: int | None, twice: int | None) -> float:
    once, twice = once or 0, twice or 0
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def score(docs: DataFrame, train: Column, text: str = "text", keep: list[str] | None = None, rounds: int = ROUNDS, seed: int = 1) -> DataFrame:
    """The kept columns with n_tokens, n_known, train_tokens, base_score (smoothed unigrams) and score (this model), as log10.

    The model learns from the rows where ``train`` is true; null counts as false. A result column replaces a kept one of its name.
    """
    outputs = [("n_tokens", LongType()), ("n_known", LongType()), ("train_tokens", LongType()), ("base_score", DoubleType()), ("score", DoubleType())]
    keep = [c for c in (keep if keep is not None else docs.columns) if c.lower() not in {n for n, _ in outputs}]
    schema = StructType([docs.schema[c] for c in keep] + [StructField(n, t) for n, t in outputs])
    ranges = ranges_for(docs, text)
    stored = cut_lineage(blocks(docs, train, text, keep, ranges))
    words = cut_lineage(word_table(stored, ranges))
    known, tokens = (int(x or 0) for x in words.agg(F.sum("distinct"), F.sum("tokens")).first())
    cells = cut_lineage(cell_table(pair_parts(stored, words, ranges), ranges))
    once, twice = cells.agg(F.sum("once"), F.sum("twice")).first()
    base = cut_lineage(word_totals(cells, ranges))
    w_once, w_twice, customers, tables = base.agg(*[F.sum(c) for c in ("once", "twice", "customers", "tables")]).first()
    d = (_discount(w_once, w_twice), _discount(once, twice))
    seating, samples, tables = None, [], int(tables or 0)
    for k in range(rounds + 1):
        sent = (cells if seating is None else seating).select(F.col("range").alias("src"), F.inline("reports"))
        state = cut_lineage(parent_state(base, sent, ranges, known, tables, d[0], seed + 100 * k))
        customers, tables = (int(x or 0) for x in state.agg(F.sum("customers"), F.sum("tables")).first())
        if k:
            samples.append((state.where("src is null").select("range", F.lit(k).alias("sample"), "answer"), (customers, tables)))
        if k < rounds:
            answers = state.where("src is not null").select("src", "range", "answer")
            seating = cut_lineage(next_seating(cells, seating, answers, ranges, (customers, tables), known, d, seed + 100 * k + 1))
    return _scored(stored, words, cells, seating, samples, ranges, known, tokens, d, schema)


FOUND = pa.schema([("block", pa.int64()), ("range", pa.int32()), ("of", pa.string()), ("found", pa.binary())])
FOUND_DDL = "block long, range int, of string, found binary"


def _word_answers(words: DataFrame, samples: list, ranges: int) -> DataFrame:
    """To each block, for its words of a range: customers, and by sample the tables, and the customers and tables in the parent, as whole numbers."""
    states = samples[0]
    for s in samples[1:]:
        states = states.unionByName(s)
    n = len(samples)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        r = left["range"][0].as_py() if len(left) else None
        found = {k: unpack(x) for k, x in zip(right["sample"].to_pylist(), right["answer"].to_pylist())}
        ids = np.cumsum(found[1][0]) if found else np.zeros(0, np.int64)
        out = []
        for block, blob in zip(left["block"].to_pylist(), left["words"].to_pylist()):
            number = unpack(blob)[0]
            at = np.minimum(np.searchsorted(ids, number), max(0, len(ids) - 1))
            known = np.flatnonzero(ids[at] == number) if len(ids) else np.zeros(0, np.int64)
            customers, by_sample = np.zeros(len(number), np.int64), np.zeros((3, n, len(number)), np.int64)
            if len(known):
                customers[known] = found[1][1][at[known]]
                for k in range(n):
                    by_sample[:, k, known] = [x[at[known]] for x in found[k + 1][2:]]
            out.append((block, r, "word", pack(customers, *[x.ravel() for x in by_sample])))
        return pa.Table.from_batches([_rows(FOUND, out)])

    asks = words.where("block is not null").select("block", "range", "words")
    return together(asks, states, "range", "range", ranges).applyInArrow(run, FOUND_DDL)


def _pair_answers(cells: DataFrame, seating: DataFrame, ranges: int, samples: int, d: float) -> DataFrame:
    """To each block, for its pairs of a range: the discounted customers of the cell, averaged over the samples; 0 without a cell."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left):
            over = cells_of(left["cells"][0].as_py())[1] - d * unpack(right["sum"][0].as_py())[0] / samples
            r = left["range"][0].as_py()
            for ask in left["asks"][0].as_py():
                kind, place = unpack(ask["pairs"])
                found = kind * (1 - d)
                found[kind == 2] = over[place]
                kinds, code = numbered(found)
                out.append((ask["block"], r, "pair", pack(kinds, code)))
        return pa.Table.from_batches([_rows(FOUND, out)])

    return together(cells.select("range", "cells", "asks"), seating.select("range", "sum"), "range", "range", ranges).applyInArrow(run, FOUND_DDL)


def _scored(stored: DataFrame, words: DataFrame, cells: DataFrame, seating: DataFrame, samples: list, ranges: int, known: int, tokens: int, d: tuple[float, float], schema: StructType) -> DataFrame:
    numbers = words.where("block is not null").select("block", "range", F.lit("number").alias("of"), F.col("words").alias("found"))
    found = numbers.unionByName(_word_answers(words, [s for s, _ in samples], ranges)).unionByName(_pair_answers(cells, seating, ranges, len(samples), d[1]))
    names = [f.name for f in schema.fields]
    totals, n = [t for _, t in samples], len(samples)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kept = pa.ipc.open_stream(left["kept"][0].as_py()).read_all()
        of = {"number": {}, "word": {}, "pair": {}}
        for kind, r, blob in zip(right["of"].to_pylist(), right["range"].to_pylist(), right["found"].to_pylist()):
            of[kind][r] = blob
        p = _Pairs(left["tokens"][0].as_py(), of["number"].items(), ranges)
        customers, by_sample = np.empty(len(p.number), np.int64), np.empty((3, n, len(p.number)), np.int64)
        for r, blob in of["word"].items():
            customers[p.members[r]], *rest = unpack(blob)
            by_sample[:, :, p.members[r]] = np.stack(rest).reshape(3, n, -1)
        share = 1 / (THETA + customers)
        rest = (THETA + d[1] * by_sample[0]) * share
        parent = np.stack([parent_probability(by_sample[1, k], by_sample[2, k], *totals[k], known, d[0]) for k in range(n)])
        over = np.empty(len(p.keys))
        for r, at in p.ranges(ranges):
            kinds, code = unpack(of["pair"][r])
            over[at] = kinds[code]
        # Each distinct pair once, by one of the tokens that have it.
        token = np.empty(len(p.keys), np.int64)
        token[p.pair] = np.arange(len(p.pair))
        u, w = p.before[token], p.ids[token]
        log = np.log10(over * share[u] + (rest[:, u] * parent[:, w]).mean(axis=0))
        base = np.log10((p.count + 0.5) / (tokens + 0.5 * (known + 1)))
        add = lambda x: np.add.reduceat(x, p.first)  # noqa: E731  every text has its end token
        values = [p.lengths, add((p.count > 0).astype(np.int64)[p.ids]), np.full(len(p.lengths), tokens), add(base[p.ids]), add(log[p.pair])]
        return pa.Table.from_arrays([*kept.columns, *map(pa.array, values)], names=names)

    return together(stored.select("block", "kept", "tokens"), found, "block", "block", ranges).applyInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text leaves 1 when divided by 5. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 5 == 1, F.lit(False))
