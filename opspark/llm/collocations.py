"""Phrase collocations by weighted acyclic automata.

A block of text counts its phrases of one to three words. The sorted phrases become a count transducer: an acyclic automaton whose
arcs carry a word and the count of the phrase that ends there. Sorted phrases complete one state after the other; a complete
state is looked up in a register and replaced by an equal one. Each block makes a transducer for every prefix range, an equal part of the hash of a phrase's first two words, so all phrases
with one beginning meet whatever the block, and a frequent word is spread over all ranges. The union of a range walks the
transducers of all blocks together and adds the weights. What is below the least count is pruned, since no part of a
candidate is rarer than the candidate itself. Counts of parts are then looked up by composing, in each range, the acceptor of
the parts that candidates ask for with the range's transducer.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words at spaces and tabs; phrases do not cross pieces. All
counts are per language; a null language is ``und``, a null text is empty. Repeated rows count as often as they occur. A cut of a phrase has
the score floor(10^6 a a / (l r)) from the counts of the phrase and its two parts, exact up to counts of 10^15; the lowest cut
counts, of equal ones the first. A candidate inside a longer one with at least ``nested`` per cent of its count is dropped. Equal scores are ordered by count and then by the phrase's bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .anchors import MIX, mixed
from .packs import by_range, distinct, joint, numbered, pack, ranges_for, tasks_for, unpack, word_arrays, words_of_arrays
from .texts import release, slices

#: Tokens after which a block is closed.
BLOCK_TOKENS = 1_200_000

#: Every byte that ends a piece becomes a full stop (which no word contains), a tab a space.
SEPARATORS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\t", b".........." + b" ")


class Transducer(NamedTuple):
    """Counts of phrases. ``words``: sorted symbols (language, line feed, word). Arrays of the root's arcs (word, count of the word, state), and of
    the arcs of two layers of states, where ``edges`` cuts the arcs of one state from the next."""

    words: pa.BinaryArray
    root: tuple[np.ndarray, np.ndarray, np.ndarray]
    second: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    third: tuple[np.ndarray, np.ndarray, np.ndarray]

    def blob(self) -> bytes:
        return pack(*word_arrays(self.words), *self.root, *self.second, *self.third)

    @classmethod
    def load(cls, blob: bytes) -> Transducer:
        lengths, data, *a = unpack(blob)
        return cls(words_of_arrays(lengths, data), tuple(a[:3]), tuple(a[3:7]), tuple(a[7:]))


def _taken(edges: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The arcs of a list of states, one state after the other: (place in the list, arc)."""
    n = edges[states + 1] - edges[states]
    at = np.repeat(np.arange(len(states)), n)
    return at, np.repeat(edges[states] - (np.cumsum(n) - n), n) + np.arange(n.sum())


def registered(edges: np.ndarray, *arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """Complete states, in order, through the register: (state of each, edges of the states kept, their arcs)."""
    n = np.diff(edges)
    out, kept = np.zeros(len(n), np.int64), []
    register: dict[bytes, int] = {}
    table = np.ascontiguousarray(np.stack(arcs, axis=1)) if len(arcs[0]) else np.zeros((0, len(arcs)), np.int64)
    # States of one arc are most; equal ones are found by sorting.
    single = np.flatnonzero(n == 1)
    if len(single):
        own = joint(*(a[edges[single]] for a in arcs))
        first = np.empty(own.max() + 1, np.int64)
        first[own[::-1]] = single[::-1]
        out[single], kept = own, first.tolist()
    for k in np.flatnonzero(n != 1).tolist():
        state = table[edges[k] : edges[k + 1]].tobytes()
        found = register.get(state)
        if found is None:
            register[state] = found = len(kept)
            kept.append(k)
        out[k] = found
    kept = np.array(kept, np.int64)
    _, at = _taken(edges, kept)
    return out, np.concatenate(([0], np.cumsum(n[kept]))), tuple(a[at] for a in arcs)


def build(words: pa.BinaryArray, one: tuple[np.ndarray, ...], two: tuple[np.ndarray, ...], three: tuple[np.ndarray, ...]) -> Transducer:
    """From sorted phrases: ``one`` (word, count), ``two`` (first, second, count), ``three`` (place in ``two``, third, count)."""
    edges = np.searchsorted(three[0], np.arange(len(two[0]) + 1))
    to, *third = registered(edges, three[1], three[2])
    at = np.flatnonzero(np.diff(two[0], prepend=-1))
    firsts = two[0][at]
    own, *second = registered(np.append(at, len(two[0])), two[1], two[2], to)
    root = distinct(np.concatenate((one[0], firsts)))
    count, state = np.zeros(len(root), np.int64), np.full(len(root), -1)
    count[np.searchsorted(root, one[0])] = one[1]
    state[np.searchsorted(root, firsts)] = own
    return Transducer(words, (root, count, state), (second[0], *second[1]), (third[0], *third[1]))


def paths(t: Transducer) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """The phrases of a transducer, as ``build`` takes them."""
    word, count, state = t.root
    has = state >= 0
    at, arc = _taken(t.second[0], state[has])
    first, second, n, to = word[has][at], t.second[1][arc], t.second[2][arc], t.second[3][arc]
    place, arc = _taken(t.third[0], to)
    return (word[count > 0], count[count > 0]), (first, second, n), (place, t.third[1][arc], t.third[2][arc])


def union(parts: list[bytes], least: int = 1) -> tuple[Transducer, dict[bytes, int]]:
    """The transducer with the added weights of all, without phrases below ``least``; and all words of each language."""
    loaded = [Transducer.load(b) for b in parts]
    coded = pa.concat_arrays([t.words for t in loaded]).dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    own, at = rank[coded.indices.to_numpy()], 0
    words, size = coded.dictionary.take(order), len(order)
    ones, twos, threes, before = [], [], [], 0
    for t in loaded:
        one, two, three = paths(t)
        number, at = own[at : at + len(t.words)], at + len(t.words)
        ones.append((number[one[0]], one[1]))
        twos.append((number[two[0]] * size + number[two[1]], two[2]))
        threes.append((three[0] + before, number[three[1]], three[2]))
        before += len(two[0])
    one = np.zeros(size, np.int64)
    for k, n in ones:
        np.add.at(one, k, n)
    pair, place = numbered(np.concatenate([k for k, _ in twos]))
    two = _added(place, np.concatenate([n for _, n in twos]), len(pair))
    key, of = numbered(place[np.concatenate([p for p, _, _ in threes])] * size + np.concatenate([w for _, w, _ in threes]))
    three = _added(of, np.concatenate([n for _, _, n in threes]), len(key))
    totals: dict[bytes, int] = {}
    counted_words = np.flatnonzero(one)
    for w, n in zip(words.take(counted_words).to_pylist(), one[counted_words].tolist()):
        lang = w.rpartition(b"\n")[0]
        totals[lang] = totals.get(lang, 0) + n
    often = np.flatnonzero(one >= least)
    keep2, keep3 = two >= least, three >= least
    new = np.cumsum(keep2) - 1
    first, second = pair[keep2] // max(size, 1), pair[keep2] % max(size, 1)
    start, third = new[key[keep3] // max(size, 1)], key[keep3] % max(size, 1)
    # Only the words that are left.
    used, k = _renumbered(size, often, first, second, third)
    t = build(words.take(pa.array(used)), (k[often], one[often]), (k[first], k[second], two[keep2]), (start, k[third], three[keep3]))
    return t, totals


def _renumbered(size: int, *members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers below ``size`` that occur, ascending, and the place of each number among them."""
    have = np.zeros(size, bool)
    for m in members:
        have[m] = True
    return np.flatnonzero(have), np.cumsum(have) - 1


def _added(place: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    np.add.at(out, place, n)
    return out


def compose(acceptor: Transducer, counts: Transducer) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the accepted single words and pairs, in the acceptor's order: the arcs both automata have, layer by layer; 0 where they part."""
    size = max(1, len(counts.words))
    number = pc.fill_null(pc.index_in(acceptor.words, counts.words), -1).to_numpy().astype(np.int64)
    (one, _), (first, second, _), _ = paths(acceptor)

    def follow(word: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(counts.root[0], number[word]), max(0, len(counts.root[0]) - 1))
        return np.where(counts.root[0][at] == number[word], at, -1) if len(counts.root[0]) else np.full(len(word), -1)

    arc = follow(one)
    single = np.where(arc >= 0, counts.root[1][arc], 0) if len(counts.root[0]) else np.zeros(len(one), np.int64)
    arc = follow(first)
    state = np.where(arc >= 0, counts.root[2][arc], -1) if len(counts.root[0]) else arc
    edges, word, n, _ = counts.second
    arcs = np.repeat(np.arange(len(edges) - 1), np.diff(edges)) * size + word
    wanted = state * size + number[second]
    at = np.minimum(np.searchsorted(arcs, wanted), max(0, len(arcs) - 1))
    pair = np.where((state >= 0) & (number[second] >= 0) & (arcs[at] == wanted), n[at], 0) if len(arcs) else np.zeros(len(first), np.int64)
    return single, pair


# Ranges


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _range(h: np.ndarray, ranges: int) -> np.ndarray:
    """Equal parts of the hash values, in order."""
    return ((mixed(h) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def word_range(h: np.ndarray, ranges: int) -> np.ndarray:
    return _range(h * MIX[2], ranges)


def pair_range(first: np.ndarray, second: np.ndarray, ranges: int) -> np.ndarray:
    return _range(first * MIX[0] + mixed(second), ranges)


class _Block:
    def __init__(self):
        self.langs: dict[str, tuple[dict[bytes, int], list[np.ndarray]]] = {}
        self.tokens = 0

    def add(self, langs: list[str], texts: list[str | None]) -> None:
        for lang, t in zip(langs, texts):
            number, ids = self.langs.setdefault(lang, ({b".": 0}, []))
            words = (t or "").encode().lower().translate(SEPARATORS).replace(b".", b" . ").split(b" ")
            x = np.fromiter([number.setdefault(w, len(number)) for w in words if w] + [0], np.int32)
            ids.append(x)
            self.tokens += len(x)

    def transducers(self, ranges: int) -> Iterator[tuple[int, bytes]]:
        """A transducer for each prefix range that has any phrase."""
        symbols, ids, base = [], [], 0
        for lang, (number, own) in self.langs.items():
            head = lang.encode() + b"\n"
            symbols += [head + w for w in number if w != b"."]
            x = np.concatenate(own).astype(np.int64)
            ids.append(np.where(x > 0, x - 1 + base, -1))
            base += len(number) - 1
        self.langs = {}
        size, words = len(symbols), pa.array(symbols, pa.binary())
        order = pc.array_sort_indices(words)
        rank = np.full(size + 1, -1)
        rank[order.to_numpy()] = np.arange(size)
        words, h = words.take(order), _hashes(symbols)[order.to_numpy()]
        x = rank[np.concatenate(ids)]
        del symbols, ids
        one = np.bincount(x[x >= 0], minlength=size)
        both = (x[:-1] >= 0) & (x[1:] >= 0)
        pair, at = numbered(x[:-1][both] * size + x[1:][both])
        n2 = np.bincount(at, minlength=len(pair))
        place = np.full(len(x), -1)
        place[:-1][both] = at
        three = (place[:-2] >= 0) & (place[1:-1] >= 0)
        key, at = numbered(place[:-2][three] * size + x[2:][three])
        n3 = np.bincount(at, minlength=len(key))
        start, third = key // max(size, 1), key % max(size, 1)
        first, second = pair // max(size, 1), pair % max(size, 1)
        singles = dict(by_range(word_range(h, ranges), ranges))
        pairs = dict(by_range(pair_range(h[first], h[second], ranges), ranges))
        edges = np.searchsorted(start, np.arange(len(pair) + 1))
        none = np.zeros(0, np.int64)
        for r in sorted(singles.keys() | pairs.keys()):
            s, p = singles.get(r, none), pairs.get(r, none)
            of, arc = _taken(edges, p)
            used, k = _renumbered(size, s, first[p], second[p], third[arc])
            t = build(words.take(pa.array(used)), (k[s], one[s]), (k[first[p]], k[second[p]], n2[p]), (of, k[third[arc]], n3[arc]))
            yield r, t.blob()


PARTS = pa.schema([("range", pa.int32()), ("automaton", pa.binary())])


def shards(docs: DataFrame, text: str, lang: str, ranges: int) -> DataFrame:
    """The transducers of all blocks: a row for each block and prefix range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(block: _Block) -> Iterator[pa.RecordBatch]:
            for r, blob in block.transducers(ranges):
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([blob], pa.binary())], schema=PARTS)

        block = _Block()
        for batch in batches:
            for start, texts in slices(batch.column(1)):
                block.add(batch.column(0).slice(start, len(texts)).to_pylist(), texts)
                if block.tokens >= BLOCK_TOKENS:
                    yield from rows(block)
                    block = _Block()
        if block.tokens:
            yield from rows(block)
        release()

    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "range int, automaton binary")


UNION = pa.schema([("range", pa.int32()), ("automaton", pa.binary()), ("totals", pa.list_(pa.struct([("lang", pa.string()), ("n", pa.int64())])))])


def counted(parts: DataFrame, ranges: int, least: int) -> DataFrame:
    """The union of each prefix range, pruned."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        t, totals = union(rows["automaton"].to_pylist(), least)
        return pa.Table.from_pylist([{"range": key[0].as_py(), "automaton": t.blob(), "totals": [{"lang": k.decode(), "n": n} for k, n in totals.items()]}], UNION)

    return parts.repartition(tasks_for(ranges), "range").groupBy("range").applyInArrow(run, "range int, automaton binary, totals array<struct<lang: string, n: long>>")


CANDIDATES = pa.schema([(c, pa.string()) for c in ("lang", "phrase", "first", "last", "head", "tail")] + [(c, pa.int64()) for c in ("a", "n_head")] + [(c, pa.int32()) for c in ("r_first", "r_last", "r_tail")])
CANDIDATES_DDL = "lang string, phrase string, first string, last string, head string, tail string, a long, n_head long, r_first int, r_last int, r_tail int"


def candidates(ranges_: DataFrame, ranges: int) -> DataFrame:
    """The phrases of two and three words of every range, with their parts and the ranges that count these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                t = Transducer.load(blob)
                words = t.words.to_pylist()
                _, (first, second, n), (place, third, m) = paths(t)
                cut = [w.rpartition(b"\n") for w in words]
                lang, word = np.array([x[0].decode() for x in cut] or [""], object), np.array([x[2].decode() for x in cut] or [""], object)
                h = _hashes(words) if words else np.zeros(1, np.uint64)
                own, of = word_range(h, ranges), pair_range
                two = word[first] + " " + word[second]
                none = [None] * len(first)
                yield _batch([lang[first], two, word[first], word[second], none, none, n, none, own[first], own[second], none])
                f, s = first[place], second[place]
                phrase = two[place] + " " + word[third]
                yield _batch([lang[f], phrase, word[f], word[third], two[place], word[s] + " " + word[third], m, n[place], own[f], own[third], of(h[s], h[third], ranges)])

    return ranges_.select("automaton").mapInArrow(run, CANDIDATES_DDL)


def _batch(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, CANDIDATES.types)], names=CANDIDATES.names)


def part_counts(found: DataFrame, ranges_: DataFrame) -> DataFrame:
    """(lang, part, n) of every part that a candidate asks for, by composition in the part's range."""
    asks = F.inline(
        F.filter(
            F.array(*[F.struct(F.col(r).alias("range"), F.col(p).alias("part")) for r, p in (("r_first", "first"), ("r_last", "last"), ("r_tail", "tail"))]),
            lambda x: x["part"].isNotNull(),
        )
    )
    wanted = found.select("lang", asks).distinct()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        lang, part, n = [], [], []
        if len(left) and len(right):
            counts = Transducer.load(left["automaton"][0].as_py())
            rows = sorted(([x.encode() + b"\n" + w.encode() for w in p.split(" ")], x, p) for x, p in zip(right["lang"].to_pylist(), right["part"].to_pylist()))
            words = sorted({w for k, _, _ in rows for w in k})
            number = {w: i for i, w in enumerate(words)}
            singles, pairs = [r for r in rows if len(r[0]) == 1], [r for r in rows if len(r[0]) == 2]
            yes = lambda x: np.ones(len(x), np.int64)
            ids = lambda x, k: np.array([number[r[0][k]] for r in x], np.int64)
            none = np.zeros(0, np.int64)
            acceptor = build(pa.array(words, pa.binary()), (ids(singles, 0), yes(singles)), (ids(pairs, 0), ids(pairs, 1), yes(pairs)), (none, none, none))
            n = np.concatenate(compose(acceptor, counts)).tolist()
            lang, part = [r[1] for r in singles + pairs], [r[2] for r in singles + pairs]
        return pa.Table.from_arrays([pa.array(lang, pa.string()), pa.array(part, pa.string()), pa.array(n, pa.int64())], names=["lang", "part", "n"])

    return ranges_.select("range", "automaton").groupBy("range").cogroup(wanted.groupBy("range")).applyInArrow(run, "lang string, part string, n long")


def exact_score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(10^6 a a / (l r)) of columns, in decimals of up to 38 digits."""
    a, l, r = (f"cast({c} as decimal(15,0))" for c in (a, l, r))  # noqa: E741
    return F.expr(f"{a} * {a} * cast(1000000 as decimal(7,0)) div ({l} * {r})")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, nested: int = 50, top: int = 2000) -> DataFrame:
    """The first ``top`` collocations of each language: lang, rank, phrase, its count a, the counts l and r of its parts, n and score."""
    ranges = ranges_for(docs, text)
    merged = cut_lineage(counted(shards(docs, text, lang, ranges), ranges, least))
    found = cut_lineage(candidates(merged, ranges))
    parts = cut_lineage(part_counts(found, merged))

    def counts(of: str) -> DataFrame:
        return parts.select("lang", F.col("part").alias(of), F.col("n").alias(f"n_{of}"))

    full = found.join(counts("first"), ["lang", "first"]).join(counts("last"), ["lang", "last"]).join(counts("tail"), ["lang", "tail"], "left")

    def cut(l: str, r: str):  # noqa: E741
        return F.struct(exact_score("a", l, r).alias("score"), F.col(l).alias("l"), F.col(r).alias("r"))

    one, two = cut("n_first", "n_last"), cut("n_first", "n_tail")
    three = cut("n_head", "n_last")
    best = F.when(F.col("tail").isNull(), one).otherwise(F.when(three["score"] < two["score"], three).otherwise(two))
    full = cut_lineage(full.select("lang", "phrase", "head", "tail", "a", "n_head", "n_tail", best.alias("best")))
    longer = full.where("tail is not null")
    covers = [longer.where(F.col("a") * 100 >= F.col(n) * nested).select("lang", F.col(p).alias("phrase")) for p, n in (("head", "n_head"), ("tail", "n_tail"))]
    inside = covers[0].unionByName(covers[1]).distinct()
    left = full.select("lang", "phrase", "a", "best.*").join(inside, ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Pieces of a language and the first ``top`` of each piece are about as many, so neither ranking grows as the language does.
    piece = F.pmod(F.xxhash64("phrase"), F.lit(1 + math.isqrt(full.count() // top)))
    first = left.withColumn("place", F.row_number().over(Window.partitionBy("lang", piece).orderBy(*order))).where(F.col("place") <= top).drop("place")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = merged.select(F.inline("totals")).groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


#: The same over one table of all phrases.
SQL = r"""
with p as materialized (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
     q as materialized (select row_number() over () as id, lang, regexp_split_to_array(piece, '[\x20\x09]+') as w from p),
     e as (select id, lang, unnest(w) as x, generate_subscripts(w, 1) as i from q),
     t as materialized (select lang, x, lead(x) over o as y, lead(x, 2) over o as z from e where x <> '' window o as (partition by id order by i)),
     f as materialized (select lang, 1 as k, x as phrase, count(*) as a from t group by all
           union all select lang, 2, x || ' ' || y, count(*) from t where y is not null group by all
           union all select lang, 3, x || ' ' || y || ' ' || z, count(*) from t where z is not null group by all),
     n as (select lang, sum(a)::bigint as n from f where k = 1 group by lang),
     c as materialized (select lang, k, phrase, a, string_split(phrase, ' ') as w from f where k > 1 and a >= 10),
     cuts as (select lang, phrase, k, a, w, unnest(range(1, k)) as j from c),
     s as (select u.lang, u.phrase, u.k, u.a, u.j, x.a as l, y.a as r, (1000000::hugeint * u.a * u.a) // (x.a::hugeint * y.a) as score
           from cuts u join f x on x.lang = u.lang and x.phrase = array_to_string(w[1:j], ' ') join f y on y.lang = u.lang and y.phrase = array_to_string(w[j + 1:], ' ')),
     b as (select lang, phrase, k, a, min(score) as score, arg_min(l, (score, j)) as l, arg_min(r, (score, j)) as r from s group by all),
     o as (select distinct t.lang, part.phrase from (select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase from c where k = 3) t
           join c part on part.lang = t.lang and part.phrase = t.phrase and part.k = 2 where 100 * t.a >= 50 * part.a),
     z as (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, score from b anti join o on b.lang = o.lang and b.phrase = o.phrase)
select lang, rank, phrase, a, l, r, n, score::bigint as score from z join n using (lang) where rank <= 2000"""
