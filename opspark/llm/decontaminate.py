"""Benchmark decontamination: a prefix-filtered set join over item-sized windows, with built-in functions only.

A window is ten consecutive words of an item (a shorter item is one window), seen as the list of its shingles: pairs of
neighbouring words, or the word itself in a window of one. Containment is required in full, so the necessary prefix
of a window is one shingle: its rarest in the documents. The documents' shingles are joined with these prefixes; the
shingle's place in the window gives the only place where the window can start (positional bound), the window must end
within the text (length bound), and its words are compared there.

The prefix table has a row for each distinct window of the benchmark. If its measured size is below ``BROADCAST_BYTES``
it is broadcast, and a scan of the texts needs no shuffle: the words of a text stay where they are, and only hits leave
the scan. Beyond that size the shingles are shuffled, and the hits meet their texts in a second join.

Results are kept by text, not by id, so ids may be null or repeated and copies share them. A null text has no words, and
an item with a null or word-less text has no window. A null item_id counts as an item named ''.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .texts import free_name

WINDOW = 10
BROADCAST_BYTES = 64 << 20

#: What stands between words: ASCII but for digits and letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; other letters stay as they are."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(low, GAP), "")


def by_text(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """A struct ``kept`` of the kept columns, a 128-bit key of the text, and its words."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    kept = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")] if keep else []
    return docs.select(*kept, F.xxhash64(t).alias("k1"), F.xxhash64(F.lit("second"), t).alias("k2"), words(F.col(f"`{text}`")).alias("words"))


def windows(benchmark: DataFrame, text: str, item_id: str) -> DataFrame:
    """(window, n, parts, items): the distinct windows, their words and the items that have them."""
    items = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item"), words(F.col(f"`{text}`")).alias("words"))
    n = F.least(F.size("words"), F.lit(WINDOW))
    placed = items.where("size(words) > 0").select("item", "words", n.alias("n"), F.explode(F.sequence(F.lit(1), F.size("words") - n + 1)).alias("at"))
    cut = placed.select("item", "n", F.slice("words", F.col("at"), F.col("n")).alias("parts"))
    return cut.groupBy("parts", "n").agg(F.collect_set("item").alias("items")).withColumn("window", F.array_join("parts", " "))


def shingles(of: DataFrame, sizes: list[int], *keep: str) -> DataFrame:
    """A row for each shingle of the arrays ``words``: the kept columns, its hash ``h`` and its place ``pos`` from 0."""
    parts = []
    for size in sizes:
        rows = of.select(*keep, "words", F.posexplode("words").alias("pos", "word"))
        if size == 2:
            rows = rows.where(F.col("pos") < F.size("words") - 1)
            parts.append(rows.select(*keep, "pos", F.xxhash64("word", F.get("words", F.col("pos") + 1)).alias("h")))
        else:
            parts.append(rows.select(*keep, "pos", F.xxhash64("word").alias("h")))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionAll(more)
    return out


def prefixes(found: DataFrame, texts: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """The rarest shingle of each window and its place in it; windows with a shingle that no document has are gone."""
    bare = found.withColumnRenamed("parts", "words")
    own = None
    for size in sizes:
        part = shingles(bare.where("n > 1" if size == 2 else "n = 1"), [size], "window")
        own = part if own is None else own.unionAll(part)
    known = own.select("h").distinct()
    counts = shingles(texts, sizes).join(F.broadcast(known) if small else known, "h").groupBy("h").agg(F.count(F.lit(1)).alias("docs"))
    rare = own.join(counts, "h", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), "h", "pos")).alias("first")
    )
    return rare.where("first.docs > 0").join(found, "window").select("window", "n", "items", "first.h", F.col("first.pos").alias("place"))


def hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(k1, k2, start, n, items): each place (from 1) where a window occurs, by the key of the text."""
    found = cut_lineage(windows(benchmark, item_text, item_id))
    size = found.agg(
        F.coalesce(F.sum(F.length("window") + 16 * F.size("items") + 64), F.lit(0)).alias("bytes"),
        F.coalesce(F.max((F.col("n") == 1).cast("int")), F.lit(0)).alias("single"),
    ).first()
    small = size["bytes"] * 4 <= BROADCAST_BYTES
    sizes = [2, 1] if size["single"] else [2]
    texts = by_text(docs, text)
    first = cut_lineage(prefixes(found, texts, sizes, small))
    start = F.col("pos") - F.col("place") + 1
    fits = (start >= 1) & (start + F.col("n") - 1 <= F.size("words"))
    same = F.array_join(F.slice("words", start, F.col("n")), " ") == F.col("window")
    if small:
        placed = None
        for s in sizes:
            rows = texts.select("k1", "k2", "words", F.posexplode("words").alias("pos", "word"))
            h = F.xxhash64("word", F.get("words", F.col("pos") + 1)) if s == 2 else F.xxhash64("word")
            part = rows.withColumn("h", h).join(F.broadcast(first.where("n > 1" if s == 2 else "n = 1")), "h").where(fits).where(same)
            part = part.select("k1", "k2", start.alias("start"), "n", "items")
            placed = part if placed is None else placed.unionAll(part)
        return placed
    near = shingles(texts, sizes, "k1", "k2").join(first, "h").select("k1", "k2", "pos", "place", "n", "window", "items").distinct()
    return near.join(texts, ["k1", "k2"]).where(fits).where(same).select("k1", "k2", start.alias("start"), "n", "items").distinct()


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The documents in which no window occurs. Only the keys of texts with hits are joined, so no texts are counted."""
    m1, m2 = free_name(docs, "m1"), free_name(docs, "m2")
    found = cut_lineage(hits(docs, benchmark, text, item_text, item_id).select(F.col("k1").alias(m1), F.col("k2").alias(m2)).distinct())
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    on = (F.xxhash64(t) == F.col(m1)) & (F.xxhash64(F.lit("second"), t) == F.col(m2))
    return docs.join(found, on, "left_anti")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None, item_text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """The kept columns of each document with ``n_words``, ``n_hit`` (words inside a window) and the sorted ``items``.

    A result replaces a kept column of its name.
    """
    keep = [c for c in (keep if keep is not None else docs.columns) if c.lower() not in ("n_words", "n_hit", "items")]
    found = cut_lineage(hits(docs, benchmark, text, item_text, item_id).distinct())
    ends = F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)
    covered = found.select("k1", "k2", F.explode(ends).alias("p")).distinct().groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_hit"))
    items = found.select("k1", "k2", F.explode("items").alias("item")).distinct().groupBy("k1", "k2").agg(F.array_sort(F.collect_list("item")).alias("items"))
    marks = covered.join(items, ["k1", "k2"]).select(F.col("k1").alias("m1"), F.col("k2").alias("m2"), F.col("n_hit").alias("m_hit"), F.col("items").alias("m_items"))
    rows = by_text(docs, text, *keep)
    rows = rows.select("kept", "k1", "k2", F.size("words").cast("long").alias("m_words"))
    joined = rows.join(marks, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")), "left")
    none = F.array().cast("array<string>")
    return joined.select("kept.*", F.col("m_words").alias("n_words"), F.coalesce("m_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("m_items", none).alias("items"))


SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
i as (select item_id, least(len(w), 10) as n, unnest(range(1, (len(w) - least(len(w), 10) + 2)::bigint)) as p, w from b where len(w) > 0),
s as (select distinct item_id, n, array_to_string(w[p:p + n - 1], ' ') as t from i),
sizes as (select distinct n from s),
e as (select doc_id, n, unnest(range(1, (len(w) - n + 2)::bigint)) as p, w from d, sizes where len(w) >= n),
h as (select doc_id, item_id, s.n, p from (select doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') as t from e) x join s on x.t = s.t and x.n = s.n),
c as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + n)) as q from h) group by doc_id),
j as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
      from (select distinct doc_id, item_id::varchar as item from h) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (doc_id) left join j using (doc_id)"""
