"""Quality rules with adaptive thresholds: quantile sketches per language and source instead of fixed cutoffs.

The statistics of a text are computed in its row with built-in functions only. Each statistic is an integer, and a
quantile sketch counts the values of a group in buckets that grow by two per cent (as in DDSketch). Two sketches merge
by adding their counts, so the sketch of a language is the sum over its sources, and the result does not depend on the
order of rows. A group's fences are its quartiles plus or minus ``FENCE`` interquartile ranges, with a least range for
statistics that are zero nearly everywhere. Groups below ``LEAST_DOCS`` documents use the sketch of their language,
languages below it the sketch of all documents. The verdicts come from a join of the statistics with the fences.

A null text has no words, and fails. Null languages and sources are groups of their own. Repeated rows count as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .texts import WORD_GAP

#: Growth of the buckets, interquartile ranges up to a fence, documents that make a sketch of their own.
GROWTH, FENCE, LEAST_DOCS = 1.02, 3, 50

#: Window of the repeated words, and the base rules.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30

#: The judged statistics (thousandths of a word or line), their least interquartile range, and whether low values fail too.
JUDGED = {"word_length": (400, True), "symbol_rate": (50, False), "dup_line_rate": (150, False), "repeat_rate": (100, False)}


def text_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines``, ``n_repeat_words``."""
    keep = keep if keep is not None else docs.columns
    base = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))
    cut = base.select(
        *keep,
        "__text",
        F.filter(F.split("__text", WORD_GAP), lambda w: w != "").alias("__words"),
        F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"),
    )

    def windows(of) -> Column:
        # Elements are taken one by one: slice() copies the whole array each time it is called in a lambda.
        last = F.size("__words") - WINDOW
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), of))

    def words(i: Column) -> list[Column]:
        return [F.get("__words", i + k) for k in range(WINDOW)]

    hashed = cut.select(
        *keep,
        "__words",
        F.length(F.regexp_replace("__text", WORD_GAP, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("__text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        windows(lambda i: F.xxhash64(*words(i))).alias("__hashes"),
    )
    # Only texts in which a window's hash repeats look at the windows themselves: sorted, with equal neighbours.
    repeats = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    sorted_ = hashed.select(
        *keep,
        F.size("__words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.when(
            repeats,
            F.array_sort(windows(lambda i: F.struct(F.concat_ws(" ", *words(i)).alias("w"), i.alias("p")))),
        ).alias("__sorted"),
    )

    def neighbour(j: Column) -> Column:
        return F.get("__sorted", j).getField("w")

    starts = sorted_.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.array_sort(
            F.transform(
                F.filter("__sorted", lambda x, j: x.w.eqNullSafe(neighbour(j - 1)) | x.w.eqNullSafe(neighbour(j + 1))), lambda x: x.p
            )
        ).alias("__starts"),
    )
    covered = F.aggregate(
        "__starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a.n + (p + WINDOW - F.greatest(p, a.end))).alias("n"), (p + WINDOW).alias("end")),
        lambda a: a.n,
    )
    return starts.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("__starts")


def rates(stats: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return stats.withColumns(
        {
            "word_length": F.expr("1000 * word_chars div greatest(n_words, 1)"),
            "symbol_rate": F.expr("1000 * n_symbols div greatest(n_words, 1)"),
            "dup_line_rate": F.expr("1000 * n_dup_lines div greatest(n_lines, 1)"),
            "repeat_rate": F.expr("1000 * n_repeat_words div greatest(n_words, 1)"),
            "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * words),
        }
    )


def bucket(value: Column) -> Column:
    """The sketch bucket of an integer: -1 for zero, else the exponent of the growth that covers it."""
    return F.when(value <= 0, F.lit(-1)).otherwise(F.ceil(F.log(value.cast("double")) / F.log(F.lit(GROWTH))).cast("int"))


def bucket_value(b: Column) -> Column:
    return F.when(b < 0, F.lit(0)).otherwise(F.floor(2 * F.pow(F.lit(GROWTH), b) / (GROWTH + 1))).cast("long")


def sketches(stats: DataFrame, by: list[str]) -> DataFrame:
    """(by..., metric, bucket, n): a mergeable quantile sketch of each judged statistic in each group."""
    pairs = [F.struct(F.lit(m).alias("metric"), bucket(F.col(m)).alias("bucket")) for m in JUDGED]
    rows = stats.select(*by, F.explode(F.array(*pairs)).alias("e")).select(*by, "e.metric", "e.bucket")
    return rows.groupBy(*by, "metric", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    return sketch.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """One row for each group: its number of documents, and a lower and upper fence for each statistic.

    A sketch has a bounded number of buckets, so a group is a small array here, however many documents it has.
    """
    sorted_ = sketch.groupBy(*by, "metric").agg(F.sum("n").alias("docs"), F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("s"))

    def quantile(q: float) -> Column:
        rank = F.floor(q * (F.col("docs") - 1))
        found = F.aggregate(
            "s",
            F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("at")),
            lambda a, x: F.struct((a.seen + x.n).alias("seen"), F.when(a.at.isNull() & (a.seen + x.n > rank), x.bucket).otherwise(a.at).alias("at")),
            lambda a: a.at,
        )
        return bucket_value(found)

    low, high = quantile(0.25), quantile(0.75)
    least = F.create_map(*[x for m, (r, _) in JUDGED.items() for x in (F.lit(m), F.lit(r))])[F.col("metric")]
    spread = F.greatest(high - low, least.cast("long"))
    each = sorted_.select(*by, "metric", "docs", (low - FENCE * spread).alias("lower"), (high + FENCE * spread).alias("upper"))
    wide = [F.max("docs").alias("docs")]
    for m in JUDGED:
        wide += [F.max(F.when(F.col("metric") == m, F.col(side))).alias(f"{m}_{side}") for side in ("lower", "upper")]
    return each.groupBy(*by).agg(*wide)


def thresholds(stats: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """The fences that hold for each (language, source) present: its own, its language's or those of all."""
    # A few rows for each group; stored, because three levels of sketches are merged from them.
    own = cut_lineage(sketches(stats, [lang, source]))
    by_group = fences(own, [lang, source]).alias("g")
    by_lang = fences(merged(own, [lang]), [lang]).alias("l")
    names = [f"{m}_{s}" for m in JUDGED for s in ("lower", "upper")]
    # The fences of all documents are one row, so a scalar subquery.
    by_all = fences(merged(own, []), []).select(F.struct(*names)).scalar()
    enough = [F.col("g.docs") >= LEAST_DOCS, F.col("l.docs") >= LEAST_DOCS]
    chosen = [F.when(enough[0], F.col(f"g.{n}")).when(enough[1], F.col(f"l.{n}")).otherwise(by_all.getField(n)).alias(n) for n in names]
    joined = by_group.join(by_lang, F.col(f"g.{lang}").eqNullSafe(F.col(f"l.{lang}")))
    return joined.select(F.col(f"g.{lang}").alias("t_lang"), F.col(f"g.{source}").alias("t_source"), *chosen)


def quality(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: its statistics, ``base_failed`` and ``kept``."""
    named = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in ((doc_id, "doc_id"), (lang, "lang"), (source, "source"), (text, "text"))])
    # A few numbers for each document, written because both the sketches and the verdicts read them.
    stats = cut_lineage(rates(text_statistics(named, keep=["doc_id", "lang", "source"])))
    limits = thresholds(stats)
    inside = ~F.col("base_failed")
    for m, (_, low_fails) in JUDGED.items():
        inside = inside & (F.col(m) <= F.col(f"{m}_upper"))
        if low_fails:
            inside = inside & (F.col(m) >= F.col(f"{m}_lower"))
    on = stats["lang"].eqNullSafe(limits["t_lang"]) & stats["source"].eqNullSafe(limits["t_source"])
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return stats.join(limits, on, "left").select(*columns, F.coalesce(inside, F.lit(False)).alias("kept"))


SQL = rf"""
with t as (select doc_id, lang, source, coalesce(text, '') as t from documents),
w as (select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from t),
r as (select row_number() over () as id, * from w),
e as (select id, unnest(range(1, len(words) - 6)) as p, words from r where len(words) >= 8),
g as (select id, p, count(*) over (partition by id, array_to_string(words[p:p + 7], ' ')) as c from e),
c as (select id, count(distinct q) as n from (select id, unnest(range(p, p + 8)) as q from g where c > 1) group by id),
s as (select r.id, doc_id, lang, source, len(words)::bigint as n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
             len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
             coalesce(n, 0)::bigint as n_repeat_words from r left join c on r.id = c.id),
m as (select *, 1000 * word_chars // greatest(n_words, 1) as word_length, 1000 * n_symbols // greatest(n_words, 1) as symbol_rate,
             1000 * n_dup_lines // greatest(n_lines, 1) as dup_line_rate, 1000 * n_repeat_words // greatest(n_words, 1) as repeat_rate,
             n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed from s),
v as (select lang, source, unnest(['word_length', 'symbol_rate', 'dup_line_rate', 'repeat_rate']) as metric,
             unnest([word_length, symbol_rate, dup_line_rate, repeat_rate]) as x from m),
b as (select *, case when x <= 0 then -1 else ceil(ln(x::double) / ln({GROWTH}::double))::int end as bucket from v),
k as (select 3 as level, lang, source, metric, bucket from b union all select 2, lang, null, metric, bucket from b
      union all select 1, null, null, metric, bucket from b),
o as (select level, lang, source, metric, bucket, row_number() over (partition by level, lang, source, metric order by bucket) as i,
             count(*) over (partition by level, lang, source, metric) as docs from k),
q as (select level, lang, source, metric, max(docs) as docs,
             max(case when i = floor(0.25 * (docs - 1)) + 1 then bucket end) as low, max(case when i = floor(0.75 * (docs - 1)) + 1 then bucket end) as high
      from o group by all),
z as (select level, lang, source, metric, docs,
             case when low < 0 then 0 else floor(2 * pow({GROWTH}::double, low) / {GROWTH + 1}) end::bigint as low,
             case when high < 0 then 0 else floor(2 * pow({GROWTH}::double, high) / {GROWTH + 1}) end::bigint as high from q),
f as (select level, lang, source, metric, docs,
             low - {FENCE} * greatest(high - low, case metric {" ".join(f"when '{m}' then {r}" for m, (r, _) in JUDGED.items())} end) as lower,
             high + {FENCE} * greatest(high - low, case metric {" ".join(f"when '{m}' then {r}" for m, (r, _) in JUDGED.items())} end) as upper from z),
h as (select g.lang, g.source, g.metric,
             case when g.docs >= {LEAST_DOCS} then g.lower when l.docs >= {LEAST_DOCS} then l.lower else a.lower end as lower,
             case when g.docs >= {LEAST_DOCS} then g.upper when l.docs >= {LEAST_DOCS} then l.upper else a.upper end as upper
      from f g join f l on l.level = 2 and g.lang is not distinct from l.lang and g.metric = l.metric
               join f a on a.level = 1 and g.metric = a.metric where g.level = 3)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and word_length between wl.lower and wl.upper and symbol_rate <= sr.upper
         and dup_line_rate <= dr.upper and repeat_rate <= rr.upper as kept
from m
join h wl on wl.metric = 'word_length' and m.lang is not distinct from wl.lang and m.source is not distinct from wl.source
join h sr on sr.metric = 'symbol_rate' and m.lang is not distinct from sr.lang and m.source is not distinct from sr.source
join h dr on dr.metric = 'dup_line_rate' and m.lang is not distinct from dr.lang and m.source is not distinct from dr.source
join h rr on rr.metric = 'repeat_rate' and m.lang is not distinct from rr.lang and m.source is not distinct from rr.source"""
