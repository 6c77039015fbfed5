"""Document search, directory lookup, policy lookup and transcript parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import cut_lineage
from ..sources.policies import topics


COLUMNS = ["id", "title", "category", "sensitivity"]


def search_matches(documents: DataFrame, requests: list[tuple[str, str | None]]) -> DataFrame:
    """(id, query, category_filter, match_score) of all documents that match a (query, category) request.

    Requests are a short list from the caller. Every document is tested against them inside its own task and
    repeated only for those it matches; the texts are read once and never shuffled.
    """
    asked = [(q.lower().strip(), c.lower() if c else None) for q, c in requests]
    wanted = F.array(
        *[F.struct(F.lit(q).alias("query"), F.lit(c).cast("string").alias("category_filter")) for q, c in asked if q]
    )
    word, title, content = F.col("query"), F.col("_title"), F.col("_content")
    asked_of = F.filter(
        wanted,
        lambda r: (F.contains(content, r["query"]) | F.contains(title, r["query"]))
        & (r["category_filter"].isNull() | (F.lower("category") == r["category_filter"])),
    )
    lowered = {n: F.lower(F.coalesce(c, F.lit(""))) for n, c in (("_title", "title"), ("_content", "content"))}
    return (
        documents.select("id", "category", *[c.alias(n) for n, c in lowered.items()])
        .withColumn("_r", F.explode(asked_of))
        .select("id", "_title", "_content", "_r.query", "_r.category_filter")
        .select("id", "query", "category_filter", tx.match_score(title, content, word).alias("match_score"))
    )


def search(documents: DataFrame, requests: list[tuple[str, str | None]], limit: int = 5) -> DataFrame:
    """Top ``limit`` documents per request by score, with the number of matches and a snippet.

    The matches are ids and scores, written once for counting and ranking; only the documents that rank are read
    again, for their snippets.
    """
    matches = cut_lineage(search_matches(documents, requests))
    by = ["query", "category_filter"]
    counts = matches.groupBy(*by).agg(F.count("*").alias("match_count"))
    best = Window.partitionBy(*by).orderBy(F.col("match_score").desc(), "id")
    top = matches.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
    same = (top["query"] == F.col("_q")) & top["category_filter"].eqNullSafe(F.col("_c"))
    counts = counts.withColumnsRenamed({"query": "_q", "category_filter": "_c"})
    found = cut_lineage(top.join(counts, same).drop("_q", "_c").withColumn("rank", F.col("rank").cast("bigint")))
    content = F.coalesce("content", F.lit(""))
    texts = documents.select(*COLUMNS, content.alias("_text")).join(found, "id")
    snippet = tx.snippet(F.col("_text"), F.lower("_text"), F.col("query"))
    return texts.select(*COLUMNS, *by, "match_score", snippet.alias("snippet"), "rank", "match_count")


def contains_first(documents: DataFrame, words: list[str], limit: int = 5) -> DataFrame:
    """First ``limit`` documents by id whose content or title contains each word, with the opening text.

    The words a document contains are picked inside its row, so that only matches become rows of their own.
    """
    wanted = F.array(*[F.lit(w.lower().strip()) for w in words if w.strip()])
    hay = F.lower(F.concat_ws(" ", F.coalesce("content", F.lit("")), F.coalesce("title", F.lit(""))))
    opening = tx.opening(F.coalesce("content", F.lit("")))
    rows = documents.select("id", F.coalesce("title", F.col("id").cast("string")).alias("title"), opening.alias("snippet"), hay.alias("_hay"))
    found = rows.withColumn("_words", F.filter(wanted, lambda w: F.contains(F.col("_hay"), w))).where(F.size("_words") > 0)
    matches = found.select(F.explode("_words").alias("query"), "id", "title", "snippet")
    order = Window.partitionBy("query").orderBy("id")
    return matches.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= limit).drop("_rn")


def find_entity(people: DataFrame, name: str | None = None, entity_id: int | None = None, limit: int = 5) -> DataFrame:
    """Directory rows by exact id, or by part of the name ignoring case; the filter reaches the scan."""
    if not name and entity_id is None:
        raise ValueError("give a name or an id")
    if entity_id is not None:
        found = people.where(F.col("id") == entity_id)
    else:
        pattern = name.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_")
        found = people.where(F.ilike("name", F.lit(f"%{pattern}%")))
    return found.orderBy("id").limit(limit)


def policy_lookup(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """Policy values per (topic, role) request. An unknown topic answers with the list of topics; a role
    narrows approval limits to its own."""
    t = topics(requests.sparkSession)
    topic = F.lower(F.trim(F.coalesce("topic", F.lit(""))))
    known = t.withColumnRenamed("topic", "_topic")
    asked = requests.withColumn("_asked", topic).join(known, F.col("_asked") == F.col("_topic"), "left")
    r = rules.select(F.col("section").alias("_section"), "key", "value")
    in_section = (F.col("section") == F.col("_section")) & F.startswith(F.col("key"), F.col("prefix"))
    limits = F.col("_asked").isin("approval_limits", "approval") & F.col("role").isNotNull()
    own = ~limits | (F.col("key") == F.concat(F.lit("approval_limits."), F.lower("role")))
    names = "approval_limits,travel_limits,per_diem,submission_deadline,pto,compensation,all"
    joined = asked.join(r, in_section & F.coalesce(own, F.lit(True)), "left")
    return joined.select(
        *requests.columns,
        F.when(F.col("_topic").isNull(), F.lit("available_topics")).otherwise(F.col("key")).alias("key"),
        F.when(F.col("_topic").isNull(), F.lit(names)).otherwise(F.col("value")).alias("value"),
    )


def tool_calls(transcript: DataFrame, tools: list[str], text: str = "text") -> DataFrame:
    """Tool and arguments named in transcript texts; texts without a known tool are left out."""
    name = tx.tool_name(F.col(text))
    return transcript.where(name.isin(*tools)).withColumns({"tool": name, "args": tx.tool_args(F.col(text))})
