"""Query log, cost ledger, caching and routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..plans import stored
from ..plans.nearest import THRESHOLD
from ..plans.stored import Store
from ..session import cut_lineage, drop, release
from ..sources.policies import DEFAULT_PRICE_MODEL

PARTS = ["retrieval_cost", "llm_cost", "tool_cost", "error_cost"]
RETRIEVAL_CAP = 3


def with_token_cost(log: DataFrame, prices: DataFrame, default_model: str = DEFAULT_PRICE_MODEL) -> DataFrame:
    """Adds ``cost`` from tokens and the price per million; an unknown model pays the default model's price."""
    p = prices.select(F.col("model").alias("_model"), "input_price", "output_price")
    known = log.join(p, F.col("model") == F.col("_model"), "left").drop("_model")
    default = prices.where(F.col("model") == default_model).agg(
        F.struct(F.max("input_price").alias("i"), F.max("output_price").alias("o"))
    ).scalar()
    cost = F.col("input_tokens") / 1e6 * F.coalesce("input_price", default["i"]) + F.col("output_tokens") / 1e6 * F.coalesce(
        "output_price", default["o"]
    )
    return known.withColumn("cost", cost).drop("input_price", "output_price")


def ledger_entries(costs: DataFrame) -> DataFrame:
    """Missing cost parts become 0; the total is their sum unless it was supplied."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in costs.columns else F.lit(0.0) for c in PARTS}
    out = costs.withColumns(filled)
    total = reduce(Column.__add__, [F.col(c) for c in PARTS])
    if "total_cost" in costs.columns:
        total = F.coalesce(F.col("total_cost").cast("double"), total)
    return out.withColumn("total_cost", total)


def cost_breakdown(ledger: DataFrame) -> DataFrame:
    """Totals by component; zeros for an empty ledger."""
    sums = {"retrieval_cost": "retrieval_total", "llm_cost": "llm_total", "tool_cost": "tool_total", "error_cost": "error_total", "total_cost": "total_daily"}
    return ledger.agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(n) for c, n in sums.items()], F.count("*").alias("query_count")
    )


def query_metrics(log: DataFrame) -> DataFrame:
    """Queries, cost, average cost and tokens of a query log."""
    zero = F.lit(0)
    return log.agg(
        F.count("*").alias("total_queries"),
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("total_cost"),
        F.coalesce(F.avg(F.coalesce("cost", F.lit(0.0))), F.lit(0.0)).alias("avg_cost_per_query"),
        F.coalesce(F.sum("input_tokens"), zero).alias("total_input_tokens"),
        F.coalesce(F.sum("output_tokens"), zero).alias("total_output_tokens"),
    )


def cost_spikes(ledger: DataFrame, sigma: float = 2.0, cost: str = "total_cost") -> DataFrame:
    """Entries above mean + sigma standard deviations; none below 3 entries or without spread.

    The two statistics are a scalar subquery: one row, whatever the size of the ledger.
    """
    c = F.coalesce(F.col(cost), F.lit(0.0))
    s = ledger.agg(F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"), F.count("*").alias("n"))).scalar()
    return ledger.where((s["n"] >= 3) & (s["std"] > 0) & (c > s["mean"] + F.lit(sigma) * s["std"]))


def user_spending(charges: DataFrame, budgets: DataFrame, default_role: str = "engineer") -> DataFrame:
    """Spending and remaining budget per user under the user's latest role; an unknown role has no budget."""
    per_user = charges.groupBy("user_id").agg(
        F.sum(F.round(F.coalesce("cost", F.lit(0.0)) * 1e6).cast("bigint")).alias("_micro"),
        F.max_by("user_role", F.struct("ts", "event_id")).alias("role"),
    )
    b = budgets.select(F.col("role").alias("_role"), "budget")
    spent = F.col("_micro") / 1e6
    return per_user.join(b, F.coalesce("role", F.lit(default_role)) == F.col("_role"), "left").select(
        "user_id",
        "role",
        spent.alias("spent"),
        F.greatest(F.lit(0.0), F.coalesce("budget", F.lit(0.0)) - spent).alias("remaining"),
    )


def cache_replay(log: DataFrame, order: tuple[str, ...] = ("ts", "query_id")) -> DataFrame:
    """Adds ``hit`` and ``cached_response`` as an exact-match cache would answer the log in time order.

    The first request of each key is found by aggregation (map-side combined) and written as a table of one
    row per key. Joining that table keeps both join sides plain shuffles, which is what lets AQE split the
    partition of a question that is asked very often.
    """
    keyed = log.withColumn("_key", tx.cache_key(F.col("query")))
    when = F.struct(*order)
    first = cut_lineage(
        keyed.groupBy(F.col("_key").alias("_k")).agg(
            F.min(when).alias("_first"), F.min_by("answer", when).alias("cached_response")
        )
    )
    joined = keyed.join(first, F.col("_key") == F.col("_k"))
    return (
        joined.withColumn("hit", F.struct(*order) != F.col("_first"))
        .withColumn("cached_response", F.when(F.col("hit"), F.col("cached_response")))
        .drop("_k", "_first")
        .withColumnRenamed("_key", "cache_key")
    )


def cached_entries(asked: Store, threshold: float) -> DataFrame:
    """(cache_key, node, part, row, ord): the requests that entered the cache, of stored (cache_key, node, ord) rows in order of ``node``.

    A request is answered without entering if its key is cached, or a cached vector is similar. Who entered
    depends only on earlier requests of the same key or a similar vector, so all requests without such a request that is
    still open are decided together; the number of rounds is the length of the longest chain of dependencies.
    The vectors stay where they are stored: a round moves keys and places only.
    """
    first = F.min(F.struct("node", "part", "row", "ord")).alias("_first")
    still, entered = cut_lineage(asked.rows.groupBy("cache_key", "same").agg(first).select("cache_key", "_first.*")), None
    while True:
        # In the order of time, the first of its key and without an earlier one like it: nothing can answer it.
        first = cut_lineage(still.groupBy("cache_key").agg(F.min(F.struct("node", "part", "row", "ord")).alias("_first")).select("cache_key", "_first.*"))
        after = stored.with_earlier(asked, _placed(first), _placed(still), threshold)
        new = cut_lineage(first.join(after, F.col("node") == F.col("id"), "left_anti"))
        release(first, after)
        entered = new if entered is None else entered.unionByName(new)
        # Of a key only its first row can have entered, and then it answers all others.
        keys = new.select(F.col("cache_key").alias("_k"), F.col("node").alias("_n"))
        rest = still.join(keys.select("_n"), F.col("node") == F.col("_n"), "left_anti")
        rest = cut_lineage(rest.join(keys, (F.col("cache_key") == F.col("_k")) & (F.col("node") > F.col("_n")), "left_anti"))
        answered = stored.with_earlier(asked, _placed(rest), _placed(new), threshold)
        before, still = still, cut_lineage(rest.join(answered, F.col("node") == F.col("id"), "left_anti"))
        release(before, rest, answered)
        if still.isEmpty():
            return entered


def _placed(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("node").alias("id"), "part", "row", "ord")


def hybrid_replay(log: DataFrame, vector: Column, threshold: float = THRESHOLD, responses: bool = True) -> DataFrame:
    """Replay of a cache that looks for the exact key first and then for the most similar cached question.

    Adds ``cache_key``, ``outcome`` (exact_hit, semantic_hit, miss), ``hit``, ``cached_response`` and ``similarity``; no ``cached_response``
    unless ``responses``. Only a miss enters the cache: a question answered by a similar one is looked up anew each time. Needs a
    unique ``query_id`` that grows with time, and a log that is the same whenever it is read: its vectors are read once and stored, its other
    columns are read again for the result.
    """
    keyed = log.withColumn("cache_key", tx.cache_key(F.col("query")))
    node = F.col("query_id")
    asked = stored.store(keyed.select("cache_key", node.alias("node"), node.cast("bigint").alias("ord"), vector.alias("_v")), "_v")
    entered = cached_entries(asked, threshold)
    by_key = entered.groupBy(F.col("cache_key").alias("_k")).agg(F.min("node").alias("_first"))
    rows = asked.rows.join(by_key, F.col("cache_key") == F.col("_k"), "left")
    rows = cut_lineage(rows.select("node", F.xxhash64("cache_key").alias("_h"), "part", "row", "ord", "_first"))
    release(asked.rows)
    open_ = rows.where(F.col("_first").isNull() | (F.col("node") < F.col("_first")))
    found = cut_lineage(stored.best_earlier(asked, _placed(open_), _placed(entered), threshold))
    drop(log.sparkSession, asked.path)
    # Where an id comes several times, a similar question is answered by each row of the entry.
    copies = cut_lineage(entered.select(F.col("node").alias("_n")).join(rows, F.col("node") == F.col("_n")).groupBy("_n").agg(F.count("*").alias("_copies")))
    found = found.join(copies, F.col("hit") == F.col("_n"))
    exact = F.coalesce(F.col("_node") > F.col("_first"), F.lit(False))
    semantic = ~exact & F.col("similarity").isNotNull()
    lookups = rows.select(F.col("node").alias("_node"), "_h", "_first").distinct().join(found.withColumnRenamed("id", "_id"), F.col("_node") == F.col("_id"), "left")
    lookups = lookups.select(
        "_node",
        F.col("_h").alias("_key"),
        F.when(exact, "exact_hit").when(semantic, "semantic_hit").otherwise("miss").alias("outcome"),
        "similarity",
        F.when(exact, F.col("_first")).otherwise(F.col("hit")).alias("_answer"),
        F.explode(F.sequence(F.lit(1), F.when(semantic, F.col("_copies").cast("int")).otherwise(F.lit(1)))).alias("_copy"),
    )
    out = keyed.join(lookups, (node == F.col("_node")) & (F.xxhash64("cache_key") == F.col("_key")), "left")
    out = out.withColumn("hit", F.col("outcome") != "miss")
    if responses:
        answers = log.select(node.alias("_n"), F.col("answer").alias("cached_response")).join(copies.select("_n"), "_n")
        numbered = Window.partitionBy("_n").orderBy("cached_response")
        answers = cut_lineage(answers.withColumn("_number", F.row_number().over(numbered)))
        out = out.join(answers, (F.col("_answer") == F.col("_n")) & (F.col("_copy") == F.col("_number")), "left").drop("_n", "_number")
    return out.drop("_node", "_key", "_answer", "_copy")


def cache_impact(log: DataFrame, keywords: list[str] | None = None, max_chars: int = 1000, replay: DataFrame | None = None) -> DataFrame:
    """Hits, misses, model share and characters saved of a log.

    Without a ``replay`` the cache is an exact one, whose hits need no replay: every key misses once, and requests with
    one key differ at most in case and outer white space, so one of them stands for the miss. With the result of
    ``hybrid_replay`` semantic hits count as well. Only misses are routed to a model.
    """
    saved = tx.chars_saved(F.col("answer"), max_chars)
    none = F.lit(0).cast("bigint")
    if replay is None:
        rows = log.groupBy(tx.cache_key(F.col("query")).alias("question")).agg(
            F.count("*").alias("n"), F.lit(1).cast("bigint").alias("missed"), none.alias("similar"), F.sum(saved).alias("saved"), F.count_if(saved > 0).alias("cut")
        )
    else:
        miss, similar = (F.col("outcome") == o for o in ("miss", "semantic_hit"))
        rows = replay.select(
            F.col("query").alias("question"), F.lit(1).cast("bigint").alias("n"), miss.cast("bigint").alias("missed"),
            similar.cast("bigint").alias("similar"), saved.alias("saved"), (saved > 0).cast("bigint").alias("cut"),
        )
    capable = tx.is_complex(F.col("question"), keywords)

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), none)

    totals = rows.agg(
        total(F.col("n")).alias("total_queries"),
        total(F.col("missed")).alias("cache_misses"),
        total(F.col("similar")).alias("cache_semantic_hits"),
        total(F.when(capable, F.col("missed"))).alias("capable_choices"),
        total(F.when(~capable, F.col("missed"))).alias("cheap_choices"),
        total(F.col("cut")).alias("responses_compressed"),
        total(F.col("saved")).alias("compression_chars_saved"),
    )
    hits = F.col("total_queries") - F.col("cache_misses")
    rate = F.when(F.col("total_queries") > 0, hits / F.col("total_queries")).otherwise(F.lit(0.0))
    choices = F.greatest(F.col("capable_choices") + F.col("cheap_choices"), F.lit(1))
    return totals.select(
        "*",
        (hits - F.col("cache_semantic_hits")).alias("cache_exact_hits"),
        rate.alias("cache_hit_rate"),
        (F.col("cheap_choices") / choices).alias("cheap_share"),
        F.bround(rate * 100, 1).alias("total_savings_pct"),
    )


def retrieval_limit(requested: Column, cap: int = RETRIEVAL_CAP) -> Column:
    return F.least(requested.cast("bigint"), F.lit(cap).cast("bigint"))


def evaluation(log: DataFrame, prices: DataFrame, replay: DataFrame | None = None) -> DataFrame:
    """Every query of a log after caching, routing and pricing: cached ones are free. ``replay``: of a hybrid cache."""
    replay = cache_replay(log) if replay is None else replay
    model = F.when(F.col("hit"), "(cache)").otherwise(tx.route_model(F.col("query")))
    tokens = {c: F.when(F.col("hit"), F.lit(0)).otherwise(F.col(c)).cast("bigint") for c in ("input_tokens", "output_tokens")}
    return with_token_cost(replay.withColumns({"model": model, **tokens}), prices)


def evaluation_report(evaluated: DataFrame, sigma: float = 2.0) -> DataFrame:
    """Cost breakdown, cache and routing impact and the number of spikes as one row. Spikes are sought among
    the paid queries, the only ones in the ledger."""
    paid = evaluated.where(~F.col("hit"))
    spikes = cost_spikes(paid, sigma, "cost").agg(F.count("*").alias("n")).scalar()
    n, hits = F.count("*"), F.count_if("hit")
    return evaluated.agg(
        n.alias("total_queries"),
        hits.alias("cache_hits"),
        F.coalesce(hits / F.when(n > 0, n), F.lit(0.0)).alias("cache_hit_rate"),
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("total_cost"),
        F.count_if(F.col("model") == tx.CAPABLE_MODEL).alias("capable_choices"),
        F.count_if(F.col("model") == tx.CHEAP_MODEL).alias("cheap_choices"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
    ).withColumn("spikes", spikes)


def answer_consistency(log: DataFrame, by: tuple[str, ...] = ("user_role",)) -> DataFrame:
    """Questions that were asked more than once in the same circumstances, with the number of different answers.

    Answers are compared by hash, without outer white space; a NULL answer is an empty one. Rows first collapse to one for each
    question and answer, so a question that is asked very often is cheap. ``drifted_at`` is when an answer other than the first came.
    """
    asked = log.select(tx.cache_key(F.col("query")).alias("cache_key"), *by, "ts", F.sha2(tx.strip(F.coalesce("answer", F.lit(""))), 256).alias("_hash"))
    answers = asked.groupBy("cache_key", *by, "_hash").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("_first"))
    per = answers.groupBy("cache_key", *by).agg(
        F.sum("n").alias("asked"), F.count(F.lit(1)).alias("answers"), F.max("n").alias("most_common"), F.min(F.struct("_first", "_hash")).alias("_start")
    )
    # Of the answers other than the first, the earliest.
    later = answers.alias("a").join(per.where("answers > 1").alias("p"), ["cache_key", *by]).where(F.col("a._hash") != F.col("p._start._hash"))
    drifted = later.groupBy("cache_key", *by).agg(F.min("a._first").alias("drifted_at"))
    again = per.where(F.col("asked") > 1).join(drifted, ["cache_key", *by], "left")
    return again.select("cache_key", *by, "asked", "answers", (F.col("most_common") / F.col("asked")).alias("agreement"), "drifted_at")


def costs_by(ledger: DataFrame, keys: list[str], cost: str = "total_cost") -> DataFrame:
    """Cost by each key alone and overall."""
    sets = [[F.col(k)] for k in keys] + [[]]
    grouped = ledger.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        *[F.grouping(k).alias(f"_g_{k}") for k in keys], F.count("*").alias("queries"), F.sum(cost).alias("cost")
    )
    name = F.coalesce(*[F.when(F.col(f"_g_{k}") == 0, F.lit(k)) for k in keys], F.lit("all"))
    item = F.coalesce(*[F.when(F.col(f"_g_{k}") == 0, F.col(k).cast("string")) for k in keys], F.lit("all"))
    return grouped.select(name.alias("grouping"), item.alias("item"), "queries", "cost")
