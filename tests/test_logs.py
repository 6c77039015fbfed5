import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opspark.functions import text as tx
from opspark.functions import vectors as vec
from opspark.operators import access, corpus, feedback, ledger
from opspark.plans import nearest
from opspark.sources import logs, policies
from opspark.sources.literals import literal_table

POLICY = policies.AccessPolicy()
T0 = dt.datetime(2024, 1, 1)


def test_search_scores_title_three_times(spark):
    docs = literal_table(
        spark,
        [("a", "Travel travel", "HR", "x" * 100 + "travel here", "Public"), ("b", "Other", "Hr", "aaaa", "Public"), ("c", "Travel", "IT", None, None)],
        "id string, title string, category string, content string, sensitivity string",
    )
    out = {(r.query, r.id): r for r in corpus.search(docs, [(" Travel ", None), ("aa", "hr"), ("", None)]).collect()}
    assert out[("travel", "a")].match_score == 7 and out[("travel", "c")].match_score == 3
    assert out[("travel", "a")].match_count == 2 and out[("travel", "a")].snippet == "x" * 80 + "travel here"
    assert out[("aa", "b")].match_score == 2
    assert len(out) == 3


def test_lookup_escapes_like_characters(spark):
    people = literal_table(spark, [(1, "Ann_Lee"), (2, "AnnaLee"), (3, "100%")], "id bigint, name string")
    assert [r.id for r in corpus.find_entity(people, name="N_l").collect()] == [1]
    assert [r.id for r in corpus.find_entity(people, name="%").collect()] == [3]
    assert [r.id for r in corpus.find_entity(people, entity_id=2).collect()] == [2]
    with pytest.raises(ValueError):
        corpus.find_entity(people)


def test_policy_lookup(spark):
    rules = policies.policy_rules(spark)
    asked = literal_table(spark, [("Approval", "VP"), ("meals", None), ("nonsense", None)], "topic string, role string")
    got = {(r.topic, r.key): r.value for r in corpus.policy_lookup(asked, rules).collect()}
    assert got[("Approval", "approval_limits.vp")] == "100000"
    assert got[("meals", "budget_limits.meal_dinner")] == "50"
    assert got[("nonsense", "available_topics")].startswith("approval_limits,")
    assert len(got) == 5


def test_access_rules(spark):
    asked = literal_table(spark, [("hr", "view_hr_data"), ("hr", "fly"), ("guest", "submit_expenses")], "role string, capability string")
    got = {(r.role, r.capability): r.allowed for r in access.has_permission(asked, POLICY).collect()}
    assert got == {("hr", "view_hr_data"): True, ("hr", "fly"): False, ("guest", "submit_expenses"): False}
    fields = literal_table(spark, [("engineer", "salary"), ("hr", "salary"), ("guest", "hobby")], "role string, field string")
    got = {(r.role, r.field): (r.allowed, r.audited) for r in access.can_view_field(fields, POLICY).collect()}
    assert got == {("engineer", "salary"): (False, True), ("hr", "salary"): (True, True), ("guest", "hobby"): (True, False)}
    docs = literal_table(spark, [("d1", "Public"), ("d2", "confidential"), ("d3", None), ("d4", "Odd")], "id string, sensitivity string")
    assert sorted(r.id for r in access.visible_documents(docs, "engineer", POLICY).collect()) == ["d1", "d3"]
    checks = access.document_checks(docs, POLICY)
    assert checks.count() == 20 and access.audit_rows(checks, "2024-01-01").where("allowed").count() == 5 + 4 + 5


def test_policy_from_json_and_redact_flag():
    text = '{"roles": {"hr": {"permissions": {"x": true}}}, "sensitive_fields": {"salary": {"visibility": ["hr"]}, "b": {"visibility": [], "redact": false}}}'
    p = policies.AccessPolicy.from_json(text)
    assert p.hidden_fields("hr") == [] and p.hidden_fields("engineer") == ["salary"]


def test_redaction(spark):
    rows = [("engineer", '{"salary": 100, "ssn": "1-2"}\nsalary: 5, x'), ("hr", '"salary": 100'), ("guest", "address: here")]
    df = literal_table(spark, rows, "role string, t string")
    out = {r.role: r.o for r in df.select("role", tx.redact_json(F.col("role"), F.col("t"), POLICY.hidden(), POLICY.hidden_fields(None)).alias("o")).collect()}
    assert out["engineer"] == '{"salary": "[REDACTED]", "ssn": "[REDACTED]"}\nsalary: [REDACTED], x'
    assert out["hr"] == '"salary": 100' and out["guest"] == "address: [REDACTED]"
    prose = literal_table(spark, [("engineer", "Her SALARY is $467,621 now; ssn 123-45-6789")], "role string, t string")
    got = prose.select(tx.redact_prose(F.col("role"), F.col("t"), POLICY.hidden(), [])).first()[0]
    assert got == "Her SALARY: [REDACTED] now; ssn: [REDACTED]"


def test_text_rules(spark):
    df = literal_table(spark, [("  Hello World\n", "a" * 1500, "x TOOL: find_it\nARGS: a=1, b = x=y ,junk,a=2")], "q string, a string, t string")
    r = df.select(
        tx.cache_key(F.col("q")).alias("key"), tx.compress(F.col("a")).alias("short"), tx.compress(F.lit(None).cast("string")).alias("none"),
        tx.chars_saved(F.col("a")).alias("saved"), tx.tool_name(F.col("t")).alias("tool"), tx.tool_args(F.col("t")).alias("args"),
        tx.route_model(F.lit("Who VS whom")).alias("m"), tx.route_model(F.lit("Who VS whom"), tx.COMPLEX_KEYWORDS_B).alias("mb"),
    ).first()
    assert r.key == "hello world" and r.saved == 500 and r.none == ""
    assert r.short == "a" * 1000 + "\n[...compressed: 500 chars truncated...]"
    assert r.tool == "find_it" and r.args == {"a": "2", "b": "x=y"}
    assert (r.m, r.mb) == (tx.CAPABLE_MODEL, tx.CHEAP_MODEL)


def query_log(spark, questions):
    rows = [(i, T0 + dt.timedelta(minutes=i), q, f"answer {i}", 10, 20) for i, q in enumerate(questions)]
    return literal_table(spark, rows, "query_id bigint, ts timestamp_ntz, query string, answer string, input_tokens bigint, output_tokens bigint")


def test_cache_replay_and_impact(spark):
    log = query_log(spark, ["Hello World", "  hello world  ", "why?", "Why?", "new"])
    out = {r.query_id: (r.hit, r.cached_response) for r in ledger.cache_replay(log).collect()}
    assert out == {0: (False, None), 1: (True, "answer 0"), 2: (False, None), 3: (True, "answer 2"), 4: (False, None)}
    impact = ledger.cache_impact(log).first()
    assert (impact.cache_exact_hits, impact.cache_misses, impact.capable_choices, impact.total_savings_pct) == (2, 3, 1, 40.0)
    assert ledger.cache_impact(log.limit(0)).first().cache_hit_rate == 0.0


def test_unknown_model_pays_the_default_price(spark):
    log = literal_table(spark, [("gemini-1.5-flash", 1_000_000, 0), ("new-model", 1_000_000, 1_000_000)], "model string, input_tokens bigint, output_tokens bigint")
    got = {r.model: r.cost for r in ledger.with_token_cost(log, policies.prices(spark)).collect()}
    assert got == {"gemini-1.5-flash": pytest.approx(0.0375), "new-model": pytest.approx(0.375)}


@pytest.mark.parametrize("costs,spikes", [([0.006] * 10 + [0.55], 1), ([0.1, 5.0], 0), ([0.2] * 10, 0)])
def test_cost_spikes(spark, costs, spikes):
    entries = literal_table(spark, [(i, c) for i, c in enumerate(costs)], "id bigint, llm_cost double")
    booked = ledger.ledger_entries(entries)
    assert ledger.cost_spikes(booked).count() == spikes
    assert ledger.cost_breakdown(booked).first().total_daily == pytest.approx(sum(costs))
    assert ledger.cost_breakdown(booked.limit(0)).first().total_daily == 0.0


def corrections(spark):
    rows = [(1, "manager", "What is the travel policy", "short", "a longer answer"), (2, "engineer", "What is the x", "short", "a longer answer"),
            (3, "executive", "y", "a long answer", "no"), (4, "hr", "z", "same", " same "), (5, "hr", "z", "same", "  ")]
    return literal_table(spark, rows, "correction_id bigint, user_role string, original_query string, original_answer string, corrected_answer string")


def test_feedback_rules(spark):
    a = {r.correction_id: (r.accepted, r.validated) for r in feedback.intake_a(corrections(spark)).collect()}
    assert a == {1: (True, True), 2: (True, False), 3: (True, True), 4: (False, None), 5: (False, None)}
    b = {r.correction_id: r.reason for r in feedback.intake_b(corrections(spark), policies.authority(spark)).collect()}
    assert b[1] == "ok" and "lacks authority" in b[2] and b[3] == "correction not more detailed than original" and b[5] == "empty correction"
    accepted = feedback.intake_a(corrections(spark)).where("accepted")
    state = feedback.state(accepted, literal_table(spark, [(2,), (2,)], "correction_id bigint"))
    assert {r.role: r.validated_corrections for r in feedback.metrics(state).collect()}["all"] == 3
    assert feedback.top_patterns(corrections(spark)).first().asDict() == {"pattern": "what is the", "count": 2}
    assert feedback.metrics(state.limit(0)).first().total_corrections == 0


def test_embedding_and_cosine(spark):
    import hashlib

    digest = hashlib.sha256("héllo".encode()).digest()
    raw = np.array([int.from_bytes(digest[i : i + 2], "big") / 32767.5 - 1 for i in range(0, 32, 2)])
    r = literal_table(spark, [("HÉLLO",)], "t string").select(vec.hash_embedding(F.col("t")).alias("v")).first()
    assert np.allclose(r.v, raw / np.linalg.norm(raw))
    df = literal_table(spark, [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 1.0]), ([], [])], "a array<double>, b array<double>")
    assert [round(x[0], 6) for x in df.select(vec.cosine(F.col("a"), F.col("b"))).collect()] == [0.707107, 0.0, 0.0, 0.0]


@pytest.mark.parametrize("ordered", [False, True])
def test_best_match_against_brute_force(spark, ordered):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 10))
    vectors = centres[rng.integers(0, 12, 300)] + rng.normal(size=(300, 10)) * 0.25
    vectors[100:200] = vectors[100]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    cached = literal_table(spark, rows, "cid bigint, vector array<double>")
    asked = cached.withColumnRenamed("cid", "qid")
    order = {"query_order": "qid", "cached_order": "cid"} if ordered else {}
    got = {r.qid: (r.cid, r.similarity) for r in nearest.best_match(asked, cached, "qid", "cid", pivots=7, tile_rows=16, **order).collect()}
    sims = unit @ unit.T
    for q in range(300):
        allowed = [c for c in range(300) if not ordered or c < q]
        best = max((sims[q, c] for c in allowed), default=-1)
        if best < 0.92:
            assert q not in got or best > 0.92 - 1e-9
        else:
            assert got[q][1] == pytest.approx(best, abs=1e-9)
            assert sims[q, got[q][0]] == pytest.approx(best, abs=1e-9)
    if ordered:
        assert all(got[q][0] == 100 for q in range(101, 200))


def test_log_append_and_pruned_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = literal_table(spark, [(T0 + dt.timedelta(days=i), f"e{i}") for i in range(4)], "timestamp timestamp_ntz, entry string")
    logs.append_log(rows, path)
    logs.append_log(rows, path)
    scan = logs.scan_log(spark, path, F.col("log_date") == "2024-01-02")
    assert [r.entry for r in scan.collect()] == ["e1", "e1"]
    assert "PartitionFilters: [isnotnull(log_date" in scan._jdf.queryExecution().executedPlan().toString()


def test_report_rows_nest(spark):
    rows = [("ks", "global", "all", "pvalue", 0.5), ("ks", "hour", "3", "pvalue", 0.1), ("ks", "hour", "3", "statistic", 0.2)]
    metrics = literal_table(spark, rows, "metric string, grouping string, segment string, field string, value double")
    row = logs.report_rows(metrics).first()
    assert row.report == {"global": {"all": {"pvalue": 0.5}}, "hour": {"3": {"pvalue": 0.1, "statistic": 0.2}}}


def test_hybrid_replay_and_python_embedder(spark):
    log = query_log(spark, ["red car", "RED CAR", "red cars", "blue"])

    def embed(texts):
        return [[t.count("red") * 1.0, t.count("car") * 1.0, t.count("blue") * 1.0, 0.01] for t in texts]

    out = {r.query_id: (r.outcome, r.cached_response) for r in ledger.hybrid_replay(log, vec.embed_with(embed)(F.col("cache_key"))).collect()}
    assert out == {0: ("miss", None), 1: ("exact_hit", "answer 0"), 2: ("semantic_hit", "answer 0"), 3: ("miss", None)}


def greedy_cache(requests, threshold):
    """The cache as a loop: exact key, else the most similar entry, else a new entry."""
    entries, out = [], {}
    for i, (query, v) in enumerate(requests):
        key = query.strip().lower()
        same = [e for e in entries if e[0] == key]
        sims = [(sum(a * b for a, b in zip(v, e[1])) / math.dist(v, [0] * len(v)) / math.dist(e[1], [0] * len(v)), -e[2]) for e in entries]
        if same:
            out[i] = ("exact_hit", f"answer {same[0][2]}")
        elif sims and max(sims)[0] >= threshold:
            out[i] = ("semantic_hit", f"answer {-max(sims)[1]}")
        else:
            out[i] = ("miss", None)
            entries.append((key, v, i))
    return out


def hybrid_outcomes(spark, requests):
    rows = [(i, q, f"answer {i}", [float(x) for x in v]) for i, (q, v) in enumerate(requests)]
    log = spark.createDataFrame(rows, "query_id long, query string, answer string, v array<double>")
    return {r.query_id: (r.outcome, r.cached_response) for r in ledger.hybrid_replay(log, F.col("v")).collect()}


def test_a_similar_question_does_not_enter_the_cache(spark):
    """b is close to a, c to b but not to a: b never answers c."""
    a, b, c = ([math.cos(x), math.sin(x)] for x in (0.0, 0.35, 0.70))
    got = hybrid_outcomes(spark, [("a", a), ("b", b), (" B ", b), ("c", c), ("b", b)])
    assert [got[i][0] for i in range(5)] == ["miss", "semantic_hit", "semantic_hit", "miss", "semantic_hit"]
    assert got[1][1] == got[2][1] == "answer 0"


def test_hybrid_cache_agrees_with_the_loop(spark):
    rnd = random.Random(6)
    asked = []
    for _ in range(120):
        x = rnd.choice([rnd.uniform(0, 3), *(y for _, y in asked[-5:])]) + rnd.choice([0, 0, 0.1, -0.3])
        asked.append((f"q{round(x, 1)}" + " " * rnd.randint(0, 2), x))
    requests = [(q, [math.cos(x), math.sin(x), 0.2]) for q, x in asked]
    assert hybrid_outcomes(spark, requests) == greedy_cache(requests, 0.92)
