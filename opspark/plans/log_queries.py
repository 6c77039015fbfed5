"""Registered queries on the corpus, the access policy, the request logs and corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vectors as vec
from ..operators import access, corpus, feedback, gates, ledger
from ..session import cut_lineage, scratch
from ..sources import policies, readers, tables
from . import nearest
from .sqlbase import with_

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
POLICY = policies.AccessPolicy()


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def values(rows) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return "(VALUES " + ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows) + ")"


# Corpus

DOCS = """docs AS (
  SELECT doc_id AS id, substring(text, 1, 40) AS title, source AS category,
         list_extract(['Public', 'Internal', 'Confidential', 'Restricted'], CAST(doc_id % 4 + 1 AS INTEGER)) AS sensitivity, text AS content FROM documents)"""
SEARCHES = [("license", None), ("The ", None), ("que", "SRC1"), ("über", None), ("@", None), ("mit", "src3"), ("tion", None)]
ASKED = f"asked(q, cat) AS {values([(q.lower().strip(), c.lower() if c else None) for q, c in SEARCHES])}"
SEARCH = f"""{DOCS}, {ASKED},
scored AS (
  SELECT id, title, category, sensitivity, q AS query, cat AS category_filter, instr(lower(content), q) AS hit, content,
         (length(title) - length(replace(lower(title), q, ''))) // length(q) * 3 + (length(content) - length(replace(lower(content), q, ''))) // length(q) AS match_score
  FROM docs, asked WHERE cat IS NULL OR lower(category) = cat),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query, category_filter ORDER BY match_score DESC, id) AS rank,
         count(*) OVER (PARTITION BY query, category_filter) AS match_count FROM scored WHERE match_score > 0),
results AS (
  SELECT id, title, category, sensitivity, query, category_filter, match_score, rank, match_count,
         CASE WHEN hit > 0 THEN regexp_replace(substring(content, greatest(hit - 80, 1), hit + 300 - greatest(hit - 80, 1)), '^\\s+|\\s+$', '', 'g')
              ELSE substring(content, 1, 300) END AS snippet FROM ranked WHERE rank <= 5)"""


@query("doc_search", with_(SEARCH, "SELECT * FROM results"))
def doc_search(spark, d):
    return corpus.search(tables.corpus(spark, d), SEARCHES)


@query("doc_search_json", with_(SEARCH, "SELECT CAST(id AS VARCHAR) AS id, title, category, query, category_filter, match_score, match_count, rank, snippet FROM results"))
def doc_search_json(spark, d):
    """The corpus written as JSON, one document per line, read back and searched; ids are texts of equal length there."""
    path = scratch(spark, "corpus")
    tables.corpus(spark, d).withColumn("id", F.lpad(F.col("id").cast("string"), 12, "0")).write.json(path)
    found = corpus.search(readers.documents_json(spark, path, one_document=False), SEARCHES)
    return found.select(F.coalesce(F.nullif(F.ltrim("id", F.lit("0")), F.lit("")), F.lit("0")).alias("id"), "title", "category", "query", "category_filter", "match_score", "match_count", "rank", "snippet")


WORDS = ["license", "in the", "über", " y los", "released under"]


@query(
    "doc_contains",
    with_(
        f"{DOCS}, asked(q) AS {values([(w.lower().strip(),) for w in WORDS])}",
        """SELECT query, id, title, snippet FROM (
             SELECT q AS query, id, title, replace(substring(content, 1, 500), chr(10), ' ') AS snippet, row_number() OVER (PARTITION BY q ORDER BY id) AS rn
             FROM docs, asked WHERE contains(lower(content || ' ' || title), q)) WHERE rn <= 5""",
    ),
)
def doc_contains(spark, d):
    return corpus.contains_first(tables.corpus(spark, d), WORDS)


PEOPLE = "people AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS department, CAST(c_acctbal AS DECIMAL(12,2)) AS salary FROM customer)"


@query(
    "entity_lookup",
    with_(PEOPLE, "SELECT id, name, department, CAST(salary AS VARCHAR) AS salary FROM people WHERE name ILIKE '%TOMER#00000012%' ORDER BY id LIMIT 5"),
)
def entity_lookup(spark, d):
    found = corpus.find_entity(tables.employees(spark, d), name="TOMER#00000012")
    return found.withColumn("salary", F.col("salary").cast("string"))


@query("entity_by_id", with_(PEOPLE, "SELECT id, name, department, CAST(salary AS VARCHAR) AS salary FROM people WHERE id = 77"))
def entity_by_id(spark, d):
    return corpus.find_entity(tables.employees(spark, d), entity_id=77).withColumn("salary", F.col("salary").cast("string"))


def _policy_rows() -> list[tuple[str, str, str]]:
    rows = []
    for section, body in policies.SPENDING_POLICY.items():
        for key, value in body.items():
            inner = value.items() if isinstance(value, dict) else [(None, value)]
            for sub, v in inner:
                text = str(v).lower() if isinstance(v, bool) else str(v)
                rows.append((section, f"{key}.{sub}" if sub else key, text))
    return rows


RULES = f"rules(section, key, value) AS {values(_policy_rows())}"


@query(
    "policy_rules",
    with_(
        RULES,
        """SELECT section, key, value, count(o_orderkey) AS orders_within FROM rules LEFT JOIN orders ON section = 'expense'
             AND starts_with(key, 'approval_limits.') AND o_totalprice <= TRY_CAST(value AS DOUBLE) GROUP BY 1, 2, 3""",
    ),
)
def policy_rules(spark, d):
    """Every policy value, with the number of orders an approver of that limit may sign."""
    rules = policies.policy_rules(spark)
    limits = rules.where((F.col("section") == "expense") & F.startswith("key", F.lit("approval_limits.")))
    bounds = limits.agg(F.collect_list(F.struct("key", F.col("value").try_cast("double").alias("limit")))).scalar()
    price = tables.table(spark, d, "orders").select("o_totalprice").withColumn("_limits", bounds)
    reached = F.filter("_limits", lambda x: F.col("o_totalprice") <= x["limit"])
    within = price.select(F.explode(reached).alias("r")).groupBy(F.col("r.key").alias("key")).agg(F.count("*").alias("n"))
    return rules.join(within, "key", "left").select(
        "section", "key", "value", F.coalesce("n", F.lit(0)).cast("bigint").alias("orders_within")
    )


TOPIC_NAMES = ["approval_limits", "Approval", "travel", "per_diem", "meals", "deadline", "pto", "compensation", "all", "bogus"]
LIMIT_ROLES = ["ic3", "VP", "manager", None]


def topic_requests(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    topic = F.element_at(F.array(*[F.lit(t) for t in TOPIC_NAMES]), (F.pmod(key, F.lit(len(TOPIC_NAMES))) + 1).cast("int"))
    role = F.element_at(F.array(*[F.lit(t) for t in LIMIT_ROLES]), (F.pmod(key, F.lit(len(LIMIT_ROLES))) + 1).cast("int"))
    return tables.table(spark, d, "customer").select(key.alias("request_id"), topic.alias("topic"), role.alias("role"))


@query(
    "policy_lookup",
    with_(
        f"""{RULES}, topics(topic, section, prefix) AS {values(policies.TOPICS)},
        requests AS (SELECT c_custkey AS request_id, list_extract({TOPIC_NAMES}, CAST(c_custkey % 10 + 1 AS INTEGER)) AS topic,
                            list_extract(['ic3', 'VP', 'manager', NULL], CAST(c_custkey % 4 + 1 AS INTEGER)) AS role FROM customer)""",
        """SELECT request_id, r.topic, role, CASE WHEN t.topic IS NULL THEN 'available_topics' ELSE u.key END AS key,
             CASE WHEN t.topic IS NULL THEN 'approval_limits,travel_limits,per_diem,submission_deadline,pto,compensation,all' ELSE u.value END AS value
           FROM requests r LEFT JOIN topics t ON t.topic = lower(r.topic)
                LEFT JOIN rules u ON u.section = t.section AND starts_with(u.key, t.prefix)
                     AND (lower(r.topic) NOT IN ('approval_limits', 'approval') OR role IS NULL OR u.key = 'approval_limits.' || lower(role))""",
    ),
)
def policy_lookup(spark, d):
    return corpus.policy_lookup(topic_requests(spark, d), policies.policy_rules(spark))


TOOLS = ["employee_lookup", "policy_search", "expense_query"]


def transcript(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns that call a tool: the arguments come from the turn."""
    c = tables.table(spark, d, "conversations")
    tool = F.element_at(F.array(*[F.lit(t) for t in [*TOOLS, "other_tool"]]), (F.pmod("turn", F.lit(4)) + 1).cast("int"))
    call = F.concat(
        F.lit("Let me check.\nTOOL:  "), tool, F.lit("\nARGS: query = "), F.replace("text", F.lit("\n"), F.lit(" ")),
        F.lit(" , limit=3,conv="), F.col("conv_id").cast("string"), F.lit(",noise"),
    )
    return c.select("conv_id", "turn", F.when(F.col("role") == "assistant", call).otherwise(F.col("text")).alias("text"))


@query(
    "tool_call_parse",
    """WITH t AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'Let me check.' || chr(10) || 'TOOL:  ' ||
          list_extract(['employee_lookup', 'policy_search', 'expense_query', 'other_tool'], CAST(turn % 4 + 1 AS INTEGER)) || chr(10) || 'ARGS: query = ' ||
          replace(text, chr(10), ' ') || ' , limit=3,conv=' || conv_id || ',noise' ELSE text END AS text FROM conversations),
       p AS (SELECT *, regexp_extract(text, 'TOOL:\\s*([a-zA-Z_]+)', 1) AS tool,
               list_transform(list_filter(string_split(regexp_extract(text, 'ARGS:\\s*(.+)', 1), ','), lambda x: contains(x, '=')), lambda x: trim(x)) AS parts FROM t)
       SELECT conv_id, turn, tool,
         trim(list_extract(list_transform(list_filter(parts, lambda x: starts_with(x, 'query')), lambda x: substring(x, instr(x, '=') + 1)), -1)) AS query,
         trim(list_extract(list_transform(list_filter(parts, lambda x: starts_with(x, 'limit')), lambda x: substring(x, instr(x, '=') + 1)), -1)) AS "limit",
         trim(list_extract(list_transform(list_filter(parts, lambda x: starts_with(x, 'conv')), lambda x: substring(x, instr(x, '=') + 1)), -1)) AS conv
       FROM p WHERE tool IN ('employee_lookup', 'policy_search', 'expense_query')""",
)
def tool_call_parse(spark, d):
    calls = corpus.tool_calls(transcript(spark, d), TOOLS)
    return calls.select("conv_id", "turn", "tool", *[F.col("args")[k].alias(k) for k in ("query", "limit", "conv")])


# Access

CAPS = f"caps(role, capability, allowed) AS {values([(r, c, str(a)) for r, own in policies.CAPABILITIES.items() for c, a in own.items()])}"


def _pick(options: list[str], number) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(number, F.lit(len(options))) + 1).cast("int"))


ASK_ROLES = [*tables.ROLES, "intern"]
ASK_CAPS = [*policies.CAPABILITIES["engineer"], "launch_rocket"]
ASK_FIELDS = [*policies.FIELD_VISIBILITY, "nickname"]


@query(
    "has_permission",
    with_(
        f"""{CAPS}, requests AS (SELECT event_id, list_extract({ASK_ROLES}, CAST(user_id % 6 + 1 AS INTEGER)) AS role,
              list_extract({ASK_CAPS}, CAST(event_id % 12 + 1 AS INTEGER)) AS capability FROM events)""",
        "SELECT event_id, role, capability, coalesce(CAST(allowed AS BOOLEAN), false) AS allowed FROM requests LEFT JOIN caps USING (role, capability)",
    ),
)
def has_permission(spark, d):
    e = tables.table(spark, d, "events")
    asked = e.select("event_id", _pick(ASK_ROLES, F.col("user_id")).alias("role"), _pick(ASK_CAPS, F.col("event_id")).alias("capability"))
    return access.has_permission(asked, POLICY).select("event_id", "role", "capability", "allowed")


FIELDS = f"seen(field, role) AS {values([(f, r) for f, rs in policies.FIELD_VISIBILITY.items() for r in rs])}"
FIELD_REQUESTS = f"""freq AS (SELECT event_id, list_extract({ASK_ROLES}, CAST(user_id % 6 + 1 AS INTEGER)) AS role,
              list_extract({ASK_FIELDS}, CAST(event_id % 6 + 1 AS INTEGER)) AS field FROM events)"""


def field_requests(spark, d) -> DataFrame:
    e = tables.table(spark, d, "events")
    return e.select("event_id", _pick(ASK_ROLES, F.col("user_id")).alias("role"), _pick(ASK_FIELDS, F.col("event_id")).alias("field"))


@query(
    "field_access",
    with_(
        f"{FIELDS}, {FIELD_REQUESTS}",
        """SELECT event_id, f.role, f.field, f.field NOT IN (SELECT field FROM seen) OR s.role IS NOT NULL AS allowed,
             f.field IN (SELECT field FROM seen) AS audited FROM freq f LEFT JOIN seen s ON s.field = f.field AND s.role = f.role""",
    ),
)
def field_access(spark, d):
    return access.can_view_field(field_requests(spark, d), POLICY).select("event_id", "role", "field", "allowed", "audited")


TIERS = f"tiers(tier, role) AS {values([(t.lower(), r) for t, rs in policies.TIER_ROLES.items() for r in rs])}"
CHECKS = f"""{DOCS}, {TIERS},
tagged AS (SELECT * REPLACE (CASE id % 10 WHEN 0 THEN NULL WHEN 1 THEN 'Secret' WHEN 2 THEN '' WHEN 3 THEN '   ' ELSE sensitivity END AS sensitivity) FROM docs),
checks AS (SELECT id, r.role, sensitivity, t.role IS NOT NULL AS allowed FROM tagged, (SELECT DISTINCT role FROM caps) r
           LEFT JOIN tiers t ON t.tier = lower(coalesce(nullif(sensitivity, ''), 'Public')) AND t.role = r.role)"""


def tagged_corpus(spark, d) -> DataFrame:
    """The corpus with some documents without a tier, of an unknown one and of a blank one."""
    k = F.col("id") % 10
    tag = F.when(k == 0, F.lit(None).cast("string")).when(k == 1, "Secret").when(k == 2, "").when(k == 3, "   ").otherwise(F.col("sensitivity"))
    return tables.corpus(spark, d).withColumn("sensitivity", tag)


@query("doc_access", with_(f"{CAPS}, {CHECKS}", "SELECT id, role, allowed FROM checks"))
def doc_access(spark, d):
    return access.document_checks(tagged_corpus(spark, d), POLICY).select("id", "role", "allowed")


@query("doc_filter", with_(f"{CAPS}, {CHECKS}", "SELECT id, sensitivity FROM checks WHERE role = 'hr' AND allowed"))
def doc_filter(spark, d):
    return access.visible_documents(tagged_corpus(spark, d), "hr", POLICY).select("id", "sensitivity")


AUDIT_AT = "2024-02-01 00:00:00"


@query(
    "audit_log",
    with_(
        f"{CAPS}, {CHECKS}, {FIELDS}, {FIELD_REQUESTS}",
        f"""SELECT TIMESTAMP '{AUDIT_AT}' AS timestamp, role, 'document:' || id AS resource, allowed, NULL AS field,
              lower(coalesce(nullif(sensitivity, ''), 'Public')) AS sensitivity FROM checks
            UNION ALL SELECT TIMESTAMP '{AUDIT_AT}', f.role, 'field:' || f.field, s.role IS NOT NULL, f.field, NULL
            FROM freq f LEFT JOIN seen s ON s.field = f.field AND s.role = f.role WHERE f.field IN (SELECT field FROM seen)""",
    ),
)
def audit_log(spark, d):
    documents = access.audit_rows(access.document_checks(tagged_corpus(spark, d), POLICY), AUDIT_AT)
    return documents.unionByName(access.field_audit_rows(access.can_view_field(field_requests(spark, d), POLICY), AUDIT_AT))


@query(
    "secure_search",
    with_(
        f"{CAPS}, {SEARCH}, {TIERS}",
        """SELECT query, category_filter, rank, id, r.role, t.role IS NOT NULL AS allowed, match_score
           FROM results, (SELECT DISTINCT role FROM caps) r LEFT JOIN tiers t ON t.tier = lower(sensitivity) AND t.role = r.role""",
    ),
)
def secure_search(spark, d):
    found = access.secure_search(tables.corpus(spark, d), SEARCHES, POLICY)
    return found.select("query", "category_filter", "rank", "id", "role", "allowed", "match_score")


def _seen_sql(field: str, shown: str, hidden: str) -> str:
    """What a role reads: the value, or what the redaction leaves of it."""
    return f"CASE WHEN role IN ({', '.join(repr(r) for r in policies.FIELD_VISIBILITY[field])}) THEN {shown} ELSE {hidden} END"


def _redacted_sql(prose: bool) -> str:
    """The redacted answers, put together from the customer's columns."""
    money, key = "CAST(c_acctbal AS DECIMAL(12,2))", "c_custkey"
    if prose:
        parts = [
            "'The '", _seen_sql("salary", f"'salary is $' || {money} || ','", "'salary: [REDACTED]'"),
            "' '", _seen_sql("ssn", f"'SSN 123-45-' || {key}", "'SSN: [REDACTED]'"),
            "' and '", _seen_sql("address", f"'address: ' || {key}", "'address: [REDACTED]'"),
            "' Main; '", _seen_sql("compensation", "'compensation of 7.'", "'compensation: [REDACTED]'"),
        ]
    else:
        parts = [
            "'{\"name\": \"' || c_name || '\", '", _seen_sql("salary", f"'\"salary\": ' || {money}", "'\"salary\": \"[REDACTED]\"'"),
            "', '", _seen_sql("ssn", f"'\"ssn\" : \"12-' || {key} || '\\\"x\"'", "'\"ssn\": \"[REDACTED]\"'"),
            "'}' || chr(10)", _seen_sql("salary", f"'salary: ' || {key}", "'salary: [REDACTED]'"),
            "', '", _seen_sql("address", f"'address: Main St ' || {key}", f"'address: [REDACTED] St ' || {key}"),
        ]
    body = " || ".join(parts)
    return f"SELECT c_custkey, role, {body} AS answer FROM (SELECT *, list_extract({ASK_ROLES}, CAST(c_custkey % 6 + 1 AS INTEGER)) AS role FROM customer)"


def _answers(spark, d, prose: bool) -> DataFrame:
    money, key = F.col("c_acctbal").cast("decimal(12,2)").cast("string"), F.col("c_custkey").cast("string")
    if prose:
        answer = F.concat(F.lit("The salary is $"), money, F.lit(", SSN 123-45-"), key, F.lit(" and address: "), key, F.lit(" Main; compensation of 7."))
    else:
        answer = F.concat(
            F.lit('{"name": "'), F.col("c_name"), F.lit('", "salary": '), money, F.lit(', "ssn" : "12-'), key, F.lit('\\"x"}\nsalary: '), key,
            F.lit(", address: Main St "), key,
        )
    return tables.table(spark, d, "customer").select("c_custkey", _pick(ASK_ROLES, F.col("c_custkey")).alias("role"), answer.alias("answer"))


@query("redact_json", _redacted_sql(False))
def redact_json(spark, d):
    redacted = tx.redact_json(F.col("role"), F.col("answer"), POLICY.hidden(), POLICY.hidden_fields(None))
    return _answers(spark, d, False).withColumn("answer", redacted)


@query("redact_prose", _redacted_sql(True))
def redact_prose(spark, d):
    redacted = tx.redact_prose(F.col("role"), F.col("answer"), POLICY.hidden(), POLICY.hidden_fields(None))
    return _answers(spark, d, True).withColumn("answer", redacted)


# Query log, costs, cache

LOG = f"""log AS (
  SELECT u.conv_id * 1000 + u.turn AS query_id, TIMESTAMP '2024-01-01' + to_minutes(u.conv_id * 10 + u.turn) AS ts, 'user' || u.conv_id % 20 AS user_id,
         list_extract({tables.ROLES}, CAST(u.conv_id % 5 + 1 AS INTEGER)) AS user_role, u.text AS query, coalesce(a.text, '') AS answer,
         length(u.text) // 4 AS input_tokens, length(coalesce(a.text, '')) // 4 AS output_tokens
  FROM conversations u LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role <> 'user' WHERE u.role = 'user')"""
PRICE_SQL = f"prices(model, pin, pout) AS {values(policies.PRICES)}"
MODEL_SQL = "list_extract(['gemini-2.5-pro', 'gemini-1.5-flash', 'gemini-2.5-flash'], CAST(query_id % 3 + 1 AS INTEGER))"
COST_SQL = "(input_tokens / 1e6 * CAST(coalesce(pin, 0.075) AS DOUBLE) + output_tokens / 1e6 * CAST(coalesce(pout, 0.30) AS DOUBLE))"
PRICED = f"""{LOG}, {PRICE_SQL}, modelled AS (SELECT *, {MODEL_SQL} AS model FROM log),
priced AS (SELECT modelled.*, {COST_SQL} AS cost FROM modelled LEFT JOIN prices USING (model))"""


def priced(spark, d) -> DataFrame:
    models = ["gemini-2.5-pro", "gemini-1.5-flash", "gemini-2.5-flash"]
    log = tables.query_log(spark, d).withColumn("model", _pick(models, F.col("query_id")))
    return ledger.with_token_cost(log, policies.prices(spark))


@query(
    "query_log",
    with_(LOG, "SELECT query_id, ts, user_id, user_role, query, substring(answer, 1, 500) AS answer, input_tokens, output_tokens FROM log"),
)
def query_log(spark, d):
    return tables.query_log(spark, d).withColumn("answer", F.substring("answer", 1, tx.ANSWER_LOG_CHARS))


@query("token_cost", with_(PRICED, "SELECT query_id, model, round(cost, 12) AS cost FROM priced"))
def token_cost(spark, d):
    return priced(spark, d).select("query_id", "model", F.round("cost", 12).alias("cost"))


def _complex_sql(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{w.replace(chr(39), chr(39) * 2)}')" for w in words) + ")"


@query(
    "model_routing",
    f"""SELECT doc_id, CASE WHEN {_complex_sql('text', tx.COMPLEX_KEYWORDS)} THEN 'gemini-2.5-flash' ELSE 'gemini-2.5-flash-lite' END AS model,
          CASE WHEN {_complex_sql('text', tx.COMPLEX_KEYWORDS_B)} THEN 'gemini-2.5-flash' ELSE 'gemini-2.5-flash-lite' END AS model_b FROM documents""",
)
def model_routing(spark, d):
    t = F.col("text")
    return tables.table(spark, d, "documents").select(
        "doc_id", tx.route_model(t).alias("model"), tx.route_model(t, tx.COMPLEX_KEYWORDS_B).alias("model_b")
    )


@query(
    "response_compress",
    """SELECT conv_id, turn, CASE WHEN length(text) > 1000 THEN substring(text, 1, 1000) || chr(10) || '[...compressed: ' || (length(text) - 1000) || ' chars truncated...]' ELSE text END AS answer,
         greatest(length(text) - 1000, 0) AS saved FROM conversations""",
)
def response_compress(spark, d):
    t = F.col("text")
    return tables.table(spark, d, "conversations").select(
        "conv_id", "turn", tx.compress(t).alias("answer"), tx.chars_saved(t).cast("bigint").alias("saved")
    )


@query("retrieval_cap", "SELECT p_partkey, least(CAST(p_size AS BIGINT), 3) AS docs FROM part")
def retrieval_cap(spark, d):
    return tables.table(spark, d, "part").select("p_partkey", ledger.retrieval_limit(F.col("p_size")).alias("docs"))


LEDGER = """raw AS (SELECT event_id, user_id, ts, event_type, CASE WHEN event_type = 'view' THEN value END AS retrieval_cost,
    CASE WHEN event_type = 'purchase' THEN value END AS llm_cost, CASE WHEN event_type = 'click' THEN value END AS tool_cost,
    CASE WHEN event_type = 'error' THEN value END AS error_cost, CASE WHEN event_id % 10 = 0 THEN value * 2 END AS given FROM events),
  ledger AS (SELECT event_id, user_id, ts, event_type, coalesce(retrieval_cost, 0) AS retrieval_cost, coalesce(llm_cost, 0) AS llm_cost, coalesce(tool_cost, 0) AS tool_cost,
    coalesce(error_cost, 0) AS error_cost, coalesce(given, coalesce(retrieval_cost, 0) + coalesce(llm_cost, 0) + coalesce(tool_cost, 0) + coalesce(error_cost, 0)) AS total_cost FROM raw)"""


def cost_ledger_frame(spark, d) -> DataFrame:
    e = tables.table(spark, d, "events")
    kind, v = F.col("event_type"), F.col("value")
    parts = {"retrieval_cost": "view", "llm_cost": "purchase", "tool_cost": "click", "error_cost": "error"}
    raw = e.select(
        "event_id", "user_id", "ts", "event_type", *[F.when(kind == t, v).alias(c) for c, t in parts.items()],
        F.when(F.col("event_id") % 10 == 0, v * 2).alias("total_cost"),
    )
    return ledger.ledger_entries(raw)


@query("cost_ledger", with_(LEDGER, "SELECT event_id, retrieval_cost, llm_cost, tool_cost, error_cost, total_cost FROM ledger"))
def cost_ledger(spark, d):
    return cost_ledger_frame(spark, d).select("event_id", *ledger.PARTS, "total_cost")


BREAKDOWN = ["retrieval_total", "llm_total", "tool_total", "error_total", "total_daily"]


@query(
    "cost_breakdown",
    with_(
        LEDGER,
        """SELECT round(sum(retrieval_cost), 4) AS retrieval_total, round(sum(llm_cost), 4) AS llm_total, round(sum(tool_cost), 4) AS tool_total,
             round(sum(error_cost), 4) AS error_total, round(sum(total_cost), 4) AS total_daily, count(*) AS query_count FROM ledger""",
    ),
)
def cost_breakdown(spark, d):
    return ledger.cost_breakdown(cost_ledger_frame(spark, d)).withColumns({c: F.round(c, 4) for c in BREAKDOWN})


@query(
    "query_metrics",
    with_(
        PRICED,
        """SELECT count(*) AS total_queries, round(sum(cost), 9) AS total_cost, round(avg(cost), 9) AS avg_cost_per_query,
             CAST(sum(input_tokens) AS BIGINT) AS total_input_tokens, CAST(sum(output_tokens) AS BIGINT) AS total_output_tokens FROM priced""",
    ),
)
def query_metrics(spark, d):
    return ledger.query_metrics(priced(spark, d)).withColumns({c: F.round(c, 9) for c in ("total_cost", "avg_cost_per_query")})


@query(
    "cost_spikes",
    with_(
        LEDGER,
        """, s AS (SELECT avg(total_cost) AS m, stddev_pop(total_cost) AS sd, count(*) AS n FROM ledger)
        SELECT event_id, total_cost FROM ledger, s WHERE n >= 3 AND sd > 0 AND total_cost > m + 2.0 * sd""".lstrip(),
    ),
)
def cost_spikes(spark, d):
    return ledger.cost_spikes(cost_ledger_frame(spark, d)).select("event_id", "total_cost")


@query(
    "costs_by_key",
    with_(
        LEDGER,
        """SELECT 'day' AS grouping, CAST(CAST(ts AS DATE) AS VARCHAR) AS item, count(*) AS queries, round(sum(total_cost), 4) AS cost FROM ledger GROUP BY 2
           UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR), count(*), round(sum(total_cost), 4) FROM ledger GROUP BY 2
           UNION ALL SELECT 'event_type', event_type, count(*), round(sum(total_cost), 4) FROM ledger GROUP BY 2
           UNION ALL SELECT 'all', 'all', count(*), round(sum(total_cost), 4) FROM ledger""",
    ),
)
def costs_by_key(spark, d):
    rows = cost_ledger_frame(spark, d).withColumn("day", F.to_date("ts"))
    return ledger.costs_by(rows, ["day", "user_id", "event_type"]).withColumn("cost", F.round("cost", 4))


AGAIN = LOG + """, asked AS (SELECT * REPLACE (CASE WHEN (query_id // 1000) % 4 = 0 THEN 'Explain: ' || query ELSE query END AS query) FROM log),
again AS (SELECT * FROM asked UNION ALL
          SELECT * REPLACE (query_id + 1000000000 AS query_id, ts + INTERVAL 400 DAY AS ts, '  ' || query || chr(10) AS query, answer || ' (again)' AS answer)
          FROM asked WHERE query_id % 3 = 0)"""


def repeated_log(spark, d) -> DataFrame:
    """The query log with every third question asked a second time, more than a year later and with white space
    around it. One conversation in four asks for an explanation, which is a question for the capable model."""
    explain = F.floor(F.col("query_id") / 1000) % 4 == 0
    asked = tables.query_log(spark, d).withColumn("query", F.when(explain, F.concat(F.lit("Explain: "), "query")).otherwise(F.col("query")))
    again = asked.where(F.col("query_id") % 3 == 0).withColumns(
        {
            "query_id": F.col("query_id") + 1_000_000_000,
            "ts": F.col("ts") + F.expr("INTERVAL '400' DAY"),
            "query": F.concat(F.lit("  "), "query", F.lit("\n")),
            "answer": F.concat("answer", F.lit(" (again)")),
        }
    )
    return asked.unionByName(again)


REPLAY = AGAIN + """, keyed AS (SELECT *, lower(regexp_replace(query, '^\\s+|\\s+$', '', 'g')) AS cache_key FROM again),
replay AS (SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY ts, query_id) > 1 AS hit,
             first_value(answer) OVER (PARTITION BY cache_key ORDER BY ts, query_id) AS first_answer FROM keyed)"""


@query("cache_replay", with_(REPLAY, "SELECT query_id, cache_key, hit, CASE WHEN hit THEN first_answer END AS cached_response FROM replay"))
def cache_replay(spark, d):
    return ledger.cache_replay(repeated_log(spark, d)).select("query_id", "cache_key", "hit", "cached_response")


@query(
    "cache_impact",
    with_(
        REPLAY,
        f"""SELECT count(*) AS total_queries, count(*) FILTER (WHERE NOT hit) AS cache_misses, count(*) FILTER (WHERE NOT hit AND {_complex_sql('cache_key', tx.COMPLEX_KEYWORDS)}) AS capable_choices,
              count(*) FILTER (WHERE NOT hit AND NOT {_complex_sql('cache_key', tx.COMPLEX_KEYWORDS)}) AS cheap_choices,
              count(*) FILTER (WHERE length(answer) > 1000) AS responses_compressed, CAST(sum(greatest(length(answer) - 1000, 0)) AS BIGINT) AS compression_chars_saved,
              count(*) FILTER (WHERE hit) AS cache_exact_hits, CAST(0 AS BIGINT) AS cache_semantic_hits, round(count(*) FILTER (WHERE hit) / count(*), 9) AS cache_hit_rate,
              round(count(*) FILTER (WHERE NOT hit AND NOT {_complex_sql('cache_key', tx.COMPLEX_KEYWORDS)}) / greatest(count(*) FILTER (WHERE NOT hit), 1), 9) AS cheap_share,
              round_even(count(*) FILTER (WHERE hit) / count(*) * 100, 1) AS total_savings_pct FROM replay""",
    ),
)
def cache_impact(spark, d):
    return ledger.cache_impact(repeated_log(spark, d)).withColumns({c: F.round(c, 9) for c in ("cache_hit_rate", "cheap_share")})


STEPS = [("first", 0), ("blurred", 6), ("blurred", 6), ("faint", 12), ("first", 0), ("faint", 12)]


def _hybrid_sql() -> str:
    """The replay step by step: in a step every vector asks once, and vectors of different ids are never similar."""
    rows = ", ".join(f"({i}, '{name}', {lost})" for i, (name, lost) in enumerate(STEPS))
    out = f"""vlog AS (SELECT CAST(step AS BIGINT) * 1000000000 + vec_id AS query_id, step, CASE WHEN vec_id % 2 = 0 THEN 'why ' ELSE 'what ' END || name || ' ' || vec_id AS query,
  repeat('answer ' || step || ' ', CAST(vec_id % 200 AS INTEGER)) AS answer, CAST(vec_id % 50 AS BIGINT) AS input_tokens, CAST(vec_id % 70 AS BIGINT) AS output_tokens,
  list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: CASE WHEN i <= lost THEN 0.0 ELSE x END) AS v
  FROM embeddings, (VALUES {rows}) s(step, name, lost)),
cache0 AS (SELECT query_id, query, v, answer FROM vlog WHERE false)"""
    for i in range(len(STEPS)):
        out += f""",
sim{i} AS (SELECT r.query_id, c.query_id AS other, c.answer, list_cosine_similarity(r.v, c.v) AS sim FROM vlog r, cache{i} c WHERE r.step = {i}),
best{i} AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, other) AS rn FROM sim{i} WHERE sim >= {nearest.THRESHOLD}),
out{i} AS (SELECT r.*, CASE WHEN e.query_id IS NOT NULL THEN 'exact_hit' WHEN b.other IS NOT NULL THEN 'semantic_hit' ELSE 'miss' END AS outcome,
  coalesce(e.answer, b.answer) AS cached_response, CASE WHEN e.query_id IS NULL THEN round(b.sim, 6) END AS similarity
  FROM vlog r LEFT JOIN cache{i} e ON e.query = r.query LEFT JOIN best{i} b ON b.query_id = r.query_id AND b.rn = 1 WHERE r.step = {i}),
cache{i + 1} AS (SELECT * FROM cache{i} UNION ALL SELECT query_id, query, v, answer FROM out{i} WHERE outcome = 'miss')"""
    return out + ", hybrid AS (" + " UNION ALL ".join(f"SELECT * FROM out{i}" for i in range(len(STEPS))) + ")"


HYBRID = _hybrid_sql()


def vector_log(spark, d) -> DataFrame:
    """Every embedding asks six times: whole, with six and with twelve numbers lost. The blurred question is close to the
    whole one, the faint one to the blurred but not to the whole one."""
    e = tables.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), F.lit(lost).alias("lost")) for i, (n, lost) in enumerate(STEPS)])
    rows = e.select("vec_id", "e", F.explode(steps).alias("s")).select("vec_id", "e", "s.*")
    word = F.when(F.col("vec_id") % 2 == 0, "why ").otherwise("what ")
    return rows.select(
        (F.col("step") * F.lit(1_000_000_000).cast("bigint") + F.col("vec_id")).alias("query_id"),
        F.concat(word, "name", F.lit(" "), F.col("vec_id").cast("string")).alias("query"),
        F.repeat(F.concat(F.lit("answer "), F.col("step").cast("string"), F.lit(" ")), (F.col("vec_id") % 200).cast("int")).alias("answer"),
        (F.col("vec_id") % 50).alias("input_tokens"),
        (F.col("vec_id") % 70).alias("output_tokens"),
        F.transform("e", lambda x, i: F.when(i < F.col("lost"), F.lit(0.0)).otherwise(x)).alias("v"),
    )


def hybrid(spark, d, responses: bool = True) -> DataFrame:
    """The vector log answered by exact key first, then by the most similar cached question."""
    return ledger.hybrid_replay(vector_log(spark, d), F.col("v"), responses=responses)


@query("cache_hybrid", with_(HYBRID, "SELECT query_id, outcome, cached_response, similarity FROM hybrid"))
def cache_hybrid(spark, d):
    return hybrid(spark, d).select("query_id", "outcome", "cached_response", F.round("similarity", 6).alias("similarity"))


@query("cache_outcomes", with_(HYBRID, "SELECT outcome, count(*) AS n, round(count(*) / (SELECT count(*) FROM hybrid), 9) AS share FROM hybrid GROUP BY 1"))
def cache_outcomes(spark, d):
    counts = cut_lineage(hybrid(spark, d, responses=False).groupBy("outcome").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.round(F.col("n") / total, 9))


@query(
    "cache_impact_hybrid",
    with_(
        HYBRID,
        f"""SELECT count(*) AS total_queries, count(*) FILTER (WHERE outcome = 'miss') AS cache_misses, count(*) FILTER (WHERE outcome = 'semantic_hit') AS cache_semantic_hits,
              count(*) FILTER (WHERE outcome = 'miss' AND {_complex_sql('query', tx.COMPLEX_KEYWORDS)}) AS capable_choices,
              count(*) FILTER (WHERE outcome = 'miss' AND NOT {_complex_sql('query', tx.COMPLEX_KEYWORDS)}) AS cheap_choices,
              count(*) FILTER (WHERE length(answer) > 1000) AS responses_compressed, CAST(sum(greatest(length(answer) - 1000, 0)) AS BIGINT) AS compression_chars_saved,
              count(*) FILTER (WHERE outcome = 'exact_hit') AS cache_exact_hits, round(count(*) FILTER (WHERE outcome <> 'miss') / count(*), 9) AS cache_hit_rate,
              round(count(*) FILTER (WHERE outcome = 'miss' AND NOT {_complex_sql('query', tx.COMPLEX_KEYWORDS)}) / greatest(count(*) FILTER (WHERE outcome = 'miss'), 1), 9) AS cheap_share,
              round_even(count(*) FILTER (WHERE outcome <> 'miss') / count(*) * 100, 1) AS total_savings_pct FROM hybrid""",
    ),
)
def cache_impact_hybrid(spark, d):
    log = vector_log(spark, d)
    out = ledger.cache_impact(log, replay=ledger.hybrid_replay(log, F.col("v"), responses=False))
    return out.withColumns({c: F.round(c, 9) for c in ("cache_hit_rate", "cheap_share")})


@query(
    "eval_report_hybrid",
    with_(
        f"""{HYBRID}, {PRICE_SQL},
chosen AS (SELECT query_id, outcome <> 'miss' AS hit, CASE WHEN outcome <> 'miss' THEN '(cache)' WHEN {_complex_sql('query', tx.COMPLEX_KEYWORDS)} THEN 'gemini-2.5-flash' ELSE 'gemini-2.5-flash-lite' END AS model,
             CASE WHEN outcome <> 'miss' THEN 0 ELSE input_tokens END AS input_tokens, CASE WHEN outcome <> 'miss' THEN 0 ELSE output_tokens END AS output_tokens FROM hybrid),
ev AS (SELECT chosen.*, {COST_SQL} AS cost FROM chosen LEFT JOIN prices USING (model))""",
        """SELECT count(*) AS total_queries, count(*) FILTER (WHERE hit) AS cache_hits, round(count(*) FILTER (WHERE hit) / count(*), 9) AS cache_hit_rate,
             round(sum(cost), 9) AS total_cost, count(*) FILTER (WHERE model = 'gemini-2.5-flash') AS capable_choices,
             count(*) FILTER (WHERE model = 'gemini-2.5-flash-lite') AS cheap_choices, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
             CAST(sum(output_tokens) AS BIGINT) AS output_tokens FROM ev""",
    ),
)
def eval_report_hybrid(spark, d):
    log = vector_log(spark, d)
    replay = ledger.hybrid_replay(log, F.col("v"), responses=False)
    replay = cut_lineage(replay.select("query", "hit", "input_tokens", "output_tokens"))
    out = ledger.evaluation_report(ledger.evaluation(log, policies.prices(spark), replay)).drop("spikes")
    return out.withColumns({c: F.round(c, 9) for c in ("cache_hit_rate", "total_cost")})


EVAL = f"""{REPLAY}, {PRICE_SQL},
chosen AS (SELECT query_id, hit, CASE WHEN hit THEN '(cache)' WHEN {_complex_sql('query', tx.COMPLEX_KEYWORDS)} THEN 'gemini-2.5-flash' ELSE 'gemini-2.5-flash-lite' END AS model,
             CASE WHEN hit THEN 0 ELSE input_tokens END AS input_tokens, CASE WHEN hit THEN 0 ELSE output_tokens END AS output_tokens FROM replay),
ev AS (SELECT chosen.*, {COST_SQL} AS cost FROM chosen LEFT JOIN prices USING (model)),
st AS (SELECT avg(cost) AS m, stddev_pop(cost) AS sd, count(*) AS n FROM ev WHERE NOT hit)"""


@query(
    "eval_report",
    with_(
        EVAL,
        """SELECT count(*) AS total_queries, count(*) FILTER (WHERE hit) AS cache_hits, round(count(*) FILTER (WHERE hit) / count(*), 9) AS cache_hit_rate,
             round(sum(cost), 9) AS total_cost, count(*) FILTER (WHERE model = 'gemini-2.5-flash') AS capable_choices,
             count(*) FILTER (WHERE model = 'gemini-2.5-flash-lite') AS cheap_choices, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
             CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
             (SELECT count(*) FROM ev, st WHERE NOT hit AND n >= 3 AND sd > 0 AND cost > m + 2.0 * sd) AS spikes FROM ev""",
    ),
)
def eval_report(spark, d):
    out = ledger.evaluation_report(ledger.evaluation(repeated_log(spark, d), policies.prices(spark)))
    return out.withColumns({c: F.round(c, 9) for c in ("cache_hit_rate", "total_cost")})


@query("eval_queries", with_(EVAL, "SELECT query_id, hit, model, input_tokens, output_tokens, round(cost, 12) AS cost FROM ev"))
def eval_queries(spark, d):
    out = ledger.evaluation(repeated_log(spark, d), policies.prices(spark))
    return out.select("query_id", "hit", "model", "input_tokens", "output_tokens", F.round("cost", 12).alias("cost"))


# Gates

DAY = 86400
GATE_CAP = 3
REQUESTS = f"""req AS (SELECT event_id, user_id, ts, event_type, value AS cost, epoch_us(ts) AS us, list_extract({tables.ROLES}, CAST(user_id % 5 + 1 AS INTEGER)) AS user_role,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
rated AS (
  SELECT user_id, rn, event_id, true AS allowed, [us] AS kept FROM req WHERE rn = 1
  UNION ALL
  SELECT q.user_id, q.rn, q.event_id, len(list_filter(kept, lambda x: q.us - x < {DAY}000000)) < {GATE_CAP},
         CASE WHEN len(list_filter(kept, lambda x: q.us - x < {DAY}000000)) < {GATE_CAP} THEN list_append(list_filter(kept, lambda x: q.us - x < {DAY}000000), q.us)
              ELSE list_filter(kept, lambda x: q.us - x < {DAY}000000) END
  FROM rated r JOIN req q ON q.user_id = r.user_id AND q.rn = r.rn + 1)"""


def requests(spark, d) -> DataFrame:
    e = tables.table(spark, d, "events")
    return e.select("event_id", "user_id", "ts", F.col("value").alias("cost"), _pick(tables.ROLES, F.col("user_id")).alias("user_role"))


def recursive(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{body}"


@query("rate_limit", recursive(REQUESTS, "SELECT event_id, user_id, allowed FROM rated"))
def rate_limit(spark, d):
    """Three requests per user and day, sliding."""
    return gates.rate_limit(requests(spark, d), GATE_CAP, DAY).select("event_id", "user_id", "allowed")


@query(
    "remaining_quota",
    recursive(
        REQUESTS,
        f"""SELECT user_id, CAST(greatest(0, {GATE_CAP} - count(*) FILTER (WHERE allowed AND q.ts <= TIMESTAMP '2024-01-20' AND q.ts > TIMESTAMP '2024-01-20' - INTERVAL {DAY} SECOND)) AS BIGINT) AS remaining
            FROM rated JOIN req q USING (user_id, event_id) GROUP BY 1""",
    ),
)
def remaining_quota(spark, d):
    decided = gates.rate_limit(requests(spark, d), GATE_CAP, DAY)
    return gates.remaining_quota(decided, "2024-01-20", GATE_CAP, DAY)


BUDGETS = f"budgets(role, budget) AS {values(policies.ROLE_BUDGETS)}"


def _budget_sql(source: str) -> str:
    return f"""gated AS (SELECT s.*, coalesce(sum(cost) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
      budget FROM (SELECT * REPLACE (CAST(cost AS DECIMAL(18,6)) AS cost) FROM {source}) s LEFT JOIN budgets b ON b.role = s.user_role),
    judged AS (SELECT *, before <= CAST(coalesce(budget, 0) - 0.01 AS DECIMAL(18,6)) AS ok FROM gated)"""


@query("budget_gate", with_(f"{BUDGETS}, " + REQUESTS.split("rated AS")[0].rstrip().rstrip(",") + f", {_budget_sql('req')}", "SELECT event_id, user_id, ok AS allowed FROM judged"))
def budget_gate(spark, d):
    return gates.budget_gate(requests(spark, d), policies.role_budgets(spark)).select("event_id", "user_id", "allowed")


@query(
    "user_spending",
    with_(
        f"{BUDGETS}, " + REQUESTS.split("rated AS")[0].rstrip().rstrip(",") + f", {_budget_sql('req')}",
        """SELECT user_id, arg_max(user_role, (ts, event_id)) AS role, round(CAST(sum(cost) AS DOUBLE), 6) AS spent,
             round(greatest(0.0, CAST(any_value(budget) - sum(cost) AS DOUBLE)), 6) AS remaining FROM judged WHERE ok GROUP BY 1""",
    ),
)
def user_spending(spark, d):
    admitted = gates.budget_gate(requests(spark, d), policies.role_budgets(spark)).where("allowed")
    out = ledger.user_spending(admitted, policies.role_budgets(spark))
    return out.withColumns({c: F.round(c, 6) for c in ("spent", "remaining")})


@query(
    "guardrail_replay",
    recursive(
        f"{BUDGETS}, {REQUESTS}, passed AS (SELECT req.* REPLACE (CASE WHEN event_type = 'error' THEN 0 ELSE cost END AS cost) FROM req JOIN rated USING (user_id, event_id) WHERE allowed), {_budget_sql('passed')}",
        """SELECT event_id, user_id, CASE WHEN NOT allowed THEN 'rate_limit_exceeded' WHEN NOT ok THEN 'budget_exceeded' END AS rejected,
             CASE WHEN allowed AND ok THEN CAST(j.cost AS DOUBLE) ELSE 0.0 END AS charged,
             CASE WHEN allowed AND ok THEN CASE WHEN event_type = 'error' OR user_id % 5 > 0 THEN 'salary: ' || event_id || ', ok' ELSE 'salary: [REDACTED], ok' END END AS answer
           FROM rated LEFT JOIN judged j USING (user_id, event_id)""",
    ),
)
def guardrail_replay(spark, d):
    """Events of the kind 'error' are requests that failed; engineers (every fifth user) may not see a salary."""
    kinds = tables.table(spark, d, "events").select("event_id", F.when(F.col("event_type") == "error", F.lit("failed")).alias("error"))
    answer = F.concat(F.lit("salary: "), F.col("event_id").cast("string"), F.lit(", ok"))
    asked = requests(spark, d).join(kinds, "event_id").withColumn("answer", answer)
    out = gates.guardrail_replay(asked, policies.role_budgets(spark), GATE_CAP, DAY, policy=POLICY)
    return out.select("event_id", "user_id", "rejected", "charged", "answer")


# Vectors


@query(
    "hash_embed",
    """WITH h AS (SELECT doc_id, sha256(lower(text)) AS x FROM documents),
       v AS (SELECT doc_id, list_transform(range(0, 16), lambda i: CAST(('0x' || substring(x, CAST(i * 4 + 1 AS BIGINT), 4)) AS INTEGER) / 32767.5 - 1.0) AS v FROM h),
       n AS (SELECT doc_id, v, sqrt(list_sum(list_transform(v, lambda a: a * a))) AS n FROM v)
       SELECT doc_id, """ + ", ".join(f"round(v[{i + 1}] / n, 9) AS e{i}" for i in range(16)) + " FROM n",
)
def hash_embed(spark, d):
    docs = tables.table(spark, d, "documents").select("doc_id", vec.hash_embedding(F.col("text")).alias("v"))
    return docs.select("doc_id", *[F.round(F.col("v")[i], 9).alias(f"e{i}") for i in range(16)])


@query(
    "cosine_sim",
    """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
       SELECT a.vec_id, CASE WHEN a.vec_id % 50 = 0 THEN 0.0 ELSE round(list_cosine_similarity(a.v, b.v), 6) END AS similarity FROM e a JOIN e b ON b.vec_id = a.vec_id + 1""",
)
def cosine_sim(spark, d):
    """Similarity of each vector to its successor; some are cut short, and unequal lengths give 0."""
    e = tables.table(spark, d, "embeddings")
    cut = F.when(F.col("vec_id") % 50 == 0, F.slice("embedding", 1, 10)).otherwise(F.col("embedding"))
    following = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return e.select("vec_id", cut.alias("a")).join(following, "vec_id").select(
        "vec_id", F.round(vec.cosine(F.col("a"), F.col("b")), 6).alias("similarity")
    )


@query(
    "semantic_match",
    """WITH c AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
       q AS (SELECT vec_id AS query_id, list_transform(v, lambda x, i: CASE WHEN i <= 6 THEN 0.0 ELSE x END) AS v FROM c),
       s AS (SELECT query_id, vec_id, list_cosine_similarity(q.v, c.v) AS sim FROM q, c),
       r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rn FROM s WHERE sim >= 0.92)
       SELECT query_id, vec_id, round(sim, 6) AS similarity FROM r WHERE rn = 1""",
)
def semantic_match(spark, d):
    """Vectors with six numbers lost look for their best match among all cached vectors."""
    e = tables.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    blurred = F.transform("vector", lambda x, i: F.when(i < 6, F.lit(0.0)).otherwise(x))
    asked = e.select(F.col("vec_id").alias("query_id"), blurred.alias("vector"))
    return nearest.best_match(asked, e, "query_id", "vec_id").withColumn("similarity", F.round("similarity", 6))


@query("semantic_index", ORACLES["semantic_match"])
def semantic_index(spark, d):
    """The same search on a stored index: built from a third of the vectors, extended by the others in two parts."""
    e = tables.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    path = scratch(spark, "index")
    nearest.store_index(nearest.build_index(nearest.entries_of(e.where("vec_id % 3 = 0"), "vec_id")), path)
    for part in (1, 2):
        nearest.extend_index(spark, path, nearest.entries_of(e.where(F.col("vec_id") % 3 == part), "vec_id"), part)
    blurred = F.transform("vector", lambda x, i: F.when(i < 6, F.lit(0.0)).otherwise(x))
    asked = e.select(F.col("vec_id").alias("query_id"), blurred.alias("vector"))
    found = nearest.search_index(nearest.open_index(spark, path), asked, "query_id", "vec_id")
    return found.withColumn("similarity", F.round("similarity", 6))


@query(
    "semantic_match_earlier",
    f"""WITH c AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
                   UNION ALL SELECT vec_id + 1000000000, list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: CASE WHEN i <= 6 THEN 0.0 ELSE x END) FROM embeddings),
       s AS (SELECT a.vec_id AS query_id, b.vec_id, list_cosine_similarity(a.v, b.v) AS sim FROM c a JOIN c b ON b.vec_id < a.vec_id),
       r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rn FROM s WHERE sim >= {nearest.THRESHOLD})
       SELECT query_id, vec_id, round(sim, 6) AS similarity FROM r WHERE rn = 1""",
)
def semantic_match_earlier(spark, d):
    """Best earlier vector of each vector: the vectors, followed by themselves with six numbers lost."""
    e = tables.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    blurred = F.transform("vector", lambda x, i: F.when(i < 6, F.lit(0.0)).otherwise(x))
    e = e.unionByName(e.select((F.col("vec_id") + 1_000_000_000).alias("vec_id"), blurred.alias("vector")))
    asked = e.withColumnRenamed("vec_id", "query_id")
    out = nearest.best_match(asked, e, "query_id", "vec_id", query_order="query_id", cached_order="vec_id")
    return out.withColumn("similarity", F.round("similarity", 6))


# Corrections

CORRECTIONS = f"""corr AS (
  SELECT u.conv_id * 1000 + u.turn AS correction_id, list_extract({ASK_ROLES}, CAST(u.conv_id % 6 + 1 AS INTEGER)) AS user_role, u.text AS original_query,
         CASE WHEN u.conv_id % 11 > 0 THEN a.text END AS original_answer, CASE u.turn % 5 WHEN 0 THEN '  ' WHEN 1 THEN a.text || ' ' WHEN 2 THEN a.text || ' More.' WHEN 3 THEN 'No.' ELSE CASE WHEN u.conv_id % 2 = 0 THEN u.text END END AS corrected_answer
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1)"""
STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
NEW, OLD = STRIP.format("coalesce(corrected_answer, '')"), STRIP.format("coalesce(original_answer, '')")


def corrections(spark, d) -> DataFrame:
    """Every turn and the one after it as a question, its answer and a correction; some answers and corrections are NULL."""
    c = tables.table(spark, d, "conversations")
    following = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    k, old = F.col("turn") % 5, F.col("answer")
    new = (
        F.when(k == 0, F.lit("  ")).when(k == 1, F.concat(old, F.lit(" "))).when(k == 2, F.concat(old, F.lit(" More.")))
        .when(k == 3, F.lit("No.")).when(F.col("conv_id") % 2 == 0, F.col("text"))
    )
    return c.join(following, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("correction_id"),
        _pick(ASK_ROLES, F.col("conv_id")).alias("user_role"),
        F.col("text").alias("original_query"),
        F.when(F.col("conv_id") % 11 > 0, old).alias("original_answer"),
        new.alias("corrected_answer"),
    )


RULES_A = f"""{CORRECTIONS},
a AS (SELECT *, CASE WHEN {NEW} = '' THEN 'empty correction' WHEN {NEW} = {OLD} THEN 'correction identical to original' END AS reason FROM corr),
ra AS (SELECT *, reason IS NULL AS accepted, CASE WHEN reason IS NULL THEN user_role IN ('manager', 'hr', 'finance', 'executive') END AS validated FROM a)"""


@query("feedback_rules_a", with_(RULES_A, "SELECT correction_id, user_role, reason, accepted, validated FROM ra"))
def feedback_rules_a(spark, d):
    return feedback.intake_a(corrections(spark, d)).select("correction_id", "user_role", "reason", "accepted", "validated")


RULES_B = f"""{CORRECTIONS}, auth(role, level) AS {values(policies.AUTHORITY)},
rb AS (SELECT corr.*, CASE WHEN {NEW} = '' THEN 'empty correction' WHEN coalesce(level, 0) < 3 THEN 'role ''' || user_role || ''' lacks authority (need manager+)'
         WHEN length({NEW}) <= length({OLD}) THEN 'correction not more detailed than original' ELSE 'ok' END AS reason FROM corr LEFT JOIN auth ON role = user_role)"""


@query("feedback_rules_b", with_(RULES_B, "SELECT correction_id, user_role, reason, reason = 'ok' AS accepted FROM rb"))
def feedback_rules_b(spark, d):
    return feedback.intake_b(corrections(spark, d), policies.authority(spark)).select("correction_id", "user_role", "reason", "accepted")


STATE = f"{RULES_A}, st AS (SELECT correction_id, user_role, validated OR correction_id % 3 = 0 AS validated FROM ra WHERE accepted)"


def correction_state(spark, d) -> DataFrame:
    accepted = feedback.intake_a(corrections(spark, d)).where("accepted")
    approvals = corrections(spark, d).where(F.col("correction_id") % 3 == 0).select("correction_id")
    return feedback.state(accepted, approvals)


@query("feedback_state", with_(STATE, "SELECT correction_id, user_role, validated FROM st"))
def feedback_state(spark, d):
    return correction_state(spark, d).select("correction_id", "user_role", "validated")


@query(
    "feedback_state_b",
    with_(
        RULES_B,
        f"""SELECT correction_id, rb.user_role, correction_id % 3 = 0 AND coalesce(level, 0) >= 3 AND length({NEW}) > length({OLD}) AS validated
            FROM rb LEFT JOIN auth a ON a.role = rb.user_role""",
    ),
)
def feedback_state_b(spark, d):
    """Approvals of every third correction, refused or not: only those fit under rules B count."""
    taken = feedback.intake_b(corrections(spark, d), policies.authority(spark)).withColumn("validated", F.lit(False))
    approvals = corrections(spark, d).where(F.col("correction_id") % 3 == 0).select("correction_id")
    return feedback.state_b(taken, approvals, policies.authority(spark)).select("correction_id", "user_role", "validated")


@query(
    "feedback_metrics",
    with_(
        STATE,
        """SELECT coalesce(user_role, 'unknown') AS role, count(*) AS total_corrections, count(*) FILTER (WHERE validated) AS validated_corrections,
             round(count(*) FILTER (WHERE validated) / count(*), 9) AS validation_rate FROM st GROUP BY 1
           UNION ALL SELECT 'all', count(*), count(*) FILTER (WHERE validated), round(count(*) FILTER (WHERE validated) / count(*), 9) FROM st""",
    ),
)
def feedback_metrics(spark, d):
    return feedback.metrics(correction_state(spark, d)).withColumn("validation_rate", F.round("validation_rate", 9))


@query(
    "feedback_lengths",
    with_(
        RULES_B,
        """SELECT count(*) AS total_corrections, round_even(avg(CASE WHEN reason = 'ok' THEN 1 ELSE 0 END), 3) AS validation_rate,
             round_even(avg(length(corrected_answer)), 1) AS avg_correction_length FROM rb""",
    ),
)
def feedback_lengths(spark, d):
    return feedback.length_metrics(feedback.intake_b(corrections(spark, d), policies.authority(spark)))


@query(
    "feedback_patterns",
    with_(
        CORRECTIONS,
        """, t AS (SELECT list_filter(regexp_split_to_array(lower(original_query), '\\s+'), lambda w: w <> '') AS w FROM corr)
        SELECT array_to_string(w[1:3], ' ') AS pattern, count(*) AS "count" FROM t WHERE len(w) > 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""".lstrip(),
    ),
)
def feedback_patterns(spark, d):
    return feedback.top_patterns(corrections(spark, d))
