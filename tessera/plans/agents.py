"""Registered agent-trace (A), usage (U), conversation (T) and error-log (L) queries.

Derived inputs (all from the driver tables, see ``sources/driver.py``):
* evaluation items = distinct ``events.user_id``; quadrant = position
  ``user_id mod 4`` in the quadrant list; expected / forbidden tools by quadrant.
* tool calls = ``events`` rows, tool from ``event_type`` ('error' = failed call).
* answers = final assistant message of the conversation with ``conv_id = user_id``.
* LLM usage = ``events`` (request = user and day, model from ``event_type``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.prefix import row_number_by
from tessera.functions.quantiles import exact_quantiles
from tessera.operators import errors as L
from tessera.operators import traces as A
from tessera.operators import usage as U
from tessera.sources.driver import EVENT_MODEL, EVENT_TOOL, messages, table, tool_events, usage_events

ORDER = ["ts", "event_id"]
# Citations of two thirds of the answers, half of them as a link; the same expression runs in Spark and in DuckDB.
CITATION = """CASE {id} % 3 WHEN 0 THEN chr(10) || chr(10) || 'Sources:' || chr(10) || '- docs/page.md' || chr(10)
  WHEN 1 THEN chr(10) || chr(10) || 'Sources:' || chr(10) || '- [page](docs/page.md)' || chr(10) ELSE '' END"""


def _items(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("user_id").distinct()
    quad = F.element_at(F.array(*[F.lit(q) for q in A.QUADRANTS]), (F.pmod("user_id", F.lit(4)) + 1).cast("int"))

    def spec(i: int) -> Column:
        m = F.create_map(*[x for q in A.QUADRANTS for x in (F.lit(q), F.lit(A.QUADRANT_TOOLS[q][i]))])
        return F.element_at(m, F.col("quadrant"))

    return (ev.select(F.col("user_id").alias("item_id"), quad.alias("quadrant"))
            .select("item_id", "quadrant", spec(0).cast("array<string>").alias("expected_tools"),
                    spec(1).cast("array<string>").alias("forbidden_tools"),
                    spec(2).alias("citation_required")))


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    a = A.final_answers(messages(spark, sf))
    cited = F.when(F.col("answer") == A.NO_ANSWER, F.col("answer")).otherwise(F.expr(f"answer || {CITATION.format(id='thread_id')}"))
    return a.select(F.col("thread_id").alias("item_id"), cited.alias("answer"))


def _results(spark: SparkSession, sf: str) -> DataFrame:
    """A8-shaped result rows: verdicts, steps, usage, cost, latency, error."""
    calls = tool_events(spark, sf)
    v = A.trace_verdicts(_items(spark, sf), calls, _answers(spark, sf), ORDER)
    last = calls.groupBy("item_id").agg(
        F.max_by("event_type", F.struct(*ORDER)).alias("last_type"),
        F.round(F.sum("value") / 100.0, 2).alias("latency_s"))
    use = usage_events(spark, sf).withColumn("item_id", F.split("request_id", ":")[0].cast("bigint"))
    per = U.price(U.roll_up(use, "item_id"))
    return (v.join(last, "item_id", "left").join(per.select("item_id", "input_tokens", "output_tokens", "cost_usd"),
                                                 "item_id", "left")
            .select("item_id", "quadrant", "tool_selection_ok", "multistep_ok", "citation_ok",
                    F.col("n_calls").alias("iterations"),
                    F.coalesce("input_tokens", F.lit(0)).alias("input_tokens"),
                    F.coalesce("output_tokens", F.lit(0)).alias("output_tokens"), "cost_usd", "latency_s",
                    F.when(F.col("last_type") == "error", F.lit("tool call failed")).alias("error")))


def _sql_case(col: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default} END"


def _sql_list(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]::VARCHAR[]"


SQL_ITEMS = f"""
items AS (SELECT item_id, ({_sql_list(A.QUADRANTS)})[(item_id % 4) + 1] AS quadrant
          FROM (SELECT DISTINCT user_id AS item_id FROM events)),
spec AS (SELECT * FROM (VALUES {", ".join(f"('{q}', {_sql_list(e)}, {_sql_list(f)}, {str(c).upper()})" for q, (e, f, c) in A.QUADRANT_TOOLS.items())})
         t(quadrant, expected_tools, forbidden_tools, citation_required)),
it AS (SELECT * FROM items JOIN spec USING (quadrant)),
calls AS (SELECT user_id AS item_id, ts, event_id, event_type, value, {_sql_case('event_type', EVENT_TOOL)} AS tool FROM events),
per_tool AS (SELECT item_id, tool, min({{'ts': ts, 'id': event_id}}) AS first FROM calls WHERE tool IS NOT NULL GROUP BY ALL),
fin AS (SELECT conv_id AS item_id, arg_max(text, turn) || {CITATION.format(id='conv_id')} AS answer FROM conversations
        WHERE role = 'assistant' AND text IS NOT NULL AND text <> '' GROUP BY conv_id),
verdicts AS (
  SELECT it.item_id, it.quadrant,
    (SELECT count(*) FROM unnest(it.expected_tools) e(t) WHERE e.t NOT IN (SELECT tool FROM per_tool p WHERE p.item_id = it.item_id)) = 0
    AND (SELECT count(*) FROM per_tool p WHERE p.item_id = it.item_id AND list_contains(it.forbidden_tools, p.tool)) = 0 AS tool_selection_ok,
    CASE WHEN it.quadrant = 'multi_step' THEN coalesce(
      (SELECT min(first) FROM per_tool p WHERE p.item_id = it.item_id AND p.tool = 'docs_search') <
      (SELECT min(first) FROM per_tool p WHERE p.item_id = it.item_id AND p.tool = 'code_generate'), FALSE) END AS multistep_ok,
    CASE WHEN it.citation_required THEN
      regexp_matches(coalesce(fin.answer, ''), '(?m)^Sources:\\s*\\n(?:- \\S.*\\n?)+')
      AND NOT regexp_matches(coalesce(fin.answer, ''), '(?m)^Sources:\\s*\\n(?:.*(?:\\[.+\\]\\(.+\\)|^\\d+\\.).*\\n?)+') END AS citation_ok,
    (SELECT count(*) FROM calls c WHERE c.item_id = it.item_id AND c.tool IS NOT NULL) AS n_calls
  FROM it LEFT JOIN fin USING (item_id))"""

SQL_USAGE_CALLS = f"""
ucalls AS (SELECT CAST(user_id AS STRING) || ':' || strftime(ts, '%Y-%m-%d') AS request_id, user_id, event_id,
                  {_sql_case('event_type', EVENT_MODEL)} AS model,
                  CASE WHEN value >= 1 THEN floor(value * 10)::BIGINT END AS input_tokens,
                  CASE WHEN value >= 1 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS output_tokens
           FROM events)"""


def _sql_price(src: str) -> str:
    pin = " ".join(f"WHEN contains(model, '{k}') THEN {a}::DOUBLE" for k, a, _ in U.PRICES)
    pout = " ".join(f"WHEN contains(model, '{k}') THEN {b}::DOUBLE" for k, _, b in U.PRICES)
    return f"""SELECT *, input_tokens + output_tokens AS total_tokens,
       round(input_tokens / 1e6 * (CASE {pin} END) + output_tokens / 1e6 * (CASE {pout} END), 6) AS cost_usd
FROM {src}"""


def _sql_rollup(key: str) -> str:
    return f"""SELECT {key}, sum(coalesce(input_tokens, 0))::BIGINT AS input_tokens,
       sum(coalesce(output_tokens, 0))::BIGINT AS output_tokens, count(*) AS llm_calls,
       array_to_string(list_sort(list_distinct(list(model) FILTER (WHERE model <> ''))), ',') AS model
FROM ucalls WHERE input_tokens IS NOT NULL OR output_tokens IS NOT NULL GROUP BY {key}"""


SQL_RESULTS = SQL_ITEMS + "," + SQL_USAGE_CALLS + f""",
peruse AS ({_sql_price('(' + _sql_rollup('user_id') + ')')}),
lastev AS (SELECT item_id, arg_max(event_type, {{'ts': ts, 'id': event_id}}) AS last_type,
                  round(sum(value) / 100.0, 2) AS latency_s FROM calls GROUP BY item_id),
results AS (SELECT v.item_id, v.quadrant, v.tool_selection_ok, v.multistep_ok, v.citation_ok, v.n_calls AS iterations,
                   coalesce(u.input_tokens, 0) AS input_tokens, coalesce(u.output_tokens, 0) AS output_tokens,
                   u.cost_usd, l.latency_s, CASE WHEN l.last_type = 'error' THEN 'tool call failed' END AS error
            FROM verdicts v LEFT JOIN lastev l USING (item_id) LEFT JOIN peruse u ON u.user_id = v.item_id)"""


# ---------------------------------------------------------------- trace_judge (A1-A5)

def q_trace_judge(spark: SparkSession, sf: str) -> DataFrame:
    v = A.trace_verdicts(_items(spark, sf), tool_events(spark, sf), _answers(spark, sf), ORDER)
    return v.select(F.col("item_id").cast("bigint").alias("item_id"), "quadrant", "tool_selection_ok",
                    "multistep_ok", "citation_ok", F.col("n_calls").cast("bigint").alias("n_calls"))


SQL_TRACE_JUDGE = "WITH " + SQL_ITEMS.strip() + """
SELECT item_id::BIGINT AS item_id, quadrant, tool_selection_ok, multistep_ok, citation_ok, n_calls::BIGINT AS n_calls
FROM verdicts"""


# ---------------------------------------------------------------- quadrant_report

def q_quadrant_report(spark: SparkSession, sf: str) -> DataFrame:
    r = A.quadrant_report(_results(spark, sf))
    return r.select("quadrant", F.col("n").cast("bigint").alias("n"),
                    *[F.round(c, 6).alias(c) for c in ("tool_rate", "multistep_rate", "citation_rate")],
                    F.col("n_multistep").cast("bigint").alias("n_multistep"),
                    F.col("n_citation").cast("bigint").alias("n_citation"),
                    *[F.round(c, 6).alias(c) for c in ("mean_steps", "mean_input_tokens", "mean_output_tokens",
                                                       "mean_cost_usd")])


SQL_QUADRANT_REPORT = "WITH " + SQL_RESULTS.strip() + """
SELECT coalesce(quadrant, 'all') AS quadrant, count(*)::BIGINT AS n,
  round(avg(tool_selection_ok::INT::DOUBLE), 6) AS tool_rate,
  round(avg(multistep_ok::INT::DOUBLE), 6) AS multistep_rate,
  round(avg(citation_ok::INT::DOUBLE), 6) AS citation_rate,
  count(multistep_ok)::BIGINT AS n_multistep, count(citation_ok)::BIGINT AS n_citation,
  round(avg(iterations), 6) AS mean_steps, round(avg(input_tokens), 6) AS mean_input_tokens,
  round(avg(output_tokens), 6) AS mean_output_tokens, round(avg(cost_usd), 6) AS mean_cost_usd
FROM results WHERE error IS NULL GROUP BY ROLLUP (quadrant)"""


# ---------------------------------------------------------------- agent_failures

def q_agent_failures(spark: SparkSession, sf: str) -> DataFrame:
    r = _results(spark, sf)
    f = A.failures(r).select("item_id", "quadrant", F.lit("failure").alias("kind"))
    e = A.errors(r).select("item_id", "quadrant", F.lit("error").alias("kind"))
    return f.unionByName(e).select(F.col("item_id").cast("bigint").alias("item_id"), "quadrant", "kind")


SQL_AGENT_FAILURES = "WITH " + SQL_RESULTS.strip() + """
SELECT item_id::BIGINT AS item_id, quadrant, 'failure' AS kind FROM results
WHERE error IS NULL AND (NOT tool_selection_ok OR coalesce(NOT multistep_ok, FALSE) OR coalesce(NOT citation_ok, FALSE))
UNION ALL SELECT item_id::BIGINT, quadrant, 'error' FROM results WHERE error IS NOT NULL"""


# ---------------------------------------------------------------- latency_profile

def q_latency_profile(spark: SparkSession, sf: str) -> DataFrame:
    r = _results(spark, sf)
    q = exact_quantiles(r, ["quadrant"], "latency_s", [0.5, 0.95], prefix="p")
    m = r.groupBy("quadrant").agg(F.avg("latency_s").alias("mean_s"), F.max("latency_s").alias("max_s"))
    return q.join(m, "quadrant").select("quadrant", F.col("n").cast("bigint").alias("n"),
                                        F.round("mean_s", 6).alias("mean_s"), F.round("p50", 6).alias("p50_s"),
                                        F.round("p95", 6).alias("p95_s"), F.round("max_s", 6).alias("max_s"))


SQL_LATENCY_PROFILE = "WITH " + SQL_RESULTS.strip() + """
SELECT quadrant, count(latency_s)::BIGINT AS n, round(avg(latency_s), 6) AS mean_s,
       round(quantile_cont(latency_s, 0.5), 6) AS p50_s, round(quantile_cont(latency_s, 0.95), 6) AS p95_s,
       round(max(latency_s), 6) AS max_s
FROM results GROUP BY quadrant"""


# ---------------------------------------------------------------- usage_cost

def q_usage_cost(spark: SparkSession, sf: str) -> DataFrame:
    calls = usage_events(spark, sf)
    priced = U.price(U.roll_up(calls))
    reqs = calls.select("request_id").distinct()
    out = reqs.join(priced, "request_id", "left")
    return out.select("request_id", "model", "input_tokens", "output_tokens", "total_tokens",
                      F.coalesce("llm_calls", F.lit(0)).cast("bigint").alias("llm_calls"), "cost_usd", "cost_krw",
                      (F.coalesce("llm_calls", F.lit(0)) > 0).alias("has_usage"))


SQL_USAGE_COST = "WITH " + SQL_USAGE_CALLS.strip() + f""",
priced AS ({_sql_price('(' + _sql_rollup('request_id') + ')')})
SELECT r.request_id, p.model, p.input_tokens, p.output_tokens, p.total_tokens,
       coalesce(p.llm_calls, 0)::BIGINT AS llm_calls, p.cost_usd, round(p.cost_usd * {U.USD_KRW}::DOUBLE, 2) AS cost_krw,
       coalesce(p.llm_calls, 0) > 0 AS has_usage
FROM (SELECT DISTINCT request_id FROM ucalls) r LEFT JOIN priced p USING (request_id)"""


def q_usage_by_model(spark: SparkSession, sf: str) -> DataFrame:
    priced = U.price(U.roll_up(usage_events(spark, sf)))
    c = U.cost_by(priced, "model")
    return c.select("model", F.col("requests").cast("bigint").alias("requests"), "input_tokens", "output_tokens",
                    F.round("cost_usd", 6).alias("cost_usd"))


SQL_USAGE_BY_MODEL = "WITH " + SQL_USAGE_CALLS.strip() + f""",
priced AS ({_sql_price('(' + _sql_rollup('request_id') + ')')})
SELECT model, count(*)::BIGINT AS requests, sum(input_tokens)::BIGINT AS input_tokens,
       sum(output_tokens)::BIGINT AS output_tokens, round(sum(cost_usd), 6) AS cost_usd
FROM priced GROUP BY model"""


# ---------------------------------------------------------------- conversations

def q_final_answer(spark: SparkSession, sf: str) -> DataFrame:
    m = messages(spark, sf)
    a = A.final_answers(m).join(A.current_query(m), "thread_id", "left")
    return a.select(F.col("thread_id").cast("bigint").alias("thread_id"), "answer", F.col("query").alias("last_query"))


SQL_FINAL_ANSWER = f"""
WITH t AS (SELECT DISTINCT conv_id FROM conversations),
fin AS (SELECT conv_id, arg_max(text, turn) AS answer FROM conversations
        WHERE role = 'assistant' AND text IS NOT NULL AND text <> '' GROUP BY conv_id),
cq AS (SELECT conv_id, arg_max(text, turn) AS q FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT t.conv_id::BIGINT AS thread_id, coalesce(fin.answer, '{A.NO_ANSWER}') AS answer, cq.q AS last_query
FROM t LEFT JOIN fin USING (conv_id) LEFT JOIN cq USING (conv_id)"""


def q_new_messages(spark: SparkSession, sf: str) -> DataFrame:
    t = A.turns(messages(spark, sf))
    return (t.groupBy("thread_id", "turn_no").agg(F.count(F.lit(1)).alias("n_messages"),
                                                   F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
            .select(F.col("thread_id").cast("bigint").alias("thread_id"), F.col("turn_no").cast("bigint").alias("turn_no"),
                    F.col("n_messages").cast("bigint").alias("n_messages"),
                    F.col("first_seq").cast("bigint").alias("first_seq"), F.col("last_seq").cast("bigint").alias("last_seq")))


SQL_NEW_MESSAGES = """
WITH t AS (SELECT conv_id, turn, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END)
                  OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS turn_no
           FROM conversations)
SELECT conv_id::BIGINT AS thread_id, turn_no::BIGINT AS turn_no, count(*)::BIGINT AS n_messages,
       min(turn)::BIGINT AS first_seq, max(turn)::BIGINT AS last_seq FROM t GROUP BY ALL"""

TRIM_BUDGET = 300


def q_history_trim(spark: SparkSession, sf: str) -> DataFrame:
    k = A.trim_history(messages(spark, sf), budget=TRIM_BUDGET)
    return k.select(F.col("thread_id").cast("bigint").alias("thread_id"), F.col("seq").cast("bigint").alias("seq"), "role")


SQL_HISTORY_TRIM = f"""
WITH m AS (SELECT conv_id, turn, role, (ceil((length(coalesce(text, '')) + length(role)) / 4) + 3)::BIGINT AS tok
           FROM conversations),
s AS (SELECT *, sum(tok) OVER (PARTITION BY conv_id ORDER BY turn DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS suffix FROM m),
inside AS (SELECT * FROM s WHERE suffix <= {TRIM_BUDGET}),
st AS (SELECT conv_id, min(turn) AS start FROM inside WHERE role = 'user' GROUP BY conv_id),
kept AS (SELECT i.conv_id, i.turn, i.role FROM inside i JOIN st USING (conv_id) WHERE i.turn >= st.start),
fb AS (SELECT conv_id, arg_max(role, turn) AS role, max(turn) AS turn FROM m
       WHERE conv_id NOT IN (SELECT conv_id FROM kept) GROUP BY conv_id)
SELECT conv_id::BIGINT AS thread_id, turn::BIGINT AS seq, role FROM kept
UNION ALL SELECT conv_id::BIGINT, turn::BIGINT, role FROM fb"""


def _event_steps(spark: SparkSession, sf: str) -> DataFrame:
    return row_number_by(tool_events(spark, sf), ["item_id"], ORDER, "seq")


def q_thread_trace(spark: SparkSession, sf: str) -> DataFrame:
    s = _event_steps(spark, sf)
    calls = s.where(F.col("tool").isNotNull()).select(
        F.col("item_id").alias("thread_id"), "seq", F.lit(0).alias("pos"), F.col("tool").alias("name"),
        F.col("props").alias("args"))
    results = s.select(F.col("item_id").alias("thread_id"), "seq", F.col("tool").alias("name"), F.col("value").alias("content"))
    return A.trace_steps(calls, results).select(F.col("thread_id").cast("bigint").alias("thread_id"),
                                                F.col("seq").cast("bigint").alias("seq"), "kind", "name", "payload")


SQL_THREAD_TRACE = f"""
WITH s AS (SELECT user_id, props, value, {_sql_case('event_type', EVENT_TOOL)} AS tool,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events)
SELECT user_id::BIGINT AS thread_id, seq::BIGINT AS seq, 'tool_call' AS kind, tool AS name, props AS payload
FROM s WHERE tool IS NOT NULL
UNION ALL
SELECT user_id::BIGINT, seq::BIGINT, 'tool_result', coalesce(tool, 'tool'), substr(CAST(value AS STRING), 1, 800) FROM s"""


def q_iteration_cap(spark: SparkSession, sf: str) -> DataFrame:
    s = tool_events(spark, sf).select(
        F.col("item_id").alias("thread_id"), F.date_format("ts", "yyyy-MM-dd").alias("turn_no"),
        "ts", "event_id", F.lit("assistant").alias("role"), F.col("tool").isNotNull().alias("has_calls"))
    f = A.iteration_flags(s, order=ORDER)
    return f.groupBy("thread_id", "turn_no").agg(
        F.count(F.lit(1)).cast("bigint").alias("steps"), F.max(F.col("capped").cast("int")).cast("boolean").alias("capped")
    ).select(F.col("thread_id").cast("bigint").alias("thread_id"), "turn_no", "steps", "capped")


SQL_ITERATION_CAP = f"""
WITH s AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS turn_no, ({_sql_case('event_type', EVENT_TOOL)}) IS NOT NULL AS has_calls,
                  row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS step FROM events)
SELECT user_id::BIGINT AS thread_id, turn_no, count(*)::BIGINT AS steps, bool_or(step = 5 AND has_calls) AS capped
FROM s GROUP BY ALL"""


# ---------------------------------------------------------------- error logs (L1-L3)

# Synthetic traceback text derived from each error event. The same expression
# text runs in Spark SQL and in DuckDB.
TRACEBACK_EXPR = (
    "'Traceback (most recent call last):' || chr(10) || "
    "'  File \"svc/app.py\", line ' || CAST(user_id + 10 AS STRING) || ', in handle' || chr(10) || "
    "'    run()' || chr(10) || "
    "'  File \"svc/mod' || CAST(CAST(json_k AS BIGINT) % 5 AS STRING) || '.py\", line ' || json_k || "
    "', in step_' || CAST(user_id % 3 AS STRING) || chr(10) || "
    "CASE CAST(json_k AS BIGINT) % 4 WHEN 0 THEN 'ValueError: bad value ' || CAST(value AS STRING) "
    "WHEN 1 THEN 'KeyError: ''k''' WHEN 2 THEN 'TimeoutError:   ' ELSE 'app.errors.RetryError: gave up' END"
)


def _error_logs(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").where(F.col("event_type") == "error")
    ev = ev.withColumn("json_k", F.get_json_object("props", "$.k"))
    return ev.select("event_id", "ts", F.expr(TRACEBACK_EXPR).alias("text"))


SQL_ERROR_LOGS = f"""
elog AS (SELECT event_id, ts, {TRACEBACK_EXPR} AS text
         FROM (SELECT *, json_extract_string(props, '$.k') AS json_k FROM events WHERE event_type = 'error'))"""


def q_error_parse(spark: SparkSession, sf: str) -> DataFrame:
    lg = _error_logs(spark, sf)
    p = lg.select("event_id", L.parse_traceback(F.col("text")).alias("p"))
    return p.select(F.col("event_id").cast("bigint").alias("event_id"), "p.*", L.summary_block(F.col("p")).alias("summary"))


_EXC = r"(?m)^\s*([A-Za-z_][A-Za-z0-9_.]*(?:Error|Exception|Warning|Interrupt))(?::\s*(.*))?$"
_FRAME = r'File "([^"]+)", line (\d+), in (\S+)'

SQL_ERROR_PARSE = "WITH " + SQL_ERROR_LOGS.strip() + f""",
x AS (SELECT event_id,
        regexp_extract_all(text, '{_EXC}', 1) AS types, regexp_extract_all(text, '{_EXC}', 2) AS msgs,
        regexp_extract_all(text, '{_FRAME}', 1) AS files, regexp_extract_all(text, '{_FRAME}', 2) AS lines,
        regexp_extract_all(text, '{_FRAME}', 3) AS funcs FROM elog),
p AS (SELECT event_id,
        CASE WHEN len(types) > 0 THEN types[-1] END AS exception_type,
        CASE WHEN len(types) > 0 THEN nullif(regexp_replace(msgs[-1], '^\\s+|\\s+$', '', 'g'), '') END AS exception_message,
        CASE WHEN len(files) > 0 THEN files[-1] END AS innermost_file,
        CASE WHEN len(files) > 0 THEN lines[-1] END AS innermost_line,
        CASE WHEN len(files) > 0 THEN funcs[-1] END AS innermost_func,
        CAST(len(files) AS STRING) AS frame_count FROM x)
SELECT event_id::BIGINT AS event_id, exception_type, exception_message, innermost_file, innermost_line, innermost_func,
       frame_count,
       '### Parsed' || chr(10) ||
       CASE WHEN exception_type IS NOT NULL THEN '- exception: ' || exception_type ||
            coalesce(': ' || exception_message, '')
            ELSE '- exception: (could not parse — not a standard Python traceback)' END || chr(10) ||
       coalesce('- innermost frame: ' || innermost_file || ':' || innermost_line || ' in ' || innermost_func || chr(10), '') ||
       '- total frames: ' || frame_count AS summary
FROM p"""


def q_error_signature(spark: SparkSession, sf: str) -> DataFrame:
    s = L.error_signatures(_error_logs(spark, sf))
    return s.select("exception_type", "innermost_file", "innermost_line", F.col("n").cast("bigint").alias("n"),
                    F.date_format("latest", "yyyy-MM-dd HH:mm:ss").alias("latest"), F.round("share", 6).alias("share"))


SQL_ERROR_SIGNATURE = SQL_ERROR_PARSE[:SQL_ERROR_PARSE.index("SELECT event_id::BIGINT AS event_id, exception_type,")] + """
SELECT coalesce(p.exception_type, '(unparsed)') AS exception_type, p.innermost_file, p.innermost_line,
       count(*)::BIGINT AS n, strftime(max(e.ts), '%Y-%m-%d %H:%M:%S') AS latest,
       round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM p JOIN elog e USING (event_id) GROUP BY ALL"""


QUERIES = {
    "trace_judge": q_trace_judge,
    "quadrant_report": q_quadrant_report,
    "agent_failures": q_agent_failures,
    "latency_profile": q_latency_profile,
    "usage_cost": q_usage_cost,
    "usage_by_model": q_usage_by_model,
    "final_answer": q_final_answer,
    "new_messages": q_new_messages,
    "history_trim": q_history_trim,
    "thread_trace": q_thread_trace,
    "iteration_cap": q_iteration_cap,
    "error_parse": q_error_parse,
    "error_signature": q_error_signature,
}

ORACLES = {
    "trace_judge": SQL_TRACE_JUDGE,
    "quadrant_report": SQL_QUADRANT_REPORT,
    "agent_failures": SQL_AGENT_FAILURES,
    "latency_profile": SQL_LATENCY_PROFILE,
    "usage_cost": SQL_USAGE_COST,
    "usage_by_model": SQL_USAGE_BY_MODEL,
    "final_answer": SQL_FINAL_ANSWER,
    "new_messages": SQL_NEW_MESSAGES,
    "history_trim": SQL_HISTORY_TRIM,
    "thread_trace": SQL_THREAD_TRACE,
    "iteration_cap": SQL_ITERATION_CAP,
    "error_parse": SQL_ERROR_PARSE,
    "error_signature": SQL_ERROR_SIGNATURE,
}


# ---------------------------------------------------------------- item_limits (A1) / tool_sequence (A2) / chat_view

ITEM_LIMIT = 20


def q_item_limits(spark: SparkSession, sf: str) -> DataFrame:
    """A1: at most so many items of each quadrant, in input order; the cap is the operator's parameter."""
    return A.select_items(_items(spark, sf), limit=ITEM_LIMIT, order_col="item_id").select(
        F.col("item_id").cast("bigint").alias("item_id"), "quadrant")


SQL_ITEM_LIMITS = "WITH " + SQL_ITEMS.strip() + f"""
SELECT item_id::BIGINT AS item_id, quadrant FROM items
QUALIFY row_number() OVER (PARTITION BY quadrant ORDER BY item_id) <= {ITEM_LIMIT}"""


def q_tool_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """A2: the tools of each run (a user's day) in call order."""
    call = F.when(F.col("tool").isNotNull(), F.array(F.struct(F.col("tool").alias("name"))))
    m = tool_events(spark, sf).select(
        F.concat_ws(":", F.col("item_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("thread_id"),
        F.struct(*ORDER).alias("seq"), F.lit("assistant").alias("role"), call.alias("tool_calls"))
    return A.tool_sequence(m).select("thread_id", F.array_join("called_tools", ",").alias("called_tools"))


SQL_TOOL_SEQUENCE = "WITH " + SQL_ITEMS.strip() + """
SELECT CAST(item_id AS VARCHAR) || ':' || strftime(ts, '%Y-%m-%d') AS thread_id,
       string_agg(tool, ',' ORDER BY ts, event_id) AS called_tools
FROM calls WHERE tool IS NOT NULL GROUP BY ALL"""

CHAT_TO_ROLE = {chat: role for role, chat in A.ROLE_TO_CHAT.items()}


def q_chat_view(spark: SparkSession, sf: str) -> DataFrame:
    """The messages that a chat view shows, with role names mapped to the stored ones and back."""
    d = A.display_rows(messages(spark, sf)).withColumn("stored_role", A.map_roles(F.col("role"), CHAT_TO_ROLE))
    return d.select(F.col("thread_id").cast("bigint").alias("thread_id"), F.col("seq").cast("bigint").alias("seq"),
                    "stored_role", A.map_roles(F.col("stored_role")).alias("role"), "content")


SQL_CHAT_VIEW = f"""
SELECT conv_id::BIGINT AS thread_id, turn::BIGINT AS seq, {_sql_case('role', CHAT_TO_ROLE, 'role')} AS stored_role, role, text AS content
FROM conversations WHERE role = 'user' OR (role = 'assistant' AND coalesce(text, '') <> '')"""

QUERIES |= {"item_limits": q_item_limits, "tool_sequence": q_tool_sequence, "chat_view": q_chat_view}
ORACLES |= {"item_limits": SQL_ITEM_LIMITS, "tool_sequence": SQL_TOOL_SEQUENCE, "chat_view": SQL_CHAT_VIEW}
