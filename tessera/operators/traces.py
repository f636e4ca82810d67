"""A (agent-trace grading) and T (conversation history) operators.

Traces are long tables ``(item_id, step order..., tool)``; verdicts are
aggregations, so an item's calls are never gathered into one array to be
judged. Conversation operators work on ``(thread_id, seq, role, content,
tool_calls)``; running counts and step numbers use distributed prefix sums
(``functions/prefix.py``), so one very long thread is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.prefix import prefix_sum, row_number_by

# Evaluation quadrants and their expected / forbidden tools.
QUADRANTS = ["docs_only", "code_only", "multi_step", "no_tool"]
QUADRANT_TOOLS = {
    "docs_only": (["docs_search"], ["code_generate", "web_search"], True),
    "code_only": (["code_generate"], ["docs_search", "web_search"], False),
    "multi_step": (["docs_search", "code_generate"], ["web_search"], False),
    "no_tool": ([], ["docs_search", "code_generate", "web_search", "error_analyze"], False),
}

# Citation rules. A "Sources:" line followed by one or more
# "- target" bullets; a link or a numbered line right after it breaks the rule.
SOURCES_RE = r"(?muUd)^Sources:\s*\n(?:- \S.*\n?)+"
BAD_CITATION_RE = r"(?muUd)^Sources:\s*\n(?:.*(?:\[.+\]\(.+\)|^\d+\.).*\n?)+"

# Fixed value: reply when a run ends without a final answer.
NO_ANSWER = "(no answer)"


# --------------------------------------------------------------------------- A1


def select_items(items: DataFrame, limit: int | None = None, quadrant: str | None = None,
                 order_col: str = "pos") -> DataFrame:
    """A1: optional quadrant filter, then at most ``limit`` items per quadrant in input order."""
    out = items if quadrant is None else items.where(F.col("quadrant") == quadrant)
    if limit:
        # a quadrant is a quarter of the items: distributed row numbers, not a window per quadrant
        out = row_number_by(out, ["quadrant"], [order_col], "_n").where(F.col("_n") <= limit).drop("_n")
    return out


# --------------------------------------------------------------------------- A2


def tool_sequence(messages: DataFrame, key: str = "thread_id") -> DataFrame:
    """A2: tool names in call order over assistant messages (``tool_calls`` array).

    Bounded per run by the agent's iteration cap; use ``trace_verdicts`` for
    grading, which never builds the array.
    """
    calls = (messages.where((F.col("role") == "assistant") & (F.size("tool_calls") > 0))
             .select(key, "seq", F.posexplode("tool_calls").alias("pos", "call")))
    return calls.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "pos", F.col("call.name").alias("name")))),
                    lambda s: s["name"]).alias("called_tools"))


# --------------------------------------------------------------------------- A3-A5


def citation_ok(answer: Column) -> Column:
    """A5: a ``Sources:`` block with at least one plain bullet and no link or
    numbered line directly under it."""
    a = F.coalesce(answer, F.lit(""))
    return a.rlike(SOURCES_RE) & ~a.rlike(BAD_CITATION_RE)


def trace_verdicts(items: DataFrame, calls: DataFrame, answers: DataFrame,
                   order: list[str], item_col: str = "item_id") -> DataFrame:
    """A3-A5 per item, by aggregation over the call rows.

    items:   (item_id, quadrant, expected_tools, forbidden_tools, citation_required)
    calls:   (item_id, <order cols>, tool)     one row per tool call, in ``order``
    answers: (item_id, answer)

    tool_ok     = expected ⊆ called and no forbidden tool called
    multistep   = first docs_search before first code_generate (multi_step only)
    citation_ok = A5 (only when required)
    """
    pos = F.struct(*order)
    per_tool = calls.where(F.col("tool").isNotNull()).groupBy(item_col, "tool").agg(F.min(pos).alias("first"))
    it = items.select(item_col, "quadrant", "expected_tools", "forbidden_tools", "citation_required")
    exp = it.select(item_col, F.explode("expected_tools").alias("tool"))
    forb = it.select(item_col, F.explode("forbidden_tools").alias("tool"))
    missing = (exp.join(per_tool, [item_col, "tool"], "left_anti").groupBy(item_col)
               .agg(F.count(F.lit(1)).alias("n_missing")))
    banned = (forb.join(per_tool, [item_col, "tool"], "left_semi").groupBy(item_col)
              .agg(F.count(F.lit(1)).alias("n_banned")))
    firsts = per_tool.groupBy(item_col).agg(
        F.min(F.when(F.col("tool") == "docs_search", F.col("first"))).alias("f_docs"),
        F.min(F.when(F.col("tool") == "code_generate", F.col("first"))).alias("f_code"),
        F.count(F.lit(1)).alias("n_distinct_tools"))
    n_calls = calls.where(F.col("tool").isNotNull()).groupBy(item_col).agg(F.count(F.lit(1)).alias("n_calls"))
    v = (it.join(missing, item_col, "left").join(banned, item_col, "left").join(firsts, item_col, "left")
         .join(n_calls, item_col, "left").join(answers, item_col, "left"))
    tool_ok = (F.coalesce("n_missing", F.lit(0)) == 0) & (F.coalesce("n_banned", F.lit(0)) == 0)
    ordered = F.coalesce(F.col("f_docs").isNotNull() & F.col("f_code").isNotNull()
                         & (F.col("f_docs") < F.col("f_code")), F.lit(False))
    return v.select(
        item_col, "quadrant", tool_ok.alias("tool_selection_ok"),
        F.when(F.col("quadrant") == "multi_step", ordered).alias("multistep_ok"),
        F.when(F.col("citation_required"), citation_ok(F.col("answer"))).alias("citation_ok"),
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"))


# --------------------------------------------------------------------------- A6-A9


def quadrant_report(results: DataFrame) -> DataFrame:
    """A6 + A7 in one pass: per quadrant and overall (``quadrant = 'all'``).

    Error rows are excluded. Rates are over non-null verdicts (null when none);
    cost mean skips null costs.
    """
    ok = results.where(F.col("error").isNull())

    def rate(c: str) -> Column:
        return F.avg(F.col(c).cast("double"))

    agg = ok.rollup("quadrant").agg(
        F.count(F.lit(1)).alias("n"),
        rate("tool_selection_ok").alias("tool_rate"),
        rate("multistep_ok").alias("multistep_rate"),
        rate("citation_ok").alias("citation_rate"),
        F.count("multistep_ok").alias("n_multistep"),
        F.count("citation_ok").alias("n_citation"),
        F.avg("iterations").alias("mean_steps"),
        F.avg("input_tokens").alias("mean_input_tokens"),
        F.avg("output_tokens").alias("mean_output_tokens"),
        F.avg("cost_usd").alias("mean_cost_usd"),
        F.grouping_id().alias("_gid"))
    return agg.select(F.when(F.col("_gid") == 1, F.lit("all")).otherwise(F.col("quadrant")).alias("quadrant"),
                      *[c for c in agg.columns if c not in ("quadrant", "_gid")])


def failures(results: DataFrame) -> DataFrame:
    """Non-error items with any false verdict (a null verdict is not a failure)."""
    bad = (~F.col("tool_selection_ok")) | F.coalesce(~F.col("multistep_ok"), F.lit(False)) \
        | F.coalesce(~F.col("citation_ok"), F.lit(False))
    return results.where(F.col("error").isNull() & bad)


def errors(results: DataFrame) -> DataFrame:
    """Error items."""
    return results.where(F.col("error").isNotNull())


# --------------------------------------------------------------------------- T


def thread_history(messages: DataFrame, thread_id) -> DataFrame:
    """One thread in order; an unknown thread gives no rows."""
    return messages.where(F.col("thread_id") == F.lit(thread_id)).orderBy("seq")


def final_answers(messages: DataFrame, key: str = "thread_id") -> DataFrame:
    """Last assistant message with content and no tool calls, per thread;
    threads without one get the fixed fallback text."""
    has_calls = F.coalesce(F.size("tool_calls"), F.lit(0)) > 0 if "tool_calls" in messages.columns else F.lit(False)
    cand = messages.where((F.col("role") == "assistant") & ~has_calls
                          & F.col("content").isNotNull() & (F.col("content") != ""))
    last = cand.groupBy(key).agg(F.max_by("content", "seq").alias("answer"))
    threads = messages.select(key).distinct()
    return threads.join(last, key, "left").select(key, F.coalesce("answer", F.lit(NO_ANSWER)).alias("answer"))


def current_query(messages: DataFrame, key: str = "thread_id") -> DataFrame:
    """T4: last user message per thread."""
    return messages.where(F.col("role") == "user").groupBy(key).agg(F.max_by("content", "seq").alias("query"))


def turns(messages: DataFrame, key: str = "thread_id") -> DataFrame:
    """Turn number = running count of user messages; rows before the first
    user message belong to turn 0. A turn's new messages are its rows."""
    return prefix_sum(messages, [key], ["seq"], F.when(F.col("role") == "user", 1).otherwise(0).cast("bigint"),
                      "turn_no")


def approx_tokens(role: Column, content: Column, extra: Column | None = None) -> Column:
    """Approximate tokens of a message: ceil((len(content) + len(role)) / 4) + 3."""
    n = F.length(F.coalesce(content, F.lit(""))) + F.length(role)
    if extra is not None:
        n = n + F.length(F.coalesce(extra, F.lit("")))
    return (F.ceil(n / 4) + 3).cast("bigint")


def trim_history(messages: DataFrame, budget: int = 8000, key: str = "thread_id") -> DataFrame:
    """Per thread, the longest suffix within ``budget`` approximate tokens,
    then started at its first user message; if nothing is left, the last
    message alone. Returns the kept rows (stored rows are untouched)."""
    m = messages.withColumn("_tok", approx_tokens(F.col("role"), F.col("content")))
    # suffix sum = thread total - prefix before the row (both without a per-thread window)
    tot = m.groupBy(key).agg(F.sum("_tok").alias("_all"))
    m = prefix_sum(m, [key], ["seq"], F.col("_tok"), "_pre").join(tot, key)
    m = m.withColumn("_suffix", F.col("_all") - F.col("_pre") + F.col("_tok")).drop("_all", "_pre")
    inside = m.where(F.col("_suffix") <= budget)
    start = inside.where(F.col("role") == "user").groupBy(key).agg(F.min("seq").alias("_start"))
    kept = inside.join(start, key).where(F.col("seq") >= F.col("_start")).drop("_start")
    last = messages.groupBy(key).agg(F.max("seq").alias("_last"))
    fallback = (m.join(last, key).where(F.col("seq") == F.col("_last")).drop("_last")
                .join(kept.select(key).distinct(), key, "left_anti"))
    return kept.unionByName(fallback).drop("_tok", "_suffix")


def trace_steps(calls: DataFrame, results: DataFrame, key: str = "thread_id") -> DataFrame:
    """T5: one row per tool call (JSON args) and per tool result (first 800
    characters), in (seq, pos) order.

    calls:   (key, seq, pos, name, args: a map or struct, or its JSON)
    results: (key, seq, name, content)
    """
    is_json = calls.schema["args"].dataType.typeName() == "string"
    c = calls.select(key, "seq", "pos", F.lit("tool_call").alias("kind"), "name",
                     (F.col("args") if is_json else F.to_json("args")).alias("payload"))
    r = results.select(key, "seq", F.lit(0).alias("pos"), F.lit("tool_result").alias("kind"),
                       F.coalesce("name", F.lit("tool")).alias("name"),
                       F.substring(F.col("content").cast("string"), 1, 800).alias("payload"))
    return c.unionByName(r)


# Message role mapping (T6), reference role name <-> chat role.
ROLE_TO_CHAT = {"human": "user", "ai": "assistant", "system": "system", "tool": "tool"}


def display_rows(messages: DataFrame, key: str = "thread_id") -> DataFrame:
    """What a chat view shows -- user messages and assistant messages with
    content and no tool calls."""
    has_calls = F.coalesce(F.size("tool_calls"), F.lit(0)) > 0 if "tool_calls" in messages.columns else F.lit(False)
    return messages.where((F.col("role") == "user")
                          | ((F.col("role") == "assistant") & ~has_calls & (F.coalesce("content", F.lit("")) != "")))


def iteration_flags(steps: DataFrame, cap: int = 5, key: str = "thread_id", order=("seq",)) -> DataFrame:
    """Assistant step number per (thread, turn); ``capped`` marks a step at
    the cap that still has calls pending (the run stops there)."""
    a = row_number_by(steps.where(F.col("role") == "assistant"), [key, "turn_no"], list(order), "step")
    return a.withColumn("capped", (F.col("step") == cap) & F.col("has_calls"))


def map_roles(role: Column, mapping: dict = ROLE_TO_CHAT) -> Column:
    """Role names mapped by a fixed table (unknown roles pass through)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, role), role)
