"""C-operators: context assembly and text shaping, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separators, placeholders and fallback sentences.
BLOCK_SEP = "\n\n---\n\n"
URL_RE = r"(?U)https?://\S+"
URL_PLACEHOLDER = "[url-removed]"
NO_DOCS = "No relevant documents found."
NO_WEB = "No web results found."
TRUNCATION_MARK = "\n\n[... truncated ...]"
# Fixed value: first fenced block, optionally tagged python/py.
FENCE_RE = r"(?s)```(?:python|py)?\s*\n(.*?)```"
NON_PYTHON_MARKERS = ["javascript", "typescript", " js ", " ts ", "node.js", "golang", " go ", "rust",
                      "java ", "c++", "c#", "ruby", "php"]


def numbered_context(ranked: DataFrame, key: str = "query_id") -> DataFrame:
    """``[i] source: path\\ntext`` blocks in rank order joined by a ``---`` rule;
    a missing path prints ``unknown``. ``ranked(key, rank, source_path, text)``."""
    block = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] source: "),
                     F.coalesce("source_path", F.lit("unknown")), F.lit("\n"), F.col("text"))
    return (ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", block.alias("b")))).alias("bs"))
            .select(key, F.array_join(F.transform("bs", lambda s: s["b"]), BLOCK_SEP).alias("context")))


def scrub_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL_RE, URL_PLACEHOLDER)


def source_first_context(queries: DataFrame, ranked: DataFrame, key: str = "query_id") -> DataFrame:
    """``path\\ntext`` blocks with URLs scrubbed; path falls back to the file
    name, then ``unknown`` (empty strings count as missing); a query with no
    passages gets the fixed sentence."""
    src = F.coalesce(F.nullif("source_path", F.lit("")), F.nullif("file_name", F.lit("")), F.lit("unknown"))
    block = F.concat(src, F.lit("\n"), scrub_urls(F.col("text")))
    per = (ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", block.alias("b")))).alias("bs"))
           .select(key, F.array_join(F.transform("bs", lambda s: s["b"]), BLOCK_SEP).alias("context")))
    return queries.select(key).join(per, key, "left").select(key, F.coalesce("context", F.lit(NO_DOCS)).alias("context"))


def web_results_block(results: DataFrame, key: str = "query_id") -> DataFrame:
    """``url\ntitle\ncontent`` blocks per query from ``results array<struct>``,
    joined by the rule; a missing url prints ``unknown``; no results gives the
    fixed sentence."""
    ex = results.select(key, F.posexplode_outer("results").alias("pos", "r"))
    blk = F.concat(F.coalesce(F.col("r.url"), F.lit("unknown")), F.lit("\n"), F.coalesce(F.col("r.title"), F.lit("")),
                   F.lit("\n"), F.coalesce(F.col("r.content"), F.lit("")))
    per = (ex.where(F.col("r").isNotNull())
           .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", blk.alias("b")))).alias("bs"))
           .select(key, F.array_join(F.transform("bs", lambda s: s["b"]), BLOCK_SEP).alias("block")))
    return results.select(key).join(per, key, "left").select(key, F.coalesce("block", F.lit(NO_WEB)).alias("block"))


def result_rows(text: Column, n: int = 600) -> Column:
    """C4: first n characters."""
    return F.substring(text, 1, n)


def preview(text: Column, n: int = 140) -> Column:
    """Newlines become spaces, first n characters."""
    return F.substring(F.regexp_replace(text, "\n", " "), 1, n)


def bounded_read(text: Column, max_chars: int = 12000) -> Column:
    """First max_chars characters plus a truncation mark when longer."""
    return F.when(F.length(text) > max_chars, F.concat(F.substring(text, 1, max_chars), F.lit(TRUNCATION_MARK))) \
        .otherwise(text)


def first_code_block(text: Column) -> Column:
    """Stripped body of the first fenced block, otherwise the whole stripped text."""
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    has = text.rlike(FENCE_RE)
    return F.when(has, strip(F.regexp_extract(text, FENCE_RE, 1))).otherwise(strip(text))


def is_python_task(task: Column) -> Column:
    """No non-Python marker in the space-padded lower-cased text."""
    padded = F.concat(F.lit(" "), F.lower(task), F.lit(" "))
    return ~F.exists(F.array(*[F.lit(m) for m in NON_PYTHON_MARKERS]), lambda m: padded.contains(m))
