"""Readers for the driver tables and the reference-shaped views derived from them.

Every derived view is a lazy DataFrame over the given parquet files, so work
grows with the tables. Column selection is explicit so Catalyst prunes the
parquet scan (``ReadSchema``) and pushes filters (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import source_path
from tessera.session import ship_package

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# Tables whose rows carry CPU-heavy text or vectors, with their unique row id
# (None: no unique id, spread round-robin).
HEAVY = {"documents": "doc_id", "pages": "page_id", "embeddings": "vec_id", "conversations": None}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    ship_package(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, HEAVY[name]) if name in HEAVY else df


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread the rows over the cluster when the scan yields fewer splits than
    there are task slots (a file written as one row group is read by one task).
    Hash on a unique id when there is one (no skew, no sort needed for a
    deterministic retry), else round-robin. A scan that already has enough
    splits is returned untouched, so at scale this adds no shuffle; on a large
    cluster 64 splits are enough, whatever the number of slots."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= min(slots, 64):
        return df
    return df.repartition(slots, key) if key else df.repartition(slots)


def doc_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 Document rows: one per driver document, ``source_path = source/doc_id``."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id"),
        source_path(F.col("source"), F.col("doc_id")).alias("source_path"),
        F.col("doc_id").cast("string").alias("file_name"),
        F.col("text").alias("page_content"),
        F.col("lang"),
    )


def doc_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document-grain passages for retrieval: ``chunk_id = doc_id`` (a bigint)."""
    return doc_corpus(spark, sf_dir).select(
        F.col("doc_id").alias("chunk_id"), "source_path", F.col("page_content").alias("text"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query table from ``benchmark``: ``query_id = item_id``, the whole item text."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense vectors from ``embeddings`` as ``array<double>``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("vec"),
                    F.col("label"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 message rows from ``conversations``: thread = conv_id, seq = turn."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("thread_id"), F.col("turn").alias("seq"),
                    F.col("role"), F.col("text").alias("content"))


# Tool names standing for the driver's event types (event_type -> tool).
EVENT_TOOL = {
    "view": "docs_search",
    "click": "code_generate",
    "signup": "web_search",
    "purchase": "error_analyze",
}

# Model ids standing for the driver's event types in usage logs.
EVENT_MODEL = {
    "view": "gpt-4o-mini-2024-07-18",
    "click": "gpt-4o-2024-08-06",
    "signup": "global.anthropic.claude-sonnet-4-5-20250929-v1:0",
    "purchase": "claude-haiku-4-5",
    "error": "local-llama-3",
}


def tool_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent tool-call trace from ``events``: item = user_id, step order = (ts, event_id).

    ``error`` events are failed calls and carry no tool name.
    """
    ev = table(spark, sf_dir, "events")
    tool_map = F.create_map(*[F.lit(x) for kv in EVENT_TOOL.items() for x in kv])
    return ev.select(
        F.col("user_id").alias("item_id"), "event_id", "ts", "event_type", "value", "props",
        F.element_at(tool_map, F.col("event_type")).alias("tool"),
    )


def usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LLM-call usage rows from ``events``: request = (user_id, day); tokens from value/props."""
    ev = table(spark, sf_dir, "events")
    model_map = F.create_map(*[F.lit(x) for kv in EVENT_MODEL.items() for x in kv])
    k = F.get_json_object("props", "$.k").cast("bigint")
    return ev.select(
        F.concat_ws(":", F.col("user_id").cast("string"),
                    F.date_format("ts", "yyyy-MM-dd")).alias("request_id"),
        "event_id",
        F.element_at(model_map, F.col("event_type")).alias("model"),
        # a call without usage metadata: value below 1 token
        F.when(F.col("value") >= 1, F.floor(F.col("value") * 10).cast("bigint")).alias("input_tokens"),
        F.when(F.col("value") >= 1, k).alias("output_tokens"),
    )
