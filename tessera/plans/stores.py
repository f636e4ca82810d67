"""Registered queries over tables that are written out and read back (S8-S10, S12, S13, K9), single threads
and embedding inputs by model (E1, E3)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import chunking as K
from tessera.operators import traces as A
from tessera.operators import usage as U
from tessera.operators.index import BGE_QUERY_INSTRUCTION, get_embedder
from tessera.operators.retrieve import retrieve
from tessera.plans import agents, sqlparts as S
from tessera.plans.agents import q_quadrant_report
from tessera.session import checkpoint_dir
from tessera.sources import sinks
from tessera.sources.driver import doc_corpus, doc_passages, messages, questions, table, usage_events

K_TOP = 10


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tessera-stores/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- chunk files

def _stored_chunks(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "chunks")
    sinks.write_chunks(K.chunk_recursive(doc_corpus(spark, sf).select("source_path", "page_content")), path)
    return sinks.read_chunks(spark, path)


def q_chunk_files(spark: SparkSession, sf: str) -> DataFrame:
    """All recursive chunks, written as JSON lines in a folder for each strategy and read back."""
    c = _stored_chunks(spark, sf)
    return c.select("strategy", "source_path", F.col("chunk_idx").cast("bigint").alias("chunk_idx"), "chunk_id", "page_content",
                    F.col("metadata")["chunk_strategy"].alias("chunk_strategy"))


def q_source_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """K9: the stored chunks of one source, the last in path order."""
    c = _stored_chunks(spark, sf)
    last = c.agg(F.max("source_path")).first()[0]
    return K.chunks_for_source(c, last).select("source_path", F.col("chunk_idx").cast("bigint").alias("chunk_idx"), "page_content")


# ---------------------------------------------------------------- QA files

def q_qa_files(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items as question rows, written as JSON lines and read back with the declared schema."""
    path = _folder(spark, "qa")
    b = table(spark, sf, "benchmark")
    b.select(F.col("item_id").cast("string").alias("id"), F.col("text").alias("question"), F.col("text").alias("ground_truth_answer"),
             F.array("text").alias("ground_truth_contexts"), F.lit("factual").alias("difficulty")).write.json(path)
    q = sinks.read_qa(spark, path)
    return q.select("id", "question", "ground_truth_answer", F.array_join("ground_truth_contexts", "|").alias("contexts"), "difficulty", "source_file")


SQL_QA_FILES = """
SELECT item_id::VARCHAR AS id, text AS question, text AS ground_truth_answer, coalesce(text, '') AS contexts,
       'factual' AS difficulty, NULL::VARCHAR AS source_file FROM benchmark"""


# ---------------------------------------------------------------- result files (S12) and the usage log

def q_result_files(spark: SparkSession, sf: str) -> DataFrame:
    """The quadrant report, written and read back."""
    path = _folder(spark, "results")
    r = q_quadrant_report(spark, sf)
    sinks.write_results(r, path)
    return spark.read.schema(r.schema).json(path)


ENDPOINT = "/chat"


def q_usage_log(spark: SparkSession, sf: str) -> DataFrame:
    """A record for each priced request, appended to the log, and the log summed by endpoint and model."""
    path = _folder(spark, "usage")
    sinks.log_usage(U.price(U.roll_up(usage_events(spark, sf))), ENDPOINT, path)
    log = spark.read.schema(sinks.USAGE_LOG_SCHEMA).parquet(path)
    c = U.cost_by(log.withColumn("key", F.concat_ws(" ", "endpoint", "model")), "key")
    return c.select("key", F.col("requests").cast("bigint").alias("requests"), "input_tokens", "output_tokens",
                    F.round("cost_usd", 6).alias("cost_usd"))


SQL_USAGE_LOG = agents.SQL_USAGE_BY_MODEL.replace("SELECT model, count(*)", f"SELECT '{ENDPOINT} ' || model AS key, count(*)")


# ---------------------------------------------------------------- one thread

def q_thread_history(spark: SparkSession, sf: str) -> DataFrame:
    """The messages of one thread, the last by id, in order."""
    m = messages(spark, sf)
    last = m.agg(F.max("thread_id")).first()[0]
    return A.thread_history(m, last).select(F.col("thread_id").cast("bigint").alias("thread_id"),
                                            F.col("seq").cast("bigint").alias("seq"), "role", "content")


SQL_THREAD_HISTORY = """
SELECT conv_id::BIGINT AS thread_id, turn::BIGINT AS seq, role, text AS content FROM conversations
WHERE conv_id = (SELECT max(conv_id) FROM conversations)"""


# ---------------------------------------------------------------- a model with a query instruction

BGE = "BAAI/bge-base-en-v1.5"


def q_dense_instructed(spark: SparkSession, sf: str) -> DataFrame:
    """Dense retrieval with an embedder of a family that puts an instruction before questions only."""
    r = retrieve(questions(spark, sf), doc_passages(spark, sf), "dense", k=K_TOP, embedder=get_embedder("hashed", BGE))
    return r.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"),
                    F.col("chunk_id").cast("bigint").alias("doc_id"), F.round("score", 6).alias("score"))


SQL_DENSE_INSTRUCTED = S.with_(
    S.passages_docs(), f"questions AS (SELECT item_id AS query_id, '{BGE_QUERY_INSTRUCTION}' || text AS question FROM benchmark)",
    S.hashed_vectors("qvec", "questions", "query_id", "question"), S.hashed_vectors("dvec", "passages", "chunk_id", "text"),
    S.dense_hashed_scores(), S.topk("r", "dense_scores", K_TOP)) + """
SELECT query_id::BIGINT AS query_id, rank::BIGINT AS rank, chunk_id::BIGINT AS doc_id, round(score, 6) AS score FROM r"""


QUERIES = {
    "chunk_files": q_chunk_files,
    "source_chunks": q_source_chunks,
    "qa_files": q_qa_files,
    "result_files": q_result_files,
    "usage_log": q_usage_log,
    "thread_history": q_thread_history,
    "dense_instructed": q_dense_instructed,
}

ORACLES = {
    "qa_files": SQL_QA_FILES,
    "result_files": agents.SQL_QUADRANT_REPORT,
    "usage_log": SQL_USAGE_LOG,
    "thread_history": SQL_THREAD_HISTORY,
    "dense_instructed": SQL_DENSE_INSTRUCTED,
}

NO_ORACLE = {
    "chunk_files": "depends on the recursive chunks; pytest compares it with the chunks before they were written",
    "source_chunks": "depends on the recursive chunks",
}
