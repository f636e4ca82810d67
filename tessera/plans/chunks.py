"""Registered chunking (K), chunk-grain retrieval and index-build (E5-E7) queries."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import chunking as K
from tessera.operators import matrix as M
from tessera.operators.evaluate import KS, containment_truth, hit_mrr, qa_table
from tessera.operators.index import HashedEmbedder, index_summary, open_index, write_index
from tessera.operators.retrieve import bm25_topk
from tessera.operators.stored import build_index, files_state
from tessera.plans.retrieval import index_folder
from tessera.session import checkpoint_dir, cut_lineage
from tessera.sources.driver import doc_corpus, questions, table

STRATEGIES = ["fixed", "recursive", "markdown", "semantic"]


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return doc_corpus(spark, sf).select("source_path", "page_content")


def _md_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as Markdown documents: ``source_path = page/<page_id>``."""
    p = table(spark, sf, "pages")
    return p.select(F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("source_path"),
                    K.html_to_markdown(F.col("html")).alias("page_content"))


def _out(c: DataFrame) -> DataFrame:
    return c.select("strategy", "source_path", F.col("chunk_idx").cast("bigint").alias("chunk_idx"), "chunk_id",
                    F.length("page_content").cast("bigint").alias("n_chars"), "page_content")


def q_chunk_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return _out(K.chunk_fixed(_docs(spark, sf)))


def q_chunk_recursive(spark: SparkSession, sf: str) -> DataFrame:
    return _out(K.chunk_recursive(_docs(spark, sf)))


def q_chunk_markdown(spark: SparkSession, sf: str) -> DataFrame:
    c = K.chunk_markdown(_md_pages(spark, sf))
    return c.select("strategy", "source_path", F.col("chunk_idx").cast("bigint").alias("chunk_idx"), "chunk_id",
                    F.length("page_content").cast("bigint").alias("n_chars"), "page_content",
                    F.col("metadata")["h1"].alias("h1"), F.col("metadata")["h2"].alias("h2"))


def q_chunk_semantic(spark: SparkSession, sf: str) -> DataFrame:
    return _out(K.chunk_semantic(_docs(spark, sf)))


def _all_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """K6: documents and pages under all four strategies; the pages are rewritten once and stored for them."""
    return K.chunk_all(_docs(spark, sf).unionByName(cut_lineage(_md_pages(spark, sf), "pages")))


def q_chunk_stats(spark: SparkSession, sf: str) -> DataFrame:
    s = K.chunk_stats(_all_chunks(spark, sf), STRATEGIES)
    return s.select("strategy", "count", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "min", "max")


def q_pick_files(spark: SparkSession, sf: str) -> DataFrame:
    p = K.pick_comparison_files(_docs(spark, sf), k=2)
    return p.select("source_path", F.col("n_headers").cast("bigint").alias("n_headers"),
                    F.col("priority").cast("bigint").alias("priority"))


_SQL_CAND = """
WITH d AS (SELECT source || '/' || CAST(doc_id AS VARCHAR) AS source_path, text FROM documents),
c AS (SELECT source_path, length(text) AS n,
             ((length(text) - length(replace(text, chr(10) || '## ', ''))) // 4)::BIGINT AS n_headers,
             (CASE WHEN starts_with(source_path, 'oss/langchain/') OR starts_with(source_path, 'oss/langgraph/')
                   THEN 1 ELSE 0 END)::BIGINT AS priority FROM d),
t AS (SELECT *, CASE WHEN n BETWEEN 3000 AND 15000 AND n_headers >= 3 THEN 1 WHEN n BETWEEN 2000 AND 20000 THEN 2 END AS tier FROM c),
picked AS (SELECT * FROM t WHERE tier = (SELECT min(tier) FROM t)
           ORDER BY priority DESC, n_headers DESC, source_path LIMIT 2)"""

SQL_PICK_FILES = _SQL_CAND + "\nSELECT source_path, n_headers, priority FROM picked"


def q_semantic_pool(spark: SparkSession, sf: str) -> DataFrame:
    docs = _docs(spark, sf)
    return K.semantic_pool(docs, K.pick_comparison_files(docs, k=2), n=5).select("source_path", F.col("tier").cast("bigint").alias("tier"))


SQL_SEMANTIC_POOL = _SQL_CAND + """,
pool AS (SELECT source_path, 0 AS tier FROM picked
         UNION ALL SELECT source_path, 1 FROM d WHERE length(text) BETWEEN 2000 AND 12000
                   AND source_path NOT IN (SELECT source_path FROM picked))
SELECT source_path, tier::BIGINT AS tier FROM pool ORDER BY tier, source_path LIMIT 5"""


def q_sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    # a source's chunks are numbered from 0 without gaps, so its first four are among these; no other is shuffled
    first = _all_chunks(spark, sf).where(F.col("chunk_idx") < 4)
    return K.sample_rows(first, per=4).select("source_path", "strategy", F.col("chunk_idx").cast("bigint").alias("chunk_idx"), "preview")


def q_bm25_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """R3 at chunk grain over the recursive chunks (ids are chunk ids)."""
    index = build_index(_passages(_docs(spark, sf), "recursive"), index_folder(spark, sf), "recursive", HashedEmbedder(), _state(spark, sf), ("postings",))
    r = bm25_topk(questions(spark, sf), index.bm25, k=10)
    return r.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"),
                    "chunk_id", F.round("score", 6).alias("score"))


def _state(spark: SparkSession, sf: str) -> str:
    return f"{files_state(spark, f'{sf.rstrip("/")}/documents.parquet')}:{K.CHUNK_SIZE}:{K.CHUNK_OVERLAP}"


def _passages(docs: DataFrame, strategy: str) -> DataFrame:
    return K.STRATEGIES[strategy](docs).select("chunk_id", "source_path", F.col("page_content").alias("text"))


#: Chunk strategies and models of the matrix; with the four methods 16 combinations.
MATRIX_STRATEGIES = ("fixed", "recursive")
MATRIX_MODELS = (HashedEmbedder(), HashedEmbedder(dim=64, model="hashed-tf-64"))


def run_chunk_matrix(spark: SparkSession, sf: str, embedders=MATRIX_MODELS) -> M.Matrix:
    docs, state = _docs(spark, sf), _state(spark, sf)
    corpora = {s: _passages(docs, s) for s in MATRIX_STRATEGIES}
    return M.run_matrix(questions(spark, sf), corpora, embedders, index_folder(spark, sf), k=max(KS), fetch_k=20, states=dict.fromkeys(corpora, state))


def q_eval_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """V6 (V1-V4, V7 on it): hit@k and MRR@k of every chunk strategy, model and method; a combination that failed is a
    row with its error."""
    m = run_chunk_matrix(spark, sf)
    if not m.combos:
        raise ValueError(f"every combination failed: {m.failed}")
    qs, docs = questions(spark, sf), doc_corpus(spark, sf)
    truth = cut_lineage(containment_truth(qs, docs), "truth")  # read twice, found once
    out = hit_mrr(qa_table(qs, truth, docs), m.ranked, truth, M.KEYS, m.combos).select(
        *M.KEYS, "k", "n_questions", F.round("hit_rate", 6).alias("hit_rate"), F.round("mrr", 6).alias("mrr"), F.lit(None).cast("string").alias("error"))
    return out.unionByName(m.failures(spark), allowMissingColumns=True) if m.failed else out


def q_index_build(spark: SparkSession, sf: str) -> DataFrame:
    """Write the recursive-chunk index partition (idempotent), reopen it
    with partition pruning and summarise (E6)."""
    base = os.path.join(checkpoint_dir(spark), "tessera-index", os.path.basename(sf.rstrip("/")))
    c = K.chunk_recursive(_docs(spark, sf)).select("chunk_id", "source_path", "chunk_idx", "page_content")
    model = "BAAI/bge-m3"
    write_index(c, base, "recursive", model)
    return index_summary(open_index(spark, base, "recursive", model)).select(
        "strategy", "model", F.col("n_chunks").cast("bigint").alias("n_chunks"))


QUERIES = {
    "chunk_fixed": q_chunk_fixed,
    "chunk_recursive": q_chunk_recursive,
    "chunk_markdown": q_chunk_markdown,
    "chunk_semantic": q_chunk_semantic,
    "chunk_stats": q_chunk_stats,
    "pick_files": q_pick_files,
    "semantic_pool": q_semantic_pool,
    "sample_rows": q_sample_rows,
    "bm25_chunks": q_bm25_chunks,
    "index_build": q_index_build,
    "eval_matrix": q_eval_matrix,
}

ORACLES = {
    "pick_files": SQL_PICK_FILES,
    "semantic_pool": SQL_SEMANTIC_POOL,
}

NO_ORACLE = {
    "chunk_fixed": "splitter fold (separator ladder with overlap) has no SQL form; pytest checks properties and goldens",
    "chunk_recursive": "same as chunk_fixed",
    "chunk_markdown": "header splitter over exploded lines; pytest fixtures",
    "chunk_semantic": "DuckDB regex has no look-behind for the sentence split",
    "chunk_stats": "depends on the chunk tables above",
    "sample_rows": "depends on the chunk tables above",
    "bm25_chunks": "depends on the chunk tables above",
    "eval_matrix": "depends on the chunk tables above; pytest compares it with brute force",
    "index_build": "writes and reopens a partitioned index",
}
