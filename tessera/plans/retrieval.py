"""Registered retrieval and evaluation queries over the driver tables.

Retrieval runs at document grain (``chunk_id = doc_id``) so that every step has
an SQL twin; the chunk-grain variants live in ``plans/chunks.py``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.evaluate import (KS, containment_truth, delta_vs_baseline, hit_by_difficulty,
                                        hit_mrr, qa_table, wide_report)
from tessera.operators.approx import approx_topk, build_cells, open_cells
from tessera.operators.index import HashedEmbedder, l2_normalize
from tessera.operators.retrieve import METHODS, bm25_topk, dense_topk, retrieve, retrieve_many, with_sources
from tessera.operators.stored import StoredIndex, build_index, build_part, files_state
from tessera.plans import sqlparts as S
from tessera.session import checkpoint_dir
from tessera.sources.driver import doc_corpus, doc_passages, questions, vectors

K = 10
FETCH_K = 20


def _out(r: DataFrame, id_name: str = "doc_id") -> DataFrame:
    return r.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"),
                    F.col("chunk_id").cast("bigint").alias(id_name), F.round("score", 6).alias("score"))


def index_folder(spark: SparkSession, sf: str) -> str:
    """Where the indexes over the tables of ``sf`` are kept."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tessera-index/{hashlib.md5(sf.rstrip('/').encode()).hexdigest()[:16]}"


def doc_index(spark: SparkSession, sf: str, *parts: str) -> StoredIndex:
    """The stored index of the documents. The first query that needs a part builds it; while the table's files stay as
    they are, later ones open it and write nothing."""
    state = files_state(spark, f"{sf.rstrip('/')}/documents.parquet")
    return build_index(doc_passages(spark, sf), index_folder(spark, sf), "document", HashedEmbedder(), state, parts)


# ---------------------------------------------------------------- bm25_topk

def q_bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _out(bm25_topk(questions(spark, sf), doc_index(spark, sf, "postings").bm25, k=K))


SQL_BM25_TOPK = S.with_(S.passages_docs(), S.questions_bench(), S.bm25(),
                        S.topk("r", "bm25_scores", K)) + """
SELECT query_id::BIGINT AS query_id, rank::BIGINT AS rank, chunk_id::BIGINT AS doc_id, round(score, 6) AS score FROM r"""


# ---------------------------------------------------------------- dense_topk

def q_dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding's 10 nearest other embeddings by cosine (whole table both sides)."""
    v = vectors(spark, sf).select(F.col("vec_id"), l2_normalize(F.col("vec")).alias("vec"))
    q = v.select(F.col("vec_id").alias("query_id"), "vec")
    c = v.select(F.col("vec_id").alias("chunk_id"), "vec")
    r = dense_topk(q, c, k=K + 1).where(F.col("query_id") != F.col("chunk_id"))
    r = r.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank")))
    return _out(r.where(F.col("rank") <= K), "vec_id")


SQL_DENSE_TOPK = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS chunk_id, list_cosine_similarity(a.e, b.e) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, chunk_id) AS rank FROM s)
SELECT query_id::BIGINT AS query_id, rank::BIGINT AS rank, chunk_id::BIGINT AS vec_id, round(score, 6) AS score
FROM r WHERE rank <= 10"""


# ---------------------------------------------------------------- dense_approx (R2)

def q_dense_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Ten near neighbours of every embedding whose id is divisible by 20, among all other embeddings, from the cells of
    its nearest centroids; the index is stored and opened again."""
    v = vectors(spark, sf).where("vec_id is not null and vec is not null").select(
        F.col("vec_id").alias("chunk_id"), l2_normalize(F.col("vec")).alias("vec"))
    base = f"{index_folder(spark, sf)}/embeddings"
    made = build_part(spark, base, files_state(spark, f"{sf.rstrip('/')}/embeddings.parquet"), lambda folder: build_cells(v, folder))
    index = open_cells(spark, f"{base}/{made['name']}", made["about"])
    q = v.where(F.col("chunk_id") % 20 == 0).select(F.col("chunk_id").alias("query_id"), "vec")
    r = approx_topk(q, index, k=K + 1).where(F.col("query_id") != F.col("chunk_id"))
    r = r.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank")))
    return _out(r.where(F.col("rank") <= K), "vec_id")


# ---------------------------------------------------------------- dense over documents

def q_dense_docs(spark: SparkSession, sf: str) -> DataFrame:
    return _out(retrieve(questions(spark, sf), doc_passages(spark, sf), "dense", k=K, index=doc_index(spark, sf, "vectors")))


def _sql_dense_ctes() -> list[str]:
    return [S.passages_docs(), S.questions_bench(),
            S.hashed_vectors("qvec", "questions", "query_id", "question"),
            S.hashed_vectors("dvec", "passages", "chunk_id", "text"),
            S.dense_hashed_scores()]


SQL_DENSE_DOCS = S.with_(*_sql_dense_ctes(), S.topk("r", "dense_scores", K)) + """
SELECT query_id::BIGINT AS query_id, rank::BIGINT AS rank, chunk_id::BIGINT AS doc_id, round(score, 6) AS score FROM r"""


# ---------------------------------------------------------------- hybrid_rrf

def q_hybrid_rrf(spark: SparkSession, sf: str) -> DataFrame:
    index = doc_index(spark, sf, "keys", "postings", "vectors")
    return _out(retrieve(questions(spark, sf), doc_passages(spark, sf), "hybrid", k=K, index=index))


def _sql_hybrid_ctes(per_list: int, fused_k: int) -> list[str]:
    return [*_sql_dense_ctes(), S.bm25(), S.topk("dk", "dense_scores", per_list),
            S.topk("bk", "bm25_scores", per_list), S.rrf("fused", [("dk", 0.5), ("bk", 0.5)], fused_k)]


SQL_HYBRID_RRF = S.with_(*_sql_hybrid_ctes(K, K)) + """
SELECT query_id::BIGINT AS query_id, rank::BIGINT AS rank, chunk_id::BIGINT AS doc_id, round(score, 6) AS score FROM fused"""


# ---------------------------------------------------------------- hybrid_rerank

def q_hybrid_rerank(spark: SparkSession, sf: str) -> DataFrame:
    index = doc_index(spark, sf, "keys", "postings", "vectors")
    return _out(retrieve(questions(spark, sf), doc_passages(spark, sf), "hybrid_rerank", k=K, fetch_k=FETCH_K, index=index))


SQL_HYBRID_RERANK = S.with_(*_sql_hybrid_ctes(FETCH_K, 2 * FETCH_K), S.rerank("rr", "fused", K)) + """
SELECT query_id::BIGINT AS query_id, rank::BIGINT AS rank, chunk_id::BIGINT AS doc_id, round(score, 6) AS score FROM rr"""


# ---------------------------------------------------------------- evaluation

COMBOS = [{"strategy": "document", "model": HashedEmbedder().model, "method": m}
          for m in ("dense", "bm25", "hybrid", "hybrid_rerank")]
KEYS = ["strategy", "model", "method"]


def _ranked_all(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All four methods over one corpus, the QA table and the ground truth."""
    passages = doc_passages(spark, sf)
    qs = questions(spark, sf)
    index = doc_index(spark, sf, "keys", "postings", "vectors")
    per = retrieve_many(qs, passages, [c["method"] for c in COMBOS], k=max(KS), fetch_k=FETCH_K, index=index)
    ranked = None
    for c in COMBOS:
        r = per[c["method"]].select(*[F.lit(c[k]).alias(k) for k in KEYS], "query_id", "rank", "chunk_id")
        ranked = r if ranked is None else ranked.unionByName(r)
    ranked = with_sources(ranked, index.keys)
    docs = doc_corpus(spark, sf)
    truth = containment_truth(qs, docs)
    qa = qa_table(qs, truth, docs)
    return ranked, qa, truth


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    ranked, qa, truth = _ranked_all(spark, sf)
    return hit_mrr(qa, ranked, truth, KEYS, COMBOS)


def q_eval_hit_mrr(spark: SparkSession, sf: str) -> DataFrame:
    m = _metrics(spark, sf)
    return m.select(*KEYS, "k", "n_questions", F.round("hit_rate", 6).alias("hit_rate"),
                    F.round("mrr", 6).alias("mrr"))


def q_eval_by_difficulty(spark: SparkSession, sf: str) -> DataFrame:
    ranked, qa, truth = _ranked_all(spark, sf)
    d = hit_by_difficulty(qa, ranked, truth, KEYS, COMBOS)
    return d.select(*KEYS, "difficulty", F.col("n_evaluated").cast("bigint").alias("n_evaluated"),
                    F.round("hit_rate", 6).alias("hit_rate"))


def q_eval_delta(spark: SparkSession, sf: str) -> DataFrame:
    d = delta_vs_baseline(_metrics(spark, sf), ["strategy", "model", "k"])
    return d.select("strategy", "model", "method", "k", F.round("delta_hit_rate", 6).alias("delta_hit_rate"),
                    F.round("delta_mrr", 6).alias("delta_mrr"))


def q_eval_report(spark: SparkSession, sf: str) -> DataFrame:
    return wide_report(_metrics(spark, sf), KEYS)


def _sql_eval_ctes() -> list[str]:
    """Twin of _ranked_all + truth + QA."""
    return [*_sql_hybrid_ctes(K, K),
            S.topk("m_dense", "dense_scores", K), S.topk("m_bm25", "bm25_scores", K),
            S.topk("dk20", "dense_scores", FETCH_K), S.topk("bk20", "bm25_scores", FETCH_K),
            S.rrf("fused20", [("dk20", 0.5), ("bk20", 0.5)], 2 * FETCH_K),
            S.rerank("m_rr", "fused20", K),
            """ranked AS (
  SELECT 'dense' AS method, query_id, rank, chunk_id FROM m_dense UNION ALL
  SELECT 'bm25', query_id, rank, chunk_id FROM m_bm25 UNION ALL
  SELECT 'hybrid', query_id, rank, chunk_id FROM fused UNION ALL
  SELECT 'hybrid_rerank', query_id, rank, chunk_id FROM m_rr)""",
            """truth AS (SELECT q.query_id, p.source_path FROM questions q JOIN passages p ON contains(p.text, q.question))""",
            """qa AS (SELECT q.query_id, count(t.source_path) AS n_gt,
              arg_min(p.lang, p.chunk_id) AS difficulty
       FROM questions q LEFT JOIN truth t USING (query_id) LEFT JOIN passages p ON p.source_path = t.source_path
       GROUP BY q.query_id)""",
            """fh AS (SELECT r.method, r.query_id, min(r.rank) AS first_rank
       FROM ranked r JOIN passages p USING (chunk_id) JOIN truth t ON t.query_id = r.query_id AND t.source_path = p.source_path
       GROUP BY ALL)""",
            """methods AS (SELECT unnest(['dense', 'bm25', 'hybrid', 'hybrid_rerank']) AS method)""",
            """per AS (SELECT m.method, q.query_id, q.n_gt, q.difficulty, fh.first_rank
        FROM qa q JOIN methods m ON TRUE LEFT JOIN fh ON fh.method = m.method AND fh.query_id = q.query_id)""",
            """metrics AS (SELECT method, k, count(*) AS n_questions,
              sum(CASE WHEN first_rank <= k THEN 1 ELSE 0 END) / count(*) AS hit_rate,
              sum(CASE WHEN first_rank <= k THEN 1.0 / first_rank ELSE 0.0 END) / count(*) AS mrr
       FROM per JOIN (SELECT unnest([3, 5, 10]) AS k) ks ON TRUE GROUP BY ALL)"""]


_MODEL = HashedEmbedder().model

SQL_EVAL_HIT_MRR = S.with_(*_sql_eval_ctes()) + f"""
SELECT 'document' AS strategy, '{_MODEL}' AS model, method, k::BIGINT AS k, n_questions::BIGINT AS n_questions,
       round(hit_rate, 6) AS hit_rate, round(mrr, 6) AS mrr FROM metrics"""

SQL_EVAL_BY_DIFFICULTY = S.with_(*_sql_eval_ctes()) + f"""
SELECT 'document' AS strategy, '{_MODEL}' AS model, method, coalesce(difficulty, 'unknown') AS difficulty,
       count(*)::BIGINT AS n_evaluated,
       round(sum(CASE WHEN first_rank <= 10 THEN 1 ELSE 0 END) / count(*), 6) AS hit_rate
FROM per WHERE n_gt > 0 GROUP BY ALL"""

SQL_EVAL_DELTA = S.with_(*_sql_eval_ctes()) + f"""
SELECT 'document' AS strategy, '{_MODEL}' AS model, m.method, m.k::BIGINT AS k,
       round(m.hit_rate - b.hit_rate, 6) AS delta_hit_rate, round(m.mrr - b.mrr, 6) AS delta_mrr
FROM metrics m JOIN metrics b ON b.method = 'dense' AND b.k = m.k WHERE m.method <> 'dense'"""

SQL_EVAL_REPORT = S.with_(*_sql_eval_ctes()) + f"""
SELECT 'document' AS strategy, '{_MODEL}' AS model, method,
  round(max(CASE WHEN k = 3 THEN hit_rate END), 3) AS hit_at_3, round(max(CASE WHEN k = 3 THEN mrr END), 3) AS mrr_at_3,
  round(max(CASE WHEN k = 5 THEN hit_rate END), 3) AS hit_at_5, round(max(CASE WHEN k = 5 THEN mrr END), 3) AS mrr_at_5,
  round(max(CASE WHEN k = 10 THEN hit_rate END), 3) AS hit_at_10, round(max(CASE WHEN k = 10 THEN mrr END), 3) AS mrr_at_10
FROM metrics GROUP BY ALL"""


QUERIES = {
    "bm25_topk": q_bm25_topk,
    "dense_topk": q_dense_topk,
    "dense_approx": q_dense_approx,
    "dense_docs": q_dense_docs,
    "hybrid_rrf": q_hybrid_rrf,
    "hybrid_rerank": q_hybrid_rerank,
    "eval_hit_mrr": q_eval_hit_mrr,
    "eval_by_difficulty": q_eval_by_difficulty,
    "eval_delta": q_eval_delta,
    "eval_report": q_eval_report,
}

ORACLES = {
    "bm25_topk": SQL_BM25_TOPK,
    "dense_topk": SQL_DENSE_TOPK,
    "dense_docs": SQL_DENSE_DOCS,
    "hybrid_rrf": SQL_HYBRID_RRF,
    "hybrid_rerank": SQL_HYBRID_RERANK,
    "eval_hit_mrr": SQL_EVAL_HIT_MRR,
    "eval_by_difficulty": SQL_EVAL_BY_DIFFICULTY,
    "eval_delta": SQL_EVAL_DELTA,
    "eval_report": SQL_EVAL_REPORT,
}

NO_ORACLE = {
    "dense_approx": "approximate: pytest measures its recall against the exact top-k and checks its scores",
}

__all__ = ["QUERIES", "ORACLES", "NO_ORACLE", "METHODS"]
