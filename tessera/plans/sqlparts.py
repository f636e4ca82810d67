"""DuckDB SQL twins of the operators, as composable CTE fragments.

Each helper returns ``name AS (...)`` text; the oracle strings in the plan
modules stitch them into one ``WITH`` query over the driver's views. The twins
state the operator semantics a second time, independently of Spark.
"""

from __future__ import annotations

TOKENS = "list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> '')"


def tokens(x: str) -> str:
    return TOKENS.format(x=x)


def passages_docs() -> str:
    return ("passages AS (SELECT doc_id AS chunk_id, source || '/' || CAST(doc_id AS VARCHAR) AS source_path, "
            "text, lang FROM documents)")


def questions_bench() -> str:
    return "questions AS (SELECT item_id AS query_id, text AS question FROM benchmark)"


def bm25(k1: float = 1.5, b: float = 0.75, eps: float = 0.25, prefix: str = "") -> str:
    """CTEs ``{p}bm25_scores(query_id, chunk_id, score)`` over ``passages`` / ``questions``."""
    p = prefix
    return f"""
{p}toks AS (SELECT chunk_id, {tokens('text')} AS toks FROM passages),
{p}dstats AS (SELECT count(*)::DOUBLE AS n, avg(len(toks)) AS avgdl FROM {p}toks),
{p}post AS (SELECT term, chunk_id, dl, count(*) AS tf
            FROM (SELECT chunk_id, len(toks) AS dl, unnest(toks) AS term FROM {p}toks) GROUP BY ALL),
{p}dft AS (SELECT term, count(*) AS df FROM {p}post GROUP BY term),
{p}rawidf AS (SELECT term, df, ln((SELECT n FROM {p}dstats) - df + 0.5) - ln(df + 0.5) AS raw_idf FROM {p}dft),
{p}terms AS (SELECT term, CASE WHEN raw_idf < 0 THEN {eps}::DOUBLE * (SELECT avg(raw_idf) FROM {p}rawidf)
                           ELSE raw_idf END AS idf FROM {p}rawidf),
{p}qt AS (SELECT query_id, term, count(*) AS qtf
          FROM (SELECT query_id, unnest({tokens('question')}) AS term FROM questions) GROUP BY ALL),
{p}bm25_scores AS (
  SELECT q.query_id, p.chunk_id,
         sum(t.idf * q.qtf * (p.tf * ({k1}::DOUBLE + 1)) /
             (p.tf + {k1}::DOUBLE * (1 - {b}::DOUBLE + {b}::DOUBLE * p.dl / (SELECT avgdl FROM {p}dstats)))) AS score
  FROM {p}qt q JOIN {p}terms t USING (term) JOIN {p}post p USING (term)
  GROUP BY ALL HAVING sum(t.idf * q.qtf * (p.tf * ({k1}::DOUBLE + 1)) /
             (p.tf + {k1}::DOUBLE * (1 - {b}::DOUBLE + {b}::DOUBLE * p.dl / (SELECT avgdl FROM {p}dstats)))) <> 0)"""


def topk(name: str, src: str, k: int, order: str = "round(score, 9) DESC, chunk_id") -> str:
    return (f"{name} AS (SELECT * FROM (SELECT query_id, chunk_id, score, "
            f"row_number() OVER (PARTITION BY query_id ORDER BY {order}) AS rank FROM {src}) WHERE rank <= {k})")


def hashed_vectors(name: str, src: str, id_col: str, text_col: str, dim: int = 256) -> str:
    """Sparse twin of the default embedder: ``{name}(id, bucket, v)`` L2-normalised."""
    return f"""
{name}_h AS (SELECT {id_col} AS id, ('0x' || substr(md5(t), 1, 8))::BIGINT AS h
             FROM (SELECT {id_col}, unnest({tokens(text_col)}) AS t FROM {src})),
{name}_raw AS (SELECT id, h % {dim} AS bucket,
                      sum(CASE WHEN (h // {dim}) % 2 = 0 THEN 1.0 ELSE -1.0 END)::DOUBLE AS v
               FROM {name}_h GROUP BY ALL),
{name} AS (SELECT id, bucket, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS v FROM {name}_raw WHERE v <> 0)"""


def dense_hashed_scores(q: str = "qvec", d: str = "dvec") -> str:
    return (f"dense_scores AS (SELECT q.id AS query_id, d.id AS chunk_id, sum(q.v * d.v) AS score "
            f"FROM {q} q JOIN {d} d USING (bucket) GROUP BY ALL)")


def rrf(name: str, lists: list[tuple[str, float]], k: int, c: int = 60) -> str:
    """Weighted RRF with dedupe by passage text; first appearance (list, rank) wins."""
    parts = " UNION ALL ".join(
        f"SELECT query_id, rank, chunk_id, {i} AS list_no, {w}::DOUBLE AS w FROM {src}"
        for i, (src, w) in enumerate(lists))
    return f"""
{name}_u AS ({parts}),
{name}_k AS (SELECT u.*, md5(p.text) AS ck FROM {name}_u u JOIN passages p USING (chunk_id)),
{name}_g AS (SELECT query_id, ck, sum(w / ({c} + rank)) AS score,
                    arg_min(chunk_id, list_no * 100000000 + rank) AS chunk_id,
                    min(list_no * 100000000 + rank) AS first_pos
             FROM {name}_k GROUP BY ALL),
{name} AS (SELECT * FROM (SELECT query_id, chunk_id, score,
                 row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, first_pos) AS rank
                 FROM {name}_g) WHERE rank <= {k})"""


def _bigrams(t: str) -> str:
    return f"list_transform(range(1, len({t})), lambda i: {t}[i] || ' ' || {t}[i + 1])"


def rerank(name: str, cand: str, top_n: int) -> str:
    """Default pair scorer twin: mean of IDF-weighted term coverage and bigram coverage (case-folded, distinct).
    The document frequencies are those of :func:`bm25`, added up over spellings."""
    return f"""
{name}_q AS (SELECT query_id, unnest(list_distinct({tokens('lower(question)')})) AS term FROM questions),
{name}_n AS (SELECT w.query_id, w.term, least(coalesce(sum(d.df), 0)::DOUBLE, (SELECT n FROM dstats)) AS df
             FROM {name}_q w LEFT JOIN dft d ON lower(d.term) = w.term GROUP BY w.query_id, w.term),
{name}_w AS (SELECT query_id, list({{'t': term, 'w': ln(1 + ((SELECT n FROM dstats) - df + 0.5) / (df + 0.5))}} ORDER BY term) AS ws
             FROM {name}_n GROUP BY query_id),
{name}_t AS (SELECT c.query_id, c.chunk_id, c.rank AS fetch_rank, w.ws,
                    {tokens('lower(q.question)')} AS qt0,
                    ' ' || array_to_string({tokens('lower(p.text)')}, ' ') || ' ' AS pn
             FROM {cand} c JOIN questions q USING (query_id) JOIN passages p USING (chunk_id) LEFT JOIN {name}_w w USING (query_id)),
{name}_s AS (SELECT query_id, chunk_id, fetch_rank, pn, ws,
                    CASE WHEN len(qt0) > 1 THEN list_distinct({_bigrams('qt0')}) ELSE [] END AS qb
             FROM {name}_t),
{name}_sc AS (SELECT query_id, chunk_id, fetch_rank,
                     (coalesce(CASE WHEN len(ws) > 0 THEN coalesce(list_sum(list_transform(list_filter(ws, lambda x: contains(pn, ' ' || x.t || ' ')), lambda x: x.w)), 0)
                                                         / list_sum(list_transform(ws, lambda x: x.w)) END, 0.0) +
                      (CASE WHEN len(qb) > 0 THEN len(list_filter(qb, lambda t: contains(pn, ' ' || t || ' '))) / len(qb) ELSE 0.0 END)) / 2.0 AS score
              FROM {name}_s),
{name} AS (SELECT * FROM (SELECT query_id, chunk_id, score,
                 row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, fetch_rank) AS rank
                 FROM {name}_sc) WHERE rank <= {top_n})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)
