"""R-operators: batch retrieval. A question is a row; all questions run at once.

Every ranked output has the shape ``(query_id, rank, chunk_id, score)``; rank
starts at 1 and ties order by ``score desc, chunk_id asc``. Wide passage text is
never carried through a ranking shuffle: it is joined back only for the final
``k`` rows (or the re-rank candidates).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import WS, let, token_rows, tokens
from tessera.operators.index import Bm25Index, bm25_term_weight
from tessera.session import cut_lineage, fits

# Ranking keys are rounded so that engines that sum in a different order still
# see exact ties (and break them by id).
RANK_DIGITS = 9
# Largest query-side table broadcast to the scan side (rows; size-checked).
BROADCAST_ROWS = 2_000_000
# Bytes of scores that a task computes at once.
TILE_BYTES = 64 << 20
# Terms of all queries together that are sent to the tasks.
TILE_TERMS = 200_000
# Most queries of a term whose hits are added to each of them; the terms of more go through a matrix product.
FEW_QUERIES = 8
# Most queries that every batch of the corpus meets; each of them leaves k rows a batch.
BLOCK_ROWS = 5_000


def rank_within(df: DataFrame, group: list[str], order: list[Column], k: int,
                rank_col: str = "rank") -> DataFrame:
    """Top-k per group with ``row_number`` (Spark inserts WindowGroupLimit, so
    each map task keeps at most k rows per group before the shuffle)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def _score_order(score: str = "score", tiebreak: str = "chunk_id") -> list[Column]:
    return [F.round(F.col(score), RANK_DIGITS).desc(), F.col(tiebreak).asc()]


def attach_text(ranked: DataFrame, passages: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join passage text onto a ranked list (final k rows or re-rank candidates).

    The ranked side is bounded (questions x k); when it fits it is broadcast and
    the passage table streams past it, so wide text is never shuffled or
    built into a hash table."""
    r = F.broadcast(ranked) if fits(ranked, broadcast_rows) else ranked
    return passages.select("chunk_id", "text").join(r, "chunk_id")


def keyed_lists(lists: list[DataFrame], passages: DataFrame) -> list[DataFrame]:
    """The ranked lists with ``content_key``, the hash of the passage's text, in one pass over the passages; only
    the texts of hits are hashed, and none is read where ``passages`` brings its keys along (a stored index does).
    Lists and keys are written, as fusions read them again."""
    u = None
    for i, r in enumerate(lists):
        part = r.withColumn("_list", F.lit(i))
        u = part if u is None else u.unionByName(part)
    found = cut_lineage(u, "hits")
    if "content_key" in passages.columns:
        r = F.broadcast(found) if fits(found, BROADCAST_ROWS) else found
        keyed = cut_lineage(passages.select("chunk_id", "content_key").join(r, "chunk_id"), "keyed")
    else:
        keyed = cut_lineage(attach_text(found, passages).withColumn("content_key", F.xxhash64("text")).drop("text"), "keyed")
    return [keyed.where(F.col("_list") == i).drop("_list") for i in range(len(lists))]


# --------------------------------------------------------------------------- R3


def query_terms(queries: DataFrame, text_col: str = "question") -> DataFrame:
    """(query_id, term, qtf): repeated query tokens count repeatedly."""
    return (token_rows(queries, ["query_id"], text_col)
            .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf")))


def _join_postings(qt: DataFrame, idx: Bm25Index, small: bool,
                   rows_per_task: int) -> DataFrame:
    """query terms ⋈ postings on term, skew-safe.

    Bounded query side: broadcast it; the postings stream through without a
    shuffle, so hot terms cost nothing extra. Otherwise: an equi-join on
    (term, salt) where only hot terms are salted -- their postings are spread
    over ``ceil(df / rows_per_task)`` salts and the (small) query rows for those
    terms are replicated once per salt. There are at most
    ``postings / rows_per_task`` hot terms; the join is left to the planner.
    """
    if small:
        return idx.postings.join(F.broadcast(qt), "term")
    hot = (idx.terms.where(F.col("df") > rows_per_task)
           .select("term", F.ceil(F.col("df") / rows_per_task).cast("int").alias("n_salt")))
    n_salt = F.coalesce(F.col("n_salt"), F.lit(1))
    post = (idx.postings.join(hot, "term", "left")
            .withColumn("salt", F.pmod(F.xxhash64("chunk_id"), n_salt)).drop("n_salt"))
    q = (qt.join(hot, "term", "left")
         .withColumn("salt", F.explode(F.sequence(F.lit(0), n_salt - 1))).drop("n_salt"))
    return post.join(q, ["term", "salt"]).drop("salt")


def bm25_scores(queries: DataFrame, idx: Bm25Index, text_col: str = "question",
                broadcast_rows: int = BROADCAST_ROWS, rows_per_task: int = 4_000_000) -> DataFrame:
    """All non-zero BM25 scores ``(query_id, chunk_id, score)``."""
    qt = query_terms(queries, text_col)
    # size check on the query side alone (reads only the questions)
    small = fits(qt, broadcast_rows)
    qt = qt.join(idx.terms.select("term", "idf"), "term")
    cand = _join_postings(qt, idx, small, rows_per_task)
    contrib = F.col("idf") * F.col("qtf") * bm25_term_weight(idx)
    return (cand.groupBy("query_id", "chunk_id").agg(F.sum(contrib).alias("score"))
            .where(F.col("score") != 0))


def bm25_topk(queries: DataFrame, idx: Bm25Index, k: int = 10, text_col: str = "question",
              broadcast_rows: int = BROADCAST_ROWS, rows_per_task: int = 4_000_000) -> DataFrame:
    """Top-k BM25 per query. Zero-score passages are not returned (their
    order would be arbitrary).

    Query terms that make a matrix of at most ``TILE_BYTES`` are sent to the tasks, which score their passages against all
    queries by tiles and hand on the best k of each query; more of them meet the postings in a join."""
    qt = query_terms(queries, text_col)
    s = None
    if fits(qt, min(TILE_TERMS, broadcast_rows)):
        asked = qt.join(idx.terms.select("term", "idf"), "term").select("query_id", "term", (F.col("idf") * F.col("qtf")).alias("w")).toArrow()
        terms, ids = (list(dict.fromkeys(asked[c].to_pylist())) for c in ("term", "query_id"))
        if terms and 8 * len(terms) * len(ids) <= TILE_BYTES:
            s = _bm25_tiles(asked, terms, ids, idx, k, queries.schema["query_id"].dataType)
    if s is None:
        s = bm25_scores(queries, idx, text_col, broadcast_rows, rows_per_task)
    return rank_within(s, ["query_id"], _score_order(), k).select("query_id", "rank", "chunk_id", "score")


def _bm25_tiles(asked, terms: list[str], ids: list, idx: Bm25Index, k: int, id_type: T.DataType) -> DataFrame:
    """``query_id, chunk_id, score``: each task's k best passages of each query, scores of 0 left out. ``asked(query_id, term,
    w)`` is an Arrow table; a passage's postings of these terms are one row of a tile, which is multiplied by ``w``."""
    import pyarrow as pa

    spark = idx.postings.sparkSession
    weights = np.zeros((len(terms), len(ids)))
    t_at, q_at = ({x: i for i, x in enumerate(xs)} for xs in (terms, ids))
    weights[[t_at[t] for t in asked["term"].to_pylist()], [q_at[q] for q in asked["query_id"].to_pylist()]] = asked["w"].to_numpy()
    shared = spark.sparkContext.broadcast((weights, pa.array(ids, asked["query_id"].type)))
    places = spark.createDataFrame(pd.DataFrame({"term": terms, "t": range(len(terms))}), "term string, t int")
    hits = (idx.postings.join(F.broadcast(places), "term").groupBy("chunk_id", "t").agg(F.sum(bm25_term_weight(idx)).alias("w"))
            .groupBy("chunk_id").agg(F.collect_list(F.struct("t", "w")).alias("hits")))  # at most the queries' terms

    def score(batches):
        m, q_ids = shared.value
        parts, best = _term_parts(m), None
        for b in batches:
            most = max(b.column(1).value_lengths().to_pylist(), default=0)
            step = max(1, TILE_BYTES // (32 * max(len(parts[1]), m.shape[1], FEW_QUERIES * most)))
            for at in range(0, b.num_rows, step):
                best = _merge_best(best, b.slice(at, step), m, k, parts)
        if best is not None:
            yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(best[0])), best[1], pa.array(best[2])], ["query_id", "chunk_id", "score"])

    return hits.mapInArrow(score, T.StructType([
        T.StructField("query_id", id_type), T.StructField("chunk_id", idx.postings.schema["chunk_id"].dataType), T.StructField("score", T.DoubleType())]))


def _term_parts(weights: np.ndarray) -> tuple:
    """The terms of ``weights`` (a row a term, a column a query) in two parts. Those that more than ``FEW_QUERIES`` queries hold:
    the place of each (-1: of the other part) and their rows. The others: their queries and weights, term after term, and
    where each term begins."""
    held = (weights != 0).sum(axis=1)
    many = held > FEW_QUERIES
    place = np.where(many, np.cumsum(many) - 1, -1)
    t, q = np.nonzero((weights != 0) & ~many[:, None])
    return place, weights[many], q, weights[t, q], np.searchsorted(t, np.arange(len(weights) + 1))


def _bm25_tile(rows, weights: np.ndarray, parts: tuple) -> np.ndarray:
    """The scores of the passages ``rows(chunk_id, hits)``, a column for each query. Terms of many queries go through a matrix
    product; each hit of the others is added to the few queries that hold it."""
    (place, product, q, wq, first), n, nq = parts, rows.num_rows, weights.shape[1]
    t, w = (c.to_numpy() for c in rows.column(1).flatten().flatten())
    row = np.repeat(np.arange(n), rows.column(1).value_lengths().to_numpy())
    col = place[t]
    many = col >= 0
    tile = np.zeros((n, len(product)))
    tile[row[many], col[many]] = w[many]
    t, w, row = t[~many], w[~many], row[~many]
    sizes = first[t + 1] - first[t]
    at = np.arange(sizes.sum()) + np.repeat(first[t] - (np.cumsum(sizes) - sizes), sizes)
    few = np.bincount(np.repeat(row, sizes) * nq + q[at], weights=np.repeat(w, sizes) * wq[at], minlength=n * nq)
    return tile @ product + few.reshape(n, nq)


def _merge_best(best, rows, weights: np.ndarray, k: int, parts: tuple | None = None):
    """``best`` (numbers of queries, passage ids, scores; None at first) with the passages ``rows(chunk_id, hits)``: the k best
    of each query, ties to the smaller id. ``parts``: what :func:`_term_parts` says of ``weights``."""
    s = _bm25_tile(rows, weights, parts or _term_parts(weights))
    s[s == 0] = -np.inf
    return _merge_scores(best, s, rows.column(0), k)


def _merge_scores(best, s: np.ndarray, chunk_ids, k: int):
    """``best`` as in :func:`_merge_best` with the scores ``s`` of the passages ``chunk_ids`` (an Arrow array), a row a passage and a
    column a query; -inf and NaN are no score."""
    import pyarrow as pa
    import pyarrow.compute as pc

    n, margin = len(s), 10.0 ** -RANK_DIGITS
    least = np.full(s.shape[1], -np.inf)
    if n > k:
        # the k-th best of the bests of disjoint runs of rows: at least k rows reach it
        run = max(1, min(64, n // k))
        runs = n // run
        reached = lambda: np.partition(s[:runs * run].reshape(runs, run, -1).max(axis=1), runs - k, axis=0)[runs - k]
        least = reached()
        if np.isnan(least).any():
            s = np.where(np.isnan(s), -np.inf, s)
            least = reached()
    if best is not None:
        held = np.bincount(best[0], minlength=s.shape[1])
        lowest = np.full(s.shape[1], np.inf)
        np.minimum.at(lowest, best[0], best[2])
        least = np.where(held < k, least, np.maximum(least, lowest))
    row, cols = np.nonzero((s >= np.round(least, RANK_DIGITS) - margin) & (s > -np.inf))
    ids, scores = chunk_ids.take(pa.array(row)), s[row, cols]
    if best is not None:
        cols, ids, scores = np.concatenate([best[0], cols]), pa.concat_arrays([best[1], ids]), np.concatenate([best[2], scores])
    place = np.empty(len(cols), dtype=np.int64)
    place[pc.array_sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(cols))
    order = np.lexsort((place, -np.round(scores, RANK_DIGITS), cols))
    sorted_cols = cols[order]
    order = order[np.arange(len(order)) - np.searchsorted(sorted_cols, sorted_cols) < k]
    return cols[order], ids.take(pa.array(order)), scores[order]


# --------------------------------------------------------------------------- R1


def _tile_topk(q_ids: np.ndarray, qm: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
    """The k best rows for each query (all, if fewer), ties to the smaller id; scores are computed for so many
    queries at a time that a tile stays within ``TILE_BYTES``."""
    n = len(ids)
    place = np.empty(n, dtype=np.int64)
    place[np.argsort(ids, kind="stable")] = np.arange(n)
    step = max(1, TILE_BYTES // (8 * n))
    run = max(1, min(64, n // k))
    for at in range(0, len(q_ids), step):
        s = v @ qm[at:at + step].T
        least = np.full(s.shape[1], -np.inf)
        if n > k:
            # the k-th best of the bests of disjoint runs of rows: at least k rows reach it
            runs = n // run
            tops = s[:runs * run].reshape(runs, run, -1).max(axis=1)
            least = np.partition(tops, runs - k, axis=0)[runs - k]
            if not np.isfinite(least).all():  # vectors that hold NaN or infinity
                r = np.round(s, RANK_DIGITS)
                least = -np.partition(-r, k - 1, axis=0)[k - 1]
        rows, cols = np.nonzero(s >= np.round(least, RANK_DIGITS) - 10.0 ** -RANK_DIGITS)
        r = np.round(s[rows, cols], RANK_DIGITS)
        order = np.lexsort((place[rows], -r, cols))
        rows, cols = rows[order], cols[order]
        best = np.arange(len(cols)) - np.searchsorted(cols, cols) < k
        rows, cols = rows[best], cols[best]
        yield pd.DataFrame({"query_id": q_ids[at + cols], "chunk_id": ids[rows], "score": s[rows, cols]})


def _matrix(vecs: pd.Series) -> np.ndarray:
    if isinstance(vecs.iloc[0], bytes):
        return np.frombuffer(b"".join(vecs), dtype="<f8").reshape(len(vecs), -1)
    return np.stack(vecs.to_numpy()).astype(np.float64)


def arrow_matrix(vecs) -> np.ndarray:
    """The vectors of an Arrow column, lists or packed (see :func:`packed`), as the rows of a matrix; a missing one, or one of
    another length, raises."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(vecs, pa.ChunkedArray):
        vecs = pa.concat_arrays(vecs.chunks)
    bytes_ = pa.types.is_binary(vecs.type) or pa.types.is_large_binary(vecs.type)
    sizes = pc.unique(pc.binary_length(vecs) if bytes_ else vecs.value_lengths()).to_pylist()
    if len(sizes) != 1 or sizes[0] is None:
        raise ValueError(f"vectors of different lengths: {sizes[:5]}")
    if bytes_:
        vecs = vecs.cast(pa.large_binary())
        begin = np.frombuffer(vecs.buffers()[1], dtype=np.int64, count=1, offset=8 * vecs.offset)[0]
        return np.frombuffer(vecs.buffers()[2] or b"", dtype="<f8", count=len(vecs) * sizes[0] // 8, offset=begin).reshape(len(vecs), sizes[0] // 8)
    return vecs.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(vecs), sizes[0])


def packed_rows(m: np.ndarray):
    """The rows of a matrix as an Arrow column of their bytes."""
    import pyarrow as pa

    n, size = len(m), 8 * m.shape[1]
    data = pa.py_buffer(np.ascontiguousarray(m, dtype="<f8"))
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int64) * size), data]).cast(pa.binary())


def packed(vectors: DataFrame) -> DataFrame:
    """``vectors(chunk_id, vec)`` with each vector as the bytes of its doubles, which are stored, read and sent as one value and not
    one by one; rows without a vector are left out."""
    import pyarrow as pa

    vectors = vectors.select("chunk_id", "vec")
    if isinstance(vectors.schema["vec"].dataType, T.BinaryType):
        return vectors.where("vec is not null")

    def run(batches: Iterable) -> Iterator:
        for b in batches:
            b = b.filter(b.column(1).is_valid())
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), packed_rows(arrow_matrix(b.column(1)))], ["chunk_id", "vec"])

    return vectors.mapInArrow(run, T.StructType([vectors.schema["chunk_id"], T.StructField("vec", T.BinaryType())]))


def vec_bytes(vectors: DataFrame) -> Column:
    """The bytes of a vector, packed or not."""
    return F.octet_length("vec").cast("long") if isinstance(vectors.schema["vec"].dataType, T.BinaryType) else 8 * F.size("vec").cast("long")


def dense_topk(queries: DataFrame, corpus: DataFrame, k: int = 10, block_bytes: int = 32 << 20,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact cosine top-k. ``queries(query_id, vec)``, ``corpus(chunk_id, vec)``, packed (:func:`packed`) or not;
    vectors are expected L2-normalised (E2), so cosine = inner product.

    Queries of at most ``block_bytes`` and ``block_rows`` in all are broadcast, and the corpus streams past them without a
    shuffle. More queries are cut into blocks by hash, the corpus as well, and Spark's shuffle brings each pair of
    blocks together, so neither side passes through the driver; there are as many pairs as task slots at least. Either
    way k rows a query leave a task or block, and a window keeps the best k of all.
    """
    spark = queries.sparkSession
    out_schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("chunk_id", corpus.schema["chunk_id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])
    queries, corpus = queries.select("query_id", "vec"), corpus.select("chunk_id", "vec")
    bytes_of = lambda v: F.coalesce(F.sum(vec_bytes(v)), F.lit(0))
    q_bytes, q_rows = queries.agg(bytes_of(queries), F.count(F.lit(1))).first()
    if q_bytes <= block_bytes and q_rows <= block_rows:
        import pyarrow as pa

        head = queries.toArrow()  # at most block_bytes of vectors
        shared = spark.sparkContext.broadcast((pa.concat_arrays(head["query_id"].chunks), arrow_matrix(head["vec"])) if head.num_rows else None)

        def stream(batches: Iterable) -> Iterator:
            q_ids, qm = shared.value or (None, None)
            best = None
            for b in batches if q_ids is not None else ():
                step = max(1, TILE_BYTES // (8 * len(qm)))
                for at in range(0, b.num_rows, step):
                    part = b.slice(at, step)
                    best = _merge_scores(best, arrow_matrix(part.column(1)) @ qm.T, part.column(0), k)
            if best is not None:
                yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(best[0])), best[1], pa.array(best[2])], ["query_id", "chunk_id", "score"])

        cand = corpus.mapInArrow(stream, out_schema)
    else:
        nq, nc = (max(1, math.ceil(n / max(1, block_bytes))) for n in (q_bytes, corpus.agg(bytes_of(corpus)).first()[0]))
        nq = max(nq, math.ceil(min(spark.sparkContext.defaultParallelism, 64) / nc))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        spot = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
        # vectors get a name of their own on each side: where both sides are one table, cogroup takes a column of one name for the same
        q = queries.select("query_id", F.col("vec").alias("qvec"), spot("query_id", nq).alias("qb"), every(nc).alias("cb"))
        c = corpus.select("chunk_id", F.col("vec").alias("cvec"), spot("chunk_id", nc).alias("cb"), every(nq).alias("qb"))

        def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return pd.DataFrame({"query_id": a["query_id"][:0], "chunk_id": b["chunk_id"][:0], "score": pd.Series(dtype=float)})
            return pd.concat(_tile_topk(a["query_id"].to_numpy(), _matrix(a["qvec"]), b["chunk_id"].to_numpy(), _matrix(b["cvec"]), k))

        cand = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInPandas(meet, out_schema)
    return rank_within(cand, ["query_id"], _score_order(), k).select("query_id", "rank", "chunk_id", "score")


# --------------------------------------------------------------------------- R4 / R5


def rrf_fuse(ranked: list[DataFrame], weights: list[float], k: int, c: int = 60,
             key_col: str = "content_key") -> DataFrame:
    """R4 + R5: weighted reciprocal-rank fusion with dedupe by passage content.

    Each input is ``(query_id, rank, chunk_id, <key_col>)``. ``score = Σ w/(c+rank)``
    over every occurrence of a content key; the kept ``chunk_id`` and the tie
    order come from the key's first appearance in the chained lists (list
    order, then rank). Output is cut at ``k``.
    """
    if len(ranked) != len(weights):
        raise ValueError("one weight per ranked list")
    u = None
    for i, (r, w) in enumerate(zip(ranked, weights)):
        part = r.select("query_id", "rank", "chunk_id", key_col,
                        F.lit(i).alias("list_no"), F.lit(float(w)).alias("w"))
        u = part if u is None else u.unionByName(part)
    g = (u.groupBy("query_id", key_col)
         .agg(F.sum(F.col("w") / (F.lit(c) + F.col("rank"))).alias("score"),
              F.min(F.struct("list_no", "rank", "chunk_id")).alias("first")))
    order = [F.round("score", 12).desc(), F.col("first.list_no"), F.col("first.rank")]
    return (rank_within(g, ["query_id"], order, k)
            .select("query_id", "rank", F.col("first.chunk_id").alias("chunk_id"), "score"))


# --------------------------------------------------------------------------- R6


def _bigrams(t: Column) -> Column:
    """Adjacent token pairs of a bound token array (``t`` must be a lambda variable)."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - 1, F.lit(1))),
                       lambda i: F.concat_ws(" ", F.try_element_at(t, i), F.try_element_at(t, i + 1)))


def question_weights(queries: DataFrame, idx: Bm25Index, text_col: str = "question") -> DataFrame:
    """``query_id, weights``: the distinct case-folded terms of each question with ``ln(1 + (N - df + 0.5) / (df + 0.5))``,
    where df adds up the spellings of the index (N at most; 0 for a term that no passage has)."""
    qt = queries.select("query_id", F.explode(F.array_distinct(tokens(F.lower(F.col(text_col))))).alias("term"))
    asked = F.broadcast(qt.select(F.col("term").alias("folded")).distinct()) if fits(qt, BROADCAST_ROWS) else qt.select(F.col("term").alias("folded")).distinct()
    df = (idx.terms.select(F.lower("term").alias("folded"), "df").join(asked, "folded")
          .groupBy(F.col("folded").alias("term")).agg(F.sum("df").alias("df")))
    n = F.least(F.coalesce("df", F.lit(0)).cast("double"), idx.n_docs)
    w = qt.join(df, "term", "left").select("query_id", "term", F.ln(1 + (idx.n_docs - n + 0.5) / (n + 0.5)).alias("w"))
    return w.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("term", "w"))).alias("weights"))  # terms of one question


def overlap_scores(pairs: DataFrame, q_col: str, p_col: str, out: str = "score") -> DataFrame:
    """Default pair scorer (R6 plug point, DataFrame -> DataFrame): mean of
    query-term coverage and query-bigram coverage, case-folded, over distinct
    terms / adjacent pairs. Terms count by the ``weights`` column where there is one (see
    :func:`question_weights`), else alike. Pure SQL (no Python).

    The passage is normalised once per pair into `` t1 t2 ... tn `` (whitespace
    runs become one space), kept as a column: terms are matched with a hash
    intersection against its split, bigrams (a handful per question) with a
    substring test for `` a b ``.
    """
    empty = F.array().cast("array<string>")
    d = (pairs.withColumn("_pn", F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.col(p_col)), WS, " ")),
                                          F.lit(" ")))
         .withColumn("_qt", tokens(F.lower(F.col(q_col)))))
    d = d.withColumn("_qd", F.array_distinct("_qt")).withColumn(
        "_qb", F.array_distinct(F.when(F.size("_qt") > 1, _bigrams(F.col("_qt"))).otherwise(empty)))
    has = F.array_intersect("_qd", F.split("_pn", " "))
    pairs_hit = F.size(F.filter("_qb", lambda b: F.col("_pn").contains(F.concat(F.lit(" "), b, F.lit(" ")))))
    if "weights" in pairs.columns:
        sum_of = lambda ws: F.aggregate(ws, F.lit(0.0).cast("double"), lambda a, x: a + x["w"])
        d = d.withColumn("_has", has)
        met = sum_of(F.filter("weights", lambda x: F.array_contains("_has", x["term"])))
        cov = F.when(F.size("weights") > 0, met / sum_of(F.col("weights"))).otherwise(F.lit(0.0))
    else:
        cov = F.when(F.size("_qd") > 0, F.size(has) / F.size("_qd")).otherwise(F.lit(0.0))
    bcov = F.when(F.size("_qb") > 0, pairs_hit / F.size("_qb")).otherwise(F.lit(0.0))
    return d.withColumn(out, ((F.coalesce(cov, F.lit(0.0)) + bcov) / 2.0).cast("double")).drop("_pn", "_qt", "_qd", "_qb", "_has")


def rerank(candidates: DataFrame, queries: DataFrame, passages: DataFrame, top_n: int = 5,
           scorer=overlap_scores, text_col: str = "question", weights: DataFrame | None = None) -> DataFrame:
    """Re-score fetched candidates ``(query_id, rank, chunk_id)`` and keep top_n.

    ``scorer(pairs, question_col, passage_col) -> pairs + score`` is the plug
    point (a cross-encoder would run there as an Arrow-batched UDF). Only
    fetched candidates are scored; ties keep the fetched order. Text is joined
    in for the candidates only. ``weights`` (:func:`question_weights`) go to the scorer with the questions.
    """
    cand = candidates.select("query_id", F.col("rank").alias("fetch_rank"), "chunk_id")
    asked = queries.select("query_id", text_col)
    if weights is not None:
        asked = asked.join(weights, "query_id", "left")
    c = attach_text(cand, passages).join(asked, "query_id")
    c = scorer(c, text_col, "text")
    order = [F.round("score", RANK_DIGITS).desc(), F.col("fetch_rank").asc()]
    return rank_within(c, ["query_id"], order, top_n).select("query_id", "rank", "chunk_id", "score")


# --------------------------------------------------------------------------- R7 / R8


METHODS = ("dense", "bm25", "hybrid", "hybrid_rerank")


def retrieve(queries: DataFrame, passages: DataFrame, method: str, k: int = 10, fetch_k: int = 20,
             dense_weight: float = 0.5, embedder=None, bm25: Bm25Index | None = None,
             passage_vecs: DataFrame | None = None, query_vecs: DataFrame | None = None, index=None) -> DataFrame:
    """One entry point, one output schema ``(query_id, rank, chunk_id, score)``.

    ``passages(chunk_id, source_path, text)`` and ``queries(query_id, question)``
    come from one chunk strategy (R10). hybrid fuses dense and BM25 lists of
    ``fetch_k`` each and cuts at ``k``; hybrid_rerank fetches the fused
    ``fetch_k`` then re-ranks to ``k`` (R7). With ``index`` (a :class:`StoredIndex`
    of these passages) vectors, postings and content keys are read from it, and
    ``passages`` only gives the texts that are re-ranked.
    """
    if method not in METHODS:
        raise ValueError(f"unknown retrieval method: {method!r}")
    from tessera.operators.index import HashedEmbedder, bm25_index

    if index is not None:
        index.check_aligned()
    if method in ("dense", "hybrid", "hybrid_rerank"):
        emb = embedder or HashedEmbedder()
        if passage_vecs is None and index is not None:
            passage_vecs = index.vectors
        if passage_vecs is None:
            # the vector index: embedded once, written to the shared checkpoint folder
            passage_vecs = cut_lineage(
                emb.embed(passages.select("chunk_id", "text"), "text", "passage").select("chunk_id", "vec"))
        if query_vecs is None:
            query_vecs = emb.embed(queries.select("query_id", "question"), "question", "query").select("query_id", "vec")
    if method in ("bm25", "hybrid", "hybrid_rerank") and bm25 is None:
        bm25 = bm25_index(passages) if index is None else index.bm25
    if method == "dense":
        return dense_topk(query_vecs, passage_vecs, k)
    if method == "bm25":
        return bm25_topk(queries, bm25, k)
    # hybrid: each list k, fused list cut at k. hybrid_rerank: each list fetch_k,
    # the whole fused list (at most 2 * fetch_k keys) is re-ranked down to k.
    per_list = k if method == "hybrid" else fetch_k
    d, b = keyed_lists([dense_topk(query_vecs, passage_vecs, per_list), bm25_topk(queries, bm25, per_list)],
                       passages if index is None else index.keys)
    fused = rrf_fuse([d, b], [dense_weight, 1.0 - dense_weight], k if method == "hybrid" else 2 * per_list)
    if method == "hybrid":
        return fused
    return rerank(cut_lineage(fused, "fused"), queries, passages, top_n=k, weights=question_weights(queries, bm25))


def with_sources(ranked: DataFrame, passages: DataFrame) -> DataFrame:
    """Attach ``source_path`` to a ranked list (final k rows only), which is broadcast where it fits."""
    r = cut_lineage(ranked, "ranked")
    return (F.broadcast(r) if fits(r, BROADCAST_ROWS) else r).join(passages.select("chunk_id", "source_path"), "chunk_id")


def retrieve_many(queries: DataFrame, passages: DataFrame, methods: list[str], k: int = 10, fetch_k: int = 20,
                  dense_weight: float = 0.5, embedder=None, index=None, bm25_list: DataFrame | None = None) -> dict[str, DataFrame]:
    """R8 + R9 for several methods at once: the dense and BM25 lists are fetched
    once at ``max(k, fetch_k)`` and written (questions x fetch_k rows); every
    method derives from them with ``rank <= k`` predicates. Same results as
    calling :func:`retrieve` per method. ``bm25_list`` is the list that was fetched from the same passages before."""
    from tessera.operators.index import HashedEmbedder, bm25_index

    for m in methods:
        if m not in METHODS:
            raise ValueError(f"unknown retrieval method: {m!r}")
    depth = max(k, fetch_k)
    emb = embedder or HashedEmbedder()
    if index is not None:
        index.check_aligned()
    lists, bm25 = {}, None
    if set(methods) & {"dense", "hybrid", "hybrid_rerank"}:
        pv = index.vectors if index is not None else cut_lineage(
            emb.embed(passages.select("chunk_id", "text"), "text", "passage").select("chunk_id", "vec"))
        qv = emb.embed(queries.select("query_id", "question"), "question", "query").select("query_id", "vec")
        lists["dense"] = dense_topk(qv, pv, depth)
    if set(methods) & {"bm25", "hybrid", "hybrid_rerank"}:
        bm25 = bm25_index(passages) if index is None else index.bm25
        lists["bm25"] = bm25_topk(queries, bm25, depth) if bm25_list is None else bm25_list
    lists = dict(zip(lists, keyed_lists(list(lists.values()), passages if index is None else index.keys)))
    out = {}
    cut = lambda df, n: df.where(F.col("rank") <= n)
    for m in methods:
        if m in ("dense", "bm25"):
            out[m] = cut(lists[m], k).select("query_id", "rank", "chunk_id", "score")
        elif m == "hybrid":
            out[m] = rrf_fuse([cut(lists["dense"], k), cut(lists["bm25"], k)], [dense_weight, 1.0 - dense_weight], k)
        else:
            fused = rrf_fuse([cut(lists["dense"], fetch_k), cut(lists["bm25"], fetch_k)],
                             [dense_weight, 1.0 - dense_weight], 2 * fetch_k)
            out[m] = rerank(cut_lineage(fused, "fused"), queries, passages, top_n=k, weights=question_weights(queries, bm25))
    return out
