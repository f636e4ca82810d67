"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are sparse rows over their component numbers. Both sides are cut into blocks of bounded size,
each pair of blocks is met in one task: the block of candidates becomes posting lists (component ->
rows and weights), and each query's components scatter their weighted postings into a dense score
array. A partition selection keeps the best k of the array, and the best of all blocks are merged.
Integer scores, so results do not depend on the order of summation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage, ship_package

#: Queries whose score arrays are alive at once.
SLAB = 32


def usable(vec: Column) -> Column:
    """True where the vector and all its components are there and finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(False))


def scaled(vec: Column, factor: int = 256) -> Column:
    """Components as ``floor(factor * x)``, x as double."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * float(factor)).cast("long"))


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of components, missing ones as 0."""
    a = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    a = pa.concat_arrays(a.chunks) if isinstance(a, pa.ChunkedArray) else a
    sizes = a.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = a.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(a), width), dtype=np.int64)
    rows = np.repeat(np.arange(len(a)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _width(t: pa.Table) -> int:
    return max([0, *t.column("vec").combine_chunks().value_lengths().to_pylist()]) if t.num_rows else 0


def _best(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> Iterator[tuple]:
    """The k best candidates of each query by (score descending, id), the query's own id left out."""
    top = max(int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * max(1, q.shape[1]), 1)
    kind = np.int32 if top < 2**31 else np.int64
    if top >= 2**63:
        raise OverflowError("scores do not fit 64 bits")
    order = np.argsort(cid, kind="stable")  # with candidates in id order, ties of a stable sort go to the smaller id
    cid, c = cid[order], c[order]
    postings = []
    for j in range(c.shape[1]):
        rows = np.flatnonzero(c[:, j])
        postings.append((rows if len(rows) < len(c) else slice(None), c[rows, j].astype(kind)))
    for at in range(0, len(q), SLAB):
        part = q[at:at + SLAB].astype(kind)
        scores = np.zeros((len(part), len(c)), dtype=kind)
        for j, (rows, weights) in enumerate(postings):
            if len(weights):
                asks = np.flatnonzero(part[:, j])
                if len(asks) == len(part) and isinstance(rows, slice):
                    scores += part[:, j, None] * weights
                elif len(asks):
                    at_rows = np.ix_(asks, np.arange(len(c)) if isinstance(rows, slice) else rows)
                    scores[at_rows] += part[asks, j, None] * weights
        for i, own in enumerate(qid[at:at + SLAB]):
            row, others = scores[i], None
            lo, hi = np.searchsorted(cid, own, "left"), np.searchsorted(cid, own, "right")
            if lo < hi:
                others = np.r_[0:lo, hi:len(cid)]
                row = row[others]
            if len(row) > k:
                least = np.partition(row, len(row) - k)[len(row) - k]
                above = np.flatnonzero(row > least)
                pick = np.r_[above, np.flatnonzero(row == least)[:k - len(above)]]  # ties at the cut: smallest ids
            else:
                pick = np.arange(len(row))
            pick = pick[np.lexsort((pick, -row[pick].astype(np.int64)))]
            ids = pick if others is None else others[pick]
            yield own, cid[ids], row[pick]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", factor: int = 256,
          query_block: int = 2048, candidate_block: int = 16384) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of all other rows for each row where ``is_query``.

    Rows without an id, or whose vector is null or holds null or non-finite components, take no part.
    Vectors of unequal length are compared as if the shorter one ended in zeros. Ties go to the smaller
    id; rows that share an id are separate candidates but never candidates of their own id. A query with
    fewer candidates gets all; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    v = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vec_col))).select(
        F.col(id_col).cast("long").alias("id"), scaled(F.col(vec_col), factor).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("q"))
    v = cut_lineage(v, "vectors")
    total, asks = v.agg(F.count(F.lit(1)), F.count(F.when(F.col("q"), 1))).first()
    cb, qb = max(1, -(-total // candidate_block)), max(1, -(-asks // query_block))
    spot = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cands = v.select("id", "vec", spot(cb, 1).alias("c")).withColumn("b", every(qb))
    queries = v.where("q").select("id", "vec", spot(qb, 2).alias("b")).withColumn("c", every(cb))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        width = max(_width(left), _width(right))
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            qid, cid = (np.asarray(t.column("id").to_numpy(), dtype=np.int64) for t in (left, right))
            for own, ids, scores in _best(qid, _matrix(left.column("vec"), width), cid, _matrix(right.column("vec"), width), k):
                out[0].append(np.full(len(ids), own, dtype=np.int64))
                out[1].append(ids)
                out[2].append(scores.astype(np.int64))
        cols = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in out]
        return pa.table(cols, names=["query_id", "vec_id", "score"])

    found = (queries.groupBy("c", "b").cogroup(cands.groupBy("c", "b"))
             .applyInArrow(meet, "query_id long, vec_id long, score long"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
