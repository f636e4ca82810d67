"""R2: approximate dense top-k over a coarse quantiser.

Centroids are fitted on a bounded sample; every vector is stored in the cell of its nearest centroid. A query looks
at the cells of its nearest centroids only and scores every vector there exactly. How many cells that are is measured
when the index is built: as few as find the wanted share of the sample's true neighbours, which is few where the vectors
lie in clusters and many where they do not. A cell has no bound, so large ones are worked off in parts of bounded
size, and nothing of a cell is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.retrieve import RANK_DIGITS, _matrix, _score_order, _tile_topk, arrow_matrix, packed, packed_rows, rank_within, vec_bytes
from tessera.session import cut_lineage, delete_paths, stored_copies

#: Vectors that the centroids are fitted on, at most so many and of at most so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 50_000, 64 << 20
MAX_CELLS = 4096
ROUNDS = 12
#: Vectors of a cell, and queries that ask it, which meet in one group of the shuffle route.
PART_ROWS = 20_000
#: Rows beyond twice the best ones that a task gathers before it drops the others.
HELD_ROWS = 200_000
#: Share of the neighbours that a query should find, measured with so many queries and neighbours of the sample.
RECALL, TRIED, NEIGHBOURS = 0.95, 300, 10


def cells_for(rows: int) -> int:
    return max(1, min(MAX_CELLS, round(math.sqrt(rows))))


def _extent(vectors: DataFrame) -> tuple[int, int]:
    """Length and number of the ``vectors``."""
    size, n = vectors.agg(F.coalesce(F.max(vec_bytes(vectors)), F.lit(0)), F.count(F.lit(1))).first()
    return size // 8, n


def sample_of(vectors: DataFrame, sample_rows: int = SAMPLE_ROWS, extent: tuple[int, int] | None = None) -> np.ndarray:
    """The ``vectors(chunk_id, vec)`` with the least hashes of their ids, so a rerun takes the same. ``extent``: what
    :func:`_extent` says of them."""
    dim, n = extent or _extent(vectors)
    sample_rows = _sample_size(dim, sample_rows)
    head = _small_hashes(vectors, n, sample_rows)
    return _sample(vectors if head is None else head, dim, sample_rows)


def _sample_size(dim: int, sample_rows: int) -> int:
    return max(1, min(sample_rows, SAMPLE_BYTES // (8 * max(dim, 1))))


def _small_hashes(rows: DataFrame, n: int, sample_rows: int) -> DataFrame | None:
    """Those of the ``n`` ``rows(chunk_id, ...)`` that hold the ``sample_rows`` least hashes and not many others; None if most rows
    would be among them. Hashes are even, so only rows with small ones are sorted and sent; ids that repeat may leave too few."""
    share = 1.25 * sample_rows / max(n, 1)
    if share < 0.5:
        some = rows.where(F.xxhash64("chunk_id") < F.lit(int(-2 ** 63 + share * 2 ** 64)))
        if sample_rows <= some.select("chunk_id").count() <= 2 * sample_rows:
            return some
    return None


def _sample(vectors: DataFrame, dim: int, sample_rows: int) -> np.ndarray:
    # what is not small is packed by all tasks, before one of them sorts
    vectors, h = packed(vectors), F.xxhash64("chunk_id")
    # the one task that holds the sample sends it, whatever the session's way to collect
    with stored_copies() as own:
        stored = cut_lineage(vectors.orderBy(h, "chunk_id").limit(sample_rows).select(h.alias("h"), "chunk_id", "vec"), "sample")
    head = stored.toArrow().sort_by([("h", "ascending"), ("chunk_id", "ascending")])
    delete_paths(vectors.sparkSession, own)
    return arrow_matrix(head["vec"]) if head.num_rows else np.zeros((0, dim))


def probes_needed(x: np.ndarray, centroids: np.ndarray, recall: float = RECALL) -> int:
    """The least number of cells in which the first rows of ``x`` find so large a share of their nearest other rows. A
    sample is thinner than the whole, so its neighbours lie farther apart and the number rather errs upwards."""
    q = x[:TRIED]
    if len(x) < 2:
        return len(centroids)
    own = nearest(x, centroids, 1)[0][:, 0]
    order = nearest(q, centroids, len(centroids))[0]
    place = np.empty_like(order)  # of each cell in the query's order
    np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1]), order.shape).copy(), axis=1)
    s = q @ x.T
    s[np.arange(len(q)), np.arange(len(q))] = -np.inf
    n = min(NEIGHBOURS, len(x) - 1)
    near = np.argpartition(-s, n - 1, axis=1)[:, :n]
    at = np.sort(np.take_along_axis(place, own[near], axis=1).ravel())
    return int(at[min(len(at) - 1, math.ceil(recall * len(at)) - 1)]) + 1


def fit_centroids(x: np.ndarray, cells: int, seed: int = 7) -> np.ndarray:
    """Spherical k-means on the rows of ``x``. A centroid that loses all its vectors moves to the one that is farthest
    from its own. Without vectors: one centroid of no length."""
    if not len(x):
        return np.zeros((1, x.shape[1]))
    rng = np.random.default_rng(seed)
    c = x[np.sort(rng.permutation(len(x))[:min(cells, len(x))])].copy()
    for _ in range(ROUNDS):
        near, score = nearest(x, c, 1)
        own = near[:, 0]
        sums = np.zeros_like(c)
        by, held = np.argsort(own, kind="stable"), np.unique(own)
        sums[held] = np.add.reduceat(x[by], np.searchsorted(own[by], held), axis=0)
        empty = np.flatnonzero(np.bincount(own, minlength=len(c)) == 0)
        sums[empty] = x[np.argsort(score[:, 0], kind="stable")[:len(empty)]]
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        c = np.divide(sums, norm, out=c.copy(), where=norm > 0)
    return c


def nearest(x: np.ndarray, centroids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the ``n`` best centroids of each row, best first, in slabs of bounded size."""
    out, scores = np.empty((len(x), n), dtype=np.int64), np.empty((len(x), n))
    step = max(1, (32 << 20) // (8 * len(centroids)))
    for at in range(0, len(x), step):
        s = x[at:at + step] @ centroids.T
        if n == 1:
            best = np.argmax(s, axis=1)[:, None]
            out[at:at + step], scores[at:at + step] = best, np.take_along_axis(s, best, axis=1)
            continue
        top = np.argpartition(-s, n - 1, axis=1)[:, :n] if n < s.shape[1] else np.broadcast_to(np.arange(s.shape[1]), s.shape)[:, :n]
        order = np.argsort(-np.take_along_axis(s, top, axis=1), axis=1, kind="stable")
        out[at:at + step] = np.take_along_axis(top, order, axis=1)
        scores[at:at + step] = np.take_along_axis(s, out[at:at + step], axis=1)
    return out, scores


def assign_cells(vectors: DataFrame, centroids: np.ndarray, files: np.ndarray) -> DataFrame:
    """``chunk_id, vec, cell, files`` of every row of ``vectors`` that has one, packed; ``files`` is a number for each cell."""
    import pyarrow as pa

    shared = vectors.sparkSession.sparkContext.broadcast((centroids, files))  # at most MAX_CELLS rows
    schema = T.StructType([vectors.schema["chunk_id"], T.StructField("vec", T.BinaryType()), T.StructField("cell", T.IntegerType()), T.StructField("files", T.IntegerType())])

    def run(batches: Iterable) -> Iterator:
        c, files = shared.value
        for b in batches:
            b = b.filter(b.column(1).is_valid())
            if b.num_rows:
                m = arrow_matrix(b.column(1))
                cell = nearest(m, c, 1)[0][:, 0]
                yield pa.RecordBatch.from_arrays([b.column(0), packed_rows(m), pa.array(cell, pa.int32()), pa.array(files[cell], pa.int32())], schema.names)

    return vectors.select("chunk_id", "vec").mapInArrow(run, schema)


def files_for(sample: np.ndarray, centroids: np.ndarray, rows: int, file_rows: int = PART_ROWS) -> np.ndarray:
    """How many files each cell is dealt out to: of about ``file_rows`` rows, by the cell's share of the sample."""
    if not len(sample):
        return np.ones(len(centroids), dtype=np.int64)
    share = np.bincount(nearest(sample, centroids, 1)[0][:, 0], minlength=len(centroids)) / len(sample)
    return np.maximum(1, np.ceil(share * rows / file_rows)).astype(np.int64)


@dataclass
class CellIndex:
    """``vectors(chunk_id, vec, cell)``, packed and stored by cell; how many each cell holds; the cells a query should look at."""

    vectors: DataFrame
    centroids: np.ndarray
    sizes: dict[int, int]
    probes: int


def embed_cells(passages: DataFrame, embedder, path: str, cells: int | None = None, sample_rows: int = SAMPLE_ROWS) -> dict:
    """:func:`build_cells` for the vectors of ``passages(chunk_id, text)``. Of many passages those of the sample are embedded
    first, and then all of them on their way to their cells, so no vector is stored twice; fewer are embedded and stored once."""
    embed = lambda p: embedder.embed(p, "text", "passage").select("chunk_id", "vec")
    n, size = passages.count(), _sample_size(embedder.dim, sample_rows)
    some = _small_hashes(passages, n, size)
    if some is not None:
        sample = _sample(embed(some), embedder.dim, size)
        return _store_cells(embed(passages), path, sample, cells or cells_for(n), n, RECALL)
    temp = cut_lineage(packed(embed(passages)), path=f"{path}/embedded")
    about = build_cells(temp, path, cells, sample_rows)
    delete_paths(passages.sparkSession, [f"{path}/embedded"])
    return about


def build_cells(vectors: DataFrame, path: str, cells: int | None = None, sample_rows: int = SAMPLE_ROWS, recall: float = RECALL) -> dict:
    """Stores ``vectors(chunk_id, vec)`` under ``path`` in a partition for each cell; rows without a vector are left out.
    Gives what :func:`open_cells` needs besides the files. The vectors are L2-normalised (E2)."""
    v = packed(vectors)
    extent = _extent(v)
    sample = sample_of(v, sample_rows, extent)
    return _store_cells(v, path, sample, cells or cells_for(extent[1]), extent[1], recall)


def _store_cells(v: DataFrame, path: str, sample: np.ndarray, cells: int, n: int, recall: float) -> dict:
    spark = v.sparkSession
    centroids = fit_centroids(sample, cells)
    # a large cell is written by several tasks, a small one to one file
    spread = F.pmod(F.xxhash64("chunk_id"), F.col("files"))
    (assign_cells(v, centroids, files_for(sample, centroids, n)).repartition("cell", spread).drop("files")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy("cell").parquet(f"{path}/vectors"))
    kept = T.StructType([v.schema["chunk_id"], T.StructField("vec", T.BinaryType())])
    stored = spark.read.schema(T.StructType([*kept.fields, T.StructField("cell", T.IntegerType())])).parquet(f"{path}/vectors")
    about = stored.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("chunk_id")).alias("h")).collect()  # a row a cell
    ids = 0
    for r in about:
        ids ^= r["h"]
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centroids)]
    spark.createDataFrame(rows, "cell int, vec array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    return {"n": sum(r["n"] for r in about), "ids": ids, "cells": len(centroids), "sizes": {str(r["cell"]): r["n"] for r in about}, "probes": probes_needed(sample, centroids, recall), "schema": kept.jsonValue()}


def open_cells(spark, path: str, about: dict) -> CellIndex:
    schema = T.StructType.fromJson(about["schema"]).add("cell", T.IntegerType())
    rows = sorted(spark.read.parquet(f"{path}/centroids").collect())  # at most MAX_CELLS
    return CellIndex(spark.read.schema(schema).parquet(f"{path}/vectors"), np.array([r["vec"] for r in rows], dtype=float),
                     {int(c): n for c, n in about["sizes"].items()}, about["probes"])


def approx_topk(queries: DataFrame, index: CellIndex, k: int = 10, probes: int | None = None, block_bytes: int = 32 << 20,
                part_rows: int = PART_ROWS) -> DataFrame:
    """R2: ``query_id, rank, chunk_id, score`` of the best ``k`` among the vectors of each query's ``probes`` nearest cells (by
    default as many as the index was measured to need); scores are exact cosines, ties go to the smaller id, and probing all cells gives R1. ``queries(query_id, vec)``.

    Queries of at most ``block_bytes`` are broadcast, and only partitions that one of them probes are read, without a
    shuffle. More queries meet their cells in a shuffle by (cell, part of the cell, part of its queries), where neither
    part has more than about ``part_rows`` rows.
    """
    spark = queries.sparkSession
    probes = min(probes or index.probes, len(index.centroids))
    schema = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType),
                           T.StructField("chunk_id", index.vectors.schema["chunk_id"].dataType), T.StructField("score", T.DoubleType())])
    queries = queries.select("query_id", "vec").where("vec is not null")
    q_bytes = queries.agg(F.coalesce(F.sum(8 * F.size("vec").cast("long")), F.lit(0))).first()[0]
    if q_bytes <= block_bytes:
        cand = _stream_cells(queries, index, k, probes, schema)
    else:
        cand = _meet_cells(cut_lineage(queries, "queries"), index, k, probes, schema, part_rows)
    return rank_within(cand, ["query_id"], _score_order(), k).select("query_id", "rank", "chunk_id", "score")


def best_of(parts: list[pd.DataFrame], k: int) -> pd.DataFrame:
    """The best ``k`` rows of each query in ``parts``, ties to the smaller id."""
    d = pd.concat(parts, ignore_index=True)
    d["_r"] = d["score"].round(RANK_DIGITS)
    return d.sort_values(["query_id", "_r", "chunk_id"], ascending=[True, False, True]).groupby("query_id", sort=False).head(k).drop(columns="_r")


def _stream_cells(queries: DataFrame, index: CellIndex, k: int, probes: int, schema: T.StructType) -> DataFrame:
    head = queries.toPandas()  # at most block_bytes of vectors
    q_ids = head["query_id"].to_numpy()
    qm = _matrix(head["vec"]) if len(head) else np.zeros((0, index.centroids.shape[1]))
    near = nearest(qm, index.centroids, probes)[0]
    asked = {int(c): np.flatnonzero((near == c).any(axis=1)) for c in np.unique(near)}
    shared = queries.sparkSession.sparkContext.broadcast((q_ids, qm, asked))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, m, by_cell = shared.value
        held: list[pd.DataFrame] = []
        size = 0
        for b in batches:
            for cell, own in b.groupby("cell", sort=False):
                rows = by_cell.get(int(cell))
                if rows is None:
                    continue
                for part in _tile_topk(ids[rows], m[rows], own["chunk_id"].to_numpy(), _matrix(own["vec"]), k):
                    held.append(part)
                    size += len(part)
                    if size > HELD_ROWS + 2 * k * len(ids):
                        held = [best_of(held, k)]
                        size = len(held[0])
        if held:
            yield best_of(held, k)

    return index.vectors.where(F.col("cell").isin(sorted(asked))).mapInPandas(run, schema)


def _meet_cells(queries: DataFrame, index: CellIndex, k: int, probes: int, schema: T.StructType, part_rows: int) -> DataFrame:
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast(index.centroids)

    def probe(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                near = nearest(_matrix(b["vec"]), shared.value, probes)[0]
                yield pd.DataFrame({"query_id": b["query_id"], "cells": list(near.astype(np.int32))})

    wanted = queries.mapInPandas(probe, T.StructType([schema["query_id"], T.StructField("cells", T.ArrayType(T.IntegerType()))]))
    wanted = cut_lineage(wanted.select("query_id", F.explode("cells").alias("cell")), "probes")
    asks = {r["cell"]: r["count"] for r in wanted.groupBy("cell").count().collect()}  # a row a cell
    parts = spark.createDataFrame([(c, -(-n // part_rows), max(1, -(-asks.get(c, 0) // part_rows))) for c, n in index.sizes.items()], "cell int, parts int, asks int")
    spot = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    parts = F.broadcast(parts)
    q = wanted.join(parts, "cell").withColumn("ask", spot("query_id", "asks")).withColumn("part", every("parts")).join(queries, "query_id")
    c = index.vectors.where(F.col("cell").isin(sorted(asks))).join(parts, "cell").withColumn("part", spot("chunk_id", "parts")).withColumn("ask", every("asks"))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": a["query_id"][:0], "chunk_id": b["chunk_id"][:0], "score": pd.Series(dtype=float)})
        return pd.concat(_tile_topk(a["query_id"].to_numpy(), _matrix(a["vec"]), b["chunk_id"].to_numpy(), _matrix(b["vec"]), k))

    by = ["cell", "part", "ask"]
    return q.select(*by, "query_id", "vec").groupBy(*by).cogroup(c.select(*by, "chunk_id", "vec").groupBy(*by)).applyInPandas(meet, schema)
