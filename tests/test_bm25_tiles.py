"""The term index counted by passage, and BM25 by tiles: the same rows as by joins, for any ids, ties and batches."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.operators.index import _count_terms, bm25_index
from tessera.operators.retrieve import _merge_best, bm25_topk


def test_term_index_counts_passages_without_a_row_for_each_token(spark):
    d = spark.createDataFrame([(None, " a b"), (None, "c a"), ("x", "a  a b"), ("x", "b a a"), ("x", "a"), ("y", None), ("z", "  "), ("w", "'x,' É")],
                              "chunk_id string, text string")
    idx = bm25_index(d, materialize=False)
    plan = idx.postings._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    assert sorted(map(str, idx.postings.select("term", "chunk_id", "dl", "tf").collect())) == sorted(
        f"Row(term={t!r}, chunk_id={c!r}, dl={dl}, tf={tf})" for t, c, dl, tf in [
            ("a", None, 2, 2), ("b", None, 2, 1), ("c", None, 2, 1), ("a", "x", 3, 4), ("b", "x", 3, 2), ("a", "x", 1, 1), ("'x,'", "w", 2, 1), ("É", "w", 2, 1)])
    # N counts an id and length once for each piece that its texts begin with
    assert spark.range(1).select(idx.n_docs).first()[0] == 8.0


def test_term_counts_do_not_depend_on_batches():
    rows = [(i // 3, w, len(w.split())) for i, w in enumerate(["a b", "b a", "c", "", " a", "a a a", "a b", "a b", "a b"])]
    rows.sort(key=lambda r: (r[0], r[2]))
    kinds = pa.schema([("chunk_id", pa.int64()), ("text", pa.string()), ("dl", pa.int32())])
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), kinds.types)], schema=kinds)
    got = [sorted(str(r) for out in _count_terms(iter(bs)) for r in out.to_pylist()) for bs in ([batch(rows)], [batch([r]) for r in rows])]
    assert got[0] == got[1] and len(got[0]) == 9


def test_bm25_by_tiles_is_bm25_by_join(spark):
    r = random.Random(3)
    text = lambda: " ".join(r.choice("abcdefghij") for _ in range(r.randint(0, 9)))
    d = spark.createDataFrame([(r.choice([None, i, i, i, 7]), text()) for i in range(300)] + [(1000 + i, "a b c") for i in range(40)], "chunk_id long, text string")
    q = spark.createDataFrame([(i, text()) for i in range(30)] + [(None, "a j"), (3, "b b")], "query_id long, question string")
    idx = bm25_index(d)
    tiles, join = bm25_topk(q, idx, 7), bm25_topk(q, idx, 7, broadcast_rows=0)
    plan = tiles._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan  # no row for each query and passage that share a term
    a, b = (sorted(map(str, x.select("query_id", "rank", "chunk_id", F.round("score", 8)).collect())) for x in (tiles, join))
    assert a == b and len(a) > 100


def test_terms_of_few_and_of_many_queries_add_up(monkeypatch):
    from tessera.operators import retrieve as R

    r = np.random.default_rng(6)
    m = np.where(r.random((30, 12)) < 0.3, r.normal(size=(30, 12)), 0.0)
    m[3] = 0
    hits = [[{"t": int(t), "w": float(r.random())} for t in r.integers(0, 30, r.integers(0, 9))] for _ in range(50)]
    hits = [[h for i, h in enumerate(hs) if h["t"] not in {x["t"] for x in hs[:i]}] for hs in hits]
    b = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(hits, pa.list_(pa.struct([("t", pa.int32()), ("w", pa.float64())])))], ["chunk_id", "hits"])
    want = np.array([sum((m[h["t"]] * h["w"] for h in hs), np.zeros(12)) for hs in hits])
    for few in (0, 3, 99):  # all by the product, some, none
        monkeypatch.setattr(R, "FEW_QUERIES", few)
        assert np.allclose(R._bm25_tile(b, m, R._term_parts(m)), want, atol=1e-12)
        assert np.allclose(R._bm25_tile(b.slice(7, 20), m, R._term_parts(m)), want[7:27], atol=1e-12)


def test_best_of_tiles_is_best_of_all():
    r = np.random.default_rng(4)
    m, ids = r.integers(0, 3, (5, 6)).astype(float), np.arange(90)
    r.shuffle(ids)
    hits = [[{"t": int(t), "w": float(r.integers(1, 4))} for t in r.permutation(5)[:r.integers(0, 4)]] for _ in ids]
    b = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(hits, pa.list_(pa.struct([("t", pa.int32()), ("w", pa.float64())])))], ["chunk_id", "hits"])
    score = np.array([sum((m[h["t"]] * h["w"] for h in hs), np.zeros(6)) for hs in hits])
    want = {(q, int(i), s) for q in range(6) for s, i in sorted([(score[j, q], -ids[j]) for j in range(90) if score[j, q]], reverse=True)[:4] for i in [-i]}
    for step in (1, 7, 90):
        best = None
        for at in range(0, 90, step):
            best = _merge_best(best, b.slice(at, step), m, 4)
        assert {(int(q), i, s) for q, i, s in zip(best[0], best[1].to_pylist(), best[2])} == want
