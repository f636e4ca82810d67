"""R-operators: BM25 against a hand computation, skew-safe join path, fusion, re-rank."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.index import bm25_index
from tessera.operators.retrieve import bm25_scores, bm25_topk, dense_topk, keyed_lists, rerank, rrf_fuse


@pytest.fixture()
def corpus(spark):
    docs = [(1, "apple banana apple"), (2, "banana cherry"), (3, "cherry cherry cherry date"), (4, "")]
    qs = [(10, "apple cherry"), (11, "banana banana"), (12, "zzz")]
    return (spark.createDataFrame(docs, "chunk_id long, text string"),
            spark.createDataFrame(qs, "query_id long, question string"))


def _bm25_python(docs, q, k1=1.5, b=0.75, eps=0.25):
    toks = {i: t.split() for i, t in docs}
    n = len(toks)
    avgdl = sum(len(v) for v in toks.values()) / n
    df = {}
    for v in toks.values():
        for w in set(v):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(n - f + 0.5) - math.log(f + 0.5) for w, f in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: (eps * mean if x < 0 else x) for w, x in idf.items()}
    out = {}
    for i, v in toks.items():
        s = 0.0
        for w in q.split():
            tf = v.count(w)
            s += idf.get(w, 0) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(v) / avgdl))
        out[i] = s
    return out


def test_bm25_matches_hand_computation(spark, corpus):
    d, q = corpus
    got = {(r.query_id, r.chunk_id): r.score for r in bm25_scores(q, bm25_index(d)).collect()}
    docs = [(r.chunk_id, r.text) for r in d.collect()]
    for qid, text in [(r.query_id, r.question) for r in q.collect()]:
        want = _bm25_python(docs, text)
        for cid, s in want.items():
            if s != 0:
                assert got[(qid, cid)] == pytest.approx(s, rel=1e-12)
            else:
                assert (qid, cid) not in got


def test_salted_join_path_equals_broadcast_path(spark, corpus):
    d, q = corpus
    idx = bm25_index(d)
    a = sorted(bm25_topk(q, idx, 3).collect())
    b = sorted(bm25_topk(q, idx, 3, broadcast_rows=0, rows_per_task=1).collect())
    assert a == b


def test_rrf_dedupes_by_content_and_breaks_ties_by_first_appearance(spark):
    dense = spark.createDataFrame([(1, 1, 100, 7), (1, 2, 200, 8)], "query_id long, rank int, chunk_id long, content_key long")
    sparse = spark.createDataFrame([(1, 1, 300, 8), (1, 2, 400, 9)], "query_id long, rank int, chunk_id long, content_key long")
    out = rrf_fuse([dense, sparse], [0.5, 0.5], k=10).orderBy("rank").collect()
    # key 8 appears in both lists (chunk 200 first, dense list first) -> highest score, keeps chunk 200
    assert [r.chunk_id for r in out] == [200, 100, 400]
    assert out[0].score == pytest.approx(0.5 / 62 + 0.5 / 61)
    # one empty list
    empty = sparse.where(F.lit(False))
    out2 = rrf_fuse([dense, empty], [0.5, 0.5], k=10).orderBy("rank").collect()
    assert [r.chunk_id for r in out2] == [100, 200]


def test_rerank_only_reorders_fetched(spark):
    cand = spark.createDataFrame([(1, 1, 10), (1, 2, 20)], "query_id long, rank int, chunk_id long")
    qs = spark.createDataFrame([(1, "red fox jumps")], "query_id long, question string")
    ps = spark.createDataFrame([(10, "blue whale"), (20, "the red fox jumps high"), (30, "red fox jumps")],
                               "chunk_id long, text string")
    out = rerank(cand, qs, ps, top_n=5).orderBy("rank").collect()
    assert [r.chunk_id for r in out] == [20, 10]  # 30 was never fetched


def _brute_topk(q, c, k):
    out = []
    for qid, x in q:
        s = sorted(((-round(sum(a * b for a, b in zip(x, y)), 9), cid) for cid, y in c))[:k]
        out += [(qid, rank, cid) for rank, (_, cid) in enumerate(s, 1)]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 64])
def test_dense_topk_with_zero_vectors_and_duplicates(spark, block_bytes):
    """Broadcast and blocked route: exactly k rows a query, ties to the smaller id."""
    c = [(i, [1.0, 0.0] if i % 3 else [0.0, 0.0]) for i in range(40)] + [(50, [0.6, 0.8]), (51, [0.6, 0.8])]
    q = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.6, 0.8]), (4, [0.0, 1.0]), (5, [0.6, 0.8])]
    got = dense_topk(spark.createDataFrame(q, "query_id long, vec array<double>"),
                     spark.createDataFrame(c, "chunk_id long, vec array<double>").repartition(3), 5, block_bytes=block_bytes)
    assert sorted((r.query_id, r["rank"], r.chunk_id) for r in got.collect()) == _brute_topk(q, c, 5)


def test_dense_topk_of_a_table_with_itself_in_blocks(spark):
    """Queries and corpus are the same rows: both routes give the brute-force neighbours."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[40:80] = x[0]
    v = spark.createDataFrame([(i, [float(y) for y in r]) for i, r in enumerate(x)], "id long, vec array<double>")
    q, c = v.select(F.col("id").alias("query_id"), "vec"), v.select(F.col("id").alias("chunk_id"), "vec")
    r = np.round(x @ x.T, 9)
    want = {(i, n + 1, int(j)) for i in range(300) for n, j in enumerate(np.lexsort((np.arange(300), -r[i]))[:7])}
    for kw in ({}, {"block_bytes": 4096}, {"block_rows": 10}):
        got = [(g.query_id, g.rank, g.chunk_id) for g in dense_topk(q, c, 7, **kw).collect()]
        assert len(got) == len(want) and set(got) == want


def test_a_task_hands_on_k_rows_a_query_whatever_its_batches(spark):
    """The broadcast route keeps the best over all batches of a task, with ids of text, null ids and vectors that hold NaN."""
    x = np.random.default_rng(8).normal(size=(500, 4))
    x[10] = np.nan
    ids = [None if i == 7 else f"c{i:03d}" for i in range(500)]
    c = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "chunk_id string, vec array<double>").coalesce(1)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:3])], "query_id long, vec array<double>")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "60")
    try:
        got = dense_topk(q, c, 5)
        rows = [(r.query_id, r["rank"], r.chunk_id) for r in got.collect()]
        plan = got._jdf.queryExecution()
        metric = {}
        def walk(p):
            if p.nodeName() == "AdaptiveSparkPlan":
                p = p.executedPlan()
            if "MapInArrow" in p.nodeName():
                m = p.metrics().get("pythonNumRowsReceived")
                metric["n"] = m.get().value() if m.isDefined() else None
            ch = p.children()
            for i in range(ch.size()):
                walk(ch.apply(i))
            if p.nodeName().endswith("QueryStage"):
                walk(p.plan())
        walk(plan.executedPlan())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    s = np.round(x @ x[:3].T, 9)
    want = [(j, n + 1, ids[i]) for j in range(3) for n, i in enumerate([i for i in np.lexsort((np.arange(500), -s[:, j])) if i != 10][:5])]
    assert sorted(rows, key=str) == sorted(want, key=str)
    assert metric["n"] == 15  # 9 batches with 3 queries, yet 5 rows for each query


def test_dense_topk_of_empty_sides(spark):
    q = spark.createDataFrame([(1, [1.0])], "query_id long, vec array<double>")
    c = spark.createDataFrame([], "chunk_id long, vec array<double>")
    for block_bytes in (1 << 20, 4):
        assert dense_topk(q, c, 3, block_bytes).count() == 0
        assert dense_topk(q.where("false"), q.withColumnRenamed("query_id", "chunk_id"), 3, block_bytes).count() == 0


def test_content_keys_are_those_of_the_texts(spark, corpus):
    d, _ = corpus
    a = spark.createDataFrame([(7, 1, 1, 0.5), (7, 2, 3, 0.4)], "query_id long, rank int, chunk_id long, score double")
    b = a.where("rank = 2")
    one, two = keyed_lists([a, b], d)
    want = {r.chunk_id: r.h for r in d.select("chunk_id", F.xxhash64("text").alias("h")).collect()}
    assert {(r.chunk_id, r.content_key) for r in one.collect()} == {(i, want[i]) for i in (1, 3)}
    assert [(r.chunk_id, r.content_key) for r in two.collect()] == [(3, want[3])]


def test_rerank_weighs_terms_by_their_index(spark):
    docs = [(1, "The rare thing and the end"), (2, "the and the and of the"), (3, "THE rare"), (4, "of the end"), (5, "")]
    d = spark.createDataFrame(docs, "chunk_id long, text string")
    q = spark.createDataFrame([(10, "The RARE of"), (11, "zzz the"), (12, "")], "query_id long, question string")
    idx = bm25_index(d)
    from tessera.operators.retrieve import question_weights

    low = {i: t.lower().split() for i, t in docs}
    spellings = {}
    for _, t in docs:
        for w in set(t.split()):
            spellings.setdefault(w.lower(), {}).setdefault(w, 0)
            spellings[w.lower()][w] += 1

    def weight(term):
        df = min(sum(spellings.get(term, {}).values()), len(docs))
        return math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))

    cand = spark.createDataFrame([(qid, i, i) for qid in (10, 11, 12) for i, _ in docs], "query_id long, rank int, chunk_id long")
    got = {(r.query_id, r.chunk_id): r.score for r in rerank(cand, q, d, top_n=5, weights=question_weights(q, idx)).collect()}
    for qid, text in ((10, "the rare of"), (11, "zzz the"), (12, "")):
        terms = text.split()
        pairs = list(dict.fromkeys(zip(terms, terms[1:])))
        for i, _ in docs:
            cov = sum(weight(t) for t in set(terms) if t in low[i]) / sum(weight(t) for t in set(terms)) if terms else 0.0
            hit = sum(p in list(zip(low[i], low[i][1:])) for p in pairs) / len(pairs) if pairs else 0.0
            assert got[qid, i] == pytest.approx((cov + hit) / 2), (qid, i)
    assert got[10, 3] > got[10, 2]  # the rare term outweighs the common ones
