"""Stored indexes (E5, E7, E8, R10) and approximate dense top-k (R2)."""

from __future__ import annotations

import uuid

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tessera.operators import approx as P
from tessera.operators import retrieve as R
from tessera.operators import stored as I
from tessera.operators.index import HashedEmbedder, bm25_index
from tessera.plans import retrieval as Q
from tessera.session import checkpoint_dir, cut_lineage
from tessera.sources.driver import doc_passages, questions


def _fresh(spark):
    return f"{checkpoint_dir(spark)}/index-{uuid.uuid4().hex}"


def _files(spark, path):
    return {r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").collect()}


PASSAGES = [(1, "s/1", "apple banana apple"), (2, "s/2", "banana cherry"), (3, "s/3", "cherry cherry date"), (4, "s/4", ""), (5, "s/5", None)]


def _passages(spark, rows=PASSAGES):
    return spark.createDataFrame(rows, "chunk_id long, source_path string, text string")


def test_a_second_build_writes_nothing_and_a_changed_input_replaces_the_index(spark):
    path, emb = _fresh(spark), HashedEmbedder(dim=16, model="hashed-16")
    first = I.build_index(_passages(spark), path, "fixed", emb)
    before = _files(spark, path)
    again = I.build_index(_passages(spark).repartition(3), path, "fixed", emb)
    assert _files(spark, path) == before and again.made == first.made
    changed = I.build_index(_passages(spark, [*PASSAGES, (6, "s/6", "elder")]), path, "fixed", emb)
    after = _files(spark, path)
    assert not after & before  # the old version is gone, manifest and all
    assert {m["version"] for m in changed.made.values()} == {2} and changed.keys.count() == 6
    assert I.open_stored(spark, path, "fixed", "hashed-16").vectors.count() == 6


def test_a_build_that_broke_off_is_passed_over(spark):
    base, made = f"{_fresh(spark)}/part", []

    def fails(folder):
        spark.range(3).write.parquet(f"{folder}/x")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        I.build_part(spark, base, "a", fails)
    assert I.manifests(spark, base) == []
    for state in ("a", "a", "b"):
        m = I.build_part(spark, base, state, lambda folder: made.append(folder) or {"n": 1})
    assert len(made) == 2 and m["version"] == 2 and len(I.manifests(spark, base)) == 1


def test_two_models_share_postings_and_keys(spark):
    path = _fresh(spark)
    I.build_index(_passages(spark), path, "fixed", HashedEmbedder(dim=16, model="org/Model A"))
    before = _files(spark, path)
    I.build_index(_passages(spark), path, "fixed", HashedEmbedder(dim=8, model="org/Model B"))
    new = {f for f in _files(spark, path) - before}
    assert new and all("vectors_fixed_model-b" in f for f in new)


def test_missing_and_unequal_parts_fail_clearly(spark):
    path, emb = _fresh(spark), HashedEmbedder(dim=16, model="m")
    with pytest.raises(ValueError, match="not built"):
        I.open_stored(spark, path, "fixed", "m")
    I.build_index(_passages(spark), path, "fixed", emb, state="x", parts=("postings",))
    I.build_index(_passages(spark, PASSAGES[:4]), path, "fixed", emb, state="y", parts=("vectors",))
    with pytest.raises(ValueError, match="different passages"):  # R10: before anything is fused
        I.open_stored(spark, path, "fixed", "m", ("postings", "vectors"))
    swapped = [(9, s, t) if i == 1 else (i, s, t) for i, s, t in PASSAGES]  # as many, but others
    with pytest.raises(ValueError, match="different passages"):
        I.build_index(_passages(spark, swapped), path, "fixed", emb, state="x", parts=("postings", "vectors"))
    with pytest.raises(ValueError, match="without its part"):
        I.open_stored(spark, path, "fixed", "m", ("postings",)).keys


def test_retrieval_from_an_opened_index_equals_one_from_passages(spark):
    passages, qs = doc_passages(spark, SF001), questions(spark, SF001)
    index = I.build_index(passages, _fresh(spark), "document", HashedEmbedder())
    index = I.open_stored(spark, index.folders["keys"].rsplit("/", 3)[0], "document", HashedEmbedder().model)
    for method in R.METHODS:
        a = R.retrieve(qs, passages, method, k=5, index=index).withColumn("score", F.round("score", 9)).collect()
        b = R.retrieve(qs, passages, method, k=5).withColumn("score", F.round("score", 9)).collect()
        assert sorted(a) == sorted(b), method
    many = R.retrieve_many(qs, passages, list(R.METHODS), k=5, fetch_k=20, index=index)
    assert sorted(many["hybrid_rerank"].select("query_id", "rank", "chunk_id").collect()) == sorted(r[:3] for r in a)


def test_opened_indexes_read_and_shuffle_no_text(spark):
    Q.q_bm25_topk(spark, SF001)
    for df in (Q.q_bm25_topk(spark, SF001), Q.q_dense_docs(spark, SF001)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "text#" not in plan.replace("question", "").split("BroadcastExchange")[0]
        scans = [line for line in plan.split("\n") if "FileScan" in line]
        assert not any("documents.parquet" in line for line in scans), scans
        assert "NestedLoop" not in plan
    assert "Bucketed: true" in Q.q_bm25_topk(spark, SF001)._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------------------------------------ R2


def _clustered(n, dim, seed=3):
    c, rng = np.random.default_rng(1).normal(size=(12, dim)), np.random.default_rng(seed)
    x = c[rng.integers(0, 12, n)] + 0.7 * rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _frame(spark, x, name="chunk_id", first=0):
    return spark.createDataFrame([(first + i, v.tolist()) for i, v in enumerate(x)], f"{name} long, vec array<double>").repartition(4)


def _recall(got, exact):
    want = {(r.query_id, r.chunk_id) for r in exact.collect()}
    return len(want & {(r.query_id, r.chunk_id) for r in got.collect()}) / len(want)


def test_recall_on_the_given_embeddings(spark):
    sf = SF001.replace("sf0.001", "sf0.1")
    got = Q.q_dense_approx(spark, sf)
    exact = Q.q_dense_topk(spark, sf).where("query_id % 20 = 0")
    both = got.join(exact.withColumnsRenamed({"score": "exact", "rank": "r"}), ["query_id", "vec_id"])
    assert both.count() >= 0.9 * exact.count() and both.where("score <> exact").count() == 0
    assert got.groupBy("query_id").count().where("count <> 10").count() == 0
    about = I.manifests(spark, f"{Q.index_folder(spark, sf)}/embeddings")[-1]["about"]
    assert about["probes"] < about["cells"] == 45, about["probes"]  # these vectors lie in no clusters, yet not everywhere is looked


@pytest.mark.parametrize("block_bytes", [32 << 20, 0])
def test_approximate_top_k_on_both_routes(spark, block_bytes):
    x, y = _clustered(3000, 16), _clustered(150, 16, seed=4)
    x[100:130] = x[100]  # ties
    corpus, queries = _frame(spark, x), _frame(spark, y, "query_id", 10_000)
    path = _fresh(spark)
    index = P.open_cells(spark, path, P.build_cells(corpus, path, cells=40))
    assert sum(index.sizes.values()) == 3000 and index.vectors.count() == 3000
    assert index.probes <= 12  # clusters: a query looks at few cells
    exact = R.dense_topk(queries, corpus, 10)
    got = cut_lineage(P.approx_topk(queries, index, 10, block_bytes=block_bytes, part_rows=50))
    assert _recall(got, exact) >= 0.9
    scores = {(r.query_id, r.chunk_id): r.score for r in got.collect()}
    for (q, c), s in scores.items():
        assert s == pytest.approx(float(y[q - 10_000] @ x[c]), abs=1e-9)
    whole = P.approx_topk(queries, index, 10, probes=40, block_bytes=block_bytes, part_rows=50)  # all cells: exact
    key = lambda d: sorted((r.query_id, r.rank, r.chunk_id) for r in d.collect())
    assert key(whole) == key(exact)


def test_a_cell_that_holds_almost_everything_is_met_in_parts(spark):
    rng = np.random.default_rng(0)
    x = np.r_[np.tile([[1.0, 0.0, 0.0]], (900, 1)), rng.normal(size=(20, 3))]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    path = _fresh(spark)
    index = P.open_cells(spark, path, P.build_cells(_frame(spark, x), path, cells=4))
    assert max(index.sizes.values()) >= 900
    q = _frame(spark, x[:200], "query_id")
    got = P.approx_topk(q, index, 5, probes=4, block_bytes=0, part_rows=100).collect()
    assert len(got) == 1000 and {(r.rank, r.chunk_id) for r in got} == {(i + 1, i) for i in range(5)}
    groups = P._meet_cells(q, index, 5, 4, R.dense_topk(q, _frame(spark, x), 1).select("query_id", "chunk_id", "score").schema, 100)
    assert "NestedLoop" not in groups._jdf.queryExecution().executedPlan().toString()


def test_odd_vectors(spark):
    empty = spark.createDataFrame([], "chunk_id long, vec array<double>")
    path = _fresh(spark)
    index = P.open_cells(spark, path, P.build_cells(empty, path))
    assert P.approx_topk(empty.withColumnRenamed("chunk_id", "query_id"), index).count() == 0
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, 0.0])], "chunk_id long, vec array<double>")
    path = _fresh(spark)
    index = P.open_cells(spark, path, P.build_cells(few, path, cells=9))
    q = spark.createDataFrame([(7, [1.0, 0.0]), (8, None), (9, [0.0, 0.0])], "query_id long, vec array<double>")
    for block in (32 << 20, 0):
        got = sorted((r.query_id, r.rank, r.chunk_id) for r in P.approx_topk(q, index, 2, block_bytes=block).collect())
        assert got[:2] == [(7, 1, 1), (7, 2, 4)] and {g[0] for g in got} == {7, 9}


def test_a_plain_bm25_index_still_builds_without_a_folder(spark):
    d = _passages(spark).select("chunk_id", "text")
    path = _fresh(spark)
    stored = I.build_index(_passages(spark), path, "x", HashedEmbedder(dim=4, model="m"), parts=("postings",)).bm25
    q = spark.createDataFrame([(1, "banana cherry"), (2, "none")], "query_id long, question string")
    a, b = (sorted(map(tuple, R.bm25_topk(q, i, 3).withColumn("score", F.round("score", 9)).collect())) for i in (stored, bm25_index(d)))
    assert a == b and len(a) == 3


def test_sample_is_the_rows_of_least_hashes_and_few_are_sorted(spark):
    from tessera.operators import approx as A

    v = spark.range(0, 4000, numPartitions=8).select(F.col("id").alias("chunk_id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vec"))
    want = [r.chunk_id for r in v.orderBy(F.xxhash64("chunk_id"), "chunk_id").limit(300).collect()]
    assert A.sample_of(v, 300)[:, 0].astype(int).tolist() == want
    same = v.withColumn("chunk_id", F.lit(5).cast("long"))  # one id throughout: hashes say nothing
    assert A.sample_of(same, 300).shape == (300, 2)


def test_vectors_are_packed_and_lie_in_one_file_for_each_small_cell(spark):
    x = _clustered(600, 8)
    path = _fresh(spark)
    about = P.build_cells(_frame(spark, x), path, cells=12)
    index = P.open_cells(spark, path, about)
    assert index.vectors.schema["vec"].dataType.typeName() == "binary"
    got = {r.chunk_id: np.frombuffer(r.vec, dtype="<f8") for r in index.vectors.collect()}
    assert len(got) == 600 and all((got[i] == x[i]).all() for i in range(600))
    assert len([f for f in _files(spark, f"{path}/vectors") if f.endswith(".parquet")]) == len(about["sizes"]) <= 12
    q = _frame(spark, x[:40], "query_id")
    key = lambda d: sorted((r.query_id, r.rank, r.chunk_id) for r in d.collect())
    lists = key(R.dense_topk(q, _frame(spark, x), 6))
    assert lists == key(R.dense_topk(q, index.vectors, 6)) == key(R.dense_topk(q, index.vectors, 6, block_bytes=512))


def test_a_large_cell_is_dealt_out_to_many_files():
    sample = np.r_[np.tile([[1.0, 0.0]], (90, 1)), np.tile([[0.0, 1.0]], (10, 1))]
    assert P.files_for(sample, np.array([[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0]]), 1_000_000, 20_000).tolist() == [45, 5, 1]
    assert P.files_for(np.zeros((0, 2)), np.zeros((1, 2)), 0).tolist() == [1]


def test_vectors_of_many_passages_are_never_stored_twice(spark, monkeypatch):
    """The sample is embedded first and all the others on their way to their cells; the index is the one of the stored vectors."""
    rows = [(i, f"s/{i}", " ".join(f"w{(i * j) % 17}" for j in range(1, 9))) for i in range(400)] + [(400, "s/400", None)]
    emb, names = HashedEmbedder(dim=16, model="m"), []
    keep = P.cut_lineage
    monkeypatch.setattr(P, "cut_lineage", lambda df, *a, **k: names.append(k.get("path") or a[0]) or keep(df, *a, **k))
    p = _passages(spark, rows).select("chunk_id", "text")
    few, many = _fresh(spark), _fresh(spark)
    a = P.embed_cells(p, emb, few)
    assert names == [f"{few}/embedded", "sample"]
    names.clear()
    b = P.embed_cells(p, emb, many, sample_rows=100)
    assert names == ["sample"]
    assert (a["n"], a["ids"], a["cells"]) == (b["n"], b["ids"], b["cells"]) == (401, a["ids"], 20)
    want = P.sample_of(emb.embed(p, "text").select("chunk_id", "vec"), 100)
    assert (P.open_cells(spark, many, b).centroids == P.fit_centroids(want, 20)).all()
    va, vb = ({r.chunk_id: bytes(r.vec) for r in P.open_cells(spark, f, m).vectors.collect()} for f, m in ((few, a), (many, b)))
    assert va == vb and len(va) == 401


def test_nearest_centroid_is_the_first_of_the_best():
    from tessera.operators import approx as A

    x, c = np.random.default_rng(2).normal(size=(50, 4)), np.random.default_rng(3).normal(size=(9, 4))
    near, score = A.nearest(x, np.vstack([c, c]), 1)
    assert (near[:, 0] == (x @ c.T).argmax(axis=1)).all() and np.allclose(score[:, 0], (x @ c.T).max(axis=1))


def test_buckets_are_written_without_a_sort_and_the_setting_stays(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from tessera.session import cut_by_key, key_buckets

    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before, save = spark.conf.get(key), DataFrameWriter.saveAsTable
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", lambda self, *a, **k: seen.append(spark.conf.get(key)) or save(self, *a, **k))
    d = spark.range(200).repartition(key_buckets(spark), "id")
    stored = cut_by_key(d, "id")
    assert sorted(r.id for r in stored.collect()) == list(range(200)) and seen == ["1"] and spark.conf.get(key) == before
    assert "Exchange" not in stored.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in cut_by_key(spark.range(50), "id").collect()) == list(range(50))  # many buckets in a task
