"""The (strategy, model, method) matrix (V6), chunkers that stay in their row (K4-K6) and models as plug points."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tessera.operators import chunking as K
from tessera.operators import matrix as M
from tessera.operators import retrieve as R
from tessera.operators.evaluate import hit_mrr
from tessera.operators.index import BatchModelEmbedder, HashedEmbedder, get_embedder
from tessera.plans import chunks as C
from tessera.session import checkpoint_dir


def _folder(spark, name="matrix"):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


class Broken(HashedEmbedder):
    """A model that fails on one of its texts."""

    def embed(self, df, text_col, side="passage", out="vec"):
        @F.pandas_udf("array<double>")
        def run(texts):
            raise RuntimeError("no such model on this worker")

        return df.withColumn(out, run(F.col(text_col)))


DOCS = [(f"s/{i}", f"alpha w{i} beta. " + " ".join(f"w{(i * j) % 13}" for j in range(1, 9)) + f".\n\nSecond part about topic{i % 4}. It ends here. And on w{i % 5}.") for i in range(24)]
QUESTIONS = [(1, "topic1 w3"), (2, "alpha w7 beta"), (3, "nothing here"), (4, "w5 w6 w5"), (5, "about topic2")]
TRUTH = [(1, "s/1"), (1, "s/5"), (2, "s/7"), (4, "s/5"), (5, "s/2"), (5, "s/6")]


def test_matrix_equals_brute_force_and_a_failed_combination_stays_alone(spark):
    docs = spark.createDataFrame(DOCS, "source_path string, page_content string")
    qs = spark.createDataFrame(QUESTIONS, "query_id long, question string")
    truth = spark.createDataFrame(TRUTH, "query_id long, source_path string")
    corpora = {s: K.STRATEGIES[s](docs).select("chunk_id", "source_path", F.col("page_content").alias("text")) for s in ("semantic", "recursive")}
    models = [HashedEmbedder(dim=32, model="org/A"), Broken(dim=32, model="org/Broken"), HashedEmbedder(dim=8, model="B")]
    folder = _folder(spark)
    m = M.run_matrix(qs, corpora, models, folder, k=10, fetch_k=15)
    assert len(m.combos) == 2 * 2 * 4 and {c["model"] for c in m.combos} == {"org/A", "B"}
    assert [(f["strategy"], f["model"]) for f in m.failed] == [("semantic", "org/Broken"), ("recursive", "org/Broken")]
    assert all(r.error for r in m.failures(spark).collect())
    qa = qs.withColumn("ground_truth_contexts", F.array())
    got = {(r.strategy, r.model, r.method, r.k): (r.n_questions, round(r.hit_rate, 9), round(r.mrr, 9)) for r in hit_mrr(qa, m.ranked, truth, M.KEYS, m.combos).collect()}
    assert len(got) == 48
    for strategy, passages in corpora.items():
        source = {r.chunk_id: r.source_path for r in passages.collect()}
        for emb in (models[0], models[2]):
            for method in R.METHODS:
                rows = R.retrieve(qs, passages, method, k=10, fetch_k=15, embedder=emb).collect()
                for k in (3, 5, 10):
                    first = [min((r.rank for r in rows if r.query_id == q and (q, source[r.chunk_id]) in TRUTH), default=99) for q, _ in QUESTIONS]
                    hit, rr = sum(f <= k for f in first) / 5, sum(1 / f for f in first if f <= k) / 5
                    assert got[strategy, emb.model, method, k] == (5, round(hit, 9), round(rr, 9)), (strategy, emb.model, method, k)
    again = M.run_matrix(qs, corpora, models[:1], folder, k=10, fetch_k=15)  # opens what is there
    key = lambda d: sorted(map(tuple, d.where("model = 'org/A'").select("strategy", "method", "query_id", "rank", "chunk_id").collect()))
    assert key(again.ranked) == key(m.ranked)


def test_matrix_query_has_every_combination(spark):
    rows = C.q_eval_matrix(spark, SF001).collect()
    assert len({(r.strategy, r.model, r.method, r.k) for r in rows}) == len(rows) == 2 * 2 * 4 * 3
    assert all(r.error is None for r in rows) and any(r.hit_rate > 0 for r in rows)


# ------------------------------------------------------------------------------------------------ K4-K6


@pytest.mark.parametrize("strategy", list(K.STRATEGIES))
def test_a_document_stays_in_its_row(spark, strategy):
    docs = spark.createDataFrame([("p", "# A\none. two. three"), ("p", "# B\nfour. five"), ("q", None), ("r", "")], "source_path string, page_content string")
    chunks = K.STRATEGIES[strategy](docs)
    assert "Exchange" not in chunks._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.source_path, r.chunk_idx, r.page_content) for r in chunks.collect())
    assert [g for g in got if g[0] == "p" and g[1] == 0] and not [g for g in got if g[0] == "q"]
    assert not any("one" in t and "four" in t for _, _, t in got)  # documents that share a path stay apart


def test_markdown_sections_follow_headers_fences_and_depth():
    text = "intro\n\n# A\n## B\n### C\ntext\n```\n# no header\n\n```\n# D\n#### E\n## F \n\n#no\n##\n~~~\n## z"
    got = K.markdown_sections(text)
    assert got == [
        ("intro", [None] * 4),
        ("# A\n## B\n### C\ntext\n```\n# no header\n\n```", ["A", "B", "C", None]),
        ("# D\n#### E", ["D", None, None, "E"]),
        ("## F\n#no", ["D", "F", None, None]),
        ("##\n~~~\n## z", ["D", "", None, None]),
    ]
    assert K.markdown_sections("") == [] and K.markdown_sections(" \n\n") == []


def test_semantic_cuts_equal_their_definition(monkeypatch):
    text = ". ".join(f"{'cat dog' if i % 6 < 3 else 'sun moon star'} n{i}" for i in range(40)) + "."
    vectors = HashedEmbedder(dim=32).vectors()
    s = text.replace(". ", ".\0").split("\0")
    v = vectors([" ".join(s[max(0, i - 1):i + 2]) for i in range(len(s))])
    d = [1 - float(a @ b) for a, b in zip(v, v[1:])]
    limit = np.percentile(d, 95)
    want, own = [], [s[0]]
    for x, t in zip(d, s[1:]):
        if x > limit + 1e-12:
            want.append(" ".join(own))
            own = []
        own.append(t)
    want.append(" ".join(own))
    assert K.semantic_split(text, vectors) == want and len(want) > 1
    monkeypatch.setattr(K, "SENTENCES", 7)  # embedded a few at a time
    assert K.semantic_split(text, vectors) == want
    assert K.semantic_split("", vectors) == [""] and K.semantic_split("one", vectors) == ["one"]


def test_all_strategies_take_one_input(spark):
    docs = spark.createDataFrame(DOCS, "source_path string, page_content string")
    n = {r.strategy: r.n for r in K.chunk_all(docs).groupBy("strategy").agg(F.countDistinct("source_path").alias("n")).collect()}
    assert n == dict.fromkeys(K.STRATEGIES, len(DOCS))
    with pytest.raises(ValueError, match="unknown chunk strategy"):
        K.chunk_all(docs, ("fixed", "other"))


# ------------------------------------------------------------------------------------------------ E1


def test_a_model_is_loaded_once_a_task_and_sees_bounded_batches(spark):
    log = _folder(spark, "loads").replace("file:", "")
    os.makedirs(log)

    def load():
        mark = f"{log}/{uuid.uuid4().hex}"
        open(f"{mark}.load", "w").close()

        def fn(texts):
            with open(f"{mark}.calls", "a") as f:
                f.write(f"{len(texts)} {sum(map(len, texts))}\n")
            return np.array([[len(t), t.count("a"), 1.0] for t in texts])

        return fn

    emb = get_embedder("batch", "org/counting", load=load, dim=3, batch_texts=8, batch_chars=100)
    assert isinstance(emb, BatchModelEmbedder)
    rows = [(i, "a" * (i % 30)) for i in range(200)] + [(200, "b" * 500), (201, None)]
    d = spark.createDataFrame(rows, "id long, text string").repartition(3).withColumn("vec", F.lit("old"))
    got = {r.id: r.vec for r in emb.embed(d, "text").collect()}
    for i, t in rows:
        v = np.array([len(t or ""), (t or "").count("a"), 1.0])
        assert got[i] == pytest.approx((v / np.linalg.norm(v)).tolist())
    files = os.listdir(log)
    assert sum(f.endswith(".load") for f in files) == 3  # one for each task
    calls = [tuple(map(int, line.split())) for f in files if f.endswith(".calls") for line in open(f"{log}/{f}")]
    assert sum(n for n, _ in calls) == 202 and all(n <= 8 and (c <= 100 or n == 1) for n, c in calls)
    with pytest.raises(ValueError, match="unknown embedding provider"):
        get_embedder("other")


def test_instructions_go_to_queries_of_their_family_only(spark):
    emb = BatchModelEmbedder(load=lambda: lambda texts: np.array([[len(t), 1.0] for t in texts]), dim=2, model="BAAI/bge-small-en")
    d = spark.createDataFrame([(1, "abc")], "id long, text string")
    p, q = (emb.embed(d, "text", side).first().vec for side in ("passage", "query"))
    assert p[0] / p[1] == pytest.approx(3) and q[0] / q[1] > 40


def test_chunk_stats_cuts_each_text_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(len(b))
            yield b

    c = spark.createDataFrame([("fixed", "a" * n) for n in (3, 5, 5, 9)] + [("fixed", None)], "strategy string, page_content string")
    r = {x["strategy"]: tuple(x)[1:] for x in K.chunk_stats(c.mapInPandas(count, c.schema), ["fixed", "semantic"]).collect()}
    assert r == {"fixed": (4, 5.5, 5.0, 3, 9), "semantic": (0, 0.0, 0.0, 0, 0)} and runs.value == 5


def test_workers_hand_on_pieces_in_bounded_runs():
    from tessera.functions.text import text_runs

    texts = ["x" * 10, None, "y" * 95, "z" * 6, "", "w" * 500, "v"]
    runs = list(text_runs(texts, rows=3, chars=100))
    assert [t for r in runs for t in r] == texts
    assert all(len(r) <= 3 and (len(r) == 1 or sum(len(t or "") for t in r) <= 100) for r in runs)
    assert list(text_runs([])) == []


def test_tokens_hashed_in_blocks_have_their_md5():
    import hashlib

    from tessera.operators.index import TokenHashes, hashed_vectors, token_hashes

    r = np.random.default_rng(5)
    toks = ["".join(r.choice(list("abcé漢𝄞\x00"), r.integers(1, 40))) for _ in range(3000)] + ["x" * n for n in range(1, 130)] + ["a", "a"]
    assert token_hashes(toks).tolist() == [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) for t in toks]
    assert token_hashes([]).tolist() == []
    texts = [" ".join(toks[i:i + 7]) for i in range(0, 3000, 7)] + ["", None, " \n", "a b a"]
    assert (hashed_vectors(texts, 32) == hashed_vectors(texts, 32, TokenHashes())).all()


def test_ground_truth_is_found_once(spark, monkeypatch):
    made, keep = [], C.cut_lineage
    combo = {"strategy": "fixed", "model": "m", "method": "dense"}
    ranked = spark.createDataFrame([("fixed", "m", "dense", 0, 1, "none")], "strategy string, model string, method string, query_id long, rank int, source_path string")
    monkeypatch.setattr(C, "cut_lineage", lambda df, name="table", path=None: made.append(name) or keep(df, name, path))
    monkeypatch.setattr(C, "run_chunk_matrix", lambda *a: M.Matrix(ranked, [combo], []))
    got = C.q_eval_matrix(spark, SF001)
    assert made == ["truth"] and "MapInPandas" not in got._jdf.queryExecution().executedPlan().toString()
    assert [(r.k, r.hit_rate) for r in got.orderBy("k").collect()] == [(3, 0.0), (5, 0.0), (10, 0.0)]


def test_embedding_and_cutting_keep_to_runs(spark, monkeypatch):
    """An Arrow batch of many texts goes through in runs, and rows keep their own results."""
    from tessera.operators.index import HashedEmbedder, hashed_vectors

    texts = [f"w{i} common. more words here. " * (i % 7) for i in range(1500)]
    d = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "source_path string, page_content string").coalesce(1)
    got = {int(r.source_path): r.vec for r in HashedEmbedder(dim=16).embed(d, "page_content").collect()}
    want = hashed_vectors(texts, 16)
    assert len(got) == 1500 and all(got[i] == [float(x) for x in want[i]] for i in range(1500))
    plan = HashedEmbedder(dim=16).embed(d, "page_content")._jdf.queryExecution().executedPlan().toString()
    assert ", 204]" in plan or "204" in plan  # an iterator of batches, so that runs are handed on
    cut = {r.source_path: r.n for r in K.chunk_recursive(d).groupBy("source_path").agg(F.count("*").alias("n")).collect()}
    assert cut == {str(i): len(K.recursive_split(t)) for i, t in enumerate(texts) if K.recursive_split(t)}
