"""Pipeline stages and their operators on callers' own column names, repeated ids, nulls, empty tables and odd batches."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pandas as pd
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tessera.llm import common as C
from tessera.llm import dart_minhash as D
from tessera.llm import exact_dedup as E
from tessera.llm import mixing as M
from tessera.session import checkpoint_dir

#: Names that the stages use or have used for their own columns.
HELPERS = ["_dig", "_id", "_n", "_copy", "_src", "_size", "_all", "_rows", "_times", "gone_id", "place", "copy_dig", "COPY_NORM", "copy_rank", "copy_nth",
           "copy_salt", "copy_row", "mix_source", "mix_full", "mix_cut", "mix_size", "mix_copy", "size", "source_size", "target", "key", "a.b"]


def _docs(spark, rows):
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in HELPERS)
    return spark.createDataFrame([(*r, *[f"{c}{r[0]}" for c in HELPERS]) for r in rows], schema).repartition(3)


ROWS = [(1, "a b c d e f", "s"), (2, "a b c d  e f", "s"), (3, None, None), (4, "", "t"), (5, " \n", "t"), (6, "other words stand here now", "t"),
        (None, "a b c d e f", "u"), (6, "other words stand here now", "t"), (7, "x" * 50_000, "u"), (8, "w " * 30_000, None), (9, "A, B c d e f", "s")]


def _intact(frame):
    for r in frame.collect():
        assert [r[c] for c in HELPERS] == [f"{c}{r.doc_id}" for c in HELPERS]
    return frame


@pytest.mark.parametrize("hot_rows", [10_000, 1])
def test_stages_keep_every_column(spark, hot_rows):
    docs = _docs(spark, ROWS)
    exact = _intact(E.drop_copies(docs, hot_rows=hot_rows))
    assert exact.columns == docs.columns and sorted(r.doc_id for r in exact.collect()) == [2, 5, 6, 7, 8, 9]
    near = _intact(D.drop_near_copies(docs))
    assert near.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in near.collect()) == [(False, 1), (False, 3), (False, 6), (False, 7), (False, 8), (True, 0)]
    mixed = _intact(M.mixed_documents(docs))
    assert mixed.columns == docs.columns
    for stage in (E.drop_copies, D.drop_near_copies, M.mixed_documents):
        assert stage(docs.limit(0)).count() == 0


@pytest.mark.parametrize("hot_rows", [10_000, 3])
def test_copies_that_stay_are_those_of_the_labels(spark, hot_rows):
    rng = random.Random(4)
    rows = [(i, rng.choice(["hot text"] * 3 + [f"text {i % 40}", f"te xt{i % 40}", None]), "s") for i in range(400)]
    docs = _docs(spark, rows)
    want = sorted(r.doc_id for r in E.label_copies(docs).where("kept").collect())
    weak = lambda c: F.substring(F.sha2(c, 256), 1, 1)  # noqa: E731  texts that share a digest stay apart
    for digest in (E.sha256_hex, weak):
        assert sorted(r.doc_id for r in E.drop_copies(docs, hot_rows=hot_rows, digest=digest).collect()) == want


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_documents_stand_as_often_as_the_mix_takes_them(spark, broadcast):
    rows = [(i, "w " * (i % 9), "hot" if i % 3 else f"s{i % 5}") for i in range(1500)] + [(5000, None, None), (5001, "a b", None), (None, "a b c", "hot")]
    docs = _docs(spark, rows)
    want = {r.doc_id: r.epochs for r in M.mix(docs).collect() if r.epochs}
    got = M.mixed_documents(docs, broadcast_sources=broadcast).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == want
    # rows that repeat id, source and size are alike
    twice = M.mixed_documents(_docs(spark, [(1, "a b", "s"), (1, "c d", "s"), (2, "a", "t")])).groupBy("text").count().collect()
    assert len({r["count"] for r in twice if r.text != "a"}) == 1


def test_no_text_is_shuffled_for_the_mix(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    plan = M.mixed_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("n", range(7))
def test_batches_of_few_words(spark, n):
    for cuts in itertools.islice(itertools.product((0, 1), repeat=max(0, n - 1)), 32):
        texts, own = [], []
        for i in range(n):
            own.append(f"w{i}")
            if i == n - 1 or cuts[i]:
                texts.append(" ".join(own))
                own = []
        texts = [*texts, ""]
        h, owner, digests = D.shingles(texts)
        assert len(digests) == len(texts) and len(h) == sum(max(1, len(t.split()) - 4) for t in texts if t)
    got = D.near_classes(spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c d e")], "doc_id long, text string").coalesce(1)).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == [(1, 1), (2, 2), (3, 3)]


def test_rows_of_one_id_are_one_document(spark):
    t = [f"w{i}" for i in range(60)]
    rows = [(5, " ".join(t), "s"), (5, "quite other words than those", "s"), (9, "quite other words than those", "s"), (7, " ".join(t[:59] + ["x"]), "s"), (8, "alone", "s")]
    got = {(r.doc_id, r.class_id) for r in D.near_classes(_docs(spark, rows)).collect()}
    assert got == {(5, 5), (9, 5), (7, 5), (8, 8)}
    assert sorted(r.doc_id for r in D.drop_near_copies(_docs(spark, rows)).collect()) == [5, 8]


def test_recall_of_near_pairs(spark):
    """Pairs at a similarity of 0.8 to 0.9, each alone with its partner, so that no other link hides a miss."""
    rng = random.Random(11)
    rows, pairs = [], 0
    for i in range(150):
        t = [f"p{i}w{rng.randrange(10**6)}" for _ in range(rng.randint(120, 400))]
        u = list(t)
        for j in rng.sample(range(5, len(t) - 5), max(1, len(t) // 60)):
            u[j] = "changed"
        a, b = ({tuple(x[k:k + 5]) for k in range(len(x) - 4)} for x in (t, u))
        if len(a & b) >= 0.8 * len(a | b):
            rows += [(2 * i, " ".join(t), "s"), (2 * i + 1, " ".join(u), "s")]
            pairs += 1
    got = D.near_classes(_docs(spark, rows)).where("doc_id <> class_id").count()
    assert pairs >= 80 and got >= 0.99 * pairs


def test_slices_and_memories_are_bounded():
    frame = pd.DataFrame({"text": ["x" * 30, None, "", "y" * 5, "z" * 90, "a"], "i": range(6)})
    got = list(C.text_slices([frame, frame.iloc[:0]], rows=3, chars=40))
    assert [list(g["i"]) for g in got] == [[0, 1, 2], [3], [4], [5]] and all(list(g.index) == list(range(len(g))) for g in got)
    memory, rng, worked = C.Recent(50), np.random.default_rng(0), 0
    for _ in range(500):
        keys = {int(k) for k in rng.integers(0, 10_000, 5)} | {-1, -2}
        new = memory.missing(keys)
        worked += len({-1, -2} & set(new))
        memory.held.update((k, -k) for k in new)
        assert all(memory.held[k] == -k for k in keys) and len(memory.held) + len(memory.older) <= 120
    assert worked == 2  # what comes again and again is kept


def _tables(spark, rows, tmp_path):
    """A folder with ``documents`` and ``labels`` as the pipeline reads them."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(r[0], 1, int("awful" in (r[1] or ""))) for r in rows], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def _stored(spark):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(checkpoint_dir(spark))
    return {r.path for r in files.select("path").collect() if "/tessera-tables/" in r.path or "/tessera-pipeline/" in r.path}


def test_the_pipeline_takes_nulls_repeated_rows_and_empty_tables(spark, tmp_path):
    import corpus_pipeline as P

    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(4000)}" for _ in range(40)) + (" awful awful words" if i % 7 == 0 else ""), "en", f"s{i % 3}", 1) for i in range(300)]
    rows += [(400, None, None, None, None), (401, "", "en", "s1", 0), (None, "no id at all here", "en", None, 4), rows[1], (402, rows[2][1] + " ", "en", "s1", 1)]
    sf = _tables(spark, rows, tmp_path / "a")
    spark.range(1).write.mode("overwrite").parquet(f"{checkpoint_dir(spark)}/tessera-tables/some")
    before = _stored(spark)
    packed = P.run(spark, sf).collect()
    left = _stored(spark) - before  # nothing but the result
    assert left and all("/tessera-pipeline/" in p and "/packing/" in p for p in left)
    ids = {r.doc_id for r in packed}
    assert {1, 400} <= ids | {400, 401} and not ids & {i for i in range(300) if i % 7 == 0 and i % 5}  # those that the labels teach
    assert len(ids & {2, 402}) <= 1
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 2048
    empty = _tables(spark, [], tmp_path / "b")
    assert P.run(spark, empty).count() == 0
