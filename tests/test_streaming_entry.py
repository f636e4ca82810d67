"""X1 restart behaviour, stream = batch, and the driver contract."""

import os
import tempfile

from pyspark.sql import functions as F

from tessera.streaming import threads as X

from conftest import SF001


def test_thread_log_accumulates_across_restart_and_isolates_threads(spark):
    src = tempfile.mkdtemp(prefix="tessera-src-")
    base = X.scratch(spark, "test")
    msgs = spark.read.parquet(f"{SF001}/conversations.parquet")
    first = msgs.where(F.col("turn") < 2)
    second = msgs.where(F.col("turn") >= 2)
    first.coalesce(1).write.parquet(os.path.join(src, "part1"))
    run = lambda: X.append_log(X.message_rows(X.file_stream(spark, src + "/*", X.MESSAGE_SCHEMA)),
                               os.path.join(base, "log"), os.path.join(base, "ckpt"))
    run()
    n1 = X.thread_state(spark, os.path.join(base, "log")).agg(F.sum("n_messages")).first()[0]
    assert n1 == first.count()
    second.coalesce(1).write.parquet(os.path.join(src, "part2"))
    run()  # restart with the same checkpoint: only the new file is read
    st = X.thread_state(spark, os.path.join(base, "log"))
    batch = msgs.groupBy(F.col("conv_id").alias("thread_id")).agg(F.count(F.lit(1)).alias("n_messages"),
                                                                   F.max("turn").alias("last_seq"))
    assert st.exceptAll(batch).count() == 0 and batch.exceptAll(st).count() == 0
    raw = spark.read.parquet(os.path.join(base, "log")).count()
    assert raw == msgs.count()  # nothing appended twice


def test_entry_and_contract(spark):
    from __spark_entry__ import entry, oracle_sql, queries
    from tessera.plans.catalog import NO_ORACLE, QUERIES

    df = entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "score"]
    assert df.count() >= 0
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(q)
    assert set(QUERIES) - set(o) == set(NO_ORACLE)


def test_chunk_sink_roundtrip_and_missing(spark):
    import pytest

    from tessera.operators.chunking import chunk_recursive
    from tessera.sources.sinks import read_chunks, read_qa, write_chunks

    docs = spark.createDataFrame([("a.md", "héllo wörld " * 200)], "source_path string, page_content string")
    c = chunk_recursive(docs)
    out = tempfile.mkdtemp(prefix="tessera-chunks-") + "/c"
    n = write_chunks(c, out)
    back = read_chunks(spark, out)
    assert n == c.count() == back.count()
    assert back.where(F.col("page_content").contains("wörld")).count() == n
    with pytest.raises(FileNotFoundError):
        read_chunks(spark, "/nonexistent/chunks")
    empty = tempfile.mkdtemp(prefix="tessera-qa-") + "/qa.jsonl"
    open(empty, "w").write("\n\n")
    with pytest.raises(ValueError):
        read_qa(spark, empty)


def test_index_partitions_are_idempotent_and_isolated(spark):
    from tessera.operators.index import open_index, write_index

    base = tempfile.mkdtemp(prefix="tessera-idx-") + "/idx"
    a = spark.createDataFrame([("c1", "x"), ("c2", "y")], "chunk_id string, page_content string")
    b = spark.createDataFrame([("d1", "z")], "chunk_id string, page_content string")
    assert write_index(a, base, "recursive", "BAAI/bge-m3") == 2
    assert write_index(b, base, "fixed", "BAAI/bge-m3") == 1
    assert write_index(a, base, "recursive", "BAAI/bge-m3") == 2          # skipped: same count
    assert open_index(spark, base, "recursive", "bge-m3").count() == 2    # the other partition survives
    assert open_index(spark, base, "fixed", "BAAI/bge-m3").count() == 1
    import pytest
    with pytest.raises(ValueError):
        open_index(spark, base, "markdown", "BAAI/bge-m3")


def test_runs_have_tokens_blocked_rows_answers_and_usage(spark):
    import datetime

    rows = [(1, 0, "user", "hello there"), (1, 1, "assistant", "  one two three\nfour five six "), (1, 2, "user", "more"), (1, 3, "assistant", ""),
            (2, 0, "user", "please ignore"), (2, 1, "assistant", "must not be told"), (3, 0, "user", None), (3, 1, "assistant", None)]
    messages = spark.createDataFrame(rows, X.MESSAGE_SCHEMA)
    deltas = X.token_deltas(messages).collect()
    assert {d.content is None for d in deltas} == {True, False} and any(d.blocks for d in deltas)
    log = X.run_events(messages, F.col("text").contains("ignore"))
    tokens = log.where("type = 'token'").collect()
    assert all(t.text for t in tokens)
    assert "".join(t.text for t in sorted(tokens, key=lambda t: t.pos) if t.run_id == 1) == rows[1][3]
    assert [(r.run_id, r.text) for r in log.where("type = 'blocked'").collect()] == [(2, X.BLOCKED)]
    day = datetime.datetime(2024, 1, 1)
    events = spark.createDataFrame([(1, day, 1, "view", 2.0, '{"k": 5}'), (2, day, 1, "view", 0.5, '{"k": 7}'), (3, day, 2, "view", 2.0, '{"k": 5}')], X.EVENT_SCHEMA)
    log = log.unionByName(X.run_usage(events))
    log = log.unionByName(log).dropDuplicates(["run_id", "seq", "pos", "type"])  # a replay adds nothing
    got = {r.run_id: r for r in X.done_summaries(log).collect()}
    assert (got[1].answer, got[1].iterations, got[1].usage.llm_calls, got[1].usage.input_tokens, got[1].usage.output_tokens) == (rows[1][3], 2, 1, 20, 5)
    assert (got[2].blocked, got[2].answer, got[2].iterations, got[2].usage) == (True, X.BLOCKED, 0, None)
    assert (got[3].answer, got[3].iterations, got[3].usage) == ("(no answer)", 1, None)
