"""Physical-plan properties the scale design depends on (checked on explain output)."""

from conftest import SF001
from pyspark.sql import functions as F

from tessera.operators.index import bm25_index
from tessera.operators.retrieve import attach_text, bm25_topk
from tessera.sources.driver import doc_passages, questions


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bm25_topk_plan(spark):
    p, q = doc_passages(spark, SF001), questions(spark, SF001)
    plan = _plan(bm25_topk(q, bm25_index(p), 10))
    assert "WindowGroupLimit" in plan            # top-k cut before the shuffle
    assert "BroadcastHashJoin" in plan           # query terms broadcast, postings stream
    assert "Bucketed: true" in plan              # scores add up where a passage's postings lie
    assert not [line for line in plan.split("\n") if "Exchange hashpartitioning(query_id" in line and "chunk_id" in line]
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_text_attached_by_broadcasting_the_ranked_side(spark):
    p = doc_passages(spark, SF001)
    ranked = spark.createDataFrame([(1, 1, 0), (1, 2, 1)], "query_id long, rank int, chunk_id long")
    plan = _plan(attach_text(ranked, p))
    assert "BroadcastHashJoin" in plan
    # the broadcast side is the ranked list, never the text column
    build = plan[plan.index("BroadcastExchange"):]
    assert "text" not in build.split("\n")[1]


def test_filters_and_columns_reach_the_scan(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet").where(F.col("event_type") == "error").select("event_id")
    plan = _plan(ev)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_sample_rows_cover_every_strategy(spark):
    from tessera.plans import chunks as C

    n = {tuple(r[:2]): r[2] for r in C._all_chunks(spark, SF001).groupBy("source_path", "strategy").count().collect()}
    got = {tuple(r[:2]): r[2] for r in C.q_sample_rows(spark, SF001).groupBy("source_path", "strategy").count().collect()}
    assert got == {k: min(4, v) for k, v in n.items()}
    assert {s for _, s in got} == set(C.STRATEGIES)
