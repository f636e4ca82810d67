"""V, D, A, T, U operators on tiny literal tables with hand-computed answers."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.quantiles import exact_quantiles
from tessera.operators import evaluate as V
from tessera.operators import traces as A
from tessera.operators import usage as U


def test_hit_mrr_denominator_includes_empty_truth(spark):
    qa = spark.createDataFrame([(1, ["a"], "factual"), (2, ["b"], None), (3, [], "howto")],
                               "query_id long, ground_truth_contexts array<string>, difficulty string")
    ranked = spark.createDataFrame([("m", 1, 1, "x"), ("m", 1, 2, "a"), ("m", 2, 1, "c"), ("m", 3, 1, "z")],
                                   "method string, query_id long, rank int, source_path string")
    truth = qa.select("query_id", F.explode("ground_truth_contexts").alias("source_path"))
    m = {r.k: r for r in V.hit_mrr(qa, ranked, truth, ["method"], [{"method": "m"}], ks=(1, 3)).collect()}
    assert m[1].n_questions == 3 and m[1].hit_rate == 0.0
    assert m[3].hit_rate == pytest.approx(1 / 3) and m[3].mrr == pytest.approx(0.5 / 3)
    assert m[3].mrr <= m[3].hit_rate
    d = {r.difficulty: r for r in V.hit_by_difficulty(qa, ranked, truth, ["method"], [{"method": "m"}], 3).collect()}
    assert set(d) == {"factual", "unknown"}  # only evaluated rows (non-empty truth)
    assert d["factual"].hit_rate == 1.0 and d["unknown"].hit_rate == 0.0


def test_delta_omits_missing_baseline(spark):
    m = spark.createDataFrame([("s1", "dense", 0.5), ("s1", "hybrid", 0.75), ("s2", "hybrid", 0.9)],
                              "strategy string, method string, hit_rate double")
    out = V.delta_vs_baseline(m, ["strategy"], value_cols=("hit_rate",)).collect()
    assert [(r.strategy, r.method, r.delta_hit_rate) for r in out] == [("s1", "hybrid", 0.25)]


@pytest.mark.parametrize("n,want", [(1, (0, 1, 0)), (2, (1, 1, 0)), (3, (1, 1, 1)), (4, (1, 2, 1)),
                                    (5, (2, 2, 1)), (10, (3, 4, 3)), (15, (4, 6, 5))])
def test_difficulty_quota(spark, n, want):
    r = spark.range(1).select(V.difficulty_quota(F.lit(n)).alias("q")).first().q
    assert (r.factual, r.howto, r.compare) == want


def test_sequential_ids_do_not_cut(spark):
    df = spark.range(0, 10005, numPartitions=7).withColumnRenamed("id", "item_id")
    ids = {r.item_id: r.id for r in V.sequential_ids(df, [F.col("item_id")]).collect()}
    assert ids[0] == "qa_0001" and ids[9998] == "qa_9999" and ids[10004] == "qa_10005"


def test_exact_quantiles_match_numpy_with_a_hot_group(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    vals = [("hot", float(x)) for x in rng.normal(size=3000)] + [("cold", float(x)) for x in rng.normal(size=7)]
    df = spark.createDataFrame(vals, "g string, v double").repartition(5)
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", [0.5, 0.95]).collect()}
    for g in ("hot", "cold"):
        xs = np.array([v for k, v in vals if k == g])
        assert got[g].q50 == pytest.approx(np.percentile(xs, 50))
        assert got[g].q95 == pytest.approx(np.percentile(xs, 95))
        assert got[g].n == len(xs)


def test_citation_rule():
    import re
    cases = {
        "Answer.\nSources:\n- docs/a.md\n- docs/b.md": True,
        "Sources:\n- [a](http://x)": False,
        "Sources:\n1. docs/a.md": False,
        "Sources:\n- docs/a.md\n2. b": True,   # only the first line after Sources: is checked
        "no sources here": False,
    }
    good = re.compile(A.SOURCES_RE.replace("(?muUd)", ""), re.M)
    bad = re.compile(A.BAD_CITATION_RE.replace("(?muUd)", ""), re.M)
    for text, want in cases.items():
        assert (bool(good.search(text)) and not bad.search(text)) == want


def test_citation_rule_spark_equals_python(spark):
    texts = ["Answer.\nSources:\n- docs/a.md", "Sources:\n- [a](http://x)", "Sources:\n1. docs/a.md",
             "Sources:\n- docs/a.md\n2. b", "none"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.ok for r in df.select(A.citation_ok(F.col("t")).alias("ok")).collect()]
    assert got == [True, False, False, True, False]


def test_trace_verdicts_tri_state(spark):
    items = spark.createDataFrame([
        (1, "multi_step", ["docs_search", "code_generate"], ["web_search"], False),
        (2, "multi_step", ["docs_search", "code_generate"], ["web_search"], False),
        (3, "docs_only", ["docs_search"], ["code_generate"], True),
        (4, "no_tool", [], ["docs_search"], False)],
        "item_id long, quadrant string, expected_tools array<string>, forbidden_tools array<string>, citation_required boolean")
    calls = spark.createDataFrame([
        (1, 1, "docs_search"), (1, 2, "code_generate"), (2, 1, "code_generate"), (2, 2, "docs_search"),
        (3, 1, "docs_search"), (3, 2, "code_generate")], "item_id long, step int, tool string")
    answers = spark.createDataFrame([(3, "x\nSources:\n- a.md")], "item_id long, answer string")
    v = {r.item_id: r for r in A.trace_verdicts(items, calls, answers, ["step"]).collect()}
    assert (v[1].tool_selection_ok, v[1].multistep_ok, v[1].citation_ok) == (True, True, None)
    assert (v[2].tool_selection_ok, v[2].multistep_ok) == (True, False)
    assert (v[3].tool_selection_ok, v[3].multistep_ok, v[3].citation_ok) == (False, None, True)
    assert (v[4].tool_selection_ok, v[4].n_calls) == (True, 0)


def test_quadrant_report_and_failures(spark):
    rows = [(1, "a", True, None, None, 2, 10, 1, 0.5, None), (2, "a", False, None, True, 4, 20, 3, None, None),
            (3, "b", True, False, None, 1, 5, 5, 1.0, None), (4, "b", True, True, None, 1, 5, 5, 1.0, "boom")]
    r = spark.createDataFrame(rows, "item_id long, quadrant string, tool_selection_ok boolean, multistep_ok boolean, "
                                    "citation_ok boolean, iterations int, input_tokens long, output_tokens long, "
                                    "cost_usd double, error string")
    rep = {x.quadrant: x for x in A.quadrant_report(r).collect()}
    assert rep["a"].n == 2 and rep["a"].tool_rate == 0.5 and rep["a"].multistep_rate is None
    assert rep["a"].mean_cost_usd == 0.5          # null cost skipped
    assert rep["all"].n == 3 and rep["all"].citation_rate == 1.0
    assert sorted(x.item_id for x in A.failures(r).collect()) == [2, 3]
    assert [x.item_id for x in A.errors(r).collect()] == [4]


def test_history_trim_edges(spark):
    msgs = [(1, 1, "user", "a" * 40), (1, 2, "assistant", "b" * 40), (1, 3, "user", "c" * 8),
            (2, 1, "user", "x" * 400), (3, 1, "assistant", "y" * 4), (3, 2, "user", "z" * 4)]
    df = spark.createDataFrame(msgs, "thread_id long, seq long, role string, content string")
    kept = {}
    for r in A.trim_history(df, budget=30).collect():
        kept.setdefault(r.thread_id, []).append(r.seq)
    # thread 1: tokens 14+15+6 -> suffix within 30 is seq 2..3, started at the first user -> [3]
    assert sorted(kept[1]) == [3]
    # thread 2: the only message is over budget -> fallback keeps the last message
    assert kept[2] == [1]
    # thread 3: suffix starts on an assistant row -> starts at the user row
    assert kept[3] == [2]


def test_usage_two_models_and_unknown(spark):
    calls = spark.createDataFrame([
        ("r1", "gpt-4o-mini-2024", 1000, 100), ("r1", "gpt-4o-2024", 2000, 200),
        ("r2", "unknown-model", 10, 10), ("r3", "gpt-4o", None, None)],
        "request_id string, model string, input_tokens long, output_tokens long")
    rep = {r.request_id: r for r in U.price(U.roll_up(calls)).collect()}
    assert rep["r1"].model == "gpt-4o-2024,gpt-4o-mini-2024" and rep["r1"].llm_calls == 2
    # the joined label is priced by the first matching key (gpt-4o-mini) for all tokens
    assert rep["r1"].cost_usd == round(3000 / 1e6 * 0.15 + 300 / 1e6 * 0.60, 6)
    assert rep["r2"].cost_usd is None and rep["r2"].cost_krw is None
    assert "r3" not in rep  # no usage at all -> no report row (usage info null)


def test_prefix_sum_hot_key_equals_window(spark):
    from pyspark.sql import Window

    from tessera.functions.prefix import prefix_sum, row_number_by
    rows = [("hot", i, i % 3) for i in range(5000)] + [("cold", i, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, seq long, v long").repartition(6)
    got = prefix_sum(df, ["k"], ["seq"], F.col("v"), "cum")
    want = df.withColumn("cum", F.sum("v").over(Window.partitionBy("k").orderBy("seq")))
    assert got.select("k", "seq", "cum").exceptAll(want.select("k", "seq", "cum")).count() == 0
    rn = row_number_by(df, ["k"], ["seq"]).where(F.col("k") == "hot").agg(F.min("row_no"), F.max("row_no")).first()
    assert tuple(rn) == (1, 5000)


def test_containment_token_route_equals_broadcast_route(spark):
    from conftest import SF001
    from tessera.sources.driver import doc_corpus, questions

    qs = questions(spark, SF001).unionByName(
        spark.createDataFrame([(900001, "a"), (900002, "the and")], "query_id long, question string"))
    docs = doc_corpus(spark, SF001)
    a = V.containment_truth(qs, docs)                      # one pass over the documents
    b = V.containment_truth(qs, docs, match_bytes=40)      # token route, short questions in blocks
    assert a.count() > 0
    for route in (a, b):
        assert "NestedLoop" not in route._jdf.queryExecution().executedPlan().toString()
    brute = docs.crossJoin(F.broadcast(qs)).where(F.col("page_content").contains(F.col("question"))).select("query_id", "source_path")
    assert a.exceptAll(brute).count() == 0 and brute.exceptAll(a).count() == 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_matcher_equals_a_test_of_each_pattern():
    import random

    from tessera.operators.contains import Matcher

    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ab é\U0001d11e") for _ in range(n))
    for _ in range(150):
        text = word(rng.randint(0, 120))
        patterns = [word(rng.randint(0, 14)) for _ in range(30)] + [text[i:i + rng.randint(0, 40)] for i in range(0, len(text), 9)] + [text, text + "a", ""]
        assert Matcher(patterns).find(text) == [i for i, p in enumerate(patterns) if p in text]
    assert Matcher([]).find("abc") == [] and Matcher(["a"]).find("") == []


def test_many_questions_take_one_pass():
    import time

    from tessera.operators.contains import Matcher

    patterns = [f"what is the meaning of thing number {i} in part {i % 97}" for i in range(20_000)]
    m = Matcher(patterns)
    text = " ".join(f"filler {i}" for i in range(200_000)) + " " + patterns[777] + "!"
    began = time.process_time()
    assert m.find(text) == [777]
    assert time.process_time() - began < 5


def test_first_questions_order_by_number(spark):
    ids = spark.createDataFrame([(f"qa_{i:04d}",) for i in (9999, 10000, 2, 1001, 10001, 1)], "id string")
    assert [r.id for r in V.first_questions(ids, 5).collect()] == ["qa_0001", "qa_0002", "qa_1001", "qa_9999", "qa_10000"]


def test_metric_names_match_without_case_and_dashes(spark):
    import pytest

    s = spark.createDataFrame([("m", 1.0, 0.5), ("m", 0.0, None)], "`Model_Name` string, `Answer-Relevancy` double, faithfulness double")
    got = {r.metric: r.mean for r in V.judged_means(s, ["Model_Name"], ["answer_relevancy", "FAITHFULNESS"]).collect()}
    assert got == {"answer_relevancy": 0.5, "FAITHFULNESS": 0.5}
    with pytest.raises(ValueError, match="no column"):
        V.judged_means(s, ["Model_Name"], ["recall"])
