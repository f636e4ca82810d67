"""Running sums, row numbers and streams over tables with payloads, hot keys, null keys, several files and late rows."""

from __future__ import annotations

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.prefix import prefix_sum
from tessera.functions.quantiles import exact_quantiles
from tessera.operators import evaluate as V
from tessera.sources import corpus as SC
from tessera.streaming import threads as X

ROWS = 400_000


def _hot(spark):
    """A third of the rows under one key, some under a null key, each with a payload."""
    i = F.col("id")
    return spark.range(0, ROWS, numPartitions=16).select(
        F.when(i % 3 == 0, F.lit(0)).when(i % 97 == 1, F.lit(None)).otherwise(i % 1000).cast("long").alias("k"),
        ((i * 7919) % ROWS).alias("o"), (i % 11).alias("v"), F.sha2(i.cast("string"), 256).alias("payload"))


def test_prefix_sum_with_payload_equals_a_plain_window(spark):
    d = _hot(spark)
    got = prefix_sum(d, ["k"], ["o"], F.col("v"), "s")
    want = d.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)))
    assert got.count() == ROWS
    assert got.exceptAll(want.select(*got.columns)).isEmpty()


def test_sequential_ids_with_payload_number_every_row_once(spark):
    got = V.sequential_ids(_hot(spark), [F.col("o")])
    assert got.agg(F.count(F.lit(1)), F.countDistinct("seq_no"), F.min("seq_no"), F.max("seq_no")).first()[:] == (ROWS, ROWS, 1, ROWS)
    assert got.where(F.col("seq_no") != F.col("o") + 1).isEmpty()


def test_quantiles_keep_a_null_group(spark):
    d = _hot(spark)
    got = {r.k: (r.n, r.q50) for r in exact_quantiles(d, ["k"], "v", [0.5]).collect()}
    want = {r.k: (r.n, r.q) for r in d.groupBy("k").agg(F.count("v").alias("n"), F.expr("percentile(v, 0.5)").alias("q")).collect()}
    assert None in want and got == want


def test_front_matter_with_repeated_and_reserved_keys(spark):
    text = "---\ntitle: a\ntitle: b\nsource_path: elsewhere\n---\nbody"
    f = spark.createDataFrame([("x/y.md", "y.md", text)], "source_path string, file_name string, text string")
    r = SC.load_documents(f).first()
    assert r.metadata == {"title": "b", "source_path": "x/y.md", "file_name": "y.md"} and r.page_content == "body"


def test_event_log_counts_late_rows_from_a_folder_of_files(spark, tmp_path):
    day = datetime.datetime(2024, 1, 10)
    path = str(tmp_path / "events.parquet")
    for n, ts in enumerate([day, day + datetime.timedelta(days=1), day + datetime.timedelta(days=5), day - datetime.timedelta(days=9)]):
        spark.createDataFrame([(10 * n + i, ts, 1, "view", 2.0, "{}") for i in range(10)], X.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    src = X.file_stream(spark, path, X.EVENT_SCHEMA, max_files=1)
    X.append_log(X.event_projection(src), str(tmp_path / "log"), str(tmp_path / "ckpt"))
    # a restart with the same checkpoint adds nothing
    X.append_log(X.event_projection(X.file_stream(spark, path, X.EVENT_SCHEMA)), str(tmp_path / "log"), str(tmp_path / "ckpt"))
    r = X.run_summaries(spark.read.parquet(str(tmp_path / "log")).dropDuplicates(["event_id", "type"])).first()
    assert r.n_tool_calls == 40


def test_quantiles_of_equal_and_weighted_rows_read_their_input_once(spark):
    """Values are counted in one pass, so what makes the rows runs once; a weight counts like so many rows."""
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(len(b))
            yield b

    d = spark.createDataFrame([("a", float(i % 3)) for i in range(31)] + [(None, 7.0)] * 4 + [("b", None)], "g string, v double").mapInPandas(count, "g string, v double")
    got = {r.g: (r.n, r.m25, r.m50) for r in exact_quantiles(d, ["g"], "v", [0.25, 0.5], prefix="m").collect()}
    assert got == {"a": (31, 0.0, 1.0), None: (4, 7.0, 7.0)} and runs.value == 36
    w = spark.createDataFrame([("a", 0, 11), ("a", 1, 9), ("a", 2, 12), ("a", 5, 0)], "g string, v int, c long")
    assert [(r.n, r.m50) for r in exact_quantiles(w, ["g"], "v", [0.5], prefix="m", weight="c").collect()] == [(32, 1.0)]
