"""Chunk / QA / result tables in and out.

Schemas are always explicit (never inferred). Row counts of a write come from
``DataFrame.observe`` so the data is not scanned a second time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.chunking import CHUNK_SCHEMA

QA_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("question", T.StringType()),
    T.StructField("ground_truth_answer", T.StringType()),
    T.StructField("ground_truth_contexts", T.ArrayType(T.StringType())),
    T.StructField("difficulty", T.StringType()), T.StructField("source_file", T.StringType())])

USAGE_LOG_SCHEMA = T.StructType([
    T.StructField("endpoint", T.StringType()), T.StructField("model", T.StringType()),
    T.StructField("input_tokens", T.LongType()), T.StructField("output_tokens", T.LongType()),
    T.StructField("total_tokens", T.LongType()), T.StructField("llm_calls", T.LongType()),
    T.StructField("cost_usd", T.DoubleType()), T.StructField("cost_krw", T.DoubleType())])


def _found(read: Callable[[], DataFrame], missing: str) -> DataFrame:
    """What ``read`` opens; a path that its store does not hold raises FileNotFoundError."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(missing) from e


def write_chunks(chunks: DataFrame, path: str, fmt: str = "json") -> int:
    """One partition folder per strategy; JSON lines keep non-ASCII text as is.
    Returns the number of rows written."""
    obs = Observation("chunks")
    out = chunks.select("page_content", "metadata", "strategy", "source_path", "chunk_idx", "chunk_id").observe(
        obs, F.count(F.lit(1)).alias("n"))
    out.write.mode("overwrite").partitionBy("strategy").format(fmt).save(path)
    return int(obs.get["n"])


def read_chunks(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Chunk table with its declared schema; a missing path raises."""
    return _found(lambda: spark.read.schema(CHUNK_SCHEMA).format(fmt).load(path), f"chunk file not found: {path}")


def read_qa(spark: SparkSession, path: str) -> DataFrame:
    """QA JSON lines (blank lines skipped by the reader); missing or empty raises."""
    df = _found(lambda: spark.read.schema(QA_SCHEMA).json(path), f"QA dataset not found: {path}").where(F.col("id").isNotNull() | F.col("question").isNotNull())
    if df.limit(1).count() == 0:
        raise ValueError(f"QA dataset empty: {path}")
    return df


def write_results(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Result tables (long form; pivot with ``evaluate.wide_report`` for the wide shape)."""
    df.write.mode("overwrite").format(fmt).save(path)


def log_usage(priced: DataFrame, endpoint: str, path: str) -> None:
    """Append one structured record per request, tagged with the endpoint."""
    rec = priced.select(F.lit(endpoint).alias("endpoint"), *[F.col(f.name).cast(f.dataType) for f in USAGE_LOG_SCHEMA
                                                              if f.name != "endpoint"])
    rec.write.mode("append").partitionBy("endpoint").parquet(path)
