"""X-operators: conversation state and agent events as Structured Streaming jobs.

* X1 thread log: messages stream into an append-only parquet log (the file
  sink commits each micro-batch exactly once; the checkpoint carries the
  source offsets across restarts). Thread state is read back keyed
  ``(thread_id, seq)``; duplicates from replays collapse there, so no unbounded
  streaming dedupe state is kept.
* X2/X3/X5 event projection: stateless select into one tagged-union schema.
* X4 run summaries / X6 token re-assembly: aggregations over such logs, keyed so
  that replays collapse. The streams themselves keep no state, and a row that
  comes late counts like any other.

Checkpoints and sinks live under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import usage as U
from tessera.operators.traces import NO_ANSWER
from tessera.session import checkpoint_dir
from tessera.sources.driver import EVENT_MODEL, EVENT_TOOL

MESSAGE_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run under the shared checkpoint dir."""
    return os.path.join(checkpoint_dir(spark), "tessera-stream", f"{name}-{uuid.uuid4().hex[:8]}")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
                max_bytes: int | None = None) -> DataFrame:
    """A Parquet table as a file stream, be it a folder of part files or a single file.

    A stream's source must be a folder or a glob, so the last character of the path
    is written as a class of one character, which matches either. A glob stays as it is.
    """
    r = spark.readStream.format("parquet").schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    path = path.rstrip("/")
    return r.load(path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]")


# --------------------------------------------------------------------------- X1


def message_rows(stream: DataFrame) -> DataFrame:
    return stream.select(F.col("conv_id").alias("thread_id"), F.col("turn").alias("seq"), "role",
                         F.col("text").alias("content"))


def append_log(stream: DataFrame, sink: str, checkpoint: str):
    """Append messages to the thread log; re-running with the same
    checkpoint resumes after the last committed batch."""
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink))
    q.awaitTermination()
    return q


def thread_state(spark: SparkSession, sink: str) -> DataFrame:
    """Per-thread state from the log: message count and last seq, isolated per thread."""
    log = spark.read.parquet(sink).dropDuplicates(["thread_id", "seq"])
    return log.groupBy("thread_id").agg(F.count(F.lit(1)).alias("n_messages"), F.max("seq").alias("last_seq"))


# --------------------------------------------------------------------------- X2 / X3 / X5


def token_text(content: Column, blocks: Column | None = None) -> Column:
    """Text of a token delta given as a string or as a list of blocks."""
    if blocks is None:
        return F.coalesce(content, F.lit(""))
    return F.coalesce(content, F.array_join(F.transform(blocks, lambda b: F.coalesce(b["text"], F.lit(""))), ""), F.lit(""))


def event_projection(events: DataFrame) -> DataFrame:
    """X2 + X5: tool_call / tool_result / error rows in one schema (stateless)."""
    tool_map = F.create_map(*[F.lit(x) for kv in EVENT_TOOL.items() for x in kv])
    tool = F.element_at(tool_map, F.col("event_type"))
    base = events.select(F.col("user_id").alias("run_id"), "event_id", "ts", tool.alias("name"), "props", "value",
                         "event_type")
    call = base.where(F.col("name").isNotNull()).select(
        "run_id", "event_id", "ts", F.lit("tool_call").alias("type"), "name", F.col("props").alias("args"),
        F.lit(None).cast("string").alias("preview"))
    result = base.where(F.col("name").isNotNull()).select(
        "run_id", "event_id", "ts", F.lit("tool_result").alias("type"), "name", F.lit(None).cast("string").alias("args"),
        F.substring(F.col("value").cast("string"), 1, 500).alias("preview"))
    err = base.where(F.col("event_type") == "error").select(
        "run_id", "event_id", "ts", F.lit("error").alias("type"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("args"), F.lit("tool call failed").alias("preview"))
    return call.unionByName(result).unionByName(err)


# --------------------------------------------------------------------------- X4 / X6


def run_summaries(projected: DataFrame) -> DataFrame:
    """Per run -- tool calls, errors, last event type and time (order ts, event_id)."""
    return projected.groupBy("run_id").agg(
        F.count_if(F.col("type") == "tool_call").alias("n_tool_calls"),
        F.count_if(F.col("type") == "error").alias("n_errors"),
        F.max_by("type", F.struct("ts", "event_id", "type")).alias("last_type"),
        F.max("ts").alias("last_ts"))


def token_rows(messages: DataFrame) -> DataFrame:
    """Assistant messages as token deltas: pieces that keep their trailing whitespace."""
    a = messages.where(F.col("role") == "assistant")
    return a.select(F.col("conv_id").alias("thread_id"), F.col("turn").alias("seq"),
                    F.posexplode(F.split(F.col("text"), r"(?<=\s)")).alias("pos", "token"))


def reassemble(tokens: DataFrame) -> DataFrame:
    """Tokens of a message, in order, concatenate back to its text."""
    return tokens.groupBy("thread_id", "seq").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda s: s["token"]),
                     "").alias("text"))


# --------------------------------------------------------------------------- X2-X5 of whole runs

#: What a run whose request is blocked says instead of an answer.
BLOCKED = "The request was blocked."


def token_deltas(messages: DataFrame) -> DataFrame:
    """Token deltas as models send them: every third as a list of blocks (one without text), the others as text."""
    block = lambda t: F.struct(t.alias("text"))
    blocks = F.array(block(F.substring("token", 1, 1)), block(F.lit(None).cast("string")), block(F.expr("substring(token, 2)")))
    listed = F.col("pos") % 3 == 2
    return token_rows(messages).select("thread_id", "seq", "pos", F.when(~listed, F.col("token")).alias("content"), F.when(listed, blocks).alias("blocks"))


def _run_rows(rows: DataFrame, **given: Column) -> DataFrame:
    types = {"run_id": "bigint", "seq": "bigint", "pos": "int", "type": "string", "text": "string", "model": "string", "input_tokens": "bigint", "output_tokens": "bigint"}
    return rows.select(*[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()])


def run_events(messages: DataFrame, blocked: Column) -> DataFrame:
    """Token rows (non-empty text) and one step row for each assistant message; a request or, where
    ``blocked`` holds, a blocked row for each user message. Stateless; a run is a conversation."""
    d = token_deltas(messages)
    at = {"run_id": F.col("conv_id"), "seq": F.col("turn")}
    tokens = _run_rows(d.withColumn("text", token_text(F.col("content"), F.col("blocks"))).where("text <> ''"), run_id=F.col("thread_id"),
                       seq=F.col("seq"), pos=F.col("pos"), type=F.lit("token"), text=F.col("text"))
    steps = _run_rows(messages.where("role = 'assistant'"), **at, type=F.lit("step"))
    stop = F.coalesce(blocked, F.lit(False))
    asked = _run_rows(messages.where("role = 'user'"), **at, type=F.when(stop, "blocked").otherwise("request"), text=F.when(stop, BLOCKED))
    return tokens.unionByName(steps).unionByName(asked)


def run_usage(events: DataFrame) -> DataFrame:
    """Usage rows of a run's model calls; events whose calls carry no usage give none."""
    models = F.create_map(*[F.lit(x) for kv in EVENT_MODEL.items() for x in kv])
    used = F.col("value") >= 1
    return _run_rows(events.where(used), run_id=F.col("user_id"), seq=F.col("event_id"), type=F.lit("usage"), model=F.element_at(models, F.col("event_type")),
                     input_tokens=F.floor(F.col("value") * 10), output_tokens=F.get_json_object("props", "$.k").cast("bigint"))


def run_log(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink).dropDuplicates(["run_id", "seq", "pos", "type"])


def done_summaries(log: DataFrame) -> DataFrame:
    """``run_id, blocked, answer, iterations, usage`` of each run in a log without replays. The answer is the last
    message with text, put together from its tokens; iterations are the steps; usage is null without a call that
    carries some. A blocked run answers so, in no step and without usage."""
    runs = log.groupBy("run_id").agg((F.count_if(F.col("type") == "blocked") > 0).alias("blocked"), F.count_if(F.col("type") == "step").alias("steps"))
    tokens = log.where("type = 'token'").select(F.col("run_id").alias("thread_id"), "seq", "pos", F.col("text").alias("token"))
    last = reassemble(tokens).groupBy(F.col("thread_id").alias("run_id")).agg(F.max_by("text", "seq").alias("last"))
    report = U.price(U.roll_up(log.where("type = 'usage'"), "run_id"))
    fields = [c for c in report.columns if c != "run_id"]
    usage = report.select("run_id", U.usage_info(report.select(*fields)).alias("used"))
    go = ~F.col("blocked")
    return runs.join(last, "run_id", "left").join(usage, "run_id", "left").select(
        "run_id", "blocked", F.when(go, F.coalesce("last", F.lit(NO_ANSWER))).otherwise(BLOCKED).alias("answer"),
        F.when(go, F.col("steps")).otherwise(0).cast("bigint").alias("iterations"), F.when(go, F.col("used")).alias("usage"))
