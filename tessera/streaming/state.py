"""X1 and X4 as keyed stream state: what a thread or a run has come to is known while the stream runs, from its state
and not from a pass over the log.

* Threads (X1): the state of a thread is the set of its message numbers as ranges, so a replayed or late message changes
  nothing twice. A thread that is silent for the time to live leaves the state; what it had is in the rows already
  emitted, and when it comes back its new ranges are united with those.
* Runs (X4): rows of a run gather until its end marker has come and as many rows as the marker says; then the done row
  is emitted and the state is dropped, whatever the order in which rows and marker came.

Spark keeps the state next to the offsets under the stream's checkpoint, so a restart goes on where it stopped.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tessera.operators import usage as U
from tessera.operators.traces import NO_ANSWER
from tessera.session import ship_package
from tessera.streaming.threads import BLOCKED, run_events, run_usage

# --------------------------------------------------------------------------- X1


def add_to_ranges(ranges: list[list[int]], numbers: Iterable[int]) -> list[list[int]]:
    """Sorted, disjoint ``[first, last]`` ranges with more numbers in them; neighbours are joined."""
    out: list[list[int]] = []
    for lo, hi in sorted([*map(list, ranges), *([n, n] for n in set(numbers))]):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


RANGES = T.ArrayType(T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())]))
THREAD_UPDATE = T.StructType([T.StructField("thread_id", T.LongType()), T.StructField("since", T.LongType()),
                              T.StructField("n_messages", T.LongType()), T.StructField("ranges", RANGES)])


def track_threads(messages: DataFrame, ttl_ms: int = 24 * 3600 * 1000) -> DataFrame:
    """For the stream ``messages(thread_id, seq, ...)`` one row for each thread of a micro-batch with all message
    numbers that its state holds. ``since`` tells the lives of a thread in the state apart."""
    def update(key, frames: Iterable[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        since, held = state.get if state.exists else (state.getCurrentProcessingTimeMs(), "[]")
        ranges = json.loads(held)
        for b in frames:
            ranges = add_to_ranges(ranges, b["seq"].dropna().astype("int64").tolist())
        state.update((since, json.dumps(ranges)))
        state.setTimeoutDuration(ttl_ms)
        yield pd.DataFrame({"thread_id": [key[0]], "since": [since], "n_messages": [sum(hi - lo + 1 for lo, hi in ranges)],
                            "ranges": [[{"lo": lo, "hi": hi} for lo, hi in ranges]]})

    ship_package(messages.sparkSession)
    return messages.where("thread_id is not null").select(F.col("thread_id").cast("long").alias("thread_id"), F.col("seq").cast("long").alias("seq")).groupBy(
        "thread_id").applyInPandasWithState(update, THREAD_UPDATE, "since long, ranges string", "append", GroupStateTimeout.ProcessingTimeTimeout)


def tracked_state(updates: DataFrame) -> DataFrame:
    """``thread_id, n_messages, last_seq`` from the rows of :func:`track_threads`: the last of each life, united."""
    last = updates.groupBy("thread_id", "since").agg(F.max_by("ranges", "n_messages").alias("ranges"))
    r = last.select("thread_id", F.inline("ranges"))
    before = Window.partitionBy("thread_id").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    new_from = F.greatest(F.col("lo"), F.coalesce(F.max("hi").over(before) + 1, F.col("lo")))
    r = r.withColumn("n", F.greatest(F.col("hi") - new_from + 1, F.lit(0)))
    return r.groupBy("thread_id").agg(F.sum("n").alias("n_messages"), F.max("hi").alias("last_seq"))


# --------------------------------------------------------------------------- X4

DONE = T.StructType([
    T.StructField("run_id", T.LongType()), T.StructField("blocked", T.BooleanType()), T.StructField("last", T.StringType()),
    T.StructField("steps", T.LongType()),
    T.StructField("calls", T.ArrayType(T.StructType([T.StructField("model", T.StringType()), T.StructField("input_tokens", T.LongType()),
                                                      T.StructField("output_tokens", T.LongType())])))])


def end_markers(rows: DataFrame) -> DataFrame:
    """The marker that ends a run, as its producer sends it: how many rows the run has (in ``seq``), replays not counted."""
    n = rows.where("run_id is not null").dropDuplicates(["run_id", "seq", "pos", "type"]).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    given = {"run_id": F.col("run_id"), "seq": F.col("n"), "type": F.lit("end")}
    return n.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema])


class Run:
    """What the rows of a run have come to; kept as JSON in the state."""

    def __init__(self, held: str | None):
        d = json.loads(held or "{}")
        self.seen: set[tuple] = {tuple(k) for k in d.get("seen", [])}
        self.rows: int | None = d.get("rows")
        self.steps, self.blocked, self.seq = d.get("steps", 0), d.get("blocked", False), d.get("seq")
        self.parts: dict[int, str] = {int(k): v for k, v in d.get("parts", {}).items()}
        self.calls: list = d.get("calls", [])

    def held(self) -> str:
        return json.dumps({**vars(self), "seen": sorted(self.seen, key=repr)})

    def add(self, seq, pos, type_, text, model, used, given) -> None:
        if type_ == "end":
            self.rows = int(seq)
            return
        key = (seq, pos, type_)
        if key in self.seen:  # a replay
            return
        self.seen.add(key)
        if type_ == "step":
            self.steps += 1
        elif type_ == "blocked":
            self.blocked = True
        elif type_ == "usage":
            self.calls.append([model, used, given])
        elif type_ == "token" and (self.seq is None or seq >= self.seq):  # only the last message that has text is an answer
            if seq != self.seq:
                self.seq, self.parts = seq, {}
            self.parts[pos] = text

    @property
    def done(self) -> bool:
        return self.rows is not None and len(self.seen) >= self.rows


def done_rows(rows: DataFrame, ttl_ms: int = 24 * 3600 * 1000) -> DataFrame:
    """A row for each run of the stream ``rows`` (see :func:`run_events`, :func:`run_usage`, :func:`end_markers`) when it is
    complete. A run that stays incomplete, and rows that are replayed after their run is done, leave the state after
    the time to live."""
    def update(key, frames: Iterable[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        run = Run(state.get[0] if state.exists else None)
        for b in frames:
            plain = b.astype(object).where(b.notna(), None)
            for row in plain[["seq", "pos", "type", "text", "model", "input_tokens", "output_tokens"]].itertuples(index=False):
                seq, pos, type_, text, model, used, given = row
                whole = lambda x: None if x is None else int(x)
                run.add(whole(seq), whole(pos), type_, text, model, whole(used), whole(given))
        if run.done:
            if state.exists:
                state.remove()
            last = "".join(run.parts[p] for p in sorted(run.parts)) if run.parts else None
            calls = [{"model": m, "input_tokens": i, "output_tokens": o} for m, i, o in run.calls]
            yield pd.DataFrame({"run_id": [key[0]], "blocked": [run.blocked], "last": [last], "steps": [run.steps], "calls": [calls]})
        else:
            state.update((run.held(),))
            state.setTimeoutDuration(ttl_ms)

    ship_package(rows.sparkSession)
    return rows.where("run_id is not null").groupBy("run_id").applyInPandasWithState(
        update, DONE, "held string", "append", GroupStateTimeout.ProcessingTimeTimeout)


def priced(done: DataFrame) -> DataFrame:
    """``run_id, blocked, answer, iterations, usage`` of done rows, as :func:`done_summaries` gives them for a log."""
    calls = done.select("run_id", F.explode("calls").alias("c")).select("run_id", "c.*")
    report = U.price(U.roll_up(calls, "run_id"))
    usage = report.select("run_id", U.usage_info(report.select(*[c for c in report.columns if c != "run_id"])).alias("used"))
    go = ~F.col("blocked")
    return done.join(usage, "run_id", "left").select(
        "run_id", "blocked", F.when(go, F.coalesce("last", F.lit(NO_ANSWER))).otherwise(BLOCKED).alias("answer"),
        F.when(go, F.col("steps")).otherwise(0).cast("bigint").alias("iterations"), F.when(go, F.col("used")).alias("usage"))


def run_until_now(out: DataFrame, sink: str, checkpoint: str) -> None:
    """Works off what the stream has now and appends to ``sink``; called again with the same checkpoint it goes on.

    State with a time to live asks for another batch all the time, so batches without data are off for this stream: what
    is overdue leaves the state with the next data.
    """
    conf, key = out.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(key, None)
    conf.set(key, "false")
    try:
        q = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
    finally:  # the stream has its own copy of the settings
        conf.unset(key) if before is None else conf.set(key, before)
    try:
        q.awaitTermination()
    finally:
        q.stop()


def state_rows(spark: SparkSession, checkpoint: str) -> int:
    """How many keys the state under ``checkpoint`` holds now."""
    return spark.read.format("statestore").load(checkpoint).count()


__all__ = ["add_to_ranges", "done_rows", "end_markers", "priced", "run_events", "run_until_now", "run_usage", "state_rows", "track_threads", "tracked_state"]
