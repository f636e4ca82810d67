"""Keyed stream state: threads (X1) and done rows of runs (X4), over restarts, late rows, replays and silence."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F

from tessera.sources.driver import messages
from tessera.streaming import state as Z
from tessera.streaming import threads as X
from tessera.session import checkpoint_dir

from conftest import SF001


def _base(spark):
    return f"{checkpoint_dir(spark)}/state-{uuid.uuid4().hex}"


class Feed:
    """A file stream that gets its files one at a time."""

    def __init__(self, spark, schema):
        self.spark, self.schema, self.base, self.n = spark, schema, _base(spark), 0
        self.send([])

    def send(self, rows):
        self.n += 1
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(f"{self.base}/in/{self.n}")

    def run(self, build):
        src = X.file_stream(self.spark, f"{self.base}/in/*", self.spark.createDataFrame([], self.schema).schema, max_files=1)
        Z.run_until_now(build(src), f"{self.base}/out", f"{self.base}/ckpt")

    def out(self, schema):
        return self.spark.read.schema(schema).parquet(f"{self.base}/out")

    def held(self):
        return Z.state_rows(self.spark, f"{self.base}/ckpt")


def test_ranges_join_and_forget_nothing():
    assert Z.add_to_ranges([], []) == [] and Z.add_to_ranges([[1, 3]], [5, 4, 9, 2]) == [[1, 5], [9, 9]]
    assert Z.add_to_ranges([[1, 1], [3, 3]], [2, -4]) == [[-4, -4], [1, 3]]


def test_threads_equal_the_log_after_stop_and_restart(spark):
    m = messages(spark, SF001).select("thread_id", "seq")
    rows = [tuple(r) for r in m.collect()]
    feed = Feed(spark, "thread_id long, seq long")
    feed.send(rows[::2])
    feed.run(Z.track_threads)
    feed.send(rows[1::2] + rows[:40])  # with replays
    feed.send([(None, 1), (rows[0][0], None)])
    feed.run(Z.track_threads)
    got = {tuple(r) for r in Z.tracked_state(feed.out(Z.THREAD_UPDATE)).collect()}
    want = {tuple(r) for r in m.distinct().groupBy("thread_id").agg(F.count("seq"), F.max("seq")).collect()}
    assert got == want and feed.held() == len(want)


def test_silent_threads_leave_the_state_and_come_back_whole(spark):
    feed = Feed(spark, "thread_id long, seq long")
    build = lambda m: Z.track_threads(m, ttl_ms=1)
    feed.send([(1, s) for s in range(5)] + [(2, 0)])
    feed.run(build)
    assert feed.held() == 2
    for i in range(3):
        time.sleep(0.05)
        feed.send([(100 + i, 0)])
        feed.run(build)
    assert feed.held() <= 2  # what is silent goes, whatever has come by
    feed.send([(1, 4), (1, 5), (1, 9)])  # a replay, the next and a later one
    feed.run(build)
    got = {r.thread_id: (r.n_messages, r.last_seq) for r in Z.tracked_state(feed.out(Z.THREAD_UPDATE)).collect()}
    assert got[1] == (7, 9) and got[2] == (1, 0)


RUN = "run_id long, seq long, pos int, type string, text string, model string, input_tokens long, output_tokens long"


def _row(run, seq, type_, pos=None, text=None, model=None, used=None, given=None):
    return (run, seq, pos, type_, text, model, used, given)


def test_done_rows_come_when_a_run_is_complete(spark):
    feed = Feed(spark, RUN)
    a = [_row(1, 0, "request"), _row(1, 1, "step"), _row(1, 1, "token", 0, "Hel"), _row(1, 1, "token", 1, "lo"), _row(1, 3, "step"),
         _row(1, 3, "token", 1, " all"), _row(1, 3, "token", 0, "Bye"), _row(1, 7, "usage", None, None, "gpt-4o-mini", 100, 10)]
    feed.send(a[::-1][:4] + [_row(2, 0, "blocked", None, X.BLOCKED), _row(2, 1, "end")])
    feed.run(Z.done_rows)
    out = feed.out(Z.DONE)
    assert [r.run_id for r in out.collect()] == [2] and feed.held() == 1
    feed.send([_row(1, len(a), "end")])  # the marker overtakes rows
    feed.run(Z.done_rows)
    assert feed.out(Z.DONE).count() == 1 and feed.held() == 1
    feed.send(a[:5])  # the late rows, with one that came before
    feed.run(Z.done_rows)  # after a restart
    got = {r.run_id: r for r in Z.priced(feed.out(Z.DONE)).collect()}
    assert feed.held() == 0 and set(got) == {1, 2}
    assert (got[1].answer, got[1].iterations, got[1].usage.llm_calls, got[1].usage.input_tokens) == ("Bye all", 2, 1, 100)
    assert (got[2].blocked, got[2].answer, got[2].iterations, got[2].usage) == (True, X.BLOCKED, 0, None)


def test_replays_of_a_finished_run_leave_the_state_again(spark):
    feed = Feed(spark, RUN)
    build = lambda m: Z.done_rows(m, ttl_ms=1)
    feed.send([_row(1, 0, "step"), _row(1, 1, "end"), _row(None, 0, "step")])
    feed.run(build)
    feed.send([_row(1, 0, "step")])
    feed.run(build)
    assert feed.held() == 1
    for i in range(2):
        time.sleep(0.05)
        feed.send([_row(10 + i, 0, "step"), _row(10 + i, 1, "end")])
        feed.run(build)
    assert feed.held() == 0 and sorted(r.run_id for r in feed.out(Z.DONE).collect()) == [1, 10, 11]
