"""Audit of interacting filters by incremental retraction.

The documents are a file stream, worked off in available-now micro-batches. Every document gets a mask of the filters
that its own text fails; whether it repeats the text of a smaller id is not known before all files are read. So the
state keeps, for each text, the least id so far and the rows that hold it. These count as first copies, all others as
repeats; when a smaller id arrives, the earlier holders are retracted from the part counters under their old mask and
counted under the new one. A task merges the rows of a text before they go to its state, so a text that a third of all
documents share sends a few rows from each task. The counters of a batch are written under its number, so a batch
that is repeated after a failure replaces them. What any order of the filters keeps, removes and loses follows from
the counts by (part, mask) alone.

Texts share state keys by hash, about ``TEXTS_PER_KEY`` to a key: Spark hands the state of one key at a time to Python,
which takes 2.4 ms a key however little is in it. The number of keys follows the number of documents.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import SPACES
from tessera.session import ship_package
from tessera.streaming.threads import file_stream

TEXTS_PER_KEY = 256
#: Micro-batches that the files are dealt to, by bytes.
BATCHES = 4

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def few_words(ws: Column, text: Column) -> Column:
    return F.size(ws) < 200


def repetitive(ws: Column, text: Column) -> Column:
    return F.size(F.array_distinct(ws)) * 100 < F.size(ws) * 50


def shouting(ws: Column, text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, _CAPITALS, ""))) * 100 > F.length(text) * 2


def symbols(ws: Column, text: Column) -> Column:
    return text.rlike(r"[#$%&*|]")


#: Conditions on the words and the text under which a document fails; the last letter stands for repeated texts.
TEXT_FILTERS: dict[str, Callable[[Column, Column], Column]] = {"A": few_words, "B": repetitive, "C": shouting, "D": symbols}
REPEATED = "E"


def masked(docs: DataFrame, filters: dict[str, Callable[[Column, Column], Column]], id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``id, no_id, part, digest, mask`` of each row: bit i of the mask is set if the i-th filter fails."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # white space becomes one kind, for which a split needs no regular expression engine
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    d = d.withColumn("ws", F.array_remove(F.split(F.translate("text", SPACES, " " * len(SPACES)), " "), ""))
    mask = F.lit(0)
    for i, fails in enumerate(filters.values()):
        mask = mask + F.when(fails(F.col("ws"), F.col("text")), 1 << i).otherwise(0)
    return d.select(F.coalesce("id", F.lit(0).cast("long")).alias("id"), F.col("id").isNull().alias("no_id"), "part",
                    F.sha2("text", 256).alias("digest"), mask.alias("mask"))


def labelled(rows: DataFrame, labels: DataFrame, label_id: str, good_col: str, toxic_col: str) -> DataFrame:
    """With ``good`` and ``toxic`` (0 or 1) from the labels; a document without a label has neither."""
    one = lambda c: F.max((F.col(c) == 1).cast("int"))
    l = labels.where(F.col(label_id).isNotNull()).groupBy(F.col(label_id).cast("long").alias("of")).agg(one(good_col).alias("g"), one(toxic_col).alias("t"))  # noqa: E741
    flag = lambda c: F.when(F.col("no_id"), 0).otherwise(F.coalesce(c, F.lit(0)))
    return rows.join(l, rows["id"] == l["of"], "left").select(*rows.columns, flag("g").alias("good"), flag("t").alias("toxic"))


COUNTED = ["part", "mask", "good", "toxic"]


def merge_copies(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row with a count for the rows of a batch that share text, part and labels and either hold the batch's least
    id of that text or are ``later``, which makes them repeats whatever else comes."""
    for b in batches:
        if not len(b):
            continue
        least = b["id"].where(~b["no_id"], b["id"].max()).groupby(b["digest"]).transform("min")
        b["later"] = ~b["no_id"] & (b["id"] > least)
        b.loc[b["later"], "id"] = 0
        yield b.groupby(["key", "digest", "no_id", "later", "id", *COUNTED], as_index=False, sort=False).size().rename(columns={"size": "n"})


MERGED = "key long, digest string, no_id boolean, later boolean, id long, part string, mask int, good int, toxic int, n long"


class Holders:
    """The state of one key: for each text its least id, its mask and the counted rows that have this id."""

    def __init__(self, stored: str | None):
        self.texts = {d: (i, m, {tuple(k): n for *k, n in rows}) for d, i, m, rows in json.loads(stored or "[]")}
        self.deltas: dict[tuple, int] = {}

    def stored(self) -> str:
        return json.dumps([(d, i, m, [(*k, n) for k, n in rows.items()]) for d, (i, m, rows) in self.texts.items()])

    def count(self, part: str, mask: int, good: int, toxic: int, n: int) -> None:
        k = (part, mask, good, toxic)
        self.deltas[k] = self.deltas.get(k, 0) + n

    def meet(self, digest: str, no_id: bool, later: bool, id_: int, part: str, mask: int, good: int, toxic: int, n: int, bit: int) -> None:
        held = self.texts.get(digest)
        if no_id:  # neither smaller nor greater than another id
            self.count(part, mask, good, toxic, n)
        elif later or held and id_ > held[0]:
            self.count(part, mask | bit, good, toxic, n)
        else:
            if held and id_ < held[0]:
                for (p, g, t), k in held[2].items():
                    self.count(p, mask, g, t, -k)
                    self.count(p, mask | bit, g, t, k)
            if not held or id_ < held[0]:
                held = self.texts[digest] = (id_, mask, {})
            held[2][part, good, toxic] = held[2].get((part, good, toxic), 0) + n
            self.count(part, mask, good, toxic, n)


def stream_counters(documents: DataFrame, labels: DataFrame, keys: int, folder: str, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                    filters: dict[str, Callable[[Column, Column], Column]] = TEXT_FILTERS,
                    label_id: str = "doc_id", good_col: str = "quality", toxic_col: str = "toxic") -> None:
    """Works off what the stream ``documents`` has now. ``folder`` keeps the stream's progress, its state and, under
    ``counters``, the changes of each micro-batch; called again with the same ``keys`` it goes on with new files only."""
    bit = 1 << len(filters)
    rows = labelled(masked(documents, filters, id_col, text_col, part_col), labels, label_id, good_col, toxic_col)
    rows = rows.withColumn("key", F.pmod(F.xxhash64("digest"), F.lit(keys))).select("key", "digest", "no_id", "id", *COUNTED)

    def update(key, frames: Iterable[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = Holders(state.get[0] if state.exists else None)
        for b in frames:
            for row in b[["digest", "no_id", "later", "id", *COUNTED, "n"]].itertuples(index=False):
                held.meet(*row[:3], *map(_plain, row[3:]), bit)
        state.update((held.stored(),))
        yield pd.DataFrame([(*k, n) for k, n in held.deltas.items() if n], columns=[*COUNTED, "delta"])

    changes = rows.mapInPandas(merge_copies, MERGED).groupBy("key").applyInPandasWithState(
        update, "part string, mask int, good int, toxic int, delta long", "texts string", "append", "NoTimeout")

    def write(batch: DataFrame, number: int) -> None:
        batch.groupBy(*COUNTED).agg(F.sum("delta").alias("delta")).write.mode("overwrite").parquet(f"{folder}/counters/batch={number}")

    q = changes.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()


def _plain(x):
    return x.item() if hasattr(x, "item") else x


def report(counters: DataFrame, letters: Sequence[str]) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` for every
    order of the filters and every part, from ``counters(part, mask, good, toxic, delta)``.

    A part is one row with the counts of its masks; the orders are worked out in that row. Over all orders, a document
    that fails k filters is removed by each of them in a k-th of the orders.
    """
    masks = range(1 << len(letters))
    by_mask = lambda what: F.array(*[F.coalesce(F.sum(F.when((F.col("mask") == m) & what, F.col("delta"))), F.lit(0)) for m in masks])
    parts = counters.groupBy("part").agg(by_mask(F.lit(True)).alias("n"), by_mask(F.col("good") == 1).alias("good"), by_mask(F.col("toxic") == 1).alias("toxic"))
    orders = ["".join(p) for p in permutations(letters)]
    d = parts.withColumn("filter_order", F.explode(F.split(F.lit(" ".join(orders)), " "))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    at = lambda i: F.instr("filter_order", letters[i])
    d = d.withColumn("before", sum((F.when(at(i) < F.col("step"), 1 << i).otherwise(0) for i in range(len(letters))), F.lit(0)))
    d = d.withColumn("own", sum((F.when(at(i) == F.col("step"), 1 << i).otherwise(0) for i in range(len(letters))), F.lit(0)))

    def total(counts: str, holds: Callable[[Column], Column], times: Callable[[Column], Column] = lambda m: F.lit(1)) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(len(masks) - 1)), F.lit(0).cast("long"),
                           lambda acc, m: acc + F.when(holds(m), F.get(counts, m) * times(m)).otherwise(F.lit(0).cast("long")))

    own = lambda m: m.bitwiseAND(F.col("own")) != 0
    passed = lambda m: m.bitwiseAND(F.col("before")) == 0
    return d.select(
        "part", "filter_order", "step",
        total("n", lambda m: passed(m) & ~own(m)).alias("kept"),
        total("n", lambda m: passed(m) & own(m)).alias("removed"),
        total("n", lambda m: ~passed(m) & own(m)).alias("redundant"),
        total("n", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", lambda m: passed(m) & own(m)).alias("good_lost"),
        total("toxic", lambda m: passed(m) & own(m)).alias("toxic_lost"),
        total("n", own, lambda m: F.floor(F.lit(len(orders)) / F.greatest(F.bit_count(m), F.lit(1)))).cast("long").alias("shapley"))


def audit(spark: SparkSession, documents_path: str, labels: DataFrame, folder: str, batches: int = BATCHES, **columns) -> DataFrame:
    """:func:`report` over the Parquet table at ``documents_path``, read as a stream of about ``batches`` micro-batches
    that leaves its state and counters in ``folder``.

    A null text counts as empty, a null part as the empty string. A document repeats another if its text is identical
    and its id greater: rows that repeat the least id are all first copies, and a row without an id neither repeats
    nor is repeated. Of several labels of an id the greater hold. An empty table has no part and gives no row.
    """
    ship_package(spark)
    stored = spark.read.parquet(documents_path)
    size = spark.read.format("binaryFile").load(documents_path).agg(F.sum("length")).first()[0]  # lists the files, reads none
    keys = max(1, -(-stored.count() // TEXTS_PER_KEY))
    documents = file_stream(spark, documents_path, stored.schema, max_bytes=max(1, -(-(size or 0) // batches)))
    stream_counters(documents, labels, keys, folder, **columns)
    letters = [*columns.get("filters", TEXT_FILTERS), REPEATED]
    changes = spark.read.schema("part string, mask int, good int, toxic int, delta long").parquet(f"{folder}/counters/batch=*")
    return report(changes.groupBy(*COUNTED).agg(F.sum("delta").alias("delta")), letters)
