"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage, ship_package

#: The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Rows and characters of texts that a Python operator works on at once. Arrow batches are larger (Spark bounds their bytes).
TEXT_ROWS, TEXT_CHARS = 256, 4_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The given table. A scan of a single split (a small single-file table) is dealt out over the
    task slots; any larger input keeps its own splits, so nothing is shuffled here at scale."""
    ship_package(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if df.rdd.getNumPartitions() == 1:
        return df.repartition(max(2, spark.sparkContext.defaultParallelism))
    return df


def text_slices(batches: Iterable[pd.DataFrame], column: str = "text", rows: int = TEXT_ROWS, chars: int = TEXT_CHARS) -> Iterator[pd.DataFrame]:
    """The rows of ``batches`` in frames of at most ``rows`` rows and ``chars`` characters; a longer text stands alone."""
    for b in batches:
        sizes = [len(t) if t is not None else 0 for t in b[column]]
        at, held = 0, 0
        for i, n in enumerate(sizes):
            if i > at and (i - at >= rows or held + n > chars):
                yield b.iloc[at:i].reset_index(drop=True)
                at, held = i, 0
            held += n
        if at < len(b):
            yield b.iloc[at:].reset_index(drop=True)


class Recent:
    """What was worked out for keys, for about ``most`` to ``2 * most`` of those met last: when the newer half is full the
    older one is dropped. Keys that come again and again stay, those that came once go."""

    def __init__(self, most: int):
        self.most, self.held, self.older = most, {}, {}

    def missing(self, keys: set, more: bool = False) -> list:
        """The ``keys`` that must be worked out and put into ``held``; all others are there then. With ``more`` the keys of
        the call before stay in ``held`` as well."""
        if len(self.held) > self.most and not more:
            self.held, self.older = {}, self.held
        held, older, out = self.held, self.older, []
        for k in keys.difference(held):
            if k in older:
                held[k] = older[k]
            else:
                out.append(k)
        return out

    def rest(self, most: int = 50_000) -> None:
        """Called at the end of a task: a worker that waits for its next task holds no more than ``most`` keys."""
        self.older = {}
        if len(self.held) > most:
            self.held = {}


def free_name(taken: Iterable[str], base: str) -> str:
    """A column name that none of ``taken`` is, whatever its case."""
    used = {c.lower() for c in taken}
    while base.lower() in used:
        base += "_"
    return base


def column(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def words_count(text: Column) -> Column:
    """Number of runs without white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def numbered_ranges(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` range-sorted and written once, with the number of its range in ``_p``.

    The table is stored, so everything that is later derived from ``_p`` (totals of the ranges and
    the rows themselves) sees the same division of the rows.
    """
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id())
    return cut_lineage(ranged, name)


def prefix_totals(stored: DataFrame, key: str, value: str, order: list[Column], before: str) -> DataFrame:
    """``before`` = sum of ``value`` over the earlier rows of the same ``key`` in ``order``.

    ``stored`` comes from ``numbered_ranges`` with an order that begins with ``key``; ``key`` must not
    be null. A key with many rows is spread over many ranges: each range is summed on its own, and only
    one total for each (range, key) meets the others.
    """
    own = Window.partitionBy("_p", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    totals = stored.groupBy("_p", key).agg(F.sum(value).alias("_sum"))
    offsets = totals.select("_p", key, F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_off"))
    local = stored.withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    return local.join(offsets, ["_p", key]).withColumn(before, F.col("_own") + F.col("_off")).drop("_own", "_off")
