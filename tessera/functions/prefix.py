"""Running sums and row numbers per key without putting a key into one task.

A window ``partitionBy(key)`` processes a whole key in one task; with one key
holding a third of the table that task is the job. Here the table is range
sorted by ``(key, order)`` and **written once with the number of its range**;
a hot key spans many ranges. The running sum is taken inside each (range, key)
piece, and each piece is shifted by the totals of the same key in earlier
ranges. Pieces and totals both come from the stored table, so they always
agree on which row lies in which range. Keys are joined null-safe.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def stored_ranges(df: DataFrame, by: list[Column], name: str = "ranges") -> DataFrame:
    """``df`` dealt into ranges of ``by`` and written, with the range number in ``_p``."""
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return cut_lineage(df.repartitionByRange(n, *by).withColumn("_p", F.spark_partition_id()), name)


def null_safe(left: DataFrame, right: DataFrame, left_cols: list[str], right_cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in zip(left_cols, right_cols)])


def prefix_sum(df: DataFrame, key: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """``out`` = sum of ``value`` over rows of the same key up to and including this
    row in ``order`` (ties in ``order`` must not occur; add a unique column)."""
    pos = stored_ranges(df.withColumn("_v", value), [F.col(c).asc_nulls_first() for c in (*key, *order)], "prefix")
    w = Window.partitionBy("_p", *key).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    wk = Window.partitionBy(*key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    local = pos.withColumn("_cum", F.sum("_v").over(w))
    piece = pos.groupBy("_p", *key).agg(F.sum("_v").alias("_tot"))
    offs = piece.select(F.col("_p").alias("_op"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)],
                        F.coalesce(F.sum("_tot").over(wk), F.lit(0)).alias("_off"))
    on = null_safe(local, offs, ["_p", *key], ["_op", *[f"_k{i}" for i in range(len(key))]])
    return local.join(offs, on).select(*[local[c] for c in df.columns], (F.col("_off") + F.col("_cum")).alias(out))


def row_number_by(df: DataFrame, key: list[str], order: list[str], out: str = "row_no") -> DataFrame:
    """1-based position within the key in ``order`` (``order`` must be unique per key)."""
    return prefix_sum(df, key, order, F.lit(1).cast("bigint"), out)


def global_positions(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """0-based position of each row in one order over the whole table. Only one count
    per range meets the others; no task sorts the whole table."""
    pos = stored_ranges(df, order, "positions")
    sizes = pos.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))  # a row per range
    local = pos.withColumn("_l", F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1)
    return local.join(offs, "_p").withColumn(out, (F.col("_off") + F.col("_l")).cast("bigint")).drop("_p", "_l", "_off")
