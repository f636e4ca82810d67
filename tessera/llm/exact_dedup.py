"""Exact dedup by skew-safe combining, in DataFrame functions only.

1. Each task merges equal texts among its own rows (the partial aggregation of step 2).
2. Rows meet by (digest, salt): a group that holds a third of all rows is met in ``salts`` places.
3. The salt winners of a digest meet; there are at most ``salts`` rows for each distinct text.

The full normalised text is part of the grouping key in every step, so two texts that share a digest
stay apart. The winners are written once with the salt they came from; documents find their group by
(digest, salt), which spreads a hot group over ``salts`` tasks again. Only for a digest that several
texts share is the text itself compared in that last join as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import SPACES, column, free_name
from tessera.session import cut_lineage

_STEP = 2 ** 65  # more than twice any id, so length * _STEP - id orders by length, then by smaller id
_NO_ID = 2 ** 63  # stands for a null id: after every long


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(20,0)")


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def sha256_hex(norm: Column) -> Column:
    return F.sha2(norm, 256)


def label_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 128,
                 digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical without white space; null counts as empty. Of equal texts
    the one with the most code points stays, then the smallest id (a null id comes last). Rows that
    repeat the id of the row that stays are all marked ``kept`` (``drop_copies`` keeps one of them).
    An empty table gives an empty result; other columns of ``docs`` are ignored, whatever their names.
    """
    ids, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    d = docs.select(ids.alias("id"), normalised(text).alias("norm"),
                    F.length(F.coalesce(text, F.lit(""))).alias("len"),
                    F.pmod(F.xxhash64(ids), F.lit(salts)).cast("int").alias("salt"))
    d = d.withColumn("dig", digest(F.col("norm")))
    # the best row of a group as one number that a hash aggregation can update in place
    rank = (F.col("len").cast("decimal(11,0)") * _whole(_STEP)
            - F.coalesce(F.col("id").cast("decimal(20,0)"), _whole(_NO_ID))).cast("decimal(38,0)")
    salted = d.groupBy("dig", "salt", "norm").agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("n"))
    group, in_order, whole = Window.partitionBy("dig", "norm"), Window.partitionBy("dig").orderBy("norm"), Window.partitionBy("dig")
    merged = (salted.repartition("dig")
              .withColumn("variant", F.dense_rank().over(in_order))
              .withColumn("best", F.max("best").over(group))
              .withColumn("n", F.sum("n").over(group))
              .withColumn("variants", F.max("variant").over(whole)))
    winners = cut_lineage(merged.select(
        "dig", "salt", "best", "n", "variants",
        F.when(F.col("variants") > 1, F.col("norm")).alias("norm")), "copies")
    plain = winners.where("variants = 1").drop("norm", "variants")
    shared = winners.where("variants > 1").drop("variants")
    out = d.select("id", "dig", "salt").join(plain, ["dig", "salt"])
    if not shared.isEmpty():  # several texts under one digest: compare the texts themselves
        out = out.unionByName(d.select("id", "dig", "salt", "norm").join(shared, ["dig", "salt", "norm"]).drop("norm"))
    code = F.pmod(-F.col("best"), _whole(_STEP).cast("decimal(38,0)"))
    keep = (F.when(code == _whole(_NO_ID), F.lit(None))
            .when(code > _whole(2 ** 64), code - _whole(_STEP)).otherwise(code)).cast("long")
    return out.select(F.col("id").alias("doc_id"), keep.alias("keep_id"), F.col("n").alias("group_size"),
                      F.col("id").eqNullSafe(keep).alias("kept"), F.col("dig").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 128, hot_rows: int = 1_000,
                digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """The rows of ``docs`` that stay, one for each group of equal texts, with all their columns, whatever their names.

    The row that stays is that of ``label_copies``; where several rows have its length and id, one of them does.
    Digests are counted first, as narrow rows. A digest of at most ``hot_rows`` rows has one place, where its rows meet
    once and are compared by their full text. Those of the others, which are at most a ``hot_rows``-th of all rows, are
    merged by each task, then by (digest, salt), then by digest, with the full text in the key at each step. Nothing
    is joined back, so a text is shuffled once.
    """
    dig, norm, rank, nth, salt, row = (free_name(docs.columns, c) for c in ("copy_dig", "copy_norm", "copy_rank", "copy_nth", "copy_salt", "copy_row"))
    text, ids = column(text_col).cast("string"), column(id_col).cast("long")
    marked = docs.withColumn(dig, digest(normalised(text)))
    counts = docs.select(digest(normalised(text)).alias(dig)).groupBy(dig).agg(F.count(F.lit(1)).alias(nth))
    hot = cut_lineage(counts.where(F.col(nth) > hot_rows).select(dig), "hot-copies")
    best = [F.length(F.coalesce(text, F.lit(""))).desc(), ids.asc_nulls_last()]
    cold = marked if (n := hot.count()) == 0 else marked.join(F.broadcast(hot) if n <= 1_000_000 else hot, dig, "left_anti")
    first = Window.partitionBy(dig, norm).orderBy(*best)
    out = (cold.repartition(dig).withColumn(norm, normalised(text)).withColumn(nth, F.row_number().over(first))
           .where(F.col(nth) == 1).select(*[column(c) for c in docs.columns]))
    if n:
        order = F.struct(F.length(F.coalesce(text, F.lit(""))).alias("len"), ids.isNotNull().alias("has"), (-ids.cast("decimal(20,0)")).alias("id"))
        rows = marked.join(F.broadcast(hot) if n <= 1_000_000 else hot, dig, "left_semi").select(
            dig, normalised(text).alias(norm), F.pmod(F.xxhash64(ids), F.lit(salts)).alias(salt), order.alias(rank),
            F.struct(*[column(c) for c in docs.columns]).alias(row))
        merged = lambda d, *by: d.groupBy(dig, norm, *by).agg(F.max(rank).alias(rank), F.max_by(row, rank).alias(row))
        kept = merged(merged(rows, salt), ).select(*[F.col(row).getField(c).alias(c) for c in docs.columns])
        out = out.unionByName(kept)
    return out
