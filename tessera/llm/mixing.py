"""Mixing sources to target weights.

Every document gets a hash-random key. The table is range-sorted by (source, key) once, distributed
prefix sums of the word counts run inside each source, and each source is cut at its budget. A budget
above the size of its source is met by whole epochs first; the cut is made in the last one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import column, free_name, numbered_ranges, prefix_totals, words_count
from tessera.session import cut_lineage


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0,
                   max_epochs: float = 3) -> DataFrame:
    """``sizes(source, source_size)`` -> ``source, no, source_size, target``.

    Sources in code point order (null last) take the weights in turn. The budget is ``share`` of all
    sizes. A target stops at ``max_epochs`` times its source's size; what is above is shared by weight
    among the others until none is above. Only this table (a row for each source) is sorted as a whole.
    Closed form: with the sources in order of ``cap / weight``, the first k are at their caps exactly
    when the level that the rest would reach is not below the cap/weight of source k.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("no", F.row_number().over(by_name))
    s = s.withColumn("w", turn[(F.col("no") - 1) % len(weights)]).withColumn("cap", F.col("source_size") * float(max_epochs))
    filled = Window.orderBy(F.col("cap") / F.col("w"), "no")
    everything = Window.partitionBy(F.lit(1))
    s = (s.withColumn("budget", F.sum("source_size").over(everything) * float(share))
         .withColumn("below", F.coalesce(F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("rest_w", F.sum("w").over(everything)
                     - F.coalesce(F.sum("w").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))))
    # level reached by this source and all with a larger cap/weight if the earlier ones are at their caps
    s = s.withColumn("level", (F.col("budget") - F.col("below")) / F.col("rest_w"))
    s = s.withColumn("open", F.col("level") * F.col("w") <= F.col("cap"))
    first_open = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), F.col("no"), F.col("level")).alias("x"))).over(everything)
    s = s.withColumn("first", first_open)
    water = F.col("first").getField("level")
    return s.select("source", "no", "source_size",
                    F.when(water.isNull(), F.col("cap")).otherwise(F.least(water * F.col("w"), F.col("cap"))).alias("target"))


def _key(ids: Column, seed: str) -> Column:
    """Made from the id alone, so it does not depend on which task reads the row."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ids.cast("string"), F.lit("")))), 1, 16)


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, max_epochs: float = 3, seed: str = "mix",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        size: Column | None = None) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, epochs, taken``.

    ``epochs`` is how often the mix takes the document, ``taken`` the words that makes. Documents are
    taken whole: in the last epoch those whose middle word lies before the cut, so each source ends
    within half a document of its target. Sizes are numbers of words (null: 0) or the column ``size``.
    The key is a hash of id and seed, so reruns agree; rows that share an id are ordered among
    themselves by size only, and equal ones are interchangeable. An empty source has target 0; an
    empty table gives an empty result.
    """
    m = placed_rows(docs, weights, share, max_epochs, seed, id_col, text_col, source_col, size)
    m = m.withColumn("epochs", F.col("full") + F.col("last").cast("long"))
    return m.select("doc_id", "source", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size")).alias("taken"))


def placed_rows(docs: DataFrame, weights: Sequence[float], share: float, max_epochs: float, seed: str, id_col: str, text_col: str,
                source_col: str, size: Column | None) -> DataFrame:
    """The rows of :func:`mix` with their ``key``, the whole epochs ``full`` of their source and whether the ``last`` one,
    which is cut, takes them."""
    d = docs.select(column(id_col).alias("doc_id"), column(source_col).alias("source"),
                    (words_count(column(text_col)) if size is None else size.cast("long")).alias("size"))
    d = cut_lineage(d, "sizes")  # the words are counted once
    sources = cut_lineage(source_targets(
        d.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs), "targets")
    s = d.withColumn("key", _key(F.col("doc_id"), seed)).withColumn("src", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
    order = [F.col("src"), F.col("key"), F.col("doc_id"), F.col("size")]
    placed = prefix_totals(numbered_ranges(s, order, "mix"), "src", "size", order[1:], "before")
    named = sources.select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("src"),
                           "source_size", "target")
    m = placed.join(named, "src")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    m = m.withColumn("full", F.least(full, F.lit(int(max_epochs))).cast("long"))
    cut = F.col("target") - F.col("full") * F.col("source_size")
    return m.withColumn("last", (F.col("size") > 0) & (F.col("full") < F.lit(float(max_epochs))) & (F.col("before") + F.col("size") / 2 <= cut))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, max_epochs: float = 3, seed: str = "mix",
                    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", size: Column | None = None,
                    broadcast_sources: int = 200_000) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns, whatever their names.

    Along a source's order the cut of its last epoch takes all rows up to one; so a source comes down to its whole epochs
    and the (key, id, size) of that row. Each document compares its own with them where it lies, and no text is
    shuffled while the sources (a row each) are at most ``broadcast_sources``. Rows that repeat id, source and size are
    taken alike, as often as the one of them that the cut takes last.
    """
    m = placed_rows(docs, weights, share, max_epochs, seed, id_col, text_col, source_col, size)
    names = [free_name(docs.columns, c) for c in ("mix_source", "mix_full", "mix_cut", "mix_size", "mix_copy")]
    src, full, cut, words, copy = names
    # a null size counts as none and is never taken; a struct orders null ids first, as the cut did
    cuts = cut_lineage(m.groupBy(F.col("source").alias(src)).agg(
        F.max("full").alias(full), F.max(F.when(F.col("last"), F.struct("key", "doc_id", "size"))).alias(cut)), "cuts")
    few = cuts.count() <= broadcast_sources
    d = docs.withColumn(words, words_count(column(text_col)) if size is None else size.cast("long"))
    d = d.join(F.broadcast(cuts) if few else cuts, column(source_col).eqNullSafe(F.col(src)))
    own = F.struct(_key(column(id_col), seed).alias("key"), column(id_col).alias("doc_id"), F.col(words).alias("size"))
    again = F.col(cut).isNotNull() & (F.col(words) > 0) & (own <= F.col(cut))
    times = F.col(full) + F.coalesce(again, F.lit(False)).cast("long")
    d = d.withColumn(full, times).where(F.col(full) > 0)
    return d.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(full)))).select(*[column(c) for c in docs.columns])
