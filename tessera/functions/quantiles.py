"""Exact, linearly interpolated quantiles per group without gathering a group.

``percentile`` keeps every value of a group in one aggregation buffer; a group
holding a third of the table would land in one task. Here equal values are
counted first and the counts are stored, so the table is read once whatever it
takes to make it. The counts are range sorted by ``(group, value)`` (a hot group
is split across many partitions), running totals within a group say which rows a
value stands for, and only the values at the two rows that bracket each requested
quantile are picked out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.prefix import null_safe, prefix_sum
from tessera.session import cut_lineage, fits

#: Most wanted quantiles, over all groups, that are broadcast.
TARGETS = 500_000


def exact_quantiles(df: DataFrame, group: list[str], value: str, qs: list[float],
                    prefix: str = "q", weight: str | None = None) -> DataFrame:
    """One row per group: ``n`` and one column per quantile (``{prefix}{int(q*100)}``),
    interpolated as ``v[lo] + (v[hi] - v[lo]) * frac`` with position ``(n-1) q``
    (same rule as Spark ``percentile`` / DuckDB ``quantile_cont`` / ``statistics.median``).
    With ``weight`` a row stands for so many rows."""
    v = df.select(*group, F.col(value).cast("double").alias("_x"), (F.lit(1) if weight is None else F.col(weight)).cast("long").alias("_w"))
    # running totals and sizes come from a stored table, so every branch below sees the same ones
    counts = cut_lineage(v.where(F.col("_x").isNotNull()).groupBy(*group, "_x").agg(F.sum("_w").alias("_c")), "quantiles")
    bounds = counts.groupBy(*group).agg(F.sum("_c").alias("n"))
    targets = bounds.select(*group, "n", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("_q"))
    x = (F.col("n") - 1) * F.col("_q")
    targets = targets.select("*", F.floor(x).alias("_lo"), F.ceil(x).alias("_hi"), (x - F.floor(x)).alias("_f"))
    # the value at row r (from 0) of a group has r among the rows that it stands for
    at = prefix_sum(counts, group, ["_x"], F.col("_c"), "_end").select(*[F.col(g).alias(f"_k{i}") for i, g in enumerate(group)], "_x", "_c", "_end")
    holds = lambda r: (F.col(r) < F.col("_end")) & (F.col(r) >= F.col("_end") - F.col("_c"))
    value_at = lambda r: F.max(F.when(holds(r), F.col("_x")))
    on = null_safe(targets, at, group, [f"_k{i}" for i in range(len(group))]) & (holds("_lo") | holds("_hi"))
    few = F.broadcast(targets) if fits(targets, TARGETS) else targets  # so that no group of values is gathered
    res = (at.join(few, on).groupBy(*group, "n", "_q", "_f")
           .agg(value_at("_lo").alias("_vlo"), value_at("_hi").alias("_vhi"))
           .select(*group, "n", "_q", (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_f")).alias("_val")))
    out = res.groupBy(*group, "n").pivot("_q", [float(q) for q in qs]).agg(F.first("_val"))
    return out.select(*group, "n", *[F.col(f"`{float(q)}`").alias(f"{prefix}{int(round(q * 100))}") for q in qs])
