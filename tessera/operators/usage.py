"""U-operators: token usage roll-up and cost.

Matching is by substring and the first key in list order wins (a short key
is a substring of a longer model name, so order matters).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import round_double

# USD per 1M tokens (input, output), in match priority order.
PRICES = [
    ("gpt-4o-mini", 0.15, 0.60),
    ("gpt-4o", 2.50, 10.00),
    ("claude-sonnet-4-5", 3.00, 15.00),
    ("claude-haiku-4-5", 1.00, 5.00),
]
# Fixed value: KRW per USD.
USD_KRW = 1400.0


def roll_up(calls: DataFrame, key: str = "request_id") -> DataFrame:
    """U2 + U3: per request, sums of input/output tokens and the number of calls
    that carry usage; the model label is the sorted distinct model ids joined
    by ``,``. Calls without usage are ignored."""
    used = calls.where(F.col("input_tokens").isNotNull() | F.col("output_tokens").isNotNull())
    return used.groupBy(key).agg(
        F.sum(F.coalesce("input_tokens", F.lit(0))).cast("bigint").alias("input_tokens"),
        F.sum(F.coalesce("output_tokens", F.lit(0))).cast("bigint").alias("output_tokens"),
        F.count(F.lit(1)).alias("llm_calls"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("model") != "", F.col("model")))), ",").alias("model"))


def price(usage: DataFrame, prices=PRICES, model_col: str = "model") -> DataFrame:
    """U1 + U4: first price key (list order) contained in the model label; cost
    ``round(in/1e6 p_in + out/1e6 p_out, 6)`` and KRW from the rounded USD.

    A label that matches no key has null cost. A multi-model label is priced by
    its first matching key for all tokens. The short list becomes one CASE
    expression, so pricing is a projection (no join, no shuffle).
    """
    m = F.col(model_col)
    p_in, p_out = F.lit(None).cast("double"), F.lit(None).cast("double")
    for key, a, b in reversed(list(prices)):
        hit = m.contains(F.lit(key))
        p_in = F.when(hit, F.lit(float(a))).otherwise(p_in)
        p_out = F.when(hit, F.lit(float(b))).otherwise(p_out)
    usd = round_double(F.col("input_tokens") / 1e6 * p_in + F.col("output_tokens") / 1e6 * p_out, 6)
    return usage.select("*", (F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
                        usd.alias("cost_usd"), round_double(usd * USD_KRW, 2).alias("cost_krw"))


def usage_info(report: DataFrame) -> Column:
    """The usage struct, or null when no call carried usage."""
    return F.when(F.col("llm_calls") > 0, F.struct(*[F.col(c) for c in report.columns]))


def cost_by(priced: DataFrame, key: str) -> DataFrame:
    """S13 roll-up: usage log aggregated by a key (e.g. endpoint)."""
    return priced.groupBy(key).agg(
        F.count(F.lit(1)).alias("requests"), F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"), F.sum("cost_usd").alias("cost_usd"))
