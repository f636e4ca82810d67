"""L-operators: Python traceback parsing and error-signature roll-ups over log tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Exception line (type + optional message) and frame patterns.
EXC_LINE = r"(?muUd)^\s*([A-Za-z_][A-Za-z0-9_.]*(?:Error|Exception|Warning|Interrupt))(?::\s*(.*))?$"
FRAME = r'(?uUd)File "([^"]+)", line (\d+), in (\S+)'


def parse_traceback(text: Column) -> Column:
    """L1: struct(exception_type, exception_message, innermost_file, innermost_line,
    innermost_func, frame_count). The last exception line and the last frame
    win; unparsable parts are null; frame_count is a string, "0" when none."""
    t = F.coalesce(text, F.lit(""))
    types = F.regexp_extract_all(t, F.lit(EXC_LINE), 1)
    msgs = F.regexp_extract_all(t, F.lit(EXC_LINE), 2)
    files = F.regexp_extract_all(t, F.lit(FRAME), 1)
    lines = F.regexp_extract_all(t, F.lit(FRAME), 2)
    funcs = F.regexp_extract_all(t, F.lit(FRAME), 3)
    n = F.size(files)

    def last(a: Column) -> Column:
        return F.when(F.size(a) > 0, F.element_at(a, -1))

    msg = F.nullif(F.regexp_replace(last(msgs), r"(?U)^\s+|\s+$", ""), F.lit(""))
    return F.struct(last(types).alias("exception_type"),
                    F.when(F.size(types) > 0, msg).alias("exception_message"),
                    last(files).alias("innermost_file"), last(lines).alias("innermost_line"),
                    last(funcs).alias("innermost_func"), n.cast("string").alias("frame_count"))


def summary_block(p: Column) -> Column:
    """L2: the parsed summary as Markdown lines."""
    exc = F.when(p["exception_type"].isNotNull(),
                 F.concat(F.lit("- exception: "), p["exception_type"],
                          F.when(p["exception_message"].isNotNull(),
                                 F.concat(F.lit(": "), p["exception_message"])).otherwise(F.lit(""))))\
        .otherwise(F.lit("- exception: (could not parse — not a standard Python traceback)"))
    frame = F.when(p["innermost_file"].isNotNull(),
                   F.concat(F.lit("- innermost frame: "), p["innermost_file"], F.lit(":"), p["innermost_line"],
                            F.lit(" in "), p["innermost_func"]))
    return F.concat_ws("\n", F.lit("### Parsed"), exc, frame, F.concat(F.lit("- total frames: "), p["frame_count"]))


def error_signatures(logs: DataFrame, text_col: str = "text", ts_col: str = "ts") -> DataFrame:
    """L3: count, share of all parsed errors and latest time per signature
    (exception type x innermost frame). Partial aggregation before the shuffle;
    the total is a scalar subquery."""
    p = logs.select(F.col(ts_col).alias("ts"), parse_traceback(F.col(text_col)).alias("p"))
    sig = p.select("ts", F.coalesce("p.exception_type", F.lit("(unparsed)")).alias("exception_type"),
                   F.col("p.innermost_file").alias("innermost_file"),
                   F.col("p.innermost_line").alias("innermost_line"))
    g = sig.groupBy("exception_type", "innermost_file", "innermost_line").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest"))
    total = g.select(F.sum("n")).scalar()
    return g.withColumn("share", F.col("n") / total)
