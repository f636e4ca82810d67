"""Secret scans over an incremental blob ledger.

Every historical version of a file is content-addressed. The ledger, a growing Parquet table, holds the
spans of each (blob, rule, rule version) that was ever scanned, also where nothing was found. A scan
takes only pairs that the ledger lacks, appends them, and joins the findings back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import text_slices
from tessera.session import cut_lineage, ship_package


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` of which ``group`` has ``least`` characters.
    ``needs``: strings of which a text must hold one for any match (a cheap test before the pattern)."""

    name: str
    version: int
    pattern: str
    least: int
    group: int = 0
    flags: int = 0
    needs: tuple[str, ...] = ()

    def spans(self, text: str, compiled: re.Pattern) -> list[tuple[int, int]]:
        if self.needs and not any(x in text for x in self.needs):
            return []
        g, least = self.group, self.least
        return [m.span() for m in compiled.finditer(text) if m.end(g) - m.start(g) >= least]


# The base kinds, in the order in which they are listed. A run of hex digits is matched
# whole either way, so its least length can be part of the pattern.
BASE_RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2,
         re.IGNORECASE | re.ASCII, (":", "=")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 16, needs=("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{32,}", 32),
)
#: Kinds beyond the base ones.
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, needs=("PRIVATE KEY-----",)),
    # begins where a run begins, so that a long run is looked at once
    Rule("jwt", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30, needs=("eyJ",)),
)
LEDGER_SCHEMA = "blob_id string, rule string, version int, spans array<struct<start:int,end:int>>"


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; one that does not exist yet is empty."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def scan_unseen(versions: DataFrame, ledger_path: str, rules: Sequence[Rule] = BASE_RULES + MORE_RULES,
                text_col: str = "text") -> DataFrame:
    """Scans the texts of ``versions`` that the ledger lacks for some rule's version; gives the appended rows.

    A null text is an empty one. Equal texts are one blob and are scanned once. The rows are written to the
    ledger in one commit, so a job that ends early leaves the ledger as it was.
    """
    spark = versions.sparkSession
    ship_package(spark)
    wanted = [f"{r.name}:{r.version}" for r in rules]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    blobs = versions.select(F.sha2(text, 256).alias("blob_id"), text.alias("text"))
    ledger = open_ledger(spark, ledger_path)
    seen = ledger.groupBy("blob_id").agg(F.collect_set(F.concat_ws(":", "rule", F.col("version").cast("string"))).alias("seen"))
    # a rule set is scanned anew only where its own pair is missing
    todo = F.array_except(F.array(*[F.lit(x) for x in wanted]), F.coalesce(F.col("seen"), F.array().cast("array<string>")))
    known = not ledger.isEmpty()
    one = blobs.dropDuplicates(["blob_id"])
    one = (one.join(seen, "blob_id", "left").withColumn("todo", todo).where(F.size("todo") > 0).drop("seen")
           if known else one.withColumn("todo", F.array(*[F.lit(x) for x in wanted])))
    compiled = {f"{r.name}:{r.version}": (r, r.pattern, r.flags) for r in rules}

    def scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = {k: (r, re.compile(p, f)) for k, (r, p, f) in compiled.items()}
        for b in text_slices(batches):
            rows = []
            for blob, body, names in zip(b["blob_id"], b["text"], b["todo"]):
                for name in names:
                    r, pattern = own[name]
                    rows.append((blob, r.name, r.version, [{"start": s, "end": e} for s, e in r.spans(body, pattern)]))
            yield pd.DataFrame(rows, columns=["blob_id", "rule", "version", "spans"])

    found = one.select("blob_id", "text", "todo").mapInPandas(scan, LEDGER_SCHEMA)
    fresh = cut_lineage(found, "scan")
    fresh.write.mode("append").parquet(ledger_path)
    return fresh


def findings(versions: DataFrame, ledger_path: str, rules: Sequence[Rule] = BASE_RULES + MORE_RULES,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, blob_id, found`` for every row (path) of ``versions``: all spans that the ledger holds for
    its text under the current rule versions, ``array<struct<start,no,end,kind>>`` by start, then kind."""
    spark = versions.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    paths = versions.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("blob_id"))
    numbers = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (f"{r.name}:{r.version}", i)])
    led = open_ledger(spark, ledger_path).withColumn("no", F.element_at(numbers, F.concat_ws(":", "rule", F.col("version").cast("string"))))
    spans = led.where(F.col("no").isNotNull() & (F.size("spans") > 0)).select(
        "blob_id", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("no").alias("no"), s["end"].alias("end"), F.col("rule").alias("kind"))).alias("own"))
    # a row for each rule of a blob, so an array of a few entries; scans that ran at once may both have written a pair
    by_blob = spans.groupBy("blob_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("own")))).alias("found"))
    none = F.array().cast("array<struct<start:int,no:int,end:int,kind:string>>")
    return paths.join(by_blob, "blob_id", "left").select("doc_id", "blob_id", F.coalesce("found", none).alias("found"))
