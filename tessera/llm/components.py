"""Connected components of a table of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of longs -> ``node, label`` for every node of a link; label is the least node of its
    component. Each round hands every node the least label around it and then that label's own label, so
    stars take two rounds and long chains a logarithmic number. Links and labels stay tables; a node with
    many links is pre-aggregated where its links are."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = cut_lineage(both, "links")
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        around = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = labels.join(around, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("next"))
        new = cut_lineage(step.join(jump, "low").select("node", F.col("label").alias("old"), F.least("low", "next").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels
