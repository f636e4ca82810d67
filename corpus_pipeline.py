"""The training corpus pipeline: toxicity, exact dedup, near-dedup, mixing, packing.

Null texts count as empty, and rows without an id stay what they are: the stages pass on all columns of ``documents`` and
any others, whatever their names. Rows that repeat an id are one document to near-dedup, and copies to exact dedup if
their texts are equal. An empty table gives an empty result. Each stage takes what its predecessor kept and, but for the last, returns the columns of ``documents``.
Toxic documents go; of equal texts and of each class of near copies one document stays; the mix takes each
source to its target, so a document may be left out or stand there up to three times; packing returns a row
for each piece of each document that the mix holds. No SQL form: the stages learn, hash and tokenise.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import dart_minhash, exact_dedup, mixing, packing, toxicity
from tessera.llm.common import read_table
from tessera.llm.queries import tokenizer_path, toxicity_model
from tessera.session import checkpoint_dir, delete_paths, stored_copies


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_model(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    return toxicity.clean_documents(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dart_minhash.drop_near_copies(docs, threshold=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, weights=(5, 2, 1), share=1.0, max_epochs=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path(), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one returns is written as Parquet and read again. What a stage stored for
    itself, and the result before it, are deleted once its own result is written."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/tessera-pipeline/{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES:
        with stored_copies() as own:
            stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        delete_paths(spark, [*own, *before])
        before = [f"{base}/{name}"]
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
