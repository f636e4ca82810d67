"""V6: every (strategy, model, method) over one question table.

A combination of chunk strategy and model has an index of its own; its ranked lists are written under its keys, so what
follows (first hits, metrics, deltas, reports) is one job over all of them. A combination that fails is reported with
its error and leaves the others as they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.retrieve import METHODS, bm25_topk, retrieve_many, with_sources
from tessera.operators.stored import build_index
from tessera.session import cut_lineage, delete_paths, stored_copies

KEYS = ["strategy", "model", "method"]


@dataclass
class Matrix:
    """``ranked(strategy, model, method, query_id, rank, chunk_id, score, source_path)`` of the combinations that went well,
    their keys, and the error of each (strategy, model) that did not."""

    ranked: DataFrame | None
    combos: list[dict]
    failed: list[dict]

    def failures(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(f["strategy"], f["model"], f["error"]) for f in self.failed], "strategy string, model string, error string")


def run_matrix(questions: DataFrame, corpora: Mapping[str, DataFrame], embedders: Sequence, folder: str, methods: Sequence[str] = METHODS,
               k: int = 10, fetch_k: int = 20, states: Mapping[str, str] | None = None) -> Matrix:
    """Ranked lists of ``questions(query_id, question)`` for each strategy of ``corpora`` (its passages: ``chunk_id,
    source_path, text``), each of ``embedders`` and each method. Indexes are kept under ``folder`` and opened again while
    ``states`` (by strategy; else the passages' content) stays the same. The models of a strategy share its postings and
    what BM25 finds in them, and its passages, which are cut once and stored until its last model is through."""
    lists: list[DataFrame] = []
    combos, failed = [], []
    for strategy, passages in corpora.items():
        stored, found, temp = None, {}, []
        for emb in embedders:
            try:
                if stored is None:
                    with stored_copies() as temp:
                        stored = cut_lineage(passages, "passages")
                index = build_index(stored, folder, strategy, emb, (states or {}).get(strategy))
                at = index.folders["postings"]
                if at not in found and set(methods) - {"dense"}:
                    found[at] = cut_lineage(bm25_topk(questions, index.bm25, max(k, fetch_k)), "bm25")
                per = retrieve_many(questions, stored, list(methods), k=k, fetch_k=fetch_k, embedder=emb, index=index, bm25_list=found.get(at))
                own = None
                for m in methods:
                    r = per[m].select(F.lit(strategy).alias("strategy"), F.lit(emb.model).alias("model"), F.lit(m).alias("method"), "query_id", "rank", "chunk_id", "score")
                    own = r if own is None else own.unionByName(r)
                lists.append(cut_lineage(with_sources(own, index.keys), "ranked"))  # runs here, so that a failure stays with its combination
            except Exception as e:  # noqa: BLE001 - whatever a model or a table does is this combination's own
                failed.append({"strategy": strategy, "model": emb.model, "error": f"{type(e).__name__}: {e}".split("\n")[0][:500]})
                continue
            combos += [{"strategy": strategy, "model": emb.model, "method": m} for m in methods]
        delete_paths(questions.sparkSession, temp)
    ranked = None
    for r in lists:
        ranked = r if ranked is None else ranked.unionByName(r)
    return Matrix(ranked, combos, failed)
