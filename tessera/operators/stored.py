"""An index that is built once and opened by retrieval.

An index belongs to a passage table (a chunk strategy) and has parts: ``keys`` (chunk id, source, content key),
``postings`` (bucketed postings and the term table) and, for each model, ``vectors`` (by cell of a coarse quantiser).
A part is a folder of its own for each version. It counts from the moment its manifest is written, which names the
state of the input it was made from; a part whose manifest names the present state is opened and nothing is written.
Earlier versions are removed when a new one counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.approx import CellIndex, embed_cells, open_cells
from tessera.operators.index import Bm25Index, bm25_constants, bm25_index, collection_name, content_fingerprint, model_slug, open_bm25
from tessera.session import cut_lineage, delete_paths

PARTS = ("keys", "postings", "vectors")


def files_state(spark: SparkSession, path: str) -> str:
    """State of a stored table from its files' names, sizes and times; no content is read."""
    f = spark.read.format("binaryFile").load(path).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("path", "length", "modificationTime")), F.lit(0)).alias("h")).first()
    return f"files:{f['n']}:{f['h']}"


def content_state(passages: DataFrame) -> str:
    """State of a passage table from its content, in one pass."""
    f = content_fingerprint(passages, ["chunk_id", "source_path", "text"]).first()
    return f"rows:{f['n']}:{f['h']}"


def manifests(spark: SparkSession, base: str) -> list[dict]:
    """The manifests of a part, oldest first."""
    try:
        rows = spark.read.text(f"{base}/manifests/*").collect()  # one line each; earlier ones are removed
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((json.loads(r["value"]) for r in rows), key=lambda m: (m["version"], m["name"]))


def build_part(spark: SparkSession, base: str, state: str, build: Callable[[str], dict], keep: int = 0) -> dict:
    """The manifest of the part at ``base`` for ``state``; ``build(folder)`` runs only if the newest one is of another
    state. All but the ``keep`` newest of the earlier versions are then removed."""
    earlier = manifests(spark, base)
    if earlier and earlier[-1]["state"] == state:
        return earlier[-1]
    version = earlier[-1]["version"] + 1 if earlier else 1
    name = f"v{version:06d}-{uuid.uuid4().hex[:8]}"  # a build that broke off, or another at once, is never written into
    made = {"version": version, "name": name, "state": state, "about": build(f"{base}/{name}")}
    spark.createDataFrame([(json.dumps(made),)], "value string").coalesce(1).write.text(f"{base}/manifests/{name}")
    delete_paths(spark, [f"{base}/{x}" for m in earlier[:len(earlier) - keep] for x in (f"manifests/{m['name']}", m["name"])])
    return made


@dataclass
class StoredIndex:
    """The opened parts of an index; each is looked at when it is asked for."""

    spark: SparkSession
    folders: dict[str, str]
    made: dict[str, dict]

    def _about(self, part: str) -> dict:
        if part not in self.made:
            raise ValueError(f"the index was opened without its part {part!r}")
        return self.made[part]["about"]

    @cached_property
    def keys(self) -> DataFrame:
        """``chunk_id, source_path, content_key``; no text."""
        self._about("keys")
        return self.spark.read.parquet(f"{self.folders['keys']}/keys")

    @cached_property
    def bm25(self) -> Bm25Index:
        return open_bm25(self.spark, self.folders["postings"], self._about("postings"))

    @cached_property
    def cells(self) -> CellIndex:
        return open_cells(self.spark, self.folders["vectors"], self._about("vectors"))

    @property
    def vectors(self) -> DataFrame:
        return self.cells.vectors.select("chunk_id", "vec")

    def check_aligned(self) -> None:
        """All parts hold the same passages, by number and hash of their ids."""
        seen = {p: (m["about"]["n"], m["about"]["ids"]) for p, m in self.made.items()}
        if len(set(seen.values())) > 1:
            raise ValueError("the parts of this index are of different passages: " + ", ".join(f"{p}: {n} ({h:x})" for p, (n, h) in sorted(seen.items())))


def part_base(spark: SparkSession, path: str, strategy: str, part: str, model: str) -> str:
    """Vectors lie in one namespace for each (strategy, model), the other parts in one for each strategy."""
    if part != "vectors":
        return f"{path.rstrip('/')}/{strategy}/{part}"
    name = spark.range(1).select(collection_name(F.lit(part), F.lit(strategy), F.lit(model)).alias("n")).first()["n"]
    return f"{path.rstrip('/')}/{strategy}/{name}"


def build_index(passages: DataFrame, path: str, strategy: str, embedder, state: str | None = None, parts: tuple[str, ...] = PARTS,
                keep: int = 0, cells: int | None = None) -> StoredIndex:
    """E5: builds the ``parts`` that are missing or of another state and opens them.

    ``passages(chunk_id, source_path, text)``, chunk ids unique. ``state`` names the state of the input (for instance
    :func:`files_state` of the table the passages come from); without it the content is hashed, which reads it once.
    """
    spark = passages.sparkSession
    state = state or content_state(passages)
    made, folders = {}, {}

    def keys(folder: str) -> dict:
        k = cut_lineage(passages.select("chunk_id", "source_path", F.xxhash64("text").alias("content_key")), path=f"{folder}/keys")
        return k.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("chunk_id")), F.lit(0)).alias("ids")).first().asDict()

    def postings(folder: str) -> dict:
        bm25_index(passages.select("chunk_id", "text"), folder=folder)
        return bm25_constants(spark, folder)

    def vectors(folder: str) -> dict:
        return embed_cells(passages.select("chunk_id", "text"), embedder, folder, cells)

    for part in parts:
        base = part_base(spark, path, strategy, part, embedder.model)
        own = f"{state}:{embedder.model}:{embedder.dim}:{cells}" if part == "vectors" else state
        made[part] = build_part(spark, base, own, {"keys": keys, "postings": postings, "vectors": vectors}[part], keep)
        folders[part] = f"{base}/{made[part]['name']}"
    out = StoredIndex(spark, folders, made)
    out.check_aligned()
    return out


def open_stored(spark: SparkSession, path: str, strategy: str, model: str, parts: tuple[str, ...] = PARTS) -> StoredIndex:
    """The newest version of each part, whatever the state of its input; ValueError if one was never built."""
    made, folders = {}, {}
    for part in parts:
        base = part_base(spark, path, strategy, part, model)
        found = manifests(spark, base)
        if not found:
            raise ValueError(f"index part {part!r} of {strategy!r} with {model!r} is not built: {base}")
        made[part], folders[part] = found[-1], f"{base}/{found[-1]['name']}"
    out = StoredIndex(spark, folders, made)
    out.check_aligned()
    return out


__all__ = ["PARTS", "StoredIndex", "build_index", "build_part", "content_state", "files_state", "manifests", "model_slug", "open_stored", "part_base"]
