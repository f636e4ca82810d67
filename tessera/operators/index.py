"""E-operators: embedding plug point, normalisation, index identity, term index.

Indexes are plain tables. ``bm25_index`` returns lazy DataFrames; ``write_index``
persists one ``(strategy, model)`` partition idempotently (E5) and
``open_index`` reads it back with partition pruning (E7).
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import let, text_runs, token_hash, tokens

# --------------------------------------------------------------------------- E4


def model_slug(model: Column) -> Column:
    """Last path part, runs of characters outside ``[A-Za-z0-9._-]`` become ``-``,
    ``-`` trimmed at both ends, lower-cased."""
    tail = F.element_at(F.split(model, "/"), -1)
    return F.lower(F.regexp_replace(F.regexp_replace(tail, r"[^a-zA-Z0-9._-]+", "-"), r"^-+|-+$", ""))


def collection_name(base: Column, strategy: Column, model: Column) -> Column:
    """One namespace per (strategy, model)."""
    return F.concat_ws("_", base, strategy, model_slug(model))


# --------------------------------------------------------------------------- E2


def l2_normalize(vec: Column) -> Column:
    """``v / |v|``; a zero vector stays zero."""
    return let(vec, lambda v: let(F.sqrt(F.aggregate(v, F.lit(0.0).cast("double"), lambda a, x: a + x * x)),
                                  lambda n: F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(x * 0.0))))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two equal-length arrays (small, oracle-checked cases only)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"),
                       lambda acc, x: acc + x)


# --------------------------------------------------------------------------- E1 / E3

# Fixed value: the query instruction that the BGE (non-m3) family prepends to
# queries only (E3); passages are embedded as-is.
BGE_QUERY_INSTRUCTION = "Represent this question for searching relevant passages: "


def query_prefix(model: str, side: str) -> str:
    """Prefix for ``side='query'`` of BGE models other than bge-m3."""
    if side not in ("query", "passage"):
        raise ValueError(f"side must be 'query' or 'passage', got {side!r}")
    m = model.lower()
    if side == "query" and "bge" in m and "bge-m3" not in m:
        return BGE_QUERY_INSTRUCTION
    return ""


#: Token hashes that a worker remembers.
HASHES = 200_000


class TokenHashes(dict):
    """The hash of each token that was asked for: the first 8 hex digits of its md5."""

    def __missing__(self, token: str) -> int:
        h = self[token] = int(hashlib.md5(token.encode("utf-8")).hexdigest()[:8], 16)
        return h


#: Rotations and constants of md5, and how many blocks go through its rounds together.
_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0 ** 32).astype(np.uint32)
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_BLOCKS = 16_384


def _md5_heads(blocks: np.ndarray) -> np.ndarray:
    """The first 8 hex digits of the md5 of each row of ``blocks`` (16 little-endian words: a message of one padded block)."""
    out = np.empty(len(blocks), dtype=np.uint32)
    for at in range(0, len(blocks), _BLOCKS):
        words = np.ascontiguousarray(blocks[at:at + _BLOCKS].T)
        used = words.any(axis=1)
        a, b, c, d = (np.full(words.shape[1], x, dtype=np.uint32) for x in _START)
        f = np.empty_like(a)
        for i in range(64):
            if i < 16:
                np.bitwise_xor(c, d, out=f)
                f &= b
                f ^= d
                word = i
            elif i < 32:
                np.bitwise_xor(b, c, out=f)
                f &= d
                f ^= c
                word = (5 * i + 1) % 16
            elif i < 48:
                np.bitwise_xor(b, c, out=f)
                f ^= d
                word = (3 * i + 5) % 16
            else:
                np.invert(d, out=f)
                f |= b
                f ^= c
                word = 7 * i % 16
            a += f
            a += _SINES[i]
            if used[word]:
                a += words[word]
            turn = _TURNS[i // 16][i % 4]
            np.right_shift(a, np.uint32(32 - turn), out=f)
            a <<= np.uint32(turn)
            a |= f
            a += b
            a, b, c, d = d, a, b, c
        out[at:at + _BLOCKS] = a + np.uint32(_START[0])
    return out.byteswap().astype(np.int64)


def token_hashes(tokens: list[str]) -> np.ndarray:
    """The first 8 hex digits of the md5 of each token. Each distinct one is hashed once, all that fit in a block together."""
    import pyarrow as pa

    seen = pa.array(tokens, pa.string()).dictionary_encode()
    data = seen.dictionary.cast(pa.large_binary())
    n = len(data)
    begins = np.frombuffer(data.buffers()[1], dtype=np.int64, count=n + 1)
    sizes, text = np.diff(begins), np.frombuffer(data.buffers()[2] or b"", dtype=np.uint8)
    short = np.flatnonzero(sizes < 56)
    blocks = np.zeros((len(short), 64), dtype=np.uint8)
    row = np.repeat(np.arange(len(short)), sizes[short])
    col = np.arange(len(row)) - np.repeat(np.cumsum(sizes[short]) - sizes[short], sizes[short])
    blocks[row, col] = text[np.repeat(begins[:-1][short], sizes[short]) + col]
    blocks[np.arange(len(short)), sizes[short]] = 0x80
    words = blocks.view("<u4")
    words[:, 14] = 8 * sizes[short]
    out = np.empty(n, dtype=np.int64)
    out[short] = _md5_heads(words)
    for i in np.flatnonzero(sizes >= 56).tolist():
        out[i] = int(hashlib.md5(data[i].as_py()).hexdigest()[:8], 16)
    return out[seen.indices.to_numpy()]


def hashed_vectors(texts: list, dim: int, cache: TokenHashes | None = None) -> np.ndarray:
    """Signed feature hashing of whitespace tokens, a row for each text, L2-normalised.

    Tokens are ``str.split()`` pieces (the same whitespace set as the SQL
    tokenizer); a token's hash is the first 8 hex digits of its md5, which is made
    once for each distinct one of these texts, or looked up in ``cache`` where
    calls are small; one numpy bincount builds the vectors.
    """
    n, pieces = len(texts), [t.split() if t else [] for t in texts]
    sizes = [len(p) for p in pieces]
    if not any(sizes):
        return np.zeros((n, dim))
    tokens = chain.from_iterable(pieces)
    flat = token_hashes(list(tokens)) if cache is None else np.fromiter(map(cache.__getitem__, tokens), dtype=np.int64, count=sum(sizes))
    r = np.repeat(np.arange(n, dtype=np.int64), sizes)
    sign = np.where((flat // dim) % 2 == 0, 1.0, -1.0)
    return unit_rows(np.bincount(r * dim + flat % dim, weights=sign, minlength=n * dim).reshape(n, dim))


def unit_rows(mat: np.ndarray) -> np.ndarray:
    """E2 for a matrix: rows of length 1; a zero row stays zero."""
    norm = np.sqrt((mat * mat).sum(axis=1, keepdims=True))
    return np.divide(mat, norm, out=np.zeros_like(mat), where=norm > 0)


def _hashed_udf(dim: int):
    """:func:`hashed_vectors` in runs of bounded size."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            for texts in text_runs(b.tolist()):
                yield pd.Series(list(hashed_vectors(texts, dim)), dtype=object)

    return embed


@dataclass(frozen=True)
class HashedEmbedder:
    """Default embedding plug point (E1): signed hashed term counts, L2-normalised.

    One small Arrow-batched helper: split, md5 per distinct token, one bincount
    per batch. Deterministic, so an SQL twin exists.
    """

    dim: int = 256
    model: str = "hashed-tf-256"

    def embed(self, df: DataFrame, text_col: str, side: str = "passage", out: str = "vec") -> DataFrame:
        prefix = query_prefix(self.model, side)
        text = F.concat(F.lit(prefix), F.col(text_col)) if prefix else F.col(text_col)
        return df.withColumn(out, _hashed_udf(self.dim)(text))

    def vectors(self):
        """A function ``list[str] -> matrix`` for operators that embed parts of a row; it keeps token hashes between calls."""
        dim, cache = self.dim, TokenHashes()

        def run(texts: list[str]) -> np.ndarray:
            if len(cache) > HASHES:
                cache.clear()
            return hashed_vectors(texts, dim, cache)

        return run


@dataclass(frozen=True)
class BatchModelEmbedder:
    """E1 plug point for a real model: ``load()`` gives a function ``list[str] -> np.ndarray``.

    ``load`` runs in the task, once for each task and never on the driver; what it returns then sees the task's texts in
    runs of at most ``batch_texts`` texts and ``batch_chars`` characters (a longer text goes alone), whatever the size of
    the Arrow batches. ``load`` may keep the model in a module of its own, which makes it one load for each worker.
    ``resources`` is a Spark resource profile for the embedding stage, for instance one task a GPU.
    """

    load: object
    dim: int
    model: str
    batch_texts: int = 64
    batch_chars: int = 200_000
    resources: object = None

    def vectors(self):
        """The loaded model as a function ``list[str] -> matrix`` of unit rows."""
        fn, most, chars = self.load(), self.batch_texts, self.batch_chars

        def run(texts: list[str]) -> np.ndarray:
            out, at, held = [np.zeros((0, self.dim))], 0, 0
            for i, t in enumerate([*texts, None]):
                if i > at and (t is None or i - at >= most or held + len(t) > chars):
                    out.append(np.asarray(fn(texts[at:i]), dtype=np.float64))
                    at, held = i, 0
                held += len(t or "")
            return unit_rows(np.concatenate(out))

        return run

    def embed(self, df: DataFrame, text_col: str, side: str = "passage", out: str = "vec") -> DataFrame:
        """``df`` with the vectors in ``out``. The texts and their vectors pass through Python with the other columns."""
        prefix, vectors, cols = query_prefix(self.model, side), self.vectors, [c for c in df.columns if c != out]

        def run(batches):
            model = vectors()
            for b in batches:
                m = model([prefix + (t or "") for t in b[text_col]])
                b[out] = list(m)
                yield b

        schema = T.StructType([*[df.schema[c] for c in cols], T.StructField(out, T.ArrayType(T.DoubleType()))])
        return df.select(*cols).mapInPandas(run, schema, profile=self.resources)


def get_embedder(provider: str, model: str | None = None, **kw):
    """E1 dispatch by provider name; unknown provider raises."""
    if provider == "hashed":
        dim = kw.get("dim", 256)
        return HashedEmbedder(dim=dim, model=model or f"hashed-tf-{dim}")
    if provider == "batch":
        return BatchModelEmbedder(model=model or "batch", **kw)
    raise ValueError(f"unknown embedding provider: {provider!r}")


# --------------------------------------------------------------------------- E8


@dataclass
class Bm25Index:
    """Okapi BM25 term index.

    postings: (term, chunk_id, tf, dl) -- one row per distinct term of a passage
    terms:    (term, df, idf)
    avgdl:    scalar-subquery column (evaluated once, broadcast as a literal)
    n_docs:   number of passages, likewise
    """

    postings: DataFrame
    terms: DataFrame
    avgdl: Column
    n_docs: Column
    k1: float
    b: float


@F.pandas_udf(T.IntegerType())
def _token_counts(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: len(t.split())).astype("int32")


#: Postings that a worker hands on at once.
POSTINGS = 50_000


def _count_terms(batches: Iterator) -> Iterator:
    """Arrow batches of ``chunk_id, text, dl``, sorted by id and length -> ``term, chunk_id, dl, tf, first``: the distinct terms
    of the texts of one id and length. ``first`` marks the piece that a text begins with; it is empty, with tf 0, where the
    text begins with white space or has no token. Held are the counts of one id and length, and the postings not handed on."""
    import pyarrow as pa

    kinds = []

    def passages() -> Iterator[tuple]:
        key, counts, leads = None, Counter(), set()
        for b in batches:
            kinds[:] = [b.column(0).type]
            for at in range(0, b.num_rows, 512):
                for chunk_id, text, dl in zip(*(c.to_pylist() for c in b.slice(at, 512).columns)):
                    if key != (chunk_id, dl):
                        if key is not None:
                            yield *key, counts, leads
                        key, counts, leads = (chunk_id, dl), Counter(), set()
                    pieces = text.split()
                    counts.update(pieces)
                    leads.add(pieces[0] if pieces and text.startswith(pieces[0]) else "")
        if key is not None:
            yield *key, counts, leads

    def rows() -> pa.RecordBatch:
        at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        return pa.RecordBatch.from_arrays([
            pa.array(terms, pa.string()), pa.array(ids, kinds[0]).take(at), pa.array(dls, pa.int32()).take(at),
            pa.array(tfs, pa.int64()), pa.array(first, pa.bool_())], ["term", "chunk_id", "dl", "tf", "first"])

    ids, dls, sizes, terms, tfs, first = [], [], [], [], [], []
    for chunk_id, dl, counts, leads in passages():
        counts.update(dict.fromkeys(leads, 0))
        ids.append(chunk_id)
        dls.append(dl)
        sizes.append(len(counts))
        terms += counts
        tfs += counts.values()
        first += [t in leads for t in counts]
        if len(terms) >= POSTINGS:
            yield rows()
            ids, dls, sizes, terms, tfs, first = [], [], [], [], [], []
    if ids:
        yield rows()


def bm25_index(passages: DataFrame, id_col: str = "chunk_id", text_col: str = "text",
               k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25, materialize: bool = True,
               folder: str | None = None) -> Bm25Index:
    """Postings, document frequency, document length, average length.

    ``idf = ln(N - df + 0.5) - ln(df + 0.5)``; a negative idf becomes
    ``epsilon * mean(idf over all terms)``. Passages without tokens still count
    in N and in the average length.

    One pass over the text: passages are dealt out by id, each is split once and
    its terms are counted where it lies (:func:`_count_terms`); its first piece is kept as a marker row
    so that N and the average length come from the same table as the
    postings. Rows of one id and one number of tokens are counted together. With ``materialize`` the postings are written once, in buckets of
    the passage id, so that scores add up without a shuffle; the term table is
    written too, and the mean-idf subquery reads it. With ``folder`` both are kept
    there (``postings``, ``terms``) for :func:`open_bm25`.
    """
    from tessera.session import cut_by_key, cut_lineage, key_buckets, ship_package

    ship_package(passages.sparkSession)
    p = passages.select(F.col(id_col).alias("chunk_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # all passages of an id come to one task, those of one length side by side
    spread = (p.withColumn("dl", _token_counts("text")).repartition(key_buckets(passages.sparkSession), "chunk_id")
              .sortWithinPartitions("chunk_id", "dl"))
    grouped = spread.mapInArrow(_count_terms, T.StructType([
        T.StructField("term", T.StringType()), T.StructField("chunk_id", p.schema["chunk_id"].dataType), T.StructField("dl", T.IntegerType()),
        T.StructField("tf", T.LongType()), T.StructField("first", T.BooleanType())]))
    if materialize:
        grouped = cut_by_key(grouped, "chunk_id", "postings", folder and f"{folder}/postings")
    docs = grouped.where("first")
    n_docs = docs.select(F.count(F.lit(1)).cast("double")).scalar()
    avgdl = docs.select(F.avg("dl")).scalar()
    postings = grouped.where(F.col("tf") > 0).select("term", "chunk_id", "dl", "tf")
    df_t = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df_t = df_t.withColumn("raw_idf", F.ln(n_docs - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5))
    if materialize:
        df_t = cut_lineage(df_t, "terms", folder and f"{folder}/terms")
    mean_idf = df_t.select(F.avg("raw_idf")).scalar()
    return Bm25Index(postings=postings, terms=_weighted_terms(df_t, mean_idf, epsilon), avgdl=avgdl, n_docs=n_docs, k1=k1, b=b)


def _weighted_terms(df_t: DataFrame, mean_idf: Column, epsilon: float) -> DataFrame:
    return df_t.select("term", "df", F.when(F.col("raw_idf") < 0, F.lit(epsilon) * mean_idf)
                       .otherwise(F.col("raw_idf")).alias("idf"))


def bm25_constants(spark, folder: str) -> dict:
    """What a stored term index says about its corpus: passages, a hash of their ids, average length and mean idf, and
    in how many buckets it lies. Reads ids and lengths of the marker rows and the term table."""
    from tessera.session import key_buckets

    row = spark.read.parquet(f"{folder}/postings").where("first").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("chunk_id")), F.lit(0)).alias("ids"), F.avg("dl").alias("avgdl")).first()
    mean = spark.read.parquet(f"{folder}/terms").agg(F.avg("raw_idf").alias("m")).first()["m"]
    return {"n": row["n"], "ids": row["ids"], "avgdl": row["avgdl"], "mean_idf": mean, "buckets": key_buckets(spark)}


def open_bm25(spark, folder: str, constants: dict, k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25) -> Bm25Index:
    """The term index that ``bm25_index(..., folder=folder)`` stored; nothing is read before it is asked."""
    from tessera.session import open_by_key

    grouped = open_by_key(spark, f"{folder}/postings", "chunk_id", constants["buckets"])
    literal = lambda x: F.lit(x).cast("double")
    terms = _weighted_terms(spark.read.parquet(f"{folder}/terms"), literal(constants["mean_idf"]), epsilon)
    return Bm25Index(postings=grouped.where(F.col("tf") > 0).select("term", "chunk_id", "dl", "tf"), terms=terms,
                     avgdl=literal(constants["avgdl"]), n_docs=literal(constants["n"]), k1=k1, b=b)


def bm25_term_weight(idx: Bm25Index) -> Column:
    """Per-posting BM25 saturation ``tf (k1+1) / (tf + k1 (1 - b + b dl/avgdl))``."""
    tf, dl = F.col("tf"), F.col("dl")
    return tf * (idx.k1 + 1) / (tf + idx.k1 * (1 - idx.b + idx.b * dl / idx.avgdl))


# --------------------------------------------------------------------------- E5-E7


def content_fingerprint(df: DataFrame, cols: list[str]) -> DataFrame:
    """Order-independent fingerprint of a table: row count and xor of row hashes."""
    return df.select(F.count(F.lit(1)).alias("n"),
                     F.coalesce(F.bit_xor(F.xxhash64(*[F.col(c) for c in cols])), F.lit(0)).alias("h"))


def write_index(chunks: DataFrame, path: str, strategy: str, model: str, reset: bool = False,
                strong_check: bool = True) -> int:
    """E5: idempotent build of one ``strategy=/model=`` partition.

    Skips the write when the stored partition already has the same row count
    and (unless ``strong_check`` is off) the same content fingerprint and no reset was
    asked for; otherwise overwrites only that partition (dynamic overwrite).
    Returns the final row count.
    """
    spark = chunks.sparkSession
    slug = spark.range(1).select(model_slug(F.lit(model)).alias("s")).first()["s"]
    data_cols = [c for c in chunks.columns if c not in ("strategy", "model")]
    want = content_fingerprint(chunks, data_cols).first()
    if not reset:
        try:
            stored = spark.read.parquet(path).where(
                (F.col("strategy") == strategy) & (F.col("model") == slug))
            have = content_fingerprint(stored, data_cols).first()
            same = have["n"] == want["n"] and (not strong_check or have["h"] == want["h"])
            if have["n"] > 0 and same:
                return int(have["n"])
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # no stored index yet
                raise
    (chunks.withColumn("strategy", F.lit(strategy)).withColumn("model", F.lit(slug))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("strategy", "model").parquet(path))
    return int(want["n"])


def open_index(spark, path: str, strategy: str, model: str) -> DataFrame:
    """Partition-pruned read of one combination; missing or empty raises ValueError."""
    slug = spark.range(1).select(model_slug(F.lit(model)).alias("s")).first()["s"]
    try:
        df = spark.read.parquet(path).where((F.col("strategy") == strategy) & (F.col("model") == slug))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"index not found: {path}") from e
    if df.limit(1).count() == 0:
        raise ValueError(f"index {strategy}/{slug} is empty or missing; build it first")
    return df


def index_summary(index: DataFrame) -> DataFrame:
    """Rows per (strategy, model)."""
    return index.groupBy("strategy", "model").agg(F.count(F.lit(1)).alias("n_chunks"))


__all__ = [
    "model_slug", "collection_name", "l2_normalize", "dot", "query_prefix", "HashedEmbedder",
    "BatchModelEmbedder", "get_embedder", "Bm25Index", "bm25_index", "bm25_term_weight",
    "bm25_constants", "open_bm25", "content_fingerprint", "write_index", "open_index", "index_summary",
]
