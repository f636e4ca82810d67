"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

The model is fitted on a bounded sample of labelled rows (``per_language`` and ``max_sample`` rows) with
follow-the-regularised-leader and an elastic net; a fifth of the sample sets the temperature. Document
frequencies are counted over all rows that may be learned from. Term
frequencies are shares of a text's n-grams, so a text's logits are the mean of one table row for each of
its n-grams, and whole texts of any length are scored in one pass without a sparse matrix.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_slices
from tessera.session import ship_package

BITS = 16
SIZES = (1, 2, 3)
#: Characters whose n-grams are looked up at once.
SLAB = 1 << 18
#: Term frequencies are small; this brings inputs near 1.
SCALE = 10.0
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """For each code point, itself where it is a letter, else a space."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    points = np.fromiter((c for c in range(0x110000) if chr(c).isalpha()), dtype=np.int64)
    table[points] = points
    return table


def _ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of all n-grams within words, in pieces; a word's ends count as a space.
    Each piece covers a range of texts' characters in order, so text numbers never fall."""
    lower = [t.lower() for t in texts]
    codes = np.frombuffer(("\0" + "\0".join(lower) + "\0").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(len(lower) + 1), [1, *(len(t) + 1 for t in lower)])  # a separator goes with the text before
    codes = _letters()[codes]
    keep = (codes != 32) | (np.r_[np.uint32(0), codes[:-1]] != 32)
    codes, owner = codes[keep].astype(np.uint64), owner[keep] - 1
    mask, shift = np.uint64(0xFFFFFFFF), np.uint64(32 - BITS)
    spread = lambda x, n: ((((x * np.uint64(0x9E3779B1 + 2 * n)) & mask) ^ (x >> np.uint64(15))) * np.uint64(0x85EBCA6B) & mask) >> shift
    for at in range(0, len(codes), SLAB):
        c, o = codes[max(0, at - 1):at + SLAB + 1], owner[max(0, at - 1):at + SLAB + 1]
        lead = min(at, 1)
        mid = np.arange(lead, min(lead + SLAB, len(c)))
        mid = mid[c[mid] != 32]
        mid = mid[mid + 1 < len(c)]  # a letter always has a neighbour on each side
        before, own, after = c[mid - 1], c[mid], c[mid + 1]
        pair = (own << np.uint64(21)) | after
        parts = [spread(own, 1), spread(pair, 2), spread(((before << np.uint64(11)) ^ pair) + before * np.uint64(7919), 3)]
        first = before == 32  # the pair of a word's start and its first letter
        rows = np.concatenate([o[mid]] * len(SIZES) + [o[mid][first]])
        buckets = np.concatenate([*parts, spread((np.uint64(32) << np.uint64(21)) | own[first], 2)]).astype(np.int64)
        yield rows, buckets


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (buckets, languages): idf times weight
    bias: np.ndarray
    temperature: float

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logits and number of n-grams of each text."""
        k = len(self.languages)
        sums, counts = np.zeros((len(texts), k)), np.zeros(len(texts), dtype=np.int64)
        for rows, buckets in _ngrams(texts):
            counts += np.bincount(rows, minlength=len(texts))
            for j in range(k):
                sums[:, j] += np.bincount(rows, weights=self.table[j][buckets], minlength=len(texts))
        return SCALE * sums / np.maximum(counts, 1)[:, None] + self.bias, counts


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, k: int, alpha: float = 0.5, beta: float = 1.0,
             l1: float = 0.02, l2: float = 0.1, epochs: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (buckets + bias, k) of sparse ``(bucket, value)`` rows, one update for each row in turn."""
    z = np.zeros((2 ** BITS + 1, k))
    n = np.zeros_like(z)

    def weights(zs: np.ndarray, ns: np.ndarray, shrink: float) -> np.ndarray:
        return np.where(np.abs(zs) <= shrink, 0.0, -(zs - np.sign(zs) * shrink) / ((beta + np.sqrt(ns)) / alpha + l2))

    for _ in range(epochs):
        for (idx, val), y in zip(rows, labels):
            i, v = np.append(idx, 2 ** BITS), np.append(val, 1.0)
            w = weights(z[i], n[i], l1)
            p = _softmax(v @ w)
            p[y] -= 1.0
            g = v[:, None] * p
            old = n[i]
            new = old + g * g
            z[i] += g - (np.sqrt(new) - np.sqrt(old)) / alpha * w
            n[i] = new
    w = weights(z, n, l1)
    return w[:-1], w[-1]


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of ``texts(text)`` each bucket's n-grams occur, and how many texts have any. Each task adds its texts up
    in one array; Spark adds the tasks' arrays, and a number for each bucket reaches the driver."""
    ship_package(texts.sparkSession)

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(2 ** BITS + 1, dtype=np.int64)  # the last place counts texts
        for b in text_slices(batches):
            seen, last = np.zeros(2 ** BITS, dtype=bool), -1
            for rows, buckets in _ngrams(list(b["text"])):
                # text numbers never fall from piece to piece, so a text's marks are complete when a greater one comes
                for r, part in zip(np.unique(rows).tolist(), _by_row(rows, buckets)):
                    if r != last:
                        held[:-1] += seen
                        seen[:] = False
                        held[-1] += 1
                        last = r
                    seen[part] = True
            held[:-1] += seen
        at = np.flatnonzero(held)
        yield pd.DataFrame({"bucket": at, "n": held[at]})

    got = texts.where("text is not null").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(2 ** BITS + 1)
    df[got["bucket"].to_numpy(np.int64)] = got["n"].to_numpy(float)
    return df[:-1], int(df[-1])


def idf_of(df: np.ndarray, texts: int) -> np.ndarray:
    return np.log((1 + texts) / (1 + df)) + 1


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of a grid from 0.05 to 20 under which the labels ``y`` are likeliest."""
    tries = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.mean(np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12))) for t in tries]
    return float(tries[int(np.argmin(loss))])


def fit(sample: DataFrame, alpha: float = 0.5, frequencies: tuple[np.ndarray, int] | None = None) -> Model | None:
    """``sample(text, lang)``, bounded, in a fixed order by ``nth`` -> the model; None if it has no letters.
    ``frequencies`` come from :func:`document_frequencies`; without them those of the sample are taken."""
    ship_package(sample.sparkSession)

    def features(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in text_slices(batches):
            got: dict[int, list[np.ndarray]] = {}
            for rows, buckets in _ngrams(list(b["text"])):
                for r, part in zip(np.unique(rows), _by_row(rows, buckets)):
                    got.setdefault(int(r), []).append(part)
            out = []
            for r, parts in got.items():
                idx, cnt = np.unique(np.concatenate(parts), return_counts=True)
                out.append((int(b["nth"].iloc[r]), b["lang"].iloc[r], idx.astype("<i4").tobytes(), cnt.astype("<i4").tobytes()))
            yield pd.DataFrame(out, columns=["nth", "lang", "idx", "cnt"])

    got = sorted(sample.mapInPandas(features, "nth long, lang string, idx binary, cnt binary").collect())
    if not got:
        return None
    languages = sorted({r["lang"] for r in got})
    y = np.array([languages.index(r["lang"]) for r in got])
    sparse = [(np.frombuffer(r["idx"], "<i4").astype(np.int64), np.frombuffer(r["cnt"], "<i4").astype(float)) for r in got]
    if frequencies is None:
        df = np.zeros(2 ** BITS)
        for idx, _ in sparse:
            df[idx] += 1
        frequencies = df, len(sparse)
    idf = idf_of(*frequencies)
    rows = [(idx, SCALE * cnt / cnt.sum() * idf[idx]) for idx, cnt in sparse]
    held = np.arange(len(rows)) % 5 == 4
    train = [r for r, h in zip(rows, held) if not h]
    w, bias = fit_ftrl(train, y[~held], len(languages), alpha)
    check = [r for r, h in zip(rows, held) if h]
    temperature = 1.0
    if check:
        logits = np.array([v @ w[i] + bias for i, v in check])
        temperature = best_temperature(logits, y[held])
    return Model(languages, np.ascontiguousarray((w * idf[:, None]).T), bias, temperature)


def _by_row(rows: np.ndarray, buckets: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(rows, kind="stable")
    return np.split(buckets[order], np.flatnonzero(np.diff(rows[order])) + 1)


def training_sample(docs: DataFrame, usable: Column, per_language: int = 600, max_sample: int = 6000,
                    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``nth, text, lang``: at most ``per_language`` rows of each language and ``max_sample`` in all, by a hash
    of the id; languages take turns, so a rare one is not crowded out. Only ids and labels are ranked."""
    ids = docs.where(usable & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.min(lang_col).alias("lang"))
    order = [F.xxhash64("id", F.lit("langid")), F.col("id")]
    # of a language with many rows only those with a small hash are ranked: four times as many as are taken
    n = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.pmod(F.xxhash64("id", F.lit("langid-share")), F.lit(1 << 30)) / float(1 << 30)
    ids = ids.join(F.broadcast(n), "lang").where((F.col("n") <= 8 * per_language) | (share < 4.0 * per_language / F.col("n"))).drop("n")
    own = ids.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("r") <= per_language)
    top = own.orderBy("r", *order).limit(max_sample)
    nth = top.withColumn("nth", F.row_number().over(Window.orderBy("r", *order)).cast("long")).drop("r")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("own")).where("text is not null")
    found = texts.join(F.broadcast(nth), "id").where(F.col("own") == F.col("lang"))  # at most max_sample ids
    return found.groupBy("nth").agg(F.min("lang").alias("lang"), F.min("text").alias("text"))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score``: the likeliest learned language of every whole text and its calibrated
    probability; ``und`` with 0 where the text is null or has no letter, or nothing could be learned."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # buckets times languages

    def score(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in text_slices(batches):
            out = pd.DataFrame({"doc_id": b["id"], "lang_pred": UNKNOWN, "score": 0.0})
            if m is not None and len(b):
                logits, counts = m.logits([t or "" for t in b["text"]])
                p = _softmax(logits / m.temperature)
                best = p.argmax(axis=1)
                known = counts > 0
                out["lang_pred"] = np.where(known, np.array(m.languages, dtype=object)[best], UNKNOWN)
                out["score"] = np.where(known, p[np.arange(len(b)), best], 0.0)
            yield out

    d = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    got = d.mapInPandas(score, "doc_id string, lang_pred string, score double")
    return got.select(F.col("doc_id").cast("long").alias("doc_id"), "lang_pred", "score")


def identify(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_language: int = 600, max_sample: int = 6000) -> DataFrame:
    """Fits on the rows where ``usable`` and predicts for all: ``doc_id, lang_pred, score``.

    Repeated ids are one row of the sample and are predicted each; an empty table gives none.
    """
    learnable = docs.where(usable & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"))
    model = fit(training_sample(docs, usable, per_language, max_sample, id_col, text_col, lang_col), frequencies=document_frequencies(learnable))
    return predict(docs, model, id_col, text_col)
