"""Toxicity by maximum-scoring segments.

Each word scores its log-odds between toxic and clean training documents under an informative Dirichlet
prior, be they positive or negative; words without evidence cost a small drift. A linear scan finds all maximal
segments of a text. Extreme-value statistics (lambda and K of the clean documents' word scores) say which of them are
significant, and turn all of them into one evidence for the text, the negative log of the chance that clean words
of that length do as well, which is calibrated on training documents that the word scores in question were not
fitted on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import column, text_slices
from tessera.session import cut_lineage, ship_package

_WORD = re.compile(r"\w+")
#: Distinct words a training task counts before it hands its counts on.
COUNTED = 100_000
BINS, TOP = 400, 80.0
#: A segment is significant if a clean text of the same length has fewer than so many of its score on average.
LEVEL = 0.05


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def maximal_segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments, (first, last, score), of a sequence whose items score ``-drift`` but for
    those given as (position, score) in order. One pass: Ruzzo and Tompa."""
    open_: list[tuple[float, float, int, int]] = []  # sum before, sum after, first, last
    total, at = 0.0, 0
    for position, s in scores:
        total -= drift * (position - at)
        left, right, first, last = total, total + s, position, position
        total, at = right, position + 1
        if s <= 0:
            continue
        while open_:
            j = len(open_) - 1
            while j >= 0 and open_[j][0] >= left:
                j -= 1
            if j < 0 or open_[j][1] >= right:
                break
            left, first = open_[j][0], open_[j][2]
            del open_[j:]
        open_.append((left, right, first, last))
    return [(first, last, right - left) for left, right, first, last in open_]


@dataclass
class WordScores:
    scores: dict[str, float]
    drift: float
    lam: float
    k: float

    def __post_init__(self) -> None:
        self.positive = {w for w, s in self.scores.items() if s > 0}

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and the segments as (first word, last word, score)."""
        ws = words(text)
        known = self.scores
        if self.positive.isdisjoint(ws):
            return len(ws), []
        return len(ws), maximal_segments([(i, known[w]) for i, w in enumerate(ws) if w in known], self.drift)

    def expected(self, n: int, s: float) -> float:
        """How many segments of score ``s`` or more ``n`` clean words have on average."""
        return self.k * n * math.exp(-self.lam * s)

    def evidence(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        """-ln of the chance of the r best segments under clean words, for the r that says most (Poisson sum
        statistics: e^-T T^(r-1) / r! (r-1)! with T the normalised sum of scores)."""
        best, t = 0.0, 0.0
        per = math.log(max(self.k * n, 1e-9))
        for r, s in enumerate(sorted((s for _, _, s in segments), reverse=True), 1):
            t += self.lam * s - per
            if t <= 0:
                break
            if r == 1:
                best = max(best, -math.log(max(-math.expm1(-math.exp(min(-t, 50))), 1e-300)))
            else:
                best = max(best, t - (r - 1) * math.log(t) + math.lgamma(r + 1) + math.lgamma(r))
        return min(best, TOP)


@dataclass
class Model:
    words: WordScores
    slope: float
    bias: float

    def score(self, text: str, level: float = LEVEL) -> tuple[float, list[tuple[int, int, float]]]:
        """The calibrated chance that a text is toxic, and its significant segments: those of a score that fewer than
        ``level`` segments of a clean text of this length reach."""
        n, segments = self.words.segments(text)
        x = self.slope * self.words.evidence(n, segments) + self.bias
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, x)))), [g for g in segments if self.words.expected(n, g[2]) < level]


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int, id_col: str, text_col: str,
                  label_id: str, label_col: str) -> DataFrame:
    """``text, toxic, fold``: at most ``max_rows`` labelled documents, chosen by a hash of their id."""
    l = labels.where(usable & F.col(label_id).isNotNull() & F.col(label_col).isNotNull()).groupBy(  # noqa: E741
        F.col(label_id).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    l = l.orderBy(F.xxhash64("id", F.lit("toxic")), "id").limit(max_rows)  # noqa: E741
    d = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text")).where("text is not null")
    # of several texts of an id, the one with the least digest
    t = d.join(F.broadcast(l), "id").groupBy("id", "toxic").agg(F.min_by("text", F.sha2("text", 256)).alias("text"))
    return cut_lineage(t.select("text", "toxic", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(2)).cast("int").alias("fold")), "toxic-train")


def count_words(train: DataFrame) -> DataFrame:
    """``word, t0, c0, t1, c1``: in how many toxic and clean documents of each fold a word occurs (a word
    that a document repeats says no more about it)."""
    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, list[int]] = {}

        def rows() -> pd.DataFrame:
            return pd.DataFrame([(w, *c) for w, c in seen.items()], columns=["word", "t0", "c0", "t1", "c1"])

        for b in batches:
            for text, toxic, fold in zip(b["text"], b["toxic"], b["fold"]):
                k = 2 * int(fold) + (0 if toxic else 1)
                for w in set(words(text)):
                    seen.setdefault(w, [0, 0, 0, 0])[k] += 1
            if len(seen) > COUNTED:
                yield rows()
                seen.clear()
        yield rows()

    got = train.mapInPandas(count, "word string, t0 long, c0 long, t1 long, c1 long")
    return got.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("t0", "c0", "t1", "c1")])


def log_odds(toxic: np.ndarray, clean: np.ndarray, n1: int, n0: int, prior: float, least_z: float) -> np.ndarray:
    """Log-odds of each word under a Dirichlet prior of ``prior`` documents shaped like both classes together, of
    at least half a document a word, so that the odds of a rare word do not grow with the sample. Words whose z is
    below ``least_z`` either way have no evidence and score 0. The z is the root of the deviance of the word's own counts
    from the classes' shares, with continuity correction; the prior has no part in it, so a rare word needs as many
    documents in a large sample as in a small one."""
    share = (toxic + clean) / max(1, n1 + n0)
    a = np.maximum(prior * share, 0.5)
    rest = prior - np.minimum(a, prior) + 1e-9
    delta = np.log((toxic + a) / (n1 - toxic + rest)) - np.log((clean + a) / (n0 - clean + rest))
    want1, want0 = ((toxic + clean) * n / max(1, n1 + n0) for n in (n1, n0))
    more = toxic > want1
    x, y = np.where(more, toxic - 0.5, toxic + 0.5), np.where(more, clean + 0.5, clean - 0.5)
    beyond = np.where(more, x > want1, x < want1) & (x > 0) & (y > 0) & (want1 > 0) & (want0 > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        z = np.sqrt(np.maximum(2 * (x * np.log(x / want1) + y * np.log(y / want0)), 0.0))
    good = beyond & (z >= least_z) & ((delta > 0) == more)
    return np.where(good, np.round(delta, 9), 0.0)


def word_scores(counts: DataFrame, sizes: list[tuple[int, int]], prior: float, least_z: float) -> list[dict[str, float]]:
    """The scores of fold 0 (from the counts of fold 1), of fold 1 (from those of fold 0) and of all, from
    ``counts(word, t0, c0, t1, c1)``. Only words with evidence in one of them reach the driver."""
    def odds(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            t0, c0, t1, c1 = (b[c].to_numpy(float) for c in ("t0", "c0", "t1", "c1"))
            got = [log_odds(t, c, *n, prior, least_z) for t, c, n in zip((t1, t0, t0 + t1), (c1, c0, c0 + c1), sizes)]
            out = pd.DataFrame({"word": b["word"], "s0": got[0], "s1": got[1], "s2": got[2]})
            yield out[(out[["s0", "s1", "s2"]] != 0).any(axis=1)]

    # fewer documents than this cannot be evidence, even if all are of one class
    table = counts.where("t0 + c0 + t1 + c1 >= 2").mapInPandas(odds, "word string, s0 double, s1 double, s2 double").toPandas()
    return [{w: s for w, s in zip(table["word"], table[c]) if s} for c in ("s0", "s1", "s2")]


def statistics(train: DataFrame, scores: list[dict[str, float]], drift: float) -> list[tuple[float, float, float]]:
    """(drift, lambda, K) of each set of word scores over the clean training documents of the fold it is for
    (set 2 is for both)."""
    spark = train.sparkSession
    shared = spark.sparkContext.broadcast(scores)

    def tally(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in text_slices(batches):
            rows = []
            for text, fold in zip(b["text"], b["fold"]):
                ws = words(text)
                for k in (int(fold), 2):
                    rows.append((k, 0.0, len(ws)))
                    s = shared.value[k]
                    rows += [(k, round(s[w], 2) or 0.01, 1) for w in ws if w in s]
            yield pd.DataFrame(rows, columns=["k", "s", "n"]).groupby(["k", "s"], as_index=False).sum()

    got = train.where("toxic = 0").mapInPandas(tally, "k int, s double, n long").groupBy("k", "s").agg(F.sum("n").alias("n")).collect()
    out = []
    for k in range(len(scores)):
        total = sum(r["n"] for r in got if r["k"] == k and r["s"] == 0) or 1
        p = {r["s"]: r["n"] / total for r in got if r["k"] == k and r["s"] != 0}
        mean = sum(s * q for s, q in p.items())
        own = max(drift, 3 * mean)  # the mean score must be negative
        rest = max(1 - sum(p.values()), 1e-9)
        lo, hi = 1e-3, 5.0
        for _ in range(80):  # the positive root of E[e^(lambda s)] = 1
            lam = (lo + hi) / 2
            value = sum(q * math.exp(lam * s) for s, q in p.items()) + rest * math.exp(-lam * own)
            lo, hi = (lo, lam) if value > 1 else (lam, hi)
        # K n e^(-lambda s) segments of score s or more are expected in n words; K from the scores seen
        starts = sum(q for s, q in p.items() if s > 0)
        tail = sum(q * math.exp(-lam * s) for s, q in p.items() if s > 0) / starts if starts else 1.0
        out.append((own, lam, max(starts / tail, 1e-6)))
    return out


def calibrate(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Slope and bias of the logistic curve through counts of toxic and clean rows at each evidence."""
    a, b = 1.0, -2.0
    n = toxic + clean
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -60, 60)))
        w = n * p * (1 - p) + 1e-12
        g = np.array([((toxic - n * p) * x).sum() - 1e-3 * (a - 1), (toxic - n * p).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(a, 1e-3), b


def fit(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int = 40_000, prior: float = 200.0, drift: float = 0.05,
        least_z: float = 2.5, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
        label_col: str = "toxic") -> Model:
    """Learns from at most ``max_rows`` labelled documents where ``usable`` holds on the label's row.

    Without labels of both kinds nothing can be learned; every text then scores the share of toxic rows (or 0). The
    words that the model holds are those with evidence in these rows, so their number follows ``max_rows``, not the corpus.
    """
    ship_package(docs.sparkSession)
    train = training_rows(docs, labels, usable, max_rows, id_col, text_col, label_id, label_col)
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in train.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = {(f, t): sum(v for (fold, toxic), v in sizes.items() if fold == f and (toxic > 0) == t) for f in (0, 1) for t in (True, False)}
    n1, n0 = n[0, True] + n[1, True], n[0, False] + n[1, False]
    if not n1 or not n0:
        share = n1 / (n1 + n0) if n1 + n0 else 0.0
        return Model(WordScores({}, drift, 1.0, 1.0), 0.0, 60.0 if share else -60.0)
    # scores for fold 0 are fitted on fold 1 and the other way round; the last ones on all
    sets = word_scores(count_words(train), [(n[1, True], n[1, False]), (n[0, True], n[0, False]), (n1, n0)], prior, least_z)
    scorers = [WordScores(s, *st) for s, st in zip(sets, statistics(train, sets, drift))]
    shared = docs.sparkSession.sparkContext.broadcast(scorers)

    def tally(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in text_slices(batches):
            x = [shared.value[f].evidence(*shared.value[f].segments(t)) for t, f in zip(b["text"], b["fold"])]
            bins = pd.DataFrame({"bin": np.minimum((np.array(x, dtype=float) * BINS / TOP).astype(int), BINS - 1), "toxic": (b["toxic"] > 0).astype(int), "n": 1})
            yield bins.groupby(["bin", "toxic"], as_index=False).sum()

    got = train.mapInPandas(tally, "bin int, toxic int, n long").groupBy("bin", "toxic").agg(F.sum("n").alias("n")).collect()
    y = np.zeros((2, BINS))
    for r in got:
        y[r["toxic"], r["bin"]] += r["n"]
    return Model(scorers[2], *calibrate(np.arange(BINS) * TOP / BINS, y[1], y[0]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, passages`` of every whole text; passages are (first word, last word, score) of the
    significant segments (see ``LEVEL``). A null or empty text has no words and scores the base rate."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in text_slices(batches):
            got = [m.score(t or "") for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["id"], "score": [g[0] for g in got],
                                "passages": [[{"first": f, "last": l, "score": s} for f, l, s in g[1]] for g in got]})

    d = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    got = d.mapInPandas(run, "doc_id string, score double, passages array<struct<first:int,last:int,score:double>>")
    return got.select(F.col("doc_id").cast("long").alias("doc_id"), "score", "passages")


def clean_documents(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t or "")[0] for t in texts], dtype=float)

    return docs.where(toxic(F.col(text_col).cast("string")) < threshold)
