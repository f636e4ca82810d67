"""Best-fit packing by patterns.

Documents are tokenised, cut into pieces of at most one sequence, and counted by length. Over the
histogram (one entry for each length, whatever the input's size) the driver plans: few-document
patterns that fill a sequence, their repeat counts by non-negative least squares, rounded; what is left
is packed best-fit decreasing, first into the small gaps of the patterns. The plan says for each length
which sequence and offset its first, second, ... piece gets, so the pieces only have to be numbered
within their length, which takes one total for each (task, length).
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_slices
from tessera.session import cut_lineage, ship_package

#: Lengths are rounded up to this many classes in the patterns.
CLASSES = 128
#: Encoded words and units a worker remembers, twice this at most.
REMEMBERED = 700_000
#: Characters that lower-casing and composition treat alike everywhere, and the tokenizer's units among them.
_PLAIN = re.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
_UNITS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+|[0-9]|[^a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f0-9]+")
_RARE_SPACE = re.compile("[\x1c-\x1f]")
#: The letter by which the tokenizer's model knows a byte: printable ones stand for themselves, others follow U+0100 in order.
_PRINTED = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
_BYTE_LETTERS = {b: 0x100 + i for i, b in enumerate(b for b in range(0x100) if b not in _PRINTED)}
_TOKENIZERS: dict = {}


class Words(dict):
    """Ids of words as bytes, each worked out by ``encode`` when it is first looked up. About ``most`` to ``2 * most`` of
    those met last are remembered: ``turn`` gives the words for the next texts, which still finds those of the one before."""

    def __init__(self, encode: Callable[[Words, str], bytes], most: int, older: dict | None = None):
        self.encode, self.most, self.older = encode, most, older or {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(self, word)
        self[word] = ids
        return ids

    def turn(self) -> Words:
        if len(self) <= self.most:
            return self
        self.older = {}
        return Words(self.encode, self.most, self)

    def rest(self, most: int) -> Words:
        """Those to begin the next task with: no more than ``most``, the first met, as frequent words are met early."""
        kept = Words(self.encode, self.most)
        kept.update(islice(chain(self.items(), self.older.items()), most))
        return kept


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, word by word.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its words. A word
    of plain Latin letters, digits and signs is cut further into the units that the tokenizer's pattern
    names, which are far fewer. A unit is what the tokenizer hands its model, byte by byte as letters, so it goes
    straight there; other words go to the tokenizer as they are. Python also splits at four
    control characters that the tokenizer keeps; a text that holds one is encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.id_bytes = [i.to_bytes(4, "little") for i in range(1 + max(self.tokenizer.get_vocab().values()))]
        self.words = Words(self._word, REMEMBERED)  # and units, which as words are themselves

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _unit(self, unit: str) -> bytes:
        if not unit.isascii():
            unit = unit.encode().decode("latin-1").translate(_BYTE_LETTERS)
        of = self.id_bytes
        return b"".join([of[t.id] for t in self.model.tokenize(unit)])

    def _word(self, words: Words, word: str) -> bytes:
        # a word of small ASCII letters is one unit, as most are; only the others are looked at more closely
        if word.isascii() and word.isalpha() and word.islower():
            return self._unit(word)
        if not _PLAIN.fullmatch(word) or "<|" in word:
            return self._encode(word)
        units = _UNITS.findall(word.lower())
        return self._unit(word) if units == [word] else b"".join(map(words.__getitem__, units))

    def texts(self, texts: list[str]) -> Iterator[bytes]:
        self.words = self.words.turn()
        word = self.words.__getitem__
        for t in texts:
            yield self._encode(t) if _RARE_SPACE.search(t) else b"".join(map(word, t.split()))

    def rest(self) -> None:
        """Called at the end of a task."""
        self.words = self.words.rest(REMEMBERED // 2)


def word_encoder(path: str) -> WordEncoder:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordEncoder(path)
    return _TOKENIZERS[path]


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, _p, _i``: the pieces of each document's ids and its end
    id. ``_i`` numbers the pieces of one length within the task ``_p``; the table is stored."""
    ship_package(docs.sparkSession)
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, task = word_encoder(tokenizer_path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for b in text_slices(batches):
            rows = []
            for doc, ids in zip(b["id"], encode.texts([t or "" for t in b["text"]])):
                ids += end
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    n = min(capacity, total - start)
                    rows.append((doc, piece, start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), task, seen[n]))
                    seen[n] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "_p", "_i"])
        encode.rest()

    # ids travel as text, for which null is an ordinary value in pandas
    d = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    p = d.mapInPandas(cut, "doc_id string, piece int, start long, length int, ids_crc32 long, _p int, _i long")
    return cut_lineage(p, "pieces")


@dataclass
class Plan:
    """For length ``length[j]``, its pieces ``first[j]``, ``first[j]+1``, ... up to the next entry go to sequences
    ``sequence[j]``, ``sequence[j]+1``, ... at ``offset[j]``. Sorted by (length, first)."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def few_document_patterns(classes: int) -> list[tuple[int, ...]]:
    """All ways to fill ``classes`` with one, two or three class sizes."""
    two = [(a, classes - a) for a in range(classes - 1, (classes - 1) // 2, -1) if classes - a <= a]
    three = [(a, b, classes - a - b) for a in range(classes - 2, 0, -1) for b in range(min(a, classes - a - 1), 0, -1)
             if classes - a - b <= b]
    return [(classes,), *two, *three]


def nonnegative_least_squares(a: np.ndarray, h: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 that brings ``a @ x`` close to ``h``: the active-set method of Lawson and Hanson."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    for _ in range(rounds):
        gain = a.T @ (h - a @ x)
        gain[free] = -np.inf
        j = int(np.argmax(gain))
        if gain[j] <= 1e-7 * max(1.0, float(np.abs(h).max())):
            break
        free[j] = True
        for _ in range(rounds):
            s = np.zeros_like(x)
            s[free] = np.linalg.lstsq(a[:, free], h, rcond=None)[0]
            low = free & (s <= 1e-12)
            if not low.any():
                x = s
                break
            step = np.min(x[low] / np.maximum(x[low] - s[low], 1e-300))
            x = x + step * (s - x)
            free &= x > 1e-12
            x[~free] = 0
    return x


def plan_packing(histogram: np.ndarray, capacity: int, classes: int = CLASSES) -> Plan:
    """``histogram[n]`` pieces of length n (1 to ``capacity``) -> where the i-th piece of each length goes."""
    left = histogram.astype(np.int64).copy()
    used = np.zeros_like(left)
    entries: list[tuple[int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free places -> runs of sequences (first, count)
    opened = 0

    def place(n: int, count: int, sequence: int, offset: int) -> None:
        entries.append((n, int(used[n]), sequence, offset))
        used[n] += count
        left[n] -= count

    def gap(size: int, first: int, count: int) -> None:
        if size and count:
            gaps.setdefault(size, []).append((first, count))

    step = -(-capacity // classes)
    of = lambda n: -(-n // step)
    full = -(-capacity // step)
    by_class = np.zeros(full + 1)
    for n in range(1, capacity + 1):
        by_class[of(n)] += left[n]
    patterns = few_document_patterns(full)
    if by_class.any():
        a = np.zeros((full, len(patterns)))
        for j, p in enumerate(patterns):
            for c in p:
                a[c - 1, j] += 1
        repeats = np.floor(nonnegative_least_squares(a, by_class[1:]) + 0.5).astype(np.int64)
        rows = {c: [n for n in range(min(c * step, capacity), (c - 1) * step, -1)] for c in range(1, full + 1)}
        for j in np.argsort(-repeats, kind="stable"):
            todo = int(repeats[j])
            while todo > 0:
                want: dict[int, int] = {}
                lengths = []
                for i, c in enumerate(patterns[j]):  # the longest left in each class; the last one fits best
                    last = i > 0 and i == len(patterns[j]) - 1
                    fit = range(min(capacity - sum(lengths), (c + 1) * step), (c - 1) * step, -1) if last else rows[c]
                    n = next((n for n in fit if left[n] > want.get(n, 0)), None)
                    if n is None:
                        break
                    want[n] = want.get(n, 0) + 1
                    lengths.append(n)
                if len(lengths) < len(patterns[j]) or sum(lengths) > capacity:
                    break
                times = min(todo, *(int(left[n]) // k for n, k in want.items()))
                offset = 0
                for n in lengths:
                    place(n, times, opened, offset)
                    offset += n
                gap(capacity - offset, opened, times)
                opened, todo = opened + times, todo - times
    for n in range(capacity, 0, -1):  # residuals, longest first, each into the smallest gap that holds it
        while left[n] > 0:
            size = next((s for s in range(n, capacity + 1) if gaps.get(s)), None)
            if size is None:
                each = min(capacity // n, int(left[n]))
                times = int(left[n]) // each
                for k in range(each):
                    place(n, times, opened, k * n)
                gap(capacity - each * n, opened, times)
                opened += times
                continue
            first, count = gaps[size].pop()
            times = min(count, int(left[n]))
            gap(size, first + times, count - times)
            place(n, times, first, capacity - size)
            gap(size - n, first, times)
    entries.sort()
    cols = np.array(entries, dtype=np.int64).reshape(-1, 4).T
    return Plan(*cols, opened)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: every document in sequences of
    at most ``capacity`` tokens.

    A document is its ids and the end id, so a null or empty text is a piece of one token. Only longer
    documents are cut. Rows that repeat an id are packed each on its own; an empty table gives none.
    """
    pieces = pieces_of(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    counts = pieces.groupBy("_p", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(counts, "lengths")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for n, c in counts.groupBy("length").agg(F.sum("n")).collect():  # at most `capacity` rows
        histogram[n] = c
    plan = plan_packing(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_p", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = pieces.join(before, ["_p", "length"]).withColumn("nth", F.col("_i") + F.col("before")).drop("_p", "_i", "before")
    shared = docs.sparkSession.sparkContext.broadcast(plan)  # its size follows the capacity, not the input

    def put(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = shared.value
        starts = np.searchsorted(p.length, np.arange(capacity + 2))
        for b in batches:
            n, nth = b["length"].to_numpy(np.int64), b.pop("nth").to_numpy(np.int64)
            at = np.empty(len(b), dtype=np.int64)
            for x in np.unique(n):
                rows = n == x
                at[rows] = starts[x] + np.searchsorted(p.first[starts[x]:starts[x + 1]], nth[rows], "right") - 1
            b["sequence_id"], b["offset"] = p.sequence[at] + nth - p.first[at], p.offset[at]
            yield b

    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return placed.select(F.col("doc_id").cast("string").alias("doc_id"), *cols[1:], "nth").mapInPandas(
        put, "doc_id string, piece int, start long, length int, ids_crc32 long, sequence_id long, offset long").select(
        F.col("doc_id").cast("long").alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
