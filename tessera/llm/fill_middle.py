"""Fill-in-the-middle transformation with cuts found on an indexable skip list.

A text's units (runs of letters, and every other character alone) form the bottom lane of a skip list. Each link of
an express lane carries two widths, the units and the code points that it skips; a search descends from the top
lane, adds up the widths of the links it takes and so comes out at exactly the unit that a rank names, together with
its place in the text. Two searches give the two cuts, whatever the length of the units before them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import ship_package

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: One node in so many is on the next lane, and a lane of at most so many nodes is the top.
FAN = 8


def unit_starts(text: str) -> tuple[np.ndarray, int]:
    """Where each unit ``[A-Za-z]+|[^A-Za-z]`` begins, and the text's code points."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lower = points | 0x20  # maps A-Z on a-z and no other code point below 0x80 on them
    letter = (lower >= 0x61) & (lower <= 0x7A) & (points < 0x80)
    begins = ~letter
    begins[0:1] = True
    begins[1:] |= ~letter[:-1]
    return np.flatnonzero(begins), len(points)


def tower_heights(n: int, fan: int = FAN) -> np.ndarray:
    """On how many lanes above the bottom each of ``n`` nodes stands: a geometric number, drawn by hash of its rank."""
    x = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    height, alive = np.zeros(n, dtype=np.int8), np.ones(n, dtype=bool)
    for _ in range(20):
        alive &= (x % np.uint64(fan)) == 0
        x //= np.uint64(fan)
        height += alive
        if not alive.any():
            break
    return height


class SkipList:
    """Units of one text. Lane 0 holds every unit; ``lanes[k]`` is (unit widths, code-point widths, down) of the links
    that leave the head and each node of lane k, where ``down`` is the node's place on the lane below. Lane 0 has no widths
    of units (each is one) and no ``down``."""

    def __init__(self, starts: np.ndarray, points: int, fan: int = FAN):
        self.units, self.points = len(starts), points
        at = np.append(starts, points)  # the code points before each unit, and before the end
        self.bottom = np.diff(at)
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        height = tower_heights(self.units, fan)
        below, level = np.arange(self.units), 1
        while len(below) > fan:
            nodes = below[height[below] >= level]
            if not len(nodes) or nodes[0] != 0:
                nodes = np.r_[0, nodes]  # the head stands on every lane
            ends = np.append(nodes[1:], self.units)
            self.lanes.append((ends - nodes, at[ends] - at[nodes], np.searchsorted(below, nodes)))
            if len(nodes) == len(below):
                break  # no node fell out; a lane above would be the same
            below, level = nodes, level + 1

    def place(self, rank: int) -> tuple[int, int]:
        """The code points before the ``rank``-th unit (``rank`` from 0 to the number of units), and the links looked at."""
        units, points, node, looked = 0, 0, 0, 0
        for unit_width, point_width, down in reversed(self.lanes):
            while node < len(unit_width) and units + unit_width[node] <= rank:
                units += int(unit_width[node])
                points += int(point_width[node])
                node, looked = node + 1, looked + 1
            looked += 1
            if units == rank:
                return points, looked
            node = int(down[node])
        while units < rank:
            points += int(self.bottom[node])
            units, node, looked = units + 1, node + 1, looked + 1
        return points, looked


def draws(key: str) -> list[int]:
    """The first four 8-digit groups of the hex sha256 of ``key``, as numbers."""
    h = hashlib.sha256(key.encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def cut(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """Number of units, and the places of the two cuts in code points."""
    listed = SkipList(*unit_starts(text))
    n = listed.units
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, listed.place(a)[0], listed.place(b)[0]


def transform(docs: DataFrame, seed: str = "1", plain_percent: int = 10, spm_percent: int = 20, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    Both cuts are drawn from the sha256 of ``seed:id``. ``form`` is plain (the text as it is, the two lengths null) for
    empty texts, texts that hold a marker, and ``plain_percent`` of the others; of the rest ``spm_percent`` have the
    suffix first (spm), the others the prefix (psm). A null text counts as empty; a null id draws from ``seed:`` alone.
    Rows that repeat an id are transformed each, with the same draws. An empty table gives an empty result, and
    other columns of ``docs`` are ignored.
    """
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, text in zip(b["id"], b["text"]):
                h1, h2, h3, h4 = draws(f"{seed}:{key or ''}")
                n, lo, hi = cut(text, h1, h2)
                if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= 100 - plain_percent:
                    rows.append((key, n, "plain", None, None, text))
                    continue
                prefix, middle, suffix = text[:lo], text[lo:hi], text[hi:]
                if h4 % 100 < spm_percent:
                    rows.append((key, n, "spm", lo, hi - lo, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"))
                else:
                    rows.append((key, n, "psm", lo, hi - lo, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"))
            out = pd.DataFrame(rows, columns=["id", "n", "form", "prefix_chars", "middle_chars", "output"])
            yield out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    d = docs.select(F.col(id_col).cast("long").cast("string").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ship_package(docs.sparkSession)
    got = d.mapInPandas(run, "id string, n long, form string, prefix_chars long, middle_chars long, output string")
    return got.select(F.col("id").cast("long").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", "output")


def restore(output: Column, form: Column) -> Column:
    """The text, from an output and its form alone. No part holds a marker, so each marker is found where it was put."""
    after = lambda c, mark: F.substring_index(c, mark, -1)
    before = lambda c, mark: F.substring_index(c, mark, 1)
    middle, head = after(output, MIDDLE), before(output, MIDDLE)
    psm = F.concat(after(before(head, SUFFIX), PREFIX), middle, after(head, SUFFIX))
    spm = F.concat(after(head, PREFIX), middle, after(before(head, PREFIX), SUFFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
