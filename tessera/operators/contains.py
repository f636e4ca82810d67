"""Which of many short texts a long text contains, in one pass over the long text.

Each pattern is found by one window of its characters, the one that is rarest among all patterns. A text's windows are
hashed at once; a bit table drops nearly all of them, and what is left is compared with the patterns themselves.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

#: Characters of a window; shorter patterns are windows as a whole.
WINDOW = 8
_BITS = 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def window_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` code points."""
    n = len(points) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    # runs of 1, 2, 4, ... points are hashed from their halves, and joined as the bits of ``size`` say
    h, part, width, done = np.zeros(n, dtype=np.uint64), points, 1, 0
    while True:
        if size & width:
            h += part[done:done + n] * _power(done)
            done += width
        if done == size:
            break
        part = part[:-width] + part[width:] * _power(width)
        width *= 2
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


class Matcher:
    """Finds the numbers of the ``patterns`` that a text contains; an empty pattern is in every text."""

    def __init__(self, patterns: list[str]):
        self.patterns = patterns
        self.empty = [i for i, p in enumerate(patterns) if not p]
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, dict[int, list[tuple[int, int]]]]] = {}
        with np.errstate(over="ignore"):
            hashes = {i: window_hashes(code_points(p), min(WINDOW, len(p))) for i, p in enumerate(patterns) if p}
        seen = Counter(int(x) for h in hashes.values() for x in np.unique(h))
        by_size: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for i, h in hashes.items():
            at = min(range(len(h)), key=lambda k: seen[int(h[k])])
            by_size.setdefault(min(WINDOW, len(patterns[i])), {}).setdefault(int(h[at]), []).append((i, at))
        for size, places in by_size.items():
            keys = np.array(sorted(places), dtype=np.uint64)
            bits = np.zeros(1 << _BITS, dtype=bool)
            bits[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.tables[size] = (bits, keys, places)

    def find(self, text: str) -> list[int]:
        found = set(self.empty)
        if self.tables and text:
            points = code_points(text)
            for size, (bits, keys, places) in self.tables.items():
                with np.errstate(over="ignore"):
                    h = window_hashes(points, size)
                at = np.flatnonzero(bits[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
                at = at[np.isin(h[at], keys)]
                for place, key in zip(at.tolist(), h[at].tolist()):
                    for i, offset in places[key]:
                        if i not in found and place >= offset and text.startswith(self.patterns[i], place - offset):
                            found.add(i)
        return sorted(found)
