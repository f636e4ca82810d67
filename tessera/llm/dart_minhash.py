"""MinHash near-dedup with dart signatures.

A text is a weighted set: its five-word shingles with their counts. Darts are thrown, by hash alone, into
the plane of (element, weight) x rank, on average one for each unit of area; those below an element's
weight belong to every text that holds it with that weight. Each dart falls on one of ``k`` coordinates,
and a text keeps its earliest dart (least rank) for each. Two texts agree on a coordinate with the
probability of their weighted Jaccard similarity, and a text costs time in proportion to its length.

Texts that agree on a band of coordinates share a bucket. In each bucket the members are compared with its
least member; members that are in different classes after that are compared with one another, block against
block, first by their signatures and, where these are close, by their shingles themselves. So every pair that
shares a bucket is either in one class already or tested: no link between classes is lost, and a large class
does not become all its pairs.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Recent, column, free_name, text_slices
from tessera.llm.components import components
from tessera.session import cut_lineage, ship_package

WORDS = 5
ROWS, BANDS = 8, 40
#: Unit cells that are handled at once.
SLAB = 1 << 19
#: Members of a bucket that are compared in one block.
BLOCK = 512
#: Rank bits of a dart within its cell.
BITS = 40
#: Pairs whose signatures agree less than this far below the threshold are not looked at: 3.6 deviations at 320 coordinates.
SLACK = 0.08
#: Word hashes a worker remembers, twice this at most.
REMEMBERED = 100_000
#: A table of at most so many narrow rows is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 1_000_000

_WORD = re.compile(r"\w+")
_POISSON = np.array([sum(math.exp(-1) / math.factorial(i) for i in range(n + 1)) * 2.0**32 for n in range(12)]).astype(np.uint64)
_hashes = Recent(REMEMBERED)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str], size: int = WORDS) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Hashes of all word shingles with their text's number, and a digest of each text's words.
    A text of fewer words is one shingle, one without words has none."""
    flat: list[int] = []
    lengths, digests = [], []
    for t in texts:
        ws = _WORD.findall(t.lower())
        digests.append(hashlib.blake2b(" ".join(ws).encode("utf-8", "surrogatepass"), digest_size=16).digest())
        new = _hashes.missing(set(ws))
        _hashes.held.update((w, xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))) for w in new)
        flat.extend(map(_hashes.held.__getitem__, ws))
        lengths.append(len(ws))
    w, n = np.array(flat, dtype=np.uint64), np.array(lengths, dtype=np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)
    take = np.minimum(size, n)[owner]  # words of the shingle that begins here
    begins = (place + size <= n[owner]) | ((place == 0) & (n[owner] < size))
    h = np.zeros(len(w), dtype=np.uint64)
    for j in range(size):
        nxt = np.zeros(len(w), dtype=np.uint64)
        nxt[:max(0, len(w) - j)] = w[j:]
        used = (j < take) & begins
        h[used] = _mix(h[used] + nxt[used] + np.uint64(j + 1))
    return h[begins], owner[begins], digests


def weigh(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (element, text) pairs with their counts."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return h[at], owner[at], np.diff(np.r_[at, len(h)]).astype(float)


def unit_cells(h: np.ndarray, owner: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The region of an element up to its weight as cells of width one: their hash, text, and the part of the
    cell that belongs to the region (below one only in the last cell of a fractional weight)."""
    n = np.ceil(weight).astype(np.int64)
    no = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return _mix(np.repeat(h, n) + _mix(no.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))), np.repeat(owner, n), np.minimum(1.0, np.repeat(weight, n) - no)


def dart_signatures(h: np.ndarray, owner: np.ndarray, weight: np.ndarray, texts: int, k: int) -> np.ndarray:
    """(texts, k) ranks of the earliest darts; rows of texts without elements stay at the largest number.

    A text of total weight W looks at ranks up to t / W, where t = k ln k + 2 k darts fill almost all
    coordinates; while some are empty it looks at further ranks. The earliest dart does not depend on how
    far a text looks, so signatures of texts of any weights agree.
    """
    none = np.iinfo(np.uint64).max
    sig = np.full(texts * k, none, dtype=np.uint64)
    cell, of, part = unit_cells(h, owner, weight)
    total = np.bincount(owner, weights=weight, minlength=texts)
    goal = k * math.log(k) + 2 * k
    depth = np.where(total > 0, np.ceil(goal / np.maximum(total, 1e-9)), 0).astype(np.int64)
    lo, hi = np.zeros(texts, dtype=np.int64), depth
    while len(cell):
        ranks = (hi - lo)[of]
        ends = np.cumsum(ranks)
        at = 0
        while at < len(cell):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLAB, "right")))
            r = ranks[at:stop]
            rank = np.arange(r.sum()) - np.repeat(np.cumsum(r) - r, r) + np.repeat(lo[of[at:stop]], r)
            c = _mix(np.repeat(cell[at:stop], r) + rank.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            darts = np.searchsorted(_POISSON, c >> np.uint64(32), "right")
            source = np.repeat(np.arange(len(c)), darts)
            number = np.arange(len(source)) - np.repeat(np.cumsum(darts) - darts, darts)
            d = _mix(c[source] + (number.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))
            text = np.repeat(of[at:stop], r)[source]
            inside = np.repeat(part[at:stop], r)[source]
            where = _mix(d + np.uint64(0x2545F4914F6CDD1D))
            value = (rank[source].astype(np.uint64) << np.uint64(BITS)) | (d >> np.uint64(64 - BITS))
            slot = text * k + ((where >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
            if (inside < 1).any():
                ok = (where & np.uint64(0xFFFFFFFF)).astype(float) / 2.0**32 < inside
                slot, value = slot[ok], value[ok]
            np.minimum.at(sig, slot, value)
            at = stop
        empty = (sig.reshape(texts, k) == none).any(axis=1) & (total > 0)
        keep = empty[of]
        cell, of, part = cell[keep], of[keep], part[keep]
        lo, hi = hi, 2 * hi
    return sig.reshape(texts, k)


def band_keys(sig: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """(texts, bands) hashes of each band's coordinates."""
    key = np.zeros((len(sig), bands), dtype=np.uint64)
    for j in range(rows):
        key = _mix(key + sig[:, j:rows * bands:rows] + np.arange(bands, dtype=np.uint64))
    return key.astype(np.int64)


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity from signatures of one byte a coordinate, of which 1 in 256 agree by chance."""
    return ((a == b).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def signature_table(docs: DataFrame, rows: int, bands: int) -> DataFrame:
    """``id, words, bands, sig``: stored, one row for each row of ``docs(id, text)``."""
    k = rows * bands

    def sign(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in text_slices(batches):
            h, owner, digests = shingles([t or "" for t in b["text"]])
            sig = dart_signatures(*weigh(h, owner), len(b), k)
            has = np.bincount(owner, minlength=len(b)) > 0
            keys, low = band_keys(sig, rows, bands), (sig & np.uint64(255)).astype(np.uint8)
            yield pd.DataFrame({"id": b["id"], "words": digests, "bands": [x if y else x[:0] for x, y in zip(keys, has)], "sig": [x.tobytes() for x in low]})
        _hashes.rest()

    return cut_lineage(docs.mapInPandas(sign, "id long, words binary, bands array<long>, sig binary"), "signatures")


def bounded_side(stored: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table as the side of a join: broadcast if it has at most ``most`` rows, else joined by a shuffle."""
    return F.broadcast(stored) if stored.count() <= most else stored.hint("merge")


def cells_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, cells`` of the rows of ``docs(id, text)`` that ``ids(id)`` names: the unit cells of the text's
    elements, sorted. With whole counts as weights, the weighted Jaccard similarity is that of these sets."""
    def hashed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in text_slices(batches):
            h, owner, _ = shingles([t or "" for t in b["text"]])
            cell, of, _ = unit_cells(*weigh(h, owner))
            order = np.lexsort((cell, of))
            parts = np.split(cell[order], np.cumsum(np.bincount(of, minlength=len(b)))[:-1])
            yield pd.DataFrame({"id": b["id"], "cells": [p.tobytes() for p in parts]})
        _hashes.rest()

    ids = bounded_side(cut_lineage(ids, "wanted"))
    return cut_lineage(docs.join(ids, "id", "left_semi").mapInPandas(hashed, "id long, cells binary"), "cells")


def alike(x: bytes, y: bytes, threshold: float) -> bool:
    """Whether the sets of unit cells have a Jaccard similarity of ``threshold`` or more."""
    if min(len(x), len(y)) < threshold * max(len(x), len(y)):
        return False
    a = np.sort(np.concatenate([np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)]))
    common = int((a[1:] == a[:-1]).sum())
    return common >= threshold * (len(a) - common)


def links_within(members: DataFrame, details: DataFrame, threshold: float, slack: float = SLACK) -> DataFrame:
    """Links ``a, b`` between the classes of each bucket.

    ``members(key, node, label)`` and ``details(node, bands, sig, cells)``. Members outside the bucket's largest class (few, where
    a bucket is large because its texts are alike) meet all members of other classes, in blocks of bounded
    size. A pair is tested only in the first bucket that it shares; for each member and class one link is
    enough, so what comes out grows with the members and not with their pairs.
    """
    sizes = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.sum("n").alias("all"), F.max(F.struct("n", F.col("label").alias("main"))).alias("m"))
    main = main.select("key", F.col("m.main").alias("main"), F.ceil((F.col("all") - F.col("m.n")) / BLOCK).cast("int").alias("nu"),
                       F.ceil(F.col("all") / BLOCK).cast("int").alias("na"))
    m = members.join(bounded_side(cut_lineage(main, "main")), "key").withColumn("out", F.col("label") != F.col("main")).join(details, "node")
    spot = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = ["out", "node", "label", "bands", "sig", "cells"]
    asks = m.where("out").select("key", spot("nu", 1).alias("u"), every("na").alias("c"), F.lit(0).alias("role"), *rest)
    all_ = m.select("key", every("nu").alias("u"), spot("na", 2).alias("c"), F.lit(1).alias("role"), *rest)
    blocks = asks.unionByName(all_).repartition("key", "u", "c").sortWithinPartitions("key", "u", "c", "role")

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        q, a = g[g["role"] == 0], g[g["role"] == 1]
        node, label, out = (a[c].to_numpy() for c in ("node", "label", "out"))
        sig, bands = (np.stack([np.frombuffer(x, dtype=np.uint8) for x in a["sig"]]), np.stack(a["bands"].to_list()))
        cells, links = a["cells"].to_list(), []
        key = int(g["key"].iloc[0])
        for own, of, s, b, c in zip(q["node"], q["label"], q["sig"], q["bands"], q["cells"]):
            likely = agreement(sig, np.frombuffer(s, dtype=np.uint8))
            maybe = np.flatnonzero((likely >= threshold - slack) & (label != of) & ~(out & (node < own)))
            if not len(maybe):
                continue
            shared = bands[maybe] == b
            maybe = maybe[b[shared.argmax(axis=1)] == key]
            met: set[int] = set()
            for i in maybe[np.argsort(-likely[maybe], kind="stable")]:
                if label[i] not in met and alike(c, cells[i], threshold):
                    met.add(label[i])
                    links.append((own, node[i]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the rows so far of the block at the end of the last batch
        for batch in batches:
            if not len(batch):
                continue
            ids = batch[["key", "u", "c"]].to_numpy()
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1), len(batch)]
            if held and (held[-1][["key", "u", "c"]].to_numpy()[-1] != ids[0]).any():
                yield compare(pd.concat(held))
                held = []
            for lo, hi in zip(cuts, cuts[1:]):
                held.append(batch.iloc[lo:hi])
                if hi < len(batch):
                    yield compare(pd.concat(held) if len(held) > 1 else held[0])
                    held = []
        if held:
            yield compare(pd.concat(held))

    return blocks.mapInPandas(run, "a long, b long")


def similar(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, threshold: float, slack: float = SLACK) -> DataFrame:
    """The ``pairs(a, b)`` whose texts have a weighted Jaccard similarity of ``threshold`` or more."""
    sig = nodes.select("node", "sig")
    both = (pairs.join(sig.withColumnsRenamed({"node": "a", "sig": "sa"}), "a").join(sig.withColumnsRenamed({"node": "b", "sig": "sb"}), "b"))

    def likely(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x, y = (np.stack([np.frombuffer(v, dtype=np.uint8) for v in b[c]]) for c in ("sa", "sb"))
                yield b.loc[agreement(x, y) >= threshold - slack, ["a", "b"]]

    close = cut_lineage(both.select("a", "b", "sa", "sb").mapInPandas(likely, "a long, b long"), "close")
    cells = cells_of(docs, close.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    full = (close.join(cells.withColumnsRenamed({"id": "a", "cells": "ca"}), "a").join(cells.withColumnsRenamed({"id": "b", "cells": "cb"}), "b"))

    def exact(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            good = [alike(x, y, threshold) for x, y in zip(b["ca"], b["cb"])]
            yield b.loc[np.array(good, dtype=bool), ["a", "b"]]

    return cut_lineage(full.select("a", "b", "ca", "cb").mapInPandas(exact, "a long, b long").distinct(), "similar")


def near_classes(docs: DataFrame, threshold: float = 0.8, rows: int = ROWS, bands: int = BANDS,
                 id_col: str = "doc_id", text_col: str = "text", slack: float | None = SLACK) -> DataFrame:
    """``doc_id, class_id, kept, n_links`` for every row: classes are the connected components of near-duplicates.

    ``class_id`` is the least id of the class, whose rows are ``kept``; ``n_links`` counts the tested links to other texts
    that were needed to hold this row's text in its class (0: no other text is near, or only the same words elsewhere).
    Words are runs of letters, digits and underscores in lower case. Texts with the same words are one class, also
    those without any (null, empty). Rows that share an id are one document and so in one class, whatever their
    texts. A row without an id is in no class: its ``class_id`` is null and it is kept. With 40 bands of 8 coordinates
    a pair at 0.8 shares a bucket with 0.9994, one at 0.85 with 0.999997. Of the pairs that share a bucket, those whose
    signatures agree by less than ``threshold - slack`` are not looked at; ``slack=None`` tests them all on their
    shingles. An empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    slack = 1.0 + threshold if slack is None else slack
    d = docs.select(column(id_col).cast("long").alias("id"), column(text_col).cast("string").alias("text"))
    named = d.where("id is not null")
    signed = signature_table(named, rows, bands)
    # texts with the same words become one node before anything is paired
    nodes = cut_lineage(signed.groupBy("words").agg(F.min("id").alias("node"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "nodes")
    entries = nodes.select("node", F.explode("bands").alias("key"))
    shared = cut_lineage(entries.groupBy("key").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    buckets = cut_lineage(entries.join(bounded_side(shared), "key"), "buckets")
    stars = buckets.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    links = similar(stars, named, nodes, threshold, slack)
    one_id = links_of_ids(signed, nodes)
    if one_id is not None:
        links = cut_lineage(links.unionByName(one_id).distinct(), "links")
    labels = components(links)
    # pairs with a bucket's least member are done; where the others are in several classes, these are compared
    others = buckets.where("n > 2 and node <> lead").select("key", "node").join(labels, "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label"))
    mixed = cut_lineage(others.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key"), "mixed")
    open_ = cut_lineage(others.join(bounded_side(mixed), "key"), "members")
    if not open_.isEmpty():
        cells = cells_of(named, open_.select(F.col("node").alias("id")).distinct())
        details = nodes.select("node", "bands", "sig").join(cells.withColumnRenamed("id", "node"), "node")
        found = cut_lineage(links_within(open_, details, threshold, slack), "found")
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = components(links)
    ends = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    held = ends.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    classes = nodes.select("words", "node").join(labels, "node", "left").join(held, "node", "left").select(
        "words", F.coalesce("label", "node").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    out = signed.select("id", "words").join(classes, "words").select(F.col("id").alias("doc_id"), "class_id", "n_links")
    out = out.unionByName(d.where("id is null").select(F.col("id").alias("doc_id"), F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links")))
    return out.select("doc_id", "class_id", (F.col("class_id").isNull() | (F.col("doc_id") == F.col("class_id"))).alias("kept"), "n_links")


def links_of_ids(signed: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """Links between the nodes that rows of one id belong to; None where no id has rows of different words."""
    several = signed.groupBy("id").agg(F.min("words").alias("x"), F.max("words").alias("y")).where("x <> y").select("id")
    several = cut_lineage(several, "repeated-ids")
    if several.isEmpty():
        return None
    of = signed.select("id", "words").join(several, "id").join(nodes.select("words", "node"), "words").select("id", "node").distinct()
    least = of.groupBy("id").agg(F.min("node").alias("a"))
    return of.join(least, "id").where("a <> node").select("a", F.col("node").alias("b")).distinct()


def drop_near_copies(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each class, with all its columns, whatever their names; rows without an id stay.

    Of several rows of the id that stays, the one whose text has the least digest stays (of equal texts, any). Only
    the ids that go meet the documents, so that no text is shuffled while these ids are few enough to be broadcast.
    """
    labels = cut_lineage(near_classes(docs, threshold, id_col=id_col, text_col=text_col).where("doc_id is not null").select("doc_id", "kept"), "near-labels")
    gone_id, place = free_name(docs.columns, "gone_id"), free_name(docs.columns, "place")
    key = column(id_col).cast("long")
    gone = cut_lineage(labels.where("not kept").select(F.col("doc_id").alias(gone_id)).distinct(), "gone")
    out = docs.join(bounded_side(gone), key == F.col(gone_id), "left_anti")
    more = cut_lineage(labels.where("kept").groupBy(F.col("doc_id").alias(gone_id)).count().where("count > 1").select(gone_id), "again")
    if more.isEmpty():
        return out
    again = out.join(bounded_side(more), key == F.col(gone_id), "left_semi")
    first = Window.partitionBy(key).orderBy(F.sha2(column(text_col).cast("string"), 256))
    again = again.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place)
    return out.join(bounded_side(more), key == F.col(gone_id), "left_anti").unionByName(again)
