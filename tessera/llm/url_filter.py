"""URL filters: a blocked Bloom filter of the listed canonical URLs in front of an exact hash join.

A listed URL is a host and the beginning of a path, with a verdict; it covers its host, all subdomains and every
path that begins so. Each URL makes the few (host suffix, path prefix) keys that could be listed: suffixes of at
most as many labels as the list's longest host, prefixes of the lengths that listed paths have. All keys are tried
in the row on the filter, whose keys lie in one block of 256 bits each. A URL without a possible hit is done there,
and nothing of it is shuffled. Possible hits meet the list itself in a hash join, which removes the filter's false
positives, and the longest listed URL wins. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

#: Words of 64 bits in a block, and bits that a key sets in each of them.
WORDS, PER_WORD = 4, 2
BITS_PER_KEY = 16
#: Bound of the filter, which every task gets: 2^18 blocks are 8 MB. A longer list fills it more, so that more false hits reach the join.
MAX_BLOCKS = 1 << 18
#: A list of at most so many entries and bytes is broadcast to the exact join; a longer one is shuffled.
BROADCAST_ENTRIES, BROADCAST_BYTES = 500_000, 32 << 20
#: Places in which a listed URL meets its hits when the list is shuffled.
SALTS = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def lower_host(host: Column) -> Column:
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z in lower case) and path of a URL; both empty for null or without ``://``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    return lower_host(F.regexp_extract(u, _PARTS, 1)), F.regexp_extract(u, _PARTS, 2)


def canonical_list(listed: DataFrame) -> DataFrame:
    """``listed(host, path, verdict)`` with a row for each host and path; of several verdicts the greater one holds
    (``block`` over ``allow``). Rows without a verdict list nothing."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return listed.where("verdict is not null").groupBy(lower_host(F.col("host").cast("string")).alias("key_host"), text("path").alias("key_path")).agg(
        F.max(F.col("verdict").cast("string")).alias("key_verdict"))


def _bit(h: Column, j: int) -> Column:
    """A word with the ``j``-th bit that the hash ``h`` names."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * j).bitwiseAND(F.lit(63).cast("long")).cast("int"))


def masks(host: Column, path: Column) -> list[Column]:
    """The bits of a key in each word of its block."""
    h = F.xxhash64(host, path, F.lit("bits"))
    out = []
    for w in range(WORDS):
        m = _bit(h, w)
        for k in range(1, PER_WORD):
            m = m.bitwiseOR(_bit(h, w + k * WORDS))
        out.append(m)
    return out


def block_of(host: Column, path: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(host, path), F.lit(blocks)).cast("int")


def bloom_words(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter as one row: an array of ``blocks`` x ``WORDS`` words."""
    cols = [F.col("key_host"), F.col("key_path")]
    filled = listed.select(block_of(*cols, blocks).alias("b"), *[m.alias(f"w{i}") for i, m in enumerate(masks(*cols))])
    filled = filled.groupBy("b").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
    every = listed.sparkSession.range(blocks).select(F.col("id").cast("int").alias("b")).join(filled, "b", "left")
    words = F.array(*[F.coalesce(f"w{i}", F.lit(0).cast("long")) for i in range(WORDS)])
    blocks_ = F.array_sort(F.collect_list(F.struct("b", words.alias("w"))))
    return every.agg(F.flatten(F.transform(blocks_, lambda x: x["w"])).alias("words"))


def may_hold(words: Column, host: Column, path: Column, blocks: int) -> Column:
    """False only for keys that are not in the list."""
    base = block_of(host, path, blocks) * WORDS
    test = F.lit(True)
    for i, m in enumerate(masks(host, path)):
        test = test & (F.get(words, base + i).bitwiseAND(m) == m)
    return test


def possible_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """The (host suffix, path prefix) keys of a URL that could be listed."""
    parts = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
                           lambda n: F.concat_ws(".", F.slice(parts, F.size(parts) - n + 1, n)))
    prefixes = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path)), lambda n: F.substr(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(h.alias("h"), p.alias("p")))))


def judge(pages: DataFrame, listed: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url",
          max_blocks: int = MAX_BLOCKS, broadcast_entries: int = BROADCAST_ENTRIES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``listed(host, path, verdict)``; ``rule`` is host and path of the longest listed URL that covers the row's (of equal
    lengths the one with the longer host), else null, and the verdict is then ``default``. A URL that is null, empty or
    without ``://`` has an empty host and path. Rows that repeat are judged each; ids may be null. An empty list leaves
    ``default`` for all, an empty table gives an empty result, and other columns of ``pages`` are ignored.
    """
    listed = cut_lineage(canonical_list(listed), "listed-urls")
    about = listed.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(F.split("key_host", r"\."))).alias("labels"),
                       F.collect_set(F.length("key_path")).alias("lengths"),  # as many as there are lengths of paths
                       F.sum(F.octet_length("key_host") + F.octet_length("key_path") + 32).alias("bytes")).first()
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    plain = [F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")]
    if not about["n"]:
        return urls.select("page_id", "host", "path", *plain)
    blocks = min(max_blocks, max(1, math.ceil(about["n"] * BITS_PER_KEY / (64 * WORDS))))
    words = bloom_words(listed, blocks).scalar()
    keys = possible_keys(F.col("host"), F.col("path"), about["labels"], sorted(about["lengths"]))
    tried = cut_lineage(urls.withColumn("words", words).withColumn(
        "keys", F.filter(keys, lambda k: may_hold(F.col("words"), k["h"], k["p"], blocks))).drop("words"), "tried-urls")
    # rows that repeat go on as one; an id's hits stay together whatever keys they share with other rows
    hits = tried.where(F.size("keys") > 0).groupBy("page_id", "host", "path").agg(F.first("keys").alias("keys"), F.count(F.lit(1)).alias("times"))
    each = hits.select("page_id", "host", "path", "times", F.explode("keys").alias("k")).select(
        "page_id", "host", "path", "times", F.col("k.h").alias("key_host"), F.col("k.p").alias("key_path"))
    if about["n"] <= broadcast_entries and about["bytes"] <= BROADCAST_BYTES:
        exact = each.join(F.broadcast(listed), ["key_host", "key_path"], "left")
    else:
        salted = each.withColumn("salt", F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(SALTS)).cast("int"))
        spread = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        exact = salted.join(spread.hint("merge"), ["key_host", "key_path", "salt"], "left")
    found = F.when(F.col("key_verdict").isNotNull(), F.struct(
        (F.length("key_host") + F.length("key_path")).alias("n"), F.length("key_host").alias("of_host"),
        F.concat("key_host", "key_path").alias("rule"), F.col("key_verdict").alias("verdict")))
    best = exact.groupBy("page_id", "host", "path", "times").agg(F.max(found).alias("best"))
    judged = best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
                         F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("time")).drop("time")
    return judged.unionByName(tried.where(F.size("keys") == 0).select("page_id", "host", "path", *plain))
