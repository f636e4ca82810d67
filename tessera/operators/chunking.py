"""K-operators: document table -> chunk table, four strategies.

* fixed / recursive (K1-K3): the published separator-ladder splitter with
  overlap, run per document inside an Arrow-batched ``pandas_udf`` (no
  shuffle; documents are independent). The merge keeps its window in a deque,
  so a multi-megabyte block stays linear.
* markdown (K4): one pass over a document's lines in its row, which gives its
  sections with their h1..h4 headers; sections are split with K3.
* semantic (K5): a document's sentences are embedded in its row with their
  neighbours (plug point); cuts where the cosine distance to the next is above
  the document's 95th percentile.

A document is one row and stays in its task for all four strategies, so no line, sentence or vector is shuffled.

Every output row: ``(source_path, strategy, chunk_idx, chunk_id, page_content, metadata)``.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import override, text_runs
from tessera.operators.index import HashedEmbedder
from tessera.session import cut_lineage

# Defaults of the reference configuration.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 150
HARD_MAX_CHARS = 8000
LADDER = ["\n\n", "\n", " ", ""]
FIXED_SEPARATOR = "\n\n"
SEMANTIC_PERCENTILE = 0.95
SENTENCE_SPLIT = r"(?<=[.?!])\s+"
_SENTENCE = re.compile(SENTENCE_SPLIT, re.ASCII)
#: Sentences of a document that are embedded at once.
SENTENCES = 4096
HEADERS = [("#", "h1"), ("##", "h2"), ("###", "h3"), ("####", "h4")]

CHUNK_SCHEMA = T.StructType([
    T.StructField("source_path", T.StringType()),
    T.StructField("strategy", T.StringType()),
    T.StructField("chunk_idx", T.IntegerType()),
    T.StructField("chunk_id", T.StringType()),
    T.StructField("page_content", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])


# --------------------------------------------------------------------------- splitter (per document)


def _pieces(text: str, sep: str, keep: bool) -> list[str]:
    """Cut ``text`` at ``sep``; with ``keep`` the separator starts the next piece."""
    if sep == "":
        return list(text)
    if not keep:
        return [p for p in text.split(sep) if p != ""]
    parts = text.split(sep)
    out = [parts[0]] + [sep + p for p in parts[1:]]
    return [p for p in out if p != ""]


def _merge(pieces: list[str], sep: str, size: int, overlap: int) -> list[str]:
    """Greedy merge to at most ``size`` with ``overlap`` carried between chunks."""
    out: list[str] = []
    cur: deque[str] = deque()
    total = 0
    slen = len(sep)
    for p in pieces:
        n = len(p)
        if total + n + (slen if cur else 0) > size:
            if cur:
                doc = sep.join(cur).strip()
                if doc:
                    out.append(doc)
                while total > overlap or (total + n + (slen if cur else 0) > size and total > 0):
                    total -= len(cur[0]) + (slen if len(cur) > 1 else 0)
                    cur.popleft()
        cur.append(p)
        total += n + (slen if len(cur) > 1 else 0)
    doc = sep.join(cur).strip()
    if doc:
        out.append(doc)
    return out


def recursive_split(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                    ladder: list[str] = LADDER) -> list[str]:
    """K3: first separator of the ladder present in the text; pieces shorter than
    ``size`` accumulate, a longer piece flushes them and is split again with the
    rest of the ladder; separators stay at the start of the following piece."""
    sep, rest = ladder[-1], []
    for i, s in enumerate(ladder):
        if s == "" or s in text:
            sep, rest = s, ladder[i + 1:]
            break
    out: list[str] = []
    good: list[str] = []
    for p in _pieces(text, sep, keep=True):
        if len(p) < size:
            good.append(p)
            continue
        if good:
            out.extend(_merge(good, "", size, overlap))
            good = []
        out.extend(recursive_split(p, size, overlap, rest) if rest else [p])
    if good:
        out.extend(_merge(good, "", size, overlap))
    return out


def fixed_split(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                hard_max: int = HARD_MAX_CHARS) -> list[str]:
    """K1 + K2: split on blank lines and merge with ``\\n\\n``; any chunk above
    ``hard_max`` is re-split by K3 with ``chunk_size = hard_max``."""
    out: list[str] = []
    for c in _merge(_pieces(text, FIXED_SEPARATOR, keep=False), FIXED_SEPARATOR, size, overlap):
        out.extend([c] if len(c) <= hard_max else recursive_split(c, hard_max, overlap))
    return out


def _per_text(cutter, kind: T.DataType):
    """A column function that gives each text to what ``cutter()`` returns, once a task. Batches are worked off and handed
    on in runs of bounded size, so a worker never holds the pieces of a whole batch."""

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cut = cutter()
        for b in batches:
            for texts in text_runs(b.tolist()):
                yield pd.Series([cut(t) for t in texts], dtype=object)

    return run


def _split_udf(kind: str, size: int, overlap: int):
    split = fixed_split if kind == "fixed" else recursive_split
    return _per_text(lambda: lambda t: split(t or "", size, overlap), T.ArrayType(T.StringType()))


# --------------------------------------------------------------------------- K12 / framing


def chunk_id(source_path: Column, strategy: Column, idx: Column) -> Column:
    """``{source_path}::{strategy}::{i}``, i = order within the source."""
    return F.concat_ws("::", source_path, strategy, idx.cast("string"))


def _frame(df: DataFrame, strategy: str, arr: Column, meta: Column | None = None) -> DataFrame:
    m = meta if meta is not None else F.col("metadata")
    x = df.select("source_path", m.alias("metadata"), F.posexplode(arr).alias("chunk_idx", "page_content"))
    return x.select("source_path", F.lit(strategy).alias("strategy"), F.col("chunk_idx").cast("int").alias("chunk_idx"),
                    chunk_id(F.col("source_path"), F.lit(strategy), F.col("chunk_idx")).alias("chunk_id"),
                    "page_content",
                    override(F.col("metadata"), F.create_map(F.lit("chunk_strategy"), F.lit(strategy))).alias("metadata"))


def _docs(docs: DataFrame) -> DataFrame:
    if "metadata" not in docs.columns:
        docs = docs.withColumn("metadata", F.create_map().cast("map<string,string>"))
    return docs.select("source_path", "page_content", "metadata")


def chunk_fixed(docs: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """K1 + K2 over a document table ``(source_path, page_content[, metadata])``."""
    d = _docs(docs)
    return _frame(d, "fixed", _split_udf("fixed", size, overlap)(F.col("page_content")))


def chunk_recursive(docs: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """K3 over a document table."""
    d = _docs(docs)
    return _frame(d, "recursive", _split_udf("recursive", size, overlap)(F.col("page_content")))


# --------------------------------------------------------------------------- K4

#: Unicode white space, as the SQL engine trims it.
_BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_HEADER = re.compile(r"(#{1,4})(?: |$)")


def markdown_sections(text: str) -> list[tuple[str, list[str | None]]]:
    """Sections of a document as (text, headers h1 to h4): a section begins at each header line outside fences; one
    without a body joins the section that follows if that is deeper. Blank lines count inside fences only."""
    sections: list[tuple[list[str], list[str | None], bool]] = []  # kept lines, headers, whether it has a body
    lines: list[str] = []
    headers: list[str | None] = [None] * 4
    body, fenced = False, False

    def close() -> None:
        if lines:
            sections.append((lines, list(headers), body))

    for raw in text.split("\n"):
        line = raw.strip(_BLANKS)
        mark = line.startswith(("```", "~~~"))
        code = mark or fenced
        fenced ^= mark
        m = None if code else _HEADER.match(line)
        if m:
            close()
            level = len(m[1])
            lines, body = [line], False
            headers = [*headers[:level - 1], line[level:].strip(" "), *[None] * (4 - level)]
        elif line or code:
            lines.append(line)
            body = True
    close()
    out: list[tuple[str, list[str | None]]] = []
    waiting: list[str] = []
    depth = lambda h: sum(x is not None for x in h)
    for i, (own, h, has_body) in enumerate(sections):
        waiting += own
        if has_body or i + 1 == len(sections) or depth(sections[i + 1][1]) <= depth(h):
            out.append(("\n".join(waiting), h))
            waiting = []
    return out


def _markdown_udf(size: int, overlap: int):
    one = T.StructType([T.StructField("text", T.StringType()), *[T.StructField(h, T.StringType()) for _, h in HEADERS]])

    def pieces(t: str | None) -> list[dict]:
        return [{"text": p, "h1": h[0], "h2": h[1], "h3": h[2], "h4": h[3]}
                for text, h in markdown_sections(t or "") for p in recursive_split(text, size, overlap)]

    return _per_text(lambda: pieces, T.ArrayType(one))


def chunk_markdown(docs: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """K4: sections at ``#``..``####`` (header lines kept, headers inside ```/~~~
    fences ignored), h1..h4 carried, header-only sections merged into the
    deeper section that follows, then K3 inside each section."""
    d = _docs(docs)
    x = d.select("source_path", "metadata", F.posexplode(_markdown_udf(size, overlap)(F.col("page_content"))).alias("chunk_idx", "p"))
    named = F.map_filter(F.create_map(*[v for _, h in HEADERS for v in (F.lit(h), F.col(f"p.{h}"))]), lambda k, v: v.isNotNull())
    own = F.create_map(F.lit("chunk_strategy"), F.lit("markdown"))
    return x.select("source_path", F.lit("markdown").alias("strategy"), F.col("chunk_idx").cast("int").alias("chunk_idx"),
                    chunk_id(F.col("source_path"), F.lit("markdown"), F.col("chunk_idx")).alias("chunk_id"),
                    F.col("p.text").alias("page_content"), override(override(F.col("metadata"), named), own).alias("metadata"))


# HTML -> Markdown rewrite rules for pages (tags stripped, h1..h4 to '#' lines).
HTML_DROP = r"(?is)<script.*?</script>|<style.*?</style>|<nav.*?</nav>|<!--.*?-->|<head.*?</head>"
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def html_to_markdown(html: Column) -> Column:
    """Page HTML as Markdown text: h1..h4 become ``#`` lines, block tags become
    line breaks, other tags are dropped, common entities decoded."""
    t = F.regexp_replace(html, HTML_DROP, "")
    for n in range(1, 5):
        t = F.regexp_replace(t, rf"(?i)<h{n}[^>]*>", "\n\n" + "#" * n + " ")
    t = F.regexp_replace(t, r"(?i)</h[1-6]>", "\n\n")
    t = F.regexp_replace(t, r"(?i)</?(p|div|article|section|li|ul|ol|br|tr|table)[^>]*>", "\n")
    t = F.regexp_replace(t, r"<[^>]+>", "")
    for a, b in HTML_ENTITIES:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(t, r"\n{3,}", "\n\n"))


# --------------------------------------------------------------------------- K5


def semantic_split(text: str, vectors, percentile: float = SEMANTIC_PERCENTILE) -> list[str]:
    """K5 for one text; ``vectors(list of str)`` gives unit rows. A sentence is embedded with its neighbours, so many at
    a time; only the distances are kept."""
    sentences = _SENTENCE.split(text)
    n = len(sentences)
    around = [" ".join(sentences[max(0, i - 1):i + 2]) for i in range(n)]
    dist, last = [], None
    for at in range(0, n, SENTENCES):
        v = vectors(around[at:at + SENTENCES])
        if last is not None:
            v = np.concatenate([last[None], v])
        dist.append(1.0 - np.einsum("ij,ij->i", v[:-1], v[1:]))
        last = v[-1]
    gaps = np.round(np.concatenate(dist), 12)  # the order of summation makes no cut
    if not len(gaps):
        return [text]
    cuts = np.flatnonzero(gaps > np.quantile(gaps, percentile)) + 1
    return [" ".join(sentences[a:b]) for a, b in zip([0, *cuts], [*cuts, n])]


def chunk_semantic(docs: DataFrame, embedder=None, percentile: float = SEMANTIC_PERCENTILE) -> DataFrame:
    """K5: cut after sentence i when the cosine distance between the buffered
    sentence i and i+1 is above the document's percentile (linear interpolation);
    chunks are sentences joined by a space. A null document has none."""
    vectors_of = (embedder or HashedEmbedder()).vectors

    def cutter():
        vectors = vectors_of()
        return lambda t: [] if t is None else semantic_split(t, vectors, percentile)

    split = _per_text(cutter, T.ArrayType(T.StringType()))
    return _frame(_docs(docs), "semantic", split(F.col("page_content")))


# --------------------------------------------------------------------------- K6-K11


STRATEGIES = {"fixed": chunk_fixed, "recursive": chunk_recursive, "markdown": chunk_markdown, "semantic": chunk_semantic}


def chunk_all(docs: DataFrame, strategies: tuple[str, ...] = tuple(STRATEGIES)) -> DataFrame:
    """K6: the same input under every strategy, one table with a ``strategy`` column; an unknown name raises."""
    out = None
    for name in strategies:
        if name not in STRATEGIES:
            raise ValueError(f"unknown chunk strategy: {name!r}")
        c = STRATEGIES[name](docs)
        out = c if out is None else out.unionByName(c)
    return out


def chunk_stats(chunks: DataFrame, strategies: list[str]) -> DataFrame:
    """K7: count, mean, median, min, max of chunk length per strategy; a strategy
    with no chunks reports zeros. The median is exact and distributed."""
    from tessera.functions.quantiles import exact_quantiles

    # the chunks are made once; the figures need how many there are of each length
    lens = chunks.groupBy("strategy", F.length("page_content").alias("len")).agg(F.count(F.lit(1)).alias("c"))
    lens = cut_lineage(lens.where("len is not null"), "lengths")
    basic = lens.groupBy("strategy").agg((F.sum(F.col("len") * F.col("c")) / F.sum("c")).alias("mean"), F.min("len").alias("min"), F.max("len").alias("max"))
    med = exact_quantiles(lens, ["strategy"], "len", [0.5], prefix="median", weight="c")
    spark = chunks.sparkSession
    names = spark.createDataFrame([(s,) for s in strategies], "strategy string")
    return (names.join(med, "strategy", "left").join(basic, "strategy", "left")
            .select("strategy", F.coalesce("n", F.lit(0)).cast("bigint").alias("count"),
                    F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce("median50", F.lit(0.0)).alias("median"),
                    F.coalesce("min", F.lit(0)).cast("bigint").alias("min"),
                    F.coalesce("max", F.lit(0)).cast("bigint").alias("max")))


def pick_comparison_files(docs: DataFrame, k: int = 2, priority_prefixes=("oss/langchain/", "oss/langgraph/")) -> DataFrame:
    """K8: length 3000..15000 with >= 3 ``\\n## ``; if none qualify, length
    2000..20000. Ranked by (priority prefix, header count) desc, ties in path
    order; top k."""
    n = F.length("page_content")
    hdr = F.regexp_count("page_content", F.lit("\n## "))
    prio = F.when(F.lit(False), 1)
    for p in priority_prefixes:
        prio = prio.when(F.col("source_path").startswith(p), 1)
    prio = prio.otherwise(0)
    t1 = (n >= 3000) & (n <= 15000) & (hdr >= 3)
    t2 = (n >= 2000) & (n <= 20000)
    c = docs.select("source_path", "page_content", hdr.alias("n_headers"), prio.alias("priority"),
                    F.when(t1, 1).when(t2, 2).alias("tier")).where(F.col("tier").isNotNull())
    has_t1 = c.where(F.col("tier") == 1).select(F.count(F.lit(1))).scalar()
    c = c.where(F.col("tier") == F.when(has_t1 > 0, F.lit(1)).otherwise(F.lit(2)))
    return c.orderBy(F.col("priority").desc(), F.col("n_headers").desc(), F.col("source_path")).limit(k)


def chunks_for_source(chunks: DataFrame, source_path: str) -> DataFrame:
    """K9."""
    return chunks.where(F.col("source_path") == source_path)


def semantic_pool(docs: DataFrame, picked: DataFrame, n: int = 5, lo: int = 2000, hi: int = 12000) -> DataFrame:
    """Picked files first, then corpus (path) order with length lo..hi, no
    duplicates, until n files."""
    first = picked.select("source_path", F.lit(0).alias("tier"))
    rest = (docs.where((F.length("page_content") >= lo) & (F.length("page_content") <= hi))
            .select("source_path", F.lit(1).alias("tier")).join(first.select("source_path"), "source_path", "left_anti"))
    return first.unionByName(rest).orderBy("tier", "source_path").limit(n)


def sample_rows(chunks: DataFrame, per: int = 4, width: int = 400) -> DataFrame:
    """First ``per`` chunks per (file, strategy); text stripped, newlines
    marked, cut at ``width`` with an ellipsis."""
    w = Window.partitionBy("source_path", "strategy").orderBy("chunk_idx")
    r = chunks.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per)
    t = F.replace(F.regexp_replace("page_content", r"(?U)^\s+|\s+$", ""), F.lit("\n"), F.lit(" ⏎ "))
    return r.select("source_path", "strategy", "chunk_idx",
                    F.when(F.length(t) <= width, t).otherwise(F.concat(F.substring(t, 1, width), F.lit(" …"))).alias("preview"))


__all__ = ["recursive_split", "fixed_split", "chunk_fixed", "chunk_recursive", "chunk_markdown", "chunk_semantic",
           "chunk_all", "chunk_stats", "pick_comparison_files", "semantic_pool", "sample_rows", "chunk_id",
           "html_to_markdown", "chunks_for_source", "STRATEGIES"]
