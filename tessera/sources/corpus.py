"""Document selection, corpus scan, front-matter and metadata.

Front-matter is handled in column expressions: the block is cut with
``locate``/``substring`` and its top-level ``key: value`` lines (with inline
``[a, b]`` or ``- a`` block lists) become a ``map<string,string>``. Deeper YAML
(nested mappings, anchors, multi-line scalars) is not interpreted; see README.
"""

from __future__ import annotations

import functools
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import let, override

# Document suffixes and the default selection rules.
DOC_SUFFIXES = (".md", ".mdx")
DEFAULT_INCLUDE = ("oss/",)
DEFAULT_EXCLUDE = ("oss/javascript/",)
MAX_PAGES = 500

KEY_LINE = r"^([A-Za-z0-9_][A-Za-z0-9_ .-]*):(?:\s+(.*)|\s*)$"


# --------------------------------------------------------------------------- S1-S3


def select_manifest(manifest: DataFrame, root: str, suffixes=DOC_SUFFIXES, include=DEFAULT_INCLUDE,
                    exclude=DEFAULT_EXCLUDE) -> DataFrame:
    """Blobs under ``root/``, suffix in ``suffixes`` (case-insensitive), relative
    path starting with any include prefix (none = all) and containing no
    exclude substring. One predicate, so it reaches the scan."""
    rel = F.expr(f"substring(path, {len(root) + 2})") if root else F.col("path")
    cond = (F.col("type") == "blob") & (F.col("path").startswith(root + "/") if root else F.lit(True))
    suffix_re = "(?i)(" + "|".join(s.replace(".", "\\.") for s in suffixes) + ")$"
    cond = cond & F.col("path").rlike(suffix_re)
    if include:
        cond = cond & functools.reduce(lambda a, b: a | b, [rel.startswith(p) for p in include])
    for x in exclude:
        cond = cond & ~rel.contains(x)
    return manifest.where(cond).withColumn("rel_path", rel)


def page_cap(manifest: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """The first ``max_pages`` paths in path order (a top-N: sort-limit)."""
    return manifest.orderBy("path").limit(max_pages)


def fetch_plan(manifest: DataFrame, stored: DataFrame, key: str = "path") -> DataFrame:
    """S3: ``status`` = 'hit' for items already stored, 'fetch' for the rest."""
    hits = manifest.join(stored.select(key).distinct(), key, "left_semi").withColumn("status", F.lit("hit"))
    todo = manifest.join(stored.select(key), key, "left_anti").withColumn("status", F.lit("fetch"))
    return hits.unionByName(todo)


# --------------------------------------------------------------------------- S4


def scan_corpus(spark: SparkSession, root: str, suffixes=DOC_SUFFIXES) -> DataFrame:
    """One row per file under ``root`` (recursive) with a doc suffix;
    ``source_path`` relative to root, ``file_name``. A missing root raises.

    File paths come URL-encoded from the scan; they are decoded, and ``root`` (a local path or a URI with its
    scheme and authority) is cut off by its length."""
    local = root[len("file:"):] if root.startswith("file:") else root
    local = "/" + local.lstrip("/") if root.startswith("file:") else local
    remote = "://" in root and not root.startswith("file:")
    if not remote and not os.path.exists(local):
        raise FileNotFoundError(f"doc root does not exist: {root}")
    base = (root if remote else os.path.abspath(local)).rstrip("/") + "/"
    df = (spark.read.option("recursiveFileLookup", "true").text(base, wholetext=True)
          .select(F.col("value").alias("text"), F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path")))
    if not remote:
        df = df.withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    suffix_re = "(?i)(" + "|".join(s.replace(".", "\\.") for s in suffixes) + ")$"
    return (df.where(F.col("path").rlike(suffix_re))
            .select(F.substring("path", len(base) + 1, 1 << 30).alias("source_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"), "text"))


# --------------------------------------------------------------------------- S5 / S6


def _scalar(v: Column) -> Column:
    """YAML scalar as Python ``str()`` would print it; null for null/~/empty."""
    t = F.trim(v)
    unq = F.regexp_replace(t, r"^'(.*)'$|^\"(.*)\"$", "$1$2")
    low = F.lower(t)
    return (F.when((t == "") | low.isin("null", "~"), F.lit(None).cast("string"))
            .when(low.isin("true", "yes", "on"), F.lit("True"))
            .when(low.isin("false", "no", "off"), F.lit("False"))
            .otherwise(unq))


def _inline_list(v: Column) -> Column:
    inner = F.regexp_extract(v, r"^\s*\[(.*)\]\s*$", 1)
    items = F.filter(F.transform(F.split(inner, ","), lambda x: _scalar(x)), lambda x: x.isNotNull())
    return F.array_join(items, ", ")


def split_frontmatter(text: Column) -> Column:
    """S5 + S6: struct(body string, metadata map<string,string>).

    Only text starting with ``---`` has front-matter; it ends at the first
    ``\\n---`` after position 3. The body loses its leading newlines. An
    unterminated block, or one that is not a mapping, leaves the text unchanged
    with an empty map; an empty block is removed with an empty map.
    """
    t = F.coalesce(text, F.lit(""))
    end = F.locate("\n---", t, 4)  # 1-based; 0 = not found (Python find from index 3)
    has = t.startswith("---") & (end > 0)
    raw = F.regexp_replace(F.substring(t, F.lit(4), F.greatest(end - 4, F.lit(0))), r"(?U)^\s+|\s+$", "")
    body = F.regexp_replace(F.substring(t, end + 4, 1 << 30), "^\n+", "")
    empty = F.create_map().cast("map<string,string>")
    return let(_parse_block(raw), lambda p: F.when(has & p["ok"], F.struct(body.alias("body"), p["m"].alias("metadata")))
               .otherwise(F.struct(t.alias("body"), empty.alias("metadata"))))


def _meta(lines: Column) -> Column:
    n = F.size(lines)
    keys = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                    lambda j: F.coalesce(F.try_element_at(lines, j), F.lit("")).rlike(KEY_LINE))
    nk = F.size(keys)

    def entry(k: Column) -> Column:
        p = F.try_element_at(keys, k)
        nxt = F.when(k < nk, F.try_element_at(keys, k + 1)).otherwise(n + 1)
        line = F.try_element_at(lines, p)
        key = F.trim(F.regexp_extract(line, KEY_LINE, 1))
        inline = F.regexp_extract(line, KEY_LINE, 2)
        block = F.transform(
            F.filter(F.slice(lines, p + 1, F.greatest(nxt - p - 1, F.lit(0))), lambda x: x.rlike(r"^\s*-\s")),
            lambda x: _scalar(F.regexp_replace(x, r"^\s*-\s+", "")))
        val = (F.when(F.trim(inline).startswith("["), _inline_list(inline))
               .when(F.trim(inline) != "", _scalar(inline))
               .when(F.size(block) > 0, F.array_join(F.filter(block, lambda x: x.isNotNull()), ", ")))
        return F.struct(key.alias("key"), val.alias("value"))

    entries = F.transform(F.sequence(F.lit(1), F.greatest(nk, F.lit(1))), entry)
    entries = F.filter(entries, lambda e: e["value"].isNotNull() & (nk > 0))
    # a key that is given again takes its last value
    last = let(entries, lambda es: F.filter(es, lambda e, i: ~F.exists(
        F.slice(es, i + 2, F.size(es)), lambda later: later["key"] == e["key"])))
    return F.map_from_entries(last)


def _parse_block(fm: Column) -> Column:
    """struct(ok: the block is a mapping (or empty), m: its top-level entries)."""
    return let(F.filter(F.split(fm, "\n"), lambda x: (F.trim(x) != "") & ~F.trim(x).startswith("#")),
               lambda lines: F.struct(
                   ((F.size(lines) == 0) | F.coalesce(F.try_element_at(lines, F.lit(1)).rlike(KEY_LINE), F.lit(False))).alias("ok"),
                   _meta(lines).alias("m")))


def load_documents(files: DataFrame) -> DataFrame:
    """S4 -> S5/S6: A1 Document rows (``source_path, file_name, page_content, metadata``)."""
    fm = files.select("source_path", "file_name", split_frontmatter(F.col("text")).alias("fm"))
    meta = override(F.col("fm.metadata"),
                    F.create_map(F.lit("source_path"), F.col("source_path"), F.lit("file_name"), F.col("file_name")))
    return fm.select("source_path", "file_name", F.col("fm.body").alias("page_content"), meta.alias("metadata"))


# --------------------------------------------------------------------------- S7 / S11


def corpus_stats(docs: DataFrame, text_col: str = "page_content") -> DataFrame:
    """Documents, total characters, average per document with a max(n, 1) guard."""
    return docs.agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("total_chars")) \
        .withColumn("avg_chars", F.col("total_chars") / F.greatest(F.col("n_docs"), F.lit(1)))


def sanitize_metadata(m: Column, value_type: str = "string") -> Column:
    """Scalar values pass as strings, anything else is serialised to JSON."""
    if value_type == "string":
        return m
    return F.transform_values(m, lambda k, v: F.to_json(v))
