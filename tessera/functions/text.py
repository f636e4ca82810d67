"""Shared column expressions (all JVM-side built-ins).

Regex flags: patterns that mirror Python ``re`` behaviour are prefixed with
``(?uUd)``-style embedded flags so Java matches Python on Unicode word
boundaries, Unicode case folding and ``.`` (which must stop only at ``\\n``).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python-compatible flag prefixes for java.util.regex.
PY_RE = "(?uUd)"
PY_RE_I = "(?iuUd)"
PY_RE_M = "(?muUd)"

# Fixed value: the characters Python's ``str.split()`` treats as whitespace,
# as one explicit class (faster than a Unicode-mode ``\s``).
WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
WS_ONLY = r"^[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*$"
WS_CHAR = r"^[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]$"


# Texts that a Python worker takes up at once, of so many characters together.
RUN_ROWS, RUN_CHARS = 512, 1 << 20


def text_runs(texts: list, rows: int = RUN_ROWS, chars: int = RUN_CHARS) -> Iterator[list]:
    """The texts (or None) in runs of at most ``rows`` texts and ``chars`` characters; a longer text stands alone."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > at and (i - at >= rows or held + n > chars):
            yield texts[at:i]
            at, held = i, 0
        held += n
    if at < len(texts):
        yield texts[at:]


def tokens(text: Column | str) -> Column:
    """``str.split()``: whitespace-separated, case-kept, empties dropped."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(c, WS), lambda t: t != F.lit(""))


def token_rows(df, keep: list[str], text: Column | str, out: str = "term"):
    """One row per whitespace token (codegen-friendly: explode, then drop empties)."""
    c = F.col(text) if isinstance(text, str) else text
    return df.select(*keep, F.explode_outer(F.split(c, WS)).alias(out)).where(F.col(out) != "")


def source_path(source: Column, doc_id: Column) -> Column:
    """File-grain identity of a driver document: ``source/doc_id``."""
    return F.concat_ws("/", source, doc_id.cast("string"))


def content_key(text: Column) -> Column:
    """Dedupe key of a passage (R5). Only compared within one query's candidates."""
    return F.xxhash64(text)


def token_hash(token: Column) -> Column:
    """Portable 32-bit token hash: first 8 hex digits of md5 (same value in any SQL engine)."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Inside a higher-order function an outer expression is re-evaluated per
    element; binding it first keeps per-row work linear.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def override(base: Column, over: Column) -> Column:
    """The two maps as one; where both hold a key, ``over`` wins."""
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(over), k)), over)


def round_double(x: Column, digits: int) -> Column:
    """Round half up on the scaled double ``x * 10^digits``. The product itself is
    rounded to a double, so next to a tie the last digit can differ by one from
    a rounding of the exact binary value (Python's ``round``)."""
    s = float(10 ** digits)
    return F.signum(x) * F.floor(F.abs(x) * s + 0.5) / s
