"""Exact dedup, mixing and archives against brute force, with nulls, ties, repeated rows and clashing names."""

from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import exact_dedup as E
from tessera.llm import mixing as M
from tessera.llm import warc as W
from tessera.session import checkpoint_dir

DOCS = "doc_id long, text string, source string, dig string, salt int, _p int"


def _docs(spark, rows):
    """Extra columns that are named like the operators' own."""
    return spark.createDataFrame([(i, t, s, "x", 1, 2) for i, t, s in rows], DOCS).repartition(3)


ROWS = [(1, "a b c", "s"), (2, "abc", "s"), (3, "ab\tc ", "t"), (4, None, None), (5, "", "t"), (6, " \n", "t"), (7, "ABC", "s"),
        (8, "x" * 100_000, "u"), (9, "x" * 100_000, "u"), (None, "abc  ", "s"), (3, "ab\tc ", "t"), (-5, "zz", "é"), (-(2**63), "z z", "s"), (2**63 - 1, "zz ", "s")]


def _expected(rows):
    norm = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\f\r")
    groups: dict = {}
    for i, t, _ in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t, _ in rows:
        g = groups[norm(t)]
        keep = min(g)[3]
        out.append((i, keep, len(g), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return out


_key = lambda r: repr(r)


def test_exact_labels_equal_brute_force(spark):
    got = [tuple(r) for r in E.label_copies(_docs(spark, ROWS)).collect()]
    assert sorted(got, key=_key) == sorted(_expected(ROWS), key=_key)


def test_exact_texts_are_compared_where_digests_collide(spark):
    weak = lambda c: F.substring(F.sha2(c, 256), 1, 1)
    got = [tuple(r)[:4] for r in E.label_copies(_docs(spark, ROWS), digest=weak, salts=3).collect()]
    assert sorted(got, key=_key) == sorted([r[:4] for r in _expected(ROWS)], key=_key)


def test_exact_filter_keeps_one_row_of_each_group_with_its_columns(spark):
    got = E.drop_copies(_docs(spark, ROWS))
    assert got.columns == ["doc_id", "text", "source", "dig", "salt", "_p"]
    keeps = sorted({r[1] for r in _expected(ROWS)})
    assert sorted(r.doc_id for r in got.collect()) == keeps


def test_exact_main_path_runs_no_python(spark):
    plan = E.label_copies(_docs(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_exact_empty_table(spark):
    assert E.label_copies(_docs(spark, [])).count() == 0 and E.drop_copies(_docs(spark, [])).count() == 0


def _fill(sizes, weights, cap):
    """Targets by repeated resharing."""
    budget, open_ = sum(sizes), set(range(len(sizes)))
    target = [0.0] * len(sizes)
    while open_:
        left = budget - sum(t for i, t in enumerate(target) if i not in open_)
        w = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / w for i in open_}
        above = {i for i in open_ if share[i] > cap * sizes[i]}
        for i in above or open_:
            target[i] = min(share[i], cap * sizes[i])
        if not above:
            break
        open_ -= above
    return target


@pytest.mark.parametrize("sizes", [[100, 1, 1, 1, 50, 0], [7], [1, 1000, 1], [5, 5, 5, 5, 5, 5, 5]])
def test_targets_equal_repeated_resharing(spark, sizes):
    s = spark.createDataFrame([(chr(97 + i), n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = [r.target for r in M.source_targets(s).orderBy("no").collect()]
    want = _fill(sizes, [[5, 2, 1][i % 3] for i in range(len(sizes))], 3)
    assert got == pytest.approx(want)


def test_mix_meets_targets_with_a_hot_source_and_reruns_agree(spark):
    rows = [(i, "w " * (i % 9), "hot" if i % 3 else f"s{i % 5}") for i in range(1500)] + [(5000, None, None), (5001, "a b", None), (7, "w", "hot")]
    got = M.mix(_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by: dict = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
        assert r.taken == r.epochs * r.size and r.epochs <= 3
    for s, rs in by.items():
        assert sum(r.size for r in rs) == rs[0].source_size
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(r.size for r in rs) / 2 + 1e-6
    again = M.mix(_docs(spark, rows).repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    docs = M.mixed_documents(_docs(spark, rows))
    assert docs.columns == ["doc_id", "text", "source", "dig", "salt", "_p"]
    assert docs.count() == sum(r.epochs for r in got)


def test_mix_of_an_empty_table_and_of_empty_texts(spark):
    assert M.mix(_docs(spark, [])).count() == 0
    got = M.mix(_docs(spark, [(1, "", "a"), (2, None, "b")])).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0), (0, 0.0)]


PAGES = [(5, "u5", "<p>same</p>"), (3, "u3", "<p>same</p>"), (4, None, None), (9, "u\r\nX-Bad: 1", ""), (3, "u3", "<p>same</p>"), (None, "n", "<p>ü\r\n\r\nWARC/1.1\r\n</p>"),
         (7, "u7", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (8, "u8", "\n" * 50_000)]


def test_archives_round_trip_and_resolve_revisits(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, rid string").repartition(3)
    got = W.archive_pages(pages).collect()
    sha = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    want = sorted((i is None, i or 0, len((h or "").encode()), sha(h)) for i, _, h in PAGES)
    assert sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest) for r in got) == want
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got if r.record_type == "revisit") == [
        (3, "revisit", 3), (5, "revisit", 3), (9, "revisit", 4)]


def test_small_payloads_stay_responses_and_empty_tables_work(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert {r.record_type for r in W.archive_pages(pages, min_bytes=1000).collect()} == {"response"}
    assert W.archive_pages(pages.limit(0)).count() == 0


def test_payloads_survive_both_archives(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").where("page_id is not null")
    base = f"{checkpoint_dir(spark)}/warc-test"
    mark = W.write_archive(pages, f"{base}/a")
    assert sorted(r.payload for r in W.read_archive(spark, f"{base}/a", mark).collect()) == sorted(h or "" for i, _, h in PAGES if i is not None)
    again = W.deduplicate_archive(spark, f"{base}/a", mark, f"{base}/b")
    kept = [r.payload for r in W.read_archive(spark, f"{base}/b", again).collect() if r.type == "response"]
    assert sorted(kept) == sorted({h or "" for i, _, h in PAGES if i is not None})
