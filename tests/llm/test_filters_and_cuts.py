"""URL filters, the filter audit and fill-in-the-middle against brute force, with odd rows, restarts and large lists."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import fill_middle as M
from tessera.llm import filter_audit as A
from tessera.llm import url_filter as U
from tessera.session import checkpoint_dir

# ------------------------------------------------------------------------------------------------ URL filters

PAGES = "page_id long, url string, host string, path string, keys string, times int, rule string"
LIST = "host string, path string, verdict string"
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("WWW.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
         ("b.net", "/", "allow"), ("a.b.net", "", "block"), ("dup.org", "/x", "allow"), ("dup.org", "/x", "block"), (None, "/n", "block"), ("skip.org", "/", None)]
URLS = ["https://WWW.Example.com/en/x?q", "http://example.com/en", "http://m.example.com/en/", "http://a.net/es/", "x://b.net/es/", "q://a.b.net?x", None, "", "no url",
        "http://example.com", "://net/fr/1", "http://dup.org/xy", "http://skip.org/", "http://host./n", "a://b://com/", "http://com.evil/en/#://x", "h://x.com/" + "é" * 9_000,
        "h://" + "a." * 20_000 + "example.com/en/" + "y/" * 20_000, "h://ünï.COM/\n/", "http://user@Example.COM:80/en/", "https://example.com/en/?a://b"]


def _pages(spark, urls):
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, "http://example.com/en/"), (0, urls[0]), (0, urls[0])] if urls else []
    return spark.createDataFrame([(*r, "h", "p", "k", 1, "r") for r in rows], PAGES).repartition(3), rows


def _judged(url, rules, default="allow"):
    at = (url or "").find("://")
    rest = (url or "")[at + 3:] if at >= 0 else ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    lower = lambda h: "".join(c.lower() if "A" <= c <= "Z" else c for c in h or "")
    host, fits = lower(host), []
    for h, p, v in rules:
        h, p = lower(h), p or ""
        if v is not None and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), len(h), h + p, v))
    return (host, path, *(max(fits)[2:] if fits else (None, default)))


@pytest.mark.parametrize("entries, blocks", [(500_000, U.MAX_BLOCKS), (0, U.MAX_BLOCKS), (0, 1)])
def test_url_verdicts_equal_brute_force(spark, entries, blocks):
    pages, rows = _pages(spark, URLS)
    got = U.judge(pages, spark.createDataFrame(RULES, LIST), broadcast_entries=entries, max_blocks=blocks)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter((i, *_judged(u, RULES)) for i, u in rows)


def test_url_lists_that_are_empty_and_tables_that_are(spark):
    pages, rows = _pages(spark, URLS)
    none = U.judge(pages, spark.createDataFrame([], LIST), default="block")
    assert collections.Counter(map(tuple, none.collect())) == collections.Counter((i, *_judged(u, [], "block")) for i, u in rows)
    assert U.judge(_pages(spark, [])[0], spark.createDataFrame(RULES, LIST)).count() == 0


def test_the_filter_misses_nothing_and_passes_little(spark):
    listed = U.canonical_list(spark.range(20_000).select(F.concat(F.lit("h"), F.col("id").cast("string"), F.lit(".org")).alias("host"), F.lit("/p").alias("path"), F.lit("block").alias("verdict")))
    blocks = 20_000 * U.BITS_PER_KEY // 256
    words = U.bloom_words(listed, blocks).first()["words"]
    assert len(words) == blocks * U.WORDS
    w = F.lit(None).cast("array<bigint>")
    one = spark.createDataFrame([(words,)], "words array<bigint>")
    keys = spark.range(40_000).select(F.concat(F.lit("h"), F.col("id").cast("string"), F.lit(".org")).alias("h"), F.lit("/p").alias("p"), (F.col("id") < 20_000).alias("listed"))
    w = one.scalar()
    got = {r.listed: r.n for r in keys.where(U.may_hold(w, F.col("h"), F.col("p"), blocks)).groupBy("listed").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got[True] == 20_000 and got.get(False, 0) < 0.01 * 20_000


def test_url_main_path_is_native_and_shuffles_only_possible_hits(spark):
    pages, _ = _pages(spark, URLS)
    for entries in (500_000, 0):
        plan = U.judge(pages, spark.createDataFrame(RULES, LIST), broadcast_entries=entries)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", plan)
        branch = plan[plan.rindex("Filter"):]  # the rows without a possible hit
        assert "Exchange" not in branch


# ------------------------------------------------------------------------------------------------ filter audit

DOCS = "doc_id long, text string, source string, mask int, key string, part string, n long"
LETTERS = "ABCDE"


def _fails(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (len(ws) < 200, 100 * len(set(ws)) < 50 * len(ws), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text)))


def _audit_brute(rows, labels):
    least: dict = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    own: dict = collections.defaultdict(list)
    for i, t, s in rows:
        fails = [*_fails(t or ""), i is not None and i > least[t or ""]]
        own[s or ""].append((fails, *labels.get(i, (0, 0))))
    out, removed_by = [], collections.Counter()
    for part, docs in own.items():
        for order in map("".join, itertools.permutations(LETTERS)):
            left = list(docs)
            for step, letter in enumerate(order, 1):
                f = LETTERS.index(letter)
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                removed_by[part, letter] += len(gone)
                out.append((part, order, step, len(left), len(gone), sum(d[0][f] for d in docs) - len(gone), sum(d[0][f] and sum(d[0]) == 1 for d in docs),
                            sum(d[1] for d in gone), sum(d[2] for d in gone)))
    return sorted((*r, removed_by[r[0], r[1][r[2] - 1]]) for r in out)


def _audit_rows(n, seed=1):
    rng = random.Random(seed)
    long = " ".join(f"w{i}" for i in range(210))
    texts = [long, "AAA bbb " * 150, "short", "", None, long + " #", "X" * 40, "é " * 300, "a\x0bb\x1cc " * 90, long.upper()]
    rows = [(i, rng.choice(texts[:3] * 2 + texts), rng.choice(["hot", "hot", "s1", "", None])) for i in rng.sample(range(-n, n), n)]
    rows += [(None, "short", "s1"), (None, long, None), rows[3], (rows[5][0], rows[5][1], "s9"), (n + 1, "w " * 100_000, "s1")]
    return rows, {i: (rng.randint(0, 1), rng.randint(0, 1)) for i in range(-n, n, 3)}


def _store(spark, rows, files):
    """A table of so many files, whose times follow no id."""
    path = f"{checkpoint_dir(spark)}/audit-{uuid.uuid4().hex}"
    spark.createDataFrame([(*r, 7, "k", "p", 1) for r in rows], DOCS).repartition(files).write.parquet(path)
    return path


def _labels(spark, labels):
    rows = [(i, q, t) for i, (q, t) in labels.items()] + [(None, 1, 1)] + [(i, 0, 0) for i in list(labels)[:5]] + [(10**9, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("batches", [1, 5])
def test_audit_equals_brute_force_in_any_number_of_batches(spark, batches, monkeypatch):
    monkeypatch.setattr(A, "TEXTS_PER_KEY", 3)
    rows, labels = _audit_rows(120)
    folder = f"{checkpoint_dir(spark)}/audit-{uuid.uuid4().hex}"
    got = A.audit(spark, _store(spark, rows, 6), _labels(spark, labels), folder, batches=batches)
    assert sorted(map(tuple, got.collect())) == _audit_brute(rows, labels)
    changes = spark.read.parquet(f"{folder}/counters/batch=*")
    if batches > 1:
        assert changes.where("delta < 0").count() > 0  # earlier masks were retracted
    assert changes.agg(F.sum("delta")).first()[0] == len(rows)


def test_audit_goes_on_with_new_files_and_keeps_its_state(spark):
    rows, labels = _audit_rows(80, seed=2)
    path, folder, lab = _store(spark, rows[40:], 2), f"{checkpoint_dir(spark)}/audit-{uuid.uuid4().hex}", _labels(spark, labels)
    A.audit(spark, path, lab, folder).count()
    spark.createDataFrame([(*r, 7, "k", "p", 1) for r in rows[:40]], DOCS).coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    for _ in range(2):  # the second call finds nothing new
        A.stream_counters(A.file_stream(spark, path, schema), lab, 1, folder)
    changes = spark.read.parquet(f"{folder}/counters/batch=*")
    got = A.report(changes.groupBy(*A.COUNTED).agg(F.sum("delta").alias("delta")), LETTERS)
    assert sorted(map(tuple, got.collect())) == _audit_brute(rows, labels)


def test_audit_of_an_empty_table(spark):
    folder = f"{checkpoint_dir(spark)}/audit-{uuid.uuid4().hex}"
    assert A.audit(spark, _store(spark, [], 1), _labels(spark, {}), folder).count() == 0


def test_copies_of_a_batch_become_one_row_for_their_state():
    import pandas as pd

    frame = pd.DataFrame({"key": 1, "digest": "d", "no_id": [False] * 900 + [True] * 100, "id": [*range(1, 901), *[0] * 100], "part": "p", "mask": 3, "good": 0, "toxic": 0})
    got = pd.concat(A.merge_copies([frame, frame.iloc[:0]]))
    assert sorted(zip(got["no_id"], got["later"], got["id"], got["n"])) == [(False, False, 1, 1), (False, True, 0, 899), (True, False, 0, 100)]


# ------------------------------------------------------------------------------------------------ fill in the middle


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aZ[`{ 1é\n𝄞", max_size=200), st.integers(0, 2**32), st.integers(0, 2**32))
def test_cuts_equal_those_of_the_unit_list(text, h1, h2):
    units = re.findall(r"(?s)[A-Za-z]+|[^A-Za-z]", text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    assert M.cut(text, h1, h2) == (len(units), len("".join(units[:a])), len("".join(units[:b])))


def test_every_rank_is_found_and_few_links_are_looked_at():
    rng = random.Random(6)
    for n in (0, 1, 2, 7, 8, 9, 64, 1_000):
        text = "".join(rng.choice(["ab", "c", "1", " ", "é"]) for _ in range(n))
        units = re.findall(r"(?s)[A-Za-z]+|[^A-Za-z]", text)
        for fan in (2, 8):
            listed = M.SkipList(*M.unit_starts(text), fan)
            assert [listed.place(r)[0] for r in range(len(units) + 1)] == [0, *itertools.accumulate(map(len, units))]
    listed = M.SkipList(*M.unit_starts("ab, " * 500_000))
    looked = [listed.place(rng.randrange(listed.units + 1))[1] for _ in range(300)]
    assert len(listed.lanes) >= 5 and sum(looked) / len(looked) < 120 and max(looked) < 600


FIM_ROWS = [(i, " ".join(["Hello", "world,", "x1", "ünï", "𝄞"][: 1 + i % 5] * (i % 7))) for i in range(-60, 60)] + [
    (1000, None), (1001, ""), (None, "no id at all"), (1002, "has <P> in it"), (1003, "<M>"), (1004, "a <S"), (1005, "<P" * 50 + ">S>"), (1006, "x" * 300_000), (5, "a b c"), (5, "a b c")]


def test_outputs_equal_brute_force_and_restore_the_text(spark):
    docs = spark.createDataFrame([(*r, "n", "f", "o") for r in FIM_ROWS], "doc_id long, text string, n string, form string, output string").repartition(3)
    got = M.transform(docs).withColumn("back", M.restore(F.col("output"), F.col("form"))).collect()
    want = collections.Counter()
    for i, t in FIM_ROWS:
        t = t or ""
        h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
        u = re.findall(r"(?s)[A-Za-z]+|[^A-Za-z]", t)
        a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
        p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            want[i, len(u), "plain", None, None, t, t] += 1
        else:
            form = "spm" if h4 % 100 < 20 else "psm"
            want[i, len(u), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}", t] += 1
    assert collections.Counter(map(tuple, got)) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert M.transform(docs.limit(0)).count() == 0
