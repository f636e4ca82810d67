"""V, J and D operators: retrieval metrics, judged-score means, evaluation-set preparation.

Inputs are long tables; every metric is conditional aggregation over a rank
column, so one retrieval at max(k) serves every k (R9).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.prefix import global_positions
from tessera.functions.text import tokens

KS = (3, 5, 10)

# --------------------------------------------------------------------------- D6


#: Bytes of question texts that a task gets as a whole.
MATCH_BYTES = 64 << 20


def containment_truth(questions: DataFrame, docs: DataFrame, q_text: str = "question",
                      d_text: str = "page_content", match_bytes: int = MATCH_BYTES) -> DataFrame:
    """``(query_id, source_path)`` for every document whose text contains the question.

    Questions of at most ``match_bytes`` go to every task, which finds all of them in one pass over each document
    as it streams past (:class:`Matcher`); no document is shuffled. More questions go through an exact token route:
    a question with three or more
    whitespace tokens has whole interior tokens, and any containing document
    has each of them as a whole token; the question's rarest interior token
    (lowest document frequency, so a hot token is never the join key unless
    every token is hot) selects candidate documents through an equi-join on
    narrow ``(source_path, term)`` rows, and only candidates get their text
    back for the ``contains`` check. Questions with fewer tokens are matched in blocks
    of ``match_bytes``, with a pass over the documents for each block.
    """
    q = questions.select("query_id", F.col(q_text).alias("q")).where("q is not null")
    d = docs.select("source_path", F.col(d_text).alias("t"))
    bytes_ = lambda x: x.agg(F.coalesce(F.sum(F.octet_length("q") + 16), F.lit(0))).first()[0]
    if bytes_(q) <= match_bytes:
        return _matched(q, d)
    qt = q.withColumn("toks", tokens(F.col("q")))
    interior = qt.where(F.size("toks") >= 3).select(
        "query_id", F.explode(F.slice("toks", 2, F.size("toks") - 2)).alias("term"))
    doc_terms = d.select("source_path", F.explode(F.array_distinct(tokens(F.col("t")))).alias("term"))
    df_t = doc_terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    pick = (interior.join(df_t, "term", "left").groupBy("query_id")
            .agg(F.min_by("term", F.coalesce("df", F.lit(0))).alias("term")))
    cand = doc_terms.join(pick, "term").select("query_id", "source_path")
    hits = (cand.join(d, "source_path").join(q, "query_id")
            .where(F.col("t").contains(F.col("q"))).select("query_id", "source_path"))
    short = qt.where(F.size("toks") < 3).select("query_id", "q")
    blocks = -(-bytes_(short) // max(1, match_bytes))
    for i in range(blocks):
        block = short.where(F.pmod(F.xxhash64("query_id", "q"), F.lit(blocks)) == i)
        hits = hits.unionByName(_matched(block, d))
    return hits


def _matched(q: DataFrame, d: DataFrame) -> DataFrame:
    from tessera.operators.contains import Matcher

    rows = q.collect()  # bounded by the caller
    shared = q.sparkSession.sparkContext.broadcast(([r["query_id"] for r in rows], [r["q"] for r in rows]))
    schema = T.StructType([q.schema["query_id"], d.schema["source_path"]])

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, texts = shared.value
        matcher = Matcher(texts)
        for b in batches:
            found = [(ids[i], path) for path, t in zip(b["source_path"], b["t"]) if t is not None for i in matcher.find(t)]
            yield pd.DataFrame(found, columns=["query_id", "source_path"])

    return d.select("source_path", "t").mapInPandas(run, schema)


def qa_table(questions: DataFrame, truth: DataFrame, docs: DataFrame) -> DataFrame:
    """A3 QA rows: ``ground_truth_contexts`` (file grain, sorted) and a difficulty.

    Difficulty here is the language of the first containing document (missing
    when nothing contains the question, reported as ``unknown``).
    """
    first = (truth.join(docs.select("source_path", "doc_id", "lang"), "source_path")
             .groupBy("query_id").agg(F.array_sort(F.collect_set("source_path")).alias("ground_truth_contexts"),
                                      F.min_by("lang", "doc_id").alias("difficulty")))
    return (questions.join(first, "query_id", "left")
            .withColumn("ground_truth_contexts",
                        F.coalesce("ground_truth_contexts", F.array().cast("array<string>"))))


# --------------------------------------------------------------------------- V1-V5


def first_hit(ranked: DataFrame, truth: DataFrame, keys: list[str]) -> DataFrame:
    """V1: smallest rank whose source is in the question's ground truth.

    ``ranked(keys..., query_id, rank, source_path)``; ``truth(query_id, source_path)``.
    Questions without a hit are absent here (left-joined back by callers).
    """
    return (ranked.join(truth, ["query_id", "source_path"])
            .groupBy(*keys, "query_id").agg(F.min("rank").alias("first_rank")))


def _with_combos(df: DataFrame, keys: list[str], combos: list[dict]) -> DataFrame:
    """Pair every row with every combination (a literal list, exploded per row; no join)."""
    arr = F.array(*[F.struct(*[F.lit(c[k]).alias(k) for k in keys]) for c in combos])
    return df.withColumn("_c", F.explode(arr)).select("*", *[F.col(f"_c.{k}").alias(k) for k in keys]).drop("_c")


def hit_mrr(qa: DataFrame, ranked: DataFrame, truth: DataFrame, keys: list[str],
            combos: list[dict], ks: tuple[int, ...] = KS) -> DataFrame:
    """V2-V4 (+V6/V7 through ``keys``): hit@k and MRR@k per combination.

    Every combination in ``combos`` is reported, even with zero hits. n = all QA
    rows, including those with empty ground truth (V4).
    """
    fh = first_hit(ranked, truth, keys)
    per = _with_combos(qa.select("query_id"), keys, combos).join(fh, [*keys, "query_id"], "left")
    r = F.col("first_rank")
    agg = per.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_questions"),
        *[F.sum(F.when(r <= k, 1).otherwise(0)).alias(f"h{k}") for k in ks],
        *[F.sum(F.when(r <= k, 1.0 / r).otherwise(0.0)).alias(f"r{k}") for k in ks])
    stacked = agg.select(*keys, "n_questions", F.explode(F.array(*[
        F.struct(F.lit(k).cast("bigint").alias("k"), F.col(f"h{k}").alias("hits"), F.col(f"r{k}").alias("rr"))
        for k in ks])).alias("m"))
    n = F.col("n_questions")
    return stacked.select(*keys, F.col("m.k").alias("k"), n.cast("bigint").alias("n_questions"),
                          (F.col("m.hits") / n).alias("hit_rate"), (F.col("m.rr") / n).alias("mrr"))


def hit_by_difficulty(qa: DataFrame, ranked: DataFrame, truth: DataFrame, keys: list[str],
                      combos: list[dict], max_k: int = max(KS)) -> DataFrame:
    """V5: hit@max_k by difficulty over evaluated questions (non-empty ground truth);
    missing difficulty is reported as ``unknown``."""
    fh = first_hit(ranked, truth, keys)
    evaluated = qa.where(F.size("ground_truth_contexts") > 0).select(
        "query_id", F.coalesce("difficulty", F.lit("unknown")).alias("difficulty"))
    per = _with_combos(evaluated, keys, combos).join(fh, [*keys, "query_id"], "left")
    return per.groupBy(*keys, "difficulty").agg(
        F.count(F.lit(1)).alias("n_evaluated"),
        (F.sum(F.when(F.col("first_rank") <= max_k, 1).otherwise(0)) / F.count(F.lit(1))).alias("hit_rate"))


def delta_vs_baseline(metrics: DataFrame, keys: list[str], method_col: str = "method",
                      baseline: str = "dense", value_cols: tuple[str, ...] = ("hit_rate", "mrr")) -> DataFrame:
    """Each non-baseline method minus the baseline on the same keys;
    rows without a baseline are omitted (inner join)."""
    base = metrics.where(F.col(method_col) == baseline).select(
        *keys, *[F.col(v).alias(f"_b_{v}") for v in value_cols])
    other = metrics.where(F.col(method_col) != baseline)
    return other.join(base, keys).select(
        *keys, method_col, *[(F.col(v) - F.col(f"_b_{v}")).alias(f"delta_{v}") for v in value_cols])


def wide_report(metrics: DataFrame, keys: list[str], ks: tuple[int, ...] = KS, digits: int = 3) -> DataFrame:
    """V9: one row per combination, ``hit@k`` / ``mrr@k`` columns (pivot on k)."""
    p = metrics.groupBy(*keys).pivot("k", list(ks)).agg(
        F.round(F.first("hit_rate"), digits).alias("hit"), F.round(F.first("mrr"), digits).alias("mrr"))
    out = [*keys]
    for k in ks:
        out += [F.col(f"{k}_hit").alias(f"hit_at_{k}"), F.col(f"{k}_mrr").alias(f"mrr_at_{k}")]
    return p.select(*out)


# --------------------------------------------------------------------------- J


def metric_column(columns: list[str], metric: str) -> str:
    """The column of a metric; case, ``-`` and ``_`` do not count. None or several matches raise."""
    plain = lambda x: x.lower().replace("-", "").replace("_", "")
    found = [c for c in columns if plain(c) == plain(metric)]
    if len(found) != 1:
        raise ValueError(f"metric {metric!r} matches {found or 'no column'}")
    return found[0]


def judged_means(scores: DataFrame, config_cols: list[str], metrics: list[str]) -> DataFrame:
    """Mean per metric per configuration, long form. NaN scores are skipped
    (pandas ``mean``); a metric with no value gives NaN. Metrics are matched with
    :func:`metric_column` and reported under the names that were asked for."""
    named = {m: metric_column([c for c in scores.columns if c not in config_cols], m) for m in metrics}
    long = scores.select(*config_cols, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"`{c}`").cast("double").alias("v")) for m, c in named.items()])).alias("x"))
    long = long.select(*config_cols, "x.metric", F.nanvl(F.col("x.v"), F.lit(None).cast("double")).alias("v"))
    return long.groupBy(*config_cols, "metric").agg(
        F.coalesce(F.avg("v"), F.lit(float("nan"))).alias("mean"))


def best_per_metric(means: DataFrame, config_cols: list[str]) -> DataFrame:
    """configuration(s) with the highest mean per metric (ties all win)."""
    w = Window.partitionBy("metric").orderBy(F.col("mean").desc())
    return means.where(~F.isnan("mean")).withColumn("pos", F.rank().over(w)).where(F.col("pos") == 1).drop("pos")


# --------------------------------------------------------------------------- D1-D4


def difficulty_quota(n: Column) -> Column:
    """(factual, howto, compare) counts for n questions per file.

    n = 1, 2, 3 are fixed mixes; n >= 4 uses max(1, round(.3n)), max(1, round(.4n))
    and the remainder (never below 0). Python rounds half to even: ``bround``.
    """
    f4 = F.greatest(F.lit(1), F.bround(n * 0.3).cast("int"))
    h4 = F.greatest(F.lit(1), F.bround(n * 0.4).cast("int"))
    c4 = F.greatest(F.lit(0), n - f4 - h4)
    return (F.when(n == 1, F.struct(F.lit(0).alias("factual"), F.lit(1).alias("howto"), F.lit(0).alias("compare")))
            .when(n == 2, F.struct(F.lit(1).alias("factual"), F.lit(1).alias("howto"), F.lit(0).alias("compare")))
            .when(n == 3, F.struct(F.lit(1).alias("factual"), F.lit(1).alias("howto"), F.lit(1).alias("compare")))
            .otherwise(F.struct(f4.alias("factual"), h4.alias("howto"), c4.cast("int").alias("compare"))))


def sequential_ids(df: DataFrame, order: list[Column], prefix: str = "qa_", width: int = 4) -> DataFrame:
    """D3: ``qa_0001 ...`` in one explicit order; ids beyond the width are not cut.

    A global row number is computed as partition offsets + a local index, so no
    single task sorts the whole table.
    """
    num = global_positions(df, order, "_pos").withColumn("seq_no", F.col("_pos") + 1).drop("_pos")
    s = num["seq_no"].cast("string")
    return num.withColumn("id", F.concat(F.lit(prefix), F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)))


def share_of_total(counts: DataFrame, count_col: str = "n") -> DataFrame:
    """Count and percent of the grand total (scalar subquery, no global window)."""
    total = counts.select(F.sum(count_col)).scalar()
    return counts.withColumn("pct", F.round(F.col(count_col) * 100.0 / total, 1))


# --------------------------------------------------------------------------- J1 / J4 / D2 / D5


def judge_samples(qa: DataFrame, answers: DataFrame, ranked: DataFrame, key: str = "query_id") -> DataFrame:
    """One judged sample per question -- user_input, contexts in rank order,
    response, reference. ``ranked(key, rank, text)`` holds the top-k passages
    (bounded by k per question)."""
    ctx = ranked.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))),
                                              lambda s: s["text"]).alias("retrieved_contexts"))
    return (qa.join(ctx, key, "left").join(answers, key, "left")
            .select(key, F.col("question").alias("user_input"),
                    F.coalesce("retrieved_contexts", F.array().cast("array<string>")).alias("retrieved_contexts"),
                    F.col("answer").alias("response"), F.col("reference")))


def first_questions(qa: DataFrame, n: int, order_col: str = "id") -> DataFrame:
    """The first n questions in input order (a top-N: sort-limit). Ids of D3 order by their number, whatever its width."""
    number = F.regexp_extract(F.col(order_col).cast("string"), r"(\d+)$", 1).cast("decimal(38,0)")
    return qa.orderBy(number.asc_nulls_last(), order_col).limit(n)


def mix_check(obtained: DataFrame, quota: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Requested vs obtained count per (file, difficulty); rows that differ.

    ``obtained(file, difficulty)`` one row per generated question;
    ``quota(file, factual, howto, compare)`` from :func:`difficulty_quota`.
    """
    got = obtained.groupBy(file_col, "difficulty").agg(F.count(F.lit(1)).alias("obtained"))
    want = quota.select(file_col, F.explode(F.array(*[
        F.struct(F.lit(d).alias("difficulty"), F.col(d).cast("bigint").alias("requested"))
        for d in ("factual", "howto", "compare")])).alias("q")).select(file_col, "q.difficulty", "q.requested")
    both = want.join(got, [file_col, "difficulty"], "full_outer")
    return both.select(file_col, "difficulty", F.coalesce("requested", F.lit(0)).alias("requested"),
                       F.coalesce("obtained", F.lit(0)).alias("obtained")).where(F.col("requested") != F.col("obtained"))


def curated_subset(docs: DataFrame, curated: DataFrame, key: str = "source_path") -> tuple[DataFrame, DataFrame]:
    """(documents in the curated list, curated names not found). A small
    list is broadcast by Spark's own size threshold; a large one is shuffled."""
    c = curated.select(key).distinct()
    return docs.join(c, key, "left_semi"), c.join(docs.select(key), key, "left_anti")
