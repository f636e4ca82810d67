"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (dart_minhash, exact_dedup, fill_middle, filter_audit, html_extract, langid, mixing, packing, secret_scan, topk, toxicity,
                         url_filter, warc)
from tessera.llm.common import read_table
from tessera.session import checkpoint_dir


def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_classes(read_table(spark, sf_dir, "documents"), threshold=0.8)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(read_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.0, max_epochs=3)
    return m.select("doc_id", "size", "source_size", "target", "taken")


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = warc.archive_pages(read_table(spark, sf_dir, "pages"))
    return r.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def remainder(column: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; the folds of the contracts."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % by


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, labels, remainder("doc_id", 5) != 0, max_rows=40_000)


def op4_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    s = toxicity.score(docs, toxicity_model(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")))
    return s.select("doc_id", (F.coalesce(remainder("doc_id", 5), F.lit(1)) == 0).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def op7_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    p = langid.identify(docs, remainder("doc_id", 4) != 2, per_language=600, max_sample=6000)
    return p.select("doc_id", (F.coalesce(remainder("doc_id", 4), F.lit(0)) == 2).alias("held_out"), "lang_pred", "score")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=0)


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    ledger = f"{checkpoint_dir(spark).rstrip('/')}/tessera-ledgers/{uuid.uuid4().hex}"
    secret_scan.scan_unseen(docs, ledger)
    f = secret_scan.findings(docs, ledger)
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("found", lambda s: s["no"] < len(secret_scan.BASE_RULES))
    return f.select("doc_id", count("assign"), count("access"), count("hex"),
                    F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.label_copies(read_table(spark, sf_dir, "documents"))


# The rules of the contract as host, beginning of the path and verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op11_url_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(read_table(spark, sf_dir, "pages"), listed, default="allow")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tessera-audits/{uuid.uuid4().hex}"
    base = sf_dir.rstrip("/")
    return filter_audit.audit(spark, f"{base}/documents.parquet", spark.read.parquet(f"{base}/labels.parquet"), folder)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fill_middle.transform(read_table(spark, sf_dir, "documents"), seed="1", plain_percent=10, spm_percent=20)
    return f.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                    F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES = {
    "op1_dart_minhash": op1_dart_minhash,
    "op2_source_mix": op2_source_mix,
    "op3_warc_revisits": op3_warc_revisits,
    "op4_toxic_segments": op4_toxic_segments,
    "op5_pattern_packing": op5_pattern_packing,
    "op6_secret_ledger": op6_secret_ledger,
    "op7_html_mincut": op7_html_mincut,
    "op8_language_id": op8_language_id,
    "op9_exact_topk": op9_exact_topk,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_url_bloom": op11_url_bloom,
    "op12_filter_audit": op12_filter_audit,
    "op13_fill_middle": op13_fill_middle,
}

SQL_MIX = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 16) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][1 + (no - 1) % 3]::DOUBLE AS w, 3.0::DOUBLE * source_size AS cap FROM s),
f AS (SELECT *, sum(source_size) OVER () AS budget,
             coalesce(sum(cap) OVER (ORDER BY cap / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
             sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_w FROM w),
lv AS (SELECT *, (budget - below) / rest_w AS level FROM f),
wl AS (SELECT level FROM lv WHERE level * w <= cap ORDER BY cap / w, no LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN (SELECT count(*) FROM wl) = 0 THEN cap ELSE least((SELECT level FROM wl) * w, cap) END AS target FROM lv),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN least(floor(t.target / t.source_size), 3) ELSE 0 END AS e,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (e + CASE WHEN size > 0 AND e < 3 AND before + size / 2.0 <= target - e * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""

SQL_DEDUP = r"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS norm,
                  length(coalesce(text, '')) AS n FROM documents),
g AS (SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""

SQL_TOPK = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""

SQL_URLS = r"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path, row_number() OVER () AS no FROM pages),
r(rule_host, rule_path, verdict) AS (VALUES %s),
m AS (SELECT u.no, rule_host || rule_path AS rule, r.verdict,
             row_number() OVER (PARTITION BY u.no ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS nth
      FROM u JOIN r ON (u.host = rule_host OR ends_with(u.host, '.' || rule_host)) AND starts_with(u.path, rule_path))
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM u LEFT JOIN m ON m.no = u.no AND m.nth = 1
""" % ", ".join("('%s', '%s', '%s')" % r for r in URL_RULES)

SQL_AUDIT = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
d AS (SELECT doc_id, part,
             CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END
             + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM d LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.letter || b.letter || x.letter || y.letter || z.letter AS filter_order FROM f a, f b, f x, f y, f z
      WHERE a.bit + b.bit + x.bit + y.bit + z.bit = 31 AND a.bit | b.bit | x.bit | y.bit | z.bit = 31),
s AS (SELECT o.filter_order, instr(o.filter_order, f.letter) AS step, f.bit, sum(g.bit) FILTER (instr(o.filter_order, g.letter) < instr(o.filter_order, f.letter)) AS before
      FROM o, f, f g GROUP BY o.filter_order, f.letter, f.bit),
p AS (SELECT DISTINCT part FROM d),
k AS (SELECT p.part, s.filter_order, s.step, s.bit, coalesce(s.before, 0)::INT AS before FROM p, s),
t AS (SELECT k.part, k.filter_order, k.step, k.bit,
             coalesce(sum(n) FILTER (mask & (k.before | k.bit) = 0), 0) AS kept,
             coalesce(sum(n) FILTER (mask & k.before = 0 AND mask & k.bit <> 0), 0) AS removed,
             coalesce(sum(n) FILTER (mask & k.before <> 0 AND mask & k.bit <> 0), 0) AS redundant,
             coalesce(sum(n) FILTER (mask = k.bit), 0) AS unique_fails,
             coalesce(sum(good) FILTER (mask & k.before = 0 AND mask & k.bit <> 0), 0) AS good_lost,
             coalesce(sum(toxic) FILTER (mask & k.before = 0 AND mask & k.bit <> 0), 0) AS toxic_lost
      FROM k JOIN c ON c.part = k.part GROUP BY k.part, k.filter_order, k.step, k.bit)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM t
"""

SQL_FIM = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') AS u,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
n AS (SELECT doc_id, text, u, len(u) AS n, ('0x' || substr(h, 1, 8))::UBIGINT % (len(u) + 1) AS c1, ('0x' || substr(h, 9, 8))::UBIGINT % (len(u) + 1) AS c2,
             ('0x' || substr(h, 17, 8))::UBIGINT % 100 AS h3, ('0x' || substr(h, 25, 8))::UBIGINT % 100 AS h4 FROM d),
p AS (SELECT doc_id, text, n, h4, array_to_string(u[1:least(c1, c2)], '') AS a, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
             array_to_string(u[greatest(c1, c2) + 1:], '') AS z,
             text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 AS plain FROM n),
f AS (SELECT *, CASE WHEN plain THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM p)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN NOT plain THEN length(a) END AS prefix_chars, CASE WHEN NOT plain THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM f
"""

ORACLES = {
    "op2_source_mix": SQL_MIX,
    "op9_exact_topk": SQL_TOPK,
    "op10_exact_dedup": SQL_DEDUP,
    "op11_url_bloom": SQL_URLS,
    "op12_filter_audit": SQL_AUDIT,
    "op13_fill_middle": SQL_FIM,
}
