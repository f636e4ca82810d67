"""WARC archives: writing, reading, and resolution of revisits, in DataFrame functions.

Archives are gzip files of WARC/1.1 records. Each record carries, directly after its version line, a
boundary that is drawn anew for each archive; a payload cannot contain it, so Spark's text reader finds
the records by it and no task ever holds a whole file. Lengths and digests are checked on reading.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import let
from tessera.session import checkpoint_dir, cut_lineage

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: So many records at most go to one file, which is the unit of reading.
RECORDS_PER_FILE = 50_000


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: each 40 bits of the hex digest make 8 digits of 5 bits."""
    part = lambda h, i: F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0")
    digits = lambda h: F.upper(F.concat(*[part(h, i) for i in range(4)]))
    return F.translate(let(F.sha1(payload), digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _line(value: Column) -> Column:
    """A header value on one line: line ends in it would end the header."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"[\r\n]+", " ")


def _headers(boundary: str, fields: list[tuple[str, Column]]) -> Column:
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]  # a null value leaves its line out
    return F.concat(F.lit(f"Archive-Boundary: {boundary}{CRLF}"), F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


def _write(records: DataFrame, folder: str, boundary: str) -> None:
    """``records(record)``, each the text after the version line; every record ends with two line ends."""
    (records.select(F.concat(F.lit(f"WARC/1.1{CRLF}"), F.col("record")).alias("value")).write.mode("errorifexists")
     .option("lineSep", CRLF + CRLF).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder))


def _read(spark: SparkSession, folder: str, boundary: str) -> DataFrame:
    """``headers, payload`` of every record."""
    mark = f"WARC/1.1{CRLF}Archive-Boundary: {boundary}{CRLF}"
    parts = spark.read.option("lineSep", mark).schema("value string").text(folder).where(F.length("value") > 0)
    at = F.instr("value", CRLF + CRLF)  # ends the headers; the record itself ends with two line ends
    return parts.select(F.substring("value", F.lit(1), at + 1).alias("headers"),
                        F.substring("value", at + 4, F.length("value") - at - 7).alias("payload"))


def _field(name: str) -> Column:
    found = F.regexp_extract("headers", rf"(?md)^{name}: (.*?)\r?$", 1)
    return F.when(found == "", F.lit(None)).otherwise(found)


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """A response record for each row; gives the archive's boundary."""
    boundary = uuid.uuid4().hex
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    body = F.col("payload").cast("binary")
    d = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.expr("uuid()").alias("rid"))
    _write(d.select(F.concat(_headers(boundary, [
        ("WARC-Type", F.lit("response")), ("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.col("rid"), F.lit(">"))),
        ("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")), ("WARC-Target-URI", _line(F.col("url"))),
        ("Page-ID", F.col("id").cast("string")), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(body))),
        ("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.octet_length("payload").cast("string"))]),
        F.col("payload")).alias("record")), folder, boundary)
    return boundary


def read_archive(spark: SparkSession, folder: str, boundary: str) -> DataFrame:
    """``rid, id, type, url, date, refers_to_rid, refers_to, stated_length, stated_digest, payload``.

    A payload whose length is not the stated one ends the job: the archive is damaged.
    """
    r = _read(spark, folder, boundary)
    size = _field("Content-Length").cast("long")
    whole = F.when(F.octet_length("payload") == size, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record: "), F.substring("headers", 1, 300))))
    return r.select(F.regexp_extract("headers", r"(?md)^WARC-Record-ID: <urn:uuid:(.*?)>\r?$", 1).alias("rid"),
                    _field("Page-ID").cast("long").alias("id"), _field("WARC-Type").alias("type"), _field("WARC-Target-URI").alias("url"),
                    _field("WARC-Date").alias("date"), F.regexp_extract("headers", r"(?md)^WARC-Refers-To: <urn:uuid:(.*?)>\r?$", 1).alias("refers_to_rid"),
                    _field("Refers-To-Page-ID").cast("long").alias("refers_to"),
                    F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("stated_digest"), whole.alias("payload"))


def resolve_revisits(records: DataFrame, min_bytes: int = 0, salts: int = 64) -> DataFrame:
    """Headers of an archive, ``rid, id, url, date, digest, strong, bytes``, with the record each one repeats.

    Adds ``first_rid, first_id, first_url, first_date``: of records with equal payloads of at least
    ``min_bytes`` bytes the one with the smallest id (null last), then the smallest record id. Payloads
    are equal when SHA-1, SHA-256 and length are. Only headers are shuffled, by (digest, salt) and then
    by digest, so a payload that a third of all records share is met in ``salts`` places first.
    """
    key = ["digest", "strong", "bytes"]
    h = records.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(salts)))
    best = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("first_id"), F.col("rid").alias("first_rid"),
                    F.col("url").alias("first_url"), F.col("date").alias("first_date"))
    salted = h.where(F.col("bytes") >= min_bytes).groupBy(*key, "salt").agg(F.min(best).alias("best"))
    winners = salted.groupBy(*key).agg(F.min("best").alias("best"), F.collect_list("salt").alias("salts"))  # at most `salts` entries
    firsts = winners.select(*key, F.explode("salts").alias("salt"), "best.*").drop("none")
    return h.join(firsts, [*key, "salt"], "left").drop("salt")


def write_deduplicated(records: DataFrame, folder: str) -> str:
    """``records`` of ``read_archive`` with ``first_rid, first_id, first_url, first_date``, which are null
    except for revisits: responses in full, revisits as headers, all with fresh headers; gives the boundary."""
    boundary = uuid.uuid4().hex
    revisit = F.col("first_rid").isNotNull()
    only = lambda c: F.when(revisit, c)
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    _write(records.select(F.concat(_headers(boundary, [
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.col("rid"), F.lit(">"))),
        ("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")), ("WARC-Target-URI", _line(F.col("url"))),
        ("Page-ID", F.col("id").cast("string")), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("stated_digest"))),
        ("WARC-Profile", only(F.lit(PROFILE))), ("WARC-Refers-To", only(F.concat(F.lit("<urn:uuid:"), F.col("first_rid"), F.lit(">")))),
        ("Refers-To-Page-ID", only(F.col("first_id").cast("string"))), ("WARC-Refers-To-Target-URI", only(_line(F.col("first_url")))),
        ("WARC-Refers-To-Date", only(F.col("first_date"))),
        ("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.octet_length(body).cast("string"))]), body).alias("record")),
        folder, boundary)
    return boundary


def deduplicate_archive(spark: SparkSession, folder: str, boundary: str, out: str, min_bytes: int = 0) -> str:
    """Reads an archive, resolves its revisits and writes the deduplicated one; gives its boundary."""
    r = read_archive(spark, folder, boundary)
    body = F.col("payload").cast("binary")
    headers = cut_lineage(r.select("rid", "id", "url", "date", "stated_digest", base32_sha1(body).alias("digest"), F.sha2(body, 256).alias("strong"),
                                   F.octet_length("payload").cast("long").alias("bytes")), "headers")
    damaged = headers.where("not digest <=> stated_digest").select("rid").head(1)
    if damaged:
        raise ValueError(f"damaged payload of record {damaged[0].rid}")
    headers = headers.drop("stated_digest")
    resolved = resolve_revisits(headers, min_bytes)
    # the table holds revisits only, so payloads need no shuffle where there are few; a record id is unique
    revisits = cut_lineage(resolved.where("first_rid <> rid").select("rid", "first_rid", "first_id", "first_url", "first_date"), "revisits")
    return write_deduplicated(r.join(revisits, "rid", "left"), out)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes an archive of ``pages``, deduplicates it, reads that back: one row for each page,
    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``.

    A null html is an empty payload, and empty payloads are equal to each other. Pages may repeat ids:
    of records that share the smallest id one is the response. A null id comes last. Length and digest
    are taken from the payload that was read back, for revisits from that of their original.
    """
    spark = pages.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/tessera-warc/{uuid.uuid4().hex}"
    first = write_archive(pages, f"{base}/crawl")
    second = deduplicate_archive(spark, f"{base}/crawl", first, f"{base}/deduplicated", min_bytes)
    r = read_archive(spark, f"{base}/deduplicated", second)
    body = F.col("payload").cast("binary")
    r = cut_lineage(r.select("rid", "id", "url", "type", "refers_to_rid", "refers_to", F.octet_length("payload").cast("long").alias("n"),
                             base32_sha1(body).alias("digest")), "archived")
    own = r.where("type = 'response'")
    from_original = own.select(F.col("rid").alias("refers_to_rid"), F.col("n").alias("on"), F.col("digest").alias("odigest"))
    back = r.where("type = 'revisit'").drop("n", "digest").join(from_original, "refers_to_rid")
    cols = [F.col("id").alias("page_id"), "url", F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
            F.col("type").alias("record_type"), "refers_to"]
    return own.select(*cols).unionByName(back.withColumnsRenamed({"on": "n", "odigest": "digest"}).select(*cols))
