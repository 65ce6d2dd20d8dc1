"""WARC as a content-addressed archive: payloads once, record headers apart, records by join.

An archive is a folder with two tables. ``payloads`` holds every distinct payload once under
its SHA-256. ``headers`` holds one row per record: the exact bytes before the payload (the
WARC header and, for a response, the HTTP header) and the payload's SHA-256. Joining the two
gives back every record byte for byte.

Of records with equal payloads that with the smallest page id is a response, the others are
revisits of it; payloads shorter than ``min_bytes`` are stored once, too, but all their
records are responses. Equality is that of SHA-256 checked against SHA-1 and length on
writing; on reading, the digest of every payload is computed again. A mismatch is an error.

Defined cases: NULL html is the empty payload; a NULL url leaves the target out; CR and LF in
a url are percent-encoded; NULL page ids come after all others, and rows that agree in page
id and payload are of the same type; an empty table gives an empty archive; other columns are
ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import cut_lineage, read
from quarry.session import ensure_checkpoint_dir

#: The base32 alphabet of RFC 4648 and the profile of a revisit.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
#: Keys of copies, of about a hundred bytes each, up to which they are broadcast.
BROADCAST_KEYS = 100_000


def base32_of_hex(hexadecimal: Column) -> Column:
    """Base32 of a 160-bit number in hexadecimal: five hexadecimal digits are four characters."""
    def four(i: Column) -> Column:
        n = F.conv(F.substring(hexadecimal, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substring(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _lines(*parts) -> Column:
    """Header lines; a part that is NULL is left out."""
    return F.concat(*[F.coalesce(F.concat(p, F.lit("\r\n")), F.lit("")) for p in parts])


def _payloads(rows: DataFrame, slim: DataFrame, group: DataFrame) -> DataFrame:
    """Each payload once. With few copies their keys are broadcast, and no payload is shuffled."""
    keys = slim.groupBy("page_id", "sha256").agg(F.count("*").alias("k")).join(group, F.col("sha256") == F.col("g"))
    keys = keys.withColumn("first", F.col("page_id").eqNullSafe(F.col("first_id"))).filter("k > 1 OR NOT first")
    keys = cut_lineage(keys.select(F.col("page_id").alias("__id"), F.col("sha256").alias("__sha"), "first"))
    rows = rows.select("page_id", "sha256", "payload")
    if keys.count() > BROADCAST_KEYS:
        return rows.groupBy("sha256").agg(F.any_value("payload").alias("payload"))
    keys = F.broadcast(keys)
    on = F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("sha256") == F.col("__sha"))
    single = rows.join(keys, on, "left_anti")
    repeated = rows.join(keys.filter("first"), on, "left_semi").dropDuplicates(["sha256"])
    return single.unionByName(repeated).select("sha256", "payload")


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write pages (page_id, url, html) as an archive into the folder ``path``."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"sha256": F.sha2("payload", 256), "sha1": F.sha1("payload"), "n": F.octet_length("payload").cast("long")})
    slim = cut_lineage(rows.select("page_id", "url", "sha256", "sha1", "n"))
    group = slim.groupBy("sha256").agg(F.min("page_id").alias("first_id"), F.min("sha1").alias("lo"), F.max("sha1").alias("hi"), F.min("n").alias("nlo"), F.max("n").alias("nhi"))
    same = (F.col("lo") == F.col("hi")) & (F.col("nlo") == F.col("nhi"))
    group = cut_lineage(group.select(F.col("sha256").alias("g"), F.when(same, F.col("first_id")).otherwise(F.raise_error(F.lit("two payloads share a SHA-256")).cast("long")).alias("first_id")))
    _payloads(rows, slim, group).write.mode("overwrite").parquet(f"{path}/payloads")

    out = slim.join(group, F.col("sha256") == F.col("g"))
    response = F.col("page_id").eqNullSafe(F.col("first_id")) | (F.col("n") < min_bytes)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit("\r\n\r\n"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    warc = _lines(
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(response, "response").otherwise("revisit")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"))), F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), url), F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_of_hex(F.col("sha1"))),
        F.when(~response, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("first_id")))),
        F.when(~response, F.lit(f"WARC-Profile: {PROFILE}")), F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.when(response, F.octet_length(http) + F.col("n")).otherwise(F.lit(0)))) 
    header = F.encode(F.concat(warc, F.lit("\r\n"), F.when(response, http).otherwise("")), "UTF-8")
    out.select(header.alias("header"), "sha256", response.alias("whole")).write.mode("overwrite").parquet(f"{path}/headers")


def read_records(spark: SparkSession, path: str, whole: bool | None = None) -> DataFrame:
    """record (the exact bytes) and sha256 of every record of an archive, payloads verified;
    with ``whole`` only of those with a payload (True) or only of revisits (False), which
    need no payload and so no join."""
    payloads = spark.read.parquet(f"{path}/payloads")
    good = F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(F.raise_error(F.lit("a payload does not have its digest")).cast("binary"))
    payloads = payloads.select(F.col("sha256").alias("g"), good.alias("payload"))
    headers = spark.read.parquet(f"{path}/headers")
    end = F.encode(F.lit("\r\n\r\n"), "UTF-8")
    responses = headers.filter("whole").join(payloads, F.col("sha256") == F.col("g")).select(F.concat("header", "payload", end).alias("record"), "sha256")
    revisits = headers.filter("NOT whole").select(F.concat("header", end).alias("record"), "sha256")
    if whole is None:
        return responses.unionByName(revisits)
    return responses if whole else revisits


def parse_records(records: DataFrame) -> DataFrame:
    """page_id, url, record_type, payload_digest, refers_to, payload (NULL for a revisit) and sha256.

    A payload whose digest is not that of its header is an error."""
    text = F.decode("record", "UTF-8")
    field = lambda name: F.regexp_extract("head", rf"(?m)^{name}: ([^\r\n]*)", 1)
    page = lambda x: F.regexp_extract(x, r"<urn:page:(-?\d+)>", 1)
    number = lambda x: F.when(x != "", x).cast("long")
    out = records.select("sha256", "record", F.substring_index(text, "\r\n\r\n", 1).alias("head"))
    out = out.withColumns({"record_type": field("WARC-Type"), "payload_digest": F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", ""), "length": field("Content-Length").cast("int")})
    block = F.substr("record", F.octet_length("head") + 5, F.col("length"))
    http = F.octet_length(F.substring_index(F.decode(block, "UTF-8"), "\r\n\r\n", 1)) + 5
    payload = F.when(F.col("record_type") == "response", F.substr(block, http, F.col("length")))
    out = out.withColumn("payload", payload)
    wrong = F.col("payload").isNotNull() & (base32_of_hex(F.sha1("payload")) != F.col("payload_digest"))
    digest = F.when(wrong, F.raise_error(F.lit("a record does not have its payload digest")).cast("string")).otherwise(F.col("payload_digest"))
    return out.select(number(page(field("WARC-Record-ID"))).alias("page_id"), F.nullif(field("WARC-Target-URI"), F.lit("")).alias("url"), "record_type",
                      digest.alias("payload_digest"), number(page(field("WARC-Refers-To"))).alias("refers_to"), "payload", "sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(read(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    responses = parse_records(read_records(spark, path, whole=True)).select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "sha256")
    responses = cut_lineage(responses)
    sizes = responses.groupBy(F.col("sha256").alias("g")).agg(F.first("payload_bytes").alias("payload_bytes"))
    visits = parse_records(read_records(spark, path, whole=False)).join(sizes, F.col("sha256") == F.col("g"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*names).unionByName(visits.select(*names))


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM h
"""
