"""Content-addressed WARC archive.

The archive has two tables in the shared folder:

* ``payloads``: each payload's bytes once, under their SHA-256 digest.  Equal digests are
  checked to have equal length and equal second hash before one copy stands for all;
* ``records``: the exact header of every record with the digest of its payload.

Original records come back by joining the two on the digest; a response is its header, its
payload and the closing blank lines, a revisit its header alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import staged

CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed by the format


@dataclass
class Archive:
    payloads: DataFrame  # digest binary, payload binary, first_id, verified boolean
    records: DataFrame   # id, header string, digest binary


def _payload(html):
    return F.coalesce(html.cast("binary"), F.lit(b""))


def write_archive(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_revisit_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> Archive:
    """Write the archive of ``df``: one record per row.

    Of records with equal payloads of at least ``min_revisit_bytes``, the one with the smallest
    id is a response and the others revisit it; smaller payloads are all responses.  A null
    payload is empty.  Rows that repeat the smallest id are responses too; a null id never is
    the smallest unless all are null.  Line breaks in a url are percent-encoded in the header.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), _payload(F.col(payload_col)).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    second = F.xxhash64("payload")
    grouped = (rows.select("digest", "payload", "id", F.octet_length("payload").alias("n"), second.alias("h"))
               .groupBy("digest")
               .agg(F.first("payload").alias("payload"), F.min("id").alias("first_id"),
                    F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("h").alias("h0"), F.max("h").alias("h1")))
    payloads = staged(grouped.select("digest", "payload", "first_id",
                                     ((F.col("n0") == F.col("n1")) & (F.col("h0") == F.col("h1"))).alias("verified")),
                      "warc-payloads", "zstd")
    heads = (rows.select("id", "url", "digest", F.octet_length("payload").alias("n"))
             .join(payloads.select("digest", "first_id", "verified"), "digest"))
    revisit = (F.col("n") >= min_revisit_bytes) & ~F.col("id").eqNullSafe(F.col("first_id"))

    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))

    safe_url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: "), urn(F.col("id")),
        F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "), safe_url,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha256:"), F.lower(F.hex("digest")),
        F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Refers-To: "), urn(F.col("first_id")),
                                 F.lit(f"{CRLF}WARC-Profile: {REVISIT_PROFILE}"))).otherwise(""),
        F.lit(f"{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.when(revisit, 0).otherwise(F.col("n")).cast("string"), F.lit(CRLF + CRLF))
    checked = F.when(F.col("verified"), header).otherwise(F.raise_error(F.lit("two payloads share a digest")))
    records = staged(heads.select("id", checked.alias("header"), "digest"), "warc-records", "zstd")
    return Archive(payloads, records)


def read_records(archive: Archive) -> DataFrame:
    """Reconstruct every record: id, header, record (bytes as archived), payload (the full
    original payload, also of revisits)."""
    j = archive.records.join(archive.payloads.select("digest", "payload"), "digest")
    body = F.when(F.col("header").contains(f"{CRLF}WARC-Type: revisit{CRLF}"), F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat(F.col("header").cast("binary"), body, F.lit((CRLF + CRLF).encode()))
    return j.select("id", "header", record.alias("record"), "payload")


def parse_records(records: DataFrame) -> DataFrame:
    """Fields of the reconstructed records: page id, type, the response referred to, and length
    and digest recomputed from the bytes; a record that disagrees with its header is an error."""
    def field(name):
        return F.regexp_extract("head", rf"\r\n{name}: ([^\r]*)\r\n", 1)

    head_bytes = F.octet_length("header")
    r = (records
         .withColumn("head", F.expr("cast(substring(record, 1, octet_length(header)) as string)"))
         .withColumn("block", F.expr("octet_length(record) - octet_length(header) - 4"))
         .withColumn("digest_now", F.sha2("payload", 256)))
    good = ((field("Content-Length").cast("long") == F.col("block"))
            & (field("WARC-Payload-Digest") == F.concat(F.lit("sha256:"), F.col("digest_now"))) & (head_bytes > 0))
    number = r"<urn:page:(-?\d+)>"
    return r.select(
        F.expr(f"try_cast(nullif(regexp_extract(head, r'WARC-Record-ID: {number}', 1), '') as bigint)").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(good, F.col("digest_now")).otherwise(F.raise_error(F.lit("a record's bytes disagree with its header")))
        .alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        F.expr(f"try_cast(nullif(regexp_extract(head, r'WARC-Refers-To: {number}', 1), '') as bigint)").alias("refers_to"))


def export_warc(archive: Archive, path: str) -> None:
    """Plain .warc text files: each record ends with a blank line pair, the writer's separator."""
    # the header's own line, not the words inside a url
    whole = F.concat("header", F.when(F.col("header").contains(f"{CRLF}WARC-Type: revisit{CRLF}"), "")
                     .otherwise(F.col("payload").cast("string")))
    (archive.records.join(archive.payloads.select("digest", "payload"), "digest").select(whole.alias("value"))
     .write.option("lineSep", CRLF + CRLF).text(path))
