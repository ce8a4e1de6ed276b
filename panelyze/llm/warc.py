"""WARC archives with revisit records for repeated payloads.

``write_archive`` turns rows into records and writes them as gzip'd WARC files
with Spark's text writer; ``read_archive`` parses files by Content-Length.
``deduplicate`` reads the headers of an archive, shuffles them by payload
digest, keeps for each digest the response with the largest page id, joins the
other records to it as revisits, and writes a new archive with fresh record
ids, in which a revisit carries the HTTP header but no payload.

Scale: only headers are grouped; the winner of a digest is a combinable
maximum, written before it is joined, so a digest that holds a third of all
records can be split over tasks.  Files stay near ``FILE_BYTES``, so one file
fits a task.

Defined cases: null html is an empty payload; a null or odd url has its control
characters percent-encoded (null: about:blank); a null page_id sorts below all
others and comes back as null; rows that repeat are records of their own, of
which the last one read is the response; an empty table gives an empty archive
and result; further columns are ignored.
"""

from __future__ import annotations

import gzip
import io

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyze.llm.common import save, scratch, table

FILE_BYTES = 32 << 20
MIN_PAYLOAD = 0
# The table has no crawl time; one fixed instant keeps reruns alike.
CAPTURED = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, by four runs of 40 bits."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    hexed = F.sha1(payload)
    runs = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*runs)), digits, letters)


def record_id(key: Column) -> Column:
    """A URN made from the md5 of ``key``."""
    h = F.md5(key)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *cut))


def safe_uri(url: Column) -> Column:
    out = F.coalesce(url, F.lit("about:blank"))
    for code in (9, 10, 13, 32):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.regexp_replace(out, r"[\x00-\x1F\x7F]", "%3F")


def _lines(pairs: list[tuple[str, Column]]) -> Column:
    return F.concat(*[F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))).otherwise("") for k, v in pairs])


def as_record(kind: Column, rid: Column, url: Column, digest: Column, size: Column, page: Column, body: Column, more=()):
    """One WARC record as text, without its last line feed (the writer adds it)."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        size.cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, body)
    head = _lines(
        [
            ("WARC-Type", kind),
            ("WARC-Record-ID", F.concat(F.lit("<"), rid, F.lit(">"))),
            ("WARC-Target-URI", url),
            ("WARC-Date", F.lit(CAPTURED)),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
            *more,
            ("X-Page-ID", page.cast("string")),
            ("Content-Type", F.lit("application/http; msgtype=response")),
            ("Content-Length", F.octet_length(block).cast("string")),
        ]
    )
    return F.concat(F.lit("WARC/1.1\r\n"), head, F.lit("\r\n"), block, F.lit("\r\n\r"))


def write_archive(records: DataFrame, path: str, mean_bytes: float) -> None:
    per_file = max(1, int(FILE_BYTES / max(1.0, mean_bytes + 600)))
    w = records.select("record").write.option("compression", "gzip").option("maxRecordsPerFile", per_file)
    w.option("lineSep", "\n").text(path)


def parse(content: bytes):
    """Headers (lower-case names) and block of each record of one file."""
    raw = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    stream = io.BufferedReader(raw, 1 << 16)
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("truncated WARC record")
        yield head, block


HEADER_SCHEMA = (
    "page_id long, record_id string, url string, record_type string, payload_digest string, payload_bytes long,"
    " refers_to long"
)


def read_archive(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records of all files under ``path``; the payload only when asked for."""

    def rows(batches):
        for pdf in batches:
            for content in pdf["content"]:
                out, held = [], 0
                for head, block in parse(bytes(content)):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = next(int(x[15:]) for x in http.split(b"\r\n") if x[:15].lower() == b"content-length:")
                    page, ref = head.get("x-page-id"), head.get("x-refers-to-page")
                    row = (
                        int(page) if page else None,
                        head["warc-record-id"].strip("<>"),
                        head.get("warc-target-uri"),
                        head["warc-type"],
                        head["warc-payload-digest"].partition(":")[2],
                        size,
                        int(ref) if ref else None,
                    )
                    out.append(row + (payload.decode("utf-8"),) if with_payload else row)
                    held += len(payload) if with_payload else 200
                    if held > 4 << 20:
                        yield frame(out)
                        out, held = [], 0
                if out:
                    yield frame(out)

    names = [x.split()[0] for x in HEADER_SCHEMA.split(",")] + ["payload"] * with_payload

    def frame(out):
        pdf = pd.DataFrame(out, columns=names)
        for c in ("page_id", "refers_to", "payload_bytes"):
            pdf[c] = pdf[c].astype("Int64")
        return pdf

    # One file a batch: a file is the unit that fits a task.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(rows, HEADER_SCHEMA + ", payload string" * with_payload)


def capture(pages: DataFrame, path: str) -> float:
    """Write one response record per row; returns the mean payload size."""
    body = F.coalesce("html", F.lit(""))
    # Where a row stands in the files tells repeated rows apart.
    rid = record_id(F.concat_ws(":", F.lit("capture"), F.monotonically_increasing_id().cast("string"), "page_id"))
    mean = pages.agg(F.avg(F.octet_length(body))).first()[0] or 0.0
    payload = F.encode(body, "UTF-8")
    out = pages.select("page_id", safe_uri(F.col("url")).alias("url"), body.alias("body"), rid.alias("rid")).select(
        as_record(
            F.lit("response"), F.col("rid"), F.col("url"), base32_sha1(F.encode("body", "UTF-8")),
            F.octet_length("body"), F.col("page_id"), F.col("body"),
        ).alias("record")
    )
    write_archive(out, path, mean)
    return mean


def deduplicate(spark: SparkSession, source: str, target: str, mean_bytes: float, min_payload: int = MIN_PAYLOAD) -> None:
    """Write ``target`` from ``source``, repeated payloads as revisits of the response with the largest page id."""
    heads = save(read_archive(spark, source), "warc-headers")
    order = F.struct("page_id", "record_id", "url")
    winners = save(
        heads.where(F.col("payload_bytes") >= min_payload)
        .groupBy("payload_digest")
        .agg(F.max(order).alias("w"), F.count("*").alias("n"))
        .where("n > 1")
        .select("payload_digest", F.col("w.record_id").alias("first_id"), F.col("w.page_id").alias("first_page"), F.col("w.url").alias("first_url")),
        "warc-winners",
    )
    eligible = heads.where(F.col("payload_bytes") >= min_payload)
    revisits = save(
        eligible.join(winners, "payload_digest")
        .where("record_id <> first_id")
        .select("record_id", "first_id", "first_page", "first_url"),
        "warc-revisits",
    )
    full = read_archive(spark, source, with_payload=True).join(revisits, "record_id", "left")
    again = F.col("first_id").isNotNull()
    fresh = lambda c: record_id(F.concat(F.lit("dedup:"), c))
    more = [
        ("WARC-Profile", F.when(again, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(again, F.concat(F.lit("<"), fresh(F.col("first_id")), F.lit(">")))),
        ("WARC-Refers-To-Target-URI", F.when(again, F.col("first_url"))),
        ("WARC-Refers-To-Date", F.when(again, F.lit(CAPTURED))),
        ("X-Refers-To-Page", F.when(again, F.col("first_page").cast("string"))),
    ]
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    body = F.when(again, F.lit("")).otherwise(F.col("payload"))
    out = full.select(
        as_record(
            kind, fresh(F.col("record_id")), F.col("url"), F.col("payload_digest"),
            F.col("payload_bytes"), F.col("page_id"), body, more,
        ).alias("record")
    )
    write_archive(out, target, mean_bytes)


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured, clean = scratch(spark, "warc-captured"), scratch(spark, "warc-clean")
    mean = capture(table(spark, sf_dir, "pages"), captured)
    deduplicate(spark, captured, clean, mean)
    return read_archive(spark, clean).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, COALESCE(html, '') AS body FROM pages
), d AS (
  SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS h FROM p
), b AS (
  SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(h, 1 + 10 * (k // 8)::INT, 10))::BIGINT >> (35 - 5 * (k % 8))::INT) & 31)::INT + 1, 1)), '') AS payload_digest
  FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = MAX(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = MAX(page_id) OVER w THEN NULL ELSE MAX(page_id) OVER w END AS refers_to
FROM b WINDOW w AS (PARTITION BY payload_digest)
"""
