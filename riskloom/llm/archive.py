"""A content-addressed WARC archive: payload bytes once by digest, exact record heads beside, records by joins.

An archive is a folder of two Parquet tables. `payloads` holds each distinct payload once, under the
SHA-256 of its bytes. `heads` holds a row a record: the exact bytes before the payload (WARC header and
HTTP head) and the payload's address. A record is its head, its payload if it has one, and two line ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.frames import maybe_broadcast, stored
from riskloom.session import scratch_path

# Payloads shorter than this are never revisits: a reference would save nothing.
REVISIT_BYTES = 1000
CAPTURED = "2025-01-01T00:00:00Z"
# Groups of copies (an address and a record id each) up to which their table is broadcast: about 15 MB.
BROADCAST_GROUPS = 100_000
# Line ends, and the profile of a record that repeats an earlier payload.
CRLF = "\r\n"
RECORD_END = CRLF * 2
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _field(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(CRLF))


def _record_id(page_id: Column, tag: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), F.lower(F.hex(tag)), F.lit(">"))


def _head(kind: Column, target: Column, digest: Column, size: Column, own: Column, refers_to: Column) -> Column:
    """WARC header and HTTP head of a record, as text of single-byte line ends."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF),
        _field("Content-Type", "text/html; charset=utf-8"),
        _field("Content-Length", size.cast("string")),
        F.lit(CRLF),
    )
    body = F.octet_length(http) + F.when(kind == "response", size).otherwise(F.lit(0))
    revisit = F.concat(_field("WARC-Profile", SAME_PAYLOAD), _field("WARC-Refers-To", F.coalesce(refers_to, F.lit(""))))
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", own),
        _field("WARC-Date", CAPTURED),
        _field("WARC-Target-URI", target),
        _field("Content-Type", "application/http;msgtype=response"),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(kind == "revisit", revisit).otherwise(F.lit("")),
        _field("Content-Length", body.cast("string")),
        F.lit(CRLF),
        http,
    )


def write_archive(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
) -> None:
    """Writes one record a row: a response, or a revisit of the response with the same payload.

    The payload is the text in UTF-8; a null text is empty. Of the rows whose payloads are equal and
    have `revisit_bytes` or more, the one of the largest id is the response (a null id is below all;
    of rows that share it, one), the others revisit it. Shorter payloads are all responses, but they
    are stored once too. Line ends, blanks and control characters of a URL become %20, so that no
    URL can add header lines; a null URL is about:blank. Repeated rows are records each, with ids of
    their own. An empty table gives an archive without records.

    Payloads that share an address must agree in length and in SHA-1 as well, else the write fails: no
    payload stands for another. Copies collapse in each task before payloads are shuffled, once; ids
    and digests decide on types in a table of their own, so a group of copies never meets in a task.
    """
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
    address, digest, size = F.unhex(F.sha2("payload", 256)), F.sha1("payload"), F.octet_length("payload").cast("long")

    keyed = rows.select(address.alias("address"), digest.alias("sha1"), "payload")
    once = keyed.groupBy("address").agg(
        F.min("sha1").alias("sha1"), F.max("sha1").alias("other"), F.first("payload").alias("payload")
    )
    clash = F.raise_error(F.concat(F.lit("two payloads share the address "), F.hex("address")))
    once = once.select("address", F.when(F.col("sha1") == F.col("other"), F.col("sha1")).otherwise(clash).alias("sha1"), "payload")
    once.write.option("compression", "zstd").parquet(f"{path}/payloads")

    # Stored before it is read twice: the tag tells rows of one id apart, and is fixed from here on.
    marked = rows.select("page_id", "url", address.alias("address"), digest.alias("sha1"), size.alias("size"))
    marked = stored(marked.withColumn("tag", F.monotonically_increasing_id()), "records")
    shared = marked.filter(F.col("size") >= revisit_bytes).groupBy("address")
    shared = shared.agg(F.max(F.struct("page_id", "tag")).alias("response"), F.count("*").alias("n"))
    shared = stored(shared.filter("n > 1").select("address", "response"), "responses")
    shared = maybe_broadcast(shared, shared.count(), BROADCAST_GROUPS)

    again = F.col("response").isNotNull() & (F.col("response.tag") != F.col("tag"))
    own, first = _record_id(F.col("page_id"), F.col("tag")), _record_id(F.col("response.page_id"), F.col("response.tag"))
    kind = F.when(again, "revisit").otherwise("response")
    target = F.regexp_replace(F.coalesce("url", F.lit("about:blank")), r"[\x00-\x20\x7f]", "%20")
    head = _head(kind, target, F.col("sha1"), F.col("size"), own, first)
    heads = marked.join(shared, "address", "left").select("page_id", head.cast("binary").alias("head"), "address")
    heads.write.option("compression", "zstd").parquet(f"{path}/heads")


def _read(spark: SparkSession, path: str, table: str) -> DataFrame:
    kinds = {"heads": "head binary, address binary", "payloads": "address binary, sha1 string, payload binary"}
    found = spark.read.parquet(f"{path}/{table}")
    return found.select(*(["page_id"] if table == "heads" else []), *[f.split()[0] for f in kinds[table].split(", ")])


def _verified(payloads: DataFrame) -> DataFrame:
    """The payloads, each checked against its address as it is read."""
    broken = F.raise_error(F.concat(F.lit("payload does not match its address "), F.hex("address")))
    same = F.unhex(F.sha2("payload", 256)) == F.col("address")
    return payloads.withColumn("payload", F.when(same, F.col("payload")).otherwise(broken))


def _named(head: Column, name: str) -> Column:
    """Value of a header field; empty where the head has none. HTTP fields follow all WARC fields."""
    return F.regexp_extract(head.cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """What the archive says of each record: (page_id, record_type, record_id, refers_to, target, payload_bytes, payload_digest).

    Fields come from the stored heads, size and SHA-1 from the stored payloads, which are hashed again
    once each and must match their address and the head; else the read fails. `refers_to` is the page
    id of the response that a revisit names, in the type of page_id; null for responses.
    """
    payloads = _verified(_read(spark, path, "payloads"))
    payloads = payloads.select("address", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    heads = _read(spark, path, "heads")
    kind = heads.schema["page_id"].dataType
    found = heads.join(payloads, "address")
    head = F.col("head")
    wrong = F.raise_error(F.concat(F.lit("payload does not match the head of "), _named(head, "WARC-Record-ID")))
    said = _named(head, "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), "payload_digest")
    refers_to = F.regexp_extract(_named(head, "WARC-Refers-To"), r"^<urn:page:(.*):[0-9a-f]+>$", 1)
    return found.select(
        "page_id",
        _named(head, "WARC-Type").alias("record_type"),
        _named(head, "WARC-Record-ID").alias("record_id"),
        F.when(refers_to != "", refers_to).cast(kind).alias("refers_to"),
        _named(head, "WARC-Target-URI").alias("target"),
        "payload_bytes",
        F.when(said, F.col("payload_digest")).otherwise(wrong).alias("payload_digest"),
    )


def rebuild_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record): the exact bytes of each WARC record, without the two line ends that close it.

    A revisit is its head alone. A payload of many records is read once and joined; heads of a hot
    payload are split over tasks by adaptive execution.
    """
    heads = _read(spark, path, "heads").withColumn("carries", _named(F.col("head"), "WARC-Type") == "response")
    alone = heads.filter(~F.col("carries")).select("page_id", F.col("head").alias("record"))
    whole = heads.filter("carries").join(_verified(_read(spark, path, "payloads")), "address")
    return whole.select("page_id", F.concat("head", "payload").alias("record")).unionByName(alone)


def write_warc_files(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records of `rebuild_records` as WARC files, one a task, each record closed by two line ends."""
    whole = records.select(F.col("record").cast("string").alias("value"))
    whole.write.option("lineSep", RECORD_END).option("compression", compression).text(path)


def archived_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the pages to an archive, in the shared folder by default, and reads it back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archive")
    write_archive(pages, path)
    return read_archive(spark, path)
