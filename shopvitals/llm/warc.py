"""A content-addressed web archive.

Payload bytes are stored once per SHA-256 digest; record headers are kept exactly and apart, with
the digest of what they describe. Records come back by joining the two; what the archive says of a
page is read from the bytes of its rebuilt record. Digests are checked when the payloads are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopvitals.llm.common import attach, whole_text
from shopvitals.session import discard, materialize, shared_dir

NL = "\r\n"
#: RFC 4648 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ARCHIVED_AT = "2024-01-01T00:00:00Z"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: four digits for every five of the hexadecimal form."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def http_header(length: Column) -> Column:
    return F.concat(
        F.lit(f"HTTP/1.1 200 OK{NL}Content-Type: text/html; charset=utf-8{NL}Content-Length: "),
        length.cast("string"), F.lit(NL + NL),
    )


def record_id(page_id: Column, sha1: Column) -> Column:
    """A record id made of the page's id, or for rows without one of nothing, and its payload's digest."""
    h = F.sha2(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("row")), sha1), 256)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def header_value(text: Column) -> Column:
    """Text that stays within one line of a header: control characters are percent-encoded, null is empty."""
    control = F.lit(r"[\x00-\x1F\x7F]")
    safe = F.transform(
        F.split(text, ""),
        lambda x: F.when(F.regexp_like(x, control), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(x)), 2, "0"))).otherwise(x),
    )
    return F.coalesce(F.when(F.regexp_like(text, control), F.array_join(safe, "")).otherwise(text), F.lit(""))


def write(pages: DataFrame, root: str, min_bytes: int = 0) -> None:
    """Write ``payloads`` (digest, payload) and ``records`` (digest, page_id, url, header, http) below ``root``.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest page_id is
    the response and the others revisit it; rows that repeat that page_id are responses as well, and
    so are rows without page_id when no equal payload has one. Null html is the empty payload. A
    group of equal payloads is counted before it is shuffled and its bytes travel as one row of each
    task. The url is kept as it is beside the header, which has it without control characters.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), whole_text(F.col("html")).alias("html")).withColumn(
        "payload", F.col("html").cast("binary")
    ).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    rows.select("digest", "payload").dropDuplicates(["digest"]).write.option("compression", "zstd").parquet(f"{root}/payloads")

    small = rows.select(
        "page_id", "url", "digest", F.octet_length("payload").cast("long").alias("n"), base32_sha1(F.col("payload")).alias("sha1"),
    )
    newest = small.where(F.col("n") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("newest"))
    kinds = small.join(newest, "digest", "left").withColumn(
        "revisit", F.coalesce(F.col("newest").isNotNull() & ~F.col("newest").eqNullSafe(F.col("page_id")), F.lit(False))
    )
    http = http_header(F.col("n"))
    block = F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("n"))
    header = F.concat(
        F.lit(f"WARC/1.1{NL}WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit(f"{NL}WARC-Record-ID: "), record_id(F.col("page_id"), F.col("sha1")),
        F.lit(f"{NL}WARC-Date: {ARCHIVED_AT}{NL}WARC-Target-URI: "), header_value(F.col("url")),
        F.lit(f"{NL}WARC-Payload-Digest: sha1:"), F.col("sha1"),
        F.when(
            F.col("revisit"),
            F.concat(
                F.lit(f"{NL}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{NL}WARC-Refers-To: "),
                record_id(F.col("newest"), F.col("sha1")), F.lit(f"{NL}Refers-To-Page: "), F.col("newest").cast("string"),
            ),
        ).otherwise(""),
        F.lit(f"{NL}Content-Type: application/http; msgtype=response{NL}Content-Length: "), block.cast("string"), F.lit(NL + NL),
    )
    kinds.select("digest", "page_id", "url", header.alias("header"), http.alias("http")).write.parquet(f"{root}/records")


def payloads(spark: SparkSession, root: str) -> DataFrame:
    """digest, payload of every stored payload; a payload that no longer has its digest is an error."""
    stored = spark.read.schema("digest binary, payload binary").parquet(f"{root}/payloads")
    right = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    return stored.withColumn("payload", F.when(right, F.col("payload")).otherwise(F.raise_error(F.lit("payload damaged")).cast("binary")))


def headers(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("digest binary, page_id long, url string, header string, http string").parquet(f"{root}/records")


def records(spark: SparkSession, root: str) -> DataFrame:
    """page_id and the exact bytes of every record; a revisit has no payload of its own."""
    kept = headers(spark, root).withColumn("own", F.when(field("WARC-Type") == "response", F.col("digest")))
    # Revisits need no payload, so they are not part of the join; a payload has one response, or rows that repeat it.
    joined = kept.where(F.col("own").isNotNull()).join(payloads(spark, root).withColumnRenamed("digest", "own"), "own")
    end = F.lit(b"\r\n\r\n")
    head = [F.encode("header", "utf-8"), F.encode("http", "utf-8")]
    return joined.select("page_id", F.concat(*head, "payload", end).alias("record")).unionByName(
        kept.where(F.col("own").isNull()).select("page_id", F.concat(*head, end).alias("record"))
    )


def pages(spark: SparkSession, root: str) -> DataFrame:
    """page_id, url and html (null ones empty) of every archived page, those of revisits from the payload they refer to."""
    joined = headers(spark, root).join(payloads(spark, root), "digest")
    return joined.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.decode("payload", "utf-8").alias("html"))


def field(name: str, header: str = "header") -> Column:
    """A field of a record's header."""
    return F.regexp_extract(F.concat(F.lit(NL), F.col(header), F.lit(NL)), rf"\r\n{name}: ([^\r]*)\r\n", 1)


def parsed(found: DataFrame) -> DataFrame:
    """What the bytes of each record say, and the length and SHA-1 of the payload that they hold.

    A record whose block has not the length its header states is an error, and so is a payload
    without the digest that the header states.
    """
    blank = NL + NL
    text = F.col("record").cast("string")
    rows = found.withColumn("header", F.substring_index(text, blank, 1))
    start = F.octet_length("header") + len(blank)
    rows = rows.withColumn("block", F.substring("record", start + 1, F.octet_length("record") - start - len(blank)))
    http = F.octet_length(F.substring_index(F.col("block").cast("string"), blank, 1)) + len(blank)
    rows = rows.withColumn("payload", F.substring("block", http + 1, F.octet_length("block")))
    rows = rows.withColumn("response", field("WARC-Type") == "response").withColumn("sha1", base32_sha1(F.col("payload")))
    right = (field("Content-Length").cast("long") == F.octet_length("block")) & (
        ~F.col("response") | (field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), "sha1"))
    )
    kind = F.when(right, field("WARC-Type")).otherwise(F.raise_error(F.lit("header and payload differ")).cast("string"))
    return rows.select(
        "page_id", kind.alias("record_type"), field("WARC-Record-ID").alias("record"), field("WARC-Refers-To").alias("refers"),
        F.when(~F.col("response"), field("Refers-To-Page").cast("long")).alias("refers_to"),
        F.when(F.col("response"), F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(F.col("response"), F.col("sha1")).alias("payload_digest"),
    )


def index(spark: SparkSession, root: str) -> DataFrame:
    """What the archive says of each page, read from the rebuilt records; a revisit's payload is that of its response."""
    rows = materialize(parsed(records(spark, root)), "index")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    revisits = rows.where(F.col("record_type") == "revisit").drop("payload_bytes", "payload_digest", "record")
    responses = rows.where(F.col("record_type") == "response")
    facts = responses.select(F.col("record").alias("refers"), "payload_bytes", "payload_digest").distinct()
    found = attach(revisits, facts, ["refers"], F.col("page_id"), facts.count())
    known = F.col("payload_digest").isNotNull()
    digest = F.when(known, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a revisit refers to no response")).cast("string"))
    return responses.select(*names).unionByName(found.withColumn("payload_digest", digest).select(*names))


def archive_and_read(table: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from an archive written and read back."""
    root = shared_dir(table.sparkSession, "archive")
    write(table, root, min_bytes)
    found = index(table.sparkSession, root)
    discard(table.sparkSession, root)
    return found
