"""Content-addressed WARC archives: payloads once by digest, record headers apart, records by a join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.session import remove, shuffles_removed

#: Formats that must be as they are: line ends, and the digits of base 32 in hexadecimal and in RFC 4648 order.
CRLF = "\r\n"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Payloads are addressed by a strong digest beside the SHA-1 that the headers name.
STRONG_BITS = 256
LEAST_BYTES = 0


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base 32 of the SHA-1: 40 hex digits are eight groups of five, four base-32 digits each."""
    hexed = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), BASE32_HEX, BASE32)


def header_block(record_type: Column, record_id: Column, uri: Column, date: Column, digest: Column,
                 length: Column, refers_to: Column) -> Column:
    """The exact header lines of a record, with the blank line that ends them."""
    fields = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), record_type), F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.concat(F.lit("WARC-Target-URI: "), uri), F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest),
        F.concat(F.lit("WARC-Refers-To: "), refers_to),
        F.when(record_type == "revisit", F.lit(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html"), F.concat(F.lit("Content-Length: "), length.cast("string"))]
    return F.concat(F.concat_ws(CRLF, *fields), F.lit(CRLF + CRLF))


def one_line(value: Column) -> Column:
    """A header value: null as empty, line ends as blanks, so that it can't end its line."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), "[\r\n]+", " ")


def write_archive(pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html",
                  least_bytes: int = LEAST_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write `pages` as two tables under `path`: `payloads` (strong, length, bytes), each payload once,
    and `headers` (key, record_type, refers_to, header, strong, sha1, length), one row per page.

    Of pages with equal payloads of at least `least_bytes` bytes, that with the smallest key is a response
    and the others are revisits of it; smaller payloads are all responses. Payloads are equal when
    their SHA-256 and their lengths are.

    Null payload is empty; a null key sorts last and is written empty; rows that repeat key and payload
    of the response are responses of the same capture; other columns are not looked at. The smallest key
    of a digest is found with partial sums before the shuffle, so a payload in a third of all pages is
    a few rows; of payload bytes each task sends one copy of each, once.
    """
    data = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(key).alias("key"), one_line(F.col(uri)).alias("uri"), data.alias("bytes"))
    keyed = rows.select("key", "uri", F.sha2("bytes", STRONG_BITS).alias("strong"), base32_sha1(F.col("bytes")).alias("sha1"),
                        F.octet_length("bytes").cast("long").alias("length"))
    first = keyed.groupBy("strong", "length").agg(F.min("key").alias("first")).withColumnsRenamed(
        {"strong": "of", "length": "of_length"})
    own = (F.col("strong") == F.col("of")) & (F.col("length") == F.col("of_length"))
    is_first = F.col("key").eqNullSafe(F.col("first")) | (F.col("length") < least_bytes)
    record_type = F.when(is_first, F.lit("response")).otherwise(F.lit("revisit"))
    refers_to = F.when(~is_first, F.col("first"))
    name = lambda k: F.concat(F.lit("<urn:page:"), k.cast("string"), F.lit(">"))
    headers = keyed.join(first, own).select(
        "key", record_type.alias("record_type"), refers_to.alias("refers_to"),
        header_block(record_type, name(F.coalesce(F.col("key").cast("string"), F.lit(""))), F.col("uri"), F.lit(date),
                     F.col("sha1"), F.when(is_first, F.col("length")).otherwise(0),
                     F.when(~is_first, name(F.col("first")))).alias("header"),
        "strong", "sha1", "length")
    stored = (rows.groupBy(F.sha2("bytes", STRONG_BITS).alias("strong"), F.octet_length("bytes").cast("long").alias("length"))
              .agg(F.any_value("bytes").alias("bytes")))
    with shuffles_removed(pages.sparkSession):
        headers.write.option("compression", "zstd").parquet(f"{path}/headers")
        stored.write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive: key, record_type, refers_to, payload_digest, payload_bytes, header, payload, record.

    The digest and the length are taken from the stored bytes again and must be those that the header names;
    a difference ends the job. `record` is the original record: header, payload unless it is a revisit,
    and the two line ends that close it.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").select(
        F.col("strong").alias("of"), "bytes", F.octet_length("bytes").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("bytes")).alias("payload_digest"),
        (F.sha2("bytes", STRONG_BITS) == F.col("strong")).alias("sound"))
    named = F.regexp_extract("header", "WARC-Payload-Digest: sha1:([A-Z2-7]{32})", 1)
    sound = reduce(lambda a, b: a & b, [F.coalesce("sound", F.lit(False)), F.col("payload_digest") == named,
                                        F.col("payload_bytes") == F.col("length")])
    joined = headers.join(payloads, F.col("strong") == F.col("of"), "left")
    body = F.when(F.col("record_type") == "response", F.col("bytes")).otherwise(F.lit("").cast("binary"))
    return joined.select(
        "key", "record_type", "refers_to", "header",
        F.when(sound, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a stored payload differs from its digest")).cast("string"))
        .alias("payload_digest"), "payload_bytes", F.col("bytes").alias("payload"),
        F.concat(F.col("header").cast("binary"), body, F.lit(CRLF + CRLF).cast("binary")).alias("record"))


def remove_archive(spark: SparkSession, path: str) -> None:
    remove(spark, path)
