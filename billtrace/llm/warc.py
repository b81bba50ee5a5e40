"""WARC archives: writing captures, reading records back, and assembling transactions.

A capture is three records: request, response (or revisit, where an earlier capture has the same
payload) and metadata. Request and metadata name the response in WARC-Concurrent-To. Reading goes
by Content-Length, so payloads may hold anything, blank lines and header-like lines included.
Assembly joins the three kinds through that identifier and gives one nested row per capture.

Spark's text writer makes the files, so they go wherever Spark can write; a file holds
``per_file`` captures at most, since it is read as a whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import attach
from .common import map_rows, staged

CRLF = "\r\n"
MIN_REVISIT_BYTES = 100
FILE_BYTES = 1 << 29  # before compression
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("concurrent_to", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("declared_digest", T.StringType()),
        T.StructField("head", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    ]
)


def _uuid(kind: str, page: Column, digest: Column, copy: Column) -> Column:
    """Record number that follows from the page, its payload and which copy it is (0: the first), so that others can name it."""
    h = F.sha2(F.concat_ws("|", F.lit(kind), F.coalesce(page.cast("string"), F.lit("null")), digest, copy.cast("string")), 256)
    parts = [F.substring(h, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without its closing blank line; headers that are NULL are left out."""
    lines = [F.lit("WARC/1.1"), *[F.concat(F.lit(f"{name}: "), value) for name, value in headers]]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws(CRLF, *lines, length), F.lit(CRLF * 2), block)


def write_captures(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2025-01-01T00:00:00Z", per_file: int = 1000
) -> None:
    """Write one transaction per row of ``pages`` below ``path``.

    Of pages with equal payloads of ``MIN_REVISIT_BYTES`` and more, the one with the smallest id is
    the response and the others revisit it. NULL html is an empty payload; a NULL url leaves out
    the header; a NULL id never is the response of others. Rows that repeat an id and a payload are
    captures of their own: they are numbered, for which the rows are written once more. A file
    holds fewer captures where payloads are so long that it would grow beyond ``FILE_BYTES``.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("page"),
        F.regexp_replace(F.col(url_col), r"[\x00-\x20]", "+").alias("url"),
        html.alias("html"),
        F.octet_length(html).alias("size"),
        F.sha2(html, 256).alias("digest"),
        F.lit(0).cast("long").alias("copy"),
    )
    known = rows.groupBy("digest", "page").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    repeats, longest = known.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    per_file = max(1, min(per_file, FILE_BYTES // (longest + 2000)))
    if repeats > 1:
        rows = staged(rows.withColumn("number", F.monotonically_increasing_id()), "pages")
        least = rows.groupBy("digest", "page").agg(F.min("number").alias("least"), F.count("*").alias("n")).filter("n > 1")
        least = staged(least.select(F.col("digest").alias("__d"), F.col("page").alias("__p"), "least"), "least")
        rows = rows.join(least, (F.col("digest") == F.col("__d")) & F.col("page").eqNullSafe(F.col("__p")), "left")
        copy = F.when(F.col("number") > F.col("least"), F.col("number")).otherwise(0)
        rows = rows.select("page", "url", "html", "size", "digest", copy.alias("copy"))
    long_enough = F.col("size") >= MIN_REVISIT_BYTES
    firsts = rows.filter(long_enough).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = attach(rows, firsts, ["digest"])
    page, url, digest, size, copy = (F.col(c) for c in ("page", "url", "digest", "size", "copy"))
    is_revisit = long_enough & F.col("first").isNotNull() & ~page.eqNullSafe(F.col("first"))
    own, date_header = _uuid("response", page, digest, copy), ("WARC-Date", F.lit(date))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size.cast("string"), F.lit(CRLF * 2))
    response = _record(
        [
            ("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
            ("WARC-Record-ID", own),
            date_header,
            ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
            ("WARC-Profile", F.when(is_revisit, REVISIT_PROFILE)),
            ("WARC-Refers-To", F.when(is_revisit, _uuid("response", F.col("first"), digest, F.lit(0)))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(is_revisit, http).otherwise(F.concat(http, F.col("html"))),
    )
    host = F.regexp_extract(url, r"^[a-z]+://([^/?#]+)", 1)
    target = F.regexp_replace(url, r"^[a-z]+://[^/?#]+", "")
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _uuid("request", page, digest, copy)), date_header, ("WARC-Target-URI", url), ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(f" HTTP/1.1{CRLF}Host: "), F.coalesce(host, F.lit("")), F.lit(CRLF * 2)),
    )
    fields = F.concat(F.lit("page-id: "), F.coalesce(page.cast("string"), F.lit("")))
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _uuid("metadata", page, digest, copy)), date_header, ("WARC-Target-URI", url), ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields"))],
        fields,
    )
    end = CRLF * 2  # closes each record; the writer adds the last
    rows.select(F.concat_ws(end, request, response, metadata)).write.option("lineSep", end).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def _fields(block: bytes) -> dict[str, str]:
    pairs = (line.split(b": ", 1) for line in block.split(b"\r\n") if b": " in line)
    return {k.decode(errors="replace").lower(): v.decode(errors="replace") for k, v in pairs}


def parse_records(data: bytes) -> Iterator[dict]:
    """Records of one archive, by Content-Length."""
    at = 0
    while at < len(data):
        cut = data.index(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/1.", at):
            raise ValueError(f"no record at byte {at}")
        header = _fields(data[at:cut])
        start = cut + 4
        end = start + int(header["content-length"])
        block, at = data[start:end], end + 4
        if data[end:at] != b"\r\n\r\n":
            raise ValueError(f"no end of record at byte {end}")
        kind = header["warc-type"]
        out = {f.name: None for f in RECORD} | {"record_id": header["warc-record-id"], "kind": kind, "concurrent_to": header.get("warc-concurrent-to"), "refers_to": header.get("warc-refers-to"), "uri": header.get("warc-target-uri"), "declared_digest": header.get("warc-payload-digest", "").removeprefix("sha256:") or None}
        if kind == "metadata":
            out["fields"] = list(_fields(block).items())
        else:
            head, _, body = block.partition(b"\r\n\r\n")
            out["head"] = head.decode(errors="replace")
            if kind == "response":
                out["payload"], out["payload_bytes"], out["payload_digest"] = body, len(body), hashlib.sha256(body).hexdigest()
        yield out


def _unpacked(data: bytes) -> bytes:
    out = []
    while data:  # one gzip member after the other
        member = zlib.decompressobj(31)
        out += [member.decompress(data), member.flush()]
        data = member.unused_data
    return b"".join(out)


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per WARC record of the gzip files below ``path``; without ``payload`` its digest alone is kept."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(parse_records(_unpacked(batch.column("content")[i].as_py())))
                if not payload:
                    for r in rows:
                        r["payload"] = None
                yield {f.name: [r[f.name] for r in rows] for f in RECORD}

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return map_rows(files.select("content"), RECORD, step)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture, joined through the concurrent-to identifiers.

    Captures without a request or metadata record have NULL there. A record that is read twice, from
    two copies of a file, counts once. Other columns of ``records`` are ignored.
    """
    main = records.filter(F.col("kind").isin("response", "revisit")).select(
        "record_id", "uri", F.struct("kind", "refers_to", "declared_digest", "head", "payload", "payload_bytes", "payload_digest").alias("response")
    )
    other = records.filter(F.col("concurrent_to").isNotNull())

    def part(kind: str, column: str) -> DataFrame:
        rows = other.filter(F.col("kind") == kind)
        own = F.struct("record_id", "head", "uri") if kind == "request" else F.struct("record_id", F.col("fields").alias("fields"))
        return rows.groupBy(F.col("concurrent_to").alias("record_id")).agg(F.any_value(own).alias(column))

    main = main.groupBy("record_id").agg(F.any_value("uri").alias("uri"), F.any_value("response").alias("response"))
    return main.join(part("request", "request"), "record_id", "left").join(part("metadata", "metadata"), "record_id", "left")


def originals(captures: DataFrame) -> DataFrame:
    """Each capture's record_id, page, kind, and the digest and size of its full payload as read, that of a revisit
    through WARC-Refers-To. ``refers_to`` is the page of the response, NULL for others.

    ``captures`` is written first, narrow, as it is read twice. A revisit of what is not there has
    its declared digest, and no size.
    """
    response = F.col("response")
    own = captures.select(
        "record_id",
        F.nullif(F.col("metadata.fields")["page-id"], F.lit("")).alias("page"),
        response["kind"].alias("kind"),
        F.when(response["kind"] == "revisit", response["refers_to"]).alias("original"),
        F.coalesce(response["payload_digest"], response["declared_digest"]).alias("digest"),
        F.when(response["kind"] == "response", response["payload_bytes"]).alias("bytes"),
    )
    own = staged(own, "captures")
    wanted = own.filter(F.col("original").isNotNull()).select(F.col("original").alias("record_id")).distinct()
    found = own.filter("kind = 'response'").join(wanted, "record_id", "left_semi")
    found = found.select(F.col("record_id").alias("original"), F.col("page").alias("refers_to"), F.col("bytes").alias("__bytes"), F.col("digest").alias("__digest"))
    both = attach(own, found, ["original"])
    return both.select("record_id", "page", "kind", F.coalesce("__digest", "digest").alias("digest"), F.coalesce("bytes", "__bytes").alias("bytes"), "refers_to")
