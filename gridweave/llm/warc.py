"""WARC archives: write captures with revisits, read archives, and assemble transactions through concurrent-to identifiers."""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.sources.scratch import new_path
from gridweave.sources.workers import map_arrow

CRLF = "\r\n"
VERSION = "WARC/1.1"
#: Date of all records: tables hold none, and equal input is to give equal archives.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record(kind: str, name: Column, url: Column, content_type: str, block: Column, *more: tuple[str, Column]) -> Column:
    """Text of a record: version line, named fields (those with a null value are left out), empty line, block, two line ends."""
    fields = [("WARC-Type", F.lit(kind)), ("WARC-Record-ID", name), ("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", url), *more, ("Content-Type", F.lit(content_type)), ("Content-Length", F.octet_length(block).cast("string"))]
    lines = [F.concat(F.lit(f"{key}: "), value, F.lit(CRLF)) for key, value in fields]
    return F.concat(F.lit(VERSION + CRLF), F.concat_ws("", *lines), F.lit(CRLF), block, F.lit(CRLF + CRLF))


def _uri(text: Column) -> Column:
    """A URL as one line of a header; control characters and spaces are percent-encoded."""
    for raw in "\r\n\t ":
        text = F.replace(text, F.lit(raw), F.lit(f"%{ord(raw):02X}"))
    return text


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 100) -> DataFrame:
    """One row per page with ``payload``, its size and digest, ``row`` (hash of URL and payload) and ``first``:
    id and ``row`` of the response among rows with the same payload.

    Payloads are grouped by digest over all pages; only digests and ids are shuffled for that, and only digests that occur more than once are
    joined back. Payloads under ``least_bytes`` are never grouped.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn("row", F.lower(F.hex(F.xxhash64("url", "digest"))))
    copies = rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min(F.when(F.col("id").isNotNull(), F.struct("id", "row"))).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL").select("digest", "first")
    return rows.join(copies, "digest", "left").withColumn("first", F.when(F.col("bytes") >= least_bytes, F.col("first")))


#: An empty member, to end a file whose last byte is not the zero that the writer puts there.
_EMPTY = gzip.compress(b"", mtime=0)


def archives(records: DataFrame, archive_bytes: int) -> DataFrame:
    """Whole archives, one row each, of records (column ``value``): each a gzip member of its own, ``archive_bytes`` or one record long at the least.

    The last byte of an archive, a zero, is left for the text writer to put there as the end of its line.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[bytes] = []
        size = 0

        def whole() -> pa.RecordBatch:
            data = b"".join(members)
            members.clear()
            return pa.RecordBatch.from_arrays([pa.array([data[:-1] if data[-1] == 0 else data + _EMPTY[:-1]], pa.binary())], names=["value"])

        for batch in batches:
            for value in batch.column(0):
                made = zlib.compressobj(4, zlib.DEFLATED, 31)
                members.append(made.compress(value.as_py()) + made.flush())
                size += len(members[-1])
                if size >= archive_bytes:
                    yield whole()
                    size = 0
        if members:
            yield whole()

    return map_arrow(records.select(F.col("value").cast("binary").alias("value")), run, "value binary").select(F.col("value").cast("string"))


def write(pages: DataFrame, path: str, archive_bytes: int = 16 << 20, **columns) -> None:
    """Write three records per page - request, response or revisit, metadata - to archives in ``path``, each record a gzip member.

    A page whose payload has a smaller-numbered equal is a revisit, without the payload; it names the record of the response in
    ``WARC-Refers-To``. The response or revisit and the metadata name the request in ``WARC-Concurrent-To``; the request's identifier is
    the transaction's. Pages that share the smallest id are all responses. Identifiers come from id, URL and payload, so that rows equal
    in these give equal records. Archives are cut by their compressed size, at ``archive_bytes``
    or the end of the record that goes beyond it. Spark's own text writer writes them, on any store that it reaches, so their names end as
    its names do.
    """
    rows = captures(pages, **columns)
    anchor = lambda id_, row: F.concat(F.coalesce(id_.cast("string"), F.lit("null")), F.lit("/"), row)
    name = lambda kind: F.concat(F.lit("<urn:capture:"), F.col("anchor"), F.lit(f":{kind}>"))
    revisit = F.col("first").isNotNull() & ((F.col("id") != F.col("first.id")) | F.col("id").isNull())
    refers = F.concat(F.lit("<urn:capture:"), anchor(F.col("first.id"), F.col("first.row")), F.lit(":response>"))
    url = F.coalesce(_uri(F.col("url")), F.lit("about:blank"))
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    head = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}")
    both = [("WARC-Concurrent-To", name("request")), ("WARC-Payload-Digest", digest)]
    content = "application/http; msgtype="
    response = _record("response", name("response"), url, content + "response", F.concat(head, F.col("payload")), *both)
    again = _record("revisit", name("revisit"), url, content + "response", head, *both, ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", refers))
    request = _record("request", name("request"), url, content + "request", F.concat(F.lit("GET "), url, F.lit(f" HTTP/1.1{CRLF}{CRLF}")))
    notes = F.concat(F.lit("page: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(f"{CRLF}payloadLength: "), F.col("bytes").cast("string"), F.lit(CRLF))
    metadata = _record("metadata", name("metadata"), url, "application/warc-fields", notes, ("WARC-Concurrent-To", name("request")))
    records = rows.withColumn("anchor", anchor(F.col("id"), F.col("row"))).select(F.explode(F.array(request, F.when(revisit, again).otherwise(response), metadata)).alias("value"))
    archives(records, archive_bytes).write.option("compression", "none").option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def inflated(data: bytes) -> bytes:
    """All members of compressed data, one after the other. Fed in small pieces, since what follows a member's end is handed back as a copy."""
    out, at = [], 0
    while at < len(data):
        member = zlib.decompressobj(31)
        while not member.eof and at < len(data):
            out.append(member.decompress(data[at : at + 16_384]))
            at = min(at + 16_384, len(data)) - len(member.unused_data)
        if not member.eof:
            raise ValueError("compressed data is cut off")
    return b"".join(out)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an archive, plain or compressed as a whole or by records: fields with lower-case names, and the block."""
    if data[:2] == b"\x1f\x8b":
        data = inflated(data)
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or data[at : at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        fields: dict[str, str] = {}
        last = ""
        for line in data[at:end].decode("utf-8", "replace").split(CRLF)[1:]:
            if line[:1] in " \t" and last:
                fields[last] += " " + line.strip()
            else:
                key, _, value = line.partition(":")
                last = key.strip().lower()
                fields[last] = value.strip()
        size = int(fields["content-length"])
        at = end + 4 + size
        if at > len(data):
            raise ValueError(f"record {fields.get('warc-record-id')} is cut off")
        yield fields, data[end + 4 : at]


FIELDS = ("warc-type", "warc-record-id", "warc-target-uri", "warc-date", "warc-concurrent-to", "warc-payload-digest", "warc-refers-to")


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in ``path``: ``kind``, ``record_id``, ``url``, ``date``, ``concurrent_to``, ``payload_digest``, ``refers_to``,
    ``http_head``, ``payload``, and what the reader measured itself: ``bytes`` and ``sha256`` of the payload.

    A file is read whole by one task, so archives are to be cut to some tens of megabytes, as ``write`` does; plain ones and those
    compressed by records or as a whole are read. A broken archive raises.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{txt,gz,warc}").load(path).select("content")
    names = ["kind", "record_id", "url", "date", "concurrent_to", "payload_digest", "refers_to", "http_head", "payload", "bytes", "sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in parse(content.as_py()):
                    head, _, body = block.partition(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
                    rows.append((*(fields.get(f) for f in FIELDS), head.decode("utf-8", "replace"), body, len(body), hashlib.sha256(body).hexdigest()))
                columns = list(zip(*rows)) or [[]] * len(names)
                kinds = [pa.string()] * 8 + [pa.binary(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return map_arrow(files, run, "kind string, record_id string, url string, date string, concurrent_to string, payload_digest string, refers_to string, http_head string, payload binary, bytes bigint, sha256 string")


def transactions(records: DataFrame, payload: bool = True) -> DataFrame:
    """One nested row per capture: ``capture`` (the request's identifier), ``request``, ``response`` (response or revisit) and ``metadata`` structs,
    and ``times``, how often its response or revisit came.

    Records are joined through their concurrent-to identifier, a request through its own; all three meet in one shuffle by that identifier.
    A capture with records missing has nulls for them; a record that names no other is a capture of its own. ``payload``
    false leaves the payloads out, and then they are not shuffled. A capture has one record of each kind; of several, that with the
    smallest identifier is taken.
    """
    kept = ["record_id", "kind", "url", "date", "payload_digest", "refers_to", "http_head", "bytes", "sha256"] + ["payload"] * payload
    fields = F.when(F.col("kind") == "metadata", F.col("payload").cast("string"))
    own = records.select(*kept, F.coalesce("concurrent_to", "record_id").alias("capture"), fields.alias("fields"))
    part = lambda *kinds: F.min(F.when(F.col("kind").isin(*kinds), F.struct(*kept)))
    notes = F.min(F.when(F.col("kind") == "metadata", F.struct("record_id", "fields")))
    times = F.greatest(F.count_if(F.col("kind").isin("response", "revisit")), F.lit(1))
    return own.groupBy("capture").agg(part("request").alias("request"), part("response", "revisit").alias("response"), notes.alias("metadata"), times.alias("times"))


def resolved(captured: DataFrame) -> DataFrame:
    """``captured`` with ``refers_capture``: for a revisit the capture whose response record it refers to, found by that record's identifier."""
    told = captured.where("response.kind = 'response'").select(F.col("response.record_id").alias("_record"), F.col("capture").alias("refers_capture"))
    return captured.join(told, F.col("response.refers_to") == F.col("_record"), "left").drop("_record")


def digests(captured: DataFrame, id_col: str = "page_id", kind: str = "bigint") -> DataFrame:
    """For each capture from its assembled records, as often as it came: the page, size and digest of the full payload, ``record_type`` and ``refers_to``.

    A response's payload is measured as read; a revisit's size is in its metadata and its digest in its own fields. A response whose digest
    as read is not the one in its fields raises. The page that a revisit refers to is in the identifier of the response's record, as ``write`` makes it.
    """
    note = lambda key: F.nullif(F.regexp_extract(F.col("metadata.fields"), rf"(?m)^{key}: (.*?)\r?$", 1), F.lit(""))
    told = F.substring_index(F.col("response.payload_digest"), ":", -1)
    whole = F.col("response.kind") == "response"
    checked = F.when(whole & (F.col("response.sha256") != told), F.raise_error(F.concat(F.lit("payload differs from its digest: "), F.col("capture")))).otherwise(told)
    return captured.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select(
        note("page").cast(kind).alias(id_col),
        F.when(whole, F.col("response.bytes")).otherwise(note("payloadLength").cast("bigint")).alias("payload_bytes"),
        checked.alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        F.nullif(F.regexp_extract(F.coalesce("response.refers_to", F.lit("")), r"^<urn:capture:(.*)/[0-9a-f]+:response>$", 1), F.lit("")).cast(kind).alias("refers_to"),
    )


def round_trip(pages: DataFrame, id_col: str = "page_id", **columns) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back, assemble the captures, and return ``digests``.

    One row per row of ``pages``. Null html is an empty payload, a null url is ``about:blank``; null ids stay null and are never referred to; repeated
    rows are captures of their own; no rows give no rows; other columns are not read; very long payloads are one record.
    """
    path = new_path(pages.sparkSession, "warc")
    write(pages, path, id_col=id_col, **columns)
    return digests(transactions(read(pages.sparkSession, path), payload=False), id_col, dict(pages.dtypes)[id_col])
