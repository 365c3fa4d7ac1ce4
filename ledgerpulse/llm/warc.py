"""WARC archives: write captures, read any archive back, and assemble transactions.

Writing: a capture becomes a response (or, when its payload repeats, a revisit), a request and a
metadata record, the latter two pointing at the first with ``WARC-Concurrent-To``. Records are made
as text columns and written by Spark's text writer with the end of a record as line separator, so an
archive is one gzip file per task and nothing passes through Python or a local disk.

Reading: Spark's text reader cuts a file wherever a record could begin; the parser puts the pieces of a
task together again by ``Content-Length``, so payloads that look like a record, and cuts that the
reader missed, do no harm. It holds one record at a time. Gzip files are read by one task each, in
order, which is what makes this exact; other files must not be split (see ``read_warc``).

Assembly: requests and metadata are gathered by the identifier they are concurrent to, aggregated before
any shuffle, and joined to responses and revisits: one nested row per capture. A capture with several
requests or metadata records carries the one with the smallest record id and the counts of all.

Defined results: a null payload is empty, a null URL has no target, a null key has no ``pageId`` field; line
breaks in a URL are percent-encoded. Captures that share key and payload (or, without a key, URL and
payload) have the same record ids and come back one row each. Payloads under ``smallest`` bytes are never revisits. Of equal larger payloads the
row with the largest key is the response; rows without a key are its revisits, or all responses if no
row has one. Empty tables give empty archives, and those give no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.llm.common import arrow_schema, keyed_join
from ledgerpulse.sources.workspace import materialize

CRLF = "\r\n"
END = "\r\n\r\n"
#: Where the reader cuts; the version's minor digit stays with the record that follows.
CUT = END + "WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, "
    "payload_digest string, payload_bytes bigint, digest_ok boolean, fields map<string,string>, payload binary"
)
_ROWS = 64


def _record_id(kind: str, *parts: Column) -> Column:
    """A URN made from the parts alone, so a task that is run again writes the same."""
    named = [F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts]
    h = F.md5(F.concat_ws("\u0001", F.lit(kind), *named))
    dashed = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *dashed), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without its two closing line breaks; headers whose value is null are left out."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{CRLF}{name}: "), v)) for name, v in headers]
    length = F.concat(F.lit(f"{CRLF}Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.lit("WARC/1.1"), F.concat_ws("", *lines), length, F.lit(END), block)


def first_captures(pages: DataFrame, key: str, payload: str, smallest: int) -> DataFrame:
    """``digest`` and ``first`` (largest key) of every payload of at least ``smallest`` bytes that repeats."""
    body = F.coalesce(F.col(payload), F.lit(""))
    return (
        pages.select(F.col(key).alias("key"), F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).alias("size"))
        .filter(F.col("size") >= smallest)
        .groupBy("digest")
        .agg(F.max("key").alias("first"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select("digest", "first")
    )


def warc_records(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", smallest: int = 1000,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Column ``value`` with the text of every record: response or revisit, request, metadata."""
    firsts = materialize(first_captures(pages, key, payload, smallest), "payloads")
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), body.alias("body"),
        F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).alias("size"),
    ).join(firsts, "digest", "left")
    digest = F.col("digest")
    own = _record_id("capture", F.col("key"), digest, F.when(F.col("key").isNull(), F.col("url")))
    revisit = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    shared = [("WARC-Target-URI", target), ("WARC-Date", F.lit(date))]
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("size").cast("string"), F.lit(END),
    )
    capture = _record([
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", own), *shared,
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(revisit, _record_id("capture", F.col("first"), digest, F.lit(None)))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
    ], F.concat(head, F.when(revisit, "").otherwise(F.col("body"))))
    request = _record([
        ("WARC-Type", F.lit("request")),
        ("WARC-Record-ID", _record_id("request", F.col("key"), F.col("url"), digest)), *shared,
        ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/http;msgtype=request")),
    ], F.concat(F.lit("GET "), F.coalesce(target, F.lit("")), F.lit(f" HTTP/1.1{END}")))
    field = F.when(F.col("key").isNotNull(), F.concat(F.lit("pageId: "), F.col("key").cast("string"), F.lit(CRLF)))
    metadata = _record([
        ("WARC-Type", F.lit("metadata")),
        ("WARC-Record-ID", _record_id("metadata", F.col("key"), F.col("url"), digest)), *shared,
        ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields")),
    ], F.coalesce(field, F.lit("")))
    return rows.select(F.explode(F.array(capture, request, metadata)).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as ``*.txt.gz`` files, each a valid gzipped WARC file."""
    records.write.option("lineSep", END).option("compression", "gzip").text(path)


def _hex(digest: str | None) -> str | None:
    """Lower-case hex of a ``sha1:`` digest in hex or base 32."""
    bare = (digest or "").rpartition(":")[2]
    if len(bare) == 32:
        return base64.b32decode(bare.upper()).hex()
    return bare.lower() or None


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").split(CRLF))
    return {name.strip(): value.strip() for name, mark, value in pairs if mark}


def _size_of(data: bytes) -> tuple[int, int] | None:
    """Start and end of the block of the record that ``data`` begins with; None before its headers are whole."""
    head = data.find(END.encode())
    if head < 0:
        return None
    length = next(
        (int(line.partition(b":")[2]) for line in data[:head].split(b"\r\n") if line[:15].lower() == b"content-length:"), 0
    )
    return head + 4, head + 4 + length


def parse_record(data: bytes, start: int, end: int) -> dict:
    """The columns of one record."""
    headers = {k.lower(): v for k, v in _fields(data[: start - 4]).items()}
    kind, block = headers.get("warc-type"), data[start:end]
    fields, payload, n = {}, block, end - start
    if kind in ("response", "revisit", "request") and "application/http" in headers.get("content-type", ""):
        head, mark, payload = block.partition(END.encode())
        fields = _fields(head.partition(b"\r\n")[2])
        declared = {k.lower(): v for k, v in fields.items()}.get("content-length", "")
        # A revisit has no payload of its own, so its size is what it says; that of a response is what is there.
        n = int(declared) if declared.isdigit() and kind == "revisit" else len(payload)
    elif kind == "metadata":
        fields = _fields(block)
    digest, sound = _hex(headers.get("warc-payload-digest")), None
    if kind == "response":
        own = hashlib.sha1(payload).hexdigest()
        sound = own == digest if digest else None
        digest = own
    return {
        "type": kind, "record_id": headers.get("warc-record-id"), "concurrent_to": headers.get("warc-concurrent-to"),
        "refers_to": headers.get("warc-refers-to"), "target_uri": headers.get("warc-target-uri"),
        "date": headers.get("warc-date"), "payload_digest": digest, "payload_bytes": n,
        "digest_ok": sound,
        "fields": list(fields.items()), "payload": payload,
    }


def split_records(pieces: Iterator[tuple[str, bytes]]) -> Iterator[dict]:
    """Records from (file, piece) in file order; every piece but a file's first lacks the characters cut away."""
    file, data = None, b""
    for name, piece in pieces:
        if name != file:
            yield from _whole(data)
            file, data = name, piece
            continue
        found = _size_of(data)
        if found and len(data) >= found[1]:
            yield from _whole(data)
            data = CUT[len(END):].encode() + piece
        else:  # the cut was inside the record
            data += CUT.encode() + piece
    yield from _whole(data)


def _whole(data: bytes) -> Iterator[dict]:
    """All records in ``data``; a second one is there if the reader missed a cut."""
    while data.startswith(b"WARC/"):
        found = _size_of(data)
        if not found or len(data) < found[1]:
            raise ValueError(f"a record ends early: {data[:80]!r}")
        yield parse_record(data, *found)
        data = data[found[1]:].lstrip(b"\r\n")


def read_warc(spark: SparkSession, path: str, payloads: bool = True, sound: bool = False) -> DataFrame:
    """One row per record of all archives under ``path``; without ``payloads`` that column is null.

    Size and digest of a response are those of the payload that was read. If they contradict the declared digest, ``digest_ok`` is
    false, and with ``sound`` the read fails.

    Files must be gzipped, one member or one per record, as archives are; Spark does not split those.
    """

    schema = arrow_schema(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (
            (batch.column(0)[i].as_py(), batch.column(1)[i].as_py()) for batch in batches for i in range(batch.num_rows)
        )
        rows, size = [], 0
        for record in split_records(pieces):
            if sound and record["digest_ok"] is False:
                raise ValueError(f"the payload of {record['record_id']} does not have the declared digest")
            if not payloads:
                record["payload"] = None
            size += len(record["payload"] or b"")
            rows.append(record)
            if len(rows) == _ROWS or size > 4 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    lines = spark.read.option("lineSep", CUT).text(path)
    return lines.select(F.col("_metadata.file_path"), F.col("value").cast("binary")).mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per response or revisit: ``capture``, ``request`` and ``metadata`` structs and their counts."""
    bare = F.struct("record_id", "target_uri", "date", F.to_json("fields").alias("fields"))

    def beside(kind: str) -> DataFrame:
        return (
            records.filter(F.col("type") == kind)
            .groupBy(F.col("concurrent_to").alias("record_id"))
            .agg(F.min(bare).alias(kind), F.count_distinct("record_id").alias(f"n_{kind}"))
        )

    captures = records.filter(F.col("type").isin("response", "revisit"))
    whole = F.struct(*[c for c in records.columns if c not in ("concurrent_to", "fields")])
    out = captures.select("record_id", whole.alias("capture"))
    for kind in ("request", "metadata"):
        out = keyed_join(out, beside(kind), ["record_id"], "left").withColumn(f"n_{kind}", F.coalesce(f"n_{kind}", F.lit(0)))
    return out.drop("record_id")


def capture_digests(transactions: DataFrame) -> DataFrame:
    """``page_id``, payload size and digest, record type and, for revisits, the page they refer to."""
    field = F.from_json("metadata.fields", "map<string,string>")
    rows = transactions.select(
        field["pageId"].cast("bigint").alias("page_id"), "capture.payload_bytes", "capture.payload_digest",
        F.col("capture.type").alias("record_type"), F.col("capture.refers_to").alias("refers"),
        F.col("capture.record_id").alias("record_id"),
    )
    responses = (
        rows.filter("record_type = 'response'").groupBy(F.col("record_id").alias("refers")).agg(F.max("page_id").alias("refers_to"))
    )
    return keyed_join(rows, responses, ["refers"], "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
