"""WARC archives: writing captures, reading archives back, and assembling transactions.

Each page gives a response (or, for a payload that an earlier page has, a revisit), a request and a metadata record. The
request names the response in WARC-Concurrent-To, the metadata record names the request. Tasks write archives of bounded size, each
record a gzip member of its own, and read them as streams, so that neither holds more than a record of any length. Reading finds
records by their Content-Length, in plain and in gzip files of any number of members. Assembly follows concurrent-to identifiers,
also over one record in between and also from a response to its request, and emits one nested row per capture.

Every row is a capture, also rows that repeat a page id, url and html: one of them may be the response, the others revisit it. Null
page ids come after all others: they are the response only if no page with an id has the payload, and revisits of one refer to a
record, but to no page id. Null html is an empty payload. Null urls have no WARC-Target-URI; line breaks in a url are written as %0D
and %0A. Records without a response form captures of their own. Extra columns are ignored. An empty table gives no archive and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, delete, filesystem, new_path

END = "\r\n"
REVISIT_BYTES = 100
#: A file ends with the capture that brings it to so many bytes.
FILE_BYTES = 256 << 20
#: Copies of one row that a task numbers.
COPIES = 1000
DATE = "2024-01-01T00:00:00Z"


def _record_id(kind: str, *parts: str) -> Column:
    """A urn:uuid from what identifies the capture."""
    h = F.md5(F.concat_ws("\u0001", F.lit(kind), *(F.coalesce(F.col(p).cast("string"), F.lit("\u0002")) for p in parts)))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _record(headers: list[Column], block: Column) -> Column:
    """The lines of headers (null ones are left out), an empty line, and the block."""
    lines = F.concat_ws(END, F.lit("WARC/1.1"), *headers, F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(lines, F.lit(END + END), block)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + ": "), value)


def _clean(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _numbered(rows: DataFrame, per: DataFrame) -> DataFrame:
    """rows with n: 0, and for rows that repeat in full 0, 1, 2 ... per(digest, page_id, url, copies)."""
    key = ("digest", "page_id", "url")
    again = cut(per.filter("copies > 1").select(*(F.col(c).alias(f"__{c}") for c in key), "copies"), "repeated")
    one = F.lit(0).cast("long").alias("n")
    if again.isEmpty():
        return rows.select("*", one)
    same = (F.col("digest") == F.col("__digest")) & F.col("page_id").eqNullSafe(F.col("__page_id")) & F.col("url").eqNullSafe(F.col("__url"))
    # One row of each kind goes on; its copies are made in tasks of their own, a bounded number each.
    single = rows.join(again, same, "left_anti").select("*", one)
    kinds = rows.join(again, same).drop("__digest", "__page_id", "__url").dropDuplicates(key)
    dealt = kinds.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}")))).repartition("digest", "page_id", "url", "block")
    last = F.least(F.col("copies"), (F.col("block") + 1) * COPIES) - 1
    return single.unionByName(dealt.withColumn("n", F.explode(F.sequence(F.col("block") * COPIES, last))).drop("copies", "block"))


def _compressed(record: bytes) -> bytes:
    """A record and the two line breaks after it as one gzip member."""
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.compress(b"\r\n\r\n") + packer.flush()


def write_archive(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Adds archives of pages(page_id, url, html) to the folder `path`. Files appear there when all are complete."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.select("*", F.octet_length("html").cast("long").alias("bytes"), F.sha2("html", 256).alias("digest"))
    per = cut(rows.groupBy("digest", "page_id", "url").agg(F.count(F.lit(1)).alias("copies"), F.max("bytes").alias("bytes")), "payloads")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url")
    first = per.filter(F.col("bytes") >= revisit_bytes).groupBy("digest").agg(F.min(order).alias("first"), F.sum("copies").alias("n")).filter("n > 1").select("digest", "first")
    first = cut(first, "first-payloads")
    told = _numbered(rows, per).join(first, "digest", "left").withColumns({"first_id": F.col("first.page_id"), "first_url": F.col("first.url"), "zero": F.lit(0).cast("long")})
    # A payload under the size has no entry: its digest isn't among those of large ones.
    again = F.col("first").isNotNull() & ~(F.col("first_id").eqNullSafe(F.col("page_id")) & F.col("first_url").eqNullSafe(F.col("url")) & (F.col("n") == 0))
    me = ("page_id", "url", "digest", "n")
    told = told.withColumns({"again": again, "response_id": _record_id("response", *me), "request_id": _record_id("request", *me), "metadata_id": _record_id("metadata", *me), "first_response": _record_id("response", "first_id", "first_url", "digest", "zero")})
    date, uri, page = F.lit("WARC-Date: " + DATE), _header("WARC-Target-URI", _clean(F.col("url"))), _header("X-Page-Id", F.col("page_id").cast("string"))
    kind = F.when(F.col("again"), "revisit").otherwise("response")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END + END))
    response = _record(
        [
            _header("WARC-Type", kind),
            _header("WARC-Record-ID", F.col("response_id")),
            date,
            uri,
            page,
            _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
            F.when(F.col("again"), _header("WARC-Refers-To", F.col("first_response"))),
            F.when(F.col("again"), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            F.lit("Content-Type: application/http;msgtype=response"),
        ],
        F.concat(http, F.when(F.col("again"), "").otherwise(F.col("html"))),
    )
    target = F.coalesce(F.regexp_extract(_clean(F.col("url")), r"://[^/?#]*([^#]*)", 1), F.lit(""))
    host = F.coalesce(F.regexp_extract(_clean(F.col("url")), r"://([^/?#]*)", 1), F.lit(""))
    request = _record(
        [F.lit("WARC-Type: request"), _header("WARC-Record-ID", F.col("request_id")), date, uri, _header("WARC-Concurrent-To", F.col("response_id")), F.lit("Content-Type: application/http;msgtype=request")],
        F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END + END)),
    )
    metadata = _record([F.lit("WARC-Type: metadata"), _header("WARC-Record-ID", F.col("metadata_id")), date, uri, _header("WARC-Concurrent-To", F.col("request_id")), F.lit("Content-Type: application/warc-fields")], F.lit("via: seriesflow\r\n"))
    staging = f"{path}/_staging-{uuid.uuid4().hex}"

    def write(batches):
        store, root = filesystem(staging)
        out, names = None, []
        for batch in batches:
            for records in zip(*(c.cast(pa.binary()).to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    # An attempt that fails leaves a file that nothing names.
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out = store.open_output_stream(f"{root}/{names[-1]}", compression=None)
                for record in records:
                    out.write(_compressed(record))
                if out.tell() >= file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    store, root = filesystem(path)
    store.create_dir(filesystem(staging)[1], recursive=True)
    written = told.select(response.alias("response"), request.alias("request"), metadata.alias("metadata")).mapInArrow(write, "name string").collect()
    for row in written:
        store.move(f"{filesystem(staging)[1]}/{row.name}", f"{root}/{row.name}")
    delete(pages.sparkSession, staging)


def _opened(source: pa.NativeFile) -> io.BufferedIOBase:
    """An archive's bytes as a stream, unpacked if it is gzip."""
    packed = source.read(2) == b"\x1f\x8b"
    source.seek(0)
    return gzip.GzipFile(fileobj=source, mode="rb") if packed else io.BufferedReader(source)


def parse_records(stream: io.BufferedIOBase):
    """(headers with lower-cased names, block) of each record of an archive."""
    while line := stream.readline():
        # Line breaks end a record.
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        yield headers, stream.read(int(headers.get("content-length", "0")))


RECORD = "record_id string, kind string, concurrent_to string, refers_to string, target_uri string, page_id long, payload_bytes long, payload_digest string, payload binary"


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in a folder. The digest of a response is that of its payload as read; that of a revisit is from its header.

    Spark lists the files, and tasks read them as streams."""
    names = [c.strip().split()[0] for c in RECORD.split(",")]
    kinds = [pa.int64() if n in ("page_id", "payload_bytes") else pa.binary() if n == "payload" else pa.string() for n in names]

    def row(headers, block):
        kind = headers.get("warc-type")
        payload = size = digest = None
        if kind in ("response", "revisit"):
            head, _, payload = block.partition(b"\r\n\r\n")
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
            if kind == "revisit":
                digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
                size = next((int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), size)
        page = headers.get("x-page-id")
        return headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-refers-to"), headers.get("warc-target-uri"), int(page) if page else None, size, digest, payload if payloads else None

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def parse(batches):
        for batch in batches:
            for name in batch.column("path").to_pylist():
                store, file = filesystem(name)
                rows, size = [], 0
                with store.open_input_file(file) as source:
                    for headers, block in parse_records(_opened(source)):
                        rows.append(row(headers, block))
                        size += len(block) if payloads else 0
                        if len(rows) >= 4096 or size >= 8 << 20:
                            yield packed(rows)
                            rows, size = [], 0
                if rows:
                    yield packed(rows)

    return spark.read.format("binaryFile").load(path).select("path").mapInArrow(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id, response, request (structs) and metadata (array of structs)."""
    answers = F.col("kind").isin("response", "revisit")
    fields = F.struct("record_id", "kind", "target_uri", "page_id", "payload_bytes", "payload_digest", "refers_to", "payload")
    links = records.filter("concurrent_to is not null").select("record_id", "concurrent_to", answers.alias("answers")).distinct()
    # What a record belongs to: the response it names, or the one that the record it names names, or the response that names it.
    ahead = links.filter("not answers").select(F.col("record_id").alias("via"), F.col("concurrent_to").alias("beyond"))
    named_by = links.filter("answers").groupBy("concurrent_to").agg(F.min("record_id").alias("answer"))
    rest = records.filter(~answers).withColumn("target", F.coalesce("concurrent_to", "record_id"))
    rest = rest.join(ahead, rest["target"] == ahead["via"], "left").withColumn("target", F.coalesce("beyond", "target")).drop("via", "beyond")
    rest = rest.join(named_by.withColumnRenamed("concurrent_to", "named"), F.col("target") == F.col("named"), "left").withColumn("capture_id", F.coalesce("answer", "target"))
    every = records.filter(answers).select(F.col("record_id").alias("capture_id"), "kind", fields.alias("r")).unionByName(rest.select("capture_id", "kind", fields.alias("r")))
    return every.groupBy("capture_id").agg(
        F.first(F.when(answers, F.col("r")), ignorenulls=True).alias("response"),
        F.first(F.when(F.col("kind") == "request", F.col("r")), ignorenulls=True).alias("request"),
        F.collect_set(F.when(F.col("kind") == "metadata", F.struct("r.record_id", "r.target_uri"))).alias("metadata"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    # Archives are parsed once: what follows uses the records more than once.
    records = cut(read_archive(spark, path, payloads=False), "records")
    captures = cut(assemble(records).filter("response is not null").select("capture_id", "response.*", F.col("request").isNotNull().alias("has_request"), F.size("metadata").alias("n_metadata")), "captures")
    originals = captures.filter("kind = 'response'").select(F.col("capture_id").alias("refers_to"), F.col("page_id").alias("original"))
    again = captures.filter("kind = 'revisit'").join(originals, "refers_to", "left")
    shared = ("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"))
    both = captures.filter("kind = 'response'").select(*shared, F.lit(None).cast("long").alias("refers_to"), "has_request", "n_metadata").unionByName(again.select(*shared, F.col("original").alias("refers_to"), "has_request", "n_metadata"))
    return both


ORACLE = """
with p as (select page_id, encode(coalesce(html, '')) b from pages),
q as (select page_id, octet_length(b) payload_bytes, sha256(b) payload_digest from p),
r as (select *, min(page_id) over (partition by payload_digest) f from q)
select page_id, payload_bytes, payload_digest, case when payload_bytes >= 100 and f <> page_id then 'revisit' else 'response' end record_type,
       case when payload_bytes >= 100 and f <> page_id then f end refers_to, true has_request, 1 n_metadata from r
"""
