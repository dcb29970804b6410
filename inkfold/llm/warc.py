"""WARC archives: writing captures, reading records, and assembling each capture from its records.

A capture is written as three records, each a gzip member: the request, the response (or a revisit that refers to an earlier
response with the same payload) and metadata. Request and metadata name the response in WARC-Concurrent-To.
Archives are kept as a Parquet table (archive, part, data), so that Spark commits whole parts only and any
file system that Spark reaches will do; data joined in order of part is a .warc.gz file. Plain archive files are read too.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.llm.common import cut, fresh_path, hot_keys, salted_join

#: Payloads of fewer bytes are always written in full.
LEAST_REVISIT = 100
#: Bytes after which a task begins a new part.
PART_BYTES = 4 << 20
#: Repeated payloads up to which the first page of each (a digest, an id, a URL) is broadcast, so that payloads need no shuffle.
BROADCAST_GROUPS = 50_000
_FEED = 1 << 16
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PRINTABLE = "".join(chr(c) for c in range(33, 127))

RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
    "header_digest string, payload_bytes long, payload_digest string, fields string, payload binary"
)


def record_id(kind: str, *parts: object) -> str:
    """A record's name, always the same for the same parts."""
    digest = hashlib.sha256(json.dumps([kind, *parts]).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest[:16], version=4)}>"


def write_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def capture_records(page: dict, place: str = "") -> list[bytes]:
    """The records of one capture. page: id, url, payload, digest; first_id and first_url of a revisited capture, or None.

    place tells captures apart that are alike in all else. A revisit names the earlier capture by its payload's digest and its URL.
    """
    url, digest = page["url"] or "", page["digest"]
    uri = quote(url, safe=_PRINTABLE)
    own = record_id("response", page["id"], url, digest, place)
    payload = page["payload"]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = [("WARC-Target-URI", uri)] * bool(uri) + [("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}")]
    http = ("Content-Type", "application/http; msgtype=response")
    if page["first_id"] is None:
        main = write_record([("WARC-Type", "response"), ("WARC-Record-ID", own), *common, http], head + payload)
    else:
        first = [("WARC-Refers-To-Target-URI", quote(page["first_url"], safe=_PRINTABLE))] * bool(page["first_url"])
        main = write_record(
            [("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("WARC-Profile", PROFILE), *first, ("WARC-Refers-To-Date", DATE), http], head
        )
    try:
        cut = urlsplit(uri)
    except ValueError:
        cut = urlsplit("")
    asked = f"GET {cut.path or '/'}{'?' + cut.query if cut.query else ''} HTTP/1.1\r\nHost: {cut.netloc}\r\n\r\n".encode()
    near = [("WARC-Date", DATE), ("WARC-Concurrent-To", own)]
    fields = {"page-id": page["id"], "url": page["url"]}
    notes = "".join(f"{k}: {json.dumps(v)}\r\n" for k, v in fields.items()).encode()
    return [
        write_record([("WARC-Type", "request"), ("WARC-Record-ID", record_id("request", own)), *near, ("Content-Type", "application/http; msgtype=request")], asked),
        main,
        write_record([("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", own)), *near, ("Content-Type", "application/warc-fields")], notes),
    ]


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """Pages with payload (UTF-8), digest and, where it revisits one, the first page (least id) with the same payload."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(html_col, F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    named = rows.where((F.octet_length("payload") >= least) & F.col("id").isNotNull())
    groups = cut(named.groupBy("digest").agg(F.min(F.struct("id", "url")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    firsts = groups.select("digest", "first")
    if groups.count() <= BROADCAST_GROUPS:
        joined = rows.join(F.broadcast(firsts), "digest", "left")
    else:
        joined = salted_join(rows, firsts, "digest", hot_keys(groups, "digest"), "id", how="left")
    again = F.col("first").isNotNull() & (F.col("first.id") != F.col("id"))
    return joined.select(
        "id", "url", "payload", "digest", F.when(again, F.col("first.id")).alias("first_id"), F.when(again, F.col("first.url")).alias("first_url")
    )


def write_archives(pages: DataFrame, path: str, part_bytes: int = PART_BYTES, **columns: str) -> None:
    """Writes the pages' captures to the table of archives at path.

    Null html is an empty payload; a null URL gives records without a target. A row without id is always written in full. Rows that
    are alike are captures of their own, told apart by their places in the archives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"captures-{TaskContext.get().partitionId():06d}.warc.gz"
        held, size, part, written = [], 0, 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                page = {c: batch.column(c)[i].as_py() for c in ("id", "url", "payload", "digest", "first_id", "first_url")}
                written += 1
                for record in capture_records(page, f"{name}:{written}"):
                    held.append(record)
                    size += len(record)
                if size >= part_bytes:
                    yield _part(name, part, held)
                    held, size, part = [], 0, part + 1
        if held:
            yield _part(name, part, held)

    made = with_revisits(pages, **columns).mapInArrow(run, "archive string, part int, data binary")
    made.write.option("compression", "uncompressed").parquet(path)


def _part(name: str, part: int, records: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([name]), pa.array([part], pa.int32()), pa.array([b"".join(records)])], ["archive", "part", "data"])


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of an archive one after the other; an archive that isn't packed is given whole."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    view, at = memoryview(data), 0
    while at < len(view):
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            fed = view[at : at + _FEED]
            if not len(fed):
                raise ValueError("the archive ends within a record")
            out.append(unpack.decompress(fed))
            at += len(fed) - len(unpack.unused_data)
        yield b"".join(out)


def _headers(lines: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines.decode("utf-8", "replace").split("\r\n")[1:]:
        key, sep, value = line.partition(":")
        if sep:
            found.setdefault(key.strip().lower(), value.strip())
    return found


def parse_records(data: bytes, with_payload: bool) -> Iterator[tuple]:
    """The records of an archive as rows of RECORD. The digest and size are those of the payload read, not of its header.

    A revisit has no payload: its size is that of the HTTP header it repeats, its digest that of its own header.
    """
    for text in members(data):
        at = 0
        while at < len(text):
            end = text.find(b"\r\n\r\n", at)
            if end < 0:
                if text[at:].strip():
                    raise ValueError("a record's header does not end")
                break
            head = _headers(text[at:end].lstrip(b"\r\n"))
            size = int(head["content-length"])
            block = text[end + 4 : end + 4 + size]
            if len(block) < size:
                raise ValueError("a record is cut off")
            at = end + 4 + size + 4
            kind, payload, n, digest, fields = head.get("warc-type"), None, None, None, None
            claimed = (head.get("warc-payload-digest") or "").removeprefix("sha256:") or None
            if kind in ("response", "resource"):
                payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else block
                n, digest = len(payload), hashlib.sha256(payload).hexdigest()
                if "sha256:" in (head.get("warc-payload-digest") or "") and claimed != digest:
                    raise ValueError(f"{head.get('warc-record-id')}: the payload does not have its digest")
            elif kind == "revisit":
                http = _headers(block.partition(b"\r\n\r\n")[0])
                n, digest = int(http["content-length"]) if "content-length" in http else None, claimed
            elif kind == "metadata":
                fields = json.dumps({k: v for k, s, v in (x.partition(": ") for x in block.decode("utf-8", "replace").split("\r\n")) if s})
            yield (
                head.get("warc-record-id"), kind, head.get("warc-concurrent-to"), head.get("warc-refers-to"), head.get("warc-target-uri"),
                head.get("warc-date"), claimed, n, digest, fields, payload if with_payload else None,
            )


def read_records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row of RECORD for each record of archives (column data: whole records, packed or not)."""
    schema = RECORD
    types = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in schema.split(", ")]

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                found, size = [], 0
                for record in parse_records(data.as_py() or b"", with_payload):
                    found.append(record)
                    size += len(record[-1] or b"") + 500
                    if size > PART_BYTES:
                        yield rows(found)
                        found, size = [], 0
                if found:
                    yield rows(found)

    return archives.select("data").mapInArrow(run, schema)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of a table written by write_archives()."""
    return read_records(spark.read.parquet(path), with_payload)


def read_files(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of .warc and .warc.gz files (each under 2 GB), wherever Spark can read them."""
    return read_records(spark.read.format("binaryFile").load(path).select(F.col("content").alias("data")), with_payload)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, request, response (or revisit or resource), metadata, n_records.

    A record that is concurrent to another belongs to that one's capture, also through one record in between. Of several
    records of a kind the least by record id is taken, so that records read twice do no harm. Records without an id are left out.
    """
    records = records.where("record_id IS NOT NULL")
    links = records.where("concurrent_to IS NOT NULL").select(F.col("record_id").alias("to_id"), F.col("concurrent_to").alias("beyond"))
    links = links.groupBy("to_id").agg(F.min("beyond").alias("beyond"))
    first = F.coalesce("concurrent_to", "record_id")
    joined = records.withColumn("to_id", first).join(links, "to_id", "left")
    joined = joined.withColumn("capture_id", F.when(F.col("concurrent_to").isNull(), F.col("record_id")).otherwise(F.coalesce("beyond", "to_id")))
    whole = F.struct(*[c for c in records.columns if c != "concurrent_to"])
    main = F.col("type").isin("response", "revisit", "resource")
    return joined.groupBy("capture_id").agg(
        F.min(F.when(F.col("type") == "request", whole)).alias("request"),
        F.min(F.when(main, whole)).alias("response"),
        F.min(F.when(F.col("type") == "metadata", whole)).alias("metadata"),
        F.count(F.lit(1)).alias("n_records"),
    )


def captures(records: DataFrame) -> DataFrame:
    """assemble() with page_id from the metadata, and for a revisit the page_id of the response it refers to: the one of the
    record it names, else the least of those whose payload has its digest. Every row written is one capture.
    """
    page = F.get_json_object("metadata.fields", "$.page-id").try_cast("long")
    path = fresh_path(records.sparkSession, "captures")
    assemble(records).withColumn("page_id", page).write.parquet(path)  # else archives would be read once for each use
    rows = records.sparkSession.read.parquet(path)
    by_digest = F.concat(F.lit("digest:"), F.col("response.header_digest"))
    is_revisit = F.coalesce(F.col("response.type") == "revisit", F.lit(False))
    keyed = rows.withColumn("to_id", F.when(is_revisit, F.coalesce("response.refers_to", by_digest)).otherwise(F.col("capture_id")))
    again = keyed.where(is_revisit).groupBy("to_id").agg(F.count(F.lit(1)).alias("n"))
    heads = rows.where(~is_revisit).select(F.explode(F.array("response.record_id", by_digest)).alias("to_id"), F.col("page_id").alias("refers_to"))
    named = heads.groupBy("to_id").agg(F.min("refers_to").alias("refers_to"))
    wanted = named.join(again, "to_id", "left_semi")
    found = salted_join(keyed, wanted, "to_id", hot_keys(again, "to_id"), "capture_id", how="left")
    return found.withColumn("refers_to", F.when(is_revisit, F.col("refers_to"))).drop("to_id")
