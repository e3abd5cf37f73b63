"""WARC writing and reading with segment reassembly (operator 5).

Pages become WARC/1.1 records: a ``response`` whose block is an HTTP message
in chunked transfer framing, or a ``revisit`` that names the page holding the
same payload.  A block longer than a segment is cut: the first record has
segment number 1, ``continuation`` records follow with the origin's id, and
the last one states the total length.

Archives are files that Spark's committer writes: records are written as lines
whose separator is the CRLF CRLF that ends a WARC record, so a file is a plain WARC
file, compressed as a whole (gzip) or not at all (none).  They are read with Spark's binary reader, parsed in
the task, and the segments are grouped by origin id; records of one segment
are decoded where they are read and shuffle only their digest.
"""

from __future__ import annotations

import gzip
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import freeze, scratch_path

#: Payloads from this size on are stored once.
REVISIT_FROM = 100
#: Bytes of a record's block from which it is cut into segments, and of a transfer chunk.
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
#: Bytes of payload that a task should write, tasks at most, and records of an archive file at most.
ARCHIVE_BYTES = 32 << 20
MAX_TASKS = 20_000
FILE_RECORDS = 20_000
END = "\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    out = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The content of a chunked body; chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if at + size + 2 > len(body) or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a transfer chunk is cut short")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head) else body


#: A payload of one page that more than 1 / HOT of all rows repeat is dealt to SALTS tasks.
HOT, SALTS = 500, 32


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def page_records(key: str, page_id, url, payload: bytes, digest: str, refers_to, date: str, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """The records of one page, without the separators after them.  A revisit has the payload of the page it refers to, so that record's name follows."""
    uri = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    own = [("WARC-Date", date), ("X-Page-Id", page_id), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    name = f"<urn:page:{key}>"
    if refers_to is not None:
        more = [("WARC-Type", "revisit"), ("WARC-Record-ID", name), ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}:{digest}>"), ("X-Refers-To-Page", refers_to)]
        return [_record(more + own, HTTP + b"\r\n")]
    block = HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    cut = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", name), ("WARC-Segment-Number", 1 if len(cut) > 1 else None)]
    out = [_record(first + own, cut[0])]
    for n, part in enumerate(cut[1:], 2):
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{key}:segment:{n}>"), ("WARC-Date", date), ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", n)]
        out.append(_record([*fields, ("WARC-Segment-Total-Length", len(block) if n == len(cut) else None)], part))
    return out


def parse_records(data: bytes):
    """``(headers, block)`` of each record of an archive file; header names in lower case."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(head["content-length"])
        at = end + 4
        block = data[at : at + size]
        at += size
        if len(block) != size or data[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record is cut short")
        at += 4
        yield head, block


def write(pages: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z", segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES, compression: str = "gzip") -> None:
    """Writes a record for every row of ``pages`` (``page_id``, ``url``, ``html``).

    Of rows with equal payloads of REVISIT_FROM bytes or more, those with the
    smallest page_id are responses; rows without a page_id are always
    responses and never referred to.  A null html is an empty payload, rows
    that repeat have a record each, an empty table gives no files, and other
    columns are not read.

    Records are named by page_id and payload digest, which a revisit knows of
    its response; rows that repeat both are numbered from the second on.  A
    pair that more than 1 / HOT of all rows share, however that comes, is
    dealt to SALTS tasks; its first row has salt 0, which of that many rows
    some have."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("html"), F.sha2(payload, 256).alias("digest"))
    rows = rows.withColumn("key", F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("none")), "digest"))
    total, n = rows.agg(F.sum(F.octet_length("html")), F.count("*")).first()
    tasks = min(MAX_TASKS, max(1, -(-(total or 0) // ARCHIVE_BYTES)))
    hot = rows.groupBy("key").agg(F.count("*").alias("n")).where((F.col("n") * HOT > n) & (F.col("n") > SALTS * SALTS)).select("key", F.lit(SALTS).alias("salts"))
    hot = F.broadcast(hot)  # fewer than HOT rows
    shared = rows.where((F.octet_length("html") >= REVISIT_FROM) & F.col("page_id").isNotNull()).select("key", "page_id", "digest")
    first = shared.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("last > refers_to")
    revisits = shared.distinct().join(first.drop("last"), "digest").where("page_id > refers_to").select("key", "refers_to").join(hot, "key", "left")
    revisits = revisits.select("key", "refers_to", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    salt = F.pmod(F.monotonically_increasing_id(), F.coalesce("salts", F.lit(1))).cast("int")
    # the texts are shuffled once, for the join and for the count of rows that repeat a key
    rows = rows.join(hot, "key", "left").withColumn("salt", salt).repartition(tasks, "key", "salt").join(revisits, ["key", "salt"], "left")
    nth = F.row_number().over(Window.partitionBy("key", "salt").orderBy("digest"))
    number = F.when((F.col("salt") > 0) | (nth > 1), F.concat_ws(":", F.col("salt").cast("string"), nth.cast("string")))
    rows = rows.withColumn("key", F.concat_ws(":", "key", number))

    def records(batches):
        for b in batches:
            out = [
                pa.array(page_records(k, i, u, h.encode(), d, r, date, segment_bytes, chunk_bytes), pa.binary())
                for k, i, u, h, d, r in zip(*(b.column(c).to_pylist() for c in ("key", "page_id", "url", "html", "digest", "refers_to")))
            ]
            if out:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(out)], names=["record"])

    lines = rows.select("key", "page_id", "url", "html", "digest", "refers_to").mapInArrow(records, "record binary")
    lines.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS).text(folder, compression=compression)


PARSED = pa.schema(
    [("origin", pa.string()), ("kind", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("page_id", pa.int64()), ("refers_to", pa.int64()),
     ("stated", pa.string()), ("payload_bytes", pa.int64()), ("digest", pa.string()), ("block", pa.binary())]
)
PARSED_DDL = "origin string, kind string, segment int, total long, page_id long, refers_to long, stated string, payload_bytes long, digest string, block binary"


def _number(x):
    return None if x is None else int(x)


def _parse_files(batches):
    for b in batches:
        for content in b.column(0):
            rows = []
            for head, block in parse_records(content.as_py()):
                kind, segment = head["warc-type"], head.get("warc-segment-number")
                row = {
                    "origin": head.get("warc-segment-origin-id", head["warc-record-id"]), "kind": kind, "segment": _number(segment), "total": _number(head.get("warc-segment-total-length")),
                    "page_id": _number(head.get("x-page-id")), "refers_to": _number(head.get("x-refers-to-page")), "stated": head.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                    "payload_bytes": None, "digest": None, "block": None,
                }
                if segment is not None:
                    row["block"] = block
                elif kind == "response":
                    p = http_payload(block)
                    row |= {"payload_bytes": len(p), "digest": hashlib.sha256(p).hexdigest()}
                rows.append(row)
                if len(rows) == 500:
                    yield pa.RecordBatch.from_pylist(rows, schema=PARSED)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=PARSED)


PAGE = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("stated", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _reassemble(keep_payload: bool):
    def run(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                size, digest, payload = r["payload_bytes"], r["digest"], None
                if r["parts"]:
                    parts = sorted(r["parts"], key=lambda x: x["segment"])
                    block = b"".join(x["block"] for x in parts)
                    if [x["segment"] for x in parts] != list(range(1, len(parts) + 1)) or r["total"] != len(block):
                        raise ValueError(f"segments of {r['origin']} are missing or do not add up to the total length")
                    payload = http_payload(block)
                    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                if r["kind"] == "response" and r["stated"] not in (None, digest):
                    raise ValueError(f"the payload of {r['origin']} does not have its digest")
                rows.append({"page_id": r["page_id"], "record_type": r["kind"], "refers_to": r["refers_to"], "stated": r["stated"], "payload_bytes": size, "payload_digest": digest, "payload": payload if keep_payload else None})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=PAGE)

    return run


def read(spark, folder: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every page in the archives.

    Fails on a record that is cut short, on missing segments, on a total
    length or a payload digest that does not hold, and on a revisit whose
    response is not there."""
    files = spark.read.format("binaryFile").load(folder)
    records = files.select("content").mapInArrow(_parse_files, PARSED_DDL)
    head = F.col("kind") != "continuation"
    grouped = records.groupBy("origin").agg(
        *(F.max(F.when(head, F.col(c))).alias(c) for c in ("kind", "page_id", "refers_to", "stated", "payload_bytes", "digest")),
        F.max("total").alias("total"),
        F.collect_list(F.when(F.col("segment").isNotNull(), F.struct("segment", "block"))).alias("parts"),
    )
    ddl = "page_id long, record_type string, refers_to long, stated string, payload_bytes long, payload_digest string, payload binary"
    pages = freeze(grouped.mapInArrow(_reassemble(False), ddl).drop("payload"), "warc_pages")
    responses = pages.where("record_type = 'response'").groupBy(F.col("page_id").alias("r_id"), F.col("payload_digest").alias("r_digest")).agg(F.max("payload_bytes").alias("r_bytes"))
    revisits = pages.where("record_type = 'revisit'").join(responses, (F.col("refers_to") == F.col("r_id")) & (F.col("stated") == F.col("r_digest")), "left")
    size = F.when(F.col("r_bytes").isNull(), F.raise_error(F.concat(F.lit("no response for page "), F.col("page_id").cast("string")))).otherwise(F.col("r_bytes"))
    revisits = revisits.select("page_id", size.cast("long").alias("payload_bytes"), F.col("stated").alias("payload_digest"), "record_type", "refers_to")
    return pages.where("record_type = 'response'").select(revisits.columns).unionByName(revisits)


def round_trip(pages: DataFrame) -> DataFrame:
    folder = scratch_path(pages.sparkSession, "warc")
    write(pages, folder)
    return read(pages.sparkSession, folder)
