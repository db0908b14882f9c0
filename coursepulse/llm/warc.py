"""WARC archives: writing with segmentation and revisit records, and reading back.

Written is WARC/1.1: a ``response`` record with an HTTP block in chunked transfer framing, or a
``revisit`` record where an equal payload of at least ``min_revisit`` bytes belongs to a page with a
larger id. Blocks longer than ``segment_bytes`` are cut into segments: the first is the record
itself, the others are ``continuation`` records that name its id and their number; the last one
states the total length.

Read back, segments are grouped by the identifier of their origin, ordered by number, checked for
gaps and against the total length, and joined; then the chunked framing is decoded and the payload
checked against its digest. A group is one page, so its size is the page's.

Files are written with Spark's text writer, whose line separator is the empty lines that end a
record, compressed with gzip, and read whole as binary files. Long pages are segments, each a record, so a file
of at most ``records_per_file`` records has at most about ``records_per_file * segment_bytes`` bytes (32 MB) before
compression. Both work on any file system that Spark can write to.

Defined results: a null html is an empty payload; null urls and ids are written empty and read as
null; control characters in urls are percent-encoded; a record's id is its page id and the number of its row, so rows
that repeat an id are records of their own, with equal or other payloads; those that repeat the id that a group's
response has are responses too; other columns are ignored; an empty table gives empty archives.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 1_000
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 2_000
DATE = "2024-01-01T00:00:00Z"
_END = "\r\n\r\n"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- writing ---------------------------------------------------------------------------------------

def _urn(page_id, row: int = 0) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{row}>"


def _base32(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for i in range(0, len(payload), size):
        piece = payload[i:i + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def _record(kind: str, urn: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn}", f"WARC-Date: {DATE}",
             *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _uri(url) -> str:
    return "".join(c if " " < c < "\x7f" or c > "\x9f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")


def page_records(page_id, row: int, url, payload: bytes, digest: str, refers_to, refers_row, segment_bytes: int = SEGMENT_BYTES):
    """The records of one page, without the empty lines that end each."""
    urn, uri = _urn(page_id, row), _uri(url)
    common = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", _base32(digest))]
    if refers_to is not None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        yield _record("revisit", urn, [*common, ("WARC-Profile", _REVISIT_PROFILE), ("WARC-Refers-To", _urn(refers_to, refers_row)),
                                       ("Content-Type", "application/http;msgtype=response")], block)
        return
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
             + chunked(payload))
    common.append(("Content-Type", "application/http;msgtype=response"))
    if len(block) <= segment_bytes:
        yield _record("response", urn, common, block)
        return
    cuts = list(range(0, len(block), segment_bytes))
    yield _record("response", urn, [*common, ("WARC-Segment-Number", "1")], block[:segment_bytes])
    for number, at in enumerate(cuts[1:], start=2):
        fields = [("WARC-Target-URI", uri), ("WARC-Segment-Origin-ID", urn), ("WARC-Segment-Number", str(number))]
        if at == cuts[-1]:
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record("continuation", f"{urn[:-1]}:segment:{number}>", fields, block[at:at + segment_bytes])


def write_archive(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, segment_bytes: int = SEGMENT_BYTES,
                  records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the pages (``page_id, url, html``) as WARC files below ``path``."""
    src = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    src = (src.withColumn("digest", F.sha1("html")).withColumn("size", F.octet_length("html"))
           .withColumn("row", F.monotonically_increasing_id()))
    # of the rows that repeat the largest id, the one with the smallest number is the one referred to
    best = F.max(F.struct("page_id", (-F.col("row")).alias("less")))
    equal = (src.where(F.col("size") >= min_revisit).groupBy("digest", "size").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("digest").alias("d"), F.col("size").alias("z"), F.col("best.page_id").alias("last"),
                                    (-F.col("best.less")).alias("last_row")))
    dealt = src.join(equal, (src["digest"] == equal["d"]) & (src["size"] == equal["z"]), "left").select(
        "page_id", "url", "html", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"), "row", "last_row")

    def run(batches):
        for b in batches:
            out, size = [], 0
            columns = zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4, 5, 6)), b.column(2))
            for page_id, url, digest, refers_to, row, refers_row, html in columns:
                for r in page_records(page_id, row, url, html.as_buffer().to_pybytes(), digest, refers_to, refers_row, segment_bytes):
                    out.append(r)
                    size += len(r)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    records = dealt.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("lineSep", _END).option("maxRecordsPerFile", records_per_file).option(
        "compression", "gzip").text(path)


# --- reading ---------------------------------------------------------------------------------------

class WarcError(ValueError):
    """A file or record that does not follow the format."""


def parse_records(data: bytes):
    """``(fields, block)`` of each record of a file; field names in lower case."""
    at, n = 0, len(data)
    while at < n:
        if data[at:at + 2] == b"\r\n":  # empty lines between records
            at += 2
            continue
        head = data.find(b"\r\n\r\n", at)
        if head < 0 or not data.startswith(b"WARC/", at):
            raise WarcError(f"no record at byte {at}")
        fields = {}
        for line in data[at:head].decode("utf-8", "replace").split("\r\n")[1:]:
            k, _, v = line.partition(":")
            fields[k.strip().lower()] = v.strip()
        size = int(fields["content-length"])
        block = data[head + 4:head + 4 + size]
        if len(block) != size:
            raise WarcError(f"record at byte {at} is cut short")
        yield fields, block
        at = head + 4 + size


def decode_http(block: bytes) -> tuple[bytes, int | None]:
    """``(payload, stated length)`` of an HTTP block, with chunked framing decoded."""
    head = block.find(b"\r\n\r\n")
    if head < 0:
        raise WarcError("no HTTP head")
    fields = {}
    for line in block[:head].split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.strip().lower()] = v.strip()
    body, stated = block[head + 4:], fields.get(b"content-length")
    if fields.get(b"transfer-encoding", b"").lower() != b"chunked":
        return body, int(stated) if stated else None
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise WarcError("chunk without a size")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts), None
        parts.append(body[at:at + size])
        if len(parts[-1]) != size or body[at + size:at + size + 2] != b"\r\n":
            raise WarcError("chunk is cut short")
        at += size + 2


def _page_of(urn: str | None) -> str | None:
    inner = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return inner.rpartition(":")[0] or None


def _hex(digest: str | None) -> str | None:
    return base64.b32decode(digest.removeprefix("sha1:")).hex() if digest else None


_RECORD = "origin string, record_type string, url string, payload_digest string, refers_to string"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives: its fields, segment number, total length and block."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches):
        for b in batches:
            for content in b.column(0):
                rows: list[tuple] = []
                size = 0
                data = content.as_buffer().to_pybytes()
                for f, block in parse_records(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    number, total = f.get("warc-segment-number"), f.get("warc-segment-total-length")
                    rows.append((f.get("warc-segment-origin-id") or f.get("warc-record-id"), f.get("warc-type"),
                                 f.get("warc-target-uri") or None, _hex(f.get("warc-payload-digest")), f.get("warc-refers-to"),
                                 int(number) if number else None, int(total) if total else None, block))
                    size += len(block)
                    if size > 8 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                yield _batch(rows)

    return files.mapInArrow(run, f"{_RECORD}, segment long, total long, block binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int64()] * 2 + [pa.binary()]
    names = ["origin", "record_type", "url", "payload_digest", "refers_to", "segment", "total", "block"]
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def reassemble(records: DataFrame) -> DataFrame:
    """One row per page: single records, and segments joined; ``problem`` says what is wrong, if anything."""
    single = records.where("segment is null").select(*_names(), "block", F.lit(None).cast("string").alias("problem"))
    parts = (records.where("segment is not null").groupBy("origin")
             .agg(F.sort_array(F.collect_list(F.struct("segment", "record_type", "url", "payload_digest", "refers_to", "total")))
                  .alias("s"), F.expr("listagg(block, X'') WITHIN GROUP (ORDER BY segment)").alias("block")))
    numbered = F.expr("s.segment = sequence(1L, cast(size(s) as long))")
    whole = parts.select("origin", F.expr("s[0]").alias("f"), "block", numbered.alias("numbered"),
                         F.expr("element_at(s, -1).total").alias("total"))
    problem = (F.when(~F.col("numbered"), "segments are missing or repeated").when(F.col("total").isNull(), "no last segment")
               .when(F.col("total") != F.octet_length("block"), "total length differs"))
    return single.unionByName(whole.select("origin", "f.record_type", "f.url", "f.payload_digest", "f.refers_to", "block",
                                           problem.alias("problem")))


def _names() -> list[str]:
    return [x.split(" ")[0] for x in _RECORD.split(", ")]


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload, problem`` of the archives.

    ``page_id`` and ``refers_to`` are strings as in the record ids. The payload of a revisit is null;
    its length and digest are those of the full payload, as its record states them.
    """

    def run(batches):
        for b in batches:
            cols = [c.to_pylist() for c in (b.column(0), b.column(4), b.column(3), b.column(6), b.column(1))]
            out: list[tuple] = []
            for urn, refers_to, digest, problem, kind, block in zip(*cols, b.column(5)):
                payload, size = None, None
                if problem is None:
                    try:
                        body, stated = decode_http(block.as_buffer().to_pybytes())
                        if kind == "revisit":
                            size = stated
                        else:
                            payload, size = body, len(body)
                            if hashlib.sha1(body).hexdigest() != digest:
                                problem = "digest differs"
                    except ValueError as e:
                        problem = str(e)
                out.append((_page_of(urn), _page_of(refers_to), size, payload, problem))
            page, refers, size, payload, problem = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(page, pa.string()), b.column(2), b.column(1), pa.array(refers, pa.string()), b.column(3),
                 pa.array(size, pa.int64()), pa.array(payload, pa.binary()), pa.array(problem, pa.string())],
                names=["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload", "problem"])

    return reassemble(read_records(spark, path)).mapInArrow(
        run, "page_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, "
             "payload binary, problem string")
