"""WARC archives: a writer that stores each payload once, and a reader that salvages damaged files.

Writing: digests of the payloads are tested with the two-pass filter of op6, so only pages whose
payload may occur twice shuffle; of equal payloads of LEAST_PAYLOAD bytes or more the largest
page_id is the response and the others are revisits that refer to it. Spark's text writer makes
the files, with the two line ends that close a record as its separator, so they lie in any store
that Spark writes to and a lost executor's files are written again.

An archive is closed by the running sum of its bytes, so many large pages together make many
archives; only a single page may exceed the target.

Reading: a record counts if its header parses, its block has the stated length, the two line ends
follow and both digests agree. Where a check fails the reader looks for the next gzip member or
version line that starts a valid record, goes on there, and logs the bytes between as a gap:
`quarantined` writes all gaps to a table beside the archives and warns of them in the log. A revisit
whose response was lost in a gap has a null size.

Defined cases: a null page is an empty payload; pages that repeat id and payload of the response
are responses too; a null page_id never outranks another, and among null ids only all are
responses; a null url has no target line, and control characters in a url are percent-encoded; an
empty table gives no records; further columns are not carried.
"""

from __future__ import annotations

import gzip
import hashlib
import logging
import re
import zlib
from base64 import b32decode, b32encode
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .common import attach_groups, materialise, text_or_empty
from .op6_exact_dedup import possibly_repeated, repeat_filter

LEAST_PAYLOAD = 1000
#: Payload bytes after which the next record begins another archive; the reader holds one archive at a time.
ARCHIVE_BYTES = 16 << 20
DATE = "2020-01-01T00:00:00Z"
END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_START = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")
_VERSION = re.compile(rb"WARC/\d\.\d\r\n")
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


class Record(NamedTuple):
    offset: int
    length: int
    headers: dict[str, str]
    payload: bytes


class Gap(NamedTuple):
    offset: int
    length: int
    reason: str


def _sha1(data: bytes) -> str:
    return "sha1:" + b32encode(hashlib.sha1(data).digest()).decode()


def record_text(page_id: int | None, url: str | None, html: str, digest: bytes, refers_to: int | None) -> str:
    """A response, or a revisit if refers_to is given, without the line ends that close it."""
    size = len(html.encode("utf-8", "surrogatepass"))
    block = _HTTP.format(size) + ("" if refers_to is not None else html)
    raw = block.encode("utf-8", "surrogatepass")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{b32encode(digest).decode()}", f"WARC-Block-Digest: {_sha1(raw)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(raw)}"]
    return "\r\n".join(lines) + END + block


def member(record: str) -> bytes:
    """A closed record as a gzip member of its own."""
    return gzip.compress((record + END).encode("utf-8", "surrogatepass"), mtime=0)


def _parse(data: bytes, at: int) -> tuple[Record, int] | str:
    """The record that starts at `at` and where the next one would, or what is wrong with it."""
    head = data.find(b"\r\n\r\n", at)
    if head < 0 or not _VERSION.match(data, at):
        return "no header"
    try:
        pairs = [x.split(":", 1) for x in data[at:head].decode().split("\r\n")[1:]]
        headers = {k.strip().lower(): v.strip() for k, v in pairs}
        size = int(headers["content-length"])
        kind = headers["warc-type"]
        headers["warc-record-id"]
    except (ValueError, KeyError):
        return "bad header"
    begin, end = head + 4, head + 4 + size
    block = data[begin:end]
    if size < 0 or len(block) < size:
        return "block cut short"
    if data[end : end + 4] != b"\r\n\r\n":
        return "record not closed"
    if headers.get("warc-block-digest", _sha1(block)) != _sha1(block):
        return "block digest differs"
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        payload = block[block.find(b"\r\n\r\n") + 4 :] if b"\r\n\r\n" in block else b""
    if kind == "response" and headers.get("warc-payload-digest", _sha1(payload)) != _sha1(payload):
        return "payload digest differs"
    return Record(at, end + 4 - at, headers, payload), end + 4


def _member(data: bytes, at: int) -> tuple[bytes, int] | str:
    unzip, out, view = zlib.decompressobj(31), [], memoryview(data)
    while at < len(data) and not unzip.eof:
        upto = min(len(data), at + 65536)
        try:
            out.append(unzip.decompress(view[at:upto]))
        except zlib.error:
            return "bad gzip member"
        at = upto
    return (b"".join(out), at - len(unzip.unused_data)) if unzip.eof else "gzip member cut short"


def _inside(out: bytes) -> list[Record] | str:
    records, at = [], 0
    while at < len(out):
        found = _parse(out, at)
        if isinstance(found, str):
            return found
        records.append(found[0])
        at = found[1]
    return records or "empty member"


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """All records that pass their checks, plain or in gzip members, and the gaps between them."""
    at, bad, reason = 0, None, ""
    while at < len(data):
        why = "no record"
        if data[at : at + 3] == b"\x1f\x8b\x08":
            whole = _member(data, at)
            found = _inside(whole[0]) if not isinstance(whole, str) else whole
            if not isinstance(found, str):
                if bad is not None:
                    yield Gap(bad, at - bad, reason)
                    bad = None
                for r in found:
                    yield r._replace(offset=at, length=whole[1] - at)
                at = whole[1]
                continue
            why = found
        elif data.startswith(b"WARC/", at):
            one = _parse(data, at)
            if not isinstance(one, str):
                if bad is not None:
                    yield Gap(bad, at - bad, reason)
                    bad = None
                yield one[0]
                at = one[1]
                continue
            why = one
        if bad is None:
            bad, reason = at, why
        later = _START.search(data, at + 1)
        at = later.start() if later else len(data)
    if bad is not None:
        yield Gap(bad, len(data) - bad, reason)


def _written(archive_bytes: int):
    """Rows (value): whole archives, without the line ends that close the last record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        size = 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.string())], names=["value"])

        for batch in batches:
            for i in range(batch.num_rows):
                value = record_text(*(batch.column(c)[i].as_py() for c in range(5)))
                more = len(value.encode("utf-8", "surrogatepass")) + len(END)
                if held and size + more > archive_bytes:
                    yield archive()
                    held, size = [], 0
                held.append(value)
                size += more
        if held:
            yield archive()

    return run


def assigned(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_PAYLOAD) -> DataFrame:
    """page_id, url, html, sha, refers_to of each page."""
    body = text_or_empty(html)
    whole = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("html"), F.unhex(F.sha1(body.cast("binary"))).alias("sha"))
    narrow = materialise(whole.select("page_id", "sha", F.octet_length("html").alias("size")), "payloads")
    stats = narrow.agg(F.count("*").alias("n"), F.count_if(F.col("size") >= least).alias("large")).first()
    large = narrow.where(F.col("size") >= least)
    words, cells = repeat_filter(large, "sha", stats["large"])
    groups = possibly_repeated(large, "sha", words, cells).where("__maybe").groupBy("sha").agg(F.count("*").alias("copies"), F.max("page_id").alias("response")).where("copies > 1")
    groups = materialise(groups, "payload-groups")
    tested = possibly_repeated(whole, "sha", words, cells).withColumn("__maybe", F.col("__maybe") & (F.octet_length("html") >= least))
    joined = attach_groups(tested.where("__maybe"), groups, "sha", "copies", max(stats["n"], 1))
    first = F.col("response").isNull() | F.col("page_id").eqNullSafe(F.col("response"))
    columns = ["page_id", "url", "html", "sha"]
    several = joined.select(*columns, F.when(~first, F.col("response")).alias("refers_to"))
    alone = tested.where("not __maybe").select(*columns, F.lit(None).cast("long").alias("refers_to"))
    return alone.unionByName(several)


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, **columns: str) -> None:
    """Writes one record a page; each file is an archive of archive_bytes at most, or one record."""
    archives = assigned(pages, **columns).mapInArrow(_written(archive_bytes), "value string")
    archives.write.option("lineSep", END).option("maxRecordsPerFile", 1).text(path)


_READ = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("reason", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
_READ_SPARK = "archive string, offset long, length long, reason string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _page(value: str | None) -> int | None:
    digits = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(digits[1]) if digits else None


def _read_row(archive: str, x: Record | Gap, payloads: bool) -> tuple:
    if isinstance(x, Gap):
        return archive, x.offset, x.length, x.reason, *[None] * 7
    h = x.headers
    digest = h.get("warc-payload-digest", "")
    digest = b32decode(digest[5:]).hex() if digest.startswith("sha1:") else hashlib.sha1(x.payload).hexdigest()
    response = h["warc-type"] != "revisit"
    return archive, x.offset, x.length, None, _page(h["warc-record-id"]), h.get("warc-target-uri"), h["warc-type"], len(x.payload) if response else None, digest, _page(h.get("warc-refers-to")), x.payload if payloads and response else None


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Records (reason null) and quarantined gaps (reason set) of all archives under a path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterable[tuple]:
            for batch in batches:
                for archive, content in zip(batch.column(0), batch.column(1)):
                    for x in salvage(content.as_py()):
                        yield _read_row(archive.as_py(), x, payloads)

        held: list[tuple] = []
        for row in rows():
            held.append(row)
            if len(held) == 512:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _READ)], schema=_READ)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _READ)], schema=_READ)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, _READ_SPARK)


_LOG = logging.getLogger(__name__)


def quarantined(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records and the gaps (archive, offset, length, reason) of one reading, written as a table each; gaps are logged too."""
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    read = materialise(records.select("archive", "offset", "length", "reason", *columns), "records")
    gaps = read.where("reason is not null").select("archive", "offset", "length", "reason")
    lost = gaps.groupBy("reason").agg(F.count("*").alias("gaps"), F.sum("length").alias("bytes")).collect()  # a row a reason
    for r in lost:
        _LOG.warning("quarantined %d gaps of %d bytes: %s", r["gaps"], r["bytes"], r["reason"])
    return read.where("reason is null").select(columns), materialise(gaps, "gaps") if lost else gaps


def resolved(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; a revisit has the size of the response that it refers to.

    Page ids may repeat with different payloads, so page and digest together name the response.
    """
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found, _ = quarantined(records)
    total = max(found.count(), 1)
    revisits = found.where("record_type = 'revisit'").drop("payload_bytes")
    named = lambda page: F.concat_ws(":", "payload_digest", F.col(page).cast("string"))
    wanted = revisits.groupBy(named("refers_to").alias("to")).agg(F.count("*").alias("copies"))
    sizes = found.where("record_type = 'response'").select(named("page_id").alias("to"), "payload_bytes").join(wanted, "to").groupBy("to", "copies").agg(F.first("payload_bytes").alias("payload_bytes"))
    sizes = materialise(sizes, "referred")
    filled = attach_groups(revisits.withColumn("to", named("refers_to")), sizes, "to", "copies", total)
    return found.where("record_type = 'response'").select(columns).unionByName(filled.select(columns))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return resolved(read_archives(spark, path))


ORACLE = """
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, octet_length(encode(body)) as n, sha1(body) as h from p),
g as (select page_id, n, h, case when n >= 1000 then max(page_id) over (partition by h) else page_id end as first from d)
select page_id, n as payload_bytes, h as payload_digest, case when first = page_id then 'response' else 'revisit' end as record_type,
       case when first <> page_id then first end as refers_to
from g
"""
