"""WARC archives: a distributed writer, and a reader that salvages what it can.

The writer makes one record per page as text whose separator is the record's end, so every
part file that Spark commits is a whole archive; a lost task leaves none behind. Payloads
of `MIN_REVISIT` bytes or more that occur again are written once, as the response of
the largest page id; the others are revisits that refer to it.

The reader takes whole files (`binaryFile`), plain or in gzip members of any number of records. Every
record is checked: version line, headers of any length, length, the end mark, and the payload's
digest (hexadecimal or base32). When a check fails it looks for the next place that starts a valid member or a valid
version line, goes on there, and reports the bytes in between as a gap with the reason. Truncated
last records are gaps too. Within a member the same holds for its unpacked bytes, up to where a damaged
or truncated member can be unpacked; such records and gaps have the place of their member in the file, and the
reason of a gap tells where in the member it lies. No payload is kept beyond its own record or member.

Null html is an empty payload; null urls are empty. Rows with equal payload and equal
largest id are all responses.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.common import stored
from labelloom.plans.joins import lookup_join
from labelloom.plans.shared import fresh_path, settle

VERSION = "WARC/1.1"
END = "\r\n\r\n"
MIN_REVISIT = 1000
FILE_BYTES = 16 * 1024 * 1024
VERSION_LINE = 64
CHUNK = 64 * 1024
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:page:"


# --- writing ---


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, n_bytes, refers_to); refers_to is null for responses."""
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{key}`").cast("bigint").alias("page_id"),
        F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("bigint").alias("n_bytes"),
    )
    groups = rows.filter(F.col("n_bytes") >= MIN_REVISIT).groupBy("digest").agg(
        F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")
    )
    shared = settle(groups.filter("n > 1").select("digest", "keeper"), "warc-groups")
    marked = lookup_join(rows, shared, ["digest"], ["page_id"])
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return marked.withColumn("refers_to", refers).drop("keeper")


def record_text(row_date: str = "2024-01-01T00:00:00Z") -> Column:
    """The record of a planned row, without its end mark."""
    crlf = "\r\n"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{crlf}Content-Type: text/html; charset=utf-8{crlf}Content-Length: "),
        F.col("n_bytes").cast("string"),
        F.lit(END),
    )
    is_revisit = F.col("refers_to").isNotNull()
    block = F.concat(http, F.when(is_revisit, F.lit("")).otherwise(F.col("payload")))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    # Control signs and blanks would break the header line.
    uri = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    head = F.concat(
        F.lit(f"{VERSION}{crlf}WARC-Type: "),
        F.when(is_revisit, "revisit").otherwise("response"),
        F.lit(f"{crlf}WARC-Record-ID: <{RECORD_URN}"), name,
        F.lit(f">{crlf}WARC-Date: {row_date}{crlf}WARC-Target-URI: "), uri,
        F.lit(f"{crlf}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(is_revisit, F.concat(
            F.lit(f"{crlf}WARC-Profile: {PROFILE}{crlf}WARC-Refers-To: <{RECORD_URN}"), F.col("refers_to").cast("string"), F.lit(">")
        )).otherwise(F.lit("")),
        F.lit(f"{crlf}Content-Type: application/http; msgtype=response{crlf}Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
    )
    return F.concat(head, block)


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write archives of about FILE_BYTES below `path`."""
    payload = F.coalesce(F.octet_length(F.col(f"`{html}`")), F.lit(0))
    mean = pages.agg(F.avg(payload).alias("mean")).first()["mean"] or 0.0
    per_file = max(1, int(FILE_BYTES / (mean + 500)))
    records = plan_records(pages, key, url, html).select(record_text().alias("value"))
    records.write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


# --- reading ---


@dataclass(frozen=True)
class Record:
    offset: int
    length: int
    kind: str
    record_id: str
    refers_to: str | None
    target: str
    payload: bytes
    digest: str


@dataclass(frozen=True)
class Gap:
    offset: int
    length: int
    reason: str


class Broken(Exception):
    """A check on a record failed."""


def stated_digest(value: str) -> tuple[str, str]:
    """Algorithm and hexadecimal digest of a header; no algorithm when the digest is of no known form."""
    name, colon, said = value.partition(":")
    algorithm, said = (name.strip().lower().replace("-", ""), said.strip()) if colon else ("sha1", value.strip())
    if algorithm not in ("md5", "sha1", "sha256", "sha512"):
        return "", said.lower()
    size = hashlib.new(algorithm).digest_size
    try:
        if len(said) == 2 * size:
            return algorithm, bytes.fromhex(said).hex()
        bare = said.rstrip("=").upper()
        if len(bare) == -(-8 * size // 5):
            return algorithm, base64.b32decode(bare + "=" * (-len(bare) % 8)).hex()
    except ValueError:
        pass
    return "", said.lower()


def parse_record(data: bytes, at: int) -> tuple[Record, int]:
    """The record at `at` and the place after its end mark; raises Broken when any check fails."""
    if not data.startswith(b"WARC/1.", at) or data.find(b"\r\n", at, at + VERSION_LINE) < 0:
        raise Broken("no version line")
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        raise Broken("no end of headers")
    lines = data[at:head_end].decode("utf-8", "replace").split("\r\n")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Broken("malformed header")
        headers[name.strip().lower()] = value.strip()
    if not (headers.get("warc-type") and headers.get("warc-record-id")):
        raise Broken("no type or id")
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise Broken("no length")
    start = head_end + 4
    end = start + int(size)
    if end + 4 > len(data):
        raise Broken("truncated")
    if data[end : end + 4] != b"\r\n\r\n":
        raise Broken("no end mark")
    block = data[start:end]
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        http_end = block.find(b"\r\n\r\n")
        if http_end < 0:
            raise Broken("no end of http headers")
        payload = block[http_end + 4 :]
    kind = headers.get("warc-type", "")
    algorithm, said = stated_digest(headers.get("warc-payload-digest", ""))
    digest = hashlib.sha1(payload).hexdigest()
    if kind != "revisit" and algorithm and said != (digest if algorithm == "sha1" else hashlib.new(algorithm, payload).hexdigest()):
        raise Broken("digest differs")
    record = Record(
        at, end + 4 - at, kind, headers.get("warc-record-id", "").strip("<>"),
        headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None,
        headers.get("warc-target-uri", ""), payload, said if kind == "revisit" else digest,
    )
    return record, end + 4


def unpack_member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """The unpacked bytes of the gzip member at `at`, the place after them, and what is wrong with the member, if anything."""
    unpack, parts, pos = zlib.decompressobj(31), [], at
    while not unpack.eof:
        if pos >= len(data):
            return b"".join(parts), len(data), "truncated member"
        before = unpack.copy()
        try:
            parts.append(unpack.decompress(data[pos : pos + CHUNK]))
            pos += CHUNK
        except zlib.error:
            # What the chunk holds before the fault counts.
            try:
                while True:
                    parts.append(before.decompress(data[pos : pos + 1]))
                    pos += 1
            except zlib.error:
                return b"".join(parts), pos, "bad member"
    return b"".join(parts), min(pos, len(data)) - len(unpack.unused_data), ""


def read_member(data: bytes, at: int) -> tuple[list[Record | Gap], int, str]:
    """Records and gaps of the gzip member at `at` in order, the place after it, and what is wrong with it."""
    inner, end, fault = unpack_member(data, at)
    found: list[Record | Gap] = []
    for x in salvage(inner, members=False):
        if isinstance(x, Gap):
            x = replace(x, reason=f"{x.reason} (bytes {x.offset} to {x.offset + x.length} of member)")
        found.append(replace(x, offset=at, length=end - at))
    if fault == "truncated member" and len(found) == 1:
        # A member per record that is cut counts as a truncated record, even when only its checksum is cut.
        found = []
    return found, end, fault


def salvage(data: bytes, members: bool = True) -> Iterator[Record | Gap]:
    """Every valid record in order, and a gap for every stretch that holds none or is a damaged member."""
    at, lost, reason = 0, None, ""
    # Of the damaged member in the lost stretch: records and gaps, and where unpacking stopped.
    held: list[Record | Gap] = []
    stopped = 0

    def lost_until(end: int) -> Iterator[Record | Gap]:
        yield from (replace(x, length=end - lost) for x in held)
        yield Gap(lost, end - lost, reason)

    while at < len(data):
        try:
            if members and data.startswith(b"\x1f\x8b", at):
                found, end, fault = read_member(data, at)
                if fault:
                    if any(isinstance(x, Record) for x in found):
                        if lost is not None:
                            yield from lost_until(at)
                        lost, reason, held, stopped = at, fault, found, end
                    raise Broken(fault)
            else:
                record, end = parse_record(data, at)
                found = [record]
                if at < stopped and any(isinstance(x, Record) and replace(x, offset=at, length=record.length) == record for x in held):
                    # A member that stores its bytes as they are shows them twice.
                    at = end
                    continue
        except Broken as broken:
            if lost is None:
                lost, reason = at, str(broken)
            at = _next_start(data, at + 1)
            continue
        if lost is not None:
            yield from lost_until(at)
            lost, held, stopped = None, [], 0
        yield from found
        at = end
    if lost is not None:
        yield from lost_until(len(data))


def _next_start(data: bytes, at: int) -> int:
    """The next place that looks like a version line or a gzip member."""
    found = [p for p in (data.find(b"WARC/1.", at), data.find(b"\x1f\x8b\x08", at)) if p >= 0]
    return min(found, default=len(data))


READ_SCHEMA = (
    "file string, offset bigint, length bigint, kind string, record_id string, refers_to string, target string, "
    "payload_bytes bigint, payload_digest string, reason string"
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record, and a row of kind "gap" (with `reason`) per quarantined stretch.

    For revisits `payload_digest` is what the record states and `payload_bytes` is 0.
    """
    schema = READ_SCHEMA + ", payload binary" * with_payload
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    kinds = [types[c.split()[1]] for c in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, rows, held = batch.column(0)[i].as_py(), [], 0
                for x in salvage(batch.column(1)[i].as_py()):
                    if isinstance(x, Gap):
                        row = (file, x.offset, x.length, "gap", None, None, None, None, None, x.reason)
                    else:
                        row = (file, x.offset, x.length, x.kind, x.record_id, x.refers_to, x.target, len(x.payload), x.digest, None)
                    if with_payload:
                        row += (None if isinstance(x, Gap) else x.payload,)
                        held += len(row[-1] or b"")
                    rows.append(row)
                    if len(rows) >= 5000 or held > FILE_BYTES:
                        yield _table(rows, names, kinds)
                        rows, held = [], 0
                if rows:
                    yield _table(rows, names, kinds)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(work, schema)


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records with each revisit's payload size taken from the response that it refers to."""
    kept = stored(records.filter("kind <> 'gap'"), "warc-records")
    wanted = kept.filter("kind = 'revisit'").select(F.col("refers_to").alias("record_id")).distinct()
    targets = kept.filter("kind = 'response'").join(wanted, "record_id", "left_semi").groupBy("record_id").agg(
        F.max("payload_bytes").alias("_bytes")
    )
    known = settle(targets.withColumnRenamed("record_id", "refers_to"), "warc-targets")
    joined = lookup_join(kept, known, ["refers_to"], ["record_id", "file"])
    size = F.when(F.col("kind") == "revisit", F.col("_bytes")).otherwise(F.col("payload_bytes"))
    return joined.withColumn("payload_bytes", size).drop("_bytes")


def page_of(record_id: Column | str) -> Column:
    col = F.col(record_id) if isinstance(record_id, str) else record_id
    number = F.regexp_extract(col, f"^{RECORD_URN}(-?[0-9]+)$", 1)
    return F.when(number != "", number.cast("bigint"))


def write_and_read(pages: DataFrame, **columns: str) -> DataFrame:
    """Write archives to the shared folder and return their resolved records."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, **columns)
    return resolve_revisits(read_archives(pages.sparkSession, path))
