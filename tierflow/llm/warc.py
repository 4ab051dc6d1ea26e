"""WARC archives: writing pages as records and reading them back (operator 10).

Writing: a page becomes a `response` record with an HTTP block in chunked transfer framing.
Pages whose payload equals that of one with a smaller id become `revisit` records that refer
to it. A block longer than `segment_bytes` is split into segments of that size: the first
is the response, the others are `continuation` records with the origin's id and a number, the
last of them with the total length. Spark's text writer stores the bytes, a bounded number of
records to a file.

Reading: a file's records are parsed by their lengths. Segments are grouped by origin id,
put in order by number, and checked against the total length; then the chunked framing is
undone and the payload compared with its digest. Whole records never pass a shuffle. A file is
read by one task, whole, once for whole records and once for segments.

Defined results: a null payload is an empty one. Rows that repeat the response's id are
responses too. Among rows without id alone, all are responses. Missing or surplus segments,
a wrong length or digest, or broken framing leave `payload` as far as it can be had and set
`intact` to false. An archive without records gives no rows.

Broken archives never fail. What does not begin with a version line is skipped up to the next
one. A length that is missing, no number, negative, or not followed by the end of a record
gives way to the next version line after a blank line, or the end of the file: what lies
before it is the block, and the record is not intact. The same goes for a record that the file
ends in, and for headers that the next record interrupts. A compressed file is read member by
member; of a broken one the part that can be had counts as the end of a file, and reading goes
on at the next member. A segment number that is none leaves a continuation out of its record,
which then is not intact, and makes a first segment a record of its own.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tierflow.llm.common import small_side, stored

SEGMENT_BYTES = 1 << 15
CHUNK_BYTES = 1 << 13
# Records of a file; with the segment size this bounds a file to some 16 MB.
RECORDS_PER_FILE = 512
# Payloads from this size on are stored once.
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_PARSED = T.StructType(
    [
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("page_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("sound", T.BooleanType()),
        T.StructField("block", T.BinaryType()),
    ]
)
_START = b"WARC/"
_GZIP = b"\x1f\x8b\x08"
_NUMBER = re.compile(r"[0-9]{1,18}")
_READ = T.StructType(
    [f for f in _PARSED.fields if f.name not in ("origin", "number", "total", "sound", "block")]
    + [T.StructField("payload", T.BinaryType()), T.StructField("payload_digest", T.StringType()), T.StructField("intact", T.BooleanType())]
)


# --- writing -------------------------------------------------------------


def write_warc(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    compression: str = "none",
) -> None:
    """Store `pages` as WARC files in the folder `path`."""
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("sha1", F.sha1("payload"))
    # Payloads that occur once need no partner, and most do.
    first = F.min(F.when(F.col("key").isNotNull(), F.struct("key", F.coalesce("url", F.lit("")).alias("url"))))
    copied = (
        rows.filter(F.length("payload") >= min_revisit_bytes)
        .groupBy("sha1")
        .agg(first.alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("sha1", "first")
    )
    copied = small_side(stored(copied, "copied"), 200)
    made = rows.join(copied, "sha1", "left")
    refers = F.when(~F.col("key").eqNullSafe(F.col("first.key")), F.col("first"))
    made = made.select(
        F.col("key").cast("string").alias("key"),
        "url",
        "payload",
        F.when(F.col("first").isNotNull(), refers["key"].cast("string")).alias("first_key"),
        F.when(F.col("first").isNotNull(), refers["url"]).alias("first_url"),
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = [r for row in zip(*(c.to_pylist() for c in batch.columns), strict=True) for r in _records(*row, segment_bytes)]
            # The writer's line end completes the blank lines after a record.
            yield pa.RecordBatch.from_arrays([pa.array([r[:-2] for r in records], pa.binary())], names=["value"])

    lines = made.mapInArrow(build, "value binary").select(F.col("value").cast("string").alias("value"))
    writer = lines.write.option("lineSep", "\r\n").option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.option("compression", compression).text(path)


def _records(key: str | None, url: str | None, payload: bytes, first_key: str | None, first_url: str | None, size: int) -> Iterator[bytes]:
    digest = base32_sha1(payload)
    own = record_id(key, url, digest)
    common = [("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        common.append(("WARC-Target-URI", _one_line(url)))
    if key is not None:
        common.append(("X-Page-ID", _one_line(key)))
    if first_key is not None:
        refers = [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(first_key, first_url or None, digest))]
        yield _record("revisit", own, common + refers, _HTTP)
        return
    block = _HTTP + chunked(payload)
    parts = [block[i : i + size] for i in range(0, len(block), size)]
    if len(parts) == 1:
        yield _record("response", own, common, block)
        return
    yield _record("response", own, [*common, ("WARC-Segment-Number", "1")], parts[0])
    for n, part in enumerate(parts[1:], 2):
        more = [("WARC-Date", DATE), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(n))]
        if n == len(parts):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record("continuation", record_id(own, str(n), digest), more, part)


def _record(kind: str, own: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record_id(key: str | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}\n{url or ''}\n{digest}')}>"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes) -> bytes:
    parts = [payload[i : i + CHUNK_BYTES] for i in range(0, len(payload), CHUNK_BYTES)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def _one_line(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


# --- reading -------------------------------------------------------------


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row per response and revisit: type, ids, payload and whether it is intact. Revisits
    have no payload of their own; see `resolved`."""
    whole = _parsed(spark, path, segmented=False)
    parts = _parsed(spark, path, segmented=True)
    # A record's own fields come with its first segment.
    names = ["record_type", "page_id", "url", "digest", "refers_to"]
    grouped = parts.groupBy(F.coalesce("origin", "record_id").alias("record_id")).agg(
        # Records written twice repeat their segments: a set holds each once.
        F.array_sort(F.collect_set(F.struct("number", "total", "sound", "block"))).alias("parts"),
        F.count("*").alias("n_parts"),
        F.greatest(F.count_if(F.col("number") == 1), F.lit(1)).alias("copies"),
        *[F.first(F.when(F.col("number") == 1, F.col(n)), ignorenulls=True).alias(n) for n in names],
    )
    joined = grouped.mapInArrow(_assemble, T.StructType([*_READ.fields, T.StructField("copies", T.LongType())]))
    joined = joined.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
    return whole.mapInArrow(_decode, _READ).unionByName(joined)


def resolved(records: DataFrame) -> DataFrame:
    """`records` with the size and digest of full payloads and the page a revisit refers to."""
    sizes = records.select(
        "record_type", "record_id", "page_id", "refers_to", "payload_digest", "digest", "intact", F.length("payload").cast("long").alias("payload_bytes")
    )
    sizes = stored(sizes, "records")
    revisit = F.col("record_type") == "revisit"
    answers = sizes.filter(~revisit).select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("to_page"), F.col("payload_bytes").alias("to_bytes"), F.col("payload_digest").alias("to_digest")
    )
    found = sizes.filter(revisit).drop("payload_bytes", "payload_digest").join(answers.distinct(), "refers_to", "left")
    found = found.select("record_type", "page_id", "to_page", F.col("to_bytes").alias("payload_bytes"), F.col("to_digest").alias("payload_digest"), (F.col("to_digest") == F.col("digest")).alias("intact"))
    own = sizes.filter(~revisit).select("record_type", "page_id", F.lit(None).cast("string").alias("to_page"), "payload_bytes", "payload_digest", "intact")
    return own.unionByName(found)


def _parsed(spark: SparkSession, path: str, segmented: bool) -> DataFrame:
    arrow = to_arrow_schema(_PARSED)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = [r for r in parse_records(content.as_py()) if (r["number"] is not None) == segmented]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, _PARSED)


def parse_records(raw: bytes) -> Iterator[dict]:
    """The records of one file."""
    for part in _members(raw) if raw.startswith(_GZIP) else [raw]:
        yield from _parse(part)


def _members(raw: bytes) -> Iterator[bytes]:
    """A compressed file unpacked, in a piece for each stretch of sound members; the part that
    can be had of a broken one ends a stretch."""
    found: list[bytes] = []
    at = 0
    while at >= 0:
        member = zlib.decompressobj(wbits=31)
        try:
            # Piece by piece, so that what comes before a fault is kept.
            for begin in range(at, len(raw), 1 << 16):
                found.append(member.decompress(raw[begin : begin + (1 << 16)]))
                if member.eof:
                    break
            sound = member.eof
        except zlib.error:
            found.append(_up_to_fault(raw, at, begin))
            sound = False
        if sound:
            at = min(begin + (1 << 16), len(raw)) - len(member.unused_data)
            if raw.startswith(_GZIP, at):
                continue
        yield b"".join(found)
        found = []
        at = raw.find(_GZIP, at if sound else at + 1)


def _up_to_fault(raw: bytes, at: int, begin: int) -> bytes:
    """What the member at `at` holds between `begin`, up to which it is sound, and its fault."""
    member, out = zlib.decompressobj(wbits=31), []
    member.decompress(raw[at:begin])
    try:
        for i in range(begin, len(raw)):
            out.append(member.decompress(raw[i : i + 1]))
    except zlib.error:
        pass
    return b"".join(out)


def _parse(raw: bytes) -> Iterator[dict]:
    at = 0
    while True:
        while raw[at : at + 1] in (b"\r", b"\n"):
            at += 1
        if not raw.startswith(_START, at):
            at = raw.find(b"\r\n" + _START, at) + 2
            if at < 2:
                return
        end, later = raw.find(b"\r\n\r\n", at), raw.find(b"\r\n" + _START, at)
        cut = end < 0 or 0 <= later < end
        if cut:
            # The file or another record starts before the headers end.
            end = later if later >= 0 else len(raw)
        h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in raw[at:end].decode("utf-8", "replace").split("\r\n")[1:])}
        begin = end if cut else end + 4
        size = None if cut else _number(h.get("content-length"))
        after = begin if size is None else begin + size
        sound = size is not None and after <= len(raw) and (after == len(raw) or raw.startswith(b"\r\n\r\n", after))
        if not sound and not cut:
            after = raw.find(b"\r\n\r\n" + _START, begin)
            after = len(raw) if after < 0 else after
        yield _record_of(h, raw[begin:after], sound)
        at = after


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and _NUMBER.fullmatch(text) else None


def _record_of(h: dict[str, str], block: bytes, sound: bool) -> dict:
    kind, own, origin = h.get("warc-type"), h.get("warc-record-id"), h.get("warc-segment-origin-id")
    number = _number(h.get("warc-segment-number"))
    if "warc-segment-number" in h and not number:
        number, sound = 0 if kind == "continuation" else None, False
    if own is None and origin is None and number is not None:
        # A segment of what is not known.
        number, sound = None, False
    return {
        "record_type": kind,
        "record_id": own,
        "page_id": h.get("x-page-id"),
        "url": h.get("warc-target-uri"),
        "digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "refers_to": h.get("warc-refers-to"),
        "origin": origin,
        "number": number,
        "total": _number(h.get("warc-segment-total-length")),
        "sound": sound,
        "block": block,
    }


def dechunked(block: bytes) -> tuple[bytes, bool]:
    """The payload of an HTTP block, and whether its framing is sound."""
    head, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in head.lower():
        return body, True
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0 or end + 2 + size > len(body):
            return b"".join(out), False
        if size == 0:
            return b"".join(out), True
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2


def _row(r: dict, block: bytes, sound: bool) -> dict:
    if r["record_type"] == "revisit":
        return {f.name: r.get(f.name) for f in _READ.fields} | {"intact": sound}
    payload, framed = dechunked(block)
    digest = base32_sha1(payload)
    own = {f.name: r.get(f.name) for f in _READ.fields}
    return own | {"payload": payload, "payload_digest": digest, "intact": sound and framed and digest == r["digest"]}


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = to_arrow_schema(_READ)
    for batch in batches:
        yield pa.RecordBatch.from_pylist([_row(r, r["block"], r["sound"]) for r in batch.to_pylist()], schema=schema)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for equal records, with their number."""
    schema = to_arrow_schema(_READ).append(pa.field("copies", pa.int64()))
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            # Continuations without a number have 0.
            parts = [p for p in r["parts"] if p["number"]]
            block = b"".join(p["block"] for p in parts)
            totals = {p["total"] for p in parts} - {None}
            sound = [p["number"] for p in parts] == list(range(1, len(parts) + 1)) and totals == {len(block)}
            sound = sound and all(p["sound"] for p in r["parts"])
            rows.append(_row(r, block, sound and r["n_parts"] == r["copies"] * len(parts)) | {"copies": r["copies"]})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)
