"""WARC archives: a writer of one gzip member per record, and a reader that salvages what damage has left.

Archives are written by Spark's text writer, so they commit with the task that made them and can stand in any store Spark writes to. It ends
every value with a separator; here that is an empty gzip member, which readers of gzip skip by the format's own rules.
"""

from __future__ import annotations

import base64
import binascii
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import salted_join

VERSION = b"WARC/1.1\r\n"
#: A gzip member without content.
SEPARATOR = gzip.compress(b"", mtime=0)
#: Where a record or a member may begin.
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
#: Records in an archive at most, so that one archive fits in a task's memory.
RECORDS_PER_ARCHIVE = 2000
CHUNK = 1 << 16

RECORDS = (
    "archive string, kind string, start long, length long, reason string, record_type string, record_id string, uri string, "
    "payload_bytes long, payload_digest string, refers_to string, payload binary"
)


def digest_label(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def digest_hex(label: str | None) -> str | None:
    """Hex of a `sha1:` label in base 32 or base 16; null if it is neither."""
    text = (label or "").strip().removeprefix("sha1:")
    try:
        return (bytes.fromhex(text) if len(text) == 40 else base64.b32decode(text.upper())).hex() if text else None
    except (ValueError, binascii.Error):
        return None


def record_bytes(kind: str, record_id: str, uri: str | None, block: bytes, payload_digest: str, refers_to: str | None, date: str) -> bytes:
    """One record; `block` is the HTTP message."""
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id,
        "WARC-Date": date,
        "WARC-Target-URI": uri and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri),
        "WARC-Payload-Digest": digest_label(payload_digest),
        "WARC-Block-Digest": digest_label(hashlib.sha1(block).hexdigest()),
        "WARC-Refers-To": refers_to,
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if refers_to else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value).encode()
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def mark_revisits(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Pages (page_id, url, html) as records: payload, payload_bytes, payload_digest, record_type, refers_to.

    Of equal payloads of at least `min_bytes` the largest page_id is the response, and rows with another page_id, or none, revisit it; rows that
    repeat that page_id are responses too, and so is a group without any page_id. A null html is an empty payload. Other columns are
    dropped. Copies of one page are spread over tasks.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    key = ["payload_digest", "payload_bytes"]
    groups = rows.filter(F.col("payload_bytes") >= min_bytes).groupBy(*key).agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    joined = salted_join(rows, groups.filter("n > 1").drop("n"), key, F.xxhash64("page_id", "url"))
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    kind = F.when(revisit, "revisit").otherwise("response")
    return joined.select("page_id", "url", "payload", *key[::-1], kind.alias("record_type"), F.when(revisit, F.col("refers_to")).alias("refers_to"))


def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def write_archives(marked: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", level: int = 1) -> None:
    """Writes what `mark_revisits` gives. A revisit keeps the HTTP head, with the length of the payload it stands for, not the payload."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for record_id, uri, payload, size, digest, kind, refers_to in batch.itertuples(index=False, name=None):
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
                record = record_bytes(kind, record_id, uri, head + (payload or b""), digest, refers_to, date)
                out.append(gzip.compress(record, level, mtime=0))
            yield pd.DataFrame({"member": out})

    revisit = F.col("record_type") == "revisit"
    rows = marked.select(
        page_urn(F.col("page_id")).alias("record_id"),
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(revisit, page_urn(F.col("refers_to"))).alias("refers_to"),
    )
    written = rows.mapInPandas(members, "member binary").select(F.col("member").cast("string").alias("value"))
    options = {"encoding": "ISO-8859-1", "lineSep": SEPARATOR.decode("latin-1"), "compression": "none", "maxRecordsPerFile": RECORDS_PER_ARCHIVE}
    written.write.options(**options).text(path)


class Damaged(Exception):
    """What is wrong with bytes that should be a record or a member."""


def parse_record(data: bytes, at: int, proven: bool = False) -> tuple[dict, int]:
    """The record at `at` and where it ends; if it must be `proven`, one without a digest of its own is damaged."""
    if not VERSION_LINE.match(data, at):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("header without end")
    fields: dict[str, str] = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without colon")
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not re.fullmatch(r"\d{1,18}", fields.get("content-length", "")) or "warc-type" not in fields:
        raise Damaged("header without length or type")
    if proven and not fields.keys() & {"warc-block-digest", "warc-payload-digest"}:
        raise Damaged("record without digest in a damaged member")
    begin, size = end + 4, int(fields["content-length"])
    if data[begin + size : begin + size + 4] != b"\r\n\r\n":
        raise Damaged("record without end")
    block = data[begin : begin + size]
    if "warc-block-digest" in fields and digest_hex(fields["warc-block-digest"]) != hashlib.sha1(block).hexdigest():
        raise Damaged("block digest differs")
    payload, length = block, size
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        stated = re.search(rb"(?im)^content-length:\s*(\d{1,18})\s*$", head)
        length = len(payload)
        if fields["warc-type"] == "revisit":
            length = int(stated[1]) if stated else None
    digest = digest_hex(fields.get("warc-payload-digest"))
    if fields["warc-type"] != "revisit":
        own = hashlib.sha1(payload).hexdigest()
        if "warc-payload-digest" in fields and digest != own:
            raise Damaged("payload digest differs")
        digest = own
    return {
        "record_type": fields["warc-type"], "record_id": fields.get("warc-record-id"), "uri": fields.get("warc-target-uri"),
        "payload_bytes": length, "payload_digest": digest, "refers_to": fields.get("warc-refers-to"), "payload": payload,
    }, begin + size + 4


def inflate(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at `at` inflates to, where it ends or fails, and why it fails; its checksum and length are checked."""
    begin, step = at, CHUNK
    while True:
        inflater, parts, view, at = zlib.decompressobj(31), [], memoryview(data), begin
        fine = len(data) if step == CHUNK else failed
        try:
            while not inflater.eof:
                if at >= len(data):
                    return b"".join(parts), at, "member without end"
                size = CHUNK if at < fine else 1
                parts.append(inflater.decompress(view[at : at + size]))
                at = min(at + size, len(data))
            return b"".join(parts), at - len(inflater.unused_data), None
        except zlib.error:
            if step == 1:
                return b"".join(parts), at, "member does not inflate or its checksum differs"
            step, failed = 1, at  # once more, byte by byte from this chunk on, to keep what it holds before the fault


def records_in(content: bytes, proven: bool) -> tuple[list[dict], list[tuple[int, int, str]]]:
    """Sound records of an inflated member, and the ranges between them that hold none, each with the reason."""
    records, gaps, at, gap, reason = [], [], 0, None, ""
    while at < len(content):
        try:
            record, end = parse_record(content, at, proven)
        except Damaged as damage:
            if gap is None:
                gap, reason = at, str(damage)
            found = VERSION_LINE.search(content, at + 1)
            at = found.start() if found else len(content)
            continue
        if gap is not None:
            gaps.append((gap, at, reason))
            gap = None
        records.append(record)
        at = end
    if gap is not None:
        gaps.append((gap, len(content), reason))
    return records, gaps


def name_of(record: dict) -> tuple:
    return record["record_type"], record["record_id"], record["payload_digest"]


def salvage(data: bytes) -> Iterator[dict]:
    """Every sound record, and every gap between them: `kind` (record or gap), `start`, `length` (bytes of the archive) and `reason`.

    After a failed check the reader tries each later place that looks like a member or a version line, until one is wholly sound. Records and
    gaps (and members without content) cover the archive. Inside a damaged record, a whole sound record kept as payload would be read as one.

    A member with a bad record, or that fails itself, gives its sound records too; of one that fails, those with a digest. Its gaps have length 0 and the
    reason names the inflated bytes; the records of a failed member have length 0 as well, since its bytes are those of a gap.
    """
    at, gap, reason = 0, None, None
    until, told = 0, set()  # where the last failed member stopped, and its records, which a stored member also shows as they are
    while at < len(data):
        records, inner, broken = [], [], None
        try:
            if data[at : at + 2] == b"\x1f\x8b":
                content, end, broken = inflate(data, at)
                records, inner = records_in(content, broken is not None)
                if broken is None and inner and not records:
                    broken = inner[0][2]
            else:
                record, end = parse_record(data, at)
                if at < until and name_of(record) in told:
                    broken = "record of a damaged member"
                else:
                    records = [record]
        except Damaged as damage:
            broken = str(damage)
        if broken is None and gap is not None:
            yield {"kind": "gap", "start": gap, "length": at - gap, "reason": reason}
            gap = None
        size = end - at if broken is None else 0
        for record in records:
            if broken is None or at >= until or name_of(record) not in told:
                yield {"kind": "record", "start": at, "length": size, **record}
        if records:
            for low, high, why in inner:
                yield {"kind": "gap", "start": at, "length": 0, "reason": f"{why}, inflated bytes {low} to {high} of the member"}
        if broken is None:
            at = end
            continue
        if records:
            told = {*told, *map(name_of, records)} if at < until else set(map(name_of, records))
            until = max(until, end)
        if gap is None:
            gap, reason = at, broken
        found = START.search(data, at + 1)
        at = found.start() if found else len(data)
    if gap is not None:
        yield {"kind": "gap", "start": gap, "length": len(data) - gap, "reason": reason}


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Rows of RECORDS for all archives under `path`, plain or of gzip members, however damaged: rows of kind `record`, and one row of kind
    `gap` for every range of bytes put aside. Archives spread over tasks; one archive is held in memory at a time (RECORDS_PER_ARCHIVE).
    An empty archive gives no rows. `payloads=False` leaves payloads null.
    """
    names = [field.split()[0] for field in RECORDS.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["path"], batch["content"], strict=True):
                rows, held = [], 0
                for row in salvage(bytes(content)):
                    row["archive"] = archive
                    held += len(row.get("payload") or b"") + 500
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    if held > 8 << 20:
                        yield frame(rows)
                        rows, held = [], 0
                if rows:
                    yield frame(rows)

    def frame(rows: list[dict]) -> pd.DataFrame:
        out = pd.DataFrame(rows).reindex(columns=names).astype(object)
        out = out.where(out.notna(), None)
        for name in ("start", "length", "payload_bytes"):
            out[name] = out[name].astype("Int64")
        return out

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, RECORDS)
