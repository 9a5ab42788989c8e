"""Web archives: writing records, each in a gzip member of its own, and reading them in spite of damage.

Writing. Of the pages with one payload, one is written whole (``response``); the others
are ``revisit`` records that name it and hold only the HTTP head. Groups are found by the
payload's SHA-1 and length, in sums that combine before the shuffle, and only payloads that
occur more than once are joined back. Tasks make members from their own rows, and Spark's text
writer puts them into files (its committer handles lost tasks; any file system of Spark's
will do). What the writer sets between two rows is an empty gzip member, so files are plain
multi-member gzip. A file has at most ``file_records`` records.

Reading. Files come through Spark, one per row. A member or a plain record is believed only if
everything holds: the gzip checksum and length, the version line, the header's form, the
length of the block, its digest and the payload's. After a failed check the reader goes on to
the next place at which a valid member begins or a version line with a valid record, takes
records again from there, and logs the bytes in between as a gap with the reason. What salvage needs is
one file in memory; a task unpacks one member at a time.

Defined results: a null payload counts as empty, a null id is below all others and is read
back as null. Of rows with the same id, payload and url, the first is the response if
that id is the largest, the rest refer to the same id; with one id and several urls,
the largest url is the response. A null url is given as ``urn:page:<id>``. An empty table
writes no record and reads none. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.tables import stored
from terrace.llm.texts import let

FILE_RECORDS = 4_000
#: WARC-Date must stand in each record; pages have none.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A longer header is damage: a search for its end must not run through the rest of the file.
MOST_HEADER = 1 << 20
_END = b"\r\n\r\n"
_STEP = 1 << 14
_COPIES = 10_000
_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
RECORD = "file string, start long, end long, gap string, record_type string, record_id string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


_EMPTY_MEMBER = _gzip(b"")


def sha1_base32(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1: five hexadecimal digits are four of base 32."""
    digits = lambda x, i: F.lpad(F.conv(F.substring(x, i * 5 + 1, 5), 16, 32), 4, "0")
    return F.translate(let(F.sha1(payload), lambda x: F.concat(*[digits(x, i) for i in range(8)])), *_BASE32)


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# -- writing -----------------------------------------------------------------------


def classified(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> tuple[DataFrame, DataFrame]:
    """(responses with payloads, revisits): one row per record to write."""
    held = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    )
    told = held.select("page_id", "url", sha1_base32(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"), "payload")
    groups = told.groupBy("digest", "bytes").agg(F.max(F.struct("page_id", "url")).alias("top"), F.count("*").alias("rows"))
    several = stored(groups.where("rows > 1").select("digest", "bytes", "top"), "several")
    same = ["digest", "bytes"]
    alone = told.join(several, same, "left_anti").select("page_id", "url", "digest", "bytes", "payload")
    # One payload for each group of copies: all are equal, and the maximum combines before the shuffle.
    whole = told.join(several, same, "left_semi").groupBy(*same).agg(F.max("payload").alias("payload")).join(several, same)
    responses = alone.unionByName(whole.select("top.page_id", "top.url", "digest", "bytes", "payload"))
    leads = F.col("page_id").eqNullSafe(F.col("top.page_id")) & F.col("url").eqNullSafe(F.col("top.url"))
    copies = told.drop("payload").join(several, same).groupBy(*same, "top", "page_id", "url").agg(F.count("*").alias("copies"))
    more = copies.withColumn("_more", F.col("copies") - F.when(leads, 1).otherwise(0)).where("_more > 0")
    # One row that is there very often becomes its copies in several tasks.
    begun = more.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_more"), F.lit(_COPIES).cast("long")))).repartition("digest", "page_id", "_from")
    numbers = F.sequence(F.col("_from"), F.least(F.col("_from") + (_COPIES - 1), F.col("_more")))
    revisits = begun.select("page_id", "url", "digest", "bytes", F.col("top.page_id").alias("refers_to"), F.explode(numbers).alias("copy"))
    return responses, revisits


def _shown(page: int | None) -> str:
    return "null" if page is None else str(page)


def _record_id(page: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{_shown(page)}/{digest}/{copy}')}>"


def _target(url: str | None, page: int | None) -> str:
    return f"urn:page:{_shown(page)}" if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")


def record(page: int | None, url: str | None, digest: str, size: int, payload: bytes | None, refers_to: int | None = None, copy: int = 0, date: str = DATE) -> bytes:
    """One record; without ``payload`` a revisit of the page ``refers_to``."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if payload is None else 'response'}",
        f"WARC-Record-ID: {_record_id(page, digest, copy)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_target(url, page)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{_digest(block)}",
        f"Page-Id: {_shown(page)}",
    ]
    if payload is None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest, 0)}", f"Refers-To-Page-Id: {_shown(refers_to)}", "WARC-Truncated: length"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _END + block + _END


def write_archives(pages: DataFrame, path: str, file_records: int = FILE_RECORDS, page_id: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Write a record per row of ``pages`` below ``path`` (a new folder that all executors reach)."""
    responses, revisits = classified(pages, page_id, url, payload)
    rows = responses.withColumns({"refers_to": F.lit(None).cast("long"), "copy": F.lit(0).cast("long")}).unionByName(
        revisits.withColumn("payload", F.lit(None).cast("binary"))
    )

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "digest", "bytes", "payload", "refers_to", "copy")]
            held: list[bytes] = []
            for i in range(batch.num_rows):
                held.append(_gzip(record(*[c[i].as_py() for c in columns])))
                if i + 1 == batch.num_rows or sum(map(len, held)) > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["member"])
                    held = []

    # The text writer takes a binary value as it is; its line separator is read as single bytes.
    packed = rows.mapInArrow(members, "member binary").select(F.col("member").cast("string").alias("value"))
    packed.write.options(lineSep=_EMPTY_MEMBER.decode("latin-1"), encoding="ISO-8859-1", maxRecordsPerFile=file_records).text(path)


# -- reading -----------------------------------------------------------------------


class Damage(Exception):
    """A check that failed."""


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """What the gzip member at a place holds, and where it ends."""
    opened, view, out = zlib.decompressobj(31), memoryview(data), []
    while not opened.eof:
        if at >= len(data):
            raise Damage("gzip: the member does not end")
        try:
            out.append(opened.decompress(view[at : at + _STEP]))
        except zlib.error as error:
            raise Damage(f"gzip: {error}") from None
        at = min(at + _STEP, len(data))
    return b"".join(out), at - len(opened.unused_data)


def _headers(data: bytes, at: int) -> tuple[dict[str, str], int]:
    """The header of the record at a place, names in lower case, and where its block begins."""
    version = _VERSION.match(data, at)
    if not version:
        raise Damage("no version line")
    end = data.find(_END, version.end() - 2, version.end() + MOST_HEADER)
    if end < 0:
        raise Damage("the header does not end")
    found = {}
    for line in data[version.end() : end].split(b"\r\n") if end > version.end() else []:
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!-9;-~]+", name):
            raise Damage("a header line has no name")
        found[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    return found, end + len(_END)


def _number(text: str | None, what: str) -> int | None:
    if text in (None, "null"):
        return None
    if not re.fullmatch(r"-?[0-9]{1,18}|-?[0-9]{19}", text):
        raise Damage(f"{what} is no number")
    return int(text)


def _record(data: bytes, at: int, keep_payload: bool) -> tuple[tuple, int]:
    """The checked record at a place, and where it ends."""
    found, begin = _headers(data, at)
    size = _number(found.get("content-length"), "Content-Length")
    if size is None or size < 0:
        raise Damage("no Content-Length")
    end = begin + size
    if data[end : end + 4] != _END:
        raise Damage("the block does not end where its length says")
    block = data[begin:end]
    if (said := found.get("warc-block-digest")) and said != f"sha1:{_digest(block)}":
        raise Damage("block digest")
    kind = found.get("warc-type")
    if not kind:
        raise Damage("no WARC-Type")
    payload, length = None, None
    if found.get("content-type", "").startswith("application/http"):
        head = block.find(_END)
        if head < 0:
            raise Damage("the HTTP head does not end")
        payload = block[head + 4 :]
        said = re.search(rb"(?i)\r\ncontent-length:[ \t]*([0-9]+)", block[: head + 2])
        length = int(said[1]) if said else None
    digest = found.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response" and payload is not None:
        if digest and digest != _digest(payload):
            raise Damage("payload digest")
        length, digest = len(payload), _digest(payload)
    refers = _number(found.get("refers-to-page-id"), "Refers-To-Page-Id")
    row = (kind, found.get("warc-record-id"), _number(found.get("page-id"), "Page-Id"), found.get("warc-target-uri"), length, digest, refers)
    return (*row, payload if keep_payload else None), end + 4


def _whole_member(data: bytes, at: int, keep_payload: bool) -> tuple[list[tuple], int]:
    """The records of the member at a place, all valid, and where the member ends."""
    opened, end = _member(data, at)
    rows, inside = [], 0
    while inside < len(opened):
        row, inside = _record(opened, inside, keep_payload)
        rows.append(row)
    return rows, end


def salvage(data: bytes, keep_payload: bool = True) -> Iterator[tuple]:
    """(start, end, gap, record fields) for all valid records, and for the gaps between them.

    ``gap`` is null for a record, else the reason of the first failed check in the bytes of the gap.
    """
    at, gap, reason = 0, None, None
    nothing = (None,) * 8
    while at < len(data):
        try:
            if data.startswith(_MAGIC, at):
                rows, end = _whole_member(data, at, keep_payload)
            else:
                row, end = _record(data, at, keep_payload)
                rows = [row]
        except Damage as damage:
            if gap is None:
                gap, reason = at, str(damage)
            following = _START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield (gap, at, reason, *nothing)
            gap = None
        yield from ((at, end, None, *row) for row in rows)
        at = end
    if gap is not None:
        yield (gap, len(data), reason, *nothing)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the files below ``path``, and gaps as rows with ``gap`` set: file, first byte, byte past the last, reason.

    ``payloads``: whether to return them too; they are checked in any case. A file has to fit
    in a task's memory and below 2 GB; a larger one is an error of the reader, never skipped.
    """
    names = [part.split()[0] for part in RECORD.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in (part.split() for part in RECORD.split(", "))])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], names=names)

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                file, data, held, size = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), [], 0
                for row in salvage(data, payloads):
                    held.append((file, *row))
                    size += len(row[-1] or b"") + 500
                    if size > 4 << 20:
                        yield batch_of(held)
                        held, size = [], 0
                if held:
                    yield batch_of(held)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(read, RECORD)


def records(read: DataFrame) -> DataFrame:
    return read.where("gap IS NULL").drop("gap")


def gaps(read: DataFrame) -> DataFrame:
    """Quarantined bytes: file, first byte, byte past the last, and the first check that failed there."""
    return read.where("gap IS NOT NULL").select("file", "start", "end", "gap")
