"""Web archives: gzip members written by tasks and read back in byte ranges.

Writing: each task writes archives of one gzip member per record. Of equal payloads of at
least ``MIN_REVISIT`` bytes, the row with the largest identifier becomes a response and the
others become revisits that name it.

Reading: a file is cut into byte ranges without an index. A task looks for gzip magic in its
range, takes a candidate for a member only if it inflates to a WARC header whose
Content-Length, end mark and checksum hold, and owns the records that start in its range; the
last one may end behind it.

Defined cases: a null payload is empty; a null identifier is written without a number and
read back as null; rows that repeat the largest identifier are responses as well; an empty
table gives no archive and no record. Other columns of the input are not read. Archives of others are read as
well: records of every type come back, with what they do not have as null. Nothing is lost in silence: where
bytes of an archive are in no readable record, or a payload differs from its digest, a row says so in
``problem``.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.llm.common import batch_of
from rentscope.llm.store import attempt_name, new_folder, open_new, open_there
from rentscope.session import materialise

MIN_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20
SPLIT_BYTES = 8 << 20
BLOCK = 1 << 18
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
LEVEL = 4
PAGE_URN = "urn:rentscope:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("uri", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
        ("path", pa.string()),
        ("problem", pa.string()),
    ]
)
RECORD_DDL = (
    "page_id long, uri string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary, path string, problem string"
)


# ---- writing


def with_originals(pages: DataFrame) -> DataFrame:
    """page_id, uri, payload, and original: the row a revisit refers to, else null.

    Equal payloads are found by SHA-256 on narrow rows; only groups of two or more are joined
    back, so a page moves only if that list is too large to be broadcast. Short pages have keys of
    their own, so that they are dealt to all tasks then.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("uri"),
        payload.alias("payload"),
        F.when(F.octet_length("html") >= MIN_REVISIT, F.sha2(payload, 256)).alias("same"),
    )
    groups = (
        rows.where("same is not null")
        .groupBy("same")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("original"))
        .where("n > 1")
        .select("same", "original")
    )
    groups = materialise(groups, "warc-groups")
    alone = F.concat(F.lit("#"), F.xxhash64("page_id", "uri").cast("string"))
    joined = rows.withColumn("same", F.coalesce("same", alone)).join(groups, "same", "left")
    return joined.select(
        "page_id",
        "uri",
        "payload",
        F.expr("if(original is not null and not (page_id <=> original), original, null)").alias(
            "original"
        ),
    )


def record_id(page_id: int | None) -> str:
    return f"<{PAGE_URN}{'' if page_id is None else page_id}>"


def record(page_id: int | None, uri: str | None, payload: bytes, original: int | None) -> bytes:
    """One record; the payload of a revisit stays out, its length and digest do not."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if uri is not None:
        head.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    if original is None:
        block = http + payload
    else:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(original)}"]
        block = http
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives and return the list of them: path, bytes, records."""
    listed = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])

    def write(batches):
        out = uri = None
        size = count = 0
        for batch in batches:
            for page_id, page_uri, payload, original in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                if out is None:
                    uri = attempt_name(folder, ".warc.gz")
                    out, size, count = open_new(uri), 0, 0
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(record(page_id, page_uri, payload, original)) + packer.flush()
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield batch_of(listed, [[uri], [size], [count]])
        if out is not None:
            out.close()
            yield batch_of(listed, [[uri], [size], [count]])

    rows = with_originals(pages).select("page_id", "uri", "payload", "original")
    return materialise(
        rows.mapInArrow(write, "path string, bytes long, records long"), "warc-archives"
    )


# ---- reading


class _Window:
    """Bytes of an open file from any position on, read block by block."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def read(self, pos: int) -> bytes:
        """Some bytes from pos on; empty at the end of the file."""
        if not self.at <= pos < self.at + len(self.data):
            self.file.seek(pos)
            self.at, self.data = pos, self.file.read(min(BLOCK, max(0, self.size - pos)))
        return self.data[pos - self.at :]

    def find_magic(self, pos: int, end: int) -> int | None:
        """The first place of gzip magic that begins in [pos, end)."""
        while pos < end:
            data = self.read(pos)
            if len(data) < len(MAGIC) and pos + len(data) < self.size:
                self.data = b""
                data = self.read(pos)
            found = data.find(MAGIC)
            if found >= 0:
                return pos + found if pos + found < end else None
            if len(data) < len(MAGIC):
                return None
            pos += len(data) - len(MAGIC) + 1
        return None

    def member(self, pos: int) -> tuple[bytes, int] | bool:
        """The text of the member that begins here and the place behind it. If it cannot be read, whether
        it begins as a WARC record does."""
        if not self._begins_as_record(pos):
            return False
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            data = self.read(pos)
            if not data:
                return True
            try:
                parts.append(inflate.decompress(data))
            except zlib.error:
                return True
            pos += len(data) - len(inflate.unused_data)
        return b"".join(parts), pos

    def _begins_as_record(self, pos: int) -> bool:
        """Whether a member here begins with a record's first bytes, whatever follows."""
        inflate, head = zlib.decompressobj(31), b""
        while len(head) < len(VERSION) and (data := self.read(pos)):
            try:
                head += inflate.decompress(data[:4096], len(VERSION) - len(head))
            except zlib.error:
                return False
            pos += min(4096, len(data))
        return head == VERSION


def parse(text: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header and block of a record, or None if its length or end mark is wrong."""
    head, border, rest = text.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not border or not lines[0].startswith(VERSION.decode()):
        return None
    fields = {
        name.strip().lower(): value.strip()
        for name, colon, value in (line.partition(":") for line in lines[1:])
        if colon
    }
    length = fields.get("content-length", "")
    if not length.isdigit() or rest[int(length) :] != b"\r\n\r\n":
        return None
    return fields, rest[: int(length)]


def _readable(member: tuple[bytes, int] | bool) -> tuple[dict[str, str], bytes] | None:
    return parse(member[0]) if isinstance(member, tuple) else None


def scan(file, size: int, start: int, end: int):
    """What starts in [start, end): (header, block) of records, and texts that tell of bytes in none.

    A record must begin where the one before it ends. So a task also reads the one behind its last
    one, and the bytes before the first of a range belong to the range before, except at the start
    of the file.
    """
    window, pos = _Window(file, size), start
    due = 0 if start == 0 else None
    while (pos := window.find_magic(pos, end)) is not None:
        member = window.member(pos)
        parsed = _readable(member)
        if parsed:
            if due is not None and due != pos:
                yield f"no readable record in bytes {due} to {pos}"
            yield parsed
            due = pos = member[1]
        else:
            if member and due is None:
                yield f"no readable record at byte {pos}"
            pos += 1
    if due is not None and due < size and (due < end or not _readable(window.member(due))):
        yield f"no readable record from byte {due} on"


def records_in(file, size: int, start: int, end: int):
    """(header, block) of the records that start in [start, end)."""
    return (found for found in scan(file, size, start, end) if isinstance(found, tuple))


def _page_id(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(PAGE_URN)
    return int(number) if number.lstrip("-").isdigit() else None


def _sha1(stated: str) -> str | None:
    """The hex form of a stated SHA-1, which archives write in base 32 or 16; None for any other digest."""
    kind, _, value = stated.partition(":")
    if kind.strip().lower() != "sha1":
        return None
    try:
        return (base64.b32decode(value.upper()) if len(value) == 32 else bytes.fromhex(value)).hex()
    except ValueError:
        return None


def _row(fields: dict[str, str], block: bytes, with_payload: bool, path: str | None = None) -> tuple:
    """A record as a row. The payload of an HTTP message is what follows its header, of others the block."""
    kind, problem = fields.get("warc-type"), None
    stated = _sha1(fields.get("warc-payload-digest", ""))
    is_http = fields.get("content-type", "").lower().startswith("application/http")
    head, _, payload = block.partition(b"\r\n\r\n") if is_http else (b"", b"", block)
    if kind == "revisit":
        # Its payload is elsewhere; its header may tell how long that is.
        lengths = [
            line.partition(b":")[2].strip()
            for line in head.split(b"\r\n")
            if line.lower().startswith(b"content-length:")
        ]
        length = int(lengths[0]) if lengths and lengths[0].isdigit() else None
        digest, payload = stated, None
    else:
        length, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if stated is not None and digest != stated:
            problem = f"the payload's digest is {digest}, not {stated}"
    return (
        _page_id(fields.get("warc-record-id")),
        fields.get("warc-target-uri"),
        kind,
        _page_id(fields.get("warc-refers-to")),
        length,
        digest,
        payload if with_payload else None,
        path,
        problem,
    )


def read_archives(
    spark: SparkSession,
    archives: DataFrame,
    split_bytes: int = SPLIT_BYTES,
    with_payload: bool = True,
) -> DataFrame:
    """One row per record of the listed archives (path, bytes), and one per stretch of bytes in none."""
    splits = archives.where("bytes > 0").select(
        "path",
        F.col("bytes").alias("size"),
        F.explode(F.expr(f"sequence(0L, bytes - 1, {int(split_bytes)}L)")).alias("start"),
    )
    count = max(1, splits.count())
    lost = [None] * (len(RECORD) - 2)

    def read(batches):
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held = [], 0
                with open_there(path) as file:
                    for found in scan(file, size, start, start + split_bytes):
                        if isinstance(found, str):
                            rows.append((*lost, path, found))
                        else:
                            rows.append(_row(*found, with_payload, path))
                        held += len(rows[-1][-3] or b"") + 200
                        if held > 8 << 20:
                            yield batch_of(RECORD, list(zip(*rows, strict=True)))
                            rows, held = [], 0
                if rows:
                    yield batch_of(RECORD, list(zip(*rows, strict=True)))

    # The rows are a few bytes each, but each stands for a range: one per task.
    return splits.repartition(count).mapInArrow(read, RECORD_DDL)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write every page to archives, read them back, and return what the records say; an error if
    any of them cannot be read."""
    archives = write_archives(pages, new_folder(spark, "warc"))
    found = read_archives(spark, archives, with_payload=False)
    told = F.concat("path", F.lit(": "), "problem")
    sound = F.when(F.col("problem").isNull(), F.col("payload_bytes")).otherwise(F.raise_error(told).cast("long"))
    return found.withColumn("payload_bytes", sound).drop("payload", "path", "problem")
