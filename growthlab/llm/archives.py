"""Legacy ARC archives converted to WARC.

An ARC file opens with a version block that names the fields of its record lines; every record is one such line,
whose last field declares the length of what follows. Records are found by these lines and lengths alone, never by
looking for separators in payloads. Conversion makes for each record what WARC asks for and ARC lacks: an identifier
(a name-based UUID of archive, offset, address and time, so a repeated task gives the same), an ISO time, a
record type, and SHA-1 digests of block and payload. Records whose payload another record has already are written
as revisits of it. Archives are files in a folder, plain or gzip (any number of members); a file is one task's
work and is unpacked as a stream."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlab.llm.storage import forget, ready, stored
from growthlab.session import fresh_folder

#: fields of a record line by ARC version (fixed values of the format)
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: address, IP, date, what stands between, declared length
_LINE = re.compile(rb"(\S.*?) (\S+) (\d{4,17}) (\S.*) (\d+)")
_HEAD_END = re.compile(rb"\r\n\r\n|\n\n")
#: archives are written once and read once or twice: packing costs more than it saves later
_FAST = {"zlib.compress.level": "BEST_SPEED"}
#: longest record or header line
LONGEST_LINE = 1 << 20
HTTP = "application/http; msgtype=response"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    """A name-based UUID: equal parts, equal identifier."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(map(str, parts)))}>"


def iso_time(digits: str, otherwise: str = "1970-01-01T00:00:00Z") -> str:
    """ARC times have 14 digits, early ones fewer: what is missing is the first moment of the rest."""
    full = digits[:14] + "00000101000000"[len(digits[:14]) :]
    try:
        return datetime.strptime(full, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")
    except ValueError:
        return otherwise


@dataclass
class Record:
    offset: int
    url: str
    ip: str
    date: str
    mime: str
    block: bytes
    more: dict[str, str] = field(default_factory=dict)
    #: bytes before it that were no record, and whether the archive ends inside it
    skipped: int = 0
    cut: bool = False

    @property
    def is_http(self) -> bool:
        return self.block.startswith(b"HTTP/")

    def payload_at(self) -> int:
        """Where the payload begins: after an HTTP head, else at once."""
        end = _HEAD_END.search(self.block) if self.is_http else None
        return end.end() if end else len(self.block) if self.is_http else 0


def _unpacked(content: pa.Buffer) -> Iterator[bytes]:
    """An archive's bytes in pieces, out of their gzip members if they are packed; a broken member ends them."""
    raw = pa.BufferReader(content)
    if content.size < 2 or content[:2].to_pybytes() != b"\x1f\x8b":
        while piece := raw.read(1 << 16):
            yield piece
        return
    member, piece = zlib.decompressobj(31), b""
    while piece := piece or raw.read(1 << 14):
        try:
            out = member.decompress(piece)
        except zlib.error:
            return
        if out:
            yield out
        piece = member.unused_data
        if member.eof:
            member = zlib.decompressobj(31)


class _Source:
    """Lines and lengths of an archive, with the place reached."""

    def __init__(self, content: pa.Buffer) -> None:
        self.pieces, self.at, self.ahead = _unpacked(content), 0, b""

    def line(self) -> bytes:
        """Up to and with the next newline; a longer line comes in pieces."""
        while (end := self.ahead.find(b"\n")) < 0 and len(self.ahead) < LONGEST_LINE:
            got = next(self.pieces, b"")
            if not got:
                break
            self.ahead += got
        end = end + 1 if end >= 0 else len(self.ahead)
        out, self.ahead = self.ahead[:end], self.ahead[end:]
        self.at += len(out)
        return out

    def take(self, size: int) -> bytes:
        parts, left = [], size
        while True:
            parts.append(self.ahead[:left])
            self.ahead = self.ahead[left:]
            left -= len(parts[-1])
            if not left or not (got := next(self.pieces, b"")):
                break
            self.ahead = got
        out = b"".join(parts)
        self.at += len(out)
        return out


def _line_fields(line: bytes, names: list[str]) -> tuple[str, str, str, str, dict[str, str], int] | None:
    """A record line by the archive's field names, or None. Addresses and content types may hold spaces."""
    found = _LINE.fullmatch(line)
    if found is None:
        return None
    url, ip, date, middle, length = (g.decode("utf-8", "replace") for g in found.groups())
    extra = names[4:-1]
    words = middle.split(" ")
    if len(words) <= len(extra):
        return None
    at = len(words) - len(extra)
    return url, ip, date, " ".join(words[:at]), dict(zip(extra, words[at:])), int(length)


def read_arc(content: pa.Buffer) -> Iterator[Record]:
    """Records of an archive in order, the version block's first. What is no record where one should begin is
    skipped line by line."""
    source, names, skipped = _Source(content), FIELDS[1].split(), 0
    while line := source.line():
        start, text = source.at - len(line), line.rstrip(b"\r\n")
        if not text:
            continue
        is_version = text.startswith(b"filedesc:")
        got = _line_fields(text, FIELDS[1].split() if is_version else names)
        if got is None:
            skipped += len(line)
            continue
        *head, more, length = got
        block = source.take(length)
        if is_version:  # its own line has the fields that its block is about to name
            about = block.decode("utf-8", "replace").splitlines()
            version = int(about[0].split(" ")[0]) if about and about[0][:1].isdigit() else 1
            listed = about[1].split() if len(about) > 1 else []
            names = listed if len(listed) >= 5 else FIELDS.get(version, FIELDS[1]).split()
            head[3], more = "text/plain", {"version": str(version), "origin": " ".join(about[0].split(" ")[2:]) if about else ""}
        yield Record(start, *head, block, more, skipped, len(block) < length)
        skipped = 0


def arc_text(pages: DataFrame, url: Column, payload: Column, head: Column, date: str) -> DataFrame:
    """One column `record` of ARC records, for a text writer with newlines between: HTTP responses with the given
    extra head lines, a version block before a partition's first. Odd partitions make version 2. DataFrame functions
    only; what a payload is encoded in does not matter."""
    number = F.monotonically_increasing_id()
    rows = pages.select(url.alias("url"), payload.cast("string").alias("payload"), head.alias("head"), number.alias("n"))
    second = F.shiftright("n", 33) % 2 == 1
    first = F.col("n").bitwiseAND((1 << 33) - 1) == 0
    url = F.regexp_replace(F.when(F.col("url") != "", F.col("url")).otherwise("unknown:"), r"[\x00-\x20\x7F]", "%20")
    body = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), "head",
        F.lit("Content-Length: "), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"), "payload",
    )
    rows = rows.select("n", url.alias("url"), body.alias("body"))
    size = F.octet_length("body").cast("string")
    name = F.concat(F.lit("pages-"), F.shiftright("n", 33).cast("string"), F.lit(".arc"))
    line = F.concat_ws(
        " ", "url", F.lit("0.0.0.0"), F.lit(date), F.lit("text/html"),
        F.when(second, F.concat_ws(" ", F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), name)), size,
    )

    def opening(version: int) -> Column:
        about = f"{version} 0 pages\n{FIELDS[version]}\n"
        middle = "text/plain" if version == 1 else "text/plain 200 - - 0 pages.arc"
        return F.concat(F.lit("filedesc://"), name, F.lit(f" 0.0.0.0 {date} {middle} {len(about)}\n{about}\n"))

    opened = F.when(first, F.when(second, opening(2)).otherwise(opening(1))).otherwise("")
    return rows.select(F.concat(opened, line, F.lit("\n"), "body").alias("record"))


def write_arc(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    id_head: str = "X-Page-Id",
    date: str = "20000101000000",
) -> str:
    """Pages as ARC files (gzip) in a new shared folder, whose path is returned; the id is a line of the HTTP head
    (none if NULL). A NULL payload is empty, a NULL or empty address `unknown:`."""
    spark = ready(pages.sparkSession)
    id_ = F.col(id_col).cast("string")
    head = F.when(id_.isNotNull(), F.concat(F.lit(f"{id_head}: "), id_, F.lit("\r\n"))).otherwise("")
    path = fresh_folder(spark, "arc")
    text = arc_text(pages, F.col(url_col), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")), head, date)
    text.write.options(compression="gzip", **_FAST).option("lineSep", "\n").text(path)
    return path


def _files(spark: SparkSession, path: str) -> DataFrame:
    ready(spark)
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def _http_head(block: bytes, end: int) -> dict[str, str]:
    """Names in lower case; the first of equal names counts."""
    out: dict[str, str] = {}
    for line in block[:end].decode("latin-1").splitlines()[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def _whole_number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch(r"-?\d{1,18}", text) else None


_INDEX = pa.schema(
    [
        ("path", pa.string()), ("offset", pa.int64()), ("id", pa.string()), ("url", pa.string()), ("date", pa.string()),
        ("rank", pa.int64()), ("digest", pa.string()), ("size", pa.int64()), ("second", pa.binary()),
    ]
)
_PARTS = pa.schema(
    [
        ("id", pa.string()), ("type", pa.string()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()),
        ("mime", pa.string()), ("info", pa.string()), ("cut", pa.bool_()), ("digest", pa.string()),
        ("block_digest", pa.string()), ("head_digest", pa.string()), ("head_size", pa.int64()), ("block", pa.large_binary()),
    ]
)
#: bytes of blocks that a batch on its way to Spark holds; a larger block goes alone
BATCH_BYTES = 4 << 20


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, weigh=lambda row: 64) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        if held and size + weigh(row) > BATCH_BYTES:
            yield made()
            held, size = [], 0
        held.append(row)
        size += weigh(row)
    if held:
        yield made()


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {kinds.get(f.type, 'binary')}" for f in schema)


def _each(files: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Buffer]]:
    for batch in files:
        for path, content in zip(batch["path"], batch["content"]):
            yield path.as_py(), content.as_buffer()


def arc_index(spark: SparkSession, path: str, rank_head: str | None = None) -> DataFrame:
    """One row per ARC record that has a payload: path, offset (in the unpacked file), id (of the WARC record), url,
    date, rank (the whole number of the HTTP head line `rank_head`), digest, size and second (another digest) of the payload."""

    def run(files: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for name, content in _each(files):
                for x in read_arc(content):
                    if x.url.startswith("filedesc:"):
                        continue
                    at = x.payload_at()
                    payload = memoryview(x.block)[at:]
                    rank = _http_head(x.block, at).get(rank_head.lower()) if rank_head and x.is_http else None
                    second = hashlib.blake2b(payload, digest_size=8).digest()
                    key = (x.offset, record_id(name, x.offset, x.url, x.date), x.url, iso_time(x.date))
                    yield name, *key, _whole_number(rank), base32_sha1(payload), len(payload), second

        yield from _in_batches(rows(), _INDEX)

    return _files(spark, path).mapInArrow(run, _ddl(_INDEX))


def _revisits(index: DataFrame, min_bytes: int) -> DataFrame:
    """Records that repeat an earlier payload, with the record they repeat. Small rows, combined before the shuffle;
    adaptive execution splits the rows of a payload that very many records share."""
    key = ["digest", "size", "second"]
    order = F.struct(F.col("rank").isNull(), "rank", "date", "url", "path", "offset", "id")
    firsts = index.where(F.col("size") >= min_bytes).groupBy(*key).agg(F.min(order).alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").select(*key, "first.id", "first.url", "first.date")
    firsts = firsts.toDF(*key, "to_id", "to_url", "to_date")
    return index.join(firsts, key).where("id <> to_id").select("id", "to_id", "to_url", "to_date")


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """What a WARC record of each ARC record is made of."""

    def run(files: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for name, content in _each(files):
                info, day = None, "1970-01-01T00:00:00Z"
                for x in read_arc(content):
                    id_, date = record_id(name, x.offset, x.url, x.date), iso_time(x.date, day)
                    ip = None if x.ip in ("0.0.0.0", "-") else x.ip
                    if x.url.startswith("filedesc:"):
                        info, day = id_, date
                        about = f"software: growthlab archive converter\r\nformat: WARC File Format 1.0\r\nfilename: {x.url[11:]}\r\n"
                        about += f"arc-version: {x.more['version']}\r\norigin: {x.more['origin']}\r\n"
                        block = about.encode()
                        digest = base32_sha1(block)
                        yield id_, "warcinfo", None, ip, date, "application/warc-fields", None, x.cut, None, digest, None, 0, block
                        continue
                    at = x.payload_at()
                    kind, mime = ("response", HTTP) if x.is_http else ("resource", x.mime)
                    mime = mime if "/" in mime else "application/octet-stream"
                    digest, whole = base32_sha1(memoryview(x.block)[at:]), base32_sha1(x.block)
                    url = re.sub(r"[\x00-\x20\x7f]", "%20", x.url)
                    yield id_, kind, url, ip, date, mime, info, x.cut, digest, whole, base32_sha1(x.block[:at]), at, x.block

        yield from _in_batches(rows(), _PARTS, lambda row: len(row[-1]) + 512)

    return _files(spark, path).mapInArrow(run, _ddl(_PARTS))


def convert(
    spark: SparkSession, path: str, out: str, rank_head: str | None = None, min_bytes: int = 0, compression: str = "gzip"
) -> None:
    """Write the ARC files under `path` as WARC files (1.0) into the folder `out`.

    A version block becomes a warcinfo record, to which its archive's records refer; an HTTP response a response,
    anything else a resource. Of responses and resources with equal payloads of `min_bytes` and more one stays: that with
    the least whole number in the HTTP head line `rank_head` (none: last), then date, address, archive and offset;
    the others become revisits that keep their HTTP head. Payloads are equal if SHA-1, length and a second digest are.
    A record that the archive cuts short is kept and marked WARC-Truncated; bytes that belong to no record are
    skipped, and so are empty files. Times that are none become the archive's. An archive may have up to 2 GB, a
    record lives in one task as bytes."""
    # written, so that its size is known: where few records are revisits, the blocks need no shuffle
    again = stored(_revisits(arc_index(spark, path, rank_head), min_bytes), "revisits")
    rows = _parts(spark, path).join(again, "id", "left")
    revisit = F.col("to_id").isNotNull()
    crlf = F.lit("\r\n")
    block = F.when(revisit, F.substring("block", F.lit(1), F.col("head_size").cast("int"))).otherwise(F.col("block"))

    def line(name: str, value: Column | str) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), crlf)).otherwise("")

    rows = rows.withColumn("block", block)
    sha = lambda c: F.concat(F.lit("sha1:"), c)
    record = F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise(F.col("type"))),
        line("WARC-Record-ID", "id"),
        line("WARC-Date", "date"),
        line("WARC-Target-URI", "url"),
        line("WARC-IP-Address", "ip"),
        line("WARC-Warcinfo-ID", "info"),
        line("WARC-Payload-Digest", sha(F.col("digest"))),
        line("WARC-Block-Digest", sha(F.when(revisit, F.col("head_digest")).otherwise(F.col("block_digest")))),
        line("WARC-Profile", F.when(revisit, PROFILE)),
        line("WARC-Refers-To", "to_id"),
        line("WARC-Refers-To-Target-URI", "to_url"),
        line("WARC-Refers-To-Date", "to_date"),
        line("WARC-Truncated", F.when(F.col("cut"), "unspecified")),
        line("Content-Type", "mime"),
        line("Content-Length", F.octet_length("block")),
        crlf,
        F.col("block").cast("string"),  # bytes as they are
    )
    # two line ends close a WARC record
    rows.select(record).write.options(compression=compression, **_FAST).option("lineSep", "\r\n\r\n").text(out)
    forget(again)


_WARC = pa.schema(
    [
        ("record_id", pa.string()), ("type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
        ("refers_to", pa.string()), ("declared_digest", pa.string()), ("http", pa.map_(pa.string(), pa.string())),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.large_binary()),
    ]
)


def _warc_records(content: pa.Buffer) -> Iterator[tuple[dict[str, str], bytes]]:
    source = _Source(content)
    while line := source.line():
        if not line.startswith(b"WARC/"):
            continue
        head: dict[str, str] = {}
        while (text := source.line().strip()):
            name, _, value = text.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        yield head, source.take(int(head.get("content-length", 0)))


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the WARC files under `path`: record_id, type, target_uri, date, refers_to, declared_digest (bare, as the
    head says), http (head lines by lower-case name; empty if not HTTP), payload_bytes and payload_digest (of the bytes
    that are there), and the payload itself (NULL unless `payloads`)."""

    def run(files: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for _, content in _each(files):
                for head, block in _warc_records(content):
                    record = Record(0, "", "", "", "", block)
                    is_http = head.get("content-type", "").startswith("application/http")
                    at = record.payload_at() if is_http else 0
                    payload = block[at:]
                    digest = head.get("warc-payload-digest")
                    http = list(_http_head(block, at).items()) if is_http else []
                    names = ("warc-record-id", "warc-type", "warc-target-uri", "warc-date", "warc-refers-to")
                    found = [head.get(n) for n in names]
                    declared = digest.removeprefix("sha1:") if digest else None
                    yield *found, declared, http, len(payload), base32_sha1(payload), payload if payloads else None

        yield from _in_batches(rows(), _WARC, lambda row: 512 + (row[7] if payloads else 0))

    fields = _ddl(_WARC).replace("http binary", "http map<string, string>")
    return _files(spark, path).mapInArrow(run, fields)
