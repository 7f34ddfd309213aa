"""Writing WARC archives from a table, and reading archives that may be damaged.

Archives are gzip files with one member for each record, or plain files. The reader checks every record: the member's
checksum, the version line, the length, the line breaks behind the block and the payload digest. Where a check fails it
searches for the next member or version line whose record passes, goes on from there, and reports the bytes between as
a gap. In a gzip file that search goes on inside the member, and of a broken member over what could be unpacked. A file
is one task's work, read in pieces, so an archive takes as much memory as its largest record; a member of more than
SPOOL bytes unpacked waits in a temporary file of the task.
"""

from __future__ import annotations

import base64
import hashlib
import re
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crawlweave.llm.shared import written
from crawlweave.session import fresh_dir
from crawlweave.sources.files import resolve

PIECE = 1 << 20
PACKED_PIECE = 1 << 16
SPOOL = 8 << 20
LAST = b"\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MEMBER = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
_HEAD_END = re.compile(rb"\r?\n\r?\n")
RECORD = (
    "path string, begin long, finish long, reason string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row_id: int | None, uri: str | None, payload: bytes, first: int | None, date: str) -> bytes:
    """A response record, or a revisit of ``first`` that holds the HTTP head but no payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    again = first is not None
    block = head if again else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if again else 'response'}",
        f"WARC-Record-ID: <urn:x-row:{'' if row_id is None else row_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_one_line(uri)}")
    if again:
        lines += [f"WARC-Refers-To: <urn:x-row:{first}>", f"WARC-Profile: {REVISIT}"]
    return "\r\n".join(lines).encode() + LAST + block + LAST


def write_archives(
    df: DataFrame,
    key: str = "page_id",
    uri: str = "url",
    body: str = "html",
    least_bytes: int = 0,
    file_bytes: int = 64 << 20,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record for each row; returns the list of files (``path``, ``records``).

    The payload is the body in UTF-8, nothing for null. Of rows with equal payloads of at least ``least_bytes`` bytes,
    the one with the smallest key is a response and the others revisit it; the rest, and rows without a key, are
    responses. Only the files in the list count: a task that runs again writes files of other names. A new file is
    begun after ``file_bytes``.
    """
    spark = df.sparkSession
    folder = fresh_dir(spark, "archives")
    filesystem, local = resolve(folder)
    filesystem.create_dir(local, recursive=True)
    rows = df.select(
        F.col(key).cast("long").alias("_key"), F.col(uri).alias("_uri"), F.coalesce(F.col(body).cast("binary"), F.lit(b"")).alias("_body")
    ).withColumn("_digest", F.sha1("_body"))
    # keys alone are compared by digest, as a third of all bodies may be equal; bodies travel by their key
    keys = written(rows.where((F.octet_length("_body") >= least_bytes) & F.col("_key").isNotNull()).select("_key", "_digest"), "archive-keys")
    firsts = keys.groupBy("_digest").agg(F.min("_key").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    again = keys.join(firsts, "_digest").where("_key <> _first").distinct()
    marked = rows.join(again, ["_key", "_digest"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, local = resolve(folder)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        done: list[tuple[str, int]] = []
        out = None
        for batch in batches:
            columns = (batch.column(c) for c in ("_key", "_uri", "_body", "_first"))
            for row_id, address, payload, first in zip(*columns):
                if out is None:
                    name = f"part-{part:06d}-{attempt}-{len(done):04d}.warc.gz"
                    out, size, count = filesystem.open_output_stream(f"{local}/{name}", compression=None), 0, 0
                pack = zlib.compressobj(4, zlib.DEFLATED, 31)
                record = record_bytes(row_id.as_py(), address.as_py(), payload.as_py(), first.as_py(), date)
                member = pack.compress(record) + pack.flush()
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", count))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", count))
        if done:
            yield pa.RecordBatch.from_pydict({"path": [d[0] for d in done], "records": [d[1] for d in done]})

    return written(marked.select("_key", "_uri", "_body", "_first").mapInArrow(run, "path string, records long"), "archive-list")


class _File:
    """Random access to a file through a window of bytes."""

    def __init__(self, source: pa.NativeFile | BinaryIO, size: int):
        self.source, self.size = source, size
        self.begin, self.held = 0, b""

    def read(self, at: int, n: int) -> bytes:
        """Up to n bytes from a position."""
        if not (self.begin <= at and at + n <= self.begin + len(self.held)):
            self.source.seek(at)
            self.begin, self.held = at, self.source.read(max(n, min(PIECE, self.size - at)))
        return self.held[at - self.begin : at - self.begin + n]

    def find(self, pattern: re.Pattern[bytes], at: int) -> int:
        """Next position of a pattern of at most 16 bytes, or the end of the file."""
        while at < self.size:
            piece = self.read(at, min(PIECE, self.size - at))
            if found := pattern.search(piece):
                return at + found.start()
            at += max(1, len(piece) - 16)
            if len(piece) <= 16:
                break
        return self.size


class Damage(Exception):
    """A record that does not pass."""


def _fields(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").splitlines()[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def parse_record(data: bytes, whole: bool) -> tuple[dict[str, str], bytes, int]:
    """(header fields, block, length) of the record that data begins with; ``whole`` asks for all of data to be it."""
    if not _VERSION.match(data):
        raise Damage("no version line")
    end = _HEAD_END.search(data)
    if not end:
        raise Damage("head without end")
    fields = _fields(data[: end.start()])
    try:
        length = int(fields["content-length"])
    except (KeyError, ValueError):
        raise Damage("no content length") from None
    stop = end.end() + length
    if length < 0 or stop + len(LAST) > len(data):
        raise Damage("cut off")
    if data[stop : stop + len(LAST)] != LAST or whole and len(data) != stop + len(LAST):
        raise Damage("wrong length")
    return fields, data[end.end() : stop], stop + len(LAST)


def _row(path: str, begin: int, finish: int, fields: dict[str, str], block: bytes) -> dict:
    kind = fields.get("warc-type", "")
    payload, size = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        end = _HEAD_END.search(block)
        payload = block[end.end() :] if end else b""
        size = len(payload)
        if kind == "revisit" and end:
            stated = _fields(block[: end.start()]).get("content-length", "")
            size = int(stated) if stated.isdigit() else size
    stated = fields.get("warc-payload-digest", "")
    if kind != "revisit":
        actual = digest_of(payload)
        if stated.startswith("sha1:") and stated[5:].upper() != actual:
            raise Damage("payload digest differs")
        stated = f"sha1:{actual}"
    return {
        "path": path, "begin": begin, "finish": finish, "reason": None, "record_type": kind,
        "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"), "payload_digest": stated.removeprefix("sha1:") or None,
        "payload_bytes": size, "payload": payload,
    }


def _before_break(unpack: zlib._Decompress, piece: bytes) -> tuple[list[bytes], int]:
    """What the bytes of a piece give before the one that breaks the stream, and its place, found by halving."""
    found, low, high = [], 0, len(piece)
    while high - low > 1:
        trial, middle = unpack.copy(), (low + high) // 2
        try:
            part = trial.decompress(piece[low:middle])
        except zlib.error:
            high = middle
        else:
            found.append(part)
            unpack, low = trial, middle
    return found, low


def _member(file: _File, at: int, out: BinaryIO) -> tuple[int, str | None]:
    """Unpack the gzip member at a position into ``out``: (end, damage); what comes before the damage is in ``out``.

    The first piece is short, so that what only looks like a member costs little.
    """
    unpack = zlib.decompressobj(31)
    begin, size = at, 1024
    while not unpack.eof:
        piece = file.read(at, min(size, file.size - at))
        size = min(PACKED_PIECE, 8 * size)
        if not piece:
            return at, "member cut off"
        before = unpack.copy() if at > begin else zlib.decompressobj(31)
        try:
            found = unpack.decompress(piece, PIECE)
        except zlib.error as error:
            parts, good = _before_break(before, piece)
            for part in parts:
                out.write(part)
            return at + good, f"member broken: {error}"
        out.write(found)
        at += len(piece) - len(unpack.unused_data) - len(unpack.unconsumed_tail)
    return at, None


def _plain(file: _File, at: int) -> tuple[dict[str, str], bytes, int]:
    """The record at a position of a plain file."""
    n = 4096
    while True:
        data = file.read(at, min(n, file.size - at))
        end = _HEAD_END.search(data)
        if end or len(data) < n:
            break
        n *= 4
    if not _VERSION.match(data) or not end:
        raise Damage("no version line" if end else "head without end")
    length = _fields(data[: end.start()]).get("content-length", "")
    if not length.isdigit():
        raise Damage("no content length")
    need = end.end() + int(length) + len(LAST)
    if at + need > file.size:
        raise Damage("cut off")
    if need > PIECE and file.read(at + need - len(LAST), len(LAST)) != LAST:
        raise Damage("wrong length")  # before so much is read
    fields, block, n = parse_record(file.read(at, need), False)
    if not {"warc-type", "warc-record-id"} <= fields.keys():
        raise Damage("no type or record id")
    return fields, block, at + n


def _inner(file: _File, at: int) -> int:
    """Where a whole record begins inside the head that begins here; else this place.

    After damage, the rest of a broken head may run into the head of the next record.
    """
    head = file.read(at, min(4096, file.size - at))
    end = _HEAD_END.search(head)
    for found in _VERSION.finditer(head, 1, end.start() if end else len(head)):
        try:
            fields, _, _ = _plain(file, at + found.start())
        except Damage:
            continue
        if {"warc-type", "warc-record-id"} <= fields.keys():
            return at + found.start()
    return at


def salvage(path: str, source: pa.NativeFile) -> Iterator[dict]:
    """Rows of RECORD for the records of a file, and with a ``reason`` for the gaps between them."""
    file = _File(source, source.size())
    packed = file.read(0, 3) == _MEMBER or file.find(re.compile(re.escape(_MEMBER)), 0) < file.find(_VERSION, 0)
    yield from _salvage_packed(path, file) if packed else _salvage_plain(path, file)


def _salvage_plain(path: str, file: _File) -> Iterator[dict]:
    at, lost, why = 0, None, ""
    while at < file.size:
        try:
            if lost is not None:
                at = _inner(file, at)
            fields, block, stop = _plain(file, at)
            row = _row(path, at, stop, fields, block)
        except Damage as error:
            if lost is None:
                lost, why = at, str(error)
            at = file.find(_VERSION, at + 1)
            continue
        if lost is not None:
            yield _gap(path, lost, at, why)
            lost = None
        yield row
        at = stop
    if lost is not None:
        yield _gap(path, lost, file.size, why)


def _salvage_packed(path: str, file: _File) -> Iterator[dict]:
    mark = re.compile(re.escape(_MEMBER))
    at, lost, why = 0, None, ""
    while at < file.size:
        with tempfile.SpooledTemporaryFile(SPOOL) as content:
            stop, damage = _member(file, at, content)
            for row in _salvage_plain(path, _File(content, content.tell())):
                if row["reason"]:
                    if lost is None:
                        lost, why = at, row["reason"]
                    continue
                if lost is not None:
                    yield _gap(path, lost, at if lost < at else stop, why)
                    lost = None
                yield row | {"begin": at, "finish": stop}
        if damage and (lost is None or lost == at):
            lost, why = at, damage
        at = file.find(mark, at + 1) if damage else stop
    if lost is not None:
        yield _gap(path, lost, file.size, why)


def _gap(path: str, begin: int, finish: int, why: str) -> dict:
    return {"path": path, "begin": begin, "finish": finish, "reason": why}


def read_archives(files: DataFrame, payload: bool = True, rows_at_once: int = 64) -> DataFrame:
    """Records and gaps of the archives whose paths are in ``files.path``; columns as in RECORD.

    Gaps have a ``reason`` and only ``path``, ``begin`` and ``finish`` beside it. Positions of a record of a gzip file
    are those of its member, also of a gap between two records of one member. ``payload_digest`` is computed from the payload, for a revisit taken from its head, as is
    its ``payload_bytes``. With ``payload`` false the payload is checked but not returned. A file that is empty has no
    rows; one that cannot be opened fails the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                filesystem, local = resolve(path)
                with filesystem.open_input_file(local) as source:
                    held: list[dict] = []
                    size = 0
                    for row in salvage(path, source):
                        if not payload:
                            row["payload"] = None
                        held.append(row)
                        size += len(row.get("payload") or b"")
                        if len(held) >= rows_at_once * (1 if payload else 64) or size >= 8 << 20:
                            yield _batch(held)
                            held, size = [], 0
                    if held:
                        yield _batch(held)

    paths = files.select("path")
    # a number of its own for the tasks: the list is short, and would be read by one task by its size
    return paths.repartition(max(1, paths.count()), "path").mapInArrow(run, RECORD)


_ARROW = {"begin": pa.int64(), "finish": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
_NAMES = [c.split(" ")[0] for c in RECORD.split(", ")]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(c) for r in rows], _ARROW.get(c, pa.string())) for c in _NAMES], names=_NAMES
    )


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the archives below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length").where(F.col("path").rlike(r"\.warc(\.gz)?$"))


def row_id(urn: str) -> Column:
    """The key that :func:`write_archives` put into a record's id."""
    return F.nullif(F.regexp_extract(urn, "urn:x-row:([0-9-]*)", 1), F.lit("")).cast("long")
