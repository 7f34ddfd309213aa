"""Records of one archive as a stream, plain or gzipped, going on after damage.

Records are framed by Content-Length, so a body may hold anything. Where no
record starts, or a gzip member is broken, the bytes up to the next record are
passed over and told as rejected.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Generator
from typing import BinaryIO, NamedTuple

CHUNK = 1 << 18
VERSION = re.compile(rb"WARC/\d")
CANDIDATE = re.compile(rb"(?:^|(?<=\n))WARC/\d")
MEMBER = re.compile(rb"\x1f\x8b\x08[\x00-\x1f]")
STATUS_LINE = re.compile(rb"HTTP/\d(?:\.\d)? (\d+)")
MEMBER_SHIFT = 20
LINE = 1 << 20  # a longer line comes in pieces


class Record(NamedTuple):
    seq: int
    kind: str
    url: str
    headers: dict[str, str]
    content: bytes
    status: int | None
    named: dict[str, str]


class Reject(NamedTuple):
    seq: int
    reason: str


class Damage(Exception):
    """What is here is not a record."""


def header_lines(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if colon:
            out[name.decode("utf-8", "replace").strip()] = value.decode("utf-8", "replace").strip()
    return out


def split_http(block: bytes) -> tuple[int | None, dict[str, str], bytes]:
    """Status, headers and body of a response block."""
    head, blank, body = block.partition(b"\r\n\r\n")
    if not blank:
        head, _, body = block.partition(b"\n\n")
    lines = head.split(b"\r\n" if b"\r\n" in head else b"\n")
    status = STATUS_LINE.match(lines[0])
    return int(status.group(1)) if status else None, header_lines(lines[1:]), body


def head_of(stream) -> dict[str, str] | None:
    """Headers of the record that starts here, None at the end; raises Damage where none starts."""
    line = stream.readline()
    while line and not line.strip(b"\r\n"):
        line = stream.readline()
    if not line:
        return None
    if not VERSION.match(line):
        raise Damage("no version line")
    lines = []
    while line := stream.readline().rstrip(b"\r\n"):
        lines.append(line)
    named = header_lines(lines)
    if not named:
        raise Damage("no headers")
    if not named.get("Content-Length", "0").isdecimal():
        raise Damage("bad length")
    return named


class Plain:
    """An uncompressed archive; any position may start a record, ``seq`` is the position."""

    def __init__(self, stream: BinaryIO, size: int):
        self.stream, self.size, self.start = stream, size, 0

    def go(self, position: int) -> None:
        self.stream.seek(position)

    def tell(self) -> int:
        return self.start

    def place(self) -> tuple[int | None, int]:
        """(where a piece may begin that starts with the next record, or None; number of the record in file order)."""
        self.start = self.stream.tell()
        return self.start, self.start

    def readline(self) -> bytes:
        return self.stream.readline(LINE)

    def read(self, length: int) -> bytes:
        return self.stream.read(length)

    def skip(self, length: int) -> None:
        self.stream.seek(min(self.stream.tell() + length, self.size))

    def end_record(self) -> None:
        """Pass the two line ends after a block; anything else belongs to what follows."""
        for _ in range(2):
            at = self.stream.tell()
            if self.stream.readline().strip(b"\r\n"):
                self.stream.seek(at)
                return

    def resume(self) -> bool:
        """Go to the next place after a bad one where a record starts."""
        found = self._next(self.start + 1, self.size)
        self.go(self.size if found is None else found)
        return found is not None

    def guess(self, begin: int, stop: int) -> int | None:
        return self._next(begin, stop)

    def _next(self, begin: int, stop: int) -> int | None:
        """First position from ``begin`` and before ``stop`` with a version line, a type and a length."""
        position = begin
        while position < stop:
            self.stream.seek(max(position - 1, 0))
            piece = self.stream.read(CHUNK + 8)
            for hit in CANDIDATE.finditer(piece, min(position, 1)):
                at = max(position - 1, 0) + hit.start()
                if at >= stop:
                    return None
                if hit.start() > CHUNK:
                    break
                self.stream.seek(at)
                try:
                    if "WARC-Type" in (head_of(self.stream) or ()):
                        return at
                except Damage:
                    pass
            position = max(position - 1, 0) + CHUNK + 1
        return None


class Gzipped(Plain):
    """A gzipped archive, read through member after member.

    Only the start of a member can start a piece. ``seq`` is the member's
    position shifted left, plus the number of records that began in it before.
    """

    def __init__(self, stream: BinaryIO, size: int):
        super().__init__(stream, size)
        self.go(0)

    def go(self, position: int) -> None:
        self.member = self.position = position  # of the member being read, of its compressed bytes to come
        self.engine, self.broken = None, False
        self.buffer, self.at, self.count, self.untouched = b"", 0, 0, True

    def tell(self) -> int:
        return (self.member << MEMBER_SHIFT) + self.count

    def place(self) -> tuple[int | None, int]:
        self._fill()
        seq = self.tell()
        self.count += 1
        return self.member if self.untouched else None, seq

    def _fill(self) -> bool:
        """Have a byte to give; False at the end of the file."""
        while self.at >= len(self.buffer):
            if self.broken:
                raise Damage("broken member")
            if self.engine is None:
                self.member, self.count, self.untouched = self.position, 0, True
                if self.position >= self.size:
                    return False
                self.engine = zlib.decompressobj(31)
            self.stream.seek(self.position)
            piece = self.stream.read(CHUNK)
            try:
                self.buffer, self.at = self.engine.decompress(piece, 4 * CHUNK), 0
                self.broken = not piece
            except zlib.error:
                self.broken = True
            left = self.engine.unused_data if self.engine.eof else self.engine.unconsumed_tail
            self.position += len(piece) - len(left)
            if self.engine.eof:
                self.engine = None
        return True

    def _take(self, end: int) -> bytes:
        taken = self.buffer[self.at : end]
        self.at, self.untouched = min(end, len(self.buffer)), self.untouched and not taken
        return taken

    def readline(self) -> bytes:
        parts, length = [], 0
        while length < LINE and self._fill():
            end = self.buffer.find(b"\n", self.at) + 1
            parts.append(self._take(end or len(self.buffer)))
            length += len(parts[-1])
            if end:
                break
        return b"".join(parts)

    def read(self, length: int) -> bytes:
        parts = []
        while length > 0 and self._fill():
            parts.append(self._take(self.at + length))
            length -= len(parts[-1])
        return b"".join(parts)

    def skip(self, length: int) -> None:
        while length > 0 and self._fill():
            length -= len(self._take(self.at + length))

    def end_record(self) -> None:
        for _ in range(2):
            for mark in (b"\r", b"\n"):
                if self._fill() and not self.untouched and self.buffer[self.at : self.at + 1] == mark:
                    self._take(self.at + 1)

    def resume(self) -> bool:
        """Go on inside the member where it still can be read, else to the next member that begins with a record."""
        try:
            while self._fill():
                first = self.untouched
                line = self.readline()
                if VERSION.match(line):
                    self.buffer, self.at, self.untouched = line + self.buffer[self.at :], 0, first
                    return True
            return False
        except Damage:
            found = self._next(self.member + 1, self.size)
            self.go(self.size if found is None else found)
            return found is not None

    def _next(self, begin: int, stop: int) -> int | None:
        """First member from ``begin`` and before ``stop`` whose first bytes are a version line; few bytes of each mark are unpacked."""
        position = begin
        while position < stop:
            self.stream.seek(position)
            piece = self.stream.read(CHUNK + 512)
            for hit in MEMBER.finditer(piece):
                at = position + hit.start()
                if at >= stop:
                    return None
                if hit.start() >= CHUNK:
                    break
                try:
                    if VERSION.match(zlib.decompressobj(31).decompress(piece[hit.start() : hit.start() + 512], 16)):
                        return at
                except zlib.error:
                    pass
            position += CHUNK
        return None


def source_of(stream: BinaryIO, size: int) -> Plain:
    stream.seek(0)
    return (Gzipped if stream.read(2) == b"\x1f\x8b" else Plain)(stream, size)


def records(
    source: Plain, begin: int, stop: int, types: frozenset[str], urls: frozenset[str] | None = None
) -> Generator[Record | Reject, None, int]:
    """Records that start from ``begin`` and before ``stop``, in file order, of the wanted types and URLs, and what was passed
    over, one row for each gap. Bodies of others are skipped. A record cut off by the end of a plain file is short.

    Returns where the first record of a later piece starts, the file's size when there is none.
    """
    source.go(begin)
    in_gap = False
    while True:
        seq = None
        try:
            offset, seq = source.place()
            if offset is not None and offset >= stop:
                return offset
            named = head_of(source)
            if named is None:
                return source.size
            in_gap = False
            kind, url = named.get("WARC-Type", ""), named.get("WARC-Target-URI", "")
            length = int(named.get("Content-Length", 0))
            if kind in types and (urls is None or url in urls):
                block = source.read(length)
                if kind == "response":
                    status, headers, body = split_http(block)
                    yield Record(seq, kind, url, headers, body, status, named)
                else:
                    yield Record(seq, kind, url, {}, block, None, named)
            else:
                source.skip(length)
            source.end_record()
        except Damage as damage:
            if not in_gap:
                yield Reject(source.tell() if seq is None else seq, str(damage))
            in_gap = True
            if not source.resume():
                return source.size


def follow(source: Plain, first: int, stop: int) -> int:
    """Where the first record starts that belongs to a later piece."""
    reading = records(source, first, stop, frozenset())
    while True:
        try:
            next(reading)
        except StopIteration as end:
            return end.value
