"""File listing and opening for the Python readers, on any filesystem Arrow knows."""

from __future__ import annotations

import glob
import gzip
import io
from collections.abc import Iterator
from typing import BinaryIO

from pyarrow import fs

PACK_BYTES = 128 * 1024 * 1024
OPEN_COST = 4 * 1024 * 1024


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def list_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the files below a folder, of one file, or of a local glob."""
    filesystem, local = resolve(path)
    if any(c in local for c in "*?[") and isinstance(filesystem, fs.LocalFileSystem):
        infos = filesystem.get_file_info(sorted(glob.glob(local)))
    else:
        info = filesystem.get_file_info(local)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        infos = [info] if info.type == fs.FileType.File else filesystem.get_file_info(fs.FileSelector(local, recursive=True))
    prefix = path[: -len(local)] if path.endswith(local) else ""
    found = [(prefix + i.path, i.size) for i in infos if i.type == fs.FileType.File]
    return sorted((p, s) for p, s in found if not p.rsplit("/", 1)[-1].startswith(("_", ".")))


def pack(pieces: list[tuple], parallelism: int = 1) -> Iterator[list[tuple]]:
    """Small pieces share a task, a large one has its own; sized like Spark's own file splits.

    The last item of a piece is its size in bytes.
    """
    total = sum(piece[-1] + OPEN_COST for piece in pieces)
    target = min(PACK_BYTES, max(OPEN_COST, total // max(parallelism, 1)))
    group: list[tuple] = []
    held = 0
    for piece in pieces:
        cost = piece[-1] + OPEN_COST
        if group and held + cost > target:
            yield group
            group, held = [], 0
        group.append(piece)
        held += cost
    if group:
        yield group


def open_file(path: str) -> BinaryIO:
    """Buffered file that can seek."""
    filesystem, local = resolve(path)
    return io.BufferedReader(Readable(filesystem.open_input_file(local)), 1 << 18)


def open_stream(path: str) -> BinaryIO:
    """Buffered stream; gzip is recognised by its magic, all members are read."""
    filesystem, local = resolve(path)
    raw = io.BufferedReader(Readable(filesystem.open_input_stream(local, compression=None)), 1 << 20)
    if raw.peek(2)[:2] == b"\x1f\x8b":
        return io.BufferedReader(gzip.GzipFile(fileobj=raw, mode="rb"), 1 << 20)
    return raw


class Readable(io.RawIOBase):
    """Arrow file or stream as a raw Python stream."""

    def __init__(self, source):
        self._source = source

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return self._source.seekable()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self._source.seek(offset, whence)
        return self._source.tell()

    def tell(self) -> int:
        return self._source.tell()

    def readinto(self, buffer) -> int:
        data = self._source.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)
