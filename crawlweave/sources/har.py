"""HAR archives: entries are cut out in Python, everything else is native."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from crawlweave.functions import http
from crawlweave.schemas import HAR_ENTRY
from crawlweave.sources import files
from crawlweave.sources.payloads import parsed_once
from crawlweave.sources.warc import FileGroup

CHUNK = 1 << 20
MARK = re.compile(rb'["{}\[\]]')
IN_STRING = re.compile(rb'(?:[^"\\]++|\\.)*+', re.DOTALL)
ENTRIES = b"entries"
SCHEMA = "path string, entry_seq bigint, is_log boolean, raw string"
ARROW_SCHEMA = pa.schema([("path", pa.string()), ("entry_seq", pa.int64()), ("is_log", pa.bool_()), ("raw", pa.string())])


def iter_objects(stream: BinaryIO) -> Iterator[tuple[bool, bytes]]:
    """(is_log, text) of the log object without its entries and of each entry.

    Accepts the log followed by entry objects with nothing between them, and
    the standard nesting ``log.entries``. Only the object being read is held, as
    the pieces of the chunks it lies in; every byte is looked at once. Reading
    stops at the first text that is not a JSON object.
    """
    stack: list[bytes] = []
    log: list[bytes] = []  # the first object, without its entries
    entry: list[bytes] = []
    kept: list[bytes] | None = None  # what the bytes being read belong to
    in_string = escaped = in_entries = False
    first, key = True, b""
    while chunk := stream.read(CHUNK):
        at = start = 0
        if escaped:  # the second byte of an escape
            at, escaped = 1, False
        while at < len(chunk):
            if in_string:
                end = IN_STRING.match(chunk, at).end()
                if len(key) <= len(ENTRIES):
                    key += chunk[at : min(end, at + len(ENTRIES) + 1)]
                if end == len(chunk):
                    break
                escaped = chunk[end : end + 1] == b"\\"  # the last byte of the chunk
                in_string, at = escaped, end + 1
                continue
            found = MARK.search(chunk, at)
            if found is None:
                break
            place, at, mark = found.start(), found.end(), found.group()
            if not stack and (mark != b"{" or chunk[start:place].strip()):
                return
            if mark == b'"':
                in_string, key = True, b""
            elif mark in b"{[":
                stack.append(mark)
                if len(stack) == 1:
                    start, kept = place, log if first else entry
                elif in_entries and len(stack) == 4:
                    start, kept = place, entry
                elif first and not in_entries and key == ENTRIES and stack == [b"{", b"{", b"["]:
                    log.append(chunk[start:at])
                    in_entries, kept = True, None
            else:
                stack.pop()
                if in_entries and len(stack) == 3:
                    entry.append(chunk[start:at])
                    yield False, b"".join(entry)
                    entry, kept = [], None
                elif in_entries and len(stack) == 2:
                    in_entries, start, kept = False, place, log
                elif not stack:
                    kept.append(chunk[start:at])
                    yield first, b"".join(kept)
                    first, log, entry, kept, start = False, [], [], None, at
        if kept is not None:
            kept.append(chunk[start:])
        elif not stack and chunk[start:].strip():
            return


class HarReader(DataSourceReader):
    def __init__(self, path: str, parallelism: int):
        self.path = path
        self.parallelism = parallelism

    def partitions(self) -> Sequence[InputPartition]:
        return [FileGroup(group) for group in files.pack(files.list_files(self.path), self.parallelism)]

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for path, _ in partition.pieces:
            with files.open_stream(path) as stream:
                for seq, (is_log, text) in enumerate(iter_objects(stream)):
                    try:
                        raw = text.decode("utf-8")
                        json.loads(raw)  # only what is JSON up to here is read, which the native parser cannot tell
                    except ValueError:
                        break
                    rows.append((path, seq, is_log, raw))
                    held += len(text)
                    if held >= 8 * CHUNK or len(rows) >= 2000:
                        yield self._batch(rows)
                        rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(values, type=field.type) for values, field in zip(zip(*rows), ARROW_SCHEMA)]
        return pa.RecordBatch.from_arrays(columns, schema=ARROW_SCHEMA)


class HarSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "har"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return HarReader(self.options["path"], int(self.options.get("parallelism", 1)))


def har_objects(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(HarSource)
    return spark.read.format("har").option("parallelism", spark.sparkContext.defaultParallelism).load(path)


def read_har(spark: SparkSession, path: str) -> DataFrame:
    """Entries of all HAR files below ``path``."""
    raw = har_objects(spark, path).filter(~F.col("is_log"))
    parsed = parsed_once(raw, F.from_json("raw", HAR_ENTRY))
    return parsed.select("path", F.col("entry_seq").alias("record_seq"), *entry_columns(F.col("e")))


def entry_columns(e) -> list:
    request, response = e["request"], e["response"]
    content = response["content"]
    empty = F.lit("")
    return [
        F.coalesce(request["url"], empty).alias("url"),
        F.coalesce(request["method"], F.lit("GET")).alias("method"),
        F.coalesce(response["status"].try_cast("int"), F.lit(0)).alias("status_code"),
        F.coalesce(response["statusText"], empty).alias("status_text"),
        http.named_values_map(request["headers"]).alias("request_headers"),
        http.named_values_map(response["headers"]).alias("headers"),
        http.body_bytes(content["text"], content["encoding"]).alias("content"),
        F.coalesce(content["mimeType"], empty).alias("content_type"),
        F.coalesce(content["size"], F.lit(0)).alias("content_size"),
        F.coalesce(e["startedDateTime"], empty).alias("started"),
        F.coalesce(e["time"], F.lit(0.0)).alias("time"),
        F.coalesce(e["timings"], F.create_map().cast("map<string,double>")).alias("timings"),
    ]


def read_har_logs(spark: SparkSession, path: str) -> DataFrame:
    """Version, creator and page list of each HAR file."""
    raw = har_objects(spark, path).filter("is_log")
    log = F.from_json("raw", "log struct<version:string, creator:struct<name:string, version:string>, pages:array<variant>>")
    return raw.withColumn("l", log["log"]).select(
        "path",
        F.coalesce("l.version", F.lit("")).alias("version"),
        F.col("l.creator").alias("creator"),
        F.coalesce(F.array_size("l.pages"), F.lit(0)).alias("page_count"),
    )


def artifact_pages(warc: DataFrame | None = None, har: DataFrame | None = None) -> DataFrame:
    """The page shape shared by WARC responses and HAR entries."""
    from crawlweave.operators.filters import responses

    shape = ["path", "record_seq", "url", "status_code", "headers", "content"]
    parts = []
    if warc is not None:
        parts.append(responses(warc).select(*shape))
    if har is not None:
        parts.append(har.select(*shape))
    if not parts:
        raise ValueError("give a warc or a har DataFrame")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
