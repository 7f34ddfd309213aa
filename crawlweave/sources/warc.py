"""WARC archives as a Spark data source.

A task streams byte ranges of archives, small ones packed together. It holds one
record at a time, and rows leave it as Arrow batches of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import parquet
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from crawlweave.schemas import WARC_RECORD
from crawlweave.session import fresh_dir
from crawlweave.sources import files, warc_splits, warc_stream

KEPT_TYPES = ("response", "request", "metadata", "warcinfo")
BATCH_BYTES = 8 * 1024 * 1024
BATCH_ROWS = 2000
MAPS = pa.map_(pa.string(), pa.string())
ARROW_SCHEMA = pa.schema(
    [
        ("path", pa.string()),
        ("record_seq", pa.int64()),
        ("record_type", pa.string()),
        ("url", pa.string()),
        ("headers", MAPS),
        ("content", pa.binary()),
        ("status_code", pa.int32()),
        ("warc_headers", MAPS),
        ("reject", pa.string()),
    ]
)
SOURCE_SCHEMA = StructType([*WARC_RECORD.fields, StructField("reject", StringType())])


class FileGroup(InputPartition):
    def __init__(self, pieces: list[tuple]):
        self.pieces = pieces


class WarcReader(DataSourceReader):
    def __init__(self, pieces: str, types: frozenset[str], parallelism: int):
        self.pieces = pieces
        self.types = types
        self.parallelism = parallelism
        self.urls: frozenset[str] | None = None

    def partitions(self) -> Sequence[InputPartition]:
        """Packs of the settled pieces, one row for each range, as a file scan lists its splits."""
        filesystem, local = files.resolve(self.pieces)
        rows = parquet.read_table(local, filesystem=filesystem, columns=["path", "size", "begin", "stop"]).to_pylist()
        pieces = sorted((r["path"], r["begin"], r["stop"], r["size"], r["stop"] - r["begin"]) for r in rows)
        return [FileGroup(group) for group in files.pack(pieces, self.parallelism)]

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for path, begin, stop, size, _ in partition.pieces:
            with files.open_file(path) as stream:
                for found in warc_stream.records(warc_stream.source_of(stream, size), begin, stop, self.types, self.urls):
                    if isinstance(found, warc_stream.Reject):
                        rows.append((path, found.seq, None, None, None, None, None, None, found.reason))
                    else:
                        seq, kind, url, headers, content, status, named = found
                        rows.append((path, seq, kind, url, list(headers.items()), content, status, list(named.items()), None))
                        held += len(content)
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield self._batch(rows)
                        rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(values, type=field.type) for values, field in zip(zip(*rows), ARROW_SCHEMA)]
        return pa.RecordBatch.from_arrays(columns, schema=ARROW_SCHEMA)


class FilteringWarcReader(WarcReader):
    """Reader for sessions with filter pushdown into Python sources; others refuse a reader that has it."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Note what allows to skip bodies; Spark still applies every filter."""
        for item in filters:
            if isinstance(item, (EqualTo, In)) and len(item.attribute) == 1:
                values = frozenset(item.value if isinstance(item, In) else [item.value])
                if item.attribute[0] == "record_type":
                    self.types = self.types & values
                elif item.attribute[0] == "url":
                    self.urls = values if self.urls is None else self.urls & values
            yield item


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> StructType:
        return SOURCE_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        pushdown = self.options.get("pushdown", "false") == "true"
        reader = FilteringWarcReader if pushdown else WarcReader
        kept = frozenset(filter(None, self.options["recordTypes"].split(",")))
        return reader(self.options["path"], kept, int(self.options.get("parallelism", 1)))


def _load(spark: SparkSession, path: str, types: Sequence[str], range_bytes: int) -> DataFrame:
    spark.dataSource.register(WarcSource)
    settled = fresh_dir(spark, "warc-pieces")
    warc_splits.pieces(spark, files.list_files(path), range_bytes).write.parquet(settled)
    reader = (
        spark.read.format("warc")
        .option("parallelism", spark.sparkContext.defaultParallelism)
        .option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
        .option("recordTypes", ",".join(types))
    )
    return reader.load(settled)


def read_warc(
    spark: SparkSession, path: str, record_types: Sequence[str] | None = None, range_bytes: int = warc_splits.RANGE_BYTES
) -> DataFrame:
    """Records of all archives below ``path``, gzipped or plain.

    Other record types than response, request, metadata and warcinfo are only
    read when asked for by name. Archives above ``range_bytes`` are read by
    several tasks, gzipped ones where a member begins with a record.
    ``record_seq`` grows in file order. Reading goes on after damage, see
    ``rejected_warc_records``.
    """
    return _load(spark, path, record_types or KEPT_TYPES, range_bytes).filter(F.col("reject").isNull()).drop("reject")


def rejected_warc_records(spark: SparkSession, path: str, range_bytes: int = warc_splits.RANGE_BYTES) -> DataFrame:
    """(path, record_seq, reason) of the places where no whole record could be read and reading went on behind them."""
    rejected = _load(spark, path, (), range_bytes).filter(F.col("reject").isNotNull())
    return rejected.select("path", "record_seq", F.col("reject").alias("reason"))
