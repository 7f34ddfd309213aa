"""Small helpers that several operators of this package use."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession

from crawlweave.session import fresh_dir

#: white space between words: blank, and tab to carriage return
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_U64 = np.uint64
_MIX1, _MIX2, _STEP = _U64(0xBF58476D1CE4E5B9), _U64(0x94D049BB133111EB), _U64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder; cuts lineage so that a lost executor costs one task."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused_prefix(df: DataFrame) -> str:
    """A prefix that no column of ``df`` has, for columns of an operator's own beside those of its input."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_share(order: Column, part: Column) -> Column:
    """Whether a 64-bit hash lies in the lowest ``part`` of all values: a bounded sample without a sort of everything."""
    return order <= part * float(1 << 64) - float(1 << 63)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = (x ^ (x >> _U64(30))) * _MIX1
    x = (x ^ (x >> _U64(27))) * _MIX2
    return x ^ (x >> _U64(31))


def _random_bytes() -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=_U64) * _STEP)
    table[65:91] = table[97:123]  # A-Z count as a-z
    return table


_BYTE = _random_bytes()
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, _U64)
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


_FORWARD = _powers(1 << 16, _BASE)
_BACKWARD = _powers(1 << 16, pow(_BASE, -1, 1 << 64))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n+1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the words; ``first[i]`` is the number of words before row i, with the total at the end."""
    solid = ~_IS_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = solid[:-1]
        start = np.flatnonzero(solid & (~before | cut[:-1]))
        after = np.empty(len(data), bool)
        after[-1] = False
        after[:-1] = solid[1:]
        end = np.flatnonzero(solid & (~after | cut[1:])) + 1
    else:
        start = end = np.zeros(0, np.int64)
    return start, end, np.searchsorted(start, at)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 1 << 14) -> np.ndarray:
    """64-bit hash of each word, A-Z taken as a-z.

    Sums of byte values times powers of an odd number, taken from running sums; long inputs go block by block, so
    the powers stay a small table. A word longer than the rest of its block ends in a later one, whose part is added.
    """
    out = np.zeros(len(start), _U64)
    width = len(_FORWARD)
    if not len(start):
        return out
    longest = int((end - start).max())
    if longest > width - block:  # a very long word: its own loop over pieces
        huge = np.flatnonzero(end - start > width - block)
        for k in huge:
            total = _U64(0)
            for a in range(int(start[k]), int(end[k]), width):
                part = data[a : min(a + width, int(end[k]))]
                total = mix(np.array([total + np.sum(_BYTE[part] * _FORWARD[: len(part)], dtype=_U64)], _U64))[0] + _STEP
            out[k] = total
        small = np.flatnonzero(end - start <= width - block)
        out[small] = word_hashes(data, start[small], end[small], block)
        return out
    first = 0
    while first < len(start):
        a = int(start[first])
        last = int(np.searchsorted(start, a + block, "left"))
        b = int(end[last - 1])
        sums = np.zeros(b - a + 1, _U64)
        np.cumsum(_BYTE[data[a:b]] * _FORWARD[: b - a], out=sums[1:])
        s, e = start[first:last] - a, end[first:last] - a
        out[first:last] = (sums[e] - sums[s]) * _BACKWARD[s]
        first = last
    return mix(out + (end - start).astype(_U64) * _STEP)


def batches(rows: Iterator[pa.RecordBatch], column: str, limit: int = 16 << 20) -> Iterator[pa.Table]:
    """Incoming batches cut or joined so that the texts of one table take about ``limit`` bytes; a longer text is alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in rows:
        lengths = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0), np.int64)
        begin = 0
        while begin < len(lengths):
            upto = np.cumsum(lengths[begin:]) + size
            n = max(int(np.searchsorted(upto, limit, "right")), 0 if held else 1)
            if n:
                held.append(batch.slice(begin, n))
                size = int(upto[n - 1])
                begin += n
            if begin < len(lengths) or size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
