"""Byte ranges of archives, so that several tasks can share one file.

A range begins at the first record that starts in it. Which one that is can only
be guessed from the bytes, since a body may hold anything that looks like a
record. So a Spark job looks at every range (the guess, and where the records
from there lead to), each range is compared with where the ranges before it
lead, and those that guessed wrong are looked at again. The result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from crawlweave.session import written
from crawlweave.sources import files, warc_stream

RANGE_BYTES = 128 * 1024 * 1024
LOOKED = "path string, size bigint, begin bigint, stop bigint, first bigint, next bigint"


def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fill in ``next``, where the records from ``first`` lead to beyond the range, and ``first`` where it is null."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            with files.open_file(row["path"]) as stream:
                source = warc_stream.source_of(stream, row["size"])
                first = row["first"]
                if first is None:
                    first = 0 if row["begin"] == 0 else source.guess(row["begin"], row["stop"])
                following = None if first is None else warc_stream.follow(source, first, row["stop"])
                out.append({**row, "first": first, "next": following})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=batch.schema)


def ranges(spark: SparkSession, listed: list[tuple[str, int]], range_bytes: int) -> DataFrame:
    """(path, size, begin, stop) of all files; an archive of any size is cut in the same way."""
    table = spark.createDataFrame(listed, "path string, size bigint")
    begins = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint"))
    cut = table.withColumn("begin", F.explode(begins))
    return cut.withColumn("stop", F.least(F.col("begin") + range_bytes, "size"))


def pieces(spark: SparkSession, listed: list[tuple[str, int]], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, size, begin, stop): every ``begin`` is the start of a record, and all records that start before ``stop`` belong
    to the piece. A file of one range needs no look; the others are settled range by range, by jobs over those still wrong."""
    cut = ranges(spark, listed, range_bytes)
    single = cut.filter(F.col("size") <= range_bytes).select("path", "size", "begin", "stop")
    many = [size for _, size in listed if size > range_bytes]
    if not many:
        return single
    tasks = sum(-(-size // range_bytes) for size in many)
    blank = F.lit(None).cast("bigint")
    todo = cut.filter(F.col("size") > range_bytes).withColumn("first", blank).withColumn("next", blank).repartition(tasks, "path", "begin")
    looked = written(todo.mapInArrow(look, LOOKED), "warc-ranges")
    before = Window.partitionBy("path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        led = looked.withColumn("entry", F.coalesce(F.max("next").over(before), F.lit(0)))
        inside = F.col("entry") < F.col("stop")
        wrong = F.when(inside, ~F.col("entry").eqNullSafe(F.col("first"))).otherwise(F.col("first").isNotNull())
        led = written(led.withColumn("wrong", wrong), "warc-chains")
        bad = led.filter("wrong")
        count = bad.count()
        if not count:
            return single.unionByName(led.filter(inside).select("path", "size", F.col("entry").alias("begin"), "stop"))
        # the first wrong range of a file has its true entry now, so every round settles at least one more
        columns = ["path", "size", "begin", "stop", F.when(inside, F.col("entry")).alias("first"), blank.alias("next")]
        again = bad.filter(inside).select(columns).repartition(count, "path", "begin").mapInArrow(look, LOOKED)
        empty = bad.filter(~inside).select(columns)
        looked = written(led.filter("NOT wrong").drop("entry", "wrong").unionByName(again).unionByName(empty), "warc-ranges")
