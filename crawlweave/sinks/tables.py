"""Columnar page tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

ROW_GROUP_ROWS = 100_000


def page_table(records: DataFrame) -> DataFrame:
    """WARC response records as the typed page table; bodies are left out.

    Types are the narrow ones of the published schema; values that do not fit
    become null instead of failing the job.
    """
    w, h = F.col("warc_headers"), F.col("headers")
    content_type = F.element_at(F.map_values(F.map_filter(h, lambda k, v: F.lower(k) == "content-type")), 1)
    date = F.try_to_timestamp(w["WARC-Date"])  # in the zone it names
    return records.filter(F.col("record_type") == "response").select(
        "url",
        w["WARC-Record-ID"].alias("record_id"),
        date.alias("date"),
        F.col("status_code").try_cast("smallint").alias("status_code"),
        F.when(F.size(h) > 0, content_type).alias("content_type"),
        F.octet_length("content").alias("content_length"),
        w["WARC-Scrape-Log-Id"].alias("log_id"),
        w["WARC-Scrape-Country"].alias("country"),
        F.coalesce(w["WARC-Scrape-Duration"].try_cast("float"), F.lit(0.0).cast("float")).alias("duration"),
        F.coalesce(w["WARC-Scrape-Retry"].try_cast("tinyint"), F.lit(0).cast("tinyint")).alias("retry_count"),
    )


def write_pages_parquet(
    pages: DataFrame, path: str, partition_by: Sequence[str] = ("country", "partition_date"), mode: str = "errorifexists"
) -> None:
    """ZSTD Parquet with a bloom filter on ``url``.

    The rebalance hint lets AQE split a partition value that holds most rows
    and merge small ones. Dates are those of UTC. Rows are sorted by URL inside each file, so that row
    group statistics prune URL prefixes.
    """
    if "partition_date" in partition_by and "partition_date" not in pages.columns:
        pages = pages.withColumn("partition_date", F.to_date(F.to_utc_timestamp("date", F.current_timezone())))
    laid_out = pages.hint("rebalance", *partition_by) if partition_by else pages.hint("rebalance")
    (
        laid_out.sortWithinPartitions(*partition_by, "url")
        .write.mode(mode)
        .partitionBy(*partition_by)
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", "9")
        .option("parquet.bloom.filter.enabled#url", "true")
        .option("parquet.bloom.filter.expected.ndv#url", str(ROW_GROUP_ROWS))
        .option("parquet.block.row.count.limit", str(ROW_GROUP_ROWS))
        .parquet(path)
    )
