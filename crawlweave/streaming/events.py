"""Event feed: landing folder to typed, verified and deduplicated events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from crawlweave.functions import http
from crawlweave.functions.signing import verify_signature
from crawlweave.operators import monitoring
from crawlweave.sources.payloads import parse_events, parsed_once

# fixed values: resource types a receiver accepts; ping only tests the endpoint
RESOURCE_TYPES = ("scrape", "ping", "crawler")
LANDING = "headers map<string,string>, body string, received_at timestamp"


def landing_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of a landing folder: ``{"headers": {...}, "body": "...", "received_at": "..."}``."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def deliveries(lines: DataFrame) -> DataFrame:
    """Raw deliveries; header names are matched by their end, whatever the vendor prefix."""
    parsed = parsed_once(lines, F.from_json("value", LANDING))
    h = F.col("e.headers")
    return parsed.select(
        http.header_ending(h, "-webhook-resource-type").alias("resource_type"),
        http.header_ending(h, "-event-name").alias("event_name"),
        http.header_ending(h, "-webhook-signature").alias("signature"),
        F.col("e.body").alias("raw"),
        F.col("e.received_at").alias("received_at"),
    )


def accept(
    received: DataFrame,
    secrets: Sequence[str] = (),
    resource_type: str = "crawler",
    event_names: Sequence[str] = (),
) -> DataFrame:
    """Typed events of one resource type.

    Routing by header comes before any JSON of the body is read. With secrets,
    deliveries that carry a wrong signature are rejected; a missing signature
    passes, as it does while an endpoint is being set up.
    """
    if resource_type not in RESOURCE_TYPES or resource_type == "ping":
        raise ValueError(f"unsupported resource type {resource_type!r}")
    wanted = received.filter(F.col("resource_type") == resource_type)
    if event_names:
        wanted = wanted.filter(F.col("event_name").isin(*event_names))
    if secrets:
        checked = verify_signature(wanted, secrets)
        bad = F.col("signature").isNotNull() & ~F.col("verified")
        typed = parse_events(checked)
        return typed.withColumn("reject_reason", F.when(bad, "signature mismatch").otherwise(F.col("reject_reason"))).drop("verified")
    return parse_events(wanted)


def stream_crawl_events(
    spark: SparkSession,
    path: str,
    secrets: Sequence[str] = (),
    event_names: Sequence[str] = (),
    max_files: int | None = None,
) -> DataFrame:
    """Crawl events of a landing folder with ``reject_reason``."""
    return accept(deliveries(landing_stream(spark, path, max_files)), secrets, event_names=event_names)


def dedupe_events(events: DataFrame, delay: str = "10 minutes", ts: str = "received_at") -> DataFrame:
    """Drop repeated deliveries that arrive within ``delay`` of each other.

    The key is a digest of crawl, event and body, so one hot crawl is spread
    over all state partitions.
    """
    key = F.sha2(F.concat_ws("\u0001", F.col("crawler_uuid"), F.col("event"), F.col("raw")), 256)
    return events.withColumn("event_key", key).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["event_key"])


def visited_contents(events: DataFrame) -> DataFrame:
    """Content of visited pages, one row per URL and format; usable while the crawl runs."""
    visited = events.filter(F.col("event") == "crawler_url_visited")
    return visited.select(
        "crawler_uuid", "url", F.col("scrape.status_code").alias("status_code"), F.explode("scrape.content").alias("format", "content")
    )


def windowed_metrics(
    log: DataFrame, window: str = "1 hour", slide: str | None = None, delay: str = "10 minutes", keys: Sequence[str] = ("proxy_pool",)
) -> DataFrame:
    """Request metrics per window in append mode: a window is emitted once the watermark has passed it.

    ``log``: ts (timestamp), success, api_credit, duration and the keys. The
    state is a histogram, one row for each window, key and millisecond of
    duration; a closed window's rows meet in a second aggregation. Batch twin:
    ``operators.monitoring.monitoring_timeseries``, with the same metrics. A feed
    that ends is closed by a row whose ``ts`` lies past the last window's end and
    the delay; its own window stays open.
    """
    span = F.window("ts", window, slide) if slide else F.window("ts", window)
    histogram = monitoring.pre_count(log.withWatermark("ts", delay), [span.alias("w"), *map(F.col, keys)])
    closed = histogram.groupBy("w", *keys).agg(*monitoring.metric_columns())
    return closed.select(F.col("w.start").alias("bucket_start"), F.col("w.end").alias("bucket_end"), *keys, *closed.columns[1 + len(keys) :])


def period_window(period: str) -> str:
    """Window length of a monitoring period name."""
    return f"{int(monitoring.PERIODS[period].total_seconds())} seconds"
