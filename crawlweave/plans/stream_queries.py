"""Streaming operators run to completion over files derived from the event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crawlweave.functions import errors as E, signing
from crawlweave.operators import filters, joins
from crawlweave.plans import fixtures
from crawlweave.plans.log_queries import ALL_CODES, ERROR_CLASSES, GUARD
from crawlweave.plans.registry import query, view
from crawlweave.session import STATE_STORE, fresh_dir
from crawlweave.sinks.reports import report_stream
from crawlweave.streaming import events as EV, state as ST

SECRET = "feed-secret"


def files_of(spark) -> int:
    """Files of a time slice, and of a micro-batch."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_time_order(rows: DataFrame, write, slices: int = 3) -> None:
    """Hand over consecutive time slices one after the other.

    A file source reads files by their age, so the feed arrives in time order,
    one slice per micro-batch.
    """
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    span = F.unix_micros("ts") - int(low.timestamp() * 1_000_000)
    width = max(int((high - low).total_seconds() * 1_000_000) // slices, 1)
    number = F.least(F.greatest(F.floor(span / width), F.lit(0)), F.lit(slices - 1))
    for i in range(slices):
        write(rows.filter(number == i).repartition(files_of(rows.sparkSession)))


#: crawl of the row that ends a feed, years after its last row
CLOSING = "closing"


def log_stream(spark, sf, name: str, lifecycle: bool = False) -> DataFrame:
    """The request log as a stream of Parquet files in time order; a closing row moves the watermark past everything.

    With ``lifecycle``, a third of the crawls ends with a terminal event at its last row's time.
    """
    path = fresh_dir(spark, name)
    log = view(spark, sf, "crawl_log").withColumn("ts", F.col("ts").cast("timestamp"))
    if lifecycle:
        last = log.filter(FINISHED).groupBy("crawler_uuid").agg(F.max("ts").alias("ts"))
        log = log.unionByName(last.select("crawler_uuid", "ts", F.lit("crawler_finished").alias("event"), F.lit(0).cast("bigint").alias("api_credit")), allowMissingColumns=True)
    in_time_order(log, lambda part: part.write.mode("append").parquet(path))
    closing = log.agg((F.max("ts") + F.expr("INTERVAL 10 YEARS")).alias("ts")).withColumn("crawler_uuid", F.lit(CLOSING))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in log.schema if f.name not in closing.columns]
    closing.select("*", *missing).select(log.columns).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_of(spark)).parquet(path)


FINISHED = "CAST(crawler_uuid AS INT) % 3 = 0"


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream until its input is used up; rows come back with their ``batch_id``."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    out = fresh_dir(spark, name)

    def append(batch: DataFrame, batch_id: int) -> None:
        # a repeated batch overwrites its own folder
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    run = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(append)
        .option("checkpointLocation", fresh_dir(spark, f"{name}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.option("basePath", out).parquet(out)


@query(
    "streamed_crawl_state",
    f"""SELECT crawler_uuid, COUNT(CASE WHEN event = 'crawler_url_visited' THEN 1 END) AS urls_visited,
              COUNT(DISTINCT CASE WHEN event <> 'crawler_url_failed' THEN url END) AS urls_extracted, COUNT(CASE WHEN event = 'crawler_url_failed' THEN 1 END) AS urls_failed,
              COUNT(CASE WHEN event = 'crawler_url_skipped' THEN 1 END) AS urls_skipped, CAST(SUM(api_credit) AS BIGINT) AS api_credit_used,
              epoch_us(MIN(ts)) AS start_us, epoch_us(MAX(ts)) AS stop_us, MAX_BY(stop_reason, ts) FILTER (WHERE stop_reason IS NOT NULL) AS stop_reason,
              {FINISHED} AS is_finished, urls_extracted - urls_skipped AS urls_to_crawl
       FROM crawl_log GROUP BY crawler_uuid""",
)
def streamed_crawl_state(spark, sf):
    """URLs are recognised over the whole feed, whose crawls go on for months."""
    stream = ST.crawl_state_stream(log_stream(spark, sf, "log", lifecycle=True), delay="1000 days", shares=2)
    return ST.merge_shares(drain(stream, "crawl-state")).filter(F.col("crawler_uuid") != CLOSING)


@query(
    "streamed_failure_guard",
    GUARD.format(codes=ALL_CODES)
    + """ SELECT crawler_uuid, MIN(rank) AS stop_rank, MIN_BY(event_id, rank) AS event_id, MIN_BY(recent_failures, rank) AS recent_failures
          FROM attempts WHERE rank >= 10 AND recent_failures >= 4 GROUP BY crawler_uuid""",
)
def streamed_failure_guard(spark, sf):
    codes = E.MONITORED_CODES + ("ERR::SCRAPE::NETWORK_ERROR", "ERR::SCRAPE::BAD_UPSTREAM_RESPONSE")
    stream = ST.failure_guard_stream(log_stream(spark, sf, "log"), threshold=0.4, codes=codes)
    return drain(stream, "guard").drop("batch_id")


@query(
    "streamed_window_metrics",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket_start, proxy_pool, COUNT(*) AS requests, COUNT(CASE WHEN success THEN 1 END) AS successes,
              COUNT(CASE WHEN NOT success THEN 1 END) AS failures, CAST(SUM(api_credit) AS BIGINT) AS credits, ROUND(AVG(duration), 9) AS avg_duration,
              ROUND(quantile_cont(CAST(ROUND(duration * 1000) AS BIGINT), 0.95) / 1000, 6) AS p95_duration
       FROM crawl_log GROUP BY date_trunc('hour', ts), proxy_pool""",
)
def streamed_window_metrics(spark, sf):
    out = drain(EV.windowed_metrics(log_stream(spark, sf, "log")), "windows")
    return out.select(
        F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss").alias("bucket_start"), "proxy_pool", "requests", "successes", "failures", "credits",
        F.round("avg_duration", 9).alias("avg_duration"), F.round("p95_duration", 6).alias("p95_duration"),
    )


def landing_folder(spark, sf) -> str:
    """Deliveries of the event envelopes: every fourth is sent twice, some are pings, some have a wrong signature."""
    log = view(spark, sf, "crawl_log").withColumn("ts", F.col("ts").cast("timestamp"))
    path = fresh_dir(spark, "landing")
    # rows are dealt out as they are in the log; envelopes, many times as wide, are made where they are written
    in_time_order(log, lambda part: part.select(*LANDED).transform(delivery_lines).write.mode("append").option("compression", PACKED).text(path))
    return path


#: a landing file is read as a whole by one task; packed it is about a sixth as long, for hardly any time
PACKED = "lz4"
#: columns of the log that an envelope is made of
LANDED = ("event_id", "k", "ts", "event", "crawler_uuid", "project", "env", "url", "country", "error_code", "stop_reason")


def delivery_lines(log: DataFrame) -> DataFrame:
    bodies = log.select("event_id", "k", "ts", "event", envelope().alias("body"))
    inner, outer = signing.pads(SECRET)
    digest = signing.hmac_hex(F.col("body").cast("binary"), F.lit(inner), F.lit(outer))
    signed = bodies.withColumn("signature", F.when(F.col("k") % 10 == 3, F.lower(digest)).when(F.col("k") % 10 != 4, digest))
    copies = signed.withColumn("copy", F.explode(F.when(F.col("event_id") % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    line = F.to_json(
        F.struct(
            F.create_map(
                F.lit("X-Vendor-Webhook-Resource-Type"), F.when(F.col("k") % 10 == 5, "ping").otherwise("crawler"),
                F.lit("X-Vendor-Crawl-Event-Name"), F.col("event"),
                F.lit("X-Vendor-Webhook-Signature"), F.col("signature"),
            ).alias("headers"),
            "body",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("received_at"),
        )
    )
    return copies.select(line.alias("value"))


def envelope() -> Column:
    """Event envelope with the id of its event as ``action``."""
    payload = f"""named_struct('crawler_uuid', crawler_uuid, 'project', project, 'env', env, 'action', CAST(event_id AS STRING), 'state', {fixtures.STATE_JSON},
        'url', url, 'scrape', named_struct('status_code', 200, 'country', country, 'log_uuid', CAST(event_id AS STRING), 'log_url', url, 'content', map('html', concat('<p>', url, '</p>'), 'text', url)),
        'urls', map(url, 'page_limit'), 'origin', 'navigation', 'discovered_urls', array(url), 'error', coalesce(error_code, 'none'), 'scrape_config', named_struct('url', url),
        'links', named_struct('scrape', url, 'status', url), 'seed_url', url)"""
    return F.expr(f"to_json(named_struct('event', event, 'payload', {payload}))")


@query(
    "streamed_crawl_events",
    """SELECT event, CAST(event_id AS VARCHAR) AS action, CASE WHEN k % 10 = 3 THEN 'signature mismatch' END AS reject_reason FROM crawl_log WHERE k % 10 <> 5""",
)
def streamed_crawl_events(spark, sf):
    stream = EV.stream_crawl_events(spark, landing_folder(spark, sf), secrets=["old-secret", SECRET], max_files=files_of(spark))
    unique = EV.dedupe_events(stream, "10 minutes")
    return drain(unique.select("event", "action", "reject_reason"), "events").drop("batch_id")


@query(
    "streamed_visited_contents",
    """SELECT crawler_uuid, url, f.format, COUNT(*) AS n FROM crawl_log, (VALUES ('html'), ('text')) AS f(format)
       WHERE event = 'crawler_url_visited' AND k % 10 NOT IN (3, 5) GROUP BY ALL""",
)
def streamed_visited_contents(spark, sf):
    stream = EV.stream_crawl_events(spark, landing_folder(spark, sf), secrets=[SECRET], event_names=["crawler_url_visited"], max_files=files_of(spark))
    accepted = EV.dedupe_events(stream.filter(F.col("reject_reason").isNull()))
    rows = drain(EV.visited_contents(accepted), "contents")
    return rows.groupBy("crawler_uuid", "url", "format").agg(F.count(F.lit(1)).alias("n"))


@query(
    "streamed_reports",
    ERROR_CLASSES.replace("SELECT request_id, http_code", ", classes AS (SELECT request_id, http_code")
    + """), s AS (SELECT error_class, COUNT(*) AS n FROM classes GROUP BY error_class)
       SELECT 'first' AS sink, error_class, n FROM s UNION ALL SELECT 'second', error_class, n FROM s""",
)
def streamed_reports(spark, sf):
    path, checkpoint = fresh_dir(spark, "failures"), fresh_dir(spark, "reports-checkpoint")
    view(spark, sf, "failures").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(path)
    source = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_of(spark)).parquet(path)
    failed = filters.classify_errors(source).withColumns({"scrape_config": F.lit("cfg"), "log_url": F.lit("log")})
    out = fresh_dir(spark, "reports")

    def sink(name: str):
        return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{out}/sink={name}/batch_id={batch_id}")

    report_stream(joins.scrape_report(failed), [sink("first"), sink("second")], checkpoint).trigger(availableNow=True).start().awaitTermination()
    reports = spark.read.option("basePath", out).parquet(out)
    return reports.groupBy("sink", F.get_json_object("error", "$.type").alias("error_class")).agg(F.count(F.lit(1)).alias("n"))
