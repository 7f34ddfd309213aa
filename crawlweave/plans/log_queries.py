"""Analytics over the request log of crawls."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from crawlweave.functions import errors as E
from crawlweave.operators import filters, guards, joins, monitoring, stats
from crawlweave.plans.registry import query, view

quoted = lambda values: ", ".join(f"'{v}'" for v in values)
FATAL, THROTTLE, MONITORED = map(quoted, (E.FATAL_CODES, E.THROTTLE_CODES, E.MONITORED_CODES))
stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
SQL_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


# --- errors ----------------------------------------------------------------------------------

ERROR_CLASSES = """, e AS (
    SELECT *, CASE WHEN error_code = 'ERR::SCRAPE::BAD_UPSTREAM_RESPONSE' THEN upstream_status ELSE api_status END AS http_code,
           split_part(error_code, '::', 2) AS resource,
           CASE WHEN retryable AND retry_after IS NOT NULL THEN retry_after ELSE 5 END AS retry_delay FROM failures),
by_resource AS (SELECT *, CASE resource WHEN 'SCRAPE' THEN 'ScrapeError' WHEN 'ASP' THEN 'AspError' END AS rc FROM e)
SELECT request_id, http_code, resource,
       CASE WHEN api_status <> 200 THEN
                 CASE WHEN http_code >= 500 THEN 'ApiHttpServerError' WHEN rc IS NOT NULL THEN rc WHEN http_code = 401 THEN 'BadApiKeyError'
                      WHEN http_code = 402 THEN 'PaymentRequired' WHEN http_code = 429 THEN 'TooManyRequest' ELSE 'ApiHttpClientError' END
            WHEN error_code = 'ERR::SCRAPE::BAD_UPSTREAM_RESPONSE' AND http_code >= 500 THEN 'UpstreamHttpServerError'
            WHEN error_code = 'ERR::SCRAPE::BAD_UPSTREAM_RESPONSE' AND http_code >= 400 THEN 'UpstreamHttpClientError'
            ELSE COALESCE(rc, 'ServiceError') END AS error_class,
       http_code || ' ' || error_code || ' ' || error_message ||
           CASE WHEN retryable THEN '. Retry delay : ' || retry_delay || ' seconds' ELSE '' END AS full_message,
       retry_delay, 3 AS retry_times FROM by_resource"""


@query("error_classes", ERROR_CLASSES)
def error_classes(spark, sf):
    return filters.classify_errors(view(spark, sf, "failures")).select(
        "request_id", "http_code", "resource", "error_class", "full_message", "retry_delay", "retry_times"
    )


@query(
    "rejects_from_headers",
    """SELECT event_id, error_code, CASE WHEN error_code IS NOT NULL THEN 'because' END AS error_message,
              CASE WHEN error_code IS NOT NULL THEN 422 END AS error_http_code, error_code IS NOT NULL AND k % 2 = 0 AS retryable FROM crawl_log""",
)
def rejects_from_headers(spark, sf):
    headers = F.when(
        F.col("error_code").isNotNull(),
        F.create_map(
            F.lit("X-Vendor-Reject-Code"), F.col("error_code"), F.lit("X-Vendor-Reject-Description"), F.lit("because"),
            F.lit("X-Vendor-Reject-Http-Code"), F.lit("422"),
            F.lit("X-Vendor-Reject-Retryable"), F.when(F.col("k") % 2 == 0, "yes").otherwise("no"),
        ),
    ).otherwise(F.create_map(F.lit("Server"), F.lit("x")))
    log = view(spark, sf, "crawl_log").select("event_id", headers.alias("headers"))
    return filters.restore_reject(log).select("event_id", "error_code", "error_message", "error_http_code", "retryable")


@query(
    "error_summary",
    f"""SELECT crawler_uuid, error_code, COUNT(*) AS errors,
               COUNT(CASE WHEN error_code IN ({THROTTLE}) THEN 1 END) AS throttle_pauses,
               COUNT(CASE WHEN error_code IN ({FATAL}) THEN 1 END) AS fatal_stops,
               COUNT(CASE WHEN error_code IN ({MONITORED}) THEN 1 END) AS monitored_errors
        FROM crawl_log WHERE error_code IS NOT NULL GROUP BY crawler_uuid, error_code""",
)
def error_summary(spark, sf):
    return stats.error_summary(view(spark, sf, "crawl_log"))


GUARD = """, attempts AS (
    SELECT crawler_uuid, event_id, ts, ROW_NUMBER() OVER w AS rank,
           CAST(SUM(CASE WHEN error_code IN ({codes}) THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS BIGINT) AS recent_failures
    FROM crawl_log WINDOW w AS (PARTITION BY crawler_uuid ORDER BY ts, event_id))"""
ALL_CODES = MONITORED + ", 'ERR::SCRAPE::NETWORK_ERROR', 'ERR::SCRAPE::BAD_UPSTREAM_RESPONSE'"


@query(
    "error_totals",
    GUARD.format(codes=ALL_CODES)
    + f""", stops AS (SELECT DISTINCT crawler_uuid FROM attempts WHERE rank >= 10 AND recent_failures >= 4)
    SELECT e.crawler_uuid, COUNT(*) AS total_errors, COUNT(CASE WHEN error_code IN ({THROTTLE}) THEN 1 END) AS throttle_pauses,
           COUNT(CASE WHEN error_code IN ({FATAL}) THEN 1 END) AS fatal_stops,
           MAX(CASE WHEN s.crawler_uuid IS NULL THEN 0 ELSE 1 END) AS high_failure_rate_stops, COUNT(DISTINCT error_code) AS codes
    FROM crawl_log e LEFT JOIN stops s ON s.crawler_uuid = e.crawler_uuid WHERE error_code IS NOT NULL GROUP BY e.crawler_uuid""",
)
def error_totals(spark, sf):
    log = view(spark, sf, "crawl_log")
    codes = E.MONITORED_CODES + ("ERR::SCRAPE::NETWORK_ERROR", "ERR::SCRAPE::BAD_UPSTREAM_RESPONSE")
    stops = guards.first_stops(guards.failure_rate(log, threshold=0.4, codes=codes))
    out = stats.error_totals(log, stops)
    return out.select(
        "crawler_uuid", "total_errors", "throttle_pauses", "fatal_stops", "high_failure_rate_stops", F.size("by_code").alias("codes")
    )


@query(
    "retry_queue",
    """SELECT f.request_id, r.url, f.error_code,
              CASE WHEN f.never_received THEN 1 WHEN f.retryable THEN COALESCE(f.retry_after, 1) ELSE 1 END AS delay_s,
              r.retry_times + 1 AS attempt, r.priority + 100 AS priority, r.cache AS cache_clear
       FROM failures f JOIN requests r ON r.request_id = f.request_id
       WHERE (f.retryable OR f.never_received OR f.error_code = 'ERR::SCRAPE::NETWORK_ERROR') AND r.retry_times + 1 < 5""",
)
def retry_queue(spark, sf):
    failures, requests = view(spark, sf, "failures"), view(spark, sf, "requests")
    return joins.retry_queue(failures, requests, custom_codes=["ERR::SCRAPE::NETWORK_ERROR"])


@query(
    "retry_stats",
    """SELECT error_code, COUNT(*) AS retries, CAST(GROUPING(error_code) AS INT) AS is_total
       FROM failures WHERE retryable GROUP BY ROLLUP (error_code)""",
)
def retry_stats(spark, sf):
    out = stats.retry_stats(view(spark, sf, "failures").filter("retryable"))
    return out.withColumn("is_total", F.col("is_total").cast("int"))


@query(
    "throttle_report",
    f""", gaps AS (
         SELECT crawler_uuid, error_code, (epoch_us(LEAD(ts) OVER (PARTITION BY crawler_uuid ORDER BY ts, event_id)) - epoch_us(ts)) / 1e6 AS gap
         FROM crawl_log)
       SELECT crawler_uuid, COUNT(*) AS pauses, COUNT(*) * 5 AS pause_seconds, ROUND(MIN(gap), 6) AS min_gap,
              COUNT(CASE WHEN gap < 5 THEN 1 END) AS early_resumes
       FROM gaps WHERE error_code IN ({THROTTLE}) GROUP BY crawler_uuid""",
)
def throttle_report(spark, sf):
    out = guards.throttle_report(view(spark, sf, "crawl_log"), block_rows=16, slot_rows=16)
    return out.withColumn("min_gap", F.round("min_gap", 6))


# --- guard and budgets -----------------------------------------------------------------------


@query(
    "failure_rate",
    GUARD.format(codes=MONITORED)
    + " SELECT crawler_uuid, event_id, rank, recent_failures, rank >= 10 AND recent_failures >= 7 AS stop FROM attempts",
)
def failure_rate(spark, sf):
    return guards.failure_rate(view(spark, sf, "crawl_log"), block_rows=32, slot_rows=32).drop("ts")


@query(
    "failure_guard_stops",
    GUARD.format(codes=ALL_CODES)
    + """ SELECT crawler_uuid, MIN(rank) AS stop_rank, MIN_BY(event_id, rank) AS event_id, MIN_BY(recent_failures, rank) AS recent_failures
          FROM attempts WHERE rank >= 10 AND recent_failures >= 4 GROUP BY crawler_uuid""",
)
def failure_guard_stops(spark, sf):
    codes = E.MONITORED_CODES + ("ERR::SCRAPE::NETWORK_ERROR", "ERR::SCRAPE::BAD_UPSTREAM_RESPONSE")
    rates = guards.failure_rate(view(spark, sf, "crawl_log"), threshold=0.4, codes=codes)
    return guards.first_stops(rates).drop("ts")


LIMITS = """SELECT crawler_uuid, CAST(CASE n % 4 WHEN 0 THEN 20 WHEN 3 THEN 15 ELSE 0 END AS INT) AS page_limit,
    CAST(CASE n % 4 WHEN 1 THEN 100 WHEN 3 THEN 120 END AS INT) AS max_api_credit, CAST(CASE n % 4 WHEN 2 THEN 86400 WHEN 3 THEN 200000 ELSE 0 END AS INT) AS max_duration
    FROM (SELECT DISTINCT crawler_uuid, CAST(crawler_uuid AS INT) AS n FROM crawl_log) AS c"""


@query(
    "visits_within_budget",
    f""", limits AS ({LIMITS}), runs AS (
      SELECT l.crawler_uuid, event_id, ROW_NUMBER() OVER w AS rank, CAST(SUM(api_credit) OVER w AS BIGINT) AS credits_after, api_credit,
             (epoch_us(ts) - epoch_us(FIRST_VALUE(ts) OVER w)) / 1e6 AS elapsed, page_limit, max_api_credit, max_duration
      FROM crawl_log l LEFT JOIN limits USING (crawler_uuid) WINDOW w AS (PARTITION BY l.crawler_uuid ORDER BY ts, event_id)),
    hits AS (SELECT *, CASE WHEN page_limit > 0 AND rank - 1 >= page_limit THEN 'page_limit'
                            WHEN max_api_credit > 0 AND credits_after - api_credit >= max_api_credit THEN 'max_api_credit'
                            WHEN max_duration > 0 AND elapsed >= max_duration THEN 'max_duration' END AS hit FROM runs),
    stops AS (SELECT crawler_uuid, MIN(rank) AS stop_rank, MIN_BY(hit, rank) AS stop_reason FROM hits WHERE hit IS NOT NULL GROUP BY crawler_uuid)
    SELECT h.crawler_uuid, event_id, rank, credits_after, CASE WHEN rank >= stop_rank THEN 'skipped' ELSE 'visited' END AS state,
           CASE WHEN rank >= stop_rank THEN stop_reason END AS reason
    FROM hits h LEFT JOIN stops s ON s.crawler_uuid = h.crawler_uuid""",
)
def visits_within_budget(spark, sf):
    log = view(spark, sf, "crawl_log")
    log.createOrReplaceTempView("crawl_log")
    limits = spark.sql(LIMITS)
    visits = log.select("crawler_uuid", "event_id", "ts", "api_credit")
    return guards.apply_budgets(visits, limits).select("crawler_uuid", "event_id", "rank", "credits_after", "state", "reason")


# --- crawl state and statistics --------------------------------------------------------------


@query(
    "latest_status",
    f"""SELECT crawler_uuid, {SQL_STAMP.format("MAX(polled_at)")} AS polled_at, MAX_BY(status, polled_at) AS status,
               MAX_BY(urls_visited, polled_at) AS urls_visited FROM status_polls GROUP BY crawler_uuid""",
)
def latest_status(spark, sf):
    out = stats.latest_status(view(spark, sf, "status_polls"))
    return out.select("crawler_uuid", stamp("polled_at").alias("polled_at"), "status", "urls_visited")


@query(
    "crawl_stats",
    """, latest AS (SELECT crawler_uuid, MAX_BY(status, polled_at) AS status, MAX_BY(CASE WHEN is_success THEN 2 WHEN NOT is_success THEN 1 ELSE 0 END, polled_at) AS s,
                           MAX_BY(urls_visited, polled_at) AS v, MAX_BY(urls_extracted, polled_at) AS x FROM status_polls GROUP BY crawler_uuid),
       sizes AS (SELECT crawler_uuid, COUNT(*) AS n, CAST(SUM(octet_length(encode(content))) AS BIGINT) AS b FROM crawl_pages GROUP BY crawler_uuid)
       SELECT l.crawler_uuid, status, status = 'DONE' AND s = 2 AS is_complete, COALESCE(n, 0) AS pages_downloaded, COALESCE(b, 0) AS total_size_bytes,
              ROUND(COALESCE(b, 0) / 1024, 6) AS total_size_kb, ROUND(COALESCE(b / n, 0), 6) AS avg_page_size_bytes,
              ROUND(CASE WHEN x > 0 THEN v / x * 100 END, 6) AS crawl_rate, ROUND(CASE WHEN x > 0 THEN COALESCE(n, 0) / x * 100 END, 6) AS download_rate
       FROM latest l LEFT JOIN sizes z ON z.crawler_uuid = l.crawler_uuid""",
)
def crawl_stats(spark, sf):
    status = stats.latest_status(view(spark, sf, "status_polls"))
    out = stats.crawl_stats(status, view(spark, sf, "crawl_pages").select("crawler_uuid", "content"))
    rounded = ["total_size_kb", "avg_page_size_bytes", "crawl_rate", "download_rate"]
    return out.select(
        "crawler_uuid", "status", "is_complete", "pages_downloaded", "total_size_bytes", *[F.round(c, 6).alias(c) for c in rounded]
    )


@query(
    "crawl_state",
    f"""SELECT crawler_uuid, COUNT(CASE WHEN event = 'crawler_url_visited' THEN 1 END) AS urls_visited,
               COUNT(DISTINCT CASE WHEN event <> 'crawler_url_failed' THEN url END) AS urls_extracted,
               COUNT(CASE WHEN event = 'crawler_url_failed' THEN 1 END) AS urls_failed, COUNT(CASE WHEN event = 'crawler_url_skipped' THEN 1 END) AS urls_skipped,
               CAST(SUM(api_credit) AS BIGINT) AS api_credit_used, {SQL_STAMP.format("MIN(ts)")} AS start_time, {SQL_STAMP.format("MAX(ts)")} AS stop_time,
               MAX_BY(stop_reason, ts) FILTER (WHERE stop_reason IS NOT NULL) AS stop_reason,
               COUNT(DISTINCT CASE WHEN event <> 'crawler_url_failed' THEN url END) - COUNT(CASE WHEN event = 'crawler_url_skipped' THEN 1 END) AS urls_to_crawl,
               ROUND((epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / 1e6, 6) AS duration
        FROM crawl_log GROUP BY crawler_uuid""",
)
def crawl_state(spark, sf):
    out = stats.crawl_state(view(spark, sf, "crawl_log"))
    return out.withColumns(
        {"start_time": stamp("start_time"), "stop_time": stamp("stop_time"), "duration": F.round("duration", 6)}
    )


COST_ROWS = """SELECT crawler_uuid, url, CAST(ts AS DATE) AS day, CAST(date_trunc('month', ts) AS DATE) AS month, api_credit AS base_credits, k % 8 = 0 AS cached,
    CASE k % 5 WHEN 0 THEN 'model' WHEN 1 THEN 'prompt' WHEN 2 THEN 'template' END AS extraction FROM crawl_log"""


@query(
    "credit_costs",
    f""", costed AS (SELECT *, CASE WHEN cached THEN 0 ELSE base_credits + CASE extraction WHEN 'model' THEN 5 WHEN 'prompt' THEN 10 WHEN 'template' THEN 1 ELSE 0 END END AS credits
        FROM ({COST_ROWS}) AS c)
        SELECT crawler_uuid, url, CAST(day AS VARCHAR) AS day, CAST(month AS VARCHAR) AS month, COUNT(*) AS pages, CAST(SUM(credits) AS BIGINT) AS credits, ROUND(AVG(credits), 9) AS avg_credits
        FROM costed GROUP BY GROUPING SETS ((crawler_uuid), (url), (day), (month))""",
)
def credit_costs(spark, sf):
    view(spark, sf, "crawl_log").createOrReplaceTempView("crawl_log")
    out = stats.credit_costs(spark.sql(COST_ROWS), [["crawler_uuid"], ["url"], ["day"], ["month"]])
    return out.select(
        "crawler_uuid", "url", F.col("day").cast("string").alias("day"), F.col("month").cast("string").alias("month"),
        "pages", "credits", F.round("avg_credits", 9).alias("avg_credits"),
    )


@query(
    "trap_report",
    """SELECT 'all_p_pages' AS trap, COUNT(*) AS hits, CAST(10 AS BIGINT) AS max_hits, COUNT(*) <= 10 AS passed FROM crawl_log WHERE regexp_matches(url, '/p/[0-9]+$')
       UNION ALL SELECT 'single_digit', COUNT(*), 1000000, COUNT(*) <= 1000000 FROM crawl_log WHERE regexp_matches(url, '/p/[0-9]$')
       UNION ALL SELECT 'never_hit', 0, 0, TRUE""",
)
def trap_report(spark, sf):
    traps = {"all_p_pages": ("/p/[0-9]+$", 10), "single_digit": ("/p/[0-9]$", 1000000), "never_hit": ("/robots-disallowed", 0)}
    return stats.trap_report(view(spark, sf, "crawl_log"), traps)


# --- monitoring ------------------------------------------------------------------------------

METRICS = """CAST(COUNT(*) AS BIGINT) AS requests, CAST(COUNT(CASE WHEN success THEN 1 END) AS BIGINT) AS successes,
    CAST(COUNT(CASE WHEN NOT success THEN 1 END) AS BIGINT) AS failures, CAST(SUM(api_credit) AS BIGINT) AS credits,
    ROUND(AVG(duration), 9) AS avg_duration, ROUND(quantile_cont(ROUND(duration * 1000), 0.95) / 1000, 9) AS p95_duration"""


def rounded(df):
    return df.withColumns({"avg_duration": F.round("avg_duration", 9), "p95_duration": F.round("p95_duration", 9)})


@query(
    "monitoring_metrics",
    f"""SELECT product, project, target, CASE WHEN GROUPING(project) = 1 AND GROUPING(target) = 1 THEN 'account' WHEN GROUPING(project) = 0 THEN 'project' ELSE 'target' END AS level, {METRICS}
        FROM crawl_log GROUP BY GROUPING SETS ((product), (product, project), (product, target))""",
)
def monitoring_metrics(spark, sf):
    return rounded(monitoring.monitoring_metrics(view(spark, sf, "crawl_log"), period="subscription", include_webhook=True))


@query(
    "monitoring_metrics_last7d",
    f"""SELECT product, project, CAST(NULL AS VARCHAR) AS target, 'project' AS level, {METRICS} FROM crawl_log
        WHERE ts >= (SELECT MAX(ts) FROM crawl_log) - INTERVAL 7 DAY AND NOT is_webhook GROUP BY product, project""",
)
def monitoring_metrics_last7d(spark, sf):
    log = view(spark, sf, "crawl_log")
    now = log.agg(F.max("ts")).first()[0]
    return rounded(monitoring.monitoring_metrics(log, period="last7d", aggregation=["project"], now=now))


@query(
    "monitoring_metrics_between",
    f"""SELECT product, CAST(NULL AS VARCHAR) AS project, target, 'target' AS level, {METRICS} FROM crawl_log
        WHERE ts >= (SELECT MAX(ts) FROM crawl_log) - INTERVAL 30 DAY AND ts <= (SELECT MAX(ts) FROM crawl_log) - INTERVAL 10 DAY GROUP BY product, target""",
)
def monitoring_metrics_between(spark, sf):
    """Bounds of the caller's own, which override the period."""
    log = view(spark, sf, "crawl_log")
    last = log.agg(F.max("ts")).first()[0]
    bounds = {"start": last - dt.timedelta(days=30), "end": last - dt.timedelta(days=10)}
    return rounded(monitoring.monitoring_metrics(log, aggregation=["target"], include_webhook=True, **bounds))


@query(
    "monitoring_metrics_last1h",
    f"""SELECT product, CAST(NULL AS VARCHAR) AS project, CAST(NULL AS VARCHAR) AS target, 'account' AS level, {METRICS} FROM crawl_log
        WHERE ts >= (SELECT MAX(ts) FROM crawl_log) - INTERVAL 1 HOUR AND NOT is_webhook GROUP BY product""",
)
def monitoring_metrics_last1h(spark, sf):
    log = view(spark, sf, "crawl_log")
    now = log.agg(F.max("ts")).first()[0]
    return rounded(monitoring.monitoring_metrics(log, period="last1h", aggregation=["account"], now=now))


@query(
    "monitoring_timeseries_between",
    f"""SELECT proxy_pool, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket_start, {METRICS} FROM crawl_log
        WHERE proxy_pool = 'residential' AND ts >= (SELECT MIN(ts) FROM crawl_log) + INTERVAL 1 DAY AND ts <= (SELECT MIN(ts) FROM crawl_log) + INTERVAL 3 DAY GROUP BY ALL""",
)
def monitoring_timeseries_between(spark, sf):
    log = view(spark, sf, "crawl_log")
    first = log.agg(F.min("ts")).first()[0]
    out = monitoring.monitoring_timeseries(log, proxy_pool="residential", start=first + dt.timedelta(days=1), end=first + dt.timedelta(days=3))
    return rounded(out).withColumn("bucket_start", F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss"))


TARGET = """SELECT {key} AS target, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS bucket_start, {metrics}
            FROM crawl_log WHERE NOT is_webhook AND target LIKE '%.example.com' GROUP BY ALL"""


@query("target_metrics", TARGET.format(key="target", metrics=METRICS))
def target_metrics(spark, sf):
    out = monitoring.target_metrics(view(spark, sf, "crawl_log"), "example.com", period=None, bucket="1 day")
    return rounded(out).withColumn("bucket_start", F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss"))


@query("target_metrics_folded", TARGET.format(key="'example.com'", metrics=METRICS))
def target_metrics_folded(spark, sf):
    out = monitoring.target_metrics(view(spark, sf, "crawl_log"), "example.com", group_subdomain=True, period=None, bucket="1 day")
    return rounded(out).withColumn("bucket_start", F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "monitoring_timeseries",
    f"""SELECT proxy_pool, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket_start, {METRICS} FROM crawl_log GROUP BY ALL""",
)
def monitoring_timeseries(spark, sf):
    out = monitoring.monitoring_timeseries(view(spark, sf, "crawl_log"))
    return rounded(out).withColumn("bucket_start", F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss"))


@query("monitoring_by_proxy_pool", f"SELECT proxy_pool, {METRICS} FROM crawl_log GROUP BY proxy_pool")
def monitoring_by_proxy_pool(spark, sf):
    return rounded(monitoring.monitoring_timeseries(view(spark, sf, "crawl_log"), bucket=None))


@query(
    "prometheus_lines",
    """, m AS (SELECT product, project, COUNT(*) AS requests, COUNT(CASE WHEN success THEN 1 END) AS successes
               FROM crawl_log WHERE NOT is_webhook GROUP BY product, project)
       SELECT 'crawl_requests{product="' || product || '",project="' || project || '",level="project"} ' || CAST(requests AS DOUBLE) AS line FROM m
       UNION ALL SELECT 'crawl_successes{product="' || product || '",project="' || project || '",level="project"} ' || CAST(successes AS DOUBLE) FROM m""",
)
def prometheus_lines(spark, sf):
    metrics = monitoring.monitoring_metrics(view(spark, sf, "crawl_log"), period=None, aggregation=["project"])
    return monitoring.to_prometheus(metrics, ["product", "project", "target", "level"], ["requests", "successes"])


# --- joins over the log ----------------------------------------------------------------------


@query(
    "matched_batch_results",
    """, ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY batch_id ORDER BY arrival_seq) AS arrival_rank FROM batch_results),
       firsts AS (SELECT batch_id, MIN_BY(config, idx) AS first_config FROM requests GROUP BY batch_id)
       SELECT COALESCE(r.batch_id, q.batch_id) AS batch_id, COALESCE(r.correlation_id, q.correlation_id) AS correlation_id, r.result_id, r.arrival_rank,
              COALESCE(q.config, f.first_config) AS config,
              CASE WHEN r.batch_id IS NULL THEN 'missing' WHEN q.idx IS NULL THEN 'fallback' ELSE 'matched' END AS match_kind
       FROM ranked r FULL OUTER JOIN requests q ON q.batch_id = r.batch_id AND q.correlation_id = r.correlation_id
       LEFT JOIN firsts f ON f.batch_id = COALESCE(r.batch_id, q.batch_id)""",
)
def matched_batch_results(spark, sf):
    out = joins.match_batch_results(view(spark, sf, "requests"), view(spark, sf, "batch_results"))
    return out.select("batch_id", "correlation_id", "result_id", "arrival_rank", "config", "match_kind")


@query(
    "scrape_report",
    ERROR_CLASSES.replace("SELECT request_id, http_code", ", classes AS (SELECT request_id, http_code")
    + """) SELECT e.request_id, r.config AS scrape_config, r.url AS log_url,
              '{"code":"' || f.error_code || '","message":"request failed"}' AS scrape_error,
              '{"message":"' || e.full_message || '","type":"' || e.error_class || '"}' AS error
       FROM classes e JOIN failures f ON f.request_id = e.request_id JOIN requests r ON r.request_id = e.request_id""",
)
def scrape_report(spark, sf):
    requests = view(spark, sf, "requests").select("request_id", F.col("config").alias("scrape_config"), F.col("url").alias("log_url"))
    return joins.scrape_report(filters.classify_errors(view(spark, sf, "failures")).join(requests, "request_id"))
