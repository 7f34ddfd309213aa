"""Query registry and the views that present the given tables as crawl data.

The view texts are portable SQL: Spark and the checking engine read the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crawlweave.session import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VIEWS: dict[str, str] = {
    # a crawl archive: one row per page
    "crawl_pages": """
        SELECT page_id, url, html AS content,
               CAST(page_id % 10 AS VARCHAR(10)) AS crawler_uuid,
               UPPER(regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1)) AS country,
               CAST(CASE page_id % 20 WHEN 0 THEN 404 WHEN 1 THEN 500 WHEN 2 THEN 301 ELSE 200 END AS INT) AS status_code,
               CAST(page_id % 97 AS DOUBLE) / 10 AS duration,
               CAST(page_id % 4 AS INT) AS retry_count,
               CASE WHEN page_id % 7 = 0 THEN 'application/xml' ELSE 'text/html; charset=utf-8' END AS content_type
        FROM pages""",
    # two records per page, as an archive with retries has
    "archive_records": """
        SELECT CASE WHEN page_id % 3 = 0 THEN url || '&gone=1' ELSE url END AS url, page_id,
               'a.warc' AS path, page_id * 2 + k AS record_seq,
               CAST(CASE WHEN k = 0 AND page_id % 5 = 0 THEN 503 ELSE status_code END AS INT) AS status_code,
               'log-' || CAST(page_id * 2 + k AS VARCHAR(20)) AS log_id, country,
               CASE WHEN page_id % 11 = 0 THEN NULL ELSE CAST((page_id + k) % 50 AS VARCHAR(20)) END AS duration_text
        FROM (SELECT 0 AS k, url, page_id, status_code, country FROM crawl_pages
              UNION ALL SELECT 1, url, page_id, status_code, country FROM crawl_pages) AS c""",
    # a request log of crawls: one row per event
    "crawl_log": """
        SELECT event_id, ts, k,
               CAST(user_id AS VARCHAR(20)) AS crawler_uuid,
               CASE user_id % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'shop' ELSE 'news' END AS project,
               CASE WHEN user_id % 2 = 0 THEN 'LIVE' ELSE 'TEST' END AS env,
               CASE event_type WHEN 'click' THEN 'crawler_url_discovered' WHEN 'signup' THEN 'crawler_url_skipped'
                               WHEN 'error' THEN 'crawler_url_failed' ELSE 'crawler_url_visited' END AS event,
               CASE k % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'FR' ELSE 'DE' END AS country,
               CASE WHEN event_type = 'error' THEN
                    CASE k % 5 WHEN 0 THEN 'ERR::ASP::SHIELD_ERROR' WHEN 1 THEN 'ERR::ASP::SHIELD_PROTECTION_FAILED'
                               WHEN 2 THEN 'ERR::THROTTLE::MAX_REQUEST_RATE_EXCEEDED' WHEN 3 THEN 'ERR::SCRAPE::NETWORK_ERROR'
                               ELSE 'ERR::SCRAPE::BAD_UPSTREAM_RESPONSE' END END AS error_code,
               CAST(CASE WHEN event_type IN ('view', 'purchase') THEN k % 25 + 1 ELSE 0 END AS BIGINT) AS api_credit,
               value / 100 AS duration,
               'https://site' || CAST(user_id % 7 AS VARCHAR(20)) || '.example.com/p/' || CAST(k AS VARCHAR(20)) AS url,
               'site' || CAST(user_id % 7 AS VARCHAR(20)) || '.example.com' AS target,
               CASE event_id % 4 WHEN 0 THEN 'scrape' WHEN 1 THEN 'screenshot' WHEN 2 THEN 'extraction' ELSE 'crawler' END AS product,
               event_type <> 'error' AS success,
               k % 10 = 0 AS is_webhook,
               CASE WHEN k % 2 = 0 THEN 'datacenter' ELSE 'residential' END AS proxy_pool,
               CASE k % 9 WHEN 0 THEN 'page_limit' WHEN 1 THEN 'max_duration' END AS stop_reason
        FROM (SELECT event_id, ts, user_id, event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
              FROM events) AS e""",
    # failed requests of the log
    "failures": """
        SELECT event_id AS request_id, crawler_uuid, ts, error_code, 'request failed' AS error_message,
               CAST(CASE k % 6 WHEN 0 THEN 200 WHEN 1 THEN 422 WHEN 2 THEN 503 WHEN 3 THEN 401 WHEN 4 THEN 429 ELSE 200 END AS INT) AS api_status,
               CAST(CASE WHEN k % 2 = 0 THEN 404 ELSE 502 END AS INT) AS upstream_status,
               k % 3 <> 0 AS retryable,
               CAST(CASE WHEN k % 4 = 0 THEN k END AS INT) AS retry_after,
               k % 50 = 0 AS never_received
        FROM crawl_log WHERE error_code IS NOT NULL""",
    # requests behind the log
    "requests": """
        SELECT event_id AS request_id, url, crawler_uuid, CAST(k % 6 AS INT) AS retry_times, CAST(k % 3 AS INT) AS priority,
               k % 2 = 0 AS cache,
               CAST(FLOOR(event_id / 50) AS BIGINT) AS batch_id, CAST(event_id % 50 AS INT) AS idx,
               'c' || CAST(event_id % 50 AS VARCHAR(20)) AS correlation_id,
               'cfg' || CAST(event_id AS VARCHAR(20)) AS config
        FROM crawl_log""",
    "batch_results": """
        SELECT CAST(FLOOR(event_id / 50) AS BIGINT) AS batch_id,
               CASE WHEN k % 10 = 0 THEN 'lost' ELSE 'c' || CAST(event_id % 50 AS VARCHAR(20)) END AS correlation_id,
               (event_id * 7919) % 1000003 AS arrival_seq, event_id AS result_id
        FROM crawl_log""",
    # one poll of the crawl state per day and crawl
    "status_polls": """
        SELECT crawler_uuid, polled_at, urls_visited, urls_extracted,
               CASE bucket WHEN 0 THEN 'DONE' WHEN 1 THEN 'RUNNING' WHEN 2 THEN 'DONE' WHEN 3 THEN 'CANCELLED' ELSE 'PENDING' END AS status,
               CASE bucket WHEN 0 THEN TRUE WHEN 2 THEN FALSE END AS is_success
        FROM (SELECT crawler_uuid, MAX(ts) AS polled_at, CAST(MAX(k) AS INT) % 5 AS bucket,
                     CAST(SUM(CASE WHEN event = 'crawler_url_visited' THEN 1 ELSE 0 END) AS BIGINT) AS urls_visited,
                     CAST(SUM(CASE WHEN event <> 'crawler_url_failed' THEN 1 ELSE 0 END) AS BIGINT) AS urls_extracted
              FROM crawl_log GROUP BY crawler_uuid, CAST(ts AS DATE)) AS p""",
    # a link graph over the pages: a tree with shortcuts, one per crawl
    "page_graph": """
        SELECT a.crawler_uuid, a.url AS source_url, b.url AS target_url
        FROM (SELECT CAST(page_id % 5 AS VARCHAR(10)) AS crawler_uuid, url,
                     CAST(page_id % 5 + 5 * (CAST(FLOOR(page_id / 5) AS BIGINT) * 2 + k) AS BIGINT) AS next_id
              FROM (SELECT 1 AS k, page_id, url FROM pages UNION ALL SELECT 2, page_id, url FROM pages
                    UNION ALL SELECT 4, page_id, url FROM pages) AS c) AS a
        JOIN pages AS b ON b.page_id = a.next_id""",
    "page_seeds": "SELECT CAST(page_id % 5 AS VARCHAR(10)) AS crawler_uuid, url FROM pages WHERE page_id < 5",
    # every page redirects: chains of up to twenty hops to a target outside, some of them loops
    "redirect_hops": """
        SELECT a.from_url, COALESCE('#' || CAST(b.page_id AS VARCHAR(20)) || ' ' || b.url, 'https://gone.example/' || CAST(a.page_id AS VARCHAR(20))) AS to_url
        FROM (SELECT '#' || CAST(page_id AS VARCHAR(20)) || ' ' || url AS from_url, page_id,
                     CASE WHEN page_id % 40 = 9 THEN page_id - 3 WHEN page_id % 20 = 15 THEN -1 ELSE page_id + 1 END AS next_id
              FROM pages) AS a
        LEFT JOIN pages AS b ON b.page_id = a.next_id""",
}


def with_views() -> str:
    return "WITH RECURSIVE " + ", ".join(f"{name} AS ({text})" for name, text in VIEWS.items())


def needed_views(name: str) -> list[str]:
    """The view and those it reads, in order."""
    out: list[str] = []

    def visit(view: str) -> None:
        for other in VIEWS:
            if other != view and f" {other}" in VIEWS[view].replace("\n", " "):
                visit(other)
        if view not in out:
            out.append(view)

    visit(name)
    return out


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the given tables as a DataFrame."""
    ctes = ", ".join(f"{v} AS ({VIEWS[v]})" for v in needed_views(name))
    raw = "pages AS (SELECT * FROM {raw_pages}), events AS (SELECT * FROM {raw_events})"
    pages, events = table(spark, sf_dir, "pages"), table(spark, sf_dir, "events")
    return spark.sql(f"WITH {raw}, {ctes} SELECT * FROM {name}", raw_pages=pages, raw_events=events)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` starts with SELECT, or with ``, name AS (...)`` to add to the views."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = f"{with_views()} {oracle.strip()}"
        return fn

    return register
