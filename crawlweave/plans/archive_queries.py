"""Readers and writers checked by round trip: files are written from a table and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlweave.functions import html as H
from crawlweave.operators import filters, stats
from crawlweave.plans import fixtures
from crawlweave.plans.registry import query, view
from crawlweave.session import fresh_dir
from crawlweave.sinks import tables
from crawlweave.sources import har, payloads, warc

BODY = "content || chr(13) || chr(10) || 'WARC/1.0' || chr(13) || chr(10) || 'not a record'"


def warc_records(spark, sf, types=None):
    return warc.read_warc(spark, fixtures.write_warc(spark, view(spark, sf, "crawl_pages")), types)


@query(
    "warc_responses",
    f"""SELECT url, status_code, md5({BODY}) AS digest, content_type, 'two' AS twice, 'log-' || page_id AS log_id, country,
               CASE WHEN page_id % 11 <> 0 THEN duration END AS duration FROM crawl_pages""",
)
def warc_responses(spark, sf):
    w, h = F.col("warc_headers"), F.col("headers")
    return filters.responses(warc_records(spark, sf)).select(
        "url", "status_code", F.md5("content").alias("digest"), h["Content-Type"].alias("content_type"), h["X-Twice"].alias("twice"),
        w["WARC-Scrape-Log-Id"].alias("log_id"), w["WARC-Scrape-Country"].alias("country"), w["WARC-Scrape-Duration"].cast("double").alias("duration"),
    )


@query(
    "warc_record_types",
    """SELECT t.kind AS record_type, COUNT(*) AS records, COUNT(DISTINCT url) AS urls
       FROM crawl_pages, (VALUES ('response'), ('request'), ('conversion')) AS t(kind) GROUP BY t.kind""",
)
def warc_record_types(spark, sf):
    records = warc_records(spark, sf, ["response", "request", "conversion"])
    return records.groupBy("record_type").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("url").alias("urls"))


DAMAGED = "page_id % 10 IN (3, 6)"


@query(
    "rejected_warc_records",
    f"""SELECT 'no version line' AS reason, CASE WHEN page_id % 2 = 0 THEN 'plain' ELSE 'gzip' END AS form, COUNT(*) AS places
        FROM crawl_pages WHERE {DAMAGED} GROUP BY ALL""",
)
def rejected_warc_records(spark, sf):
    path = fixtures.write_warc(spark, view(spark, sf, "crawl_pages"), F.expr(DAMAGED))
    form = F.when(F.endswith("path", F.lit(".gz")), "gzip").otherwise("plain")
    rejects = warc.rejected_warc_records(spark, path, range_bytes=1 << 20)
    return rejects.groupBy("reason", form.alias("form")).agg(F.count(F.lit(1)).alias("places"))


@query(
    "warc_records_after_damage",
    f"""SELECT url, record_type, md5(CASE record_type WHEN 'response' THEN {BODY} ELSE 'GET ' || url || ' HTTP/1.1' || repeat(chr(13) || chr(10), 2) END) AS digest
        FROM crawl_pages, (VALUES ('response'), ('request')) AS t(record_type) WHERE NOT ({DAMAGED} AND record_type = 'response')""",
)
def warc_records_after_damage(spark, sf):
    """All records but the damaged ones, with small ranges, so that most archives are read by several tasks."""
    path = fixtures.write_warc(spark, view(spark, sf, "crawl_pages"), F.expr(DAMAGED))
    records = warc.read_warc(spark, path, ["response", "request"], range_bytes=1 << 20)
    return records.select("url", "record_type", F.md5("content").alias("digest"))


@query(
    "warc_one_url",
    f"""SELECT url, status_code, md5({BODY}) AS digest, 'log-' || page_id AS log_id, country, CASE WHEN page_id % 11 <> 0 THEN duration END AS duration
        FROM crawl_pages WHERE url = (SELECT MAX(url) FROM crawl_pages)""",
)
def warc_one_url(spark, sf):
    wanted = view(spark, sf, "crawl_pages").agg(F.max("url")).first()[0]
    page = filters.page_contents(filters.read_url(filters.responses(warc_records(spark, sf)), wanted))
    return page.select("url", "status_code", F.md5("content").alias("digest"), "log_id", "country", "duration")


@query(
    "har_entries",
    """SELECT url, 'GET' AS method, CASE WHEN page_id % 13 = 0 THEN 0 ELSE status_code END AS status_code, content_type, md5(content) AS digest,
              CAST(octet_length(encode(content)) AS BIGINT) AS content_size, ROUND(duration * 1000, 3) AS time, 'two' AS twice FROM crawl_pages""",
)
def har_entries(spark, sf):
    entries = har.read_har(spark, fixtures.write_har(spark, view(spark, sf, "crawl_pages")))
    return entries.select(
        "url", "method", "status_code", "content_type", F.md5("content").alias("digest"), "content_size", F.round("time", 3).alias("time"),
        F.col("headers")["X-Twice"].alias("twice"),
    )


HAR_ROWS = """SELECT url, CASE WHEN page_id % 13 = 0 THEN 0 ELSE status_code END AS status_code, content_type, md5(content) AS digest FROM crawl_pages"""


def har_digests(entries):
    return entries.select("url", "status_code", "content_type", F.md5("content").alias("digest"))


@query("har_nested_entries", HAR_ROWS)
def har_nested_entries(spark, sf):
    """Entries inside the log object, as the standard form has them."""
    return har_digests(har.read_har(spark, fixtures.write_har(spark, view(spark, sf, "crawl_pages"), nested=True)))


@query("har_with_status", f"SELECT * FROM ({HAR_ROWS}) AS h WHERE status_code = 404")
def har_with_status(spark, sf):
    entries = har.read_har(spark, fixtures.write_har(spark, view(spark, sf, "crawl_pages")))
    return har_digests(filters.filter_status(entries, 404))


@query("har_of_content_type", f"SELECT * FROM ({HAR_ROWS}) AS h WHERE contains(lower(content_type), 'xml')")
def har_of_content_type(spark, sf):
    entries = har.read_har(spark, fixtures.write_har(spark, view(spark, sf, "crawl_pages")))
    return har_digests(filters.filter_content_type(entries, "XML"))


@query("har_one_url", f"SELECT * FROM ({HAR_ROWS}) AS h WHERE url = (SELECT MIN(url) FROM crawl_pages)")
def har_one_url(spark, sf):
    pages = view(spark, sf, "crawl_pages")
    wanted = pages.agg(F.min("url")).first()[0]
    return har_digests(filters.read_url(har.read_har(spark, fixtures.write_har(spark, pages)), wanted))


@query(
    "har_logs",
    """SELECT '1.2' AS version, 'crawl-' || crawler_uuid AS creator, CAST(MAX(status_code) AS VARCHAR) AS creator_version, CAST(COUNT(*) AS INT) AS page_count
       FROM crawl_pages GROUP BY crawler_uuid, FLOOR(page_id / 1000)""",
)
def har_logs(spark, sf):
    logs = har.read_har_logs(spark, fixtures.write_har_archives(spark, view(spark, sf, "crawl_pages")))
    return logs.select("version", F.col("creator.name").alias("creator"), F.col("creator.version").alias("creator_version"), "page_count")


@query(
    "timing_breakdown",
    """, t AS (SELECT 'total' AS phase, duration * 1000 AS ms FROM crawl_pages UNION ALL SELECT 'wait', duration * 600 FROM crawl_pages
               UNION ALL SELECT 'receive', duration * 400 FROM crawl_pages)
       SELECT phase, COUNT(*) AS requests, ROUND(AVG(ms), 4) AS avg_ms, ROUND(quantile_cont(ms, 0.5), 4) AS median_ms FROM t GROUP BY phase""",
)
def timing_breakdown(spark, sf):
    entries = har.read_har(spark, fixtures.write_har(spark, view(spark, sf, "crawl_pages")))
    out = stats.timing_breakdown(entries)
    return out.withColumns({"avg_ms": F.round("avg_ms", 4), "median_ms": F.round("median_ms", 4)})


@query(
    "artifact_pages",
    f"""SELECT 'warc' AS source, url, status_code, md5({BODY}) AS digest FROM crawl_pages
        UNION ALL SELECT 'har', url, CASE WHEN page_id % 13 = 0 THEN 0 ELSE status_code END, md5(content) FROM crawl_pages""",
)
def artifact_pages(spark, sf):
    entries = har.read_har(spark, fixtures.write_har(spark, view(spark, sf, "crawl_pages")))
    pages = har.artifact_pages(warc_records(spark, sf), entries)
    source = F.when(F.contains("path", F.lit("/warc-")), "warc").otherwise("har")
    return pages.select(source.alias("source"), "url", "status_code", F.md5("content").alias("digest"))


@query(
    "pages_as_parquet",
    f"""SELECT url, '<urn:uuid:' || page_id || '>' AS record_id, '2024-05-06 07:08:09' AS at, status_code, content_type,
               CAST(octet_length(encode({BODY})) AS INT) AS content_length, 'log-' || page_id AS log_id, country,
               ROUND(CASE WHEN page_id % 11 <> 0 THEN duration ELSE 0 END, 4) AS duration, retry_count FROM crawl_pages""",
)
def pages_as_parquet(spark, sf):
    path = fresh_dir(spark, "pages")
    tables.write_pages_parquet(tables.page_table(warc_records(spark, sf)), path)
    return spark.read.parquet(path).select(
        "url", "record_id", F.date_format(F.to_utc_timestamp("date", F.current_timezone()), "yyyy-MM-dd HH:mm:ss").alias("at"), F.col("status_code").cast("int").alias("status_code"), "content_type",
        "content_length", "log_id", "country", F.round(F.col("duration").cast("double"), 4).alias("duration"), F.col("retry_count").cast("int").alias("retry_count"),
    )


@query(
    "url_lists",
    """SELECT url, 'skipped' AS status, 'robots_txt' AS reason FROM crawl_pages WHERE page_id % 3 = 0
       UNION ALL SELECT url, 'skipped', NULL FROM crawl_pages WHERE page_id % 3 = 1
       UNION ALL SELECT url, 'skipped', NULL FROM crawl_pages WHERE page_id % 3 = 2
       UNION ALL SELECT url || ',x', 'visited', NULL FROM crawl_pages""",
)
def url_lists(spark, sf):
    pages = view(spark, sf, "crawl_pages")
    turn = F.col("page_id") % 3
    reason = F.when(turn == 0, ",robots_txt").when(turn == 1, ",").otherwise("")
    skipped = pages.select(F.concat(F.lit("  "), "url", reason, F.lit(" \r\n\n")).alias("value"))
    visited = pages.select(F.concat("url", F.lit(",x\t")).alias("value"))
    one = payloads.read_url_list(spark, fixtures.write_lines(spark, skipped, "skipped"), "skipped")
    two = payloads.read_url_list(spark, fixtures.write_lines(spark, visited, "visited"), "visited")
    return one.unionByName(two).select("url", "status", "reason")


@query(
    "scrape_results",
    """SELECT CASE WHEN page_id % 9 <> 8 THEN url END AS url, page_id % 9 = 8 AS is_api_error, CASE WHEN page_id % 9 = 8 THEN 'e' || page_id END AS error_id,
              CASE WHEN page_id % 9 <> 8 THEN status_code END AS upstream_status, page_id % 9 <> 8 AND status_code < 400 AS scrape_success,
              CASE WHEN page_id % 9 <> 8 AND page_id % 4 IN (0, 3) THEN md5(content) END AS text_digest, CASE WHEN page_id % 9 <> 8 AND page_id % 4 = 1 THEN md5(content) END AS bytes_digest,
              CASE WHEN page_id % 9 <> 8 AND page_id % 4 = 2 THEN 'ref://' || url END AS content_ref, CASE WHEN page_id % 9 <> 8 THEN content_type END AS content_type,
              CASE WHEN page_id % 9 <> 8 AND page_id % 2 = 0 THEN 'x' END AS accept, CASE WHEN page_id % 9 <> 8 AND status_code >= 400 THEN 'ERR::SCRAPE::BAD_UPSTREAM_RESPONSE' END AS error_code FROM crawl_pages""",
)
def scrape_results(spark, sf):
    path = fixtures.write_lines(spark, fixtures.scrape_result_lines(view(spark, sf, "crawl_pages")), "results")
    return payloads.read_scrape_results(spark, path).select(
        "url", "is_api_error", "error_id", "upstream_status", "scrape_success", F.md5("content").alias("text_digest"), F.md5("content_bytes").alias("bytes_digest"),
        "content_ref", F.col("response_headers")["content-type"].alias("content_type"), F.col("config_headers")["Accept"].alias("accept"), F.col("error.code").alias("error_code"),
    )


@query(
    "crawl_contents",
    """SELECT url, 'html' AS format, md5(content) AS digest FROM crawl_pages UNION ALL SELECT url, 'text', md5(country) FROM crawl_pages WHERE page_id % 3 = 0""",
)
def crawl_contents(spark, sf):
    path = fixtures.write_lines(spark, fixtures.contents_lines(view(spark, sf, "crawl_pages")), "contents")
    return payloads.read_crawl_contents(spark, path).select("url", "format", F.md5("content").alias("digest"))


ACCEPTED = "k NOT IN (11, 12, 13) AND NOT (event = 'crawler_url_failed' AND k = 17)"


@query(
    "crawl_events",
    f"""SELECT event, crawler_uuid, project, env, CAST(k AS BIGINT) AS urls_visited, stop_reason, CASE WHEN event IN ('crawler_url_visited', 'crawler_url_failed') THEN url END AS url,
               CASE WHEN event = 'crawler_url_visited' THEN '<p>' || url || '</p>' END AS html, CASE WHEN event = 'crawler_url_discovered' THEN 2 END AS discovered,
               CASE WHEN event = 'crawler_url_skipped' THEN 'page_limit' END AS skip_reason, CASE WHEN event = 'crawler_url_failed' THEN error_code END AS error, COUNT(*) AS n
        FROM crawl_log WHERE {ACCEPTED} GROUP BY ALL""",
)
def crawl_events(spark, sf):
    path = fixtures.write_lines(spark, fixtures.event_lines(view(spark, sf, "crawl_log")), "events")
    accepted, _ = payloads.read_crawl_events(spark, path)
    rows = accepted.select(
        "event", "crawler_uuid", "project", "env", F.col("state.urls_visited").alias("urls_visited"), F.col("state.stop_reason").alias("stop_reason"), "url",
        F.col("scrape.content")["html"].alias("html"), F.when(F.col("discovered_urls").isNotNull(), F.size("discovered_urls")).alias("discovered"),
        F.get(F.map_values("urls"), F.lit(0)).alias("skip_reason"), "error",
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "rejected_crawl_events",
    f"""SELECT CASE k WHEN 11 THEN 'unknown event' WHEN 12 THEN 'missing event' WHEN 13 THEN 'missing crawler_uuid' ELSE 'missing links.scrape' END AS reject_reason, COUNT(*) AS n
        FROM crawl_log WHERE NOT ({ACCEPTED}) GROUP BY 1""",
)
def rejected_crawl_events(spark, sf):
    path = fixtures.write_lines(spark, fixtures.event_lines(view(spark, sf, "crawl_log")), "events")
    _, rejected = payloads.read_crawl_events(spark, path)
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "crawl_status_payloads",
    """SELECT crawler_uuid, status, is_success, status IN ('DONE', 'CANCELLED') AS is_finished, urls_visited, urls_extracted, CAST(NULL AS VARCHAR) AS reject_reason, COUNT(*) AS n
       FROM status_polls WHERE urls_extracted <> 3 GROUP BY ALL
       UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'missing state.urls_skipped', COUNT(*) FROM status_polls WHERE urls_extracted = 3 HAVING COUNT(*) > 0""",
)
def crawl_status_payloads(spark, sf):
    path = fixtures.write_lines(spark, fixtures.status_lines(view(spark, sf, "status_polls")), "status")
    accepted, rejected = payloads.read_crawl_status(spark, path)
    rows = accepted.select("crawler_uuid", "status", "is_success", "is_finished", "urls_visited", "urls_extracted", F.lit(None).cast("string").alias("reject_reason"))
    lost = rejected.select("reject_reason")
    out = rows.unionByName(lost, allowMissingColumns=True)
    return out.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "extraction_results",
    """SELECT CASE page_id % 4 WHEN 0 THEN country END AS name, CASE page_id % 4 WHEN 1 THEN url END AS plain, CASE page_id % 4 WHEN 0 THEN 'application/json' WHEN 1 THEN 'text/plain' END AS content_type,
              page_id % 4 < 2 AS extraction_success, CASE WHEN page_id % 4 = 3 THEN 'e' || page_id END AS error_id, COUNT(*) AS n FROM crawl_pages GROUP BY ALL""",
)
def extraction_results(spark, sf):
    path = fixtures.write_lines(spark, fixtures.extraction_lines(view(spark, sf, "crawl_pages")), "extractions")
    rows = payloads.read_extractions(spark, path).select(
        F.try_variant_get("data", "$.name", "string").alias("name"),
        F.when(F.schema_of_variant("data") == "STRING", F.try_variant_get("data", "$", "string")).alias("plain"),
        "content_type", "extraction_success", "error_id",
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "sitemap_urls",
    """SELECT 'https://maps.example/map-' || CAST(FLOOR(page_id / 100) AS BIGINT) || '.xml' AS sitemap_url, 'https://maps.example/index-' || CAST(FLOOR(page_id / 100000) AS BIGINT) || '.xml' AS via_index, url AS loc, FALSE AS is_dead FROM crawl_pages
       UNION ALL SELECT DISTINCT 'https://maps.example/dead-' || CAST(FLOOR(page_id / 100000) AS BIGINT) || '.xml', 'https://maps.example/index-' || CAST(FLOOR(page_id / 100000) AS BIGINT) || '.xml', NULL, TRUE FROM crawl_pages""",
)
def sitemap_urls(spark, sf):
    path = fixtures.sitemap_files(spark, view(spark, sf, "crawl_pages").select("page_id", "url"))
    return payloads.read_sitemaps(spark, path, "https://maps.example")


@query(
    "text_only_results",
    """SELECT CASE WHEN page_id % 9 <> 8 AND page_id % 4 IN (0, 3) THEN 'parsed' ELSE 'refused' END AS outcome, COUNT(*) AS n FROM crawl_pages GROUP BY 1""",
)
def text_only_results(spark, sf):
    path = fixtures.write_lines(spark, fixtures.scrape_result_lines(view(spark, sf, "crawl_pages")), "results")
    parsed, refused = payloads.text_only(payloads.read_scrape_results(spark, path))
    both = parsed.select(F.lit("parsed").alias("outcome")).unionByName(refused.select(F.lit("refused").alias("outcome")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    "warc_page_titles",
    """SELECT url, regexp_extract(content, '<html lang="([^"]*)"', 1) AS lang FROM crawl_pages WHERE status_code = 200 AND url LIKE '%/en/%'""",
)
def warc_page_titles(spark, sf):
    """The read, filter and project path of a crawl: archive, responses, URL pattern, page fields."""
    records = filters.responses(warc_records(spark, sf))
    pages = filters.page_contents(filters.filter_url_pattern(filters.filter_status(records, 200), "*/en/*"))
    return pages.select("url", H.page_metadata(F.col("content"))["lang"].alias("lang"))
