"""Predicates, lookups and scalar functions over crawled pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlweave.functions import errors as E, http, signing, urls
from crawlweave.operators import filters, guards, joins, stats, text
from crawlweave.plans.registry import query, view
from crawlweave.session import table


@query(
    "stats_by_country",
    """SELECT country, COUNT(*) AS total_requests, ROUND(AVG(duration), 9) AS avg_duration,
              COUNT(CASE WHEN status_code = 200 THEN 1 END) AS success_count
       FROM crawl_pages GROUP BY country""",
)
def stats_by_country(spark, sf):
    out = stats.stats_by(view(spark, sf, "crawl_pages"), "country")
    return out.withColumn("avg_duration", F.round("avg_duration", 9))


@query("pages_with_status", "SELECT page_id, url FROM crawl_pages WHERE status_code = 404")
def pages_with_status(spark, sf):
    return filters.filter_status(view(spark, sf, "crawl_pages"), 404).select("page_id", "url")


@query(
    "pages_of_content_type",
    "SELECT page_id, content_type FROM crawl_pages WHERE contains(lower(content_type), 'text/html')",
)
def pages_of_content_type(spark, sf):
    return filters.filter_content_type(view(spark, sf, "crawl_pages"), "TEXT/html").select("page_id", "content_type")


@query(
    "read_one_url",
    """SELECT url, record_seq, status_code, log_id, country FROM archive_records
       WHERE url = (SELECT MAX(url) FROM archive_records) ORDER BY record_seq LIMIT 1""",
)
def read_one_url(spark, sf):
    records = view(spark, sf, "archive_records")
    wanted = records.agg(F.max("url")).first()[0]
    return filters.read_url(records, wanted).select("url", "record_seq", "status_code", "log_id", "country")


@query(
    "pages_matching_glob",
    """SELECT page_id, url FROM crawl_pages
       WHERE regexp_matches(url, '^https://[^/]*.*\\.example\\.[a-z].*/[e-f][^x]/[1-5].*$')""",
)
def pages_matching_glob(spark, sf):
    pages = view(spark, sf, "crawl_pages")
    return filters.filter_url_pattern(pages, "https://*.example.[a-z]*/[e-f][!x]/[1-5]*").select("page_id", "url")


@query(
    "pages_by_path_rules",
    """SELECT page_id, url, 'include' AS mode FROM crawl_pages
       WHERE regexp_matches(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '^(/en/.*|/fr/.*\\.html)$')
       UNION ALL
       SELECT page_id, url, 'exclude' FROM crawl_pages
       WHERE NOT regexp_matches(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '^(/en/.*|.*/)$')
          OR url = (SELECT MIN(url) FROM crawl_pages)""",
)
def pages_by_path_rules(spark, sf):
    pages = view(spark, sf, "crawl_pages").select("page_id", "url")
    seed = pages.agg(F.min("url")).first()[0]
    kept = filters.filter_paths(pages, include=["/en/*", "/fr/*.html"]).withColumn("mode", F.lit("include"))
    left = filters.filter_paths(pages, exclude=["/en/*", "*/"], seed=seed).withColumn("mode", F.lit("exclude"))
    return kept.unionByName(left)


PAGE_LINKS = """, page_links AS (
    SELECT url AS source_url, UNNEST(range(len(hrefs))) AS position, UNNEST(hrefs) AS href
    FROM (SELECT url, regexp_extract_all(content, '<a href="([^"]*)"', 1) AS hrefs FROM crawl_pages) AS h),
absolute_links AS (
    SELECT source_url, position, href,
           CASE WHEN href LIKE '/%' THEN regexp_extract(source_url, '^([a-z]+://[^/]+)', 1) || href ELSE href END AS target_url
    FROM page_links)"""


@query("page_links", PAGE_LINKS + " SELECT source_url, position, href, target_url FROM absolute_links")
def page_links(spark, sf):
    return text.extract_links(view(spark, sf, "crawl_pages"))


@query(
    "links_in_scope",
    """, candidate_links AS (
         SELECT a.url AS source_url, b.url AS href FROM crawl_pages a JOIN crawl_pages b ON b.page_id = a.page_id + 1),
       parts AS (
         SELECT *, regexp_extract(source_url, '^[a-z]+://([^/?#]*)', 1) AS h0, regexp_extract(href, '^[a-z]+://([^/?#]*)', 1) AS h1,
                regexp_extract(href, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS p1 FROM candidate_links)
       SELECT source_url, href,
              CASE WHEN h1 = 'spam-farm.example.org' THEN CASE WHEN p1 = '/en' OR p1 LIKE '/en/%' THEN 'internal' ELSE 'out' END
                   WHEN h1 LIKE '%.spam-farm.example.org' THEN 'subdomain'
                   WHEN h1 LIKE '%.example.net' THEN 'external' ELSE 'out' END AS scope,
              (h0 = 'spam-farm.example.org' OR h0 LIKE '%.spam-farm.example.org') AND
              CASE WHEN h1 = 'spam-farm.example.org' THEN p1 = '/en' OR p1 LIKE '/en/%'
                   ELSE h1 LIKE '%.spam-farm.example.org' OR h1 LIKE '%.example.net' END AS follow
       FROM parts""",
)
def links_in_scope(spark, sf):
    pages = view(spark, sf, "crawl_pages")
    after = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("href"))
    links = pages.select("page_id", F.col("url").alias("source_url")).join(after, "page_id")
    scoped = filters.scope_links(
        links, "https://spam-farm.example.org/en/", follow_external_links=True, allowed_external_domains=["*.example.net"]
    )
    return scoped.select("source_url", "href", "scope", "follow")


@query(
    "page_links_in_scope",
    PAGE_LINKS
    + """, parts AS (SELECT source_url, position, target_url, regexp_extract(source_url, '^[a-z]+://([^/?#]*)', 1) AS h0, regexp_extract(target_url, '^[a-z]+://([^/?#]*)', 1) AS h1 FROM absolute_links)
       SELECT source_url, position, target_url,
              CASE WHEN h1 LIKE '%.example.com' THEN 'subdomain' WHEN h1 LIKE '%.example.net' THEN 'external' ELSE 'out' END AS scope, h0 LIKE '%.example.com' AS follow FROM parts""",
)
def page_links_in_scope(spark, sf):
    """Scope of the links that the pages have."""
    links = text.extract_links(view(spark, sf, "crawl_pages")).withColumnRenamed("href", "as_written").withColumn("href", F.col("target_url"))
    scoped = filters.scope_links(links, "https://example.com/", follow_external_links=True, allowed_external_domains=["*.example.net"])
    return scoped.select("source_url", "position", "target_url", "scope", "follow")


@query(
    "page_result_flags",
    """SELECT page_id, status_code BETWEEN 200 AND 299 AS success, status_code >= 400 AS error,
              'https://log/' || crawler_uuid AS log_url FROM crawl_pages""",
)
def page_result_flags(spark, sf):
    pages = view(spark, sf, "crawl_pages").withColumn("log_id", F.col("crawler_uuid"))
    return filters.result_flags(pages, log_base="https://log/").select("page_id", "success", "error", "log_url")


@query(
    "crawl_status_flags",
    """SELECT crawler_uuid, CAST(polled_at AS VARCHAR) AS at, status,
              status = 'DONE' AND COALESCE(is_success, FALSE) AS is_complete, status IN ('PENDING', 'RUNNING') AS is_running,
              status = 'DONE' AND COALESCE(NOT is_success, FALSE) AS is_failed, status = 'CANCELLED' AS is_cancelled,
              ROUND(CASE WHEN urls_extracted = 0 THEN 0 ELSE urls_visited * 100.0 / urls_extracted END, 6) AS progress_pct
       FROM (SELECT * REPLACE (strftime(polled_at, '%Y-%m-%d %H:%M:%S') AS polled_at) FROM status_polls)""",
)
def crawl_status_flags(spark, sf):
    polls = view(spark, sf, "status_polls")
    return filters.crawl_status_flags(polls).select(
        "crawler_uuid",
        F.date_format("polled_at", "yyyy-MM-dd HH:mm:ss").alias("at"),
        "status",
        "is_complete",
        "is_running",
        "is_failed",
        "is_cancelled",
        F.round("progress_pct", 6).alias("progress_pct"),
    )


@query(
    "usage_and_quota",
    """SELECT event_id, CAST(k % 12 AS BIGINT) AS remaining_quota, api_credit AS cost, ROUND(duration * 1000, 3) AS duration_ms,
              k % 12 = 0 AS quota_exhausted FROM crawl_log""",
)
def usage_and_quota(spark, sf):
    log = view(spark, sf, "crawl_log").select(
        "event_id",
        F.create_map(
            F.lit("X-Vendor-Remaining-Api-Credit"), (F.col("k") % 12).cast("string"),
            F.lit("X-Vendor-Api-Cost"), F.col("api_credit").cast("string"),
            F.lit("x-vendor-response-time"), (F.col("duration") * 1000).cast("string"),
        ).alias("headers"),
    )
    return filters.usage_columns(log).select(
        "event_id", "remaining_quota", "cost", F.round("duration_ms", 3).alias("duration_ms"), "quota_exhausted"
    )


@query(
    "item_validity",
    """SELECT page_id, title IS NOT NULL AND link IS NOT NULL AS is_valid,
              CASE WHEN title IS NULL AND link IS NULL THEN 'title,link' WHEN title IS NULL THEN 'title'
                   WHEN link IS NULL THEN 'link' ELSE '' END AS missing
       FROM (SELECT page_id, NULLIF(regexp_extract(content, '<title>([^<]*)<', 1), '') AS title,
                    NULLIF(regexp_extract(url, '(http://.*)', 1), '') AS link FROM crawl_pages) AS i""",
)
def item_validity(spark, sf):
    blank_null = lambda c: F.when(c != "", c)
    items = view(spark, sf, "crawl_pages").select(
        "page_id",
        blank_null(F.regexp_extract("content", "<title>([^<]*)<", 1)).alias("title"),
        blank_null(F.regexp_extract("url", "(http://.*)", 1)).alias("link"),
    )
    return filters.mark_valid(items, ["title", "link"]).select("page_id", "is_valid", "missing")


REQUEST_CASES = """
    SELECT event_id AS request_id, CAST(FLOOR(event_id / 120) AS BIGINT) AS batch_id,
           CASE WHEN k = 7 THEN '' ELSE 'c' || CAST(event_id % 110 AS VARCHAR(20)) END AS correlation_id,
           CASE WHEN k % 4 = 0 THEN 'body' END AS body, CASE WHEN k % 6 = 0 THEN 'data' END AS data,
           CASE WHEN k % 5 = 0 THEN '' ELSE url END AS url, CASE WHEN k % 9 = 0 THEN 'list' END AS url_list,
           CAST(NULL AS VARCHAR(10)) AS remote_url_list,
           CASE WHEN k % 8 = 0 THEN 't' END AS template, CASE WHEN k % 16 = 0 THEN 'i' END AS inline_template
    FROM crawl_log"""


@query(
    "request_violations",
    f""", r AS ({REQUEST_CASES}),
    sources AS (SELECT request_id, CASE WHEN url <> '' THEN 1 ELSE 0 END + CASE WHEN url_list IS NOT NULL THEN 1 ELSE 0 END AS n FROM r)
    SELECT request_id, 'missing_correlation_id' AS rule, '422' AS code FROM r WHERE correlation_id = ''
    UNION ALL SELECT request_id, 'body_and_data', '400' FROM r WHERE body IS NOT NULL AND data IS NOT NULL
    UNION ALL SELECT request_id, 'template_and_inline_template', '400' FROM r WHERE template IS NOT NULL AND inline_template IS NOT NULL
    UNION ALL SELECT request_id, 'no_url_source', '400' FROM sources WHERE n = 0
    UNION ALL SELECT request_id, 'several_url_sources', '400' FROM sources WHERE n > 1
    UNION ALL SELECT request_id, 'reused_correlation_id', '422' FROM (
        SELECT request_id, ROW_NUMBER() OVER (PARTITION BY batch_id, correlation_id ORDER BY request_id) AS rn FROM r WHERE correlation_id <> '') AS d WHERE rn > 1
    UNION ALL SELECT MIN(request_id), 'batch_too_large', '400' FROM r GROUP BY batch_id HAVING COUNT(*) > 100""",
)
def request_violations(spark, sf):
    view(spark, sf, "crawl_log").createOrReplaceTempView("crawl_log")
    return filters.validate_requests(spark.sql(REQUEST_CASES))


@query(
    "content_kinds",
    """SELECT CASE WHEN contains(content_type, 'text/html') THEN 'html' WHEN contains(content_type, 'application/xml') THEN 'xml'
                   ELSE 'text' END AS kind, COUNT(*) AS pages FROM crawl_pages GROUP BY 1""",
)
def content_kinds(spark, sf):
    return filters.content_kind(view(spark, sf, "crawl_pages")).groupBy("kind").agg(F.count(F.lit(1)).alias("pages"))


@query(
    "blocked_pages",
    """SELECT page_id, COALESCE(antibot IS NOT NULL, FALSE) AS blocked, antibot, 1 AS cost
       FROM (SELECT page_id, CASE WHEN status_code = 500 AND crawler_uuid = '1' THEN 'wall'
                                  WHEN status_code IN (404, 500) THEN 'gate'
                                  WHEN regexp_matches(content, '(?i)class="ad"') AND country = 'FR' THEN 'banner' END AS antibot FROM crawl_pages) AS b""",
)
def blocked_pages(spark, sf):
    pages = view(spark, sf, "crawl_pages").withColumn(
        "headers", F.create_map(F.lit("server"), F.concat(F.lit("edge-"), "crawler_uuid"), F.lit("x-country"), F.col("country"))
    )
    rules = [
        filters.BlockRule("wall", statuses=(500,), headers={"Server": "^edge-1$"}),
        filters.BlockRule("gate", statuses=(404, 500)),
        filters.BlockRule("banner", headers={"X-Country": "^FR$"}, body='(?i)class="ad"'),
    ]
    return filters.detect_blocked(pages, rules).select("page_id", "blocked", "antibot", "cost")


@query(
    "blocked_pages_by_table",
    """, words AS (SELECT page_id, status_code, crawler_uuid, country, ' ' || trim(regexp_replace(lower(content), '[^a-z0-9]+', ' ', 'g')) || ' ' AS w FROM crawl_pages),
    first AS (SELECT page_id, CASE WHEN status_code = 500 AND crawler_uuid = '1' THEN 'wall'
                                   WHEN contains(w, ' div class ad ') AND country = 'FR' THEN 'banner'
                                   WHEN status_code IN (404, 500) AND CAST(crawler_uuid AS INT) % 2 = 0 THEN 'host ' || crawler_uuid
                                   WHEN contains(w, ' track ') AND status_code = 301 THEN 'tracker' END AS antibot FROM words)
    SELECT page_id, TRUE AS valid_input, antibot IS NOT NULL AS blocked, antibot, 1 AS cost FROM first""",
)
def blocked_pages_by_table(spark, sf):
    """Rules as a table, some of them made from the crawls that there are."""
    pages = view(spark, sf, "crawl_pages").withColumn("headers", F.create_map(F.lit("Server"), F.concat(F.lit("edge-"), "crawler_uuid"), F.lit("x-country"), F.col("country")))
    schema = "rule_ord int, vendor string, statuses array<int>, headers map<string,string>, body string"
    fixed = [
        (1, "wall", [500], {"server": "edge-1"}, None),
        (2, "banner", [], {"X-Country": "FR"}, '<div class="ad">'),
        (1000, "tracker", [301], {}, "Track("),
        (1001, "asks nothing", [], {}, ""),
    ]
    number = F.col("crawler_uuid").cast("int")
    made = pages.select("crawler_uuid").distinct().filter(number % 2 == 0).select(
        (number + 10).alias("rule_ord"), F.concat(F.lit("host "), "crawler_uuid").alias("vendor"), F.array(F.lit(404), F.lit(500)).alias("statuses"),
        F.create_map(F.lit("SERVER"), F.concat(F.lit("edge-"), "crawler_uuid")).alias("headers"), F.lit(None).cast("string").alias("body"),
    )
    rules = spark.createDataFrame(fixed, schema).unionByName(made)
    return filters.detect_blocked_by(pages, rules)


# --- duplicates, batches, paging -------------------------------------------------------------


@query(
    "last_record_per_url",
    """SELECT url, MAX(record_seq) AS record_seq, MAX_BY(status_code, record_seq) AS status_code, MAX_BY(log_id, record_seq) AS log_id
       FROM archive_records GROUP BY url""",
)
def last_record_per_url(spark, sf):
    records = view(spark, sf, "archive_records").select("url", "path", "record_seq", "status_code", "log_id")
    return joins.dedupe_records(records, "last").select("url", "record_seq", "status_code", "log_id")


@query(
    "first_record_per_url",
    """SELECT url, MIN(record_seq) AS record_seq, MIN_BY(status_code, record_seq) AS status_code FROM archive_records GROUP BY url""",
)
def first_record_per_url(spark, sf):
    records = view(spark, sf, "archive_records").select("url", "path", "record_seq", "status_code")
    return joins.dedupe_records(records, "first").select("url", "record_seq", "status_code")


@query("distinct_urls", "SELECT url, MIN(record_seq) AS first_seq FROM archive_records WHERE url <> '' GROUP BY url")
def distinct_urls(spark, sf):
    return stats.distinct_urls(view(spark, sf, "archive_records"))


@query(
    "page_batches",
    """SELECT page_id, crawler_uuid, CAST(FLOOR((ROW_NUMBER() OVER (PARTITION BY crawler_uuid ORDER BY page_id) - 1) / 7) AS BIGINT) AS batch
       FROM crawl_pages""",
)
def page_batches(spark, sf):
    pages = view(spark, sf, "crawl_pages").select("page_id", "crawler_uuid")
    return guards.assign_batches(pages, size=7, bucket=F.floor(F.col("page_id") / 64)).select("page_id", "crawler_uuid", "batch")


@query("url_list_page", "SELECT url FROM crawl_pages WHERE status_code = 200 ORDER BY url LIMIT 25 OFFSET 25")
def url_list_page(spark, sf):
    pages = view(spark, sf, "crawl_pages").select(
        "url", F.when(F.col("status_code") == 200, "visited").otherwise("failed").alias("status")
    )
    return guards.url_list_page(pages, page=2, per_page=25).select("url")


@query(
    "url_list_pages",
    """, n AS (SELECT url, CAST(FLOOR((ROW_NUMBER() OVER (ORDER BY url, page_id) - 1) / 20) AS INT) + 1 AS page FROM crawl_pages WHERE status_code = 200),
       last AS (SELECT MAX(page) AS last FROM n)
       SELECT page, url FROM n, last WHERE page = 1 OR page = CAST(FLOOR(last / 2) AS INT) + 1 OR page = last""",
)
def url_list_pages(spark, sf):
    """The first, a deep and the last page of one list that is laid out once."""
    pages = view(spark, sf, "crawl_pages").filter("status_code = 200").select("url", "page_id")
    ranked = guards.RankedList(pages, ["url", "page_id"])
    last = -(-ranked.rows.count() // 20)
    out = [ranked.page(n, 20).select(F.lit(n).alias("page"), "url") for n in sorted({1, last // 2 + 1, last})]
    union = out[0]
    for more in out[1:]:
        union = union.unionByName(more)
    return union


@query(
    "slowest_requests",
    "SELECT url, duration FROM crawl_pages WHERE duration > 5 ORDER BY duration DESC, url LIMIT 10",
)
def slowest_requests(spark, sf):
    return stats.slowest(view(spark, sf, "crawl_pages").select("url", "duration"))


@query(
    "artifact_url_overlap",
    """, l AS (SELECT DISTINCT url FROM archive_records), r AS (SELECT DISTINCT url FROM crawl_pages)
       SELECT (SELECT COUNT(*) FROM l WHERE url IN (SELECT url FROM r)) AS both,
              (SELECT COUNT(*) FROM l WHERE url NOT IN (SELECT url FROM r)) AS only_left,
              (SELECT COUNT(*) FROM r WHERE url NOT IN (SELECT url FROM l)) AS only_right""",
)
def artifact_url_overlap(spark, sf):
    return stats.artifact_overlap(view(spark, sf, "archive_records"), view(spark, sf, "crawl_pages"))


@query(
    "geo_variation",
    """SELECT url, COUNT(DISTINCT content) AS variants, string_agg(DISTINCT country, ',' ORDER BY country) AS countries,
              COUNT(DISTINCT content) > 1 AS varies
       FROM (SELECT regexp_extract(url, '^([a-z]+://[^/]+)', 1) AS url, country, content FROM crawl_pages) AS g GROUP BY url""",
)
def geo_variation(spark, sf):
    pages = view(spark, sf, "crawl_pages").withColumn("url", F.regexp_extract("url", urls.ORIGIN, 1))
    return stats.geo_variation(pages).withColumn("countries", F.array_join("countries", ","))


# --- scalar functions ------------------------------------------------------------------------

URL_VARIANTS = """
    SELECT page_id, url,
           CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN origin || '/.' || rest WHEN 2 THEN origin || '/x/..' || rest
                WHEN 3 THEN UPPER(origin) || rest WHEN 4 THEN '  ' || url || ' '
                ELSE regexp_extract(url, '^([^?#]*)', 1) || '?utm_source=mail&sid=' || CAST(page_id AS VARCHAR(20)) || '#part' END AS variant
    FROM (SELECT page_id, url, regexp_extract(url, '^([a-z]+://[^/]+)', 1) AS origin, regexp_extract(url, '^[a-z]+://[^/]+(.*)$', 1) AS rest
          FROM pages) AS v"""


@query(
    "normalized_urls",
    f""", v AS ({URL_VARIANTS})
    SELECT page_id, rtrim(regexp_extract(url, '^([^?#]*)', 1), '/') ||
           CASE WHEN page_id % 6 <> 5 AND contains(url, '?page=2&ref=x') THEN '?page=2&ref=x' ELSE '' END AS normalized
    FROM v""",
)
def normalized_urls(spark, sf):
    variants = spark.sql(f"WITH pages AS (SELECT * FROM {{raw}}) {URL_VARIANTS}", raw=table(spark, sf, "pages"))
    cleaned = urls.normalize_url(F.col("variant"), drop_params=("utm_source", "sid"))
    return variants.select("page_id", cleaned.alias("normalized"))


@query(
    "parsed_content_types",
    """SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'application/xml' ELSE 'text/html' END AS mime,
              CASE WHEN page_id % 7 <> 0 THEN 'utf-8' END AS charset, CAST(page_id AS VARCHAR) AS boundary FROM crawl_pages""",
)
def parsed_content_types(spark, sf):
    value = F.concat(F.upper("content_type"), F.lit('; Boundary="'), F.col("page_id").cast("string"), F.lit('"; flag'))
    parsed = view(spark, sf, "crawl_pages").select("page_id", http.parse_content_type(value).alias("c"))
    return parsed.select(
        "page_id", "c.mime", F.lower(F.col("c.params")["charset"]).alias("charset"), F.col("c.params")["boundary"].alias("boundary")
    )


HTTP_HEADS = """
    SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'HTTP/2 ' WHEN 1 THEN 'HTTP/1.1 ' ELSE 'SPDY ' END
           || CAST(status_code AS VARCHAR(5)) || ' OK' || eol || 'Server: one' || eol || 'X-Url: ' || url || eol || 'no colon' || eol || 'Server:two ' AS head
    FROM (SELECT *, CASE WHEN page_id % 2 = 0 THEN chr(13) || chr(10) ELSE chr(10) END AS eol FROM crawl_pages) AS h"""


@query(
    "parsed_http_heads",
    """SELECT page_id, CASE WHEN page_id % 3 <> 2 THEN status_code END AS status_code, 'two' AS server, url AS x_url, 2 AS headers FROM crawl_pages""",
)
def parsed_http_heads(spark, sf):
    view(spark, sf, "crawl_pages").createOrReplaceTempView("crawl_pages")
    parsed = spark.sql(HTTP_HEADS).select("page_id", http.parse_http_head(F.col("head")).alias("h"))
    headers = F.col("h.headers")
    return parsed.select(
        "page_id", "h.status_code", headers["Server"].alias("server"), headers["X-Url"].alias("x_url"), F.size(headers).alias("headers")
    )


MIMES = "CASE page_id % 6 WHEN 0 THEN 'text/markdown' WHEN 1 THEN 'text/plain' WHEN 2 THEN 'text/html; q=1' WHEN 3 THEN 'application/ld+JSON' WHEN 4 THEN 'image/png' ELSE content_type END"


@query(
    "formats_of_mimes",
    f"""SELECT page_id, CASE WHEN m LIKE '%markdown%' THEN 'markdown' WHEN m LIKE '%plain%' THEN 'text' WHEN m LIKE '%html%' THEN 'html'
                             WHEN m LIKE '%json%' THEN 'json' END AS format
        FROM (SELECT page_id, lower({MIMES}) AS m FROM crawl_pages) AS t""",
)
def formats_of_mimes(spark, sf):
    pages = view(spark, sf, "crawl_pages").withColumn("mime", F.expr(MIMES))
    return pages.select("page_id", http.format_of_mime(F.col("mime")).alias("format"))


MAGIC = "CASE event_id % 7 WHEN 0 THEN '1F8B0800' WHEN 1 THEN '28B52FFD' WHEN 2 THEN '789C0102' WHEN 3 THEN '7802' WHEN 4 THEN '1F' WHEN 5 THEN '22B52FFD00' ELSE '48545450' END"


@query(
    "compression_formats",
    f"""SELECT event_id, CASE WHEN m LIKE '1F8B%' THEN 'gzip' WHEN m LIKE '28B52FFD%' OR m LIKE '22B52FFD%' THEN 'zstd' WHEN m LIKE '789C%' THEN 'deflate' END AS compression
        FROM (SELECT event_id, {MAGIC} AS m FROM crawl_log) AS t""",
)
def compression_formats(spark, sf):
    log = view(spark, sf, "crawl_log").withColumn("content", F.unhex(F.expr(MAGIC)))
    return log.select("event_id", http.detect_compression(F.col("content")).alias("compression"))


TIMES = "CASE k % 4 WHEN 0 THEN substr(CAST(ts AS VARCHAR(30)), 1, 19) WHEN 1 THEN substr(CAST(ts AS VARCHAR(30)), 1, 19) || '.5' WHEN 2 THEN 'at ' || substr(CAST(ts AS VARCHAR(30)), 1, 19) || ' or later' ELSE substr(CAST(ts AS VARCHAR(30)), 1, 10) END"


@query(
    "parsed_api_timestamps",
    """SELECT event_id, CASE WHEN k % 4 = 0 THEN CAST(epoch(date_trunc('second', ts)) AS BIGINT) END AS seconds FROM crawl_log""",
)
def parsed_api_timestamps(spark, sf):
    log = view(spark, sf, "crawl_log").withColumn("text", F.expr(TIMES))
    return filters.parse_api_timestamps(log, ["text"]).select("event_id", F.unix_seconds("text_ts").alias("seconds"))


@query(
    "error_code_parts",
    """SELECT event_id, CASE WHEN k % 3 = 0 THEN NULL ELSE split_part(error_code, '::', 2) END AS resource
       FROM crawl_log""",
)
def error_code_parts(spark, sf):
    log = view(spark, sf, "crawl_log")
    code = F.when(F.col("k") % 3 == 0, F.concat("error_code", F.lit("::EXTRA"))).otherwise(F.col("error_code"))
    return log.select("event_id", E.error_resource(code).alias("resource"))


@query(
    "error_messages",
    """SELECT request_id, '<-- ' || api_status || ' | ' || CASE WHEN request_id % 4 = 3 THEN '' ELSE error_code || ' - ' END || error_message || '.' ||
              CASE request_id % 4 WHEN 0 THEN ' Checkout the related doc: https://doc/a' WHEN 1 THEN ' Checkout the related doc: https://doc/b, https://doc/c' ELSE '' END AS message
       FROM failures""",
)
def error_messages(spark, sf):
    failures = view(spark, sf, "failures")
    turn = F.col("request_id") % 4
    links = F.when(turn == 0, '{"Doc": "https://doc/a", "More": "https://doc/z"}').when(turn == 1, '["https://doc/b", "https://doc/c"]').otherwise("{}")
    code = F.when(turn != 3, F.col("error_code"))
    return failures.select("request_id", E.error_message(F.col("api_status"), code, F.col("error_message"), links).alias("message"))


SECRETS = ("first-secret", "k" * 80)


@query(
    "verified_signatures",
    """, padded AS (SELECT event_id, encode(url || event || event_id) AS body FROM crawl_log),
       pads AS (SELECT unhex(i) AS i, unhex(o) AS o FROM (VALUES (
         '__INNER__', '__OUTER__')) AS t(i, o))
       SELECT event_id, upper(sha256(o || unhex(sha256(i || body)))) AS digest, event_id % 3 <> 2 AS verified FROM padded, pads"""
    .replace("__INNER__", signing.pads(SECRETS[0])[0].hex())
    .replace("__OUTER__", signing.pads(SECRETS[0])[1].hex()),
)
def verified_signatures(spark, sf):
    log = view(spark, sf, "crawl_log")
    bodies = log.select("event_id", F.concat("url", "event", "event_id").alias("raw"))
    pairs = [signing.pads(s) for s in SECRETS]
    digest = lambda pair: signing.hmac_hex(F.col("raw").cast("binary"), F.lit(pair[0]), F.lit(pair[1]))
    signed = bodies.withColumn("digest", digest(pairs[0])).withColumn(
        "signature",
        F.when(F.col("event_id") % 3 == 0, F.col("digest")).when(F.col("event_id") % 3 == 1, digest(pairs[1])).otherwise(F.lower("digest")),
    )
    return signing.verify_signature(signed, SECRETS).select("event_id", "digest", "verified")
