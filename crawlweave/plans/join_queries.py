"""Joins and audits over pages and their links."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlweave.functions import urls
from crawlweave.operators import audits, filters, joins, text
from crawlweave.plans.page_queries import PAGE_LINKS
from crawlweave.plans.registry import query, view


def records_with_headers(spark, sf):
    """Archive records shaped as the WARC reader returns them."""
    named = F.map_filter(
        F.create_map(
            F.lit("WARC-Scrape-Duration"), F.col("duration_text"),
            F.lit("WARC-Scrape-Log-Id"), F.col("log_id"),
            F.lit("WARC-Scrape-Country"), F.col("country"),
        ),
        lambda k, v: v.isNotNull(),
    )
    return view(spark, sf, "archive_records").select(
        "url", "path", "record_seq", "status_code", F.create_map(F.lit("server"), F.col("log_id")).alias("headers"), named.alias("warc_headers")
    )


@query(
    "content_with_metadata",
    """, last AS (SELECT url, MAX(record_seq) AS seq FROM archive_records GROUP BY url)
       SELECT p.page_id, p.url, length(p.content) AS chars, COALESCE(r.status_code, 200) AS status_code, r.log_id AS server,
              CAST(r.duration_text AS DOUBLE) AS duration, r.log_id, r.country
       FROM crawl_pages p LEFT JOIN last l ON l.url = p.url LEFT JOIN archive_records r ON r.url = l.url AND r.record_seq = l.seq""",
)
def content_with_metadata(spark, sf):
    contents = view(spark, sf, "crawl_pages").select("page_id", "url", "content")
    out = joins.content_with_metadata(contents, records_with_headers(spark, sf))
    return out.select(
        "page_id", "url", F.length("content").cast("bigint").alias("chars"), "status_code", F.col("headers")["server"].alias("server"), "duration", "log_id", "country"
    )


@query(
    "content_with_first_metadata",
    """, first AS (SELECT url, MIN(record_seq) AS seq FROM archive_records GROUP BY url)
       SELECT p.page_id, COALESCE(r.status_code, 200) AS status_code, r.log_id
       FROM crawl_pages p LEFT JOIN first l ON l.url = p.url LEFT JOIN archive_records r ON r.url = l.url AND r.record_seq = l.seq""",
)
def content_with_first_metadata(spark, sf):
    contents = view(spark, sf, "crawl_pages").select("page_id", "url", "content")
    out = joins.content_with_metadata(contents, records_with_headers(spark, sf), keep="first")
    return out.select("page_id", "status_code", "log_id")


def contents_and_wanted(spark, sf):
    """Contents in three formats and a URL list that also names absent pages."""
    pages = view(spark, sf, "crawl_pages")
    rows = F.array(
        F.struct(F.lit("html").alias("format"), F.col("content")),
        F.struct(F.lit("text").alias("format"), F.when(F.col("status_code") == 200, F.col("url")).alias("content")),
        F.struct(F.lit("markdown").alias("format"), F.upper("url").alias("content")),
    )
    contents = pages.select("url", F.inline(rows))
    wanted = view(spark, sf, "archive_records").select("url")
    return contents, wanted


WANTED = ", wanted AS (SELECT DISTINCT url FROM archive_records)"


@query(
    "looked_up_urls",
    WANTED
    + """ SELECT url, CASE WHEN status_code = 200 THEN url END AS text, upper(url) AS markdown FROM crawl_pages WHERE url IN (SELECT url FROM wanted)""",
)
def looked_up_urls(spark, sf):
    return joins.lookup_urls(*contents_and_wanted(spark, sf), ["text", "markdown"])


@query(
    "lookup_report",
    WANTED
    + """, have AS (SELECT url FROM crawl_pages WHERE status_code = 200)
       SELECT COUNT(*) AS requested, COUNT(CASE WHEN url IN (SELECT url FROM have) THEN 1 END) AS found,
              COUNT(CASE WHEN url NOT IN (SELECT url FROM have) THEN 1 END) AS missing FROM wanted""",
)
def lookup_report(spark, sf):
    return joins.lookup_report(*contents_and_wanted(spark, sf), ["text"])


@query("missing_urls", WANTED + " SELECT url FROM wanted WHERE url NOT IN (SELECT url FROM crawl_pages WHERE status_code = 200)")
def missing_urls(spark, sf):
    return joins.missing_urls(*contents_and_wanted(spark, sf), ["text"])


@query(
    "matched_extraction_rules",
    """, p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM crawl_pages),
       m AS (SELECT page_id, CASE WHEN regexp_matches(path, '^/en/[0-9].*/$') THEN 0 WHEN path LIKE '/en/%' THEN 1
                                  WHEN path LIKE '/fr/%' OR path LIKE '/de/%.html' THEN CASE WHEN path LIKE '/fr/%' THEN 2 ELSE 3 END END AS rule_ord FROM p)
       SELECT page_id, rule_ord, CASE rule_ord WHEN 0 THEN '/en/*/' WHEN 1 THEN '/en/*' WHEN 2 THEN '/fr/*' WHEN 3 THEN '/de/*.html' END AS rule_pattern,
              CASE rule_ord WHEN 0 THEN 'model' WHEN 1 THEN 'prompt' WHEN 2 THEN 'template' WHEN 3 THEN 'model' END AS rule_type FROM m""",
)
def matched_extraction_rules(spark, sf):
    rules = [
        filters.ExtractionRule("/en/*/", "model", "product"),
        filters.ExtractionRule("/en/*", "prompt", "find the author"),
        filters.ExtractionRule("/fr/*", "template", "ephemeral:"),
        filters.ExtractionRule("/de/*.html", "model", "article"),
    ]
    pages = view(spark, sf, "crawl_pages").select("page_id", "url")
    return filters.match_rules(pages, rules).select("page_id", "rule_ord", "rule_pattern", "rule_type")


@query(
    "new_links",
    PAGE_LINKS
    + """ SELECT source_url, target_url, MIN(position % 3) AS rule_idx FROM absolute_links
          WHERE target_url NOT IN (SELECT target_url FROM absolute_links WHERE source_url = (SELECT MIN(source_url) FROM absolute_links))
          GROUP BY source_url, target_url""",
)
def new_links(spark, sf):
    links = text.extract_links(view(spark, sf, "crawl_pages")).withColumn("rule_idx", (F.col("position") % 3).cast("bigint"))
    first = links.agg(F.min("source_url")).first()[0]
    return joins.new_links(links, seen=links.filter(F.col("source_url") == first).select("target_url"))


@query(
    "media_requests",
    PAGE_LINKS + " SELECT source_url AS url, CAST(position AS INT) AS media_idx, href AS media_url FROM page_links",
)
def media_requests(spark, sf):
    pages = view(spark, sf, "crawl_pages")
    items = pages.select("url", F.regexp_extract_all("content", F.lit(text.ANCHOR), 1).alias("file_urls"))
    return joins.explode_media_requests(items)


ROBOTS = [("Disallow", "/en/"), ("Allow", "/en/1"), ("Disallow", "/*?page="), ("Disallow", "/fr/*.html$"), ("Disallow", "")]


def robots_of_hosts(pages):
    """The same rules for every host of the pages."""
    rules = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(path).alias("path")) for rule, path in ROBOTS])
    return pages.select(urls.host(F.col("url")).alias("host")).distinct().select("host", F.inline(rules))


@query(
    "robots_audit",
    """, t AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1) AS target FROM crawl_pages)
       SELECT page_id, CASE WHEN regexp_matches(target, '^/fr/.*\\.html$') THEN '/fr/*.html$' WHEN contains(target, '?page=') THEN '/*?page='
                            WHEN target LIKE '/en/1%' THEN '/en/1' WHEN target LIKE '/en/%' THEN '/en/' END AS matched_path,
              regexp_matches(target, '^/fr/.*\\.html$') OR contains(target, '?page=') OR (target LIKE '/en/%' AND target NOT LIKE '/en/1%') AS disallowed FROM t""",
)
def robots_audit(spark, sf):
    pages = view(spark, sf, "crawl_pages").select("page_id", "url")
    return audits.robots_audit(pages, robots_of_hosts(pages)).select("page_id", "matched_path", "disallowed")


@query(
    "nofollow_audit",
    """, marks AS (SELECT url, page_id % 5 = 0 AS meta, page_id % 7 = 0 AS header FROM crawl_pages),
       f AS (SELECT target_url, length(target_url) % 2 = 0 AS rel, meta, header FROM page_graph JOIN marks ON url = source_url)
       SELECT target_url, COUNT(CASE WHEN rel THEN 1 END) AS rel_links, COUNT(CASE WHEN meta THEN 1 END) AS meta_links, COUNT(CASE WHEN header THEN 1 END) AS header_links
       FROM f GROUP BY target_url
       HAVING COUNT(CASE WHEN NOT (rel OR meta OR header) THEN 1 END) = 0 AND target_url IN (SELECT url FROM crawl_pages WHERE status_code = 200)""",
)
def nofollow_audit(spark, sf):
    links = view(spark, sf, "page_graph").withColumn("rel", F.when(F.length("target_url") % 2 == 0, "noopener NoFollow"))
    pages = view(spark, sf, "crawl_pages").select(
        "url",
        F.when(F.col("page_id") % 5 == 0, "noindex, nofollow").alias("meta_robots"),
        F.when(F.col("page_id") % 7 == 0, "nofollow").alias("x_robots_tag"),
    )
    visits = filters.filter_status(view(spark, sf, "crawl_pages"), 200)
    return audits.nofollow_audit(audits.nofollow_flags(links, pages), visits)


@query(
    "crawl_depth",
    """, reach AS (
         SELECT crawler_uuid, url, 0 AS depth FROM page_seeds
         UNION
         SELECT g.crawler_uuid, g.target_url, r.depth + 1 FROM reach r JOIN page_graph g ON g.crawler_uuid = r.crawler_uuid AND g.source_url = r.url WHERE r.depth < 40)
       SELECT crawler_uuid, url, MIN(depth) AS depth FROM reach GROUP BY crawler_uuid, url""",
)
def crawl_depth(spark, sf):
    return audits.crawl_depth(view(spark, sf, "page_graph"), view(spark, sf, "page_seeds"))


@query(
    "crawl_depth_limited",
    """, reach AS (
         SELECT crawler_uuid, url, 0 AS depth FROM page_seeds
         UNION
         SELECT g.crawler_uuid, g.target_url, r.depth + 1 FROM reach r JOIN page_graph g ON g.crawler_uuid = r.crawler_uuid AND g.source_url = r.url WHERE r.depth < 2)
       SELECT crawler_uuid, url, MIN(depth) AS depth FROM reach GROUP BY crawler_uuid, url""",
)
def crawl_depth_limited(spark, sf):
    return audits.crawl_depth(view(spark, sf, "page_graph"), view(spark, sf, "page_seeds"), max_depth=2)


@query(
    "redirect_chains",
    """, chain AS (
         SELECT from_url, to_url AS end_url, [from_url] AS seen, 1 AS hops FROM redirect_hops
         UNION ALL
         SELECT c.from_url, h.to_url, list_append(c.seen, c.end_url), c.hops + 1 FROM chain c JOIN redirect_hops h ON h.from_url = c.end_url
         WHERE NOT list_contains(c.seen, c.end_url))
       SELECT from_url, MAX_BY(end_url, hops) AS end_url, MAX(hops) AS hops, MAX_BY(list_contains(seen, end_url), hops) AS is_loop
       FROM chain GROUP BY from_url""",
)
def redirect_chains(spark, sf):
    return audits.redirect_chains(view(spark, sf, "redirect_hops"))
