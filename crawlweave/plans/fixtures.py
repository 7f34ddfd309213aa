"""Crawl artifacts written from the given tables, for the readers to read back.

Everything is written by Spark tasks below the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crawlweave.session import fresh_dir
from crawlweave.sources import files

CRLF = "\r\n"


def warc_record(kind: str, block: Column, lines: list[Column], version: Column | str = "WARC/1.0") -> Column:
    head = F.concat_ws(
        CRLF,
        F.lit(version) if isinstance(version, str) else version,
        F.lit(f"WARC-Type: {kind}"),
        *lines,
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit(CRLF * 2), block)


def warc_rows(pages: DataFrame, damaged: Column | None = None) -> DataFrame:
    """A response, a request and a conversion record per page; ``concat_ws`` leaves out null headers.

    The responses of ``damaged`` pages have a bad version line.
    """
    version = "WARC/1.0" if damaged is None else F.when(damaged, "WERC/1.0").otherwise("WARC/1.0")
    named = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    page_id = F.col("page_id").cast("string")
    common = [named("WARC-Target-URI", F.col("url")), named("WARC-Date", F.lit("2024-05-06T07:08:09Z"))]
    scrape = common + [
        named("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), page_id, F.lit(">"))),
        named("WARC-Scrape-Log-Id", F.concat(F.lit("log-"), page_id)),
        named("WARC-Scrape-Country", F.col("country")),
        F.when(F.col("page_id") % 11 != 0, named("WARC-Scrape-Duration", F.col("duration").cast("string"))),
        named("WARC-Scrape-Retry", F.col("retry_count").cast("string")),
    ]
    eol = F.when(F.col("page_id") % 2 == 0, CRLF).otherwise("\n")
    status = F.when(F.col("page_id") % 5 == 0, "HTTP/2 ").otherwise("HTTP/1.1 ")
    response = F.concat(
        status, F.col("status_code").cast("string"), F.lit(" Fine"), eol, F.lit("Content-Type: "), F.col("content_type"), eol,
        F.lit("X-Twice: one"), eol, F.lit("X-Twice: two"), eol, eol, F.col("content"), F.lit(CRLF + "WARC/1.0" + CRLF + "not a record"),
    )
    request = F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1" + CRLF * 2))
    records = F.array(
        warc_record("response", response, scrape, version), warc_record("request", request, common), warc_record("conversion", F.col("url"), common)
    )
    return pages.select(F.explode(records).alias("value"))


def write_warc(spark: SparkSession, pages: DataFrame, damaged: Column | None = None) -> str:
    """A folder of archives, one of each kind for each partition of the pages: half of the pages plain, half gzipped."""
    path = fresh_dir(spark, "warc")
    for name, odd in (("none", 0), ("gzip", 1)):
        part = warc_rows(pages.filter(F.col("page_id") % 2 == odd), damaged)
        part.write.option("lineSep", CRLF * 2).option("compression", name).text(f"{path}/{name}")
    return path


HAR_LOG = '{"log": {"version": "1.2", "creator": {"name": "fixture", "version": "1"}, "pages": [], "entries": []}}'


def har_entries(pages: DataFrame, *beside: Column) -> DataFrame:
    """One HAR entry per page as JSON text, after the columns ``beside``."""
    header = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    coded = F.col("page_id") % 3 == 0
    content = F.struct(
        F.octet_length("content").alias("size"),
        F.col("content_type").alias("mimeType"),
        F.when(coded, F.base64(F.encode("content", "UTF-8"))).otherwise(F.col("content")).alias("text"),
        F.when(coded, "base64").alias("encoding"),
    )
    response = F.struct(
        F.when(F.col("page_id") % 13 != 0, F.col("status_code").cast("string")).alias("status"),
        F.lit("Fine").alias("statusText"),
        F.array(header("X-Twice", F.lit("one")), header("X-Twice", F.lit("two"))).alias("headers"),
        content.alias("content"),
    )
    entry = F.struct(
        F.lit("2024-05-06T07:08:09Z").alias("startedDateTime"),
        (F.col("duration") * 1000).alias("time"),
        F.create_map(F.lit("wait"), F.col("duration") * 600, F.lit("receive"), F.col("duration") * 400, F.lit("blocked"), F.lit(-1.0)).alias("timings"),
        F.struct(F.lit("GET").alias("method"), F.col("url"), F.array(header("Accept", F.lit("*/*"))).alias("headers")).alias("request"),
        response.alias("response"),
    )
    return pages.select(*beside, F.to_json(entry).alias("value"))


def write_har(spark: SparkSession, pages: DataFrame, nested: bool = False) -> str:
    """An archive for each partition of the pages: the log object followed by its entries, or the entries inside the log."""
    opening, closing = HAR_LOG[: HAR_LOG.index("]}}") - len('"entries": [')] + '"entries": [', "]}}"

    def with_log(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [HAR_LOG]})
        yield from batches

    def in_log(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = opening
        for batch in batches:
            for value in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"value": [mark + value]})
                mark = ","
        yield pa.RecordBatch.from_pydict({"value": [closing if mark == "," else opening + closing]})

    path = fresh_dir(spark, "har")
    entries = har_entries(pages).mapInArrow(in_log if nested else with_log, "value string")
    entries.write.option("compression", "gzip").text(path)
    return path


def write_har_archives(spark: SparkSession, pages: DataFrame) -> str:
    """An archive for each thousand pages of a crawl, whose log names the crawl and lists the pages."""
    archive = F.concat_ws("-", "crawler_uuid", F.floor(F.col("page_id") / 1000).cast("string")).alias("archive")
    listed = F.collect_list(F.struct(F.col("page_id").cast("string").alias("id"), F.col("url").alias("title")))
    log = F.struct(
        F.lit("1.2").alias("version"),
        F.struct(F.concat(F.lit("crawl-"), F.first("crawler_uuid")).alias("name"), F.max("status_code").cast("string").alias("version")).alias("creator"),
        listed.alias("pages"), F.array().cast("array<string>").alias("entries"),
    )
    logs = pages.groupBy(archive).agg(F.lit(-1).cast("bigint").alias("at"), F.to_json(F.struct(log.alias("log"))).alias("value"))
    lines = har_entries(pages, archive, F.col("page_id").alias("at"))
    path = fresh_dir(spark, "har-archives")
    rows = logs.unionByName(lines).repartition("archive").sortWithinPartitions("archive", "at")
    rows.select("archive", "value").write.partitionBy("archive").text(path)
    return path


def write_lines(spark: SparkSession, lines: DataFrame, name: str) -> str:
    path = fresh_dir(spark, name)
    lines.write.text(path)
    return path


STATE_JSON = """named_struct('urls_visited', k, 'urls_extracted', k * 2, 'urls_to_crawl', k, 'urls_failed', k % 7, 'urls_skipped', k, 'api_credit_used', k * 3, 'duration', k / 4,
    'start_time', unix_timestamp(ts), 'stop_time', unix_timestamp(ts) + k / 4, 'stop_reason', stop_reason)"""


def event_lines(log: DataFrame) -> DataFrame:
    """Event envelopes as JSON lines; a part of them is incomplete or unknown."""
    payload = f"""named_struct('crawler_uuid', IF(k = 13, NULL, crawler_uuid), 'project', project, 'env', env, 'action', 'act', 'state', {STATE_JSON},
        'url', IF(event IN ('crawler_url_visited', 'crawler_url_failed'), url, NULL),
        'scrape', IF(event = 'crawler_url_visited', named_struct('status_code', 200, 'country', country, 'log_uuid', CAST(event_id AS STRING),
            'log_url', url, 'content', map('html', concat('<p>', url, '</p>'), 'text', url)), NULL),
        'urls', IF(event = 'crawler_url_skipped', map(url, 'page_limit', concat(url, '?x=1'), 'robots_txt'), NULL),
        'origin', IF(event = 'crawler_url_discovered', 'navigation', NULL), 'discovered_urls', IF(event = 'crawler_url_discovered', array(url, concat(url, '/a')), NULL),
        'error', IF(event = 'crawler_url_failed', error_code, NULL), 'scrape_config', IF(event = 'crawler_url_failed', named_struct('method', 'GET', 'url', url), NULL),
        'links', IF(event = 'crawler_url_failed', named_struct('scrape', IF(k = 17, NULL, url)), NULL))"""
    name = "CASE WHEN k = 11 THEN 'crawler_paused' WHEN k = 12 THEN NULL ELSE event END"
    return log.selectExpr(f"to_json(named_struct('event', {name}, 'payload', {payload})) AS value")


def status_lines(polls: DataFrame) -> DataFrame:
    """Status payloads; some use the old identifier field, some miss a counter."""
    payload = """named_struct('crawler_uuid', IF(urls_visited % 2 = 0, crawler_uuid, NULL), 'uuid', IF(urls_visited % 2 = 0, NULL, crawler_uuid), 'status', status,
        'is_success', is_success, 'is_finished', status IN ('DONE', 'CANCELLED'),
        'state', named_struct('urls_visited', urls_visited, 'urls_extracted', urls_extracted, 'urls_to_crawl', urls_extracted, 'urls_failed', 0,
            'urls_skipped', IF(urls_extracted = 3, NULL, 0), 'api_credit_used', 1.5, 'duration', 2))"""
    return polls.selectExpr(f"to_json({payload}) AS value")


def scrape_result_lines(pages: DataFrame) -> DataFrame:
    """Result envelopes of every content format, and error objects."""
    envelope = """to_json(named_struct('config', named_struct('url', url, 'headers', IF(page_id % 2 = 0, map('Accept', 'x'), NULL)), 'context', named_struct('id', page_id),
        'result', named_struct('url', url, 'status', 'DONE', 'status_code', status_code, 'reason', 'r', 'success', status_code < 400,
            'format', CASE page_id % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'binary' WHEN 2 THEN 'clob' ELSE 'text' END,
            'content', CASE page_id % 4 WHEN 1 THEN base64(encode(content, 'UTF-8')) WHEN 2 THEN concat('ref://', url) ELSE content END,
            'duration', duration, 'log_url', concat('log/', page_id), 'response_headers', map('Content-Type', content_type, 'X-A', 'b'),
            'error', IF(status_code >= 400, named_struct('code', 'ERR::SCRAPE::BAD_UPSTREAM_RESPONSE', 'message', 'bad', 'retryable', true, 'http_code', 422), NULL))))"""
    error = "to_json(named_struct('error_id', concat('e', page_id), 'message', 'refused', 'http_code', 401))"
    return pages.selectExpr(f"IF(page_id % 9 = 8, {error}, {envelope}) AS value")


def contents_lines(pages: DataFrame) -> DataFrame:
    """The three shapes of a contents payload."""
    return pages.selectExpr(
        """CASE page_id % 3 WHEN 0 THEN to_json(named_struct('contents', map(url, map('html', content, 'text', country))))
             WHEN 1 THEN to_json(named_struct('contents', map(url, content)))
             ELSE to_json(named_struct('pages', array(named_struct('url', url, 'status_code', status_code, 'content', content)))) END AS value"""
    )


def extraction_lines(pages: DataFrame) -> DataFrame:
    """Extraction results: objects, texts, nothing, and errors."""
    return pages.selectExpr(
        """CASE page_id % 4 WHEN 0 THEN to_json(named_struct('data', named_struct('name', country, 'ids', array(page_id)), 'content_type', 'application/json'))
             WHEN 1 THEN to_json(named_struct('data', url, 'content_type', 'text/plain')) WHEN 2 THEN '{}'
             ELSE to_json(named_struct('error_id', concat('e', page_id), 'message', 'no')) END AS value"""
    )


def sitemap_files(spark: SparkSession, pages: DataFrame) -> str:
    """A sitemap per 100 pages and an index per 1000 sitemaps, each of which also names a missing one. Files are written by tasks."""
    xml_url = lambda c: F.concat(F.lit("<url><loc> "), F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit(" </loc></url>"))
    group = F.floor(F.col("page_id") / 100)  # a protocol file is bounded; so is this group
    maps = pages.groupBy(group.alias("g")).agg(F.concat_ws("", F.collect_list(xml_url(F.col("url")))).alias("body")).select(
        F.concat(F.lit("map-"), F.col("g").cast("string"), F.lit(".xml")).alias("name"),
        F.concat(F.lit('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), "body", F.lit("</urlset>")).alias("body"),
    )
    entry = lambda name: F.concat(F.lit("<sitemap><loc>https://maps.example/"), name, F.lit("</loc></sitemap>"))
    number = F.floor(F.regexp_extract("name", r"([0-9]+)", 1).cast("bigint") / 1000)
    index = maps.groupBy(number.cast("string").alias("n")).agg(F.concat_ws("", F.collect_list(entry(F.col("name")))).alias("body")).select(
        F.concat(F.lit("index-"), "n", F.lit(".xml")).alias("name"),
        F.concat(F.lit("<sitemapindex>"), "body", entry(F.concat(F.lit("dead-"), "n", F.lit(".xml"))), F.lit("</sitemapindex>")).alias("body"),
    )
    path = fresh_dir(spark, "sitemaps")

    def write(rows) -> None:
        filesystem, local = files.resolve(path)
        filesystem.create_dir(local, recursive=True)
        for row in rows:
            with filesystem.open_output_stream(f"{local}/{row.name}", compression=None) as out:
                out.write(row.body.encode())

    maps.unionByName(index).foreachPartition(write)
    return path
