"""Result, status, event, URL list and sitemap payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crawlweave import schemas as S
from crawlweave.functions import http

# fixed values: events at the start and end of a crawl
LIFECYCLE = ("crawler_started", "crawler_stopped", "crawler_cancelled", "crawler_finished")


def json_lines(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Raw payloads in column ``raw``: one per line, or one per file."""
    return spark.read.text(path, wholetext=whole_files).withColumnRenamed("value", "raw").filter(F.trim("raw") != "")


def parsed_once(raw: DataFrame, expression: Column, name: str = "e") -> DataFrame:
    """Add a parsed column behind a generator.

    Without it the optimizer copies ``from_json`` into every field access and
    pushed filter, and the text is parsed once per field.
    """
    return raw.select("*", F.explode(F.array(expression)).alias(name))


# --- URL lists -------------------------------------------------------------------------------


def parse_url_list(lines: DataFrame, status: str, column: str = "value") -> DataFrame:
    """``url[,reason]`` lines; a visited or pending line is the URL as a whole."""
    line = F.regexp_replace(F.col(column), r"^\s+|\s+$", "")
    rows = lines.select(line.alias("raw_line")).filter(F.col("raw_line") != "")
    raw = F.col("raw_line")
    if status in ("visited", "pending"):
        return rows.select(raw.alias("url"), F.lit(status).alias("status"), F.lit(None).cast("string").alias("reason"), "raw_line")
    comma = F.locate(",", raw)
    reason = F.when(comma > 0, F.substring(raw, comma + 1, F.length(raw)))
    return rows.select(
        F.when(comma > 0, F.substring(raw, F.lit(1), comma - 1)).otherwise(raw).alias("url"),
        F.lit(status).alias("status"),
        F.when(reason != "", reason).alias("reason"),
        "raw_line",
    )


def read_url_list(spark: SparkSession, path: str, status: str = "visited") -> DataFrame:
    return parse_url_list(spark.read.text(path), status)


# --- scrape results --------------------------------------------------------------------------


def parse_scrape_results(raw: DataFrame) -> DataFrame:
    """Result envelopes as flat typed rows.

    Header names become lower case, binary content is decoded, and content
    that is only a reference (clob, blob) moves to ``content_ref``.
    """
    parsed = parsed_once(raw, F.from_json("raw", S.SCRAPE_ENVELOPE))
    e, r = F.col("e"), F.col("e.result")
    content, form = r["content"], r["format"]
    is_ref = form.isin("clob", "blob")
    config_headers = F.try_variant_get(e["config"], "$.headers", "map<string,string>")
    empty = F.create_map().cast("map<string,string>")
    failed = F.coalesce(~r["success"], F.lit(False))
    return parsed.select(
        e["error_id"].isNotNull().alias("is_api_error"),
        e["error_id"].alias("error_id"),
        e["message"].alias("message"),
        e["http_code"].alias("http_code"),
        r["url"].alias("url"),
        r["status"].alias("status"),
        r["status_code"].alias("upstream_status"),
        r["reason"].alias("reason"),
        F.coalesce(r["success"], F.lit(False)).alias("scrape_success"),
        form.alias("format"),
        F.when(form.isin("binary") | is_ref, F.lit(None).cast("string")).otherwise(content).alias("content"),
        F.when(form == "binary", F.unbase64(content)).alias("content_bytes"),
        F.when(is_ref, content).alias("content_ref"),
        r["duration"].alias("duration"),
        r["log_url"].alias("log_url"),
        F.coalesce(config_headers, empty).alias("config_headers"),
        http.lower_keys(F.coalesce(r["request_headers"], empty)).alias("request_headers"),
        http.lower_keys(F.coalesce(r["response_headers"], empty)).alias("response_headers"),
        F.when(failed, r["error"]).alias("error"),
        e["config"].alias("config"),
        e["context"].alias("context"),
        *[r[c].alias(c) for c in ("screenshots", "dns", "ssl", "iframes", "browser_data")],
    )


def read_scrape_results(spark: SparkSession, path: str) -> DataFrame:
    return parse_scrape_results(json_lines(spark, path))


def text_only(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(text rows, other rows): only content of format ``text`` may be parsed as HTML."""
    is_text = F.coalesce(F.col("format") == "text", F.lit(False))
    return results.filter(is_text), results.filter(~is_text)


# --- crawl contents --------------------------------------------------------------------------


def parse_crawl_contents(raw: DataFrame, default_format: str = "html") -> DataFrame:
    """Contents payloads in long form ``(url, format, content)``.

    Accepts url to {format: text}, url to text, and a list of pages; each
    payload is parsed once.
    """
    schema = "contents map<string,variant>, pages array<struct<url:string, content:string>>"
    parsed = parsed_once(raw, F.from_json("raw", schema))
    row = lambda url, form, content: F.struct(url.alias("url"), form.alias("format"), content.alias("content"))
    plain = F.lit(default_format)

    def of_url(entry: Column) -> Column:
        value = entry["value"]
        formats = F.map_entries(F.try_variant_get(value, "$", "map<string,string>"))
        return F.when(
            F.schema_of_variant(value).startswith("OBJECT"), F.transform(formats, lambda f: row(entry["key"], f["key"], f["value"]))
        ).otherwise(F.array(row(entry["key"], plain, F.try_variant_get(value, "$", "string"))))

    listed = F.flatten(F.transform(F.map_entries("e.contents"), of_url))
    pages = F.transform("e.pages", lambda p: row(p["url"], plain, p["content"]))
    nothing = F.array().cast("array<struct<url:string,format:string,content:string>>")
    return parsed.select(F.inline(F.concat(F.coalesce(listed, nothing), F.coalesce(pages, nothing))))


def read_crawl_contents(spark: SparkSession, path: str, default_format: str = "html") -> DataFrame:
    return parse_crawl_contents(json_lines(spark, path), default_format)


# --- crawl events ----------------------------------------------------------------------------


def missing_fields(e: Column) -> Column:
    """Reason to reject an event envelope; null when it is complete."""
    p = e["payload"]
    need = lambda col, name: F.when(col.isNull(), F.lit(name))
    base = [need(p[c], c) for c in ("crawler_uuid", "project", "env", "action", "state")]
    base += [need(p["state"][c], f"state.{c}") for c in S.REQUIRED_STATE]
    event = e["event"]
    scrape = p["scrape"]
    visited = [need(p["url"], "url")] + [
        need(scrape[c], f"scrape.{c}") for c in ("status_code", "country", "log_uuid", "log_url", "content")
    ]
    specific = {
        LIFECYCLE: [need(p["seed_url"], "seed_url"), need(p["links"]["status"], "links.status")],
        ("crawler_url_visited",): visited,
        ("crawler_url_skipped",): [need(p["urls"], "urls")],
        ("crawler_url_discovered",): [need(p["origin"], "origin"), need(p["discovered_urls"], "discovered_urls")],
        ("crawler_url_failed",): [
            need(p["url"], "url"),
            need(p["error"], "error"),
            need(p["scrape_config"], "scrape_config"),
            need(p["links"]["scrape"], "links.scrape"),
        ],
    }
    # each field is looked at in one place: a copy for each kind of event would make a method too long for the JIT compiler
    own = F.lit(None).cast("string")
    for names, fields in specific.items():
        own = F.when(event.isin(*names), F.coalesce(*fields)).otherwise(own)
    known = event.isin(*[name for names in specific for name in names])
    reason = F.when(known, F.concat(F.lit("missing "), F.coalesce(*base, own))).otherwise("unknown event")
    return F.when(e.isNull() | event.isNull(), "missing event").when(p.isNull(), "missing payload").otherwise(reason)


def parse_events(raw: DataFrame) -> DataFrame:
    """Typed events plus ``reject_reason``; works on batch and streaming DataFrames."""
    parsed = parsed_once(raw, F.from_json("raw", S.EVENT_ENVELOPE))
    return parsed.withColumn("reject_reason", missing_fields(F.col("e"))).select(
        *[c for c in raw.columns], F.col("e.event").alias("event"), "e.payload.*", "reject_reason"
    )


def split_events(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected)."""
    return (
        parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw"),
        parsed.filter(F.col("reject_reason").isNotNull()).select("raw", "event", "reject_reason"),
    )


def read_crawl_events(spark: SparkSession, path: str, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) events. ``strict=False`` also accepts incomplete events of known names."""
    parsed = parse_events(json_lines(spark, path))
    if not strict:
        known = F.col("reject_reason").startswith("missing ") & ~F.col("reject_reason").isin("missing event", "missing payload")
        parsed = parsed.withColumn("reject_reason", F.when(~known, F.col("reject_reason")))
    return split_events(parsed)


# --- crawl status ----------------------------------------------------------------------------


def parse_crawl_status(raw: DataFrame) -> DataFrame:
    parsed = parsed_once(raw, F.from_json("raw", S.CRAWL_STATUS))
    e = F.col("e")
    uuid = F.coalesce(e["crawler_uuid"], e["uuid"])
    need = lambda col, name: F.when(col.isNull(), F.lit(name))
    first = F.coalesce(
        F.when(uuid.isNull() | (uuid == ""), "crawler_uuid"),
        F.when(e["status"].isNull() | (e["status"] == ""), "status"),
        need(e["is_finished"], "is_finished"),
        need(e["state"], "state"),
        *[need(e["state"][c], f"state.{c}") for c in S.REQUIRED_STATE],
    )
    return parsed.select(
        "raw",
        uuid.alias("crawler_uuid"),
        e["status"].alias("status"),
        e["is_success"].alias("is_success"),
        e["is_finished"].alias("is_finished"),
        "e.state.*",
        F.when(first.isNotNull(), F.concat(F.lit("missing "), first)).alias("reject_reason"),
    )


def read_crawl_status(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) status payloads."""
    parsed = parse_crawl_status(json_lines(spark, path))
    return (
        parsed.filter(F.col("reject_reason").isNull()).drop("raw", "reject_reason"),
        parsed.filter(F.col("reject_reason").isNotNull()).select("raw", "reject_reason"),
    )


# --- extractions -----------------------------------------------------------------------------


def parse_extractions(raw: DataFrame) -> DataFrame:
    """Extraction results; ``data`` stays a VARIANT, an empty result has none."""
    parsed = parsed_once(raw, F.from_json("raw", S.EXTRACTION_ENVELOPE))
    data = F.when(~F.is_variant_null(F.col("e.data")), F.col("e.data"))
    return parsed.select(
        data.alias("data"),
        F.col("e.content_type").alias("content_type"),
        data.isNotNull().alias("extraction_success"),
        F.col("e.error_id").alias("error_id"),
        F.col("e.message").alias("message"),
    )


def read_extractions(spark: SparkSession, path: str) -> DataFrame:
    return parse_extractions(json_lines(spark, path))


# --- sitemaps --------------------------------------------------------------------------------


def parse_sitemaps(documents: DataFrame) -> DataFrame:
    """URLs of sitemaps and of the sitemaps an index names.

    ``documents``: sitemap_url, xml. Output ``(sitemap_url, via_index, loc,
    is_dead)``: a child named by an index but not present is kept once with
    ``is_dead`` and a null loc. One sitemap file is limited to 50,000 URLs by
    its protocol, so a document fits a row.
    """
    locs = F.transform(
        F.regexp_extract_all("xml", F.lit(r"(?is)<loc[^>]*>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</loc>"), 1),
        lambda u: F.replace(F.replace(u, F.lit("&apos;"), F.lit("'")), F.lit("&amp;"), F.lit("&")),
    )
    exploded = documents.select(
        "sitemap_url", F.col("xml").rlike(r"(?i)<sitemapindex").alias("is_index"), F.explode(locs).alias("loc")
    )
    children = exploded.filter("is_index").groupBy(F.col("loc").alias("sitemap_url")).agg(F.min("sitemap_url").alias("via_index"))
    leaves = exploded.filter(~F.col("is_index")).select("sitemap_url", "loc")
    listed = leaves.join(children, "sitemap_url", "left").withColumn("is_dead", F.lit(False))
    dead = (
        children.join(documents.select("sitemap_url"), "sitemap_url", "left_anti")
        .withColumn("loc", F.lit(None).cast("string"))
        .withColumn("is_dead", F.lit(True))
    )
    return listed.select("sitemap_url", "via_index", "loc", "is_dead").unionByName(
        dead.select("sitemap_url", "via_index", "loc", "is_dead")
    )


def read_sitemaps(spark: SparkSession, path: str, base_url: str) -> DataFrame:
    """Sitemap files below ``path``; a file's URL is ``base_url`` and its name."""
    documents = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.concat(F.lit(base_url.rstrip("/") + "/"), F.col("_metadata.file_name")).alias("sitemap_url"),
        F.col("value").alias("xml"),
    )
    return parse_sitemaps(documents)
