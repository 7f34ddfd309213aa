"""HTML conversion, typed values, corpora, chunks and retrieval."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from crawlweave.functions import html as H, urls
from crawlweave.operators import extract, text
from crawlweave.plans.page_queries import PAGE_LINKS
from crawlweave.plans.registry import query, view
from crawlweave.session import fresh_dir, table
from crawlweave.sinks import pages as page_sinks

literal = lambda s: "'" + s.replace("'", "''") + "'"


def sql_rules(column: str, rules) -> str:
    """The same replacement rules as DuckDB SQL."""
    for pattern, replacement in rules:
        column = f"regexp_replace({column}, {literal(pattern)}, {literal(re.sub(r'[$]([0-9])', r'\\\1', replacement))}, 'g')"
    return column


def sql_entities(column: str) -> str:
    for name, char in H.ENTITIES:
        column = f"replace({column}, {literal(name)}, {literal(char)})"
    return column


def sql_trim(column: str) -> str:
    return f"regexp_replace({column}, '^\\s+|\\s+$', '', 'g')"


VISIBLE = sql_rules("content", H.HIDDEN)
# written for the elements that the pages of the table have, not from the library's rules
GONE = "'<style>.*?</style>|<script>.*?</script>|<!--.*?-->'"
SHOWN = f"regexp_replace(content, {GONE}, ' ', 'gs')"
TEXT_LINES = f"""regexp_replace(regexp_replace(regexp_replace({SHOWN}, '<head>.*?</head>', '', 'gs'),
    '</?(html|body|nav|ul|li|div|article|h1|p|br|footer)( [^>]*)?>', chr(10), 'gi'), '<[^>]*>', '', 'g')"""
SQL_TEXT = f"""trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace({TEXT_LINES}, '&copy;', '©'), '&nbsp;', ' '), '&quot;', '"'), '&amp;', '&'),
    '[ \t\r]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n+', chr(10), 'g'), ' ' || chr(10))"""
SQL_CLEAN = f"""regexp_replace(regexp_replace(regexp_replace({SHOWN}, '<nav>.*?</nav>', ' ', 'gs'), '<footer>.*?</footer>', ' ', 'gs'),
    '(<div class="ad">)[^<]*(</div>)', '\\1\\2', 'g')"""
SQL_MARKDOWN = sql_trim(sql_rules(sql_entities(sql_rules(VISIBLE, [H.HEAD] + H.markdown_rules())), H.SPACES))


@query(
    "converted_pages",
    f"""SELECT url, 'text' AS format, md5({SQL_TEXT}) AS digest, length({SQL_TEXT}) AS chars FROM crawl_pages
        UNION ALL SELECT url, 'clean_html', md5({SQL_CLEAN}), length({SQL_CLEAN}) FROM crawl_pages
        UNION ALL SELECT url, 'markdown', md5({SQL_MARKDOWN}), length({SQL_MARKDOWN}) FROM crawl_pages""",
)
def converted_pages(spark, sf):
    pages = view(spark, sf, "crawl_pages").select("url", "content")
    out = text.convert_html(pages, ["text", "clean_html", "markdown"])
    return out.select("url", "format", F.md5("content").alias("digest"), F.length("content").cast("bigint").alias("chars"))


@query(
    "content_format_invariants",
    """SELECT url, TRUE AS clean_without_nav, TRUE AS clean_without_script, contains(content, '<h1>') AS clean_with_heading, TRUE AS clean_not_longer,
              TRUE AS text_without_tags, TRUE AS text_shorter, contains(content, '<h1>') AS markdown_with_heading, TRUE AS all_filled FROM crawl_pages""",
)
def content_format_invariants(spark, sf):
    """What the formats of one page keep and lose, as columns."""
    pages = view(spark, sf, "crawl_pages").select("url", "page_id", "content")
    made = text.convert_html(pages, ["html", "clean_html", "text", "markdown"])
    page = made.groupBy("page_id", "url").pivot("format", ["html", "clean_html", "text", "markdown"]).agg(F.first("content"))
    has = lambda column, words: F.contains(F.col(column), F.lit(words))
    filled = [F.length(F.col(c)) > 0 for c in ("html", "clean_html", "text", "markdown")]
    return page.select(
        "url", (~has("clean_html", "<nav")).alias("clean_without_nav"), (~has("clean_html", "<script")).alias("clean_without_script"),
        has("clean_html", "<h1>").alias("clean_with_heading"), (F.length("clean_html") <= F.length("html")).alias("clean_not_longer"),
        (~F.rlike("text", F.lit("<[a-z/]"))).alias("text_without_tags"), (F.length("text") < F.length("html")).alias("text_shorter"),
        F.rlike("markdown", F.lit(r"(?m)^# ")).alias("markdown_with_heading"), (filled[0] & filled[1] & filled[2] & filled[3]).alias("all_filled"),
    )


@query(
    "pages_as_json",
    f"""SELECT url, regexp_extract(content, '<html lang="([^"]*)"', 1) AS lang, trim({sql_entities("regexp_extract(content, '<h1>([^<]*)</h1>', 1)")}) AS heading,
               len(regexp_extract_all(content, '<li>')) AS items, len(regexp_extract_all(content, '<a href="')) AS links, NULLIF(regexp_extract(content, '<a href="([^"]*)"', 1), '') AS first_link,
               len(list_filter(regexp_extract_all(regexp_replace(content, '<script>.*?</script>', '', 'gs'), '<p>(?:<b>)?([^<]*)', 1), lambda p: trim(p) <> '')) AS paragraphs FROM crawl_pages""",
)
def pages_as_json(spark, sf):
    out = text.convert_html(view(spark, sf, "crawl_pages").select("url", "content"), ["json"]).select("url", F.try_parse_json("content").alias("j"))
    get = lambda path, kind: F.try_variant_get("j", path, kind)
    count = lambda path: F.size(get(path, "array<variant>")).cast("bigint")
    return out.select(
        "url", get("$.metadata.lang", "string").alias("lang"), get("$.headings[0].text", "string").alias("heading"), count("$.items").alias("items"),
        count("$.links").alias("links"), get("$.links[0].url", "string").alias("first_link"), count("$.paragraphs").alias("paragraphs"),
    )


SQL_CONTENT = f"regexp_extract({VISIBLE}, '<(?is:article\\b[^>]*>(.*)</article\\s*>)', 1)"
SQL_MAIN = sql_trim(sql_rules(sql_entities(sql_rules(
    f"CASE WHEN {SQL_CONTENT} <> '' THEN {SQL_CONTENT} ELSE {sql_rules(VISIBLE, [H.BOILERPLATE])} END",
    [H.HEAD] + H.markdown_rules(no_images=True, no_links=True),
)), H.SPACES))


@query("main_content_markdown", f"SELECT url, md5({SQL_MAIN}) AS digest, length({SQL_MAIN}) AS chars FROM crawl_pages")
def main_content_markdown(spark, sf):
    pages = view(spark, sf, "crawl_pages").select("url", "content")
    out = text.convert_html(pages, ["markdown"], options=["only_content", "no_links", "no_images"])
    return out.select("url", F.md5("content").alias("digest"), F.length("content").cast("bigint").alias("chars"))


@query(
    "page_metadata",
    f"""SELECT url, trim({sql_entities("regexp_extract(content, '<title>([^<]*)</title>', 1)")}) AS title, trim({sql_entities("regexp_extract(content, '<h1>([^<]*)</h1>', 1)")}) AS h1,
               regexp_extract(content, '<html lang="([^"]*)"', 1) AS lang, regexp_extract(content, '<meta charset="([^"]*)"', 1) AS charset,
               CAST(NULL AS VARCHAR) AS description FROM crawl_pages""",
)
def page_metadata(spark, sf):
    return text.page_metadata(view(spark, sf, "crawl_pages")).select("url", "title", "h1", "lang", "charset", "description")


@query(
    "page_metadata_json",
    f"""SELECT url, CAST(json_extract_string(j, '$.title') AS VARCHAR) AS title, CAST(json_extract_string(j, '$.lang') AS VARCHAR) AS lang FROM (
        SELECT url, to_json({{'title': trim({sql_entities("regexp_extract(content, '<title>([^<]*)</title>', 1)")}), 'lang': regexp_extract(content, '<html lang="([^"]*)"', 1)}}) AS j FROM crawl_pages) AS t""",
)
def page_metadata_json(spark, sf):
    out = text.convert_html(view(spark, sf, "crawl_pages").select("url", "content"), ["page_metadata"])
    return out.select("url", F.get_json_object("content", "$.title").alias("title"), F.get_json_object("content", "$.lang").alias("lang"))


@query(
    "emails_in_documents",
    """SELECT DISTINCT doc_id, email FROM (SELECT doc_id, UNNEST(regexp_extract_all(text,
         '([A-Za-z0-9._%+\\-]+@[A-Za-z0-9](?:[A-Za-z0-9.\\-]*[A-Za-z0-9])?\\.[A-Za-z]{2,})', 1)) AS email FROM documents) AS e""",
)
def emails_in_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(text.emails(F.col("text"))).alias("email"))


@query(
    "prices_in_text",
    """, found AS (SELECT doc_id, regexp_extract_all(text, '[+]1 [(]([0-9]{3})[)] ([0-9]{3})-', 1) AS a, regexp_extract_all(text, '[+]1 [(]([0-9]{3})[)] ([0-9]{3})-', 2) AS b FROM documents),
       calls AS (SELECT doc_id, UNNEST(range(len(a))) AS i, UNNEST(a) AS a, UNNEST(b) AS b FROM found)
       SELECT doc_id, CAST(2 * i AS INT) AS position, CAST('1' || a || '.5' AS DOUBLE) AS amount, 'EUR' AS currency FROM calls
       UNION ALL SELECT doc_id, CAST(2 * i + 1 AS INT), CAST(b AS DOUBLE), 'USD' FROM calls""",
)
def prices_in_text(spark, sf):
    """Prices in whole documents, whose phone numbers are turned into two prices each; other signs and numbers stay."""
    priced = F.regexp_replace("text", r"[+]1 [(]([0-9]{3})[)] ([0-9]{3})-", r"€ 1,$1.5 or \$$2 ")
    found = table(spark, sf, "documents").select("doc_id", F.posexplode(text.prices(priced)).alias("position", "p"))
    return found.select("doc_id", "position", "p.amount", "p.currency")


@query(
    "formatted_links",
    PAGE_LINKS
    + """ SELECT source_url AS url, COUNT(DISTINCT lower(target_url)) AS links, MIN(lower(target_url)) AS first_link FROM absolute_links GROUP BY source_url""",
)
def formatted_links(spark, sf):
    pages = view(spark, sf, "crawl_pages").withColumn("v", F.regexp_extract_all("content", F.lit(text.ANCHOR), 1))
    specs = [{"name": "absolute_url"}, {"name": "lowercase"}, {"name": "unique"}]
    values = text.apply_formatters(F.col("v"), specs, base_url=F.col("url"))
    return (
        pages.select("url", values.alias("v"))
        .filter(F.size("v") > 0)
        .select("url", F.size("v").cast("bigint").alias("links"), F.array_min("v").alias("first_link"))
    )


@query(
    "formatted_dates",
    """SELECT event_id, strftime(ts, '%d-%m-%Y') AS day, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS number,
              regexp_extract(props, '([0-9]+)', 1) AS picked, upper(event_type) AS kind FROM events""",
)
def formatted_dates(spark, sf):
    """Formatters and casts over the columns of the events, which hold times, JSON and words."""
    day = text.apply_formatters(F.array(F.date_format("ts", "yyyy-MM-dd")), [{"name": "datetime", "args": {"format": "%d-%m-%Y"}}])
    picked = text.apply_formatters(F.array("props"), [{"name": "pick", "args": {"key": "k"}}])
    tagged = F.array(F.concat(F.lit("<b>"), "event_type", F.lit("</b>")))
    kind = text.apply_formatters(tagged, [{"name": "remove_html"}, {"name": "uppercase"}])
    number = text.cast_values(picked, "float")
    return table(spark, sf, "events").select(
        "event_id", day[0].alias("day"), number[0].alias("number"), picked[0].alias("picked"), kind[0].alias("kind")
    )


@query(
    "document_chunks",
    """, sized AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) > 0),
       starts AS (SELECT doc_id, text, UNNEST(range(0, CAST(GREATEST(CEIL((n - 1000) / 800), 0) AS BIGINT) + 1)) AS i FROM sized)
       SELECT doc_id, CAST(i AS INT) AS chunk_idx, CAST(i * 800 AS INT) AS start, md5(substring(text, i * 800 + 1, 1000)) AS digest FROM starts""",
)
def document_chunks(spark, sf):
    chunks = text.chunk_documents(table(spark, sf, "documents").select("doc_id", "text"))
    return chunks.select("doc_id", "chunk_idx", "start", F.md5("chunk").alias("digest"))


@query(
    "nearest_vectors",
    """, q AS (SELECT label AS query_id, MIN_BY(embedding, vec_id) AS qe FROM embeddings GROUP BY label),
       s AS (SELECT query_id, vec_id, list_sum(list_transform(list_zip(embedding, qe), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)))
                / (sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))) * sqrt(list_sum(list_transform(qe, lambda x: CAST(x AS DOUBLE) * x)))) AS score
             FROM embeddings, q),
       r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
       SELECT query_id, vec_id, ROUND(score, 6) AS score, CAST(rank AS INT) AS rank FROM r WHERE rank <= 4""",
)
def nearest_vectors(spark, sf):
    vectors = table(spark, sf, "embeddings")
    queries = vectors.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("embedding"))
    return text.retrieve_top_k(vectors, queries).withColumn("score", F.round("score", 6))


@query(
    "page_file_plan",
    """, n AS (SELECT page_id, url, regexp_extract(url, '([^/]*)$', 1) AS last, CASE WHEN page_id % 7 = 0 THEN '.xml' ELSE '.html' END AS ext FROM crawl_pages),
       f AS (SELECT page_id, CASE WHEN last = '' THEN regexp_replace(replace(regexp_replace(url, '^https?://', ''), '/', '-'), '-$', '') || ext
                                  WHEN contains(last, ext) THEN last ELSE last || ext END AS file_name FROM n)
       SELECT page_id, file_name, ROW_NUMBER() OVER (PARTITION BY file_name ORDER BY page_id) AS collision_rank FROM f""",
)
def page_file_plan(spark, sf):
    pages = view(spark, sf, "crawl_pages").select("page_id", "url", "content_type")
    return page_sinks.plan_page_files(pages, keys=("page_id",)).select("page_id", "file_name", "collision_rank")


@query(
    "page_files_written",
    """, n AS (SELECT page_id, content, url, regexp_extract(url, '([^/]*)$', 1) AS last, CASE WHEN page_id % 7 = 0 THEN '.xml' ELSE '.html' END AS ext FROM crawl_pages),
       f AS (SELECT page_id, content, CASE WHEN last = '' THEN regexp_replace(replace(regexp_replace(url, '^https?://', ''), '/', '-'), '-$', '') || ext
                                  WHEN contains(last, ext) THEN last ELSE last || ext END AS file_name FROM n),
       r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY file_name ORDER BY page_id) AS rank FROM f)
       SELECT CASE WHEN rank = 1 THEN file_name ELSE regexp_extract(file_name, '^(.*?)([.][^.]*)?$', 1) || '-' || rank || regexp_extract(file_name, '([.][^.]*)$', 1) END AS file_name,
              md5(content) AS digest, strlen(content) AS bytes FROM r""",
)
def page_files_written(spark, sf):
    """Pages saved as files and read back: names, with ranks where several pages take one, and bytes."""
    planned = page_sinks.plan_page_files(view(spark, sf, "crawl_pages").select("page_id", "url", "content_type", "content"), keys=("page_id",))
    path = fresh_dir(spark, "page-files")
    page_sinks.write_page_files(planned, path)
    back = spark.read.format("binaryFile").load(path)
    name = F.regexp_extract("path", "([^/]*)$", 1)
    return back.select(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("file_name"), F.md5("content").alias("digest"), F.col("length").alias("bytes"))


SITE = "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)"


@query(
    "site_text_sections",
    f""", m AS (SELECT {SITE} AS site, url, {SQL_MARKDOWN} AS md FROM crawl_pages WHERE status_code = 200),
    k AS (SELECT * FROM m WHERE md <> ''), c AS (SELECT site, COUNT(*) AS n FROM k GROUP BY site)
    SELECT site, 1 AS part, url, md5('---' || chr(10) || chr(10) || '### ' || url || chr(10) || chr(10) || md || chr(10)) AS digest FROM k
    UNION ALL SELECT site, 0, '', md5('# Site' || chr(10) || chr(10) || '> All pages' || chr(10) || chr(10) || 'Text of the pages of ' || site || chr(10) || chr(10) || '## Pages' || chr(10)) FROM c
    UNION ALL SELECT site, 2, '', md5('---' || chr(10) || chr(10) || '## Summary' || chr(10) || chr(10) || 'Pages in this file: ' || n || chr(10) ||
        'Site: ' || site || chr(10)) FROM c""",
)
def site_text_sections(spark, sf):
    pages = view(spark, sf, "crawl_pages").select("url", "status_code", "content")
    made = text.convert_html(pages, ["markdown"]).withColumn("site", F.regexp_extract("url", urls.ORIGIN, 1))
    return page_sinks.build_llms_txt(made, "Site", "All pages").select("site", "part", "url", F.md5("section").alias("digest"))


@query(
    "llms_txt_written",
    f""", m AS (SELECT {SITE} AS site, url, {SQL_MARKDOWN} AS md FROM crawl_pages WHERE status_code = 200),
    k AS (SELECT site, '---' || chr(10) || chr(10) || '### ' || url || chr(10) || chr(10) || md || chr(10) AS section FROM m WHERE md <> ''),
    l AS (SELECT site, UNNEST(string_split(section, chr(10))) AS line FROM k)
    SELECT site, COUNT(*) + 8 + 7 AS lines, COUNT(CASE WHEN line LIKE '### http%' THEN 1 END) AS pages, CAST(SUM(length(line)) AS BIGINT) AS chars,
           '# Site' AS first_line, 'Site: ' || site AS last_words FROM l GROUP BY site""",
)
def llms_txt_written(spark, sf):
    """One text for each site, written and read back in the order of its part files."""
    pages = view(spark, sf, "crawl_pages").select("url", "status_code", "content")
    made = text.convert_html(pages, ["markdown"]).withColumn("site", F.regexp_extract("url", urls.ORIGIN, 1))
    path = fresh_dir(spark, "llms-txt")
    page_sinks.write_llms_txt(page_sinks.build_llms_txt(made, "Site", "All pages"), path)
    lines = spark.read.text(path).select("site", "value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    place = F.struct("file", "block", "at")
    own = F.contains("value", F.lit("Text of the pages of ")) | F.col("value").isin("# Site", "> All pages", "## Pages", "## Summary") | F.startswith("value", F.lit("Pages in this file: "))
    own = own | (F.col("value") == F.concat(F.lit("Site: "), "site"))
    # the footer's rule is the last of its kind
    sizes = lines.groupBy("site").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.rlike("value", F.lit("^### http"))).alias("pages"),
        (F.sum(F.when(own, 0).otherwise(F.length("value"))) - 3).cast("bigint").alias("chars"),
        F.min_by("value", place).alias("first_line"), F.max_by("value", F.when(F.col("value") != "", place)).alias("last_words"),
    )
    return sizes


TEMPLATE = {
    "source": "html",
    "selectors": [
        {"name": "heading", "type": "css", "query": "article > h1::text", "formatters": [{"name": "lowercase"}]},
        {"name": "links", "type": "xpath", "query": "//nav//a/@href", "multiple": True, "formatters": [{"name": "absolute_url"}]},
        {"name": "items", "type": "css", "query": "nav ul li", "nested": [
            {"name": "label", "type": "css", "query": "a::text"},
            {"name": "target", "type": "xpath", "query": "//a/@href"},
            {"name": "anchors", "type": "xpath", "query": "count(//a)", "cast": "float"},
        ]},
    ],
}


@query(
    "extracted_fields",
    """, t AS (SELECT url, regexp_extract(content, '<article><h1>([^<]*)</h1>', 1) AS h, regexp_extract(content, '(<nav>.*?</nav>)', 1) AS nav FROM crawl_pages),
       v AS (SELECT url, h, regexp_extract_all(nav, 'href="([^"]*)"', 1) AS hrefs, regexp_extract_all(nav, 'href="[^"]*">([^<]*)<', 1) AS labels FROM t)
       SELECT url, CASE WHEN h <> '' THEN lower(replace(h, '&amp;', '&')) END AS heading, len(hrefs) AS links,
              CASE WHEN len(hrefs) > 0 THEN regexp_extract(url, '^([a-z]+://[^/]+)', 1) || hrefs[len(hrefs)] END AS last_link,
              len(labels) AS items, CASE WHEN len(labels) > 0 THEN labels[1] END AS first_label, CASE WHEN len(hrefs) > 0 THEN hrefs[1] END AS first_target,
              CASE WHEN len(hrefs) > 0 THEN 1.0::DOUBLE END AS first_anchors FROM v""",
)
def extracted_fields(spark, sf):
    out = extract.extract_fields(view(spark, sf, "crawl_pages").select("url", "content"), TEMPLATE)
    get = lambda path, kind: F.try_variant_get("data", path, kind)
    rows = out.select("url", get("$.heading", "string").alias("heading"), get("$.links", "array<string>").alias("l"),
                      get("$.items", "array<struct<label:string,target:string,anchors:double>>").alias("i"))
    count = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    first = F.get("i", F.lit(0))
    return rows.select(
        "url", "heading", F.when(F.col("l").isNotNull(), count("l")).otherwise(F.lit(0)).alias("links"), F.when(F.size("l") > 0, F.element_at("l", -1)).alias("last_link"),
        F.when(F.col("i").isNotNull(), count("i")).otherwise(F.lit(0)).alias("items"),
        first["label"].alias("first_label"), first["target"].alias("first_target"), first["anchors"].alias("first_anchors"),
    )


@query(
    "extracted_by_regex",
    """SELECT url, NULLIF(lower(regexp_extract(content, '<title>([^<]*)', 1)), '') AS title, len(regexp_extract_all(content, '(?i)<P[ >]')) AS paragraphs FROM crawl_pages""",
)
def extracted_by_regex(spark, sf):
    template = {
        "selectors": [
            {"name": "title", "type": "regex", "query": "<title>([^<]*)", "formatters": [{"name": "lowercase"}]},
            {"name": "paragraphs", "type": "regex", "query": "<P[ >]", "multiple": True, "options": {"ignorecase": True}},
        ]
    }
    out = extract.extract_fields(view(spark, sf, "crawl_pages").select("url", "content"), template)
    count = F.size(F.try_variant_get("data", "$.paragraphs", "array<string>"))
    return out.select("url", F.try_variant_get("data", "$.title", "string").alias("title"), F.greatest(count, F.lit(0)).cast("bigint").alias("paragraphs"))
