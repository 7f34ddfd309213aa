"""HTTP and payload level column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: first bytes of a compressed body
GZIP_MAGIC = "1F8B"
ZSTD_MAGIC = ("1EB52FFD", "22B52FFD", "23B52FFD", "24B52FFD", "25B52FFD", "26B52FFD", "27B52FFD", "28B52FFD")
DEFLATE_MAGIC = ("7801", "785E", "789C", "78DA")


def last_wins_map(entries: Column) -> Column:
    """``array<struct<key,value>>`` to a map in which the last duplicate key wins."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_entries(
        F.transform(
            keys,
            lambda k: F.struct(
                k.alias("key"),
                F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value"),
            ),
        )
    )


def named_values_map(headers: Column) -> Column:
    """HAR header list to a map; null becomes an empty map."""
    pairs = F.transform(headers, lambda h: F.struct(h["name"].alias("key"), h["value"].alias("value")))
    pairs = F.filter(pairs, lambda e: e["key"].isNotNull())
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(last_wins_map(pairs), empty)


def lower_keys(headers: Column) -> Column:
    """Case-insensitive headers: lower-case names, last one wins."""
    pairs = F.transform(
        F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    return last_wins_map(pairs)


def header_ending(headers: Column, suffix: str) -> Column:
    """Value of the header whose lower-case name ends with ``suffix``, whatever its vendor prefix."""
    hits = F.map_values(F.map_filter(headers, lambda k, v: F.endswith(F.lower(k), F.lit(suffix))))
    return F.get(hits, F.lit(0))


def parse_http_head(head: Column) -> Column:
    """Status and headers of a raw HTTP head (text before the blank line)."""
    lines = F.split(F.regexp_replace(head, "\r\n", "\n"), "\n", -1)
    named = F.filter(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), lambda l: F.contains(l, F.lit(":")))
    pairs = F.transform(
        named,
        lambda l: F.struct(
            F.trim(F.regexp_extract(l, r"^([^:]*):", 1)).alias("key"),
            F.trim(F.regexp_extract(l, r"^[^:]*:(.*)$", 1)).alias("value"),
        ),
    )
    return F.struct(status_of_line(F.get(lines, F.lit(0))).alias("status_code"), last_wins_map(pairs).alias("headers"))


def status_of_line(line: Column) -> Column:
    """Status code of a status line; the minor version is optional."""
    return F.regexp_extract(line, r"^HTTP/\d(?:\.\d)? (\d+)", 1).try_cast("int")


def parse_content_type(value: Column) -> Column:
    """``text/html; charset="utf-8"`` to struct<mime, params>."""
    pieces = F.split(value, ";", -1)
    params = F.filter(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p: F.contains(p, F.lit("=")))
    pairs = F.transform(
        params,
        lambda p: F.struct(
            F.lower(F.trim(F.regexp_extract(p, r"^([^=]*)=", 1))).alias("key"),
            F.regexp_replace(F.trim(F.regexp_extract(p, r"^[^=]*=(.*)$", 1)), r'^"+|"+$', "").alias("value"),
        ),
    )
    return F.struct(F.lower(F.trim(F.get(pieces, F.lit(0)))).alias("mime"), last_wins_map(pairs).alias("params"))


def format_of_mime(mime: Column) -> Column:
    """Content format named by a MIME type; null for types without one."""
    low = F.lower(mime)
    return (
        F.when(F.contains(low, F.lit("markdown")), "markdown")
        .when(F.contains(low, F.lit("plain")), "text")
        .when(F.contains(low, F.lit("html")), "html")
        .when(F.contains(low, F.lit("json")), "json")
    )


def content_kind(content_type: Column) -> Column:
    """html, xml or text, by the content-type header."""
    value = F.coalesce(content_type, F.lit(""))
    return (
        F.when(F.contains(value, F.lit("text/html")), "html")
        .when(F.contains(value, F.lit("application/xml")), "xml")
        .otherwise("text")
    )


def detect_compression(content: Column) -> Column:
    """gzip, zstd or deflate by magic bytes, else null."""
    first = F.hex(F.substring(content, 1, 4))
    return (
        F.when(first.startswith(GZIP_MAGIC), "gzip")
        .when(first.isin(*ZSTD_MAGIC), "zstd")
        .when(F.substring(first, 1, 4).isin(*DEFLATE_MAGIC), "deflate")
    )


def body_bytes(text: Column, encoding: Column) -> Column:
    """HAR body: base64 when flagged so, else the UTF-8 bytes of the text."""
    value = F.coalesce(text, F.lit(""))
    return F.when(encoding == "base64", F.unbase64(value)).otherwise(F.encode(value, "UTF-8"))


def utf8_text(content: Column) -> Column:
    """Bytes as text; invalid sequences become U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def api_timestamp(text: Column) -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss`` of at most 26 characters, else null."""
    return F.when(
        (F.length(text) <= 26) & text.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"),
        F.try_to_timestamp(text, F.lit("yyyy-M-d H:m:s")),
    )
