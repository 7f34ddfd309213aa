"""Links, content formats, typed values and corpora out of pages."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from crawlweave.functions import html as H, http, urls

ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
SOURCE = r"""(?is)<(?:img|script|iframe|source|video|audio|embed)\b[^>]*?\bsrc\s*=\s*["']([^"']*)["']"""
ANCHOR_TAG = r"""(?is)<a\b[^>]*>"""
FORMAT_OPTIONS = ("no_images", "no_links", "only_content")
CONVERTIBLE = ("html", "clean_html", "markdown", "text", "page_metadata", "json")

# fixed values: currency signs and their codes
CURRENCY = {"$": "USD", "€": "EUR", "£": "GBP", "¥": "JPY"}


def extract_links(pages: DataFrame, include_src: bool = False, absolute: bool = True, content: str = "content") -> DataFrame:
    """One row per link of a page: source_url, position, href, and target_url when ``absolute``."""
    found = F.regexp_extract_all(F.col(content), F.lit(ANCHOR), 1)
    if include_src:
        found = F.concat(found, F.regexp_extract_all(F.col(content), F.lit(SOURCE), 1))
    links = pages.select(F.col("url").alias("source_url"), F.posexplode(found).alias("position", "href"))
    links = links.withColumn("href", F.replace("href", F.lit("&amp;"), F.lit("&")))
    return links.withColumn("target_url", urls.absolute_url(F.col("source_url"), F.col("href"))) if absolute else links


def extract_link_tags(pages: DataFrame, content: str = "content") -> DataFrame:
    """Links with their ``rel`` attribute: source_url, position, target_url, rel."""
    tags = F.regexp_extract_all(F.col(content), F.lit(ANCHOR_TAG), 0)
    tag = F.col("tag")
    attribute = lambda name: F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*["']([^"']*)["']""", 1)
    return (
        pages.select(F.col("url").alias("source_url"), F.posexplode(tags).alias("position", "tag"))
        .withColumn("href", attribute("href"))
        .filter(F.col("href") != "")
        .select(
            "source_url",
            "position",
            urls.absolute_url(F.col("source_url"), F.replace("href", F.lit("&amp;"), F.lit("&"))).alias("target_url"),
            attribute("rel").alias("rel"),
        )
    )


def convert_html(pages: DataFrame, formats: Sequence[str], options: Sequence[str] = (), content: str = "content") -> DataFrame:
    """Pages in several content formats, long form ``(url, format, content)``."""
    unknown = (set(formats) - set(CONVERTIBLE)) | (set(options) - set(FORMAT_OPTIONS))
    if unknown:
        raise ValueError(f"unknown formats or options {sorted(unknown)}")
    page, shown = F.col(content), F.col("_shown")
    made: dict[str, Column] = {}
    for name in formats:
        if name == "html":
            made[name] = page
        elif name == "clean_html":
            made[name] = H.clean_html(shown)
        elif name == "text":
            made[name] = H.html_text(shown)
        elif name == "markdown":
            made[name] = H.markdown(shown, "no_images" in options, "no_links" in options)
        elif name == "json":
            made[name] = H.structured(page, shown)
        else:
            made[name] = F.to_json(H.page_metadata(page))
    others = [c for c in pages.columns if c != content]
    rows = F.array(*[F.struct(F.lit(n).alias("format"), c.alias("content")) for n, c in made.items()])
    # the visible part is worked out once, in a projection of its own
    shared = pages.withColumn("_shown", H.visible(page, "only_content" in options))
    return shared.select(*others, F.inline(rows))


def page_metadata(pages: DataFrame, content: str = "content") -> DataFrame:
    return pages.select("url", H.page_metadata(F.col(content)).alias("m")).select("url", "m.*")


# --- typed values ----------------------------------------------------------------------------


def prices(text: Column) -> Column:
    """``array<struct<amount, currency>>`` of the prices in a text."""
    raw = F.regexp_extract_all(text, F.lit(r"([$€£¥] ?[0-9][0-9,]*(?:\.[0-9]+)?)"), 1)
    code = F.create_map(*[F.lit(v) for pair in CURRENCY.items() for v in pair])
    return F.transform(
        raw,
        lambda p: F.struct(
            F.regexp_replace(p, r"[^0-9.]", "").try_cast("double").alias("amount"),
            F.element_at(code, F.substring(p, 1, 1)).alias("currency"),
        ),
    )


def emails(text: Column) -> Column:
    """Distinct e-mail addresses in order of appearance."""
    return F.array_distinct(
        F.regexp_extract_all(text, F.lit(r"([A-Za-z0-9._%+\-]+@[A-Za-z0-9](?:[A-Za-z0-9.\-]*[A-Za-z0-9])?\.[A-Za-z]{2,})"), 1)
    )


def image_urls(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""(?is)<img\b[^>]*?\bsrc\s*=\s*["']([^"']*)["']"""), 1)


STRFTIME = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%y": "yy", "%b": "MMM", "%B": "MMMM"}
INPUT_DATES = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy", "MMM d, yyyy", "d MMMM yyyy")


def java_date_format(pattern: str) -> str:
    out, i = "", 0
    while i < len(pattern):
        token = pattern[i : i + 2]
        if token in STRFTIME:
            out += STRFTIME[token]
            i += 2
        elif token.startswith("%"):
            raise ValueError(f"unsupported date directive {token!r}")
        else:
            out += f"'{pattern[i]}'" if pattern[i].isalpha() else pattern[i]
            i += 1
    return out


def apply_formatters(values: Column, specs: Sequence[Mapping[str, Any]], base_url: Column | None = None) -> Column:
    """Formatters in order over ``array<string>``; ``datetime`` and ``pick`` take arguments."""
    for spec in specs:
        name, args = spec["name"], spec.get("args") or {}
        if name == "uppercase":
            values = F.transform(values, lambda v: F.upper(v))
        elif name == "lowercase":
            values = F.transform(values, lambda v: F.lower(v))
        elif name == "remove_html":
            values = F.transform(values, lambda v: F.trim(F.regexp_replace(v, *H.ANY_TAG)))
        elif name == "absolute_url":
            if base_url is None:
                raise ValueError("absolute_url needs a base_url")
            values = F.transform(values, lambda v: urls.absolute_url(base_url, v))
        elif name == "unique":
            values = F.array_distinct(values)
        elif name == "datetime":
            out = java_date_format(args["format"])
            values = F.transform(
                values,
                lambda v: F.date_format(F.coalesce(*[F.try_to_timestamp(v, F.lit(p)) for p in INPUT_DATES]), out),
            )
        elif name == "pick":
            key = args["key"]
            values = F.transform(values, lambda v: F.get_json_object(v, f"$.{key}"))
        else:
            raise ValueError(f"unknown formatter {name!r}")
    return values


def cast_values(values: Column, kind: str) -> Column:
    types = {"float": "double", "int": "bigint", "str": "string", "bool": "boolean"}
    if kind not in types:
        raise ValueError(f"unknown cast {kind!r}")
    return F.transform(values, lambda v: v.try_cast(types[kind]))


# --- chunks and retrieval --------------------------------------------------------------------


def chunk_documents(documents: DataFrame, size: int = 1000, overlap: int = 200, text: str = "text") -> DataFrame:
    """Overlapping windows over the whole text: chunk_idx, start, chunk."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    step = size - overlap
    length = F.length(F.col(text))
    last = F.greatest(F.ceil((length - size) / step), F.lit(0)).cast("int")
    others = [c for c in documents.columns if c != text]
    pieces = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            i.alias("chunk_idx"), (i * step).alias("start"), F.substring(F.col(text), i * step + 1, F.lit(size)).alias("chunk")
        ),
    )
    return documents.filter(length > 0).select(*others, F.inline(pieces))


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    values = table[column].combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(values), -1)


def retrieve_top_k(vectors: DataFrame, queries: DataFrame, k: int = 4, block: int = 1024, vector_block: int = 4096) -> DataFrame:
    """The k nearest vectors to each query by cosine similarity; exact.

    Vectors and queries are packed into blocks, each pair of blocks is scored as
    one matrix product, and only the k best of each query leave it. No row but a
    pair of blocks ever carries both. Vectors of another dimension than a query's are not compared with it; a
    vector without length, or one that holds nulls, has no score and comes last. Rows without a vector take no part.
    """

    def packed(rows: DataFrame, row_id: str, number: str, per_block: int) -> tuple[DataFrame, int]:
        rows = rows.filter(F.col("embedding").isNotNull()).select(F.size("embedding").alias("dim"), F.col(row_id), F.col("embedding").cast("array<double>").alias("v"))
        parts = max(1, -(-rows.count() // per_block))
        placed = rows.withColumn(number, F.pmod(F.xxhash64(row_id), F.lit(parts)).cast("int"))
        return placed.groupBy("dim", number).agg(F.collect_list(F.struct(row_id, "v")).alias(f"{number}s")), parts

    left, vector_parts = packed(vectors, "vec_id", "_vector", vector_block)
    right, query_parts = packed(queries, "query_id", "_query", block)
    pairs = left.withColumn("_query", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1)))).join(right, ["dim", "_query"])
    query_type = queries.schema["query_id"].dataType.simpleString()
    vec_type = vectors.schema["vec_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held, asked = (pa.Table.from_batches([pa.RecordBatch.from_struct_array(batch.column(c)[i].values)]) for c in ("_vectors", "_querys"))
                v, q = _matrix(held, "v"), _matrix(asked, "v")
                length = np.linalg.norm(v, axis=1) * np.linalg.norm(q, axis=1)[:, None]
                with np.errstate(invalid="ignore", divide="ignore"):
                    scores = np.where(length > 0, (q @ v.T) / length, np.nan)
                ids = held["vec_id"].to_numpy()
                for query_id, s in zip(asked["query_id"], scores):
                    best = np.lexsort((ids, np.where(np.isnan(s), np.inf, -s)))[:k]
                    out = [pa.array([query_id.as_py()] * len(best), query_id.type), held["vec_id"].combine_chunks().take(pa.array(best)), pa.array(s[best])]
                    yield pa.RecordBatch.from_arrays(out, ["query_id", "vec_id", "score"])

    scored = pairs.select("_vectors", "_querys").mapInArrow(score, f"query_id {query_type}, vec_id {vec_type}, score double")
    scored = scored.withColumn("score", F.nanvl("score", F.lit(None).cast("double")))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
