"""Lookups of the crawl world as joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from crawlweave.functions import errors as E
from crawlweave.operators import filters, ordering

FORMATS = ("html", "clean_html", "markdown", "text", "json", "extracted_data", "page_metadata")


def dedupe_records(records: DataFrame, keep: str = "last", keys: Sequence[str] = ("url",), order: Sequence[str] = ("path", "record_seq")) -> DataFrame:
    """First or last record per key; ``order`` tells the records of a key apart.

    Only keys and order are aggregated, then the chosen records are joined back, so bodies are moved once and not sorted.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep is first or last")
    pick = F.max if keep == "last" else F.min
    chosen = records.groupBy(*keys).agg(pick(F.struct(*order)).alias("_best")).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(f"_best.{c}").alias(f"_o_{c}") for c in order]
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in order]
    return records.join(chosen, same, "left_semi")


def content_with_metadata(contents: DataFrame, records: DataFrame, keep: str = "last", keys: Sequence[str] = ("url",)) -> DataFrame:
    """Page content left-joined with the metadata of its archive record.

    ``records`` needs url, status_code, headers, warc_headers and an order
    (path, record_seq). Without metadata the status is 200 and the rest null.
    Bodies of the archive are never shuffled.
    """
    w = F.col("warc_headers")
    meta = records.select(
        *keys,
        "path",
        "record_seq",
        "status_code",
        "headers",
        w["WARC-Scrape-Duration"].try_cast("double").alias("duration"),
        w["WARC-Scrape-Log-Id"].alias("log_id"),
        w["WARC-Scrape-Country"].alias("country"),
    )
    meta = dedupe_records(meta, keep, keys).drop("path", "record_seq")
    kept = contents.filter(F.col("content").isNotNull() & (F.col("content") != ""))
    empty = F.create_map().cast("map<string,string>")
    return kept.join(meta, list(keys), "left").withColumns(
        {"status_code": F.coalesce("status_code", F.lit(200)), "headers": F.coalesce("headers", empty)}
    )


def match_batch_results(requests: DataFrame, results: DataFrame, bucket_width: int = 1_000_000) -> DataFrame:
    """Batch results with the configuration they belong to.

    ``requests``: batch_id, idx, correlation_id, config. ``results``: batch_id,
    arrival_seq, correlation_id, payload columns. An unknown correlation id
    falls back to the first request of the batch; requests without a result
    stay as ``missing``.
    """
    asked = requests.select("batch_id", "correlation_id", "idx", "config")
    first = requests.groupBy("batch_id").agg(F.min_by("config", "idx").alias("first_config"))
    arrived = ordering.running(
        results, ["batch_id"], ["arrival_seq"], ordering.id_range("arrival_seq", bucket_width), rank="arrival_rank"
    )
    # left and anti join instead of a full outer one: AQE can split a hot id only in the former
    matched = arrived.join(asked, ["batch_id", "correlation_id"], "left").withColumn(
        "match_kind", F.when(F.col("idx").isNull(), "fallback").otherwise("matched")
    )
    missing = asked.join(results, ["batch_id", "correlation_id"], "left_anti").withColumn("match_kind", F.lit("missing"))
    return (
        matched.unionByName(missing, allowMissingColumns=True)
        .join(first, "batch_id", "left")
        .withColumn("config", F.coalesce("config", "first_config"))
        .drop("first_config")
    )


def lookup_urls(contents: DataFrame, wanted: DataFrame, formats: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Content of the wanted URLs, one column per format. URLs without content are left out.

    Of several contents of a URL in one format the last by ``order`` counts; without an order they must not occur twice.
    """
    unknown = set(formats) - set(FORMATS)
    if unknown:
        raise ValueError(f"unknown formats {sorted(unknown)}")
    found = contents.filter(F.col("format").isin(*formats) & F.col("content").isNotNull())
    found = found.join(wanted.select("url"), "url", "left_semi")
    if order:
        found = dedupe_records(found.select("url", "format", "content", *order), "last", ("url", "format"), order)
    return found.groupBy("url").pivot("format", list(formats)).agg(F.max("content"))


def lookup_report(contents: DataFrame, wanted: DataFrame, formats: Sequence[str]) -> DataFrame:
    """One row: distinct URLs requested and found, and how many are missing."""
    have = contents.filter(F.col("format").isin(*formats) & F.col("content").isNotNull()).select("url").distinct()
    asked = wanted.select("url").distinct()
    marked = asked.join(have.withColumn("hit", F.lit(1)), "url", "left")
    return marked.agg(
        F.count(F.lit(1)).alias("requested"),
        F.count("hit").alias("found"),
        F.count_if(F.col("hit").isNull()).alias("missing"),
    )


def missing_urls(contents: DataFrame, wanted: DataFrame, formats: Sequence[str]) -> DataFrame:
    """Wanted URLs without content in any of the formats."""
    have = contents.filter(F.col("format").isin(*formats) & F.col("content").isNotNull())
    return wanted.select("url").distinct().join(have, "url", "left_anti")


def new_links(
    links: DataFrame,
    seen: DataFrame | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Each link of a page once, owned by the first rule that yields it.

    ``links``: source_url, target_url, rule_idx. ``transform`` stands for the
    user's link hooks. ``seen``: target_url already requested.
    """
    candidates = links.transform(transform) if transform else links
    owned = candidates.groupBy("source_url", "target_url").agg(F.min("rule_idx").alias("rule_idx"))
    if seen is None:
        return owned
    return owned.join(seen.select("target_url").distinct(), "target_url", "left_anti").select(
        "source_url", "target_url", "rule_idx"
    )


def retry_queue(
    failures: DataFrame, requests: DataFrame, max_retries: int = 5, custom_codes: Sequence[str] = ()
) -> DataFrame:
    """Next-attempt rows of failures worth another try.

    ``failures``: request_id, error_code, retryable, retry_after (nullable),
    never_received (tried again after a second, whatever else the row says). ``requests``: request_id, url, retry_times, priority, cache.
    """
    retry = F.coalesce(F.col("retryable"), F.lit(False))
    lost = F.coalesce(F.col("never_received"), F.lit(False)) if "never_received" in failures.columns else F.lit(False)
    custom = F.col("error_code").isin(*custom_codes) if custom_codes else F.lit(False)
    chosen = failures.filter(lost | retry | custom).select(
        "request_id",
        "error_code",
        F.when(retry & ~lost, F.coalesce(F.col("retry_after"), F.lit(1))).otherwise(F.lit(1)).alias("delay_s"),
    )
    attempt = F.coalesce(F.col("retry_times"), F.lit(0)) + 1
    return (
        chosen.join(requests, "request_id")
        .withColumn("attempt", attempt)
        .filter(F.col("attempt") < max_retries)
        .select(
            "request_id",
            "url",
            "error_code",
            "delay_s",
            "attempt",
            (F.coalesce(F.col("priority"), F.lit(0)) + 100).alias("priority"),
            F.coalesce(F.col("cache"), F.lit(False)).alias("cache_clear"),
        )
    )


def explode_media_requests(items: DataFrame, column: str = "file_urls") -> DataFrame:
    """One request per media URL of an item.

    The column holds strings or structs with a ``url`` field; other element
    types are refused.
    """
    kind = items.schema[column].dataType
    element = getattr(kind, "elementType", None)
    if element is None:
        raise ValueError(f"{column} is not an array")
    name = element.typeName()
    others = [c for c in items.columns if c != column]
    media = items.select(*others, F.posexplode(column).alias("media_idx", "media"))
    if name == "string":
        return media.withColumn("media_url", F.col("media")).drop("media")
    if name == "struct" and "url" in element.names:
        return media.withColumn("media_url", F.col("media.url"))
    raise ValueError("media elements are strings or structs with a url")


def scrape_report(results: DataFrame) -> DataFrame:
    """What a reporter receives for each result or error."""
    error = F.when(
        F.col("error_class").isNotNull(),
        F.to_json(F.struct(F.col("full_message").alias("message"), F.col("error_class").alias("type"))),
    )
    scrape_error = F.when(
        F.col("error_code").isNotNull(),
        F.to_json(F.struct(F.col("error_code").alias("code"), F.col("error_message").alias("message"))),
    )
    return results.select("request_id", "scrape_config", "log_url", scrape_error.alias("scrape_error"), error.alias("error"))


def with_error_classes(log: DataFrame) -> DataFrame:
    """Error classes of log rows that failed; other rows keep null."""
    marked = filters.classify_errors(log)
    failed = F.col("error_code").isNotNull()
    return marked.withColumns(
        {c: F.when(failed, F.col(c)) for c in ("error_class", "full_message", "retry_delay", "retry_times", "resource")}
    )


def class_ancestors() -> dict[str, list[str]]:
    """Every error class with its ancestors, nearest first."""
    out: dict[str, list[str]] = {}
    for name in E.CLASS_PARENT:
        chain, parent = [], E.CLASS_PARENT[name]
        while parent:
            chain.append(parent)
            parent = E.CLASS_PARENT[parent]
        out[name] = chain
    return out
