"""Predicates, lookups, derived flags and request checks."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from crawlweave.functions import errors as E, http, patterns, urls
from crawlweave.functions.html import bind

MAX_PATHS = 100
MAX_DOMAINS = 250
MAX_BATCH = 100

# fixed values: event names a crawl may subscribe to
CRAWL_EVENTS = (
    "crawler_started",
    "crawler_stopped",
    "crawler_cancelled",
    "crawler_finished",
    "crawler_url_visited",
    "crawler_url_skipped",
    "crawler_url_discovered",
    "crawler_url_failed",
)


def responses(records: DataFrame) -> DataFrame:
    """HTTP responses with a usable status."""
    return records.filter((F.col("record_type") == "response") & (F.coalesce(F.col("status_code"), F.lit(0)) != 0))


def filter_status(pages: DataFrame, code: int, column: str = "status_code") -> DataFrame:
    """Rows with this status; a missing or non-numeric status counts as 0."""
    number = status_number(pages, column)
    return pages.filter((number == code) | number.isNull() if code == 0 else number == code)


def status_number(pages: DataFrame, column: str) -> Column:
    """Integer columns are compared bare, so that the filter reaches the scan."""
    col = F.col(column)
    if pages.schema[column].dataType.typeName() in ("byte", "short", "integer", "long"):
        return col
    return F.coalesce(col.try_cast("int"), F.lit(0))


def filter_content_type(pages: DataFrame, text: str, column: str = "content_type") -> DataFrame:
    """Case-insensitive substring match."""
    return pages.filter(F.contains(F.lower(F.col(column)), F.lit(text.lower())))


def read_url(pages: DataFrame, url: str, order: Sequence[str] = ("path", "record_seq")) -> DataFrame:
    """First record of exactly this URL, by file and place in it; no row when absent."""
    return pages.filter(F.col("url") == url).orderBy(*order).limit(1)


def page_contents(records: DataFrame) -> DataFrame:
    """Responses as readable content with the metadata of their archive headers.

    The body is decoded as UTF-8, invalid bytes become U+FFFD.
    """
    w = F.col("warc_headers")
    return records.select(
        "url",
        http.utf8_text(F.col("content")).alias("content"),
        "status_code",
        "headers",
        w["WARC-Scrape-Duration"].try_cast("double").alias("duration"),
        w["WARC-Scrape-Log-Id"].alias("log_id"),
        w["WARC-Scrape-Country"].alias("country"),
        "path",
        "record_seq",
    )


def filter_url_pattern(pages: DataFrame, pattern: str, column: str = "url") -> DataFrame:
    """Glob over the whole URL."""
    return pages.filter(patterns.matches_glob(F.col(column), pattern))


def filter_paths(
    df: DataFrame,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    seed: str | None = None,
    syntax: str = "wildcard",
    column: str = "url",
) -> DataFrame:
    """Keep or drop URLs by path patterns; the seed is always kept."""
    if include and exclude:
        raise ValueError("include and exclude are mutually exclusive")
    chosen = list(include or exclude)
    if not chosen:
        return df
    if len(chosen) > MAX_PATHS:
        raise ValueError(f"at most {MAX_PATHS} path patterns")
    if syntax == "wildcard":
        regex = patterns.any_glob_regex(chosen, wildcards="*")
    elif syntax == "regex":
        regex = "|".join(f"(?:{p})" for p in chosen)
    else:
        raise ValueError("syntax is wildcard or regex")
    hit = urls.path(F.col(column)).rlike(regex)
    keep = hit if include else ~hit
    if seed is not None:
        keep = keep | (F.col(column) == seed)
    return df.filter(keep)


def scope_links(
    links: DataFrame,
    seed: str | Column,
    follow_external_links: bool = False,
    allowed_external_domains: Sequence[str] = (),
    follow_internal_subdomains: bool = True,
    allowed_internal_subdomains: Sequence[str] = (),
    ignore_base_path_restriction: bool = False,
    social_domains: Sequence[str] = (),
    source: str = "source_url",
    target: str = "href",
) -> DataFrame:
    """Add ``scope`` (internal, subdomain, external, out) and ``follow``.

    External pages are read, but the links found on them are not followed:
    ``follow`` is false for links whose source is outside the seed's site.
    """
    if len(allowed_external_domains) > MAX_DOMAINS or len(allowed_internal_subdomains) > MAX_DOMAINS:
        raise ValueError(f"at most {MAX_DOMAINS} domains")
    seed_col = F.lit(seed) if isinstance(seed, str) else seed
    seed_host = urls.host(seed_col)
    to, origin = F.col(target), F.col(source)
    to_host, origin_host = urls.host(to), urls.host(origin)
    base = F.regexp_replace(urls.path(seed_col), r"/$", "")
    to_path = urls.path(to)
    in_base = F.lit(True) if ignore_base_path_restriction else ((to_path == base) | to_path.startswith(F.concat(base, F.lit("/"))))
    below = F.endswith(to_host, F.concat(F.lit("."), seed_host))
    subdomain = F.lit(follow_internal_subdomains)
    if allowed_internal_subdomains:
        subdomain = subdomain & to_host.rlike(patterns.any_glob_regex(list(allowed_internal_subdomains)))
    external = F.lit(follow_external_links)
    if allowed_external_domains:
        external = external & to_host.rlike(patterns.any_glob_regex(list(allowed_external_domains)))
    elif social_domains:
        external = external & ~to_host.isin(*social_domains)
    scope = (
        F.when(to_host == "", "out")
        .when(to_host == seed_host, F.when(in_base, "internal").otherwise("out"))
        .when(below, F.when(subdomain, "subdomain").otherwise("out"))
        .when(external, "external")
        .otherwise("out")
    )
    home = (origin_host == seed_host) | F.endswith(origin_host, F.concat(F.lit("."), seed_host))
    return links.withColumn("scope", scope).withColumn("follow", home & (F.col("scope") != "out"))


def result_flags(results: DataFrame, log_base: str = "") -> DataFrame:
    """Success and error flags of page results.

    ``success`` is a 2xx page, ``error`` a page of 400 or more. With a column
    ``api_status`` the answer of the service itself is told apart as ``api_success``.
    """
    status = F.col("status_code")
    added = {
        "success": F.coalesce((status >= 200) & (status < 300), F.lit(False)),
        "error": F.coalesce(status >= 400, F.lit(False)),
    }
    if "log_id" in results.columns:
        added["log_url"] = F.when(F.col("log_id").isNotNull(), F.concat(F.lit(log_base), F.col("log_id")))
    if "api_status" in results.columns:
        added["api_success"] = F.col("api_status").between(200, 299)
    return results.withColumns(added)


def crawl_status_flags(status: DataFrame) -> DataFrame:
    """State flags and progress of a crawl; needs status, is_success, urls_visited, urls_extracted."""
    done = F.col("status") == "DONE"
    extracted, visited = F.col("urls_extracted"), F.col("urls_visited")
    return status.withColumns(
        {
            "is_complete": done & F.coalesce(F.col("is_success"), F.lit(False)),
            "is_running": F.col("status").isin("PENDING", "RUNNING"),
            "is_failed": done & F.coalesce(~F.col("is_success"), F.lit(False)),
            "is_cancelled": F.col("status") == "CANCELLED",
            "progress_pct": F.when(extracted == 0, F.lit(0.0)).otherwise(F.try_divide(visited, extracted) * 100),
        }
    )


def restore_reject(results: DataFrame, headers: str = "headers") -> DataFrame:
    """Rebuild an error from reject headers, whatever their vendor prefix."""
    h = F.col(headers)
    retryable = F.lower(F.coalesce(http.header_ending(h, "-reject-retryable"), F.lit("false")))
    return results.withColumns(
        {
            "error_code": http.header_ending(h, "-reject-code"),
            "error_message": http.header_ending(h, "-reject-description"),
            "error_http_code": http.header_ending(h, "-reject-http-code").try_cast("int"),
            "retryable": retryable.isin("yes", "true"),
            "doc_url": http.header_ending(h, "-reject-doc"),
        }
    )


def classify_errors(failures: DataFrame) -> DataFrame:
    """Class, message, retry delay and retry count of failed results.

    Needs ``api_status`` (answer of the service), ``upstream_status``,
    ``error_code``, ``error_message``, ``retryable``; uses ``description``,
    ``retry_after`` and ``has_retry_header`` when present.
    """
    code = F.col("error_code")
    http_code = F.when(code == E.BAD_UPSTREAM, F.col("upstream_status")).otherwise(F.col("api_status"))
    kind_is_http = ~F.coalesce(F.col("api_status").between(200, 299), F.lit(False))
    retryable = F.coalesce(F.col("retryable"), F.lit(False))
    delay = F.lit(E.RETRY_DELAY_SECONDS)
    if "retry_after" in failures.columns:
        has_header = F.col("has_retry_header") if "has_retry_header" in failures.columns else F.lit(True)
        delay = F.when(retryable & has_header, F.coalesce(F.col("retry_after"), delay)).otherwise(delay)
    message = F.concat_ws(" ", http_code.cast("string"), code, F.col("error_message"))
    if "description" in failures.columns:
        text = F.col("description")
        message = F.when(text.isNotNull() & (text != ""), F.concat(message, F.lit(": "), text)).otherwise(message)
    message = F.when(
        retryable, F.concat(message, F.lit(". Retry delay : "), delay.cast("string"), F.lit(" seconds"))
    ).otherwise(message)
    return failures.withColumns(
        {
            "http_code": http_code,
            "resource": E.error_resource(code),
            "error_class": E.error_class(kind_is_http, http_code, code),
            "full_message": message,
            "is_retryable": retryable,
            "retry_delay": delay,
            "retry_times": F.lit(E.RETRY_TIMES),
        }
    )


def usage_columns(results: DataFrame, headers: str = "headers") -> DataFrame:
    """Quota, cost and duration out of response headers."""
    h = F.col(headers)
    quota = http.header_ending(h, "-remaining-api-credit").try_cast("bigint")
    return results.withColumns(
        {
            "remaining_quota": quota,
            "cost": http.header_ending(h, "-api-cost").try_cast("bigint"),
            "duration_ms": http.header_ending(h, "-response-time").try_cast("double"),
            "quota_exhausted": F.coalesce(quota == 0, F.lit(False)),
        }
    )


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): rows with all, or not all, of the required columns."""
    marked = mark_valid(df, required)
    return (
        marked.filter("is_valid").drop("is_valid", "missing"),
        marked.filter("NOT is_valid").drop("is_valid"),
    )


def mark_valid(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return df.withColumn("missing", F.array_join(missing, ",")).withColumn("is_valid", F.col("missing") == "")


def validate_requests(requests: DataFrame) -> DataFrame:
    """Violations ``(request_id, rule, code)`` of a request table.

    Used where present: ``batch_id``, ``correlation_id``, ``body``, ``data``,
    ``template``, ``inline_template``, ``url``, ``url_list``,
    ``remote_url_list``, ``exclude_paths``, ``include_only_paths``,
    ``webhook_events``. A repeated correlation id is reported on every request
    but the first (lowest request_id) of its batch.
    """
    have = set(requests.columns)
    filled = lambda name: F.col(name).isNotNull() & (F.length(F.col(name)) > 0)
    rules: list[tuple[str, str, Column]] = []
    if {"batch_id", "correlation_id"} <= have:
        absent = F.col("correlation_id").isNull() | (F.col("correlation_id") == "")
        rules.append(("missing_correlation_id", "422", absent & F.col("batch_id").isNotNull()))
    if {"body", "data"} <= have:
        rules.append(("body_and_data", "400", filled("body") & filled("data")))
    if {"template", "inline_template"} <= have:
        rules.append(("template_and_inline_template", "400", filled("template") & filled("inline_template")))
    sources = [c for c in ("url", "url_list", "remote_url_list") if c in have]
    if len(sources) > 1:
        given = sum((filled(c).cast("int") for c in sources), F.lit(0))
        rules.append(("no_url_source", "400", given == 0))
        rules.append(("several_url_sources", "400", given > 1))
    if {"exclude_paths", "include_only_paths"} <= have:
        both = (F.size("exclude_paths") > 0) & (F.size("include_only_paths") > 0)
        rules.append(("exclusive_path_filters", "400", F.coalesce(both, F.lit(False))))
    if "webhook_events" in have:
        known = F.array(*[F.lit(e) for e in CRAWL_EVENTS])
        unknown = F.size(F.array_except("webhook_events", known)) > 0
        rules.append(("unknown_event", "400", F.coalesce(unknown, F.lit(False))))
    found = F.array_compact(
        F.array(*[F.when(test, F.struct(F.lit(rule).alias("rule"), F.lit(code).alias("code"))) for rule, code, test in rules])
    )
    out = requests.select("request_id", F.explode(found).alias("v")).select("request_id", "v.rule", "v.code")
    if {"batch_id", "correlation_id"} <= have:
        named = requests.filter((F.col("correlation_id") != "") & F.col("batch_id").isNotNull())
        repeated = (
            named.groupBy("batch_id", "correlation_id")
            .agg(F.min("request_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1")
        )
        reused = (
            named.select("batch_id", "correlation_id", "request_id")
            .join(repeated, ["batch_id", "correlation_id"])
            .filter(F.col("request_id") > F.col("first_id"))
            .select("request_id", F.lit("reused_correlation_id").alias("rule"), F.lit("422").alias("code"))
        )
        oversize = (
            requests.filter(F.col("batch_id").isNotNull())
            .groupBy("batch_id")
            .agg(F.min("request_id").alias("request_id"), F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > MAX_BATCH)
            .select("request_id", F.lit("batch_too_large").alias("rule"), F.lit("400").alias("code"))
        )
        out = out.unionByName(reused).unionByName(oversize)
    return out


def parse_api_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_ts`` for each named string column; text of another form gives null and stays as it is."""
    return df.withColumns({f"{c}_ts": http.api_timestamp(F.col(c)) for c in columns})


def content_kind(results: DataFrame, column: str = "content_type") -> DataFrame:
    return results.withColumn("kind", http.content_kind(F.col(column)))


@dataclass(frozen=True)
class BlockRule:
    """One user-supplied sign of an anti-bot page; unset fields match anything."""

    vendor: str
    statuses: tuple[int, ...] = ()
    headers: Mapping[str, str] = field(default_factory=dict)
    body: str | None = None


def detect_blocked(pages: DataFrame, rules: Sequence[BlockRule], cost: int = 1) -> DataFrame:
    """Add ``valid_input``, ``blocked``, ``antibot`` and ``cost``; the first matching rule wins.

    Needs ``url``, ``status_code``, ``headers`` (map with lower-case names) and ``content``.
    Rules are an ordered driver-side list and become one ``when`` chain, not a join.
    """
    vendor = F.lit(None).cast("string")
    for rule in reversed(rules):
        tests = []
        if rule.statuses:
            tests.append(F.col("status_code").isin(*rule.statuses))
        for name, regex in rule.headers.items():
            tests.append(F.coalesce(F.col("headers")[name.lower()].rlike(regex), F.lit(False)))
        if rule.body is not None:
            tests.append(F.coalesce(F.col("content").rlike(rule.body), F.lit(False)))
        if not tests:
            raise ValueError(f"rule {rule.vendor!r} has no condition")
        hit = tests[0]
        for test in tests[1:]:
            hit = hit & test
        vendor = F.when(hit, rule.vendor).otherwise(vendor)
    valid = F.coalesce(
        F.col("url").isNotNull() & (F.col("url") != "") & F.col("status_code").between(100, 599), F.lit(False)
    )
    marked = pages.withColumn("valid_input", valid).withColumn("antibot", F.when(F.col("valid_input"), vendor))
    return marked.withColumn("blocked", F.when(F.col("valid_input"), F.col("antibot").isNotNull())).withColumn(
        "cost", F.when(F.col("valid_input"), F.lit(cost)).otherwise(F.lit(0))
    )


def word_run(text: Column) -> Column:
    """A-Z, a-z and 0-9 of a text as lower-case words with one blank between them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " "))


def block_conditions(rules: DataFrame) -> DataFrame:
    """Conditions of block rules, one row for each way to meet one: rule_ord, vendor, n_conditions, condition, kind, key, literal.

    ``rules``: rule_ord, vendor, statuses (array), headers (map of name to a text the value holds), body (words).
    """
    named = rules.select("rule_ord", "vendor", *[F.col(c) for c in ("statuses", "headers", "body")])
    none = F.lit("")
    status = named.select(
        "rule_ord", "vendor", F.lit("status").alias("condition"), F.lit("status").alias("kind"), F.explode(F.col("statuses").cast("array<string>")).alias("key"), none.alias("literal")
    )
    headers = named.select("rule_ord", "vendor", F.explode("headers").alias("name", "literal")).select(
        "rule_ord", "vendor", F.concat(F.lit("header "), F.lower("name")).alias("condition"), F.lit("header").alias("kind"), F.lower("name").alias("key"), "literal"
    )
    words = named.withColumn("key", word_run(F.col("body"))).filter("key <> ''")
    body = words.select("rule_ord", "vendor", F.lit("body").alias("condition"), F.lit("body").alias("kind"), "key", none.alias("literal"))
    every = status.unionByName(headers).unionByName(body)
    counts = every.groupBy("rule_ord").agg(F.count_distinct("condition").cast("int").alias("n_conditions"))
    return every.join(counts, "rule_ord")


def detect_blocked_by(pages: DataFrame, rules: DataFrame, key: str = "page_id", cost: int = 1) -> DataFrame:
    """``key``, ``valid_input``, ``blocked``, ``antibot`` and ``cost`` of pages under a table of rules; the first rule by
    ``rule_ord`` whose conditions all hold wins.

    A rule holds where the status is one of ``statuses``, each named header holds its text, and the words of
    ``body`` follow each other in the content; what a rule leaves out is not asked, a rule that asks nothing never holds. ``pages``:
    key, url, status_code, headers (map) and content. What a page shows (status, header names, runs of as many words as
    the rules' bodies have) meets the conditions in a join, so there is no bound on the number of rules, and no body is
    shuffled. Names of headers and words of bodies match in any case.
    """
    conditions = block_conditions(rules)
    lengths = [r[0] for r in conditions.filter("kind = 'body'").select(F.size(F.split("key", " "))).distinct().collect()]  # a few numbers
    words = F.split(word_run(F.coalesce("content", F.lit(""))), " ")
    signal = lambda kind, name, value: F.struct(F.lit(kind).alias("kind"), name.alias("key"), value.alias("value"))
    shown = [
        F.array(signal("status", F.col("status_code").cast("string"), F.lit(""))),
        F.transform(F.coalesce(F.map_entries("headers"), F.array()), lambda h: signal("header", F.lower(h["key"]), F.coalesce(h["value"], F.lit("")))),
    ]


    def runs(words: Column, n: int) -> Column:
        places = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.array_join(F.slice(words, i, n), " "))

    if lengths:
        text_runs = bind(words, lambda w: F.array_distinct(F.flatten(F.array(*[runs(w, n) for n in sorted(lengths)]))))
        shown.append(F.transform(text_runs, lambda t: signal("body", t, F.lit(""))))
    valid = F.coalesce(F.col("url").isNotNull() & (F.col("url") != "") & F.col("status_code").between(100, 599), F.lit(False))
    signals = pages.filter(valid).select(F.col(key).alias("_page"), F.explode(F.flatten(F.array(*shown))).alias("_s")).select("_page", "_s.*")
    met = signals.join(conditions, ["kind", "key"]).filter(F.contains("value", "literal"))
    whole = met.groupBy("_page", "rule_ord", "vendor", "n_conditions").agg(F.count_distinct("condition").alias("n")).filter("n = n_conditions")
    first = whole.groupBy("_page").agg(F.min_by("vendor", "rule_ord").alias("antibot"))
    judged = pages.select(key, valid.alias("valid_input")).join(first.withColumnRenamed("_page", key), key, "left")
    return judged.select(
        key, "valid_input", F.when(F.col("valid_input"), F.col("antibot").isNotNull()).alias("blocked"), "antibot",
        F.when(F.col("valid_input"), F.lit(cost)).otherwise(F.lit(0)).alias("cost"),
    )


@dataclass(frozen=True)
class ExtractionRule:
    """Ordered extraction rule; ``pattern`` is a path with ``*`` wildcards."""

    pattern: str
    type: str
    value: str = ""


def match_rules(pages: DataFrame, rules: Sequence[ExtractionRule], column: str = "url") -> DataFrame:
    """Add ``rule_ord``, ``rule_pattern``, ``rule_type`` and ``rule_value`` of the first rule matching the decoded path."""
    if len(rules) > 100:
        raise ValueError("at most 100 rules")
    if len(rules) > 50:
        warnings.warn("more than 50 extraction rules", stacklevel=2)
    for rule in rules:
        if rule.type not in ("model", "prompt", "template"):
            raise ValueError(f"unknown rule type {rule.type!r}")
        if len(rule.pattern) > patterns.MAX_PATTERN_LENGTH:
            raise ValueError("pattern longer than 1000 characters")
    path = F.col("_path")
    chosen = F.lit(None).cast("int")
    for i in reversed(range(len(rules))):
        pattern = rules[i].pattern
        test = path.rlike(patterns.any_glob_regex([pattern], wildcards="*")) if "*" in pattern else path == pattern
        chosen = F.when(test, F.lit(i)).otherwise(chosen)

    def pick(attribute: str) -> Column:
        values = F.array(*[F.lit(getattr(r, attribute)) for r in rules]).cast("array<string>")
        return F.get(values, F.col("rule_ord"))

    return (
        pages.withColumn("_path", urls.decoded_path(F.col(column)))
        .withColumn("rule_ord", chosen)
        .withColumns({"rule_pattern": pick("pattern"), "rule_type": pick("type"), "rule_value": pick("value")})
        .drop("_path")
    )
