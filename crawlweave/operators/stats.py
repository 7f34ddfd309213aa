"""Crawl statistics, costs, errors and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from crawlweave.functions import errors as E
from crawlweave.operators import filters, ordering

# fixed values: credits added per extracted page
EXTRACTION_SURCHARGE = {"model": 5, "prompt": 10, "template": 1}


def crawl_stats(status: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """State, progress, sizes and rates per crawl.

    ``status``: crawler_uuid, status, is_success and the URL counters.
    ``pages``: crawler_uuid, content; one partial aggregate per task, bodies are not shuffled.
    """
    flags = filters.crawl_status_flags(status)
    extracted = F.col("urls_extracted")
    out = flags.withColumn("crawl_rate", F.when(extracted > 0, F.col("urls_visited") / extracted * 100))
    if pages is None:
        return out
    sizes = pages.groupBy("crawler_uuid").agg(
        F.count(F.lit(1)).alias("pages_downloaded"), F.sum(F.octet_length("content")).alias("total_size_bytes")
    )
    total, count = F.col("total_size_bytes"), F.col("pages_downloaded")
    return (
        out.join(sizes, "crawler_uuid", "left")
        .fillna(0, ["pages_downloaded", "total_size_bytes"])
        .withColumns(
            {
                "total_size_kb": total / 1024,
                "total_size_mb": total / (1024 * 1024),
                "avg_page_size_bytes": F.when(count == 0, F.lit(0.0)).otherwise(F.try_divide(total, count)),
                "download_rate": F.when(extracted > 0, count / extracted * 100),
            }
        )
        .withColumn("avg_page_size_kb", F.col("avg_page_size_bytes") / 1024)
    )


def stats_by(pages: DataFrame, key: str) -> DataFrame:
    """Requests, average duration and successes per key."""
    return pages.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.avg("duration").alias("avg_duration"),
        F.count_if(F.col("status_code") == 200).alias("success_count"),
    )


def error_summary(failures: DataFrame, guard_stops: DataFrame | None = None) -> DataFrame:
    """Errors per crawl and code, with throttle pauses and stops.

    ``failures``: crawler_uuid, error_code. ``guard_stops``: one row per crawl
    stopped by the failure guard.
    """
    code = F.col("error_code")
    by_code = (
        failures.filter(code.isNotNull())
        .groupBy("crawler_uuid", "error_code")
        .agg(F.count(F.lit(1)).alias("errors"))
        .withColumns(
            {
                "throttle_pauses": F.when(code.isin(*E.THROTTLE_CODES), F.col("errors")).otherwise(F.lit(0)),
                "fatal_stops": F.when(code.isin(*E.FATAL_CODES), F.col("errors")).otherwise(F.lit(0)),
                "monitored_errors": F.when(code.isin(*E.MONITORED_CODES), F.col("errors")).otherwise(F.lit(0)),
            }
        )
    )
    if guard_stops is None:
        return by_code
    stops = guard_stops.select("crawler_uuid").distinct().withColumn("high_failure_rate_stops", F.lit(1))
    return by_code.join(stops, "crawler_uuid", "left").fillna(0, ["high_failure_rate_stops"])


def error_totals(failures: DataFrame, guard_stops: DataFrame | None = None) -> DataFrame:
    """One row per crawl: totals and the breakdown ``by_code`` as a map."""
    per_code = error_summary(failures, guard_stops)
    sums = ["errors", "throttle_pauses", "fatal_stops", "monitored_errors"]
    aggs = [F.sum(c).alias("total_errors" if c == "errors" else c) for c in sums]
    if guard_stops is not None:
        aggs.append(F.max("high_failure_rate_stops").alias("high_failure_rate_stops"))
    # error codes are a closed vocabulary, so the map is bounded
    return per_code.groupBy("crawler_uuid").agg(
        *aggs, F.map_from_entries(F.array_sort(F.collect_list(F.struct("error_code", "errors")))).alias("by_code")
    )


def credit_costs(pages: DataFrame, by: Sequence[Sequence[str]]) -> DataFrame:
    """Pages, credits and average cost for each list of grouping columns.

    ``pages``: base_credits, cached, extraction (nullable rule type) and the
    grouping columns. Cached pages cost nothing.
    """
    names = list(dict.fromkeys(c for group in by for c in group))
    costed = pages.withColumn("credits", page_credits())
    return (
        costed.groupingSets([[F.col(c) for c in group] for group in by], *[F.col(c) for c in names])
        .agg(
            F.grouping_id().alias("grouping"),
            F.count(F.lit(1)).alias("pages"),
            F.sum("credits").alias("credits"),
            F.avg("credits").alias("avg_credits"),
        )
    )


def page_credits() -> Column:
    """Credits of one page."""
    surcharge = F.lit(0)
    for kind, extra in EXTRACTION_SURCHARGE.items():
        surcharge = F.when(F.col("extraction") == kind, F.lit(extra)).otherwise(surcharge)
    return F.when(F.col("cached"), F.lit(0)).otherwise(F.col("base_credits") + surcharge)


def crawl_state(events: DataFrame) -> DataFrame:
    """URL counters per crawl out of its event log.

    ``events``: crawler_uuid, event, url, api_credit, ts, stop_reason
    (nullable). Distinct URLs are counted with Spark's two-phase distinct, so a
    large crawl is spread over tasks.
    """
    event, url = F.col("event"), F.col("url")
    extracted = F.count_distinct(F.when(event != "crawler_url_failed", url))
    return (
        events.groupBy("crawler_uuid")
        .agg(
            F.count_if(event == "crawler_url_visited").alias("urls_visited"),
            extracted.alias("urls_extracted"),
            F.count_if(event == "crawler_url_failed").alias("urls_failed"),
            F.count_if(event == "crawler_url_skipped").alias("urls_skipped"),
            F.sum("api_credit").alias("api_credit_used"),
            F.min("ts").alias("start_time"),
            F.max("ts").alias("stop_time"),
            F.max_by("stop_reason", F.when(F.col("stop_reason").isNotNull(), F.col("ts"))).alias("stop_reason"),
        )
        .withColumns(
            {
                "urls_to_crawl": F.col("urls_extracted") - F.col("urls_skipped"),
                "duration": (F.unix_micros(F.col("stop_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / 1e6,
            }
        )
    )


def retry_stats(attempts: DataFrame) -> DataFrame:
    """Retries in total and per error code; the total has a null code."""
    return attempts.rollup("error_code").agg(F.count(F.lit(1)).alias("retries"), F.grouping("error_code").alias("is_total"))


def trap_report(visits: DataFrame, traps: Mapping[str, tuple[str, int]], column: str = "url") -> DataFrame:
    """Hits per trap, 0 for a trap never hit.

    ``traps`` maps a name to (regex, greatest number of hits allowed). Every
    trap is counted in the same pass over the visits.
    """
    counted = visits.agg(*[F.count_if(F.col(column).rlike(rx)).alias(f"t{i}") for i, (rx, _) in enumerate(traps.values())])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("trap"), F.col(f"t{i}").alias("hits"), F.lit(limit).cast("bigint").alias("max_hits"))
            for i, (name, (_, limit)) in enumerate(traps.items())
        ]
    )
    return counted.select(F.inline(rows)).withColumn("passed", F.col("hits") <= F.col("max_hits"))


def timing_breakdown(entries: DataFrame) -> DataFrame:
    """Requests, average and median milliseconds per phase, ``total`` included.

    ``entries``: time, timings (map). Both are exact: the median is the mean of
    the middle ones of all values, found by their ranks.
    """
    phases = F.map_concat(F.create_map(F.lit("total"), F.col("time")), F.coalesce("timings", F.create_map().cast("map<string,double>")))
    long_form = entries.select(F.explode(phases).alias("phase", "ms")).filter(F.col("ms") >= 0)
    ranked = ordering.ranged(long_form, ["phase"], ["ms"])
    totals = ranked.groupBy("phase").agg(F.max("rank").alias("requests"), F.avg("ms").alias("avg_ms"))
    middle = (F.col("rank") >= F.col("requests") / 2) & (F.col("rank") <= F.col("requests") / 2 + 1)
    both = ranked.join(totals, "phase").filter(middle).groupBy("phase")
    return both.agg(F.first("requests").alias("requests"), F.first("avg_ms").alias("avg_ms"), F.avg("ms").alias("median_ms"))


def geo_variation(pages: DataFrame) -> DataFrame:
    """URLs whose content differs between countries."""
    hashed = pages.select("url", "country", F.sha2(F.col("content"), 256).alias("h")).distinct()
    return (
        hashed.groupBy("url")
        .agg(F.count_distinct("h").alias("variants"), F.array_sort(F.collect_set("country")).alias("countries"))
        .withColumn("varies", F.col("variants") > 1)
    )


def distinct_urls(pages: DataFrame, seq: str = "record_seq", column: str = "url") -> DataFrame:
    """Distinct non-blank URLs with the position they were first seen at."""
    return (
        pages.filter(F.col(column).isNotNull() & (F.col(column) != ""))
        .groupBy(F.col(column).alias("url"))
        .agg(F.min(seq).alias("first_seq"))
    )


def latest_status(polls: DataFrame, ts: str = "polled_at") -> DataFrame:
    """Last known status per crawl."""
    rest = [c for c in polls.columns if c != "crawler_uuid"]
    best = F.max_by(F.struct(*rest), F.col(ts)).alias("r")
    return polls.groupBy("crawler_uuid").agg(best).select("crawler_uuid", *[F.col(f"r.{c}").alias(c) for c in rest])


def artifact_overlap(left: DataFrame, right: DataFrame, column: str = "url") -> DataFrame:
    """Distinct URLs held by both artifacts and by either alone; one shuffle on the URL."""
    tagged = left.select(F.col(column).alias("url"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.col(column).alias("url"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    sides = tagged.groupBy("url").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return sides.agg(
        F.count_if((F.col("l") + F.col("r")) == 2).alias("both"),
        F.count_if(F.col("r") == 0).alias("only_left"),
        F.count_if(F.col("l") == 0).alias("only_right"),
    )


def slowest(pages: DataFrame, min_s: float = 5.0, k: int = 10) -> DataFrame:
    """The k slowest requests above ``min_s`` seconds, ties by URL."""
    return pages.filter(F.col("duration") > min_s).orderBy(F.col("duration").desc(), F.col("url")).limit(k)
