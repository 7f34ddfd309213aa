"""Monitoring metrics over a request log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from crawlweave.functions import urls

# fixed values: periods and their length; a subscription period starts where the caller says
PERIODS = {
    "last7d": dt.timedelta(days=7),
    "last24h": dt.timedelta(hours=24),
    "last1h": dt.timedelta(hours=1),
    "last5m": dt.timedelta(minutes=5),
}
AGGREGATIONS = ("account", "project", "target")


def utc_naive(moment: dt.datetime) -> dt.datetime:
    """Aware moments are converted to UTC, naive ones taken as UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return moment


def moment(df: DataFrame, value: dt.datetime, ts: str = "ts") -> Column:
    """Literal of the same timestamp type as the column, so that the filter stays pushable."""
    text = utc_naive(value).isoformat(sep=" ")
    if df.schema[ts].dataType.typeName() == "timestamp_ntz":
        return F.lit(text).cast("timestamp_ntz")
    return F.to_timestamp(F.lit(text + "Z"))


def within(
    log: DataFrame,
    period: str | None = None,
    now: dt.datetime | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    subscription_start: dt.datetime | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Rows of a period. Start and end go together and override the period."""
    if (start is None) != (end is None):
        raise ValueError("start and end go together")
    if start is None:
        if period is None:
            return log
        if period == "subscription":
            if subscription_start is None:
                return log
            start = subscription_start
        elif period in PERIODS:
            if now is None:
                raise ValueError("a period needs now")
            start = now - PERIODS[period]
        else:
            raise ValueError(f"unknown period {period!r}")
        if now is None:
            return log.filter(F.col(ts) >= moment(log, start, ts))
        end = now
    return log.filter((F.col(ts) >= moment(log, start, ts)) & (F.col(ts) <= moment(log, end, ts)))


def metric_columns() -> list[Column]:
    """Metrics over rows pre-counted per millisecond of duration; the average is exact, the percentile one of milliseconds."""
    n = F.col("n")
    return [
        F.sum(n).alias("requests"),
        F.sum("ok").alias("successes"),
        (F.sum(n) - F.sum("ok")).alias("failures"),
        F.sum("credits").alias("credits"),
        (F.sum("seconds") / F.sum(n)).alias("avg_duration"),
        (F.percentile("ms", F.lit(0.95), n) / 1000).alias("p95_duration"),
    ]


def pre_count(log: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Rows per key and millisecond of duration.

    This is the only shuffle that sees log rows. It is combined in every map
    task and leaves at most one row per key and millisecond, which bounds the
    percentile buffers after it, however many rows a key has.
    """
    return log.groupBy(*keys, F.round(F.col("duration") * 1000).cast("bigint").alias("ms")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("success")).alias("ok"),
        F.sum("api_credit").alias("credits"),
        F.sum("duration").alias("seconds"),
    )


def monitoring_metrics(
    log: DataFrame,
    period: str | None = "last24h",
    aggregation: Sequence[str] = AGGREGATIONS,
    now: dt.datetime | None = None,
    include_webhook: bool = False,
    **bounds,
) -> DataFrame:
    """Metrics for the account, per project and per target in one pass.

    ``log``: ts, product, project, target, success, api_credit, duration (s)
    and optionally is_webhook. Output rows carry their ``level``.
    """
    unknown = set(aggregation) - set(AGGREGATIONS)
    if unknown or not aggregation:
        raise ValueError(f"aggregation is a non-empty subset of {AGGREGATIONS}")
    rows = within(log, period, now, **bounds)
    if not include_webhook and "is_webhook" in log.columns:
        rows = rows.filter(~F.col("is_webhook"))
    counted = pre_count(rows, [F.col("product"), F.col("project"), F.col("target")])
    sets = {
        "account": [F.col("product")],
        "project": [F.col("product"), F.col("project")],
        "target": [F.col("product"), F.col("target")],
    }
    product, project, target = F.col("product"), F.col("project"), F.col("target")
    level = (
        F.when((F.grouping("project") == 1) & (F.grouping("target") == 1), "account")
        .when(F.grouping("project") == 0, "project")
        .otherwise("target")
    )
    return counted.groupingSets([sets[a] for a in AGGREGATIONS if a in aggregation], product, project, target).agg(
        level.alias("level"), *metric_columns()
    )


def target_metrics(
    log: DataFrame,
    domain: str,
    group_subdomain: bool = False,
    period: str | None = "last24h",
    now: dt.datetime | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    bucket: str = "1 hour",
    include_webhook: bool = False,
) -> DataFrame:
    """Metrics over time of one domain and its subdomains, folded into one or not."""
    host = urls.host(F.col("url"))
    rows = within(log, period, now, start, end)
    if not include_webhook and "is_webhook" in log.columns:
        rows = rows.filter(~F.col("is_webhook"))
    rows = rows.filter((host == domain) | F.endswith(host, F.lit("." + domain)))
    key = F.lit(domain) if group_subdomain else host
    counted = pre_count(rows, [key.alias("target"), F.window("ts", bucket).alias("w")])
    return counted.groupBy("target", F.col("w.start").alias("bucket_start")).agg(*metric_columns())


def monitoring_timeseries(
    log: DataFrame,
    bucket: str | None = "1 hour",
    proxy_pool: str | None = None,
    period: str | None = None,
    now: dt.datetime | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
) -> DataFrame:
    """Session metrics per proxy pool, in total (``bucket=None``) or over time."""
    rows = within(log, period, now, start, end)
    if proxy_pool is not None:
        rows = rows.filter(F.col("proxy_pool") == proxy_pool)
    if bucket is None:
        counted = pre_count(rows, [F.col("proxy_pool")])
        return counted.groupBy("proxy_pool").agg(*metric_columns())
    counted = pre_count(rows, [F.col("proxy_pool"), F.window("ts", bucket).alias("w")])
    return counted.groupBy("proxy_pool", F.col("w.start").alias("bucket_start")).agg(*metric_columns())


def to_prometheus(metrics: DataFrame, labels: Sequence[str], values: Sequence[str], prefix: str = "crawl") -> DataFrame:
    """Metrics as Prometheus text lines, one row per sample."""
    quoted = [
        F.when(
            F.col(c).isNotNull(),
            F.concat(
                F.lit(f'{c}="'),
                F.regexp_replace(F.regexp_replace(F.col(c).cast("string"), r"\\", r"\\\\"), '"', r'\\"'),
                F.lit('"'),
            ),
        )
        for c in labels
    ]
    tags = F.concat_ws(",", *quoted)
    numbers = metrics.select(tags.alias("_tags"), *[F.col(v).cast("double").alias(v) for v in values])
    long_form = numbers.unpivot(["_tags"], list(values), "metric", "value")
    return long_form.filter(F.col("value").isNotNull()).select(
        F.concat(
            F.lit(f"{prefix}_"), F.col("metric"), F.lit("{"), F.col("_tags"), F.lit("} "), F.col("value").cast("string")
        ).alias("line")
    )
