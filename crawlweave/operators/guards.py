"""Failure guard, budgets, batches, pagination and throttle pauses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from crawlweave.functions import errors as E
from crawlweave.operators import ordering
from crawlweave.session import fresh_dir, written


def failure_rate(
    attempts: DataFrame,
    n: int = 10,
    threshold: float = 0.7,
    codes: Sequence[str] = E.MONITORED_CODES,
    block_rows: int = ordering.BLOCK_ROWS,
    slot_rows: int = ordering.SLOT_ROWS,
) -> DataFrame:
    """Failures among the last ``n`` scrapes of each attempt and whether the guard trips there.

    ``attempts``: crawler_uuid, ts, event_id, error_code. Only full windows of
    ``n`` attempts count. Neither a crawl nor a time span is ever one task.
    """
    slim = attempts.select(
        "crawler_uuid", "ts", "event_id", F.coalesce(F.col("error_code").isin(*codes), F.lit(False)).cast("int").alias("bad")
    )
    ranked = ordering.ranged(slim, ["crawler_uuid"], ["ts", "event_id"], slot_rows=slot_rows)
    blocks = ordering.in_blocks(ranked, before=n - 1, block_rows=block_rows)
    frame = Window.partitionBy("crawler_uuid", "_block").orderBy("rank").rowsBetween(-(n - 1), 0)
    return (
        blocks.withColumn("recent_failures", F.sum("bad").over(frame))
        .filter("_own")
        .withColumn("stop", (F.col("rank") >= n) & (F.col("recent_failures") >= threshold * n))
        .select("crawler_uuid", "event_id", "ts", "rank", "recent_failures", "stop")
    )


def first_stops(rates: DataFrame) -> DataFrame:
    """The attempt at which the guard stops a crawl."""
    best = F.min_by(F.struct("event_id", "ts", "recent_failures"), F.col("rank")).alias("r")
    return (
        rates.filter("stop")
        .groupBy("crawler_uuid")
        .agg(F.min("rank").alias("stop_rank"), best)
        .select("crawler_uuid", "stop_rank", F.col("r.event_id").alias("event_id"), F.col("r.ts").alias("ts"), F.col("r.recent_failures").alias("recent_failures"))
    )


def apply_budgets(visits: DataFrame, limits: DataFrame, slot_rows: int = ordering.SLOT_ROWS) -> DataFrame:
    """``state`` visited or skipped for each visit, with the reason.

    ``visits``: crawler_uuid, ts, event_id, api_credit. ``limits``:
    crawler_uuid, page_limit, max_api_credit, max_duration (s); 0 or null is no
    limit. A crawl stops before the first visit that finds a budget used up, and
    everything after it is skipped for the same reason.
    """
    ranked = ordering.ranged(
        visits, ["crawler_uuid"], ["ts", "event_id"], sums={"credits_after": "api_credit"}, first={"_start_ts": "ts"}, slot_rows=slot_rows
    )
    joined = ranked.join(limits, "crawler_uuid", "left")
    elapsed = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("_start_ts").cast("timestamp"))) / 1e6

    def used_up(limit: str, spent: Column) -> Column:
        return F.coalesce((F.col(limit) > 0) & (spent >= F.col(limit)), F.lit(False))

    reason = (
        F.when(used_up("page_limit", F.col("rank") - 1), "page_limit")
        .when(used_up("max_api_credit", F.col("credits_after") - F.col("api_credit")), "max_api_credit")
        .when(used_up("max_duration", elapsed), "max_duration")
    )
    used = [c for c in limits.columns if c != "crawler_uuid"] + ["_start_ts"]
    marked = written(joined.withColumn("_hit", reason).drop(*used), "visits-marked")
    stops = (
        marked.filter(F.col("_hit").isNotNull())
        .groupBy("crawler_uuid")
        .agg(F.min("rank").alias("_stop_rank"), F.min_by("_hit", "rank").alias("_stop_reason"))
    )
    skipped = F.coalesce(F.col("rank") >= F.col("_stop_rank"), F.lit(False))
    return (
        marked.join(stops, "crawler_uuid", "left")
        .withColumn("state", F.when(skipped, "skipped").otherwise("visited"))
        .withColumn("reason", F.when(skipped, F.col("_stop_reason")))
        .drop("_stop_rank", "_stop_reason", "_hit")
    )


def assign_batches(
    df: DataFrame, size: int = 100, partition_key: str = "crawler_uuid", order: str = "page_id", bucket: Column | None = None
) -> DataFrame:
    """Consecutive batches of ``size`` rows per key."""
    ranked = ordering.running(df, [partition_key], [order], ordering.id_range(order) if bucket is None else bucket)
    return ranked.withColumn("batch", F.floor((F.col("rank") - 1) / size))


class RankedList:
    """A list laid out once by ranges of its order, for any number of pages.

    Each range is a folder of its own, and an index of one row for each range
    says at which place it starts; a page reads the folders that it overlaps.
    """

    def __init__(self, df: DataFrame, order: Sequence[str]):
        self.order, self.columns = list(order), df.columns
        path = fresh_dir(df.sparkSession, "ranked-list")
        placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
        placed.write.partitionBy("_part").parquet(path)
        self.rows = df.sparkSession.read.schema(placed.schema).parquet(path)
        counts = self.rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
        self.index = written(counts.withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))), "ranked-index")

    def page(self, page: int = 1, per_page: int = 100) -> DataFrame:
        """Rows of one page; pages start at 1, a page past the end is empty."""
        if page < 1 or not 1 <= per_page <= 1000:
            raise ValueError("page starts at 1, per_page is 1 to 1000")
        offset = (page - 1) * per_page
        # every range holds a row at least, so a page overlaps per_page ranges at most
        overlaps = (F.col("_start") < offset + per_page) & (F.col("_start") + F.col("_rows") > offset)
        starts = {r["_part"]: r["_start"] for r in self.index.filter(overlaps).collect()}
        if not starts:
            return self.rows.filter(F.lit(False)).select(self.columns)
        start = F.element_at(F.create_map(*[F.lit(x) for pair in starts.items() for x in pair]), F.col("_part"))
        number = start + F.row_number().over(Window.partitionBy("_part").orderBy(*self.order))
        chosen = self.rows.filter(F.col("_part").isin(*starts)).withColumn("_number", number)
        chosen = chosen.filter((F.col("_number") > offset) & (F.col("_number") <= offset + per_page))
        return chosen.orderBy(*self.order).select(self.columns)


def paginate(df: DataFrame, order: Sequence[str], page: int = 1, per_page: int = 100) -> DataFrame:
    """One page of a list; for several pages keep the ``RankedList``."""
    if page < 1 or not 1 <= per_page <= 1000:
        raise ValueError("page starts at 1, per_page is 1 to 1000")
    return RankedList(df, order).page(page, per_page)


def url_list_page(entries: DataFrame, status: str | None = None, page: int = 1, per_page: int = 100) -> DataFrame:
    """Page of a crawl's URL list; without a status the visited URLs are meant."""
    return paginate(entries.filter(F.col("status") == (status or "visited")), ["url"], page, per_page)


def throttle_report(
    attempts: DataFrame, block_rows: int = ordering.BLOCK_ROWS, slot_rows: int = ordering.SLOT_ROWS
) -> DataFrame:
    """Throttle pauses per crawl.

    ``gap`` is the time until the next attempt of the crawl; ``early_resumes``
    counts attempts that came before the pause was over.
    """
    slim = attempts.select(
        "crawler_uuid", "ts", "event_id", F.coalesce(F.col("error_code").isin(*E.THROTTLE_CODES), F.lit(False)).alias("throttled")
    )
    ranked = ordering.ranged(slim, ["crawler_uuid"], ["ts", "event_id"], slot_rows=slot_rows)
    blocks = ordering.in_blocks(ranked, after=1, block_rows=block_rows)
    following = Window.partitionBy("crawler_uuid", "_block").orderBy("rank")
    gap = (F.unix_micros(F.lead("ts").over(following).cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1e6
    return (
        blocks.withColumn("gap", gap)
        .filter("_own AND throttled")
        .groupBy("crawler_uuid")
        .agg(
            F.count(F.lit(1)).alias("pauses"),
            (F.count(F.lit(1)) * E.THROTTLE_PAUSE_SECONDS).alias("pause_seconds"),
            F.min("gap").alias("min_gap"),
            F.count_if(F.col("gap") < E.THROTTLE_PAUSE_SECONDS).alias("early_resumes"),
        )
    )
