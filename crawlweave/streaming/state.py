"""Stateful operators over the event feed; each has a batch twin it agrees with."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from crawlweave.functions.errors import MONITORED_CODES

TERMINAL = ("crawler_finished", "crawler_stopped", "crawler_cancelled")
COUNTS = ("visited", "failed", "skipped", "extracted", "credits")
# counters of one share of a crawl, times as -1 where there is none; close_ms: when the share is closed after the end
COUNTERS = np.dtype([*((name, "<i8") for name in (*COUNTS, "first_us", "last_us", "reason_us", "close_ms")), ("closed", "?")])
NONE_YET = np.array([(0, 0, 0, 0, 0, -1, -1, -1, -1, False)], COUNTERS)
STATE_OUT = (
    "crawler_uuid string, salt int, urls_visited bigint, urls_extracted bigint, urls_failed bigint, urls_skipped bigint, "
    "api_credit_used bigint, start_us bigint, stop_us bigint, reason_us bigint, stop_reason string, is_finished boolean"
)
COUNTED, NEW_URL, END = 0, 1, 2  # what a row of a share stands for
GUARD_OUT = "crawler_uuid string, stop_rank bigint, event_id bigint, recent_failures bigint"
# an attempt that waits; crawl: place in its bundle, named: the id is not null
ATTEMPT = np.dtype([("crawl", "<i4"), ("ts", "<i8"), ("named", "?"), ("id", "<i8"), ("bad", "i1")])
HELD_ROWS = 65_536  # waiting attempts of a bundle in one state value, about 1.5 MB


class CrawlStateProcessor(StatefulProcessor):
    """Counters of one share of each crawl of a bundle; its URLs come without repetition.

    Some time after the crawl's terminal event the share is closed: the final counters and the end mark stay, and rows
    that come later are ignored. The counters of a bundle are one value, read and written once for a batch.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "crawls array<string>, counters binary, reasons array<string>, timer_ms bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        crawls, counters, reasons, timer_ms = self.load()
        index = {crawl: i for i, crawl in enumerate(crawls)}
        touched, ends = set(), {}
        for frame in rows:
            crawl = np.array([index.setdefault(c, len(index)) for c in frame["crawler_uuid"]])
            grown = len(index) - len(counters)
            counters, reasons = np.concatenate([counters, np.repeat(NONE_YET, grown)]), reasons + [None] * grown
            opened = ~counters["closed"][crawl]
            crawl, frame = crawl[opened], frame[opened]
            touched.update(crawl.tolist())
            kind, timed = frame["kind"].to_numpy(), frame["ts_us"].notna().to_numpy()
            np.add.at(counters["extracted"], crawl[kind == NEW_URL], 1)
            end = (kind == END) & timed
            for c, us in zip(crawl[end].tolist(), frame["ts_us"][end]):
                ends[c] = max(int(us), ends.get(c, 0))
            batch, crawl, timed = frame[kind == COUNTED], crawl[kind == COUNTED], timed[kind == COUNTED]
            for name in ("visited", "failed", "skipped"):
                np.add.at(counters[name], crawl[(batch["event"] == f"crawler_url_{name}").to_numpy()], 1)
            np.add.at(counters["credits"], crawl, batch["api_credit"].fillna(0).to_numpy("i8"))
            batch, crawl = batch[timed].assign(crawl=crawl[timed]), crawl[timed]
            ts = batch["ts_us"].to_numpy("i8")
            np.maximum.at(counters["last_us"], crawl, ts)
            counters["first_us"][crawl[counters["first_us"][crawl] == -1]] = np.iinfo("i8").max
            np.minimum.at(counters["first_us"], crawl, ts)
            named = batch[batch["stop_reason"].notna()]
            for at in named.groupby("crawl")["ts_us"].idxmax():
                c, us = int(named.at[at, "crawl"]), int(named.at[at, "ts_us"])
                if us >= counters["reason_us"][c]:
                    counters["reason_us"][c], reasons[c] = us, str(named.at[at, "stop_reason"])
        for c, us in ends.items():
            if counters["close_ms"][c] == -1:
                counters["close_ms"][c] = us // 1000 + self.keep_ms
        self.store(list(index), counters, reasons, timer_ms)
        if touched:
            at = np.array(sorted(touched))
            now, names = counters[at], list(index)
            time = lambda name: pd.Series(now[name], dtype="Int64").mask(now[name] == -1)
            yield pd.DataFrame(
                {
                    "crawler_uuid": pd.Series([names[i] for i in at], dtype="object"), "salt": key[1], "urls_visited": now["visited"],
                    "urls_extracted": now["extracted"], "urls_failed": now["failed"], "urls_skipped": now["skipped"],
                    "api_credit_used": now["credits"], "start_us": time("first_us"), "stop_us": time("last_us"), "reason_us": time("reason_us"),
                    "stop_reason": pd.Series([reasons[i] for i in at], dtype="object"), "is_finished": now["close_ms"] != -1,
                }
            )

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        crawls, counters, reasons, _ = self.load()
        counters["closed"] |= (counters["close_ms"] != -1) & (counters["close_ms"] <= timerValues.getCurrentWatermarkInMs())
        self.store(crawls, counters, reasons, None)
        yield from ()

    def load(self) -> tuple[list[str | None], np.ndarray, list[str | None], int | None]:
        crawls, counters, reasons, timer_ms = self.totals.get() or ([], b"", [], None)
        return list(crawls), np.frombuffer(counters, COUNTERS).copy(), list(reasons), timer_ms

    def store(self, crawls: list[str | None], counters: np.ndarray, reasons: list[str | None], timer_ms: int | None) -> None:
        """Keep the counters; the one timer of the bundle is that of the share to be closed next."""
        ahead = counters["close_ms"][(counters["close_ms"] != -1) & ~counters["closed"]]
        next_ms = int(ahead.min()) if len(ahead) else None
        if next_ms != timer_ms:
            if timer_ms is not None:
                self.handle.deleteTimer(timer_ms)
            if next_ms is not None:
                self.handle.registerTimer(next_ms)
        self.totals.update((crawls, counters.tobytes(), reasons, next_ms))

    def close(self) -> None:
        pass


def crawl_state_stream(events: DataFrame, keep_ms: int = 3_600_000, delay: str = "1 day", shares: int = 16, bundles: int = 1_024) -> DataFrame:
    """Running URL counters per crawl and share of its rows (append mode, newest row of a share last).

    ``events``: crawler_uuid, event, url, api_credit, ts, stop_reason. Which URLs
    of a crawl are new is decided by Spark's own keyed state of (crawl, URL), one
    row on disk for each, which is forgotten ``delay`` after the URL came first:
    ``delay`` is the longest time over which a URL is recognised, and how late
    rows may be. The rows of a crawl are dealt to ``shares``, so that one hot
    crawl is worked on by as many tasks; ``merge_shares`` adds the shares up.
    Crawls are dealt to ``bundles`` by hash, whose counters are one value. A
    terminal event reaches every share, which is closed once the watermark is
    ``keep_ms`` past it. Batch twin: ``operators.stats.crawl_state``.
    """
    own = F.pmod(F.xxhash64("url"), F.lit(shares)).cast("int")
    fields = ["crawler_uuid", "event", "url", "api_credit", "ts", F.unix_micros("ts").alias("ts_us"), "stop_reason"]
    timed = events.withWatermark("ts", delay)
    counted = timed.select(*fields, F.lit(COUNTED).alias("kind"), own.alias("salt"))
    ended = timed.filter(F.col("event").isin(*TERMINAL)).select(
        *fields, F.lit(END).alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("salt")
    )
    with_url = timed.filter((F.col("event") != "crawler_url_failed") & F.col("url").isNotNull())
    new = with_url.dropDuplicatesWithinWatermark(["crawler_uuid", "url"]).select(*fields, F.lit(NEW_URL).alias("kind"), own.alias("salt"))
    rows = counted.unionByName(ended).unionByName(new).drop("url")
    bundle = F.pmod(F.xxhash64("crawler_uuid"), F.lit(bundles)).alias("bundle")
    return rows.select(bundle, "*").groupBy("bundle", "salt").transformWithStateInPandas(
        CrawlStateProcessor(keep_ms), outputStructType=STATE_OUT, outputMode="Append", timeMode="EventTime"
    )


def merge_shares(updates: DataFrame, order: str = "batch_id") -> DataFrame:
    """Latest state per crawl out of the updates written so far; ``order`` tells newer updates from older ones."""
    rest = [c for c in updates.columns if c not in ("crawler_uuid", "salt", order)]
    latest = updates.groupBy("crawler_uuid", "salt").agg(F.max_by(F.struct(*rest), order).alias("s")).select("crawler_uuid", "s.*")
    sums = ["urls_visited", "urls_extracted", "urls_failed", "urls_skipped", "api_credit_used"]
    return (
        latest.groupBy("crawler_uuid")
        .agg(
            *[F.sum(c).alias(c) for c in sums],
            F.min("start_us").alias("start_us"),
            F.max("stop_us").alias("stop_us"),
            F.max_by("stop_reason", "reason_us").alias("stop_reason"),
            F.max("is_finished").alias("is_finished"),
        )
        .withColumn("urls_to_crawl", F.col("urls_extracted") - F.col("urls_skipped"))
    )


class FailureGuardProcessor(StatefulProcessor):
    """Flags of the last n attempts of each crawl of a bundle; speaks once for a crawl, when its guard trips.

    Attempts wait until the watermark has passed their slot of ``slot_us``, and are then judged in the order of time,
    however they came. While at most ``held_rows`` wait in a bundle, they lie packed in one value beside the tallies of
    its crawls, so that a batch costs a bundle the same few state calls whatever its crawls and attempts. More are kept
    by slot, and only one slot is held at a time.
    """

    def __init__(self, n: int, threshold: float, slot_us: int, held_rows: int = HELD_ROWS):
        self.n = n
        self.threshold = threshold
        self.slot_us = slot_us
        self.held_rows = held_rows
        # flags: those of the last attempts, newest first
        self.tally = np.dtype([("attempts", "<i8"), ("stopped", "?"), ("flags", "i1", (max(n - 1, 1),))])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getValueState("recent", "crawls array<string>, tallies binary, held binary, by_slot boolean, timer_ms bigint")
        self.waiting = handle.getMapState("waiting", "slot bigint", "held binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        crawls, tallies, held, by_slot, timer_ms = self.load()
        stops, held = self.judged(crawls, tallies, held, timerValues.getCurrentWatermarkInMs())
        index = {crawl: i for i, crawl in enumerate(crawls)}
        parts, waiting, first = [held], len(held), None
        for frame in rows:
            part = np.empty(len(frame), ATTEMPT)
            part["crawl"] = [index.setdefault(crawl, len(index)) for crawl in frame["crawler_uuid"]]
            part["ts"], part["named"], part["id"], part["bad"] = (frame[c].to_numpy() for c in ("ts_us", "named", "event_id", "bad"))
            known = part["crawl"] < len(tallies)
            part = part[~(known & tallies["stopped"][np.where(known, part["crawl"], 0)])] if len(tallies) else part
            if not len(part):
                continue
            first = int(part["ts"].min()) if first is None else min(first, int(part["ts"].min()))
            parts, waiting = [*parts, part], waiting + len(part)
            if by_slot or waiting > self.held_rows:
                self.lay_out(np.concatenate(parts))
                by_slot, parts, waiting = True, [held[:0]], 0
        tallies = np.concatenate([tallies, np.zeros(len(index) - len(tallies), self.tally)])
        held = np.concatenate(parts)
        if not by_slot:
            due_ms = self.due_ms(int(held["ts"].min()) // self.slot_us) if len(held) else None
        else:
            firsts = [ms for ms in (timer_ms, None if first is None else self.due_ms(first // self.slot_us)) if ms is not None]
            due_ms = min(firsts, default=None)
        if timer_ms != due_ms:
            if timer_ms is not None:
                self.handle.deleteTimer(timer_ms)
            if due_ms is not None:
                self.handle.registerTimer(due_ms)
        self.store(list(index), tallies, held, by_slot, due_ms)
        yield from stops

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        crawls, tallies, held, by_slot, timer_ms = self.load()
        if timer_ms != expiredTimerInfo.getExpiryTimeInMs():
            return
        watermark, next_ms = timerValues.getCurrentWatermarkInMs(), None
        stops, held = self.judged(crawls, tallies, held, watermark)
        if by_slot:
            for slot in sorted(k[0] for k in self.waiting.keys()):
                if self.due_ms(slot) > watermark:
                    next_ms = self.due_ms(slot)
                    break
                more, _ = self.judged(crawls, tallies, np.frombuffer(self.waiting.getValue((slot,))[0], ATTEMPT), watermark)
                stops += more
                self.waiting.removeKey((slot,))
            by_slot = next_ms is not None
        elif len(held):
            next_ms = self.due_ms(int(held["ts"].min()) // self.slot_us)
        if next_ms is not None:
            self.handle.registerTimer(next_ms)
        self.store(crawls, tallies, held, by_slot, next_ms)
        yield from stops

    def judged(self, crawls: list[str | None], tallies: np.ndarray, held: np.ndarray, watermark_ms: int) -> tuple[list[pd.DataFrame], np.ndarray]:
        """Count the attempts whose slot the watermark has passed; the crawls that stop at one, and what goes on waiting."""
        due = self.due_ms(held["ts"] // self.slot_us) <= watermark_ms
        now, rest = held[due], held[~due]
        now = np.sort(now[~tallies["stopped"][now["crawl"]]], order=["crawl", "ts", "named", "id", "bad"])
        if not len(now):
            return [], rest
        # the flags of each crawl, oldest first, ahead of its attempts
        found = np.unique(now["crawl"])
        before = np.minimum(tallies["attempts"][found], self.n - 1)
        old = np.arange(max(self.n - 1, 1))[::-1] < before[:, None]
        order = np.argsort(np.concatenate([np.repeat(found, before), now["crawl"]]), kind="stable")
        crawl = np.concatenate([np.repeat(found, before), now["crawl"]])[order]
        bad = np.concatenate([tallies["flags"][found][:, ::-1][old], now["bad"]])[order]
        start = np.searchsorted(crawl, found)
        end = np.append(start[1:], len(crawl))
        place = np.arange(len(crawl)) - np.repeat(start, end - start)
        sums = np.concatenate([[0], np.cumsum(bad, dtype="i8")])
        at = np.arange(len(crawl)) + 1
        recent = sums[at] - sums[at - np.minimum(place + 1, self.n)]
        hits = np.flatnonzero((place + 1 >= self.n) & (recent >= self.threshold * self.n))
        _, one = np.unique(crawl[hits], return_index=True)
        hits = hits[one]
        which = np.searchsorted(found, crawl[hits])
        ranks = tallies["attempts"][crawl[hits]] + place[hits] - before[which] + 1
        for back in range(self.n - 1):
            has = end - 1 - back >= start
            tallies["flags"][found[has], back] = bad[(end - 1 - back)[has]]
        tallies["attempts"][found] += end - start - before
        if not len(hits):
            return [], rest
        tallies["stopped"][crawl[hits]] = True
        tripped = now[order[hits] - before.sum()]
        stops = pd.DataFrame(
            {
                "crawler_uuid": [crawls[c] for c in crawl[hits]], "stop_rank": ranks,
                "event_id": pd.array(tripped["id"], dtype="Int64"), "recent_failures": recent[hits],
            }
        )
        stops.loc[~tripped["named"], "event_id"] = pd.NA
        return [stops], rest[~tallies["stopped"][rest["crawl"]]]

    def lay_out(self, held: np.ndarray) -> None:
        """Add attempts to the slots they belong to."""
        held = held[np.argsort(held["ts"], kind="stable")]
        for part in np.split(held, np.flatnonzero(np.diff(held["ts"] // self.slot_us)) + 1):
            slot = (int(part["ts"][0]) // self.slot_us,)
            before = bytes(self.waiting.getValue(slot)[0]) if self.waiting.containsKey(slot) else b""
            self.waiting.updateValue(slot, (before + part.tobytes(),))

    def load(self) -> tuple[list[str | None], np.ndarray, np.ndarray, bool, int | None]:
        crawls, tallies, held, by_slot, timer_ms = self.recent.get() or ([], b"", b"", False, None)
        return list(crawls), np.frombuffer(tallies, self.tally).copy(), np.frombuffer(held, ATTEMPT), by_slot, timer_ms

    def store(self, crawls: list[str | None], tallies: np.ndarray, held: np.ndarray, by_slot: bool, timer_ms: int | None) -> None:
        self.recent.update((crawls, tallies.tobytes(), held.tobytes(), by_slot, timer_ms))

    def due_ms(self, slot: Any) -> Any:
        return (slot + 1) * self.slot_us // 1000

    def close(self) -> None:
        pass


def failure_guard_stream(
    attempts: DataFrame,
    n: int = 10,
    threshold: float = 0.7,
    codes: Sequence[str] = MONITORED_CODES,
    delay: str = "10 minutes",
    slot_seconds: int = 60,
    bundles: int = 4_096,
) -> DataFrame:
    """One row per crawl at the attempt that trips the guard.

    Attempts may come in any order within ``delay``; each is judged once the
    watermark has passed its slot of ``slot_seconds``. Crawls are dealt to
    ``bundles`` by hash, whose state is read and written once for a batch; what
    is held of a bundle is its waiting attempts if they are few, else one slot.
    A feed that ends is closed by a row of a later time. Batch twin:
    ``operators.guards.failure_rate`` with ``first_stops``.
    """
    ts = F.col("ts").cast("timestamp")
    bad = F.coalesce(F.col("error_code").isin(*codes), F.lit(False)).cast("int")
    timed = attempts.withColumn("ts", ts).filter(F.col("ts").isNotNull()).withWatermark("ts", delay)
    slim = timed.select(
        F.pmod(F.xxhash64("crawler_uuid"), F.lit(bundles)).alias("bundle"), F.col("crawler_uuid").cast("string").alias("crawler_uuid"), "ts",
        F.unix_micros("ts").alias("ts_us"), F.col("event_id").isNotNull().alias("named"), F.coalesce("event_id", F.lit(0)).cast("bigint").alias("event_id"), bad.alias("bad"),
    )
    return slim.groupBy("bundle").transformWithStateInPandas(
        FailureGuardProcessor(n, threshold, slot_seconds * 1_000_000), outputStructType=GUARD_OUT, outputMode="Append", timeMode="EventTime"
    )
