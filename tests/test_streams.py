"""Streaming details beyond the registered queries."""

import collections
import datetime as dt
import json
import os
import random
import types
import urllib.parse

import pandas as pd
import pytest
from pyspark.sql import functions as F

from crawlweave import schemas as S
from crawlweave.functions import errors as E, signing
from crawlweave.operators import guards
from crawlweave.plans import stream_queries as SQ
from crawlweave.plans.stream_queries import drain
from crawlweave.sources import payloads
from crawlweave.streaming import events as EV, state as ST

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "crawler_uuid string, event string, url string, api_credit bigint, ts timestamp, stop_reason string"


def feed(spark, path, batches):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_a_finished_crawl_keeps_its_totals_in_every_share(spark, tmp_path):
    at = lambda hours: T0 + dt.timedelta(hours=hours)
    first = [("c", "crawler_url_visited", f"u{i}", 1, at(0), None) for i in range(20)] + [("c", "crawler_finished", None, 0, at(0), "no_more_urls")]
    # a timer fires in the batch after the one that moved the watermark past it
    later = [("other", "crawler_url_visited", "x", 1, at(9), None)]
    filler = [("other", "crawler_url_visited", "y", 1, at(9.5), None)]
    again = [("c", "crawler_url_visited", f"u{i}", 1, at(10), None) for i in range(20)]
    stream = ST.crawl_state_stream(feed(spark, str(tmp_path / "in"), [first, later, filler, again]), keep_ms=3_600_000, delay="10 minutes", shares=3)
    updates = drain(stream, "shares").cache()
    done = ST.merge_shares(updates.filter("batch_id = 0")).filter("crawler_uuid = 'c'").first()
    assert (done["urls_visited"], done["urls_extracted"], done["stop_reason"], done["is_finished"]) == (20, 20, "no_more_urls", True)
    assert updates.filter("crawler_uuid = 'c'").select("salt").distinct().count() == 3
    # the share is closed: rows that come hours later neither start it anew nor count
    last = ST.merge_shares(updates).filter("crawler_uuid = 'c'").first()
    assert (last["urls_visited"], last["urls_extracted"], last["is_finished"]) == (20, 20, True)


def test_the_end_of_a_crawl_is_remembered(spark, tmp_path):
    first = [("c", "crawler_url_visited", "u", 1, T0, None), ("c", "crawler_finished", None, 0, T0, "page_limit")]
    late = [("c", "crawler_url_visited", "v", 1, T0 + dt.timedelta(minutes=1), None)]
    updates = drain(ST.crawl_state_stream(feed(spark, str(tmp_path / "in"), [first, late]), shares=1), "late")
    last = ST.merge_shares(updates).first()
    assert (last["urls_visited"], last["stop_reason"], last["is_finished"]) == (2, "page_limit", True)


def test_attempts_out_of_order_within_the_watermark(spark, tmp_path):
    """Shuffled inside each batch and across neighbouring ones: the guard stops where the batch twin does."""
    rng = random.Random(11)
    rows, at = [], T0
    for i in range(900):
        at += dt.timedelta(seconds=rng.choice([0, 5, 40]))
        rows.append((f"c{rng.randrange(6)}", i, at, rng.choice([None, E.MONITORED_CODES[0]])))
    schema = "crawler_uuid string, event_id bigint, ts timestamp, error_code string"
    late = sorted(rows, key=lambda r: r[2] + dt.timedelta(seconds=rng.randrange(500)))  # up to 500 s late
    batches = [late[i : i + 60] for i in range(0, 900, 60)] + [[("closing", 0, at + dt.timedelta(days=1), None)]]
    path = str(tmp_path / "in")
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = drain(ST.failure_guard_stream(feed, threshold=0.8), "guard").drop("batch_id")
    want = guards.first_stops(guards.failure_rate(spark.createDataFrame(rows, schema), threshold=0.8)).drop("ts")
    names = ["crawler_uuid", "stop_rank", "event_id", "recent_failures"]
    found = sorted(tuple(r) for r in got.select(names).collect())
    assert found == sorted(tuple(r) for r in want.select(names).collect()) and len(found) >= 3


class Store:
    """State of one key in memory; counts the calls."""

    def __init__(self):
        self.calls, self.values, self.timers = 0, collections.defaultdict(dict), set()

    def state(self, name):
        values = self.values[name]

        def counted(do):
            def call(*args):
                self.calls += 1
                return do(*args)

            return call

        ways = {
            "get": lambda: values.get(None), "update": lambda v: values.__setitem__(None, v), "keys": lambda: iter(list(values)), "clear": values.clear,
            "containsKey": values.__contains__, "getValue": values.__getitem__, "updateValue": values.__setitem__, "removeKey": lambda k: values.pop(k),
        }
        return types.SimpleNamespace(**{k: counted(v) for k, v in ways.items()})

    def getValueState(self, name, schema):
        return self.state(name)

    def getMapState(self, name, key, value):
        return self.state(name)

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls += 1
        self.timers.discard(ms)

    def run(self, processor, key, frames, watermark):
        now = types.SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        out = list(processor.handleInputRows(key, iter(frames), now)) if frames else []
        for ms in sorted(t for t in self.timers if t <= watermark):
            out += processor.handleExpiredTimer(key, now, types.SimpleNamespace(getExpiryTimeInMs=lambda: ms))
            self.timers.discard(ms)
        return [tuple(None if pd.isna(v) else v for v in row) for frame in out for row in frame.itertuples(index=False)]


def test_counters_of_a_bundle_are_one_value():
    """As one crawl at a time would be counted; state calls do not grow with the crawls."""
    rng = random.Random(7)
    columns = ["crawler_uuid", "event", "api_credit", "ts_us", "stop_reason", "kind"]
    events = ["crawler_url_visited", "crawler_url_failed", "crawler_url_skipped", "crawler_url_discovered"]
    batches = []
    for low in (0, 5_000):
        rows = [(f"c{rng.randrange(200)}", rng.choice(events), rng.randrange(9), t * 1_000_000, rng.choice([None, f"r{t}"]), rng.choice([ST.COUNTED, ST.NEW_URL])) for t in rng.sample(range(low, low + 5_000), 3_000)]
        batches.append(pd.DataFrame([*rows, ("c7", "crawler_finished", 0, (low + 2_000) * 1_000_000, None, ST.END)], columns=columns))
    store, processor = Store(), ST.CrawlStateProcessor(keep_ms=1_000)
    processor.init(store)
    first = store.run(processor, (3, 1), [batches[0][:1000], batches[0][1000:]], 1_000_000)
    assert len(first) == 200 and store.timers == {2_001_000}
    last = {r[0]: r for r in first} | {r[0]: r for r in store.run(processor, (3, 1), [batches[1]], 3_000_000)}
    assert not store.timers and store.calls < 12
    rows = pd.concat(batches, ignore_index=True)
    for crawl, mine in rows.groupby("crawler_uuid"):
        counted = mine[mine["kind"] == ST.COUNTED]
        named = counted[counted["stop_reason"].notna()].sort_values("ts_us")
        want = [crawl, 1, *((counted["event"] == e).sum() for e in events[:1]), (mine["kind"] == ST.NEW_URL).sum(), *((counted["event"] == e).sum() for e in events[1:3])]
        want += [counted["api_credit"].sum(), counted["ts_us"].min(), counted["ts_us"].max(), named["ts_us"].iloc[-1], named["stop_reason"].iloc[-1], crawl == "c7"]
        assert list(last[crawl]) == want
    # c7 is closed, the others are not
    again = store.run(processor, (3, 1), [batches[1][batches[1]["crawler_uuid"].isin(["c7", "c8"])]], 3_000_000)
    assert [r[0] for r in again] == ["c8"]


@pytest.mark.parametrize("held_rows", [100_000, 50, 0])
def test_crawls_of_a_bundle_share_state_calls(held_rows):
    """Every batch moves the watermark to the middle of its minutes; each attempt is in a slot of its own for its crawl."""
    rng = random.Random(5)
    rows = [(f"c{rng.randrange(30)}" if rng.random() < 0.95 else None, rng.randrange(3000) * 60_000_000, i if rng.random() < 0.9 else None, int(rng.random() < 0.4)) for i in range(3000)]
    want = {}
    for crawl in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == crawl), key=lambda r: (r[1], r[2] is not None, r[2] or 0, r[3]))
        for i in range(9, len(mine)):
            if (bad := sum(r[3] for r in mine[i - 9 : i + 1])) >= 7:
                want[crawl] = (crawl, i + 1, mine[i][2], bad)
                break
    assert len(want) >= 15
    store, processor, got = Store(), ST.FailureGuardProcessor(10, 0.7, 60_000_000, held_rows), []
    processor.init(store)
    names, watermark = ["crawler_uuid", "ts_us", "event_id", "bad"], 0
    for low in range(0, 3000, 1000):
        batch = [r for r in rows if low <= r[1] // 60_000_000 < low + 1000]
        rng.shuffle(batch)
        frame = pd.DataFrame(batch, columns=names).assign(named=lambda f: f["event_id"].notna(), event_id=lambda f: f["event_id"].fillna(0).astype("int64"))
        got += store.run(processor, (0,), [frame[:400], frame[400:]], watermark)
        watermark = (low + 500) * 60_000
        got += store.run(processor, (0,), [], watermark)
    got += store.run(processor, (0,), [], 10**12)
    assert sorted(got, key=str) == sorted(want.values(), key=str)
    assert not store.timers and (held_rows < 100_000 or store.calls < 40)


def test_period_names():
    assert EV.period_window("last5m") == "300 seconds" and EV.period_window("last7d") == "604800 seconds"


def test_deliveries_route_by_header(spark):
    lines = spark.createDataFrame(
        [('{"headers": {"X-V-Webhook-Resource-Type": "ping"}, "body": "{}"}',), ('{"headers": {"x-v-webhook-resource-type": "crawler", "X-V-Crawl-Event-Name": "crawler_started"}, "body": "{}"}',)],
        "value string",
    )
    rows = EV.accept(EV.deliveries(lines), event_names=["crawler_started"]).select("resource_type", "reject_reason").collect()
    assert [tuple(r) for r in rows] == [("crawler", "missing event")]
    assert EV.accept(EV.deliveries(lines), resource_type="scrape").filter(F.lit(True)).count() == 0


def test_envelopes_are_made_after_the_log_is_dealt_out(spark, tmp_path, monkeypatch):
    events = [(i, T0 + dt.timedelta(minutes=i), i % 5, ["view", "click", "error"][i % 3], 1.0, f'{{"k": {i % 30}}}') for i in range(60)]
    spark.createDataFrame(events, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(0, "https://a.example/us", "")], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    dealt, in_time_order = [], SQ.in_time_order
    monkeypatch.setattr(SQ, "in_time_order", lambda rows, write: (dealt.append(rows.columns), in_time_order(rows, write)))
    lines = spark.read.text(SQ.landing_folder(spark, str(tmp_path)))
    assert lines.count() == 60 + 15 and EV.deliveries(lines).filter("raw IS NOT NULL").select("raw").distinct().count() == 60
    assert "event_id" in dealt[0] and not {"body", "signature"} & set(dealt[0])


def test_no_digest_without_a_signature(spark):
    body = F.when(F.col("signature").isNull(), F.raise_error("digest of an unsigned body")).otherwise(F.lit("x"))
    inner, outer = signing.pads("s")
    right = signing.hmac_hex(F.lit(b"x"), F.lit(inner), F.lit(outer))
    rows = spark.createDataFrame([(1, None), (2, "wrong"), (3, "right")], "id int, signature string")
    signed = rows.withColumn("signature", F.when(F.col("signature") == "right", right).otherwise(F.col("signature"))).withColumn("raw", body)
    found = signing.verify_signature(signed, ["s"]).select("id", "verified").collect()
    assert [tuple(r) for r in found] == [(1, False), (2, False), (3, True)]


def test_landing_files_are_packed(spark, tmp_path):
    # a plain landing folder is written and read at six times the length
    events = [(i, T0 + dt.timedelta(minutes=i), i % 5, ["view", "click", "error"][i % 3], 1.0, f'{{"k": {i % 30}}}') for i in range(600)]
    spark.createDataFrame(events, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(0, "https://a.example/us", "")], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    lines = spark.read.text(SQ.landing_folder(spark, str(tmp_path)))
    stored = sum(os.path.getsize(urllib.parse.urlparse(f).path) for f in lines.inputFiles())
    read = lines.agg(F.count("value"), F.sum(F.octet_length("value"))).first()
    assert read[0] == 600 + 150 and 3 * stored < read[1]


def test_missing_fields_looks_at_each_field_once(spark):
    assert str(payloads.missing_fields(F.col("e"))).count("state.urls_visited") == 1
    state = {c: 1 for c in S.REQUIRED_STATE}
    base = {"crawler_uuid": "c", "project": "p", "env": "e", "action": "a", "state": state}
    cases = [
        ({"event": "crawler_finished", "payload": base | {"seed_url": "u", "links": {"status": "s"}}}, None),
        ({"event": "crawler_finished", "payload": base | {"seed_url": "u"}}, "missing links.status"),
        ({"event": "crawler_url_visited", "payload": base | {"url": "u", "scrape": {"status_code": 200}}}, "missing scrape.country"),
        ({"event": "crawler_url_skipped", "payload": base | {"env": None}}, "missing env"),
        ({"event": "crawler_url_skipped", "payload": base}, "missing urls"),
        ({"event": "crawler_url_skipped", "payload": base | {"urls": {"u": "r"}, "state": state | {"duration": None}}}, "missing state.duration"),
        ({"event": "crawler_url_discovered", "payload": base | {"origin": "o", "discovered_urls": []}}, None),
        ({"event": "crawler_url_failed", "payload": base | {"url": "u", "error": "x"}}, "missing scrape_config"),
        ({"event": "other", "payload": {}}, "unknown event"),
        ({"payload": base}, "missing event"),
        ({"event": "other"}, "missing payload"),
    ]
    rows = spark.createDataFrame([(i, json.dumps(e)) for i, (e, _) in enumerate(cases)], "i int, raw string")
    found = {r.i: r.reject_reason for r in payloads.parse_events(rows).select("i", "reject_reason").collect()}
    assert found == {i: reason for i, (_, reason) in enumerate(cases)}
