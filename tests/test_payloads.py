"""Literal payloads: events, URL lists, status, results, contents, extractions."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from crawlweave.sources import payloads

# fixed values: the field and event names of the payloads below; all values are our own
STATE = {
    "duration": 93.25, "urls_visited": 310, "urls_extracted": 812, "urls_failed": 7, "urls_skipped": 495, "urls_to_crawl": 3,
    "api_credit_used": 1240, "stop_reason": None, "start_time": 1704067200, "stop_time": 1704067293.25,
}
BASE = {"crawler_uuid": "u1", "project": "default", "env": "LIVE", "action": "x", "state": STATE}


def envelope(event, **extra):
    return {"event": event, "payload": copy.deepcopy({**BASE, **extra})}


LIFE = {"seed_url": "https://news.example/archive", "links": {"status": "https://control.example/jobs/u1/status"}}
VISITED = {
    "url": "https://news.example/a/17",
    "scrape": {"status_code": 206, "country": "nl", "log_uuid": "run-17", "log_url": "https://traces.example/run-17", "content": {"html": "<main>", "text": "news"}},
}
SKIPPED = {"urls": {"https://news.example/print?a=17": "page_limit", "https://news.example/archive/1999": "page_limit"}}
DISCOVERED = {"origin": "navigation", "discovered_urls": ["https://news.example/a/18", "https://news.example/a/19"]}
FAILED = {
    "url": "https://news.example/a/20", "error": "ERR::SCRAPE::NETWORK_ERROR", "scrape_config": {"method": "HEAD", "render": True},
    "links": {"log": None, "scrape": "https://control.example/fetch"},
}
GOOD = [
    envelope("crawler_started", **LIFE), envelope("crawler_stopped", **LIFE), envelope("crawler_cancelled", **LIFE), envelope("crawler_finished", **LIFE),
    envelope("crawler_url_visited", **VISITED), envelope("crawler_url_skipped", **SKIPPED), envelope("crawler_url_discovered", **DISCOVERED),
    envelope("crawler_url_failed", **FAILED),
]


def frame(spark, items):
    return spark.createDataFrame([(i if isinstance(i, str) else json.dumps(i),) for i in items], "raw string")


def test_all_event_shapes_are_accepted(spark):
    accepted, rejected = payloads.split_events(payloads.parse_events(frame(spark, GOOD)))
    rows = {r["event"]: r for r in accepted.collect()}
    assert rejected.count() == 0 and len(rows) == 8
    assert rows["crawler_started"]["links"]["status"].endswith("/status")
    assert rows["crawler_url_visited"]["scrape"]["content"] == {"html": "<main>", "text": "news"}
    assert rows["crawler_url_skipped"]["urls"]["https://news.example/archive/1999"] == "page_limit"
    assert rows["crawler_url_discovered"]["discovered_urls"][0] == "https://news.example/a/18"
    failed = rows["crawler_url_failed"]
    assert failed["links"]["log"] is None and failed["error"] == "ERR::SCRAPE::NETWORK_ERROR"
    assert json.loads(failed["scrape_config"].toJson())["method"] == "HEAD"
    assert failed["state"]["urls_extracted"] == 812 and failed["state"]["stop_time"] == 1704067293.25


def without(event, *path):
    out = copy.deepcopy(event)
    holder = out
    for key in path[:-1]:
        holder = holder[key]
    del holder[path[-1]]
    return out


@pytest.mark.parametrize(
    "event, reason",
    [
        (envelope("crawler_paused"), "unknown event"),
        ({"payload": BASE}, "missing event"),
        ({"event": "crawler_started"}, "missing payload"),
        (without(GOOD[0], "payload", "crawler_uuid"), "missing crawler_uuid"),
        (without(GOOD[0], "payload", "state", "urls_failed"), "missing state.urls_failed"),
        (without(GOOD[0], "payload", "links"), "missing links.status"),
        (without(GOOD[4], "payload", "scrape", "log_uuid"), "missing scrape.log_uuid"),
        (without(GOOD[7], "payload", "links", "scrape"), "missing links.scrape"),
        ("not json", "missing event"),
    ],
)
def test_incomplete_events_are_rejected(spark, event, reason):
    accepted, rejected = payloads.split_events(payloads.parse_events(frame(spark, [event])))
    assert accepted.count() == 0
    assert [r["reject_reason"] for r in rejected.collect()] == [reason]


@pytest.mark.parametrize(
    "body, status, expected",
    [
        ("", "visited", []),
        ("http://docs.example/guide?v=2\nhttp://docs.example/faq\n", "visited", [("http://docs.example/guide?v=2", None), ("http://docs.example/faq", None)]),
        ("http://docs.example/old,max_duration\nhttp://docs.example/api,no_more_urls\n", "failed", [("http://docs.example/old", "max_duration"), ("http://docs.example/api", "no_more_urls")]),
        ("http://docs.example/drafts/9,robots_txt\n", "skipped", [("http://docs.example/drafts/9", "robots_txt")]),
        ("\n\nhttp://docs.example/faq\n\nhttp://docs.example/\n\n\n", "visited", [("http://docs.example/faq", None), ("http://docs.example/", None)]),
        ("\thttp://docs.example/faq \r\nhttp://docs.example/img\t\r\n", "visited", [("http://docs.example/faq", None), ("http://docs.example/img", None)]),
        ("https://e.example/a,b", "pending", [("https://e.example/a,b", None)]),
        ("https://e.example/a,\nhttps://e.example/b,x,y\nhttps://e.example/c", "skipped", [("https://e.example/a", None), ("https://e.example/b", "x,y"), ("https://e.example/c", None)]),
    ],
)
def test_url_lists(spark, tmp_path, body, status, expected):
    (tmp_path / "urls.txt").write_bytes(body.encode())
    rows = payloads.read_url_list(spark, str(tmp_path), status).collect()
    assert sorted((r["url"], r["reason"]) for r in rows) == sorted(expected)
    assert all(r["status"] == status for r in rows)


def test_status_uses_the_old_identifier_and_rejects_gaps(spark):
    good = {"crawler_uuid": "a", "uuid": "b", "status": "DONE", "is_success": True, "is_finished": True, "state": STATE}
    old = {**without(good, "crawler_uuid"), "is_success": None, "status": "RUNNING"}
    bad = [without(without(good, "crawler_uuid"), "uuid"), without(good, "state", "duration"), without(good, "status")]
    rows = payloads.parse_crawl_status(frame(spark, [good, old, *bad])).collect()
    assert [(r["crawler_uuid"], r["reject_reason"]) for r in rows] == [
        ("a", None), ("b", None), (None, "missing crawler_uuid"), ("a", "missing state.duration"), ("a", "missing status"),
    ]


def test_scrape_results(spark):
    result = {"url": "u", "status": "DONE", "status_code": 200, "success": True, "format": "text", "content": "<p>", "response_headers": {"X-A": "1", "x-a": "2"}}
    items = [
        {"config": {"headers": []}, "context": {}, "result": result},
        {"config": {"headers": {"a": "b"}}, "context": {}, "result": {**result, "format": "binary", "content": "aGk="}},
        {"config": {}, "context": {}, "result": {**result, "format": "clob", "content": "https://big.example/1"}},
        {"error_id": "e1", "message": "no", "http_code": 401},
    ]
    rows = payloads.parse_scrape_results(frame(spark, items)).collect()
    assert rows[0]["config_headers"] == {} and rows[1]["config_headers"] == {"a": "b"}
    assert rows[0]["response_headers"] == {"x-a": "2"} and rows[0]["content"] == "<p>"
    assert bytes(rows[1]["content_bytes"]) == b"hi" and rows[1]["content"] is None
    assert rows[2]["content_ref"] == "https://big.example/1" and rows[2]["content"] is None
    assert rows[3]["is_api_error"] and rows[3]["error_id"] == "e1" and not rows[0]["is_api_error"]


def test_contents_in_all_shapes(spark):
    items = [
        {"contents": {"u1": {"html": "<p>", "markdown": "# x"}}, "links": {}},
        {"contents": {"u2": "# Home", "u4": '{"a": 1}'}},
        {"pages": [{"url": "u3", "status_code": 200, "content": "c"}]},
    ]
    rows = payloads.parse_crawl_contents(frame(spark, items), default_format="markdown").collect()
    assert sorted(map(tuple, rows)) == [("u1", "html", "<p>"), ("u1", "markdown", "# x"), ("u2", "markdown", "# Home"), ("u3", "markdown", "c"), ("u4", "markdown", '{"a": 1}')]


def test_extractions(spark):
    items = [{"data": {"a": [1]}, "content_type": "application/json"}, {"data": None}, {}, {"data": "text", "content_type": "text/plain"}]
    rows = payloads.parse_extractions(frame(spark, items)).select("extraction_success", F.to_json("data").alias("d")).collect()
    assert [tuple(r) for r in rows] == [(True, '{"a":[1]}'), (False, None), (False, None), (True, '"text"')]
