"""Operators on small hand-made inputs, and skewed ones against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from crawlweave.functions import errors as E
from crawlweave.operators import audits, extract, filters, guards, joins, monitoring, ordering, stats, text
from crawlweave.session import Buckets

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """Attempts of which one crawl holds most rows, with equal times and empty hours."""
    rng = random.Random(7)
    rows, at = [], T0
    for i in range(3000):
        at += dt.timedelta(seconds=rng.choice([0, 1, 30, 9000]))
        crawl = "hot" if rng.random() < 0.8 else f"c{rng.randrange(40)}"
        code = rng.choice([None, None, E.MONITORED_CODES[0], E.THROTTLE_CODES[0]])
        rows.append((crawl, at, i, code, rng.randrange(5)))
    df = spark.createDataFrame(rows, "crawler_uuid string, ts timestamp, event_id bigint, error_code string, api_credit bigint")
    return rows, df.repartition(7)


def by_crawl(rows):
    out = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("slot_rows", [1, 64, 8192])
def test_ranged_rank_and_sum(skewed, slot_rows):
    rows, df = skewed
    got = ordering.ranged(df, ["crawler_uuid"], ["ts", "event_id"], sums={"total": "api_credit"}, first={"begin": "ts"}, slot_rows=slot_rows)
    want = set()
    for crawl, items in by_crawl(rows).items():
        total = 0
        for rank, item in enumerate(items, 1):
            total += item[4]
            want.add((crawl, item[2], rank, total, items[0][1]))
    assert {tuple(r) for r in got.select("crawler_uuid", "event_id", "rank", "total", "begin").collect()} == want
    with pytest.raises(ValueError):
        ordering.ranged(df, ["crawler_uuid"], ["ts"], slot_rows=100)


def test_one_hot_hour_is_shared_out(spark):
    """Four of five rows in one hour of one crawl: no task gets more than twice the mean."""
    hot = F.col("id") % 5 < 4
    ts = F.timestamp_seconds(F.when(hot, F.col("id") % 3600).otherwise(F.col("id") * 60) + 1_700_000_000)
    df = spark.range(0, 100_000, 1, 8).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("crawler_uuid"), ts.alias("ts"), F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, E.MONITORED_CODES[0]).alias("error_code"), F.lit(1).cast("bigint").alias("api_credit"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ordering.ranged(df, ["crawler_uuid"], ["ts", "event_id"], sums={"total": "api_credit"}, slot_rows=512)
        rates = guards.failure_rate(df, block_rows=512, slot_rows=512)
        for out in (ranked, rates):
            sizes = [r["count"] for r in out.withColumn("_task", F.spark_partition_id()).groupBy("_task").count().collect()]
            assert sum(sizes) == 100_000 and max(sizes) <= 2 * sum(sizes) / len(sizes) and len(sizes) == 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranked.filter(F.col("rank") != F.col("total")).isEmpty()


def test_running_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, o bigint")
    got = ordering.running(df, ["k"], ["o"], ordering.id_range("o", 1))
    assert sorted((r["k"] or "", r["rank"]) for r in got.collect()) == [("", 1), ("", 2), ("a", 1)]


@pytest.mark.parametrize("block_rows", [9, 10, 64, 100000])
def test_failure_rate(skewed, block_rows):
    rows, df = skewed
    want = {}
    for crawl, items in by_crawl(rows).items():
        bad = [i[3] in E.MONITORED_CODES for i in items]
        for n, item in enumerate(items):
            recent = sum(bad[max(0, n - 9) : n + 1])
            want[item[2]] = (recent, n >= 9 and recent >= 4)
    rates = guards.failure_rate(df, threshold=0.4, block_rows=block_rows)
    assert {r["event_id"]: (r["recent_failures"], r["stop"]) for r in rates.collect()} == want
    stops = {r["crawler_uuid"]: r["event_id"] for r in guards.first_stops(rates).collect()}
    first = {}
    for crawl, items in by_crawl(rows).items():
        hits = [i[2] for i in items if want[i[2]][1]]
        if hits:
            first[crawl] = hits[0]
    assert stops == first and "hot" in stops


def test_seven_of_ten_stops_and_fewer_do_not(spark):
    def rows(crawl, flags):
        return [(crawl, T0 + dt.timedelta(seconds=i), i, E.MONITORED_CODES[2] if f else None) for i, f in enumerate(flags)]

    data = rows("stop", [1] * 7 + [0] * 3) + rows("six", [1] * 6 + [0] * 4) + rows("short", [1] * 9)
    df = spark.createDataFrame(data, "crawler_uuid string, ts timestamp, event_id bigint, error_code string")
    assert [tuple(r)[:3] for r in guards.first_stops(guards.failure_rate(df)).collect()] == [("stop", 10, 9)]


@pytest.mark.parametrize("block_rows", [1, 50])
def test_throttle_report(skewed, block_rows):
    rows, df = skewed
    want = {}
    for crawl, items in by_crawl(rows).items():
        gaps = [(b[1] - a[1]).total_seconds() for a, b in zip(items, items[1:] + [None]) if b is not None and a[3] in E.THROTTLE_CODES]
        pauses = sum(i[3] in E.THROTTLE_CODES for i in items)
        if pauses:
            want[crawl] = (pauses, pauses * 5, min(gaps, default=None), sum(g < 5 for g in gaps))
    got = guards.throttle_report(df, block_rows=block_rows)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


def test_budgets(spark):
    visits = spark.createDataFrame([("a", T0 + dt.timedelta(seconds=i), i, 10) for i in range(5)] + [("b", T0, 9, 1)], "crawler_uuid string, ts timestamp, event_id bigint, api_credit bigint")
    limits = spark.createDataFrame([("a", 0, 25, 3600)], "crawler_uuid string, page_limit int, max_api_credit int, max_duration int")
    got = {r["event_id"]: (r["state"], r["reason"]) for r in guards.apply_budgets(visits, limits).collect()}
    spent = ("skipped", "max_api_credit")
    assert got == {0: ("visited", None), 1: ("visited", None), 2: ("visited", None), 3: spent, 4: spent, 9: ("visited", None)}


def test_pages_of_a_list(spark):
    df = spark.range(1000).select(F.format_string("u%04d", "id").alias("url")).repartition(5)
    assert [r[0] for r in guards.paginate(df, ["url"], page=3, per_page=7).collect()] == [f"u{i:04d}" for i in range(14, 21)]
    assert [r[0] for r in guards.paginate(df, ["url"], page=143, per_page=7).collect()] == [f"u{i:04d}" for i in range(994, 1000)]
    assert guards.paginate(df, ["url"], page=200, per_page=7).count() == 0
    for page, size in ((0, 10), (1, 0), (1, 1001)):
        with pytest.raises(ValueError):
            guards.paginate(df, ["url"], page=page, per_page=size)


def test_driver_side_checks(spark):
    df = spark.createDataFrame([("https://e.example/a", 200)], "url string, status_code int")
    with pytest.raises(ValueError):
        filters.filter_paths(df, include=["/a"], exclude=["/b"])
    with pytest.raises(ValueError):
        filters.filter_paths(df, exclude=["/x"] * 101)
    with pytest.raises(ValueError):
        filters.scope_links(df, "https://e.example", allowed_external_domains=["d"] * 251)
    with pytest.raises(ValueError):
        filters.match_rules(df, [filters.ExtractionRule("/a", "magic")])
    with pytest.raises(ValueError):
        monitoring.monitoring_metrics(df, aggregation=["team"])
    with pytest.raises(ValueError):
        monitoring.within(df, start=T0)
    with pytest.raises(ValueError):
        joins.dedupe_records(df, keep="middle")


def test_path_regex_syntax_and_seed(spark):
    df = spark.createDataFrame([("https://e.example/products/1",), ("https://e.example/",), ("https://e.example/admin/x?y=/products/",)], "url string")
    kept = filters.filter_paths(df, include=[r"^/products?/.*"], syntax="regex", seed="https://e.example/")
    assert sorted(r[0] for r in kept.collect()) == ["https://e.example/", "https://e.example/products/1"]


def test_error_hierarchy_and_messages(spark):
    failures = spark.createDataFrame(
        [(422, 404, E.BAD_UPSTREAM, "m", True, 9), (200, 503, E.BAD_UPSTREAM, "m", False, None), (429, None, "ERR::THROTTLE::X", "m", False, None), (422, None, "ERR::ASP::X", "m", False, None), (503, None, "ERR::ASP::X", "m", False, None)],
        "api_status int, upstream_status int, error_code string, error_message string, retryable boolean, retry_after int",
    )
    rows = filters.classify_errors(failures).collect()
    assert [r["error_class"] for r in rows] == ["ScrapeError", "UpstreamHttpServerError", "TooManyRequest", "AspError", "ApiHttpServerError"]
    assert rows[0]["full_message"] == f"404 {E.BAD_UPSTREAM} m. Retry delay : 9 seconds" and rows[0]["retry_delay"] == 9
    assert joins.class_ancestors()["UpstreamHttpServerError"] == ["UpstreamHttpClientError", "UpstreamHttpError", "HttpError", "ServiceError"]


def test_traps(spark):
    visits = spark.createDataFrame([(f"https://maze.example/{p}",) for p in ("jump", "month/7", "month/8")], "url string")
    traps = {"one_page": ("/jump$", 1), "endless_months": ("/month/", 1), "closed_area": ("/staff", 0)}
    assert {r["trap"]: (r["hits"], r["passed"]) for r in stats.trap_report(visits, traps).collect()} == {
        "one_page": (1, True), "endless_months": (2, False), "closed_area": (0, True),
    }


def test_fragment_variants_are_one_page(spark):
    from crawlweave.functions.urls import normalize_url

    links = spark.createDataFrame([(f"https://t.example/f#{c}",) for c in "abc"], "u string")
    assert links.select(normalize_url(F.col("u"))).distinct().count() == 1


def test_redirects(spark):
    hops = [(f"r{i}", f"r{i + 1}") for i in range(1, 10)] + [("a", "b"), ("b", "a"), ("self", "self"), ("in", "a")] + [(f"l{i}", f"l{i + 1}") for i in range(33)]
    rows = {r["from_url"]: r for r in audits.redirect_chains(spark.createDataFrame(hops, "from_url string, to_url string")).collect()}
    assert len(rows) == len(hops)
    assert (rows["r1"]["end_url"], rows["r1"]["hops"], rows["r1"]["is_loop"]) == ("r10", 9, False)
    assert all(rows[u]["is_loop"] for u in ("a", "b", "self", "in")) and rows["a"]["hops"] == 2 and rows["in"]["hops"] == 3
    assert (rows["l0"]["end_url"], rows["l0"]["hops"]) == ("l33", 33)
    moved = spark.createDataFrame([("m", "old", 1), ("m", "new", 2)], "from_url string, to_url string, seen_at int")
    assert [r["end_url"] for r in audits.redirect_chains(moved, "seen_at").collect()] == ["new"]


def test_lost_requests_are_tried_after_a_second(spark):
    failures = spark.createDataFrame([(1, "E", True, 9, True), (2, "E", True, 9, False), (3, "E", False, 9, True), (4, "E", False, 9, False)], "request_id int, error_code string, retryable boolean, retry_after int, never_received boolean")
    requests = spark.createDataFrame([(i, "u", 0, 0, False) for i in range(1, 5)], "request_id int, url string, retry_times int, priority int, cache boolean")
    assert {r["request_id"]: r["delay_s"] for r in joins.retry_queue(failures, requests).collect()} == {1: 1, 2: 9, 3: 1}


def test_missing_status_is_zero(spark):
    for kind in ("int", "string"):
        pages = spark.sql(f"SELECT CAST(s AS {kind}) AS status_code FROM VALUES (0), (200), (NULL) AS t(s)")
        assert filters.filter_status(pages, 0).count() == 2 and filters.filter_status(pages, 200).count() == 1


def test_first_record_over_several_files(spark):
    records = spark.createDataFrame([("u", "b.warc", 1), ("u", "a.warc", 7)], "url string, path string, record_seq int")
    assert filters.read_url(records, "u").first()["path"] == "a.warc"
    assert joins.dedupe_records(records).first()["path"] == "b.warc"


def test_last_content_of_a_url_counts(spark):
    contents = spark.createDataFrame([("u", "text", "zzz", 1), ("u", "text", "aaa", 2)], "url string, format string, content string, seq int")
    assert joins.lookup_urls(contents, contents.select("url"), ["text"], ["seq"]).first()["text"] == "aaa"


def test_every_page_of_a_list(spark):
    rows = spark.range(57).selectExpr("id * 7 % 57 AS x").repartition(5)
    pages = [[r["x"] for r in guards.paginate(rows, ["x"], p, 10).collect()] for p in range(1, 8)]
    assert [x for page in pages for x in page] == list(range(57)) and pages[6] == []


def test_a_page_reads_its_ranges_only(spark):
    rows = spark.range(5000).selectExpr("id * 7919 % 5003 AS x", "'y' AS y").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = guards.RankedList(rows, ["x"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranked.index.count() == 4
    want = sorted(r["x"] for r in rows.collect())
    for page in (1, 7, 50):
        found = ranked.page(page, 100)
        assert [r["x"] for r in found.collect()] == want[(page - 1) * 100 : page * 100]
        assert len(found.inputFiles()) == 4 and "PartitionFilters: [isnotnull(_part" in found._jdf.queryExecution().executedPlan().toString()
    assert ranked.page(51, 100).isEmpty() and ranked.page(51, 100).columns == ["x", "y"]
    assert guards.RankedList(rows.limit(0), ["x"]).page(1).isEmpty()


def test_block_rules_of_a_table(spark):
    pages = spark.createDataFrame(
        [(1, "u", 403, {"Server": "cloud-gate"}, "x"), (2, "u", 200, {}, "Please  verify you ARE human!"), (3, "u", 200, None, "verify humans"),
         (4, "", 403, {}, ""), (5, "u", 403, {"server": None}, None), (6, "u", 429, {"via": "cloud-gate"}, "verify you are human")],
        "page_id int, url string, status_code int, headers map<string,string>, content string",
    )
    rules = [(3, "any", [403], {}, None), (1, "gate", [403, 429], {"SERVER": "gate"}, None), (2, "human", [], {}, "verify, you are human"), (0, "nothing", [], {}, "")]
    table = spark.createDataFrame(rules, "rule_ord int, vendor string, statuses array<int>, headers map<string,string>, body string")
    got = {r["page_id"]: (r["valid_input"], r["blocked"], r["antibot"], r["cost"]) for r in filters.detect_blocked_by(pages, table).collect()}
    assert got == {
        1: (True, True, "gate", 1), 2: (True, True, "human", 1), 3: (True, False, None, 1), 4: (False, None, None, 0),
        5: (True, True, "any", 1), 6: (True, True, "human", 1),
    }
    assert {r["blocked"] for r in filters.detect_blocked_by(pages, table.limit(0)).collect()} == {False, None}


def test_depth(spark):
    links = spark.createDataFrame([("c", "s", "a"), ("c", "a", "b"), ("c", "b", "s"), ("c", "s", "b2"), ("d", "a", "z")], "crawler_uuid string, source_url string, target_url string")
    seeds = spark.createDataFrame([("c", "s")], "crawler_uuid string, url string")
    assert {(r["url"], r["depth"]) for r in audits.crawl_depth(links, seeds).collect()} == {("s", 0), ("a", 1), ("b2", 1), ("b", 2)}
    assert {r["url"] for r in audits.crawl_depth(links, seeds, max_depth=1).collect()} == {"s", "a", "b2"}
    deep = spark.createDataFrame([("c", f"n{i}", f"n{i + 1}") for i in range(60)], links.schema)
    start = spark.createDataFrame([("c", "n0")], seeds.schema)
    assert {(r["url"], r["depth"]) for r in audits.crawl_depth(deep, start, max_depth=20).collect()} == {(f"n{i}", i) for i in range(21)}
    assert audits.crawl_depth(links.limit(0), seeds).collect() == [("c", "s", 0)]
    assert audits.crawl_depth(links, seeds.limit(0)).isEmpty()


def test_a_level_shuffles_no_edges(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    edges = Buckets(spark, "links", ["crawler_uuid", "url"])
    reached = Buckets(spark, "reached", ["crawler_uuid", "url"])
    try:
        edges.append(spark.range(1000).selectExpr("'c' AS crawler_uuid", "id AS url", "id * 2 AS next_url"))
        reached.append(spark.range(10).selectExpr("'c' AS crawler_uuid", "id AS url", "0 AS depth"))
        plan = reached.rows().join(edges.rows(), ["crawler_uuid", "url"])._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        edges.forget()
        reached.forget()


def plain_chain(step, url):
    seen, hops = {url}, 0
    while url in step:
        url, hops = step[url], hops + 1
        if url in seen:
            return url, hops, True
        seen.add(url)
    return url, hops, False


def test_redirects_of_every_shape(spark):
    rng = random.Random(5)
    step = {f"n{i}": f"n{i + 1}" for i in range(1000)}  # a thousand hops
    step |= {"self": "self", "t1": "self", "x": "y", "y": "x", "z": "x"}
    step |= {f"c{i}": f"c{(i + 1) % 37}" for i in range(37)} | {f"d{i}": f"d{(i + 1) % 16}" for i in range(16)}
    step |= {f"tail{i}": f"tail{i + 1}" for i in range(90)} | {"tail90": "c5"}
    step |= {f"r{i}": f"r{rng.randrange(400)}" for i in range(300)}
    hops = spark.createDataFrame([(a, b) for a, b in step.items()] + [("n0", "zzz"), (None, "n3")], "from_url string, to_url string").repartition(5)
    got = {r["from_url"]: (r["end_url"], r["hops"], r["is_loop"]) for r in audits.redirect_chains(hops).collect()}
    assert got == {url: plain_chain(step, url) for url in step}
    assert audits.redirect_chains(hops.limit(0)).isEmpty()


def test_robots_longest_rule_wins(spark):
    rules = spark.createDataFrame([("e.example", "Disallow", "/a/"), ("e.example", "Allow", "/a/ok"), ("e.example", "Disallow", "/*.pdf$"), ("e.example", "Disallow", "/x+y(")], "host string, rule string, path string")
    visits = spark.createDataFrame([(f"https://E.example{p}",) for p in ("/a/no", "/a/ok/1", "/b.pdf", "/b.pdf?x", "/x+y(z", "/")] + [("https://other.example/a/no",)], "url string")
    got = {r["url"]: r["disallowed"] for r in audits.robots_audit(visits, rules).collect()}
    assert {u for u, bad in got.items() if bad} == {"https://E.example/a/no", "https://E.example/b.pdf", "https://E.example/x+y(z"}


def test_media_requests_take_strings_and_structs_only(spark):
    df = spark.sql("SELECT 1 AS i, array(named_struct('url', 'u', 'method', 'GET')) AS file_urls, array(1) AS numbers")
    assert joins.explode_media_requests(df.drop("numbers")).first()["media_url"] == "u"
    with pytest.raises(ValueError):
        joins.explode_media_requests(df, "numbers")


def test_retrieval_matches_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(200, 8)).astype("float32")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>").repartition(6)
    queries = spark.createDataFrame([(0, vectors[3].tolist()), (1, (-vectors[5]).tolist())], "query_id bigint, embedding array<float>")
    got = text.retrieve_top_k(df, queries, k=5).orderBy("query_id", "rank").collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for q, probe in ((0, vectors[3]), (1, -vectors[5])):
        best = np.argsort(-(unit @ (probe / np.linalg.norm(probe))))[:5]
        assert [r["vec_id"] for r in got if r["query_id"] == q] == best.tolist()
    in_blocks = text.retrieve_top_k(df, queries, k=5, block=1, vector_block=17).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in in_blocks] == [(r["query_id"], r["vec_id"]) for r in got]


LIBRARY = """<html><body data-branch="north"><h2>Reading   room</h2><p class="note">Open <i>daily</i> &amp; late</p>
<dl><dt>Seats</dt><dd>120</dd><dt>Desks</dt><dd>35</dd></dl><a href="plan.svg">Plan</a><a>no target</a>
<p class="fee">Card: $12.00, lost card: $7.50</p></body></html>"""


def fields(spark, *selectors, page=LIBRARY):
    import json

    pages = spark.createDataFrame([("https://books.example/north/index", page)], "url string, content string")
    row = extract.extract_fields(pages, {"source": "html", "selectors": list(selectors)}).select(F.to_json("data").alias("d")).first()
    return json.loads(row["d"])


def test_template_text_and_attributes(spark):
    got = fields(
        spark,
        {"name": "room", "query": "h2::text", "type": "css"},
        {"name": "branch", "query": "//body/@data-branch", "type": "xpath"},
        {"name": "note", "query": "p.note", "type": "css", "formatters": [{"name": "remove_html"}]},
        {"name": "nothing", "query": "h6::text", "type": "css"},
    )
    assert got["branch"] == "north" and got["room"].split() == ["Reading", "room"] and "daily" in got["note"] and "<i>" not in got["note"]
    assert "nothing" not in got


def test_template_many_and_casts(spark):
    got = fields(
        spark,
        {"name": "labels", "query": "dt::text", "type": "css", "multiple": True, "formatters": [{"name": "lowercase"}]},
        {"name": "seats", "query": "//dd[1]/text()", "type": "xpath", "cast": "int"},
        {"name": "plan", "query": "a::attr(href)", "type": "css", "formatters": [{"name": "absolute_url"}]},
    )
    assert got == {"labels": ["seats", "desks"], "seats": 120, "plan": "https://books.example/north/plan.svg"}


def test_template_nested_and_prices(spark):
    got = fields(
        spark,
        {"name": "list", "query": "dl", "type": "css", "nested": [{"name": "names", "query": "dt::text", "type": "css", "multiple": True}]},
        {"name": "fee", "query": "p.fee::text", "type": "css", "extractor": {"name": "price"}},
        {"name": "numbers", "query": r"(\d+)</dd>", "type": "regex", "multiple": True, "cast": "int"},
    )
    assert got == {"list": [{"names": ["Seats", "Desks"]}], "fee": {"amount": 12.0, "currency": "USD"}, "numbers": [120, 35]}


def test_template_on_an_empty_page(spark):
    assert fields(spark, {"name": "room", "query": "h2::text", "type": "css"}, page="") == {}


@pytest.mark.parametrize(
    "selector",
    [{"name": "a", "query": "a:hover", "type": "css"}, {"name": "a", "query": "//a[last()]", "type": "xpath"}, {"name": "a", "query": "x", "type": "jmespath"},
     {"name": "a", "query": "a >", "type": "css"}, {"name": "a", "query": "a", "type": "css", "cast": "money"}, {"name": "a", "query": "a", "extractor": {"name": "phones"}}, {"query": "a"}],
)
def test_unsupported_templates_fail_before_a_job(spark, selector):
    pages = spark.createDataFrame([("u", "c")], "url string, content string")
    with pytest.raises(ValueError):
        extract.extract_fields(pages, {"selectors": [selector]})
