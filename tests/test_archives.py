"""WARC and HAR readers on awkward files."""

import gzip
import io
import json

import pytest

from crawlweave.operators.filters import responses
from crawlweave.sources import files, har, warc, warc_splits, warc_stream


def record(kind, url, block, **headers):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Target-URI: {url}", f"Content-Length: {len(block)}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items()]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


PAGE = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-A: 1\r\nX-A: 2\r\n\r\n"
TRICKY = PAGE + b"body\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\nmore"
RECORDS = [
    record("warcinfo", "", b"software: x"),
    record("response", "https://e.example/a", TRICKY, WARC_Scrape_Country="us", WARC_Scrape_Duration="1.5"),
    record("response", "https://e.example/lf", b"HTTP/1.0 404 Gone\nServer: s\n\nlf body"),
    record("response", "https://e.example/h2", b"HTTP/2 201 Made\r\n\r\n"),
    record("response", "https://e.example/odd", b"no head at all"),
    record("conversion", "https://e.example/a", b"# text"),
    record("request", "https://e.example/a", b"GET / HTTP/1.1\r\n\r\n"),
]


def read(spark, path, **kw):
    return {(r["url"], r["record_type"]): r for r in warc.read_warc(spark, str(path), **kw).collect()}


def check(rows):
    assert len(rows) == 6 and ("https://e.example/a", "conversion") not in rows
    page = rows[("https://e.example/a", "response")]
    assert bytes(page["content"]) == TRICKY[len(PAGE) :] and page["status_code"] == 200
    assert page["headers"]["X-A"] == "2" and page["warc_headers"]["WARC-Scrape-Country"] == "us"
    assert rows[("https://e.example/lf", "response")]["status_code"] == 404
    assert bytes(rows[("https://e.example/lf", "response")]["content"]) == b"lf body"
    assert rows[("https://e.example/h2", "response")]["status_code"] == 201
    assert rows[("https://e.example/odd", "response")]["status_code"] is None


def test_plain(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"".join(RECORDS))
    check(read(spark, tmp_path))


def test_gzip_with_one_member_per_record(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in RECORDS))
    check(read(spark, tmp_path))


def test_named_types_and_responses(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"".join(RECORDS))
    assert list(read(spark, tmp_path, record_types=["conversion"])) == [("https://e.example/a", "conversion")]
    urls = {r["url"] for r in responses(warc.read_warc(spark, str(tmp_path))).collect()}
    assert urls == {"https://e.example/a", "https://e.example/lf", "https://e.example/h2"}


def test_truncated_last_record_is_kept_short(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes((RECORDS[2] + RECORDS[1])[:-30])
    rows = read(spark, tmp_path)
    assert len(rows) == 2 and len(rows[("https://e.example/a", "response")]["content"]) < len(TRICKY) - len(PAGE)


def test_filters_reach_the_source_and_stay_right(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"".join(RECORDS))
    df = warc.read_warc(spark, str(tmp_path)).filter("url = 'https://e.example/a' AND record_type = 'response'")
    assert [r["status_code"] for r in df.collect()] == [200]


def test_small_files_share_tasks_and_large_ones_do_not():
    mb = 1 << 20
    listed = [("a", 1 * mb), ("b", 1 * mb), ("c", 500 * mb), ("d", 2 * mb)]
    assert [[name for name, _ in group] for group in files.pack(listed, 1)] == [["a", "b"], ["c"], ["d"]]


LOG = {"log": {"version": "1.2", "creator": {"name": "n"}, "pages": [], "entries": []}}


def entry(url, status=200, text='{"a": "}{"}', **content):
    return {
        "startedDateTime": "2024-01-01T00:00:00Z", "time": 12.5, "timings": {"wait": 10, "receive": 2.5},
        "request": {"method": "POST", "url": url, "headers": []},
        "response": {"status": status, "headers": [{"name": "A", "value": "1"}, {"name": "A", "value": "2"}], "content": {"text": text, "mimeType": "text/HTML", "size": 3, **content}},
    }


ENTRIES = [entry("u1"), entry("u2", "404", "aGk=", encoding="base64"), {"request": {"url": "u3"}}, entry("u4", None, 'quote \\" and [')]


@pytest.mark.parametrize("form", ["joined", "standard", "gzip", "pretty"])
def test_har_forms(spark, tmp_path, form):
    standard = {"log": {**LOG["log"], "entries": ENTRIES, "comment": "after"}}
    text = json.dumps(standard, indent=2) if form == "pretty" else json.dumps(standard) if form == "standard" else json.dumps(LOG) + "".join(map(json.dumps, ENTRIES))
    data = text.encode()
    (tmp_path / "a.har").write_bytes(gzip.compress(data) if form == "gzip" else data)
    rows = {r["url"]: r for r in har.read_har(spark, str(tmp_path)).collect()}
    assert list(sorted(rows)) == ["u1", "u2", "u3", "u4"]
    assert rows["u1"]["status_code"] == 200 and rows["u2"]["status_code"] == 404 and rows["u3"]["status_code"] == 0 and rows["u4"]["status_code"] == 0
    assert bytes(rows["u2"]["content"]) == b"hi" and bytes(rows["u1"]["content"]) == b'{"a": "}{"}'
    assert rows["u1"]["headers"] == {"A": "2"} and rows["u3"]["headers"] == {} and rows["u3"]["method"] == "GET"
    assert rows["u1"]["timings"] == {"wait": 10.0, "receive": 2.5} and rows["u1"]["method"] == "POST"
    log = har.read_har_logs(spark, str(tmp_path)).first()
    assert log["version"] == "1.2" and log["creator"]["name"] == "n"


def test_har_stops_at_garbage(spark, tmp_path):
    (tmp_path / "a.har").write_text(json.dumps(LOG) + json.dumps(ENTRIES[0]) + " oops " + json.dumps(ENTRIES[1]))
    assert [r["url"] for r in har.read_har(spark, str(tmp_path)).collect()] == ["u1"]


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 64])
def test_har_objects_across_chunk_borders(monkeypatch, chunk):
    monkeypatch.setattr(har, "CHUNK", chunk)
    for text in (json.dumps(LOG) + " \n".join(map(json.dumps, ENTRIES)), json.dumps({"log": {**LOG["log"], "entries": ENTRIES}}, indent=1)):
        found = [(is_log, json.loads(raw)) for is_log, raw in har.iter_objects(io.BytesIO(text.encode()))]
        assert [e for is_log, e in found if not is_log] == ENTRIES
        assert [e["log"]["version"] for is_log, e in found if is_log] == ["1.2"]


FAKE = b"x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: fake\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"


BIG = [record("response", f"https://e.example/{i}", PAGE + (FAKE * (i % 4) + b"-" * (i * 37 % 900))) for i in range(60)]


def shape(df):
    return sorted((r["path"], r["record_seq"], r["url"], bytes(r["content"])) for r in df.collect())


@pytest.mark.parametrize("range_bytes", [97, 400, 5000])
def test_ranges_of_one_file_give_the_same_records(spark, tmp_path, range_bytes):
    (tmp_path / "a.warc").write_bytes(b"".join(BIG))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(b"".join(BIG[:9])))
    (tmp_path / "c.warc").write_bytes(b"".join(BIG[:5]) + b"garbage\r\n" + b"".join(BIG[5:9]))
    (tmp_path / "d.warc.gz").write_bytes(b"".join(map(gzip.compress, BIG)))
    whole = shape(warc.read_warc(spark, str(tmp_path)))
    assert len(whole) == 60 + 9 + 9 + 60 and "fake" not in {u for _, _, u, _ in whole}
    assert shape(warc.read_warc(spark, str(tmp_path), range_bytes=range_bytes)) == whole
    plan = [tuple(r) for r in warc_splits.pieces(spark, files.list_files(str(tmp_path)), range_bytes).collect()]
    assert all(len([p for p in plan if p[0].endswith(name)]) > 1 for name in ("a.warc", "d.warc.gz"))
    assert len([p for p in plan if p[0].endswith("b.warc.gz")]) == 1  # one member cannot be shared
    rejects = warc.rejected_warc_records(spark, str(tmp_path), range_bytes).collect()
    assert [(r["path"].rsplit("/", 1)[-1], r["record_seq"], r["reason"]) for r in rejects] == [("c.warc", sum(map(len, BIG[:5])), "no version line")]


def read_bytes(data, begin=0, stop=None):
    source = warc_stream.source_of(io.BytesIO(data), len(data))
    found = list(warc_stream.records(source, begin, len(data) if stop is None else stop, frozenset({"response"})))
    urls = [f.url.rsplit("/", 1)[-1] for f in found if isinstance(f, warc_stream.Record)]
    return urls, [f.reason for f in found if isinstance(f, warc_stream.Reject)]


@pytest.mark.parametrize("chunk", [7, 64, 1 << 18])
def test_reading_goes_on_after_damage(monkeypatch, chunk):
    monkeypatch.setattr(warc_stream, "CHUNK", chunk)
    ten = BIG[:10]
    names = [str(i) for i in range(10)]
    assert read_bytes(b"".join(ten)) == (names, [])
    bad_length = ten[3].replace(b"Content-Length: ", b"Content-Length: x")
    assert read_bytes(b"".join(ten[:3]) + bad_length + b"".join(ten[4:]))[0][:3] == names[:3]
    assert read_bytes(b"".join([*ten[:3], b"WARC/1.0\r\n\r\n", *ten[3:]])) == (names, ["no headers"])
    lost = b"".join(ten[:3]) + ten[3][5:] + b"".join(ten[4:])
    assert read_bytes(lost)[0][-6:] == names[4:] and read_bytes(lost)[1][0] == "no version line"
    assert read_bytes(b"") == ([], []) and read_bytes(b"\r\n\r\n") == ([], [])
    assert read_bytes(b"\r\n".join(ten)) == (names, [])  # more line ends than there should be


@pytest.mark.parametrize("chunk", [600, 1 << 18])
def test_gzip_damage(monkeypatch, chunk):
    monkeypatch.setattr(warc_stream, "CHUNK", chunk)
    members = [gzip.compress(r) for r in BIG[:10]]
    names = [str(i) for i in range(10)]
    assert read_bytes(b"".join(members)) == (names, [])
    broken = bytearray(members[4])
    broken[-6] ^= 255  # the check sum
    assert read_bytes(b"".join([*members[:4], bytes(broken), *members[5:]])) == (names[:4] + names[5:], ["broken member"])
    torn = members[4][: len(members[4]) // 2]
    assert read_bytes(b"".join([*members[:4], torn, *members[5:]])) == (names[:4] + names[5:], ["broken member"])
    assert read_bytes(b"".join(members[:9]) + members[9][:60]) == (names[:9], ["broken member"])
    inside = gzip.compress(BIG[0] + b"noise\r\n" * 3 + BIG[1]) + members[2]
    assert read_bytes(inside) == (["0", "1", "2"], ["no version line"])
    marks = b"\x1f\x8b\x08\x00" * 20_000  # what only looks like members
    assert read_bytes(b"".join([members[0], marks, *members[1:]])) == (names, ["broken member"])
    spanning = b"".join(BIG[:10])
    parts = b"".join(gzip.compress(spanning[i : i + 333]) for i in range(0, len(spanning), 333))
    assert read_bytes(parts) == (names, [])  # records that go on in the next member


@pytest.mark.parametrize("mb", [8, 64])
def test_one_long_string_is_read_in_linear_time(mb):
    import time

    text = '{"log": {"entries": []}}{"a": "' + 'x\\"y}{' * ((mb << 20) // 7) + '"}'
    start = time.perf_counter()
    found = list(har.iter_objects(io.BytesIO(text.encode())))
    assert [is_log for is_log, _ in found] == [True, False] and len(found[1][1]) == len(text) - 24
    assert time.perf_counter() - start < mb / 8
