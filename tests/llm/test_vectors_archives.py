"""Nearest vectors, archives, and the registered queries."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checker import compare, connect
from crawlweave.llm import hash_forest, warc_salvage
from crawlweave.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def exact(rows, queries, k):
    out = {}
    vectors = {i: np.array(v) for i, v in rows}
    for q, v in queries:
        scores = [(-(vectors[i] * np.array(v)).sum(), i) for i in vectors if i != q and len(vectors[i]) == len(v)]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_nearest_awkward(spark):
    rng = np.random.default_rng(1)
    good = [(i, (rng.normal(size=6) * rng.uniform(0.1, 5)).tolist()) for i in range(80)]
    good += [(100 + i, good[3][1]) for i in range(40)] + [(200, [1.0, 2.0]), (220, [2.0, -1.0])]
    bad = [(300, None), (301, [0.0] * 6), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (304, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (305, [])]
    frame = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("v", F.lit("x"))
    got = {}
    for r in hash_forest.nearest(frame, frame.where("vec_id % 20 = 0 OR vec_id > 299"), k=5, recall=1.0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    want = exact(good, [g for g in good if g[0] % 20 == 0], 5)
    assert {q: [found[k] for k in sorted(found)] for q, found in got.items()} == want
    nothing = spark.createDataFrame([], frame.schema)
    assert hash_forest.nearest(nothing, nothing).collect() == []
    assert hash_forest.nearest(frame, nothing).collect() == []


def test_nearest_ties():
    vectors = np.array([[1.0] + [float(i >> b & 1) for b in range(8)] for i in range(256)])
    ids = np.random.default_rng(3).permutation(256)
    forest = hash_forest.Forest(vectors, float(np.linalg.norm(vectors, axis=1).max()))
    got = hash_forest.nearest_in(forest, ids, np.array([1000]), np.eye(9)[:1], 5, 1.0)
    assert got["vec_id"].to_pylist() == [0, 1, 2, 3, 4]


def test_nearest_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = rows.orderBy("vec_id").collect()
    ids, vectors = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    got = {}
    for r in hash_forest.nearest(rows, rows.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    hits = 0
    for place in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[place]
        scores[place] = -np.inf
        assert len(got[ids[place]]) == 20
        hits += len(set(got[ids[place]]) & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(got)


def packed(data):
    tool = zlib.compressobj(4, zlib.DEFLATED, 31)
    return tool.compress(data) + tool.flush()


@pytest.mark.parametrize("wrap", [bytes, packed], ids=["plain", "gzip"])
def test_salvage(wrap):
    body = b"text with WARC/1.0\r\nContent-Length: 3\r\n\r\ninside "
    records = [warc_salvage.record_bytes(i, f"http://x.example/{i}", body * (i + 1), None, "2000-01-01T00:00:00Z") for i in range(12)]
    parts = [wrap(r) for r in records]
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).tolist()

    def read(data):
        rows = list(warc_salvage.salvage("f", pa.BufferReader(bytes(data))))
        return [(r["begin"], r["finish"]) if r.get("reason") else int(r["record_id"][11:-1]) for r in rows]

    whole = b"".join(parts)
    assert read(whole) == list(range(12))
    assert read(b"") == [] and read(b"junk") == [(0, 4)]
    assert read(b"junk " * 9 + whole) == [(0, 45), *range(12)]
    assert read(whole[: at[7] + 30]) == [*range(7), (at[7], at[7] + 30)]
    broken = bytearray(whole)
    broken[at[4] + len(parts[4]) - 12] ^= 255  # in the payload
    broken[at[9]] ^= 255  # in the first bytes
    assert read(broken) == [*range(4), (at[4], at[5]), *range(5, 9), (at[9], at[10]), 10, 11]
    end = at[5] + len(parts[5]) - 30  # a record without its end
    assert read(whole[:end] + whole[at[6] :]) == [*range(5), (at[5], end), *range(6, 12)]


@pytest.mark.parametrize("filler", [0, 3_000_000])
def test_salvage_inside_a_member(filler):
    rng = np.random.default_rng(4)
    bodies = [rng.integers(97, 123, 3000 + filler * (i == 1), dtype=np.uint8).tobytes() for i in range(40)]
    records = [warc_salvage.record_bytes(i, f"http://x.example/{i}", b, None, "2000-01-01T00:00:00Z") for i, b in enumerate(bodies)]

    def read(data):
        rows = list(warc_salvage.salvage("f", pa.BufferReader(bytes(data))))
        return [(r["begin"], r["finish"]) if r.get("reason") else int(r["record_id"][11:-1]) for r in rows]

    bad = bytearray(records[20])
    bad[-100] ^= 1
    one, two = packed(b"".join([*records[:20], bytes(bad), *records[21:30]])), packed(b"".join(records[30:]))
    whole = packed(b"".join(records))
    assert read(whole) == list(range(40))
    assert read(one + two) == [*range(20), (0, len(one)), *range(21, 40)]
    for wrong in (b"WARC/9.9", b"Content-Length: 1\r\nX: "):
        middle = records[20].replace(b"WARC/1.1", wrong) if wrong[:4] == b"WARC" else records[20].replace(b"Content-Length: 3", wrong)
        assert 20 not in read(packed(b"".join([*records[:20], middle, *records[21:]])))[:20]
        assert read(packed(b"".join([*records[:20], middle, *records[21:]])))[21:] == list(range(21, 40))
    cut = read(whole[: len(whole) * 3 // 4] + two)
    n = cut.index((0, len(whole) * 3 // 4))
    assert n > (0 if filler else 25) and cut == [*range(n), (0, len(whole) * 3 // 4), *range(30, 40)]
    crc = bytearray(whole)
    crc[-6] ^= 255
    assert read(bytes(crc) + two) == [*range(40), (0, len(whole)), *range(30, 40)]


def test_archives_awkward(spark):
    rows = [(1, "http://a/\r\nX: 1", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "x" * 300_000), (None, "u", "<p>é</p>"), (2, None, "<p>é</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("clash"))
    files = warc_salvage.write_archives(frame, file_bytes=200)
    read = warc_salvage.read_archives(files)
    assert read.where("reason IS NOT NULL").count() == 0
    got = read.select(warc_salvage.row_id("record_id").alias("id"), "record_type", warc_salvage.row_id("refers_to").alias("first"), "payload_bytes", "payload", "target_uri").collect()
    seen = sorted(((r.id, r.record_type, r.first, r.payload_bytes, bytes(r.payload)) for r in got), key=str)
    p = "<p>é</p>".encode()
    want = [(1, "response", None, 9, p), (2, "revisit", 1, 9, b""), (2, "revisit", 1, 9, b""), (3, "response", None, 0, b""), (4, "revisit", 3, 0, b""), (5, "response", None, 300_000, b"x" * 300_000), (None, "response", None, 9, p)]
    assert seen == sorted(want, key=str)
    assert {r.target_uri for r in got} == {"http://a/%0D%0AX: 1", None, "u"}
    long_only = warc_salvage.read_archives(warc_salvage.write_archives(frame, least_bytes=10), payload=False)
    assert {r.record_type for r in long_only.collect()} == {"response"}
    assert warc_salvage.read_archives(warc_salvage.write_archives(frame.limit(0))).collect() == []


def test_archive_listing(spark):
    files = warc_salvage.write_archives(spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string"))
    path = files.first().path
    assert warc_salvage.list_archives(spark, path.rsplit("/", 1)[0]).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs(spark, name):
    if name in ORACLES:
        ok, message = compare(spark, connect(SF_DIR), name, QUERIES[name], ORACLES[name], SF_DIR)
        assert ok, message
    else:
        tables = {"op2_hash_forest": "embeddings", "op3_warc_salvage": "pages"}
        n = spark.read.parquet(f"{SF_DIR}/{tables.get(name, 'documents')}.parquet").count()
        rows = QUERIES[name](spark, SF_DIR).count()
        assert rows == n if name != "op2_hash_forest" else rows > 0


def salvaged(data):
    return list(warc_salvage.salvage("x", pa.BufferReader(data)))


def test_false_members_and_damaged_types():
    """Thousands of bytes that only look like members, and a record whose type line is broken."""
    import time

    records = [warc_salvage.record_bytes(i, f"https://e.example/{i}", b"payload %d" % i, None, "2000-01-01T00:00:00Z") for i in range(4)]
    members = [zlib_member(r) for r in records]
    false = b"\x1f\x8b\x08\x00" * 4000 + b"\x1f\x8b\x08\x00junk\x00\x03\xff" * 500
    start = time.perf_counter()
    rows = salvaged(members[0] + false + b"".join(members[1:]))
    assert time.perf_counter() - start < 20
    assert [r["record_id"] for r in rows if not r["reason"]] == [f"<urn:x-row:{i}>" for i in range(4)]
    assert [(r["begin"], r["finish"]) for r in rows if r["reason"]] == [(len(members[0]), len(members[0]) + len(false))]
    broken = records[1].replace(b"WARC-Type", b"WARC-Tipe")
    for data in (records[0] + broken + records[2], zlib_member(records[0] + broken + records[2])):
        rows = salvaged(data)
        assert [r["record_id"] for r in rows if not r["reason"]] == ["<urn:x-row:0>", "<urn:x-row:2>"]
        assert len([r for r in rows if r["reason"]]) == 1


def zlib_member(data):
    pack = zlib.compressobj(4, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), "test-stage")
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        sizes.append(docs.count())
    assert docs.where("NOT round_trip OR round_trip IS NULL").isEmpty()
    assert 0 < sizes[2] <= sizes[1] == sizes[0] < 200 and sizes[3] == sizes[4]
    assert corpus_pipeline.run(spark, SF_DIR).count() == sizes[4]
    nothing = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, SF_DIR)
        assert nothing.count() == 0
