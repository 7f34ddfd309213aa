"""Writers: layout on disk and file names."""

import pytest
from pyspark.sql import functions as F

from crawlweave.plans import fixtures, registry
from crawlweave.sinks import pages as P, tables
from crawlweave.sources import warc

SF_DIR = "/root/testdata/sf0.001"


def test_page_table_layout(spark, tmp_path):
    records = warc.read_warc(spark, fixtures.write_warc(spark, registry.view(spark, SF_DIR, "crawl_pages")))
    table = tables.page_table(records)
    assert [f.dataType.simpleString() for f in table.schema] == ["string", "string", "timestamp", "smallint", "string", "int", "string", "string", "float", "tinyint"]
    path = str(tmp_path / "pages")
    tables.write_pages_parquet(table, path)
    back = spark.read.parquet(path)
    assert back.count() == table.count()
    plan = back.filter("country = 'EN' AND url = 'https://e.example/a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan and "EqualTo(url,https://e.example/a)" in plan
    files = [f for f in (tmp_path / "pages").rglob("*.parquet")]
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)


@pytest.mark.parametrize(
    "url, content_type, name",
    [
        ("https://e.example/a/page", "text/html; charset=utf-8", "page.html"),
        ("https://e.example/a/page.html", "text/html", "page.html"),
        ("https://e.example/a/b/", "text/html", "e.example-a-b.html"),
        ("https://e.example/data", None, "data.octet-stream"),
        ("https://e.example/i.png", "image/png", "i.png"),
    ],
)
def test_file_names(one, url, content_type, name):
    assert one(P.file_name(F.col("u"), F.col("t").cast("string")), u=url, t=content_type) == name


def test_page_files_do_not_overwrite_each_other(spark, tmp_path):
    rows = [(f"https://e.example/{d}/same", "text/html", i, f"body {i}") for i, d in enumerate("abc")]
    pages = spark.createDataFrame(rows, "url string, content_type string, record_seq bigint, content string").repartition(3)
    P.write_page_files(P.plan_page_files(pages, keys=("record_seq",)), str(tmp_path / "out"))
    found = {f.name: f.read_text() for f in (tmp_path / "out").iterdir()}
    assert found == {"same.html": "body 0", "same-2.html": "body 1", "same-3.html": "body 2"}


def test_site_text(spark, tmp_path):
    rows = [("s", "https://e.example/b", 200, " # B \n"), ("s", "https://e.example/a", 200, "A"), ("s", "https://e.example/c", 404, "C"), ("s", "https://e.example/d", 200, "  ")]
    pages = spark.createDataFrame(rows, "site string, url string, status_code int, content string")
    P.write_llms_txt(P.build_llms_txt(pages, "Docs", "All of it"), str(tmp_path / "txt"))
    text = "".join(f.read_text() for f in sorted((tmp_path / "txt" / "site=s").glob("*.txt")))
    assert text.startswith("# Docs\n\n> All of it\n") and text.index("### https://e.example/a") < text.index("### https://e.example/b\n\n# B\n")
    assert "e.example/c" not in text and "e.example/d" not in text and "Pages in this file: 2" in text
