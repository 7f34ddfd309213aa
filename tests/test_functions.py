"""Column functions against independent Python."""

import fnmatch
import hashlib
import hmac
import re
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from crawlweave.functions import errors, html as H, http, patterns, signing, urls
from crawlweave.operators import text as X


@settings(max_examples=300, deadline=None)
@given(st.text("ab-c*?[]!/.\\^", max_size=10), st.text("abc-/.]![\\^", max_size=8))
def test_globs_agree_with_fnmatch(pattern, value):
    # the regex is checked in Python after mapping the two constructs Python spells differently
    regex = patterns.glob_regex(pattern).replace(r"\z", r"\Z").replace(patterns.NO_CHARACTER, r"(?!)")
    regex = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m.group(1), 16))), regex)
    assert bool(re.match(regex, value)) == fnmatch.fnmatchcase(value, pattern)


GLOBS = ["*", "https://e.example/*", "*/p?/[a-c]*", "*[!0-9]", "a[b", "*.html", "x[]]y", "https://e.example/a"]
VALUES = ["https://e.example/a", "https://e.example/p1/b.html", "x]y", "a[b", "9", "z\nz", ""]


def test_globs_in_spark(spark):
    rows = spark.createDataFrame([(v,) for v in VALUES], "v string")
    for glob in GLOBS:
        got = {r[0] for r in rows.filter(patterns.matches_glob(F.col("v"), glob)).collect()}
        assert got == {v for v in VALUES if fnmatch.fnmatchcase(v, glob)}, glob


BASE = "https://lib.example/books/river"


@pytest.mark.parametrize(
    "variant",
    ["https://lib.example/books/shelf/../river", "https://lib.example/./books/./river", "Https://LIB.example:443/books/river", "https://lib.example/books/river/",
     "https://lib.example/books/river#page-3", "https://lib.example/books/river?", "https://lib.example/Books/River", "https://lib.example/books/river?sid=q8"],
)
def test_url_variants_collapse(one, variant):
    assert one(urls.normalize_url(F.col("u"), drop_params=["sid"], fold_path_case=True), u=variant) == BASE


@pytest.mark.parametrize("url", ["https://e.example/a/../../b/./c?z=1&a=2#x", "http://e.example:80", "mailto:x@y", "//odd", "https://e.example/%7Ea/?q"])
def test_normalization_is_idempotent(one, url):
    once = one(urls.normalize_url(F.col("u")), u=url)
    assert one(urls.normalize_url(F.col("u")), u=once) == once


REFS = ["/x", "x", "../x", "./x?y#z", "?q=1", "#f", "", "//o.example/p", "http://o.example", "a/b/../c", "../../../x", "mailto:a@b.c"]


@pytest.mark.parametrize("base", ["https://e.example/a/b/c.html?q=1", "https://e.example", "https://e.example/a/"])
def test_references_resolve_like_urljoin(spark, base):
    rows = spark.createDataFrame([(r,) for r in REFS], "r string").select("r", urls.absolute_url(F.lit(base), F.col("r")).alias("u"))
    for ref, got in rows.collect():
        want = urljoin(base, ref) if ref else base
        assert got == want, (base, ref)


def test_decoded_path(one):
    assert one(urls.decoded_path(F.col("u")), u="https://e.example/caf%C3%A9/a+b?x=%20") == "/café/a+b"
    assert one(urls.decoded_path(F.col("u")), u="https://e.example/100%") == "/100%"


@pytest.mark.parametrize("secret", ["short-one", "x" * 64, "long-" * 40])
def test_hmac(spark, secret):
    body = '{"event":"crawler_finished","é":1}'
    good = hmac.new(secret.encode(), body.encode(), hashlib.sha256).hexdigest().upper()
    rows = spark.createDataFrame([(body, good), (body, good.lower()), (body + " ", good), (body, None)], "raw string, signature string")
    checked = signing.verify_signature(rows, ["other", secret])
    assert [r["verified"] for r in checked.collect()] == [True, False, False, False]
    assert secret not in checked._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    "value, mime, params",
    [("text/html", "text/html", {}), ('Text/HTML; Charset="UTF-8"; x', "text/html", {"charset": "UTF-8"}), (" a/b ;q=1;Q=2", "a/b", {"q": "2"})],
)
def test_content_type(one, value, mime, params):
    got = one(http.parse_content_type(F.col("v")), v=value)
    assert (got["mime"], got["params"]) == (mime, params)


def test_compression(one):
    for data, want in [(b"\x1f\x8b\x08", "gzip"), (b"\x28\xb5\x2f\xfd.", "zstd"), (b"\x78\x9c", "deflate"), (b"\x78\x02", None), (b"\x1f", None), (b"", None)]:
        assert one(http.detect_compression(F.col("c")), c=bytearray(data)) == want


def test_api_timestamp(one):
    assert one(http.api_timestamp(F.col("t")).cast("string"), t="2024-05-06 07:08:09") == "2024-05-06 07:08:09"
    for text in ("2024-05-06T07:08:09", "2024-05-06 07:08:09.5", "2024-13-06 07:08:09", "soon"):
        assert one(http.api_timestamp(F.col("t")), t=text) is None


def test_error_parts_and_message(one):
    assert one(errors.error_resource(F.col("c")), c="ERR::ASP::SHIELD_ERROR") == "ASP"
    assert one(errors.error_resource(F.col("c")), c="ERR::X") is None
    args = [F.col("s"), F.col("c"), F.col("m"), F.col("l")]
    assert one(errors.error_message(*args), s=422, c="ERR::A::B", m="bad", l='{"d": "https://x"}') == "<-- 422 | ERR::A::B - bad. Checkout the related doc: https://x"
    assert one(errors.error_message(*args), s=422, c="ERR::A::B", m="bad", l="[]") == "<-- 422 | ERR::A::B - bad."


PAGE = """<html lang="en"><head><title>A &amp; B</title><meta name="description" content="All of it"><style>p{}</style></head>
<body onload="go()"><nav><a href="/n">Nav</a></nav><script>if (a < b) { track("</p>") }</script><!-- gone --><main><h2>Head <b>bold</b></h2>
<p style="x">One&nbsp;&lt;two&gt; &#233;&#x1F600;&amp;lt;</p><ul><li>first<li><a href='/q' class=k>second</a> <a href="/r?a=1"><em>third</em></a></ul>
<img src="/i.png" alt="pic"><p>unclosed <b>bold<br>line</main><SCRIPT>never closed"""


def test_text(one):
    text = one(H.html_text(H.visible(F.col("h"))), h=PAGE)
    assert "<two> é😀&lt;" in text and "track" not in text and "gone" not in text and "A & B" not in text
    assert re.search(r"<[a-z]", text.replace("<two>", "")) is None and len(text) < len(PAGE)
    assert "Head bold" in text.split("\n")


def test_clean_html(one):
    clean = one(H.clean_html(H.visible(F.col("h"))), h=PAGE)
    assert not re.search(r"(?i)<script|<style|<!--|onload|style=", clean) and "<h2>Head <b>bold</b></h2>" in clean and "<li>first" in clean
    assert "/n" not in clean and "second" not in clean  # navigation, and a block of nothing but links
    assert clean.count("<li>") == PAGE.count("<li>") and clean.count("</ul>") == 1  # whose tags stay


def test_clean_html_drops_what_stands_beside(one):
    page = (
        '<div class="top ad-slot"><p>Buy this</p></div><div class="advice">Good advice</div><div id="cookie">We bake</div><p>See <a href="/x">one</a> of many things here</p>'
        '<p><a href="/y">Only links</a> | <a href="/z">and more links</a></p><p>A sentence without any link.</p><aside>Elsewhere</aside>'
    )
    clean = one(H.clean_html(F.col("h")), h=page)
    assert "Good advice" in clean and "of many things" in clean and "without any link" in clean
    assert not any(words in clean for words in ("We bake", "Only links", "more links", "Elsewhere"))


def test_markdown(one):
    full = one(H.markdown(H.visible(F.col("h"))), h=PAGE)
    assert "## Head **bold**" in full and "- first" in full and "[*third*](/r?a=1)" in full and "![pic](/i.png)" in full and "[Nav](/n)" in full
    bare = one(H.markdown(H.visible(F.col("h"), True), no_images=True, no_links=True), h=PAGE)
    assert "Nav" not in bare and "](" not in bare and "*third*" in bare and "<html" not in bare


def test_unclosed_tags_stay_linear(one):
    page = "<b><a href=\"x\"><script" * 1 + "<b><i><h1><a href=\"y\">" * 20000
    assert one(F.length(H.markdown(H.visible(F.col("h")))), h=page) >= 0


def test_metadata(one):
    meta = one(H.page_metadata(F.col("h")), h=PAGE)
    assert (meta["title"], meta["h1"], meta["lang"], meta["description"], meta["canonical"]) == ("A & B", None, "en", "All of it", None)


def test_typed_values(one):
    found = one(X.prices(F.col("t")), t="from $9.99 to € 1,200 or 5 dollars, $$$")
    assert [tuple(p) for p in found] == [(9.99, "USD"), (1200.0, "EUR")]
    assert one(X.emails(F.col("t")), t="a.b@c.example, x@y, <q+r@s-t.example>. a.b@c.example") == ["a.b@c.example", "q+r@s-t.example"]


def test_formatters_refuse_unknown_names():
    for specs in ([{"name": "shout"}], [{"name": "absolute_url"}], [{"name": "datetime", "args": {"format": "%Q"}}]):
        with pytest.raises(ValueError):
            X.apply_formatters(F.lit(None), specs)
