"""HTML conversion and page metadata as native regular-expression rules.

The rules keep to the subset shared by Java and RE2. Each is one pass over the
text; patterns without nested quantifiers, so none can overflow the stack.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

Rule = tuple[str, str]

# an element that is never closed reaches to the end of the page, as in a browser; this also keeps each rule linear
HIDDEN: list[Rule] = [
    (
        r"<(?is:!--.*?(?:-->|\z)|script\b.*?(?:</script\s*>|\z)|style\b.*?(?:</style\s*>|\z)|noscript\b.*?(?:</noscript\s*>|\z)"
        r"|template\b.*?(?:</template\s*>|\z)|iframe\b.*?(?:</iframe\s*>|\z)|svg\b.*?(?:</svg\s*>|\z))",
        " ",
    ),
]
HEAD: Rule = (r"<(?is:head\b.*?</head\s*>)", " ")
BOILERPLATE: Rule = (
    r"<(?is:nav\b.*?</nav\s*>|header\b.*?</header\s*>|footer\b.*?</footer\s*>|aside\b.*?</aside\s*>|form\b.*?</form\s*>)",
    " ",
)
# words that name an element as something beside the content
ASIDES = "ad|ads|advert|advertisement|banner|breadcrumbs?|cookie|menu|navbar|newsletter|pagination|promo|share|sidebar|social|sponsor(?:ed)?"
BLOCK_START: Rule = (
    r"(<(?i:article|blockquote|dd|div|dl|dt|figure|h[1-6]|li|main|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>)",
    "\x01$1",
)
BLOCK_TAG = r"</?(?i:article|blockquote|body|dd|div|dl|dt|figure|h[1-6]|html|li|main|ol|p|pre|section|table|tbody|td|th|thead|tr|ul)\b[^>]*>"
ANCHOR_TEXT = r"<[Aa]\b[^>]*>([^<]*)"
ATTRIBUTES: list[Rule] = [
    (r"""\s(?i:on[a-z]+|style)\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+)""", ""),
]
BLOCK_TAGS: Rule = (
    r"</?(?i:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|li|main"
    r"|nav|ol|p|pre|section|table|tbody|td|th|thead|tr|ul|title|html|body)\b[^>]*>",
    "\n",
)
ANY_TAG: Rule = (r"<[!/?A-Za-z][^>]*>", "")
OTHER_TAGS: Rule = (r"</?(?:[B-Zb-z]|[Aa][A-Za-z0-9])[^>]*>|<[!?][^>]*>", "")
SPACES: list[Rule] = [
    (r"[ \t\r\f\x0B]+", " "),
    (r" ?\n ?", "\n"),
    (r"\n{3,}", "\n\n"),
]
TEXT_LINES: Rule = (r"\n{2,}", "\n")

IMAGE_ALT_FIRST: Rule = (r"""<(?i:img)\b[^>]*?\b(?i:alt)="([^"]*)"[^>]*?\b(?i:src)="([^"]*)"[^>]*>""", r"![$1]($2)")
IMAGE_SRC_FIRST: Rule = (r"""<(?i:img)\b[^>]*?\b(?i:src)="([^"]*)"[^>]*?\b(?i:alt)="([^"]*)"[^>]*>""", r"![$2]($1)")
IMAGE_BARE: Rule = (r"""<(?i:img)\b[^>]*?\b(?i:src)="([^"]*)"[^>]*>""", r"![]($1)")
# start and end tags are replaced on their own, so an unclosed tag costs nothing
MARKDOWN_MARKS: list[Rule] = [
    (r"<(?i:h1)\b[^>]*>", "\n\n# "),
    (r"<(?i:h2)\b[^>]*>", "\n\n## "),
    (r"<(?i:h3)\b[^>]*>", "\n\n### "),
    (r"<(?i:h4)\b[^>]*>", "\n\n#### "),
    (r"<(?i:h5)\b[^>]*>", "\n\n##### "),
    (r"<(?i:h6)\b[^>]*>", "\n\n###### "),
    (r"</?(?i:b|strong)\s*>", "**"),
    (r"</?(?i:i|em)\s*>", "*"),
    (r"</?(?i:pre)\b[^>]*>", "\n\n```\n"),
    (r"</?(?i:code)\b[^>]*>", "`"),
    (r"<(?i:li)\b[^>]*>", "\n- "),
    (r"<(?i:hr)\b[^>]*>", "\n\n---\n\n"),
    (r"</(?i:h[1-6])\s*>|</?(?i:p|div|section|article|main|ul|ol|table|blockquote|dl|figure)\b[^>]*>", "\n\n"),
    (r"<(?i:br)\b[^>]*>|</?(?i:tr|dt|dd)\b[^>]*>", "\n"),
    (r"</?(?i:td|th)\b[^>]*>", " "),
]
# by now anchors hold text only
LINK: Rule = (r"""<[Aa]\b[^>]*?\b(?i:href)="([^"]*)"[^>]*>([^<]*)</[Aa]\s*>""", r"[$2]($1)")

# fixed values: named character references decoded in text; &amp; must come last
ENTITIES: list[tuple[str, str]] = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&hellip;", "…"),
    ("&mdash;", "—"),
    ("&ndash;", "–"),
    ("&amp;", "&"),
]


def apply_rules(text: Column, rules: Sequence[Rule]) -> Column:
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def code_point(number: Column) -> Column:
    """Character of a Unicode code point."""
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def decode_entities(text: Column) -> Column:
    """Named references and decimal or hexadecimal code points."""
    out = bind(text, decode_numbers)
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


def decode_numbers(text: Column) -> Column:
    decimal = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&#([0-9]{1,7});"), 1))
    hexadecimal = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&#[xX]([0-9a-fA-F]{1,6});"), 1))
    valid = lambda n: n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)

    def put(body: Column, source: Column, number: Column) -> Column:
        return F.when(valid(number), F.replace(body, source, code_point(number))).otherwise(body)

    with_decimal = F.aggregate(
        decimal, text, lambda body, n: put(body, F.concat(F.lit("&#"), n, F.lit(";")), n.cast("bigint"))
    )
    with_both = F.aggregate(
        hexadecimal,
        with_decimal,
        lambda body, n: put(
            put(body, F.concat(F.lit("&#x"), n, F.lit(";")), F.conv(n, 16, 10).cast("bigint")),
            F.concat(F.lit("&#X"), n, F.lit(";")),
            F.conv(n, 16, 10).cast("bigint"),
        ),
    )
    return F.when(F.contains(text, F.lit("&#")), with_both).otherwise(text)


def main_content(html: Column) -> Column:
    """Inside of ``main``, else of ``article``, else the page without navigation."""
    inside = lambda tag: lambda h: F.nullif(F.regexp_extract(h, rf"<(?is:{tag}\b[^>]*>(.*)</{tag}\s*>)", 1), F.lit(""))
    return bind(html, lambda h: F.coalesce(inside("main")(h), inside("article")(h), apply_rules(h, [BOILERPLATE])))


def visible(html: Column, only_content: bool = False) -> Column:
    """HTML without scripts, styles and comments; the common first step of the formats."""
    shown = apply_rules(html, HIDDEN)
    return main_content(shown) if only_content else shown


def clean_html(shown: Column) -> Column:
    """Visible HTML without boilerplate, inline handlers and styles.

    Navigation, headers, footers, asides and forms go whole. The rest is cut into blocks, each from one block tag to the
    next; a block keeps only its tags where its element is named as something beside the content, or where more than
    half of its text is link text.
    """
    marked = apply_rules(shown, [BOILERPLATE, *ATTRIBUTES, BLOCK_START])
    return F.array_join(F.transform(F.split(marked, "\x01"), without_boilerplate), "")


def without_boilerplate(block: Column) -> Column:
    size = lambda c: F.length(apply_rules(c, [ANY_TAG, (r"\s+", "")]))
    linked = size(F.array_join(F.regexp_extract_all(block, F.lit(ANCHOR_TEXT), 1), ""))
    beside = F.rlike(block, F.lit(rf"""^<[^>]*\b(?i:class|id|role)\s*=\s*["'](?:[^"'>]*[\s_-])?(?i:{ASIDES})(?:[\s_-][^"'>]*)?["']"""))
    dense = F.contains(block, F.lit("</a")) & (2 * linked > size(block))
    return F.when(beside | dense, F.array_join(F.regexp_extract_all(block, F.lit(BLOCK_TAG), 0), "")).otherwise(block)


def structured(html: Column, shown: Column) -> Column:
    """JSON of a page: its metadata, headings with their levels, paragraphs, list items, links and images, in page order."""
    every = lambda pattern, group: F.regexp_extract_all(shown, F.lit(pattern), group)
    plain = lambda c: F.trim(apply_rules(decode_entities(apply_rules(c, [ANY_TAG])), [(r"\s+", " ")]))
    some = lambda c: F.filter(F.transform(c, plain), lambda t: t != "")
    heading = r"<(?i:h)([1-6])\b[^>]*>((?s:.*?))</(?i:h)[1-6]\s*>"
    link = r"""<[Aa]\b[^>]*?\b(?i:href)\s*=\s*["']([^"']*)["'][^>]*>([^<]*)"""
    return F.to_json(
        F.struct(
            page_metadata(html).alias("metadata"),
            F.zip_with(every(heading, 1), every(heading, 2), lambda n, t: F.struct(n.cast("int").alias("level"), plain(t).alias("text"))).alias("headings"),
            # a paragraph ends where the next block begins, as its end tag is often left out
            some(every(r"<(?i:p)\b[^>]*>((?s:.*?))(?:</(?i:p|article|section|div|main|body)\s*>|\z|(?=<(?i:p|ul|ol|div|h[1-6]|table|footer)\b))", 1)).alias("paragraphs"),
            some(every(r"<(?i:li)\b[^>]*>((?s:.*?))</(?i:li)\s*>", 1)).alias("items"),
            F.zip_with(every(link, 1), every(link, 2), lambda u, t: F.struct(u.alias("url"), plain(t).alias("text"))).alias("links"),
            every(r"""<(?i:img)\b[^>]*?\b(?i:src)\s*=\s*["']([^"']*)["']""", 1).alias("images"),
        )
    )


def html_text(shown: Column) -> Column:
    """Readable text of visible HTML, one line per block."""
    bare = apply_rules(shown, [HEAD, BLOCK_TAGS, ANY_TAG])
    return trim_lines(apply_rules(decode_entities(bare), SPACES + [TEXT_LINES]))


def markdown_rules(no_images: bool = False, no_links: bool = False) -> list[Rule]:
    images: list[Rule] = [] if no_images else [IMAGE_ALT_FIRST, IMAGE_SRC_FIRST, IMAGE_BARE]
    links: list[Rule] = [] if no_links else [LINK]
    return images + MARKDOWN_MARKS + [OTHER_TAGS] + links + [ANY_TAG]


def markdown(shown: Column, no_images: bool = False, no_links: bool = False) -> Column:
    """Markdown of visible HTML."""
    marked = apply_rules(shown, [HEAD] + markdown_rules(no_images, no_links))
    return trim_lines(apply_rules(decode_entities(marked), SPACES))


def trim_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def meta_tag(html: Column, name: str) -> Column:
    """Content of a meta tag by name or property, attributes in either order."""
    after = F.regexp_extract(
        html, rf"""(?is)<meta\b[^>]*\b(?:name|property)\s*=\s*["']{name}["'][^>]*\bcontent\s*=\s*["']([^"']*)["']""", 1
    )
    before = F.regexp_extract(
        html, rf"""(?is)<meta\b[^>]*\bcontent\s*=\s*["']([^"']*)["'][^>]*\b(?:name|property)\s*=\s*["']{name}["']""", 1
    )
    return F.coalesce(F.nullif(after, F.lit("")), F.nullif(before, F.lit("")))


def page_metadata(html: Column) -> Column:
    """Struct of title, description and the other usual metadata; missing ones are null."""
    blank_null = lambda c: F.nullif(c, F.lit(""))
    inner = lambda tag: blank_null(
        F.trim(decode_entities(apply_rules(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1), [ANY_TAG])))
    )
    return F.struct(
        inner("title").alias("title"),
        inner("h1").alias("h1"),
        blank_null(F.regexp_extract(html, r"""(?is)<html\b[^>]*\blang\s*=\s*["']([^"']*)["']""", 1)).alias("lang"),
        blank_null(F.regexp_extract(html, r"""(?is)<meta\b[^>]*\bcharset\s*=\s*["']?([A-Za-z0-9_\-]+)""", 1)).alias("charset"),
        meta_tag(html, "description").alias("description"),
        meta_tag(html, "keywords").alias("keywords"),
        meta_tag(html, "robots").alias("robots"),
        meta_tag(html, "og:title").alias("og_title"),
        meta_tag(html, "og:image").alias("og_image"),
        blank_null(
            F.regexp_extract(html, r"""(?is)<link\b[^>]*\brel\s*=\s*["']canonical["'][^>]*\bhref\s*=\s*["']([^"']*)["']""", 1)
        ).alias("canonical"),
    )
