"""URL parts, normalization and reference resolution as column expressions.

Parts are cut with the RFC 3986 appendix B expression, which never fails on a
malformed URL, instead of ``parse_url``, which builds a ``java.net.URI`` per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# RFC 3986 appendix B; groups: 2 scheme, 4 authority, 5 path, 7 query, 9 fragment
PARTS = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)"
PATH = r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)"
ORIGIN = r"^([^:/?#]+://[^/?#]*)"


def host(url: Column) -> Column:
    """Lower-case host without user info and port; empty when there is none."""
    return F.lower(F.regexp_extract(url, HOST, 1))


def path(url: Column) -> Column:
    """Path, ``/`` when empty."""
    raw = F.regexp_extract(url, PATH, 1)
    return F.when(raw == "", F.lit("/")).otherwise(raw)


def decoded_path(url: Column) -> Column:
    """Percent-decoded path; ``+`` is kept, an undecodable path stays as it is."""
    raw = path(url)
    decoded = F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(raw, F.lit("%")), F.coalesce(decoded, raw)).otherwise(raw)


def remove_dot_segments(raw_path: Column) -> Column:
    """Resolve ``.`` and ``..``; the rest of the path is untouched."""
    segments = F.split(F.regexp_replace(raw_path, r"^/", ""), "/", -1)
    last = F.element_at(segments, -1)
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, part)),
    )
    tail = F.when(last.isin(".", "..") & (F.size(folded) > 0), F.lit("/")).otherwise(F.lit(""))
    resolved = F.concat(F.lit("/"), F.array_join(folded, "/"), tail)
    return F.when(raw_path.rlike(r"(^|/)\.\.?(/|$)"), resolved).otherwise(raw_path)


def normalize_url(
    url: Column,
    drop_params: Sequence[str] = (),
    fold_path_case: bool = False,
    sort_params: bool = True,
) -> Column:
    """One spelling for URLs that name the same resource.

    Scheme and host are lower-cased, default ports, fragments, dot segments, an
    empty query and a trailing slash are removed, and query parameters are
    sorted. ``drop_params`` removes volatile parameters such as session ids.
    ``fold_path_case`` is lossy and off by default.
    """
    trimmed = F.trim(url)
    scheme = F.lower(F.regexp_extract(trimmed, PARTS, 2))
    authority = F.lower(F.regexp_extract(trimmed, PARTS, 4))
    authority = F.when(scheme == "http", F.regexp_replace(authority, r":80$", "")).when(
        scheme == "https", F.regexp_replace(authority, r":443$", "")
    ).otherwise(authority)
    clean_path = remove_dot_segments(F.regexp_extract(trimmed, PARTS, 5))
    clean_path = F.regexp_replace(clean_path, r"/+$", "")
    clean_path = F.when(clean_path == "", F.lit("/")).otherwise(clean_path)
    if fold_path_case:
        clean_path = F.lower(clean_path)
    query = F.regexp_extract(trimmed, PARTS, 7)
    params = F.filter(F.split(query, "&", -1), lambda p: p != "")
    if drop_params:
        names = F.array(*[F.lit(name) for name in drop_params])
        params = F.filter(params, lambda p: ~F.array_contains(names, F.substring_index(p, "=", 1)))
    if sort_params:
        params = F.array_sort(params)
    clean_query = F.array_join(params, "&")
    suffix = F.when((query == "") | (clean_query == ""), F.lit("")).otherwise(F.concat(F.lit("?"), clean_query))
    absolute = F.concat(scheme, F.lit("://"), authority, clean_path, suffix)
    return F.when((scheme == "") | (authority == ""), trimmed).otherwise(absolute)


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve a reference found on page ``base``."""
    ref = F.trim(href)
    scheme = F.regexp_extract(base, r"^([^:/?#]+):", 1)
    origin = F.regexp_extract(base, ORIGIN, 1)
    base_path = F.regexp_extract(base, PATH, 1)
    directory = F.regexp_replace(base_path, r"[^/]*$", "")
    directory = F.when(directory == "", F.lit("/")).otherwise(directory)
    no_fragment = F.regexp_extract(base, r"^([^#]*)", 1)
    no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    ref_path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    ref_rest = F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    return (
        F.when(ref == "", no_fragment)
        .when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), ref)
        .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
        .when(ref.startswith("#"), F.concat(no_fragment, ref))
        .when(ref.startswith("?"), F.concat(no_query, ref))
        .when(ref.startswith("/"), F.concat(origin, remove_dot_segments(ref_path), ref_rest))
        .otherwise(F.concat(origin, remove_dot_segments(F.concat(directory, ref_path)), ref_rest))
    )
