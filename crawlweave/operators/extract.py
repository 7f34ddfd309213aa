"""Template extraction.

Only the selection inside a page runs in Python, Arrow-fed. Extractors,
formatters, casts and the assembly of the result are native expressions, and
a template of plain regular expressions is native altogether.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from crawlweave.functions import selectors as S
from crawlweave.operators import text as X

EXTRACTORS = ("price", "links", "images", "emails")
Spec = Mapping[str, Any]


def leaves(specs: list[Spec], path: tuple[int, ...] = ()) -> Iterator[tuple[tuple[int, ...], Spec]]:
    """Selectors without nested ones, with their position in the template."""
    for i, spec in enumerate(specs):
        if spec.get("nested"):
            yield from leaves(spec["nested"], path + (i,))
        else:
            yield path + (i,), spec


def leaf_name(path: tuple[int, ...]) -> str:
    return "leaf_" + "_".join(map(str, path))


def check(specs: list[Spec]) -> None:
    """Raise for anything that could only fail later, in a task."""
    if not specs:
        raise ValueError("a template needs selectors")
    for spec in specs:
        if "name" not in spec or "query" not in spec:
            raise ValueError(f"selector without name or query: {dict(spec)}")
        compile_query(spec)
        if spec.get("extractor") and spec["extractor"]["name"] not in EXTRACTORS:
            raise ValueError(f"unknown extractor {spec['extractor']['name']!r}")
        if spec.get("nested"):
            check(spec["nested"])
        else:
            finish(F.array(F.lit("")), spec, F.lit(""))


def compile_query(spec: Spec):
    """Function from a scope (node or text) to the matches."""
    kind, query, options = spec.get("type", "css"), spec["query"], spec.get("options") or {}
    if kind == "regex":
        find = S.regex(query, options)
        as_text = options.get("content") == "text"
        return lambda scope: find(scope if isinstance(scope, str) else "".join(scope.strings()) if as_text else scope.html())
    if kind not in ("css", "xpath"):
        raise ValueError(f"unsupported selector type {kind!r}")
    run = S.css(query) if kind == "css" else S.xpath(query)
    return lambda scope: run(S.parse_page(scope) if isinstance(scope, str) else scope)


def flat(value) -> str:
    return value if isinstance(value, str) else value.html()


def collect(specs: list[Spec], queries: dict, scope, path: tuple[int, ...], out: dict) -> None:
    """Append the matches below ``scope`` to the list of each leaf."""
    for i, spec in enumerate(specs):
        here = path + (i,)
        found = queries[here](scope)
        if not spec.get("nested"):
            out[here].append([flat(v) for v in found] if spec.get("multiple") else [flat(v) for v in found[:1]])
            continue
        below = {p: [] for p in out if p[: len(here)] == here}
        for hit in found:
            collect(spec["nested"], queries, hit, here, below)
        for p, values in below.items():
            out[p].append(values)


def all_queries(specs: list[Spec], path: tuple[int, ...] = ()) -> dict:
    out = {}
    for i, spec in enumerate(specs):
        out[path + (i,)] = compile_query(spec)
        if spec.get("nested"):
            out.update(all_queries(spec["nested"], path + (i,)))
    return out


def finish(values: Column, spec: Spec, base_url: Column) -> Column:
    """Extractor, formatters and cast of one leaf; first value unless ``multiple``."""
    extractor = (spec.get("extractor") or {}).get("name")
    if extractor == "price":
        values = F.flatten(F.transform(values, lambda v: F.transform(X.prices(v), lambda p: F.to_json(p))))
    elif extractor == "emails":
        values = F.flatten(F.transform(values, lambda v: X.emails(v)))
    elif extractor == "links":
        values = F.flatten(F.transform(values, lambda v: F.regexp_extract_all(v, F.lit(X.ANCHOR), 1)))
    elif extractor == "images":
        values = F.flatten(F.transform(values, lambda v: X.image_urls(v)))
    values = X.apply_formatters(values, spec.get("formatters") or [], base_url)
    if spec.get("cast"):
        values = X.cast_values(values, spec["cast"])
    elif extractor == "price" and not spec.get("formatters"):
        values = F.transform(values, lambda v: F.from_json(v, "amount double, currency string"))
    many = spec.get("multiple") or (extractor in ("links", "images", "emails"))
    return values if many else F.get(values, F.lit(0))


def assemble(specs: list[Spec], row: Mapping[tuple, Column], base_url: Column, path: tuple[int, ...] = ()) -> Column:
    """Struct of the template's names; a nested selector becomes an array of structs, one per match."""
    fields = []
    for i, spec in enumerate(specs):
        here = path + (i,)
        if not spec.get("nested"):
            fields.append(finish(row[here], spec, base_url).alias(spec["name"]))
            continue
        inner = [p for p in row if p[: len(here)] == here]
        objects = F.transform(
            F.sequence(F.lit(0), F.size(row[inner[0]]) - 1),
            lambda i: assemble(spec["nested"], {p: F.get(row[p], i) for p in inner}, base_url, here),
        )
        fields.append(F.when(F.size(row[inner[0]]) > 0, objects).alias(spec["name"]))
    return F.struct(*fields)


def native_regex(specs: list[Spec]) -> bool:
    return all(s.get("type") == "regex" and not s.get("nested") and (s.get("options") or {}).get("content") != "text" for s in specs)


def java_flags(options: Mapping[str, Any]) -> str:
    on = "".join(f for name, f in (("dotall", "s"), ("ignorecase", "i"), ("multiline", "m")) if options.get(name))
    return f"(?{on})" if on else ""


def extract_fields(pages: DataFrame, template: Spec, content: str = "content", url: str = "url") -> DataFrame:
    """Add ``data`` (VARIANT), the template's result for each page.

    The template is checked on the driver; an unsupported selector, formatter
    or cast raises before a job starts.
    """
    if template.get("source", "html") != "html":
        raise ValueError("only html sources are supported")
    specs = list(template["selectors"])
    check(specs)
    others = [f for f in pages.schema.fields if f.name != content]
    if native_regex(specs):
        import re

        row = {}
        for i, spec in enumerate(specs):
            group = 1 if re.compile(spec["query"]).groups else 0
            row[(i,)] = F.regexp_extract_all(content, F.lit(java_flags(spec.get("options") or {}) + spec["query"]), group)
        found = pages
    else:
        paths = [p for p, _ in leaves(specs)]
        fields = list(others)
        for p in paths:
            kind: T.DataType = T.ArrayType(T.StringType())
            for _ in range(len(p) - 1):
                kind = T.ArrayType(kind)
            fields.append(T.StructField(leaf_name(p), kind))
        schema = T.StructType(fields)
        arrow_types = {p: to_arrow_type(schema[leaf_name(p)].dataType) for p in paths}
        names = [f.name for f in others]

        def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            queries = all_queries(specs)
            for batch in batches:
                columns: dict = {p: [] for p in paths}
                for html in batch.column(content):
                    collect(specs, queries, S.parse_page(html.as_py() or ""), (), columns)
                arrays = [batch.column(n) for n in names] + [pa.array(columns[p], type=arrow_types[p]) for p in paths]
                yield pa.RecordBatch.from_arrays(arrays, names=names + [leaf_name(p) for p in paths])

        found = pages.mapInArrow(select, schema)
        row = {p: F.col(leaf_name(p)) for p in paths}
    data = F.parse_json(F.to_json(assemble(specs, row, F.col(url))))
    return found.select(*[f.name for f in others], data.alias("data"))
