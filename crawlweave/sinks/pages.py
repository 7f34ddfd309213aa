"""Pages as files and as site digests."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

from crawlweave.operators import ordering
from crawlweave.session import written
from crawlweave.sources import files


def file_name(url: Column, content_type: Column) -> Column:
    """Name a page is saved under: last URL segment plus the extension of its type."""
    mime = F.regexp_extract(F.coalesce(content_type, F.lit("application/octet-stream")), r"^([^;]*)", 1)
    subtype = F.trim(F.regexp_extract(mime, r"^[^/]*/([^/]*)", 1))
    extension = F.concat(F.lit("."), F.when(subtype == "", "octet-stream").otherwise(subtype))
    last = F.regexp_extract(url, r"([^/]*)$", 1)
    named = F.when(F.contains(last, extension), last).otherwise(F.concat(last, extension))
    flat = F.regexp_replace(F.replace(F.regexp_replace(url, r"^(?:https|http)?://", ""), F.lit("/"), F.lit("-")), r"-$", "")
    return F.when(named == extension, F.concat(flat, extension)).otherwise(named)


def plan_page_files(pages: DataFrame, keys: Sequence[str] = ("path", "record_seq"), width: int = 1_000_000) -> DataFrame:
    """Add ``file_name`` and ``collision_rank`` (1 for the first page with that name, in key order).

    ``keys`` identify a page; the last one is an integer. Names are ranked
    without the bodies, and only the later pages of a taken name are joined back.
    """
    named = pages.withColumn("file_name", file_name(F.col("url"), F.col("content_type")))
    bucket = F.struct(*keys[:-1], ordering.id_range(keys[-1], width).alias("range"))
    ranked = ordering.running(named.select(*keys, "file_name"), ["file_name"], list(keys), bucket, rank="collision_rank")
    later = ranked.filter("collision_rank > 1").drop("file_name")
    return named.join(later, list(keys), "left").withColumn("collision_rank", F.coalesce("collision_rank", F.lit(1)).cast("bigint"))


def write_page_files(planned: DataFrame, path: str, content: str = "content") -> None:
    """Write each page from its executor; later pages of a taken name get ``-<rank>`` before the extension.

    Names depend on the rows alone, so a repeated task writes the same files again.
    """
    rank = F.col("collision_rank")
    stem = F.regexp_extract("file_name", r"^(.*?)(\.[^.]*)?$", 1)
    extension = F.regexp_extract("file_name", r"(\.[^.]*)$", 1)
    final = F.when(rank == 1, F.col("file_name")).otherwise(F.concat(stem, F.lit("-"), rank.cast("string"), extension))

    def write(rows: Iterator[Row]) -> None:
        filesystem, local = files.resolve(path)
        filesystem.create_dir(local, recursive=True)
        for row in rows:
            with filesystem.open_output_stream(f"{local}/{row.name}", compression=None) as out:
                out.write(row.body or b"")

    planned.select(final.alias("name"), F.col(content).cast("binary").alias("body")).foreachPartition(write)


def build_llms_txt(pages: DataFrame, site_name: str, description: str, site: str = "site", markdown: str = "content") -> DataFrame:
    """Sections of one llms.txt per site: ``(site, part, url, section)``.

    Part 0 is the header, 1 a page, 2 the footer with the page count. Sections
    stay rows, so no site is ever gathered in one place.
    """
    body = F.regexp_replace(F.col(markdown), r"^\s+|\s+$", "")
    made = pages.filter(F.col("status_code") == 200).select(F.col(site).alias("site"), "url", body.alias("_body"))
    kept = written(made.filter("_body <> ''"), "site-text")  # converted once, for the sections and their number
    key, body = F.col("site"), F.col("_body")
    sections = kept.select(
        key, F.lit(1).alias("part"), "url", F.concat(F.lit("---\n\n### "), F.col("url"), F.lit("\n\n"), body, F.lit("\n")).alias("section")
    )
    counts = kept.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    header = F.concat(
        F.lit(f"# {site_name}\n\n> {description}\n\nText of the pages of "),  # fixed by the format: title, quote, sections
        F.col("site"),
        F.lit("\n\n## Pages\n"),
    )
    footer = F.concat(
        F.lit("---\n\n## Summary\n\nPages in this file: "), F.col("n").cast("string"), F.lit("\nSite: "), F.col("site"), F.lit("\n"),
    )
    ends = counts.select(
        "site",
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("part"), F.lit("").alias("url"), header.alias("section")),
                F.struct(F.lit(2).alias("part"), F.lit("").alias("url"), footer.alias("section")),
            )
        ),
    )
    return sections.unionByName(ends)


def write_llms_txt(sections: DataFrame, path: str) -> None:
    """One folder per site whose part files, read in name order, are the document."""
    (
        sections.repartitionByRange("site", "part", "url")
        .sortWithinPartitions("site", "part", "url")
        .select("site", F.col("section").alias("value"))
        .write.partitionBy("site")
        .text(path)
    )
