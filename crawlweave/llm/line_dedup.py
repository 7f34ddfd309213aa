"""Removal of lines that many documents share, decided on hashes alone.

Texts are split and hashed once, into a table of hashes. Line hashes are dealt out by ranges of (hash, document), with
the rows of a range sorted by hash, document and position. A line that very many documents hold therefore spreads over
several ranges; each range passes on one row for each hash and document it has seen first, and these meet as counts.
Back to the documents go compressed bitmaps of the lines to keep, no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crawlweave.llm.shared import SPACES, unused_prefix, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are; plain ASCII takes the faster function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def lines_of(text: str) -> Column:
    """The lines of a text; null or empty is one empty line."""
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_keep_bitmaps(
    df: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """Which lines of each document stay: ``_doc``, ``_text`` (hash of the text) and ``_keep``.

    A line's key is the line without white space at its ends, A-Z in lower case. A key of at least ``min_chars`` code
    points in at least ``min_docs`` documents keeps its lines only in the document with the largest id. ``_keep`` maps
    a word number to 64 bits, bit i of word w standing for line 64 w + i; a word whose lines all stay is left out, and
    so is a document without any other. Rows of one id count as one document; rows without an id are not compared and
    keep all lines.
    """
    line = F.btrim(F.col("_line"), F.lit(SPACES))
    rows = (
        df.select(F.col(doc).alias("_doc"), F.xxhash64(text).alias("_text"), F.posexplode(lines_of(text)).alias("_pos", "_line"))
        .where(F.col("_doc").isNotNull())
        .select("_doc", "_text", "_pos", ascii_lower(line).alias("_key"))
        .where(F.char_length("_key") >= min_chars)
        .select("_doc", "_text", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"))
    )
    rows = written(rows, "line-hashes")
    order = [F.col("_h1"), F.col("_h2"), F.col("_doc").desc()]
    ranged = rows.drop("_text").repartitionByRange(*order).sortWithinPartitions(*order, "_pos")
    first = ranged.groupBy("_h1", "_h2", "_doc").agg(F.min("_pos").alias("_pos"))
    shared = (
        first.groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_doc").alias("_keeper"))
        .where(F.col("_n") >= min_docs)
        .drop("_n")
    )
    dropped = rows.join(shared, ["_h1", "_h2"]).where(F.col("_doc") != F.col("_keeper"))
    bit = F.expr("shiftleft(1L, _pos % 64)")
    words = dropped.groupBy("_doc", "_text", F.expr("_pos div 64").cast("int").alias("_word")).agg(
        F.bitwise_not(F.bit_or(bit)).alias("_bits")
    )
    return words.groupBy("_doc", "_text").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_keep"))


def drop_shared_lines(
    df: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
) -> DataFrame:
    """The rows with the lines that :func:`line_keep_bitmaps` keeps as their text, and the counts of lines before and gone.

    Columns of the counts' names are replaced, all others are kept. A text that loses nothing stays as it is, null
    included; one that loses all its lines becomes empty.
    """
    own = unused_prefix(df)
    lines, left, keep = own + "lines", own + "left", own + "keep"
    bitmaps = line_keep_bitmaps(df, doc, text, min_chars, min_docs).select(
        F.col("_doc").alias(own + "doc"), F.col("_text").alias(own + "text"), F.col("_keep").alias(keep)
    )
    same = (F.col(doc) == F.col(own + "doc")) & (F.xxhash64(F.col(text)) == F.col(own + "text"))
    joined = df.join(bitmaps, same, "left").withColumn(lines, lines_of(text))  # texts travel whole and are split behind the join
    kept = F.expr(f"filter({lines}, (x, i) -> coalesce(getbit({keep}[cast(i div 64 as int)], i % 64) = 1, true))")
    loses = F.col(keep).isNotNull()
    out = joined.withColumn(left, F.when(loses, kept))
    return (
        out.withColumn(text, F.when(loses, F.array_join(left, "\n")).otherwise(F.col(text)))
        .withColumn(n_lines, F.size(lines).cast("long"))
        .withColumn(n_dropped, F.when(loses, F.size(lines) - F.size(left)).otherwise(0).cast("long"))
        .drop(lines, left, keep, own + "doc", own + "text")
    )
