"""Exact per-key ordering that never puts a whole key into one task.

A plain ``Window.partitionBy(crawl)`` sorts a crawl in one task; one crawl may
hold a large part of the table. ``ranged`` lays the rows out in ranges of key and
order, whatever the keys or times look like, and carries counts and sums over the
range boundaries. ``running`` does the same for rows whose order column already
gives buckets of bounded size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from crawlweave.session import written

BLOCK_ROWS = 100_000
SLOT_ROWS = 8192  # a power of two


def _offsets(totals: DataFrame, keys: Sequence[str], sums: Mapping[str, str], first: Sequence[str]) -> DataFrame:
    """What each slot of a key has to add: rows and sums of the slots before it, and the key's first values."""
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    key = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a row's place in its slot is the distance to the slot's first row, as the layout numbers rows in order
    return totals.select(
        *keys,
        "_slot",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_begin") + 1).alias("_rank0"),
        *[F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)).alias(f"_o_{name}") for name in sums],
        *[F.first(f"_f_{c}").over(key).alias(f"_f_{c}") for c in first],
    )


def ranged(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rank: str = "rank",
    sums: Mapping[str, str] | None = None,
    first: Mapping[str, str] | None = None,
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """Add ``rank`` (1-based) and running totals per key; ``df`` is read twice, to find the ranges and to lay them out.

    ``sums`` maps new column names to the columns summed up to and including the
    row, ``first`` new names to columns of which the key's first value is wanted.
    No window meets more than ``slot_rows`` rows of a key; one row for each slot
    meets per key. Null keys are a key of their own. Rows that tie in ``order``
    stand as the layout has them.
    """
    if slot_rows & (slot_rows - 1):
        raise ValueError("slot_rows is a power of two")
    sums, first = dict(sums or {}), dict(first or {})
    keyed = df.withColumn("_key", F.struct(*keys))
    sorted_rows = keyed.repartitionByRange("_key", *order).sortWithinPartitions("_key", *order)
    numbered = sorted_rows.withColumn("_at", F.monotonically_increasing_id())
    slot = F.shiftright("_at", slot_rows.bit_length() - 1)
    laid_out = written(numbered, "ranges").withColumn("_slot", slot)
    totals = laid_out.groupBy("_key", "_slot").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_at").alias("_begin"),
        *[F.sum(c).alias(f"_t_{name}") for name, c in sums.items()],
        *[F.min_by(c, "_at").alias(f"_f_{name}") for name, c in first.items()],
    )
    # written, so that their size is known: broadcast where small, else joined by key and slot
    carried = written(_offsets(totals, ["_key"], sums, list(first)), "range-offsets")
    out = laid_out.join(carried, ["_key", "_slot"]).withColumn(rank, F.col("_at") + F.col("_rank0"))
    inside = Window.partitionBy("_key", "_slot").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    for name, c in sums.items():
        out = out.withColumn(name, F.col(f"_o_{name}") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
    for name in first:
        out = out.withColumn(name, F.col(f"_f_{name}"))
    return out.drop("_key", "_at", "_slot", "_rank0", *[f"_o_{name}" for name in sums], *[f"_f_{name}" for name in first])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    bucket: Column,
    rank: str = "rank",
    sums: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``rank`` (1-based) and running totals per key.

    ``bucket`` must be non-decreasing in ``order``; it sets how many rows one
    task sorts. ``sums`` maps new column names to the columns summed up to and
    including the row. Integer columns keep sums exact.
    """
    sums = dict(sums or {})
    slotted = df.withColumn("_key", F.struct(*[F.col(k) for k in keys])).withColumn("_slot", F.struct(bucket.alias("b")))
    totals = slotted.groupBy("_key", "_slot").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{name}") for name, c in sums.items()]
    )
    earlier = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_key",
        "_slot",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        *[F.coalesce(F.sum(f"_t_{name}").over(earlier), F.lit(0)).alias(f"_o_{name}") for name in sums],
    )
    inside = Window.partitionBy("_key", "_slot").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = slotted.join(offsets, ["_key", "_slot"])
    out = out.withColumn(rank, (F.col("_n0") + F.row_number().over(inside)).cast("bigint"))
    for name, c in sums.items():
        out = out.withColumn(name, F.col(f"_o_{name}") + F.coalesce(F.sum(c).over(upto), F.lit(0)))
    return out.drop("_key", "_slot", "_n0", *[f"_o_{name}" for name in sums])


def in_blocks(
    df: DataFrame, rank: str = "rank", before: int = 0, after: int = 0, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Cut ranked rows into blocks and copy the rows a frame needs from the neighbouring blocks.

    Adds ``_block`` and ``_own``; window over ``(key, _block)`` ordered by rank,
    then keep the rows with ``_own``.
    """
    if max(before, after) > block_rows:
        raise ValueError("a frame may not be longer than a block")
    index = F.floor((F.col(rank) - 1) / block_rows)
    position = F.pmod(F.col(rank) - 1, F.lit(block_rows))
    copies = F.array(
        index,
        F.when(position >= block_rows - before, index + 1) if before else F.lit(None).cast("bigint"),
        F.when((position < after) & (index > 0), index - 1) if after else F.lit(None).cast("bigint"),
    )
    return (
        df.withColumn("_home", index)
        .withColumn("_block", F.explode(F.array_compact(copies)))
        .withColumn("_own", F.col("_block") == F.col("_home"))
        .drop("_home")
    )


def id_range(column: str | Column, width: int = 1_000_000) -> Column:
    """Default bucket for rows ordered by an integer."""
    return F.floor((F.col(column) if isinstance(column, str) else column) / width)
