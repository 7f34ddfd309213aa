"""Mixing of sources to target sizes: how often each document enters the mix, by pivotal rounding.

A source's target divided by its size is the number of copies that each of its documents should get. The whole part is
taken as it is; the fractional parts are rounded to 0 or 1 in pairs that pass words between two documents until one of
them has an integral number of copies, so a source's words stay at its target up to one document. Blocks of documents
are rounded independently, each hands on at most one unfinished document, and these meet in blocks again, level by
level.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from crawlweave.llm.shared import WORD, unused_prefix, written

BLOCK_ROWS = 4096
CERTAIN = 1e-12


def word_count(text: str | Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, order: Column, rank: str) -> DataFrame:
    """0-based rank in one global order: ranges are numbered inside, and only their row counts meet."""
    parts = written(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_part").orderBy(order)
    return (
        parts.join(offsets, "_part")
        .withColumn(rank, F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_part", "_before")
    )


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``target`` for each row of ``totals`` (``source``, ``source_size``).

    ``weights`` go round in code point order of the sources, null last; ``share`` times all sizes is shared by weight.
    A target stops at ``most`` times its source's size, and what is over is shared by weight among the rest until no
    target is above; each round is one aggregate over the sources.
    """
    order = F.col("source").asc_nulls_last()
    cycle = F.array(*[F.lit(w) for w in weights])
    rows = ranked(totals, order, "_rank").withColumn("_weight", F.get(cycle, (F.col("_rank") % len(weights)).cast("int")))
    rows = written(rows.withColumn("_most", F.col("source_size") * most), "source-weights")
    everything = rows.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        full = F.col("_most") <= F.col("_weight") * level
        held, open_weight, n = rows.agg(
            F.coalesce(F.sum(F.when(full, F.col("_most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0)),
            F.count(F.when(full, 1)),
        ).first()
        if n == stopped or not open_weight:
            break
        level, stopped = max(level, (share * everything - held) / open_weight), n
    return rows.withColumn("target", F.least(F.col("_most"), F.col("_weight") * F.lit(level))).drop("_weight", "_most")


def _settle_equal(sizes: np.ndarray, p: float, draws: np.ndarray) -> np.ndarray:
    """Round documents of one probability, sizes descending: each against all smaller ones as one partner.

    The partner's documents keep a common probability, so large documents become integral while there is still much
    to pass words to, and what is left over in the end is among the smallest.
    """
    out = np.empty(len(sizes))
    rest = float(sizes.sum())
    for k, a in enumerate(sizes.tolist()):
        mass = rest * p
        rest -= a
        if p <= CERTAIN or p >= 1 - CERTAIN or not a or rest <= 0:
            out[k:] = p if a and rest <= 0 else round(p)
            break
        high = min(1.0, mass / a)
        low = max(0.0, mass - rest) / a
        out[k] = high if draws[k] * (high - low) < p - low else low
        p = min(1.0, max(0.0, (mass - a * out[k]) / rest))
    near = np.round(out)
    return np.where(np.abs(out - near) <= CERTAIN, near, out)


def _settle(sizes: np.ndarray, p: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Round in pairs, keeping the sum of size times probability; at most one value stays between 0 and 1."""
    p = p.copy()
    hold = -1
    for j in range(len(p)):
        if p[j] <= CERTAIN or p[j] >= 1 - CERTAIN or not sizes[j]:
            p[j] = round(p[j])
            continue
        if hold < 0:
            hold = j
            continue
        a, b = sizes[hold], sizes[j]
        mass = a * p[hold] + b * p[j]
        high = min(1.0, mass / a)  # all that fits goes to the held document
        low = (mass - b * min(1.0, mass / b)) / a  # or to the other one
        up = draws[j] * (high - low) < p[hold] - low
        p[hold] = high if up else low
        p[j] = (mass - a * p[hold]) / b
        for k in (hold, j):
            if p[k] <= CERTAIN or p[k] >= 1 - CERTAIN:
                p[k] = round(p[k])
        free = [k for k in (hold, j) if 0 < p[k] < 1]
        hold = free[0] if free else -1
    return p


def _rounding(seed: int, level: int) -> Callable[[pa.Table], pa.Table]:
    def settle(group: pa.Table) -> pa.Table:
        size, p = group["size"].to_numpy(), group["_p"].to_numpy()
        order = np.lexsort((group["_hash"].to_numpy(), -size))
        place = [seed, level, group["_rank"][0].as_py(), group["_block"][0].as_py()]
        draws = np.random.Generator(np.random.PCG64(place)).random(len(order))
        out = np.empty(len(order))
        sizes = size[order].astype(float)
        out[order] = _settle(sizes, p[order], draws) if level else _settle_equal(sizes, float(p[0]), draws)
        at = group.schema.get_field_index("_p")
        return group.set_column(at, "_p", pa.array(out)).drop_columns(["_block"])

    return settle


def copies(
    docs: DataFrame, key: list[str], seed: int = 17, block_rows: int = BLOCK_ROWS, **targets: object
) -> DataFrame:
    """How many copies of each row the mix takes.

    ``docs`` has the columns ``key`` (any that tell rows apart), ``source`` and ``size`` (words). Returned with
    ``source_size``, ``target`` (of the source) and ``copies``. Rows without words take part in no pair. The draws
    follow from ``seed``, the source's place and the block, and rows of a block are taken from large to small and then
    by the key's hash, so reruns agree; equal rows are interchangeable.
    """
    hashed = F.xxhash64(F.lit(seed), *key)
    rows = written(docs.select(*key, "source", F.col("size").cast("long").alias("size"), hashed.alias("_hash")), "sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    sources = written(source_targets(totals, **targets), "targets")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    open_rows = (
        rows.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_p", wanted - F.floor(wanted))
        .withColumn("_whole", F.floor(wanted).cast("long"))
        .withColumn("_blocks", F.ceil(F.col("_n") / block_rows).cast("long"))
        .drop("_n")
    )
    blocks = int(sources.agg(F.max(F.ceil(F.col("_n") / block_rows))).first()[0] or 0)
    done: list[DataFrame] = []
    level = 0
    while blocks:
        block = F.pmod(F.xxhash64(F.lit(level), "_hash"), F.greatest("_blocks", F.lit(1)))
        blocked = open_rows.withColumn("_block", block).groupBy("_rank", "_block")
        settled = written(blocked.applyInArrow(_rounding(seed, level), open_rows.schema), "rounded")
        inside = (F.col("_p") > 0) & (F.col("_p") < 1)
        if blocks == 1:
            lucky = F.pmod(F.xxhash64(F.lit(seed), F.lit("last"), "_hash"), F.lit(1_000_003)) < F.col("_p") * 1_000_003
            done.append(settled.withColumn("_p", F.when(inside, lucky.cast("double")).otherwise(F.col("_p"))))
            break
        done.append(settled.where(~inside))
        open_rows = settled.where(inside).withColumn("_blocks", F.ceil(F.col("_blocks") / block_rows).cast("long"))
        blocks = math.ceil(blocks / block_rows)
        level += 1
    out = done[0] if done else open_rows
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(
        *key, "source", "size", "source_size", "target", (F.col("_whole") + F.col("_p").cast("long")).alias("copies")
    )


def mixed(df: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", **options: object) -> DataFrame:
    """The documents of the mix, each as often as :func:`copies` says; columns as in ``df``.

    A row is known by its id, source and text's hash; equal rows share out their copies.
    """
    own = unused_prefix(df)
    identity = [F.col(doc).alias("_doc"), F.xxhash64(text).alias("_text"), F.col(source).alias("source")]
    taken = copies(df.select(*identity, word_count(text).alias("size")), ["_doc", "_text"], **options)
    names = {"_doc": own + "doc", "_text": own + "text", "source": own + "source"}
    taken = taken.groupBy(*[F.col(a).alias(b) for a, b in names.items()]).agg(F.sort_array(F.collect_list("copies")).alias(own + "copies"))
    same = (
        F.col(doc).eqNullSafe(F.col(own + "doc"))
        & F.col(source).eqNullSafe(F.col(own + "source"))
        & (F.xxhash64(F.col(text)) == F.col(own + "text"))
    )
    columns = [F.col(f"`{c}`") for c in df.columns]
    found = own + "copies"

    def repeated(rows: DataFrame, times: Column) -> DataFrame:
        return rows.withColumn(own + "copy", F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*columns)

    # only rows that repeat need a number of their own; the exchange of the texts serves both joins
    single = repeated(df.join(taken.where(F.size(found) == 1), same), F.col(found)[0])
    number = F.row_number().over(Window.partitionBy(*names.values()).orderBy(F.lit(1)))
    several = df.join(taken.where(F.size(found) > 1), same).withColumn(own + "times", F.get(found, number - 1))
    return single.unionByName(repeated(several, F.col(own + "times")))
