"""Merkle manifest of a dataset, with all proofs by octopus multiproofs.

Rows are leaves of one tree for each group, the groups' roots are leaves of the tree on top. Leaves lie in blocks of
``2 ** BLOCK_LEVEL`` consecutive ones. Block roots are reduced in the same way until one node is left, so no task holds
more than a block. To prove all its leaves a block works out which nodes it cannot derive from its own, the union over all
of its proofs, fetches those once by a join, and folds each proof on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from crawlweave.llm.shared import written

BLOCK_LEVEL = 10
LOWER, TOP = 0, 1  # kinds of trees: over the leaves of a group, over the roots of the groups


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_hash(columns: Sequence[Column]) -> Column:
    """SHA-256 in hex of the values, each ``-`` if null, else its byte count, a colon and the value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def sizes_up(n: int) -> list[int]:
    """Numbers of nodes of a tree's levels, from its ``n`` leaves to its root."""
    out = [n]
    while out[-1] > 1:
        out.append((out[-1] + 1) // 2)
    return out


def levels_of(nodes: dict[int, str], level: int, sizes: Sequence[int], upto: int) -> list[dict[int, str]]:
    """What can be derived from nodes of one level, level by level: a node whose two children, or only child, are known."""
    out = [nodes]
    for below in sizes[level:upto]:
        now = {}
        for i in {k >> 1 for k in out[-1]}:
            left, right = out[-1].get(2 * i), out[-1].get(2 * i + 1)
            if left is not None and (right is not None or 2 * i + 1 >= below):
                now[i] = digest(left, right) if right is not None else digest(left)
        out.append(now)
    return out


def missing(wanted: Sequence[int], known: Sequence[dict[int, str]], sizes: Sequence[int]) -> list[tuple[int, int]]:
    """(level, index) of the siblings on the ways of the wanted leaves to the root that cannot be derived: the union over
    all ways, each once."""
    out, on_way = [], set(wanted)
    for level, size in enumerate(sizes[:-1]):
        have = known[level] if level < len(known) else {}
        beside = {i ^ 1 for i in on_way if i ^ 1 < size} - on_way
        out += sorted((level, i) for i in beside if i not in have)
        on_way = {i >> 1 for i in on_way}
    return out


def fold(leaf: str, index: int, siblings: Sequence[str | None]) -> str:
    """The root that a leaf and its siblings give; null where a level has none."""
    for sibling in siblings:
        pair = (leaf,) if sibling is None else (sibling, leaf) if index & 1 else (leaf, sibling)
        leaf, index = digest(*pair), index >> 1
    return leaf


def group_key(group: Column) -> Column:
    """A string that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time, as a row here is a whole block."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _indexed(leaves: DataFrame) -> DataFrame:
    """Adds ``idx``, the place in the group by id, null first, and hash, and ``n``, the group's size.

    Ranges of (group, id) are counted and numbered, so that no task holds a whole group.
    """
    ranged = leaves.repartitionByRange("grp", "id", "leaf").sortWithinPartitions("grp", "id", "leaf")
    placed = written(ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "merkle-ordered")
    runs = placed.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")
    runs = runs.select("grp", "part", shift.alias("shift"), F.sum("rows").over(group).alias("n"))
    return placed.join(runs, ["grp", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _packed(entries: DataFrame, *columns: str) -> DataFrame:
    """One row for each block of consecutive entries (grp, n, idx, columns), in order."""
    rows = F.sort_array(F.collect_list(F.struct("idx", *columns)))
    packed = entries.groupBy("grp", F.shiftright("idx", BLOCK_LEVEL).alias("block")).agg(F.first("n").alias("n"), rows.alias("rows"))
    return packed.select("grp", "block", "n", *[F.col(f"rows.{c}").alias(c) for c in columns])


NODES = "kind int, grp string, n long, level int, idx long, digest string"


def _reduced(blocks: DataFrame, kind: int, base: int) -> DataFrame:
    """Nodes that each block of entries on level ``base`` gives. Of a group's leaves only the block's root leaves the block,
    as it can derive what is below by itself; the tree on top is kept whole."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string()
        for row in each_row(batches):
            sizes, first = sizes_up(row["n"]), row["block"] << BLOCK_LEVEL
            entries = {first + i: h for i, h in enumerate(row["digest"])}
            known = levels_of(entries, base, sizes, min(base + BLOCK_LEVEL, len(sizes) - 1))
            kept = range(len(known)) if kind == TOP and not base else range(1, len(known)) if base else [len(known) - 1]
            out = [(kind, row["grp"], row["n"], base + k, i, h) for k in kept for i, h in known[k].items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], NODES.split()[::2])

    return blocks.select("grp", "block", "n", "digest").mapInArrow(up, NODES)


def _tree(blocks: DataFrame, kind: int) -> DataFrame:
    """Nodes of all trees of a kind, ``BLOCK_LEVEL`` levels in each round until every tree has its root."""
    nodes = written(_reduced(blocks, kind, 0), "merkle-nodes")
    found, base = nodes, BLOCK_LEVEL
    while True:
        open_ones = nodes.where((F.col("level") == base) & (F.col("n") > 1 << base))
        if open_ones.isEmpty():
            return found
        nodes = written(_reduced(_packed(open_ones, "digest"), kind, base), "merkle-nodes")
        found, base = found.unionByName(nodes), base + BLOCK_LEVEL


def _roots(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("level") == F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0))


def manifest(leaves: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(blocks, trees, nodes) of leaves (id, grp, leaf, altered), ``grp`` a ``group_key``.

    ``blocks`` holds the leaves in order, by id, null first, then hash; ``trees`` has a row for each group: ``subroot``, its
    ``place`` among the ``groups``, and the dataset's ``root``; ``nodes`` has the nodes of all trees from block roots up and
    the whole tree on top.
    """
    blocks = written(_packed(_indexed(leaves), "id", "leaf", "altered"), "merkle-blocks")
    lower = _tree(blocks.withColumnRenamed("leaf", "digest"), LOWER)
    groups = written(_indexed(_roots(lower).select(F.lit("").alias("grp"), F.col("grp").alias("id"), F.col("digest").alias("leaf"))), "merkle-groups")
    upper = _tree(_packed(groups.withColumnRenamed("leaf", "digest"), "digest"), TOP)
    top = _roots(upper).select("n", "digest").head()
    count, root = (top.n, top.digest) if top else (0, None)
    trees = groups.select(F.col("id").alias("grp"), F.col("leaf").alias("subroot"), F.col("idx").alias("place"), F.lit(count).alias("groups"), F.lit(root).alias("root"))
    return blocks, trees, lower.unionByName(upper)


def _heights(row: dict) -> tuple[list[int], list[int], dict[int, str], list[dict[int, str]]]:
    sizes, first = sizes_up(row["n"]), row["block"] << BLOCK_LEVEL
    leaves = {first + i: h for i, h in enumerate(row["leaf"])}
    return sizes, sizes_up(row["groups"]), leaves, levels_of(leaves, 0, sizes, min(BLOCK_LEVEL, len(sizes) - 1))


def _wanted_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a block has to fetch for the proofs of all its leaves."""
    types = pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int64()
    for row in each_row(batches):
        sizes, top, leaves, known = _heights(row)
        own = [(LOWER, row["grp"], *at) for at in missing(leaves, known, sizes)]
        asked = own + [(TOP, "", *at) for at in missing([row["place"]], [], top)]
        if asked:
            out = [(row["grp"], row["block"], *a) for a in asked]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["for_grp", "for_block", "kind", "grp", "level", "idx"])


PROOFS = "id long, leaf string, subroot string, root string, siblings array<string>, folded_root string, verified boolean"


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The proof of each leaf of a block, from what it derives and what it fetched."""
    types = pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.bool_()
    for row in each_row(batches):
        sizes, top, leaves, known = _heights(row)
        known += [{} for _ in range(len(sizes) - len(known))]
        above = {}
        for node in row["fetched"] or []:
            (known[node["level"]] if node["kind"] == LOWER else above.setdefault(node["level"], {}))[node["idx"]] = node["digest"]
        on_top = [above[level].get((row["place"] >> level) ^ 1) if level in above else None for level in range(len(top) - 1)]
        out = []
        for (index, leaf), row_id, altered in zip(leaves.items(), row["id"], row["altered"]):
            below = [known[level].get((index >> level) ^ 1) for level in range(len(sizes) - 1)]
            subroot = fold(altered or leaf, index, below)
            folded = fold(subroot, row["place"], on_top)
            proof = [s for s in (*below, *on_top) if s is not None]
            out.append((row_id, leaf, row["subroot"], row["root"], proof, folded, folded == row["root"]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [c.split()[0] for c in PROOFS.split(", ")])


def proofs(blocks: DataFrame, trees: DataFrame, nodes: DataFrame) -> DataFrame:
    """For each leaf ``id``, ``leaf``, ``subroot``, ``root``, ``siblings`` (from leaf to root, levels without one left out),
    ``folded_root`` (from the altered leaf where there is one) and ``verified``, whether that is the root."""
    placed = written(blocks.join(trees, "grp"), "merkle-placed")
    asked = placed.select("grp", "block", "n", "leaf", "place", "groups").mapInArrow(
        _wanted_nodes, "for_grp string, for_block long, kind int, grp string, level int, idx long"
    )
    found = asked.join(nodes.select("kind", "grp", "level", "idx", "digest"), ["kind", "grp", "level", "idx"])
    fetched = found.groupBy(F.col("for_grp").alias("grp"), F.col("for_block").alias("block")).agg(
        F.collect_list(F.struct("kind", "level", "idx", "digest")).alias("fetched")
    )
    return placed.join(fetched, ["grp", "block"], "left").mapInArrow(_expanded, PROOFS)


def with_proofs(df: DataFrame, columns: Sequence[str], group: str, row_id: str, tampered: Column | None = None) -> DataFrame:
    """``proofs`` of all rows of ``df``: a leaf hashes ``columns``, leaves of equal ``group`` form a tree.

    ``tampered`` is the hash of a changed row, null where the row is as it was. Repeated rows are leaves of their own,
    null ids come first, null values, groups and ids are kept apart from empty ones; without rows there is no proof.
    """
    altered = F.lit(None).cast("string") if tampered is None else tampered
    leaves = df.select(
        F.col(row_id).cast("long").alias("id"), group_key(F.col(group)).alias("grp"), leaf_hash([F.col(c) for c in columns]).alias("leaf"), altered.alias("altered")
    )
    return proofs(*manifest(written(leaves, "merkle-leaves")))
