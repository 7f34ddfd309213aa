"""Prefix trie of conversations, built as a burst trie.

A conversation is a sequence of turn ids, sequences that occur more than once are one suffix with a weight. Suffixes lie
in containers under trie heads, at first all under the root. A container of more than ``limit`` suffixes is burst by the
next turn id: each distinct next turn becomes a head with a container of its own. What is left is dealt to shards by head,
sorted, and each container is swept in one pass that opens and closes nodes. The totals of containers then go up through
the heads, one burst level at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crawlweave.llm.shared import written

LIMIT = 512
CHUNK = 4096
ROOT = b"\0"
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def turn_lists(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of each conversation as an array of (id, n), in the order of ``turn``, null first.

    Null roles and texts count as empty. Rows of one turn number stand in the order of role, then of the SHA-256 of the
    text; equal rows are turns of their own. Rows without a conversation id are left out. ``id`` is 16 bytes of a hash of
    role and text, ``n`` the code points of the text. A conversation is one row of some 30 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    named = df.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), role.alias("role"),
        F.sha2(text, 256).alias("hash"), F.char_length(text).cast("long").alias("n"),
    )
    number = F.unhex(F.substring(F.sha2(F.concat_ws("\0", F.octet_length("role"), "role", "hash"), 256), 1, 32))
    lists = named.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "hash", number.alias("id"), "n"))).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["n"].alias("n"))).alias("turns"))


def with_shared_heads(lists: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Each conversation c rebuilt: the first h turns of conversation c - c % group, then its own after its first h.

    h is the unsigned crc32 of the decimal id modulo ``most``; a conversation that does not exist lends no turns.
    """
    lent = lists.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_from"), F.slice("turns", 1, most - 1).alias("_lent"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    own = lists.withColumn("_from", F.col("conv_id") - F.col("conv_id") % group).withColumn("_h", h)
    head = F.slice(F.coalesce("_lent", F.slice("turns", 1, 0)), F.lit(1), F.col("_h"))
    rest = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return own.join(lent, "_from", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def _sequence_key() -> Column:
    return F.unhex(F.substring(F.sha2(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), ""), 256), 1, 32))


def ends(members: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the ascending decimal ids of each key's conversations, joined by commas.

    Ranges of (key, id) join their ids to pieces, so that the one task which hashes a key's pieces in turn reads few rows.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            spans = [(a, min(a + CHUNK, b)) for first, b in zip(cuts, cuts[1:]) for a in range(first, b, CHUNK)]
            rows = [(keys[a], ids[a], ",".join(map(str, ids[a:b])).encode()) for a, b in spans]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.binary()))], ["key", "first", "piece"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()):
                if k == key:
                    state.update(b"," + piece)
                else:
                    if state is not None:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(piece)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    ranged = members.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    joined = ranged.mapInArrow(lambda b: pieces(x for x in b if x.num_rows), "key binary, first long, piece binary")
    return joined.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashes, "key binary, ends_sha256 string")


NODE = "head binary, on_top boolean, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, key binary"


def sweep(suffixes: list[tuple[list[bytes], list[int], int, int, bytes]], depth: int, owner: int) -> list[tuple]:
    """Nodes of one sorted container below a head of this depth and smallest member ``owner``.

    A suffix is (turn ids, lengths, smallest member, weight, key). A node is (on_top, depth, conv_id, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, key), its parent known when the parent is closed; the totals of the whole
    container come last, as a row whose ``on_top`` is null.
    """
    out: list[list] = []
    # an open node: smallest member, members, children, leaves, saved, key, length of its text, closed children
    top = [owner, 0, 0, 0, 0, None, 0, []]
    path, open_nodes = [], [top]

    def close() -> None:
        node = open_nodes.pop()
        above = open_nodes[-1]
        node[3] = node[3] or 1
        node[4] += (node[1] - 1) * node[6]
        row = [len(open_nodes) == 1, depth + len(open_nodes), node[0], None, node[1], node[2], node[3], node[4], node[5]]
        for child in node[7]:
            child[3] = node[0]
        out.append(row)
        if above is not top:
            above[0] = min(above[0], node[0])
        for i in (1, 3, 4):
            above[i] += node[i]
        above[2] += 1
        above[7].append(row)

    for ids, lengths, member, weight, key in suffixes:
        same = 0
        while same < min(len(path), len(ids)) and path[same] == ids[same]:
            same += 1
        while len(open_nodes) > same + 1:
            close()
        for n in lengths[same:]:
            open_nodes.append([member, 0, 0, 0, 0, None, n, []])
        path = ids
        last = open_nodes[-1]
        last[0], last[5] = min(last[0], member), key
        last[1] += weight
    while len(open_nodes) > 1:
        close()
    for row in top[7]:
        row[3] = owner
    return [tuple(r) for r in out] + [(None, depth, owner, None, top[1], top[2], top[3], top[4], None)]


def _sweep_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers follow each other in a shard, each at most ``limit`` suffixes."""
    types = [pa.binary(), pa.bool_(), *[pa.int64()] * 7, pa.binary()]
    names = [c.strip().split()[0] for c in NODE.split(",")]

    def nodes(head: bytes, held: list, depth: int, owner: int) -> list[tuple]:
        return [(head, *row) for row in sweep(held, depth, owner)]

    head, depth, owner, held, out = None, 0, 0, [], []
    for batch in batches:
        for row in batch.to_pylist():
            if row["head"] != head:
                if held:
                    out += nodes(head, held, depth, owner)
                head, depth, owner, held = row["head"], row["depth"], row["owner"], []
            held.append((row["ids"], row["lengths"], row["member"], row["weight"], row["key"]))
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
    if held:
        out += nodes(head, held, depth, owner)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def trie(lists: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row for each distinct sequence of first turns of the conversations in ``lists`` (conv_id, turns as
    ``turn_lists`` gives them; ids are unique).

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. The root has depth 0, all conversations as members and no text;
    conversations without turns end there. Without conversations there are no nodes.
    """
    members = written(lists.withColumn("key", _sequence_key()), "trie-members")
    suffixes = members.groupBy("key").agg(F.min("conv_id").alias("member"), F.count(F.lit(1)).alias("weight"), F.first("turns").alias("turns"))
    rows = suffixes.select(
        F.lit(ROOT).alias("head"), F.lit(None).cast("binary").alias("above"), F.lit(0).cast("long").alias("n"), "member", "weight", "key", "turns"
    )
    levels: list[DataFrame] = []  # heads of each burst level
    calm: list[DataFrame] = []  # suffixes in containers that need no bursting
    while True:
        depth = len(levels)
        rows = written(rows, "trie-suffixes")
        ended = F.size("turns") == 0
        heads = rows.groupBy("head").agg(
            F.first("above").alias("above"), F.first("n").alias("n"), F.min("member").alias("conv_id"), F.sum("weight").alias("n_convs"),
            F.count_if(~ended).alias("left"), F.max(F.when(ended, F.col("key"))).alias("key"),
        )
        heads = written(heads.withColumn("depth", F.lit(depth).cast("long")), "trie-heads")
        levels.append(heads)
        placed = rows.where(~ended).join(heads.select("head", "left", F.col("conv_id").alias("owner"), "depth"), "head")
        calm.append(placed.where(F.col("left") <= limit))
        if heads.where(F.col("left") > limit).isEmpty():
            break
        first = F.element_at("turns", 1)
        rows = placed.where(F.col("left") > limit).select(
            F.unhex(F.md5(F.concat("head", first["id"]))).alias("head"), F.col("head").alias("above"), first["n"].alias("n"),
            "member", "weight", "key", F.slice("turns", F.lit(2), F.size("turns")).alias("turns"),
        )
    left = calm[0]
    for more in calm[1:]:
        left = left.unionByName(more)
    shards = left.select(
        "head", "depth", "owner", "member", "weight", "key",
        F.transform("turns", lambda t: t["id"]).alias("ids"), F.transform("turns", lambda t: t["n"]).alias("lengths"),
    )
    swept = written(shards.repartition("head").sortWithinPartitions("head", "ids").mapInArrow(_sweep_shard, NODE), "trie-swept")
    sums = ["n_children", "n_leaves", "saved_tokens"]
    totals = swept.where("on_top IS NULL").select("head", *[F.col(c).alias(f"_{c}") for c in sums])
    found, below = [], None
    for heads in reversed(levels):
        known = totals if below is None else totals.unionByName(below)
        nodes = heads.join(known, "head", "left").select(
            "head", "above", "depth", "conv_id", "n_convs", F.coalesce("_n_children", F.lit(0)).alias("n_children"),
            F.coalesce("_n_leaves", F.lit(1)).alias("n_leaves"),
            (F.coalesce("_saved_tokens", F.lit(0)) + (F.col("n_convs") - 1) * F.col("n")).alias("saved_tokens"), "key",
        )
        nodes = written(nodes, "trie-nodes")
        found.append(nodes)
        below = nodes.where(F.col("above").isNotNull()).groupBy(F.col("above").alias("head")).agg(
            F.count(F.lit(1)).alias("_n_children"), F.sum("n_leaves").alias("_n_leaves"), F.sum("saved_tokens").alias("_saved_tokens")
        )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", *sums, "key"]
    out = swept.where("on_top IS NOT NULL").select(columns)
    for nodes, upper in zip(found, [*levels[:-1][::-1], None]):
        if upper is None:
            named = nodes.withColumn("parent_conv_id", F.lit(None).cast("long"))
        else:
            named = nodes.join(upper.select(F.col("head").alias("above"), F.col("conv_id").alias("parent_conv_id")), "above", "left")
        out = out.unionByName(named.select(columns))
    return out.join(ends(members), "key", "left").select(*columns[:-1], F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256"))
