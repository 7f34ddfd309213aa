"""Prefix trie, exact top products and Merkle manifest, against plain versions."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlweave.llm import merkle, metric_tree, prefix_trie


# --- prefix trie ------------------------------------------------------------------------------


def rebuilt(rows, group=100, most=6):
    """conv_id -> rebuilt turns."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        out[c] = own.get(c - c % group, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {p: [q for q in members if q[: len(p)] == p] for p in members}
    children = {p: [q for q in below[p] if len(q) == len(p) + 1] for p in members}
    saved = {p: (len(m) - 1) * len(p[-1][1]) if p else 0 for p, m in members.items()}
    out = set()
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        out.add(
            (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), sum(not children[q] for q in below[p]),
             sum(saved[q] for q in below[p]), hashlib.sha256(ends.encode()).hexdigest())
        )
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations():
    rng = np.random.default_rng(4)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(205, 215), 7_000_000_000]:
        for t in range(int(rng.integers(1, 9))):
            rows.append((c, t, ["user", "assistant"][t % 2], f"word {rng.integers(0, 3)} é"))
    rows += [(c, t, "user", "the same") for c in range(300, 340) for t in range(4)]  # copies
    rows += [(c, t, "user", "x" * t) for c in range(400, 420) for t in range(c - 399)]  # each goes on from the one before
    rows += [(50, None, None, None), (50, 1, "user", None), (50, 1, "user", ""), (50, 1, "assistant", "b"), (51, 2, None, "a")]
    rows += [(None, 0, "user", "lost"), (52, 0, "user", "long " * 40_000), (52, 0, "user", "long " * 40_000), (-7, 0, "user", "minus")]
    return rows


@pytest.mark.parametrize("limit", [1, 3, 512])
def test_trie_awkward(spark, limit):
    rows = [r for r in conversations() if r[0] is None or r[0] >= 0]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.repartition(3).withColumn("turns", F.lit(1)).withColumn("HEAD", F.lit("x")).withColumn("_from", F.lit(2))
    lists = prefix_trie.turn_lists(frame)
    got = prefix_trie.trie(prefix_trie.with_shared_heads(lists), limit)
    want = rebuilt(rows)
    assert [] in want.values() and got.columns == COLUMNS  # some conversations have no turns left
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == plain_trie(want)


def test_trie_of_lists(spark):
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = rebuilt(rows, group=1, most=1)
    assert {tuple(r) for r in prefix_trie.trie(prefix_trie.turn_lists(frame), 4).collect()} == plain_trie(want)
    nothing = spark.createDataFrame([], frame.schema)
    assert prefix_trie.trie(prefix_trie.with_shared_heads(prefix_trie.turn_lists(nothing))).collect() == []


def test_ends_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    members = spark.range(1000).select(F.when(F.col("id") % 10 == 3, b"b").otherwise(b"a").alias("key"), F.col("id").alias("conv_id"))
    got = {bytes(r.key): r.ends_sha256 for r in prefix_trie.ends(members.repartition(5)).collect()}
    join = lambda keep: hashlib.sha256(",".join(str(i) for i in range(1000) if keep(i)).encode()).hexdigest()
    assert got == {b"b": join(lambda i: i % 10 == 3), b"a": join(lambda i: i % 10 != 3)}


# --- exact top products -----------------------------------------------------------------------


def plain_top(rows, queries, k, scale=1024):
    best = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole = tuple(int(np.floor(scale * x)) for x in v)
            best[i] = min(best.get(i, whole), whole)
    out = {}
    for q in queries:
        if q in best:
            scores = [(-sum(a * b for a, b in zip(best[q], v)), i) for i, v in best.items() if i != q and len(v) == len(best[q])]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return {q: found for q, found in out.items() if found}


def tops(frame, queries, k):
    got = {}
    for r in metric_tree.top_products(frame, queries, k=k).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    return {q: [found[i] for i in range(1, len(found) + 1)] for q, found in got.items()}


def test_top_products_awkward(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=6) * rng.uniform(0.1, 5)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(2000 + i, [float(i % 2), 0.0, 0.0, 0.0, 0.0, 1.0]) for i in range(150)]
    rows += [(3000, [1.0, 2.0]), (3100, [2.0, -1.0]), (3200, [0.0] * 6), (3300, [0.0] * 6), (3400, [5.0])]
    rows += [(4000, None), (4100, [1.0, None] + [0.0] * 4), (4200, [float("nan")] * 6), (4300, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    rows += [(100, [9.0] * 6), (100, [-9.0] * 6), (5, rows[5][1])]  # repeated ids
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    frame = frame.withColumn("dim", F.lit("a")).withColumn("BLOCK", F.lit(1)).withColumn("v", F.lit(2.0))
    want = plain_top(rows, [i for i, _ in rows if i is not None and i % 100 == 0], 7)
    queries = frame.where("vec_id % 100 = 0")
    assert tops(frame, queries, 7) == want
    for name, value in (("BLOCK", 40), ("QUERIES", 2), ("ROUTING", 4), ("PAGE", 5), ("FANOUT", 3), ("DIRECTORY", 2)):
        monkeypatch.setattr(metric_tree, name, value)
    assert tops(frame, queries, 7) == want  # many blocks, deep trees, several pages of the directory
    nothing = spark.createDataFrame([], frame.schema)
    assert tops(nothing, nothing, 3) == tops(frame, nothing, 3) == tops(nothing, queries, 3) == {}


def test_top_products_beyond_doubles(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.integers(-(10**6), 10**6, 3) * 1.0).tolist()) for i in range(0, 900, 20)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = plain_top(rows, [i for i, _ in rows if i % 100 == 0], 4)
    assert max(s for found in want.values() for _, s in found) > 2**53
    assert tops(frame, frame.where("vec_id % 100 = 0"), 4) == want
    huge = spark.createDataFrame([(0, [1e300]), (100, [-1e300]), (1, [1e300])], "vec_id long, embedding array<double>")
    assert tops(huge, huge.where("vec_id = 0"), 4) == {0: [(1, 2**63 - 1), (100, -(2**63))]}


def test_bounds_spare_pages():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 8)) * 3000
    vectors = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8)) * 30).astype(np.int64)
    square = float((vectors.astype(float) ** 2).sum(1).max())
    tree = metric_tree.MTree(np.arange(4000), vectors, square)
    read, kept = [], tree.pages
    tree.pages = type("Pages", (list,), {"__getitem__": lambda self, i: (read.append(i), list.__getitem__(self, i))[1]})(kept)
    for q in range(0, 4000, 400):
        ids, scores = tree.search(vectors[q], q, 10, None)
        exact = vectors @ vectors[q]
        exact[q] = -(2**60)
        best = np.lexsort((np.arange(4000), -exact))[:10]
        assert ids.tolist() == best.tolist() and scores.tolist() == exact[best].tolist()
    assert len(read) < 10 * len(kept) / 2


# --- Merkle manifest --------------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    out = []
    for nodes in levels[:-1]:
        out.append(nodes[i ^ 1] if i ^ 1 < len(nodes) else None)
        i >>= 1
    return out


def plain_leaf(values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_proofs(rows):
    """Sorted (id, leaf, subroot, root, siblings, folded root, verified) of rows (id, group, number, text)."""
    groups = {}
    for row in rows:
        number = row[2] if row[2] is None else row[2] + 1
        odd = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
        groups.setdefault(row[1], []).append((row[0], plain_leaf(row), plain_leaf((*row[:2], number, row[3])) if odd else None))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [plain_tree([x[1] for x in sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for g in order]
    top = plain_tree([t[-1][0] for t in trees])
    out = []
    for place, (g, tree) in enumerate(zip(order, trees)):
        for i, (row_id, leaf, altered) in enumerate(sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            h, siblings = altered or leaf, []
            for at, way in ((i, path(tree, i)), (place, path(top, place))):
                for s in way:
                    h = digest(h) if s is None else digest(s, h) if at & 1 else digest(h, s)
                    siblings += [s] if s else []
                    at >>= 1
            out.append((row_id, leaf, tree[-1][0], top[-1][0], siblings, h, h == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, lang string, n long, text string"


def proven(frame):
    changed = [F.try_add("n", F.lit(1)) if c == "n" else F.col(c) for c in ("doc_id", "lang", "n", "text")]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf_hash(changed))
    rows = merkle.with_proofs(frame, ["doc_id", "lang", "n", "text"], "lang", "doc_id", tampered).collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("level", [1, 2, 10])
def test_proofs_awkward(spark, monkeypatch, level):
    monkeypatch.setattr(merkle, "BLOCK_LEVEL", level)
    rows = [(i, ["de", "en", "ä"][i % 3] if i < 60 else "en", i * 7, f"text {i} é") for i in range(150)]
    rows += [(200, None, None, None), (201, None, 5, ""), (202, "", None, "x" * 300_000), (203, "solo", 1, "a"), (None, "en", 2, "n")]
    rows += [(7, "en", 7, "again"), (7, "en", 7, "again"), (7, "en", 8, "other")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    frame = frame.withColumn("grp", F.lit(1)).withColumn("LEAF", F.lit("x")).withColumn("idx", F.lit(None))
    want = plain_proofs(rows)
    assert proven(frame) == want
    verdicts = {r[6] for r in want}
    assert verdicts == {True, False}


def test_proofs_small(spark):
    assert proven(spark.createDataFrame([], SCHEMA)) == []
    alone = [(3, "en", 1, "only")]
    assert proven(spark.createDataFrame(alone, SCHEMA)) == plain_proofs(alone)


def test_missing_is_the_least(spark):
    sizes = merkle.sizes_up(13)
    known = merkle.levels_of({i: str(i) for i in (4, 5, 6, 7, 12)}, 0, sizes, len(sizes) - 1)
    # 4 to 7 give their own subtree, 12 stands alone up to level 2
    assert merkle.missing([4, 5, 6, 7, 12], known, sizes) == [(2, 0), (2, 2)]
    assert merkle.missing(range(13), merkle.levels_of({i: str(i) for i in range(13)}, 0, sizes, 4), sizes) == []
