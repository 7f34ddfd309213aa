"""Exact search for the largest integer inner products, best first in M-trees.

One more component gives all vectors the same length, so that the largest inner product is the smallest distance, and
distances obey the triangle inequality. Vectors go to the nearest of some routing vectors and there to blocks of bounded
size. A block is an M-tree: pages of at most PAGE entries, each with its distance to the page's own routing vector, inner
entries also with a covering radius. A query first searches a block of its nearest routing vector, which bounds its k-th
score, then every other block whose ball reaches that bound. Inside a block pages are taken in order of their least
possible distance; an entry whose stored distance to the parent rules it out is never computed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from crawlweave.llm.shared import written

BLOCK = 8192
QUERIES = 1024
ROUTING = 64
DIRECTORY = 1024
PAGE = 64
FANOUT = 16
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


class MTree:
    """Pages over the vectors of one block; ``square`` is at least the square of each vector's length.

    ``pages[p]`` is (is a leaf, entries, distances to the page's routing vector, covering radii): entries are places of
    vectors, in an inner page those of routing vectors followed by the child pages.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, square: float, seed: int = 5):
        self.ids, self.vectors, self.square = ids, vectors, square
        rows = vectors.astype(np.float64)
        self.rows = rows
        self._full = np.column_stack([rows, np.sqrt(np.maximum(square - (rows * rows).sum(1), 0))])
        self.pages: list[tuple[bool, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self._random = np.random.default_rng(seed)
        everything = np.arange(len(ids))
        self.root = int(np.argmax(self._full @ self._full.mean(0))) if len(ids) else 0
        to_root = self._distance(self.root, everything)
        self.radius = float(to_root.max())
        self._page(everything, self.root, to_root)
        del self._full

    def _distance(self, a: int, places: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 * (self.square - self._full[places] @ self._full[a]), 0))

    def _page(self, places: np.ndarray, parent: int, to_parent: np.ndarray) -> int:
        number = len(self.pages)
        none = np.zeros(0)
        if len(places) <= PAGE:
            self.pages.append((True, places, to_parent, none, none))
            return number
        self.pages.append((False, places, to_parent, none, none))
        count = min(FANOUT, -(-len(places) // PAGE) * 2)
        pivots = self._random.choice(places, count, replace=False)
        far = np.sqrt(np.maximum(2 * (self.square - self._full[places] @ self._full[pivots].T), 0))
        nearest = far.argmin(1)
        if np.bincount(nearest).max() > 0.9 * len(places):  # nothing to tell them apart: equal parts by distance
            nearest = np.empty(len(places), np.int64)
            nearest[np.argsort(far[:, 0], kind="stable")] = np.arange(len(places)) * count // len(places)
        radii, children, routing = [], [], []
        for c in range(count):
            inside = nearest == c
            if inside.any():
                radii.append(far[inside, c].max())
                routing.append(pivots[c])
                children.append(self._page(places[inside], int(pivots[c]), far[inside, c]))
        routing = np.array(routing)
        self.pages[number] = (False, routing, self._distance(parent, routing), np.array(radii), np.array(children))
        return number

    def search(self, query: np.ndarray, own: int, k: int, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the ``k`` best of other ids than ``own``, of those scoring at least ``least``; equal scores by id."""
        q = query.astype(np.float64)
        q2 = float(q @ q)
        if max(q2, self.square) >= EXACT:  # doubles are not exact: whole numbers of any size, no bounds
            exact = self.vectors.astype(object) @ query.astype(object)
            scores = np.array([max(-LONG - 1, min(LONG, int(s))) for s in exact], np.int64).reshape(-1)
            places = np.flatnonzero((self.ids != own) & (scores >= (-LONG - 1 if least is None else least)))
            best = places[np.lexsort((self.ids[places], -scores[places].astype(object)))[:k]]
            return self.ids[best], scores[best]
        both = q2 + self.square
        margin = 1e-6 * np.sqrt(both) + 1e-9
        reach = np.inf if least is None else np.sqrt(max(both - 2.0 * least, 0)) + margin
        floor = -np.inf if least is None else float(least)
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        to_root = float(np.sqrt(max(both - 2 * (self.rows[self.root] @ q), 0)))
        queue = [(max(to_root - self.radius, 0.0), 0, to_root)]
        while queue:
            nearest, page, to_page = heapq.heappop(queue)
            if nearest > reach:
                break
            leaf, places, to_parent, radii, children = self.pages[page]
            if leaf:
                may = np.abs(to_parent - to_page) <= reach
                at = places[may]
                found = self.rows[at] @ q
                good = (found >= floor) & (self.ids[at] != own)
                if good.any():
                    ids, scores = np.concatenate([ids, self.ids[at[good]]]), np.concatenate([scores, found[good]])
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                    if len(ids) == k:
                        floor = max(floor, scores[-1])
                        reach = np.sqrt(max(both - 2 * floor, 0)) + margin
            else:
                may = np.flatnonzero(np.abs(to_parent - to_page) - radii <= reach)
                to_entry = np.sqrt(np.maximum(both - 2 * (self.rows[places[may]] @ q), 0))
                lower = np.maximum(to_entry - radii[may], 0)
                for bound, child, distance in zip(lower.tolist(), children[may].tolist(), to_entry.tolist()):
                    if bound <= reach:
                        heapq.heappush(queue, (bound, child, distance))
        return ids, scores.astype(np.int64)

    PAGES = "pages array<struct<leaf: boolean, entries: binary, to_parent: binary, radii: binary, children: binary>>"

    def stored(self) -> dict:
        names = "entries", "to_parent", "radii", "children"
        pages = [{"leaf": p[0]} | {n: a.astype(np.int64 if n in ("entries", "children") else np.float64).tobytes() for n, a in zip(names, p[1:])} for p in self.pages]
        return {
            "ids": self.ids.tobytes(), "vectors": self.vectors.tobytes(), "square": self.square,
            "root": self.root, "routing": self.vectors[self.root].tobytes(), "radius": self.radius, "pages": pages,
        }

    @classmethod
    def loaded(cls, row: dict) -> MTree:
        tree = cls.__new__(cls)
        tree.ids = np.frombuffer(row["ids"], np.int64)
        tree.vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(tree.ids), row["dim"])
        tree.rows, tree.square, tree.root, tree.radius = tree.vectors.astype(np.float64), row["square"], row["root"], row["radius"]
        number = lambda page, name, kind: np.frombuffer(page[name], kind)
        tree.pages = [
            (p["leaf"], number(p, "entries", np.int64), number(p, "to_parent", float), number(p, "radii", float), number(p, "children", np.int64))
            for p in row["pages"]
        ]
        return tree


TREE = f"dim int, block long, ids binary, vectors binary, square double, root int, routing binary, radius double, {MTree.PAGES}"
_PAGE_TYPE = pa.struct([("leaf", pa.bool_()), *[(n, pa.binary()) for n in ("entries", "to_parent", "radii", "children")]])
_TREE_TYPE = pa.schema(
    [("dim", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary()), ("square", pa.float64()),
     ("root", pa.int32()), ("routing", pa.binary()), ("radius", pa.float64()), ("pages", pa.list_(_PAGE_TYPE))]
)


def whole_numbers(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component, null where the vector holds a null or non-finite one; held inside long."""
    v = vector.cast("array<double>")
    most = float(1 << 62)
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(v, lambda x: F.floor(F.least(F.lit(most), F.greatest(F.lit(-most), x * float(scale)))).cast("long")))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _cut(counts: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """How many parts of at most about ``limit`` rows each key's rows make."""
    return counts.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("parts"))


def _share(column: str = "id") -> Column:
    return F.pmod(F.xxhash64(column), F.col("parts")).cast("long")


def nearest_routing(rows: DataFrame, routing: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``cluster``, the place of the routing vector of largest cosine; the vectors are at most ROUTING a dimension."""
    units = {d: v / np.maximum(np.linalg.norm(v.astype(float), axis=1, keepdims=True), 1e-300) for d, v in routing.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cluster = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                cluster[at] = (matrix(batch.column("v").take(pa.array(at)), int(dim)).astype(float) @ units[int(dim)].T).argmax(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cluster)], [*batch.schema.names, "cluster"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(assign, f"{kinds}, cluster long")


def index(rows: DataFrame, squares: DataFrame) -> DataFrame:
    """One row for each block: its M-tree as pages. ``rows``: (dim, block, id, v), ``squares``: (dim, square)."""

    def build(table: pa.Table) -> pa.Table:
        dim = table["dim"][0].as_py()
        order = np.argsort(table["id"].to_numpy(), kind="stable")
        tree = MTree(table["id"].to_numpy()[order], matrix(table["v"], dim)[order], table["square"][0].as_py())
        return pa.Table.from_pylist([{"dim": dim, "block": table["block"][0].as_py(), **tree.stored()}], _TREE_TYPE)

    return rows.join(squares, "dim").select("dim", "block", "id", "v", "square").groupBy("dim", "block").applyInArrow(build, TREE)


def _pack(table: pa.Table) -> pa.Table:
    """Queries (id, v, least) of one part as bytes; no bound is the smallest long."""
    dim = table["dim"][0].as_py()
    names = [n for n in table.column_names if n not in ("id", "v", "least")]
    least = table["least"].fill_null(-LONG - 1).to_numpy()
    packed = {n: table[n][:1] for n in names}
    packed |= {"asked": pa.array([table["id"].to_numpy().tobytes()]), "queries": pa.array([matrix(table["v"], dim).tobytes()]), "leasts": pa.array([least.tobytes()])}
    return pa.table(packed)


def _unpacked(row: dict) -> zip:
    asked = np.frombuffer(row["asked"], np.int64)
    least = np.frombuffer(row["leasts"], np.int64)
    return zip(asked.tolist(), np.frombuffer(row["queries"], np.int64).reshape(len(asked), row["dim"]), least.tolist())


def _search(routed: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) of the best of each routed query (dim, block, id, v, least) in its block."""
    parts = routed.join(_cut(routed, ["dim", "block"], QUERIES), ["dim", "block"]).withColumn("part", _share()).drop("parts")
    groups = parts.groupBy("dim", "block", "part").applyInArrow(_pack, "dim int, block long, part long, asked binary, queries binary, leasts binary")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                tree, asked, ids, scores = MTree.loaded(row), [], [], []
                for own, query, least in _unpacked(row):
                    found, score = tree.search(query, own, k, None if least == -LONG - 1 else least)
                    asked.append(np.full(len(found), own))
                    ids.append(found)
                    scores.append(score)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (asked, ids, scores)], ["query_id", "vec_id", "score"])

    return trees.join(groups, ["dim", "block"]).mapInArrow(search, "query_id long, vec_id long, score long")


def _routes(queries: DataFrame, trees: DataFrame) -> DataFrame:
    """(dim, block, id, v, least): for each query (dim, id, v, least, home) all blocks but its home whose ball reaches its
    bound. Packs of queries meet pages of the directory of blocks."""
    entries = trees.select("dim", "block", "routing", "radius", "square")
    pages = entries.join(_cut(entries, ["dim"], DIRECTORY), "dim").groupBy("dim", _share("block").alias("page"), "parts").agg(
        F.collect_list(F.struct("block", "routing", "radius", "square")).alias("balls")
    )
    groups = queries.join(_cut(queries, ["dim"], QUERIES), "dim").withColumn("part", _share()).drop("parts")
    ids = groups.groupBy("dim", "part").agg(F.collect_list(F.struct("id", "v", "least", "home")).alias("queries"))
    ids = ids.join(pages.groupBy("dim").agg(F.first("parts").alias("parts")), "dim")
    ids = ids.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - F.lit(1).cast("long")))).drop("parts")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                dim, balls = row["dim"], row["balls"]
                routing = np.stack([np.frombuffer(b["routing"], np.int64) for b in balls]).astype(float)
                radius, square = np.array([b["radius"] for b in balls]), balls[0]["square"]
                blocks = np.array([b["block"] for b in balls])
                for q in row["queries"]:
                    v = np.array(q["v"], np.int64).astype(float).reshape(dim)
                    both = v @ v + square
                    near = np.ones(len(blocks), bool)
                    if q["least"] is not None and max(v @ v, square) < EXACT:
                        far = np.sqrt(np.maximum(both - 2 * (routing @ v), 0)) - radius
                        near = far <= np.sqrt(max(both - 2.0 * q["least"], 0)) + 2e-6 * np.sqrt(both) + 1e-9
                    to = blocks[near & (blocks != q["home"])]
                    n = len(to)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim] * n, pa.int32()), pa.array(to, pa.int64()), pa.array([q["id"]] * n, pa.int64()),
                         pa.array([q["v"]] * n, pa.list_(pa.int64())), pa.array([q["least"]] * n, pa.int64())],
                        ["dim", "block", "id", "v", "least"],
                    )

    return ids.join(pages.drop("parts"), ["dim", "page"]).mapInArrow(reach, "dim int, block long, id long, v array<long>, least long")


def top_products(
    df: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024
) -> DataFrame:
    """The ``k`` largest integer inner products of ``queries`` with rows of ``df``: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Components count as floor(scale * x). A query's own id is left out; equal scores stand by id; all candidates are
    returned if there are fewer. Vectors that are null or hold a null or non-finite component take no part, nor do rows
    without an id; zero vectors do. Of rows with one id that with the smallest vector counts; vectors are compared with
    those of their own dimension. Of equal vectors the ``k`` + 1 smallest ids are searched, as no other can be among the
    best. Sums beyond long are held at its ends, whole numbers beyond 2**53 are compared without bounds.
    """

    def usable(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col(vec_id).cast("long").alias("id"), whole_numbers(F.col(vector), scale).alias("v"))
        rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).groupBy("id").agg(F.min("v").alias("v"))
        return rows.select(F.size("v").alias("dim"), "id", "v")

    equal = Window.partitionBy("dim", "_hash", "v").orderBy("id")
    rows = usable(df).withColumn("_hash", F.xxhash64("v")).withColumn("_n", F.row_number().over(equal))
    rows = written(rows.where(F.col("_n") <= k + 1).drop("_n", "_hash"), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("square"))
    squares = written(sizes, "vector-sizes")
    spread = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30))
    sample = rows.join(squares, "dim").where(spread < F.lit(float(ROUTING << 30)) / F.col("n")).select("dim", "v")
    chosen: dict[int, list] = {}
    for r in sample.collect():
        chosen.setdefault(r.dim, []).append(r.v)
    routing = {r.dim: np.array(chosen.get(r.dim, [[1] * r.dim]), np.int64).reshape(-1, r.dim) for r in squares.select("dim").collect()}
    placed = written(nearest_routing(rows, routing), "vectors-routed")
    parts = written(_cut(placed, ["dim", "cluster"], BLOCK), "vector-parts")
    blocks = placed.join(parts, ["dim", "cluster"]).withColumn("block", F.shiftleft("cluster", 32) + _share())
    trees = written(index(blocks.select("dim", "block", "id", "v"), squares), "metric-trees")

    asked = usable(queries).join(squares.select("dim"), "dim").select("dim", "id", "v")  # dimensions without rows have no candidates
    home = F.shiftleft(F.coalesce("cluster", F.lit(0).cast("long")), 32)
    at_home = nearest_routing(asked, routing).join(parts, ["dim", "cluster"], "left").withColumn("home", home + F.coalesce(_share(), F.lit(0)))
    at_home = written(at_home.select("dim", "id", "v", "home"), "queries-home")
    first = written(_search(at_home.select("dim", F.col("home").alias("block"), "id", "v", F.lit(None).cast("long").alias("least")), trees, k), "found-home")
    bounds = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
    routed = written(_routes(at_home.join(bounds, "id", "left"), trees), "queries-routed")
    found = first.unionByName(_search(routed, trees, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
