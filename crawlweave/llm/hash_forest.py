"""Nearest vectors by inner product from a forest of sorted hash strings.

Each tree gives a vector a string of bits, the sides of random hyperplanes it lies on, and keeps the strings of a block
of vectors in one sorted array, where all strings with a common prefix stand together. A query descends every tree to
its longest matching prefix; the trees then ascend together, one bit at a time, until their ranges hold enough
candidates, and those are compared exactly. How many are enough is set from the recall on a bounded sample.

Vectors and queries are dealt into blocks of fixed size; each pair of blocks is one piece of work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from crawlweave.llm.shared import hash_share, written

BLOCK = 8192
QUERIES = 1024
TREES = 32
BITS = 32
SAMPLE = 6000
SHARES = (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.65, 0.8, 1.0)


class Forest:
    """Trees over the vectors of one block."""

    def __init__(self, vectors: np.ndarray, norm: float, trees: int = TREES, seed: int = 11):
        """``norm`` is at least the largest length; one more component makes all lengths equal to it, so that the nearest
        by inner product are the nearest by angle."""
        self.vectors = vectors
        self.planes = np.random.default_rng(seed).normal(size=(trees * BITS, vectors.shape[1] + 1))
        rest = np.sqrt(np.maximum(norm * norm - (vectors * vectors).sum(1), 0))
        codes = self._codes(np.column_stack([vectors, rest]))
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def _codes(self, vectors: np.ndarray) -> np.ndarray:
        bits = (vectors @ self.planes.T > 0).reshape(len(vectors), -1, BITS)
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        return np.ascontiguousarray((bits @ weights).T)

    def candidates(self, queries: np.ndarray, least: int) -> Iterator[np.ndarray]:
        """Places of the candidates of each query: those of the longest prefix length at which the trees' ranges hold
        ``least`` entries together, or all vectors."""
        codes = self._codes(np.column_stack([queries, np.zeros(len(queries))]))
        trees, n = codes.shape
        low = np.zeros((BITS + 1, trees, n), np.int64)
        high = np.full((BITS + 1, trees, n), self.sorted.shape[1], np.int64)
        for t in range(trees):
            for length in range(1, BITS + 1):
                shift = BITS - length
                prefix = codes[t] >> shift << shift
                low[length, t] = np.searchsorted(self.sorted[t], prefix)
                high[length, t] = np.searchsorted(self.sorted[t], prefix + (1 << shift))
        found = (high - low).sum(axis=1)
        enough = found >= min(least, trees * self.sorted.shape[1])
        length = BITS - np.argmax(enough[::-1], axis=0)
        for q in range(n):
            seen = np.zeros(self.sorted.shape[1], bool)
            for t in range(trees):
                seen[self.order[t, low[length[q], t, q] : high[length[q], t, q]]] = True
            yield np.flatnonzero(seen)


def nearest_in(forest: Forest, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, share: float) -> pa.Table:
    """(query_id, vec_id, score) of the ``k`` best candidates in a block for each query, its own row left out."""
    out_q, out_v, out_s = [], [], []
    for own, q, places in zip(query_ids, queries, forest.candidates(queries, max(k + 1, int(share * TREES * len(ids))))):
        places = places[ids[places] != own]
        if len(places) > k:  # all that may be among the best, also where many tie at the last place
            found = forest.vectors[places]
            rough = found @ q
            error = 4 * len(q) * np.finfo(float).eps * np.linalg.norm(q) * np.sqrt(np.einsum("ij,ij->i", found, found).max())
            places = places[rough >= np.partition(rough, -k)[-k] - error]
        scores = (forest.vectors[places] * q).sum(axis=1)  # the same sum for equal vectors, wherever they stand
        best = np.lexsort((ids[places], -scores))[:k]
        out_q.append(np.full(len(best), own))
        out_v.append(ids[places][best])
        out_s.append(scores[best])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return pa.table({"query_id": join(out_q, np.int64), "vec_id": join(out_v, np.int64), "score": join(out_s, np.float64)})


def share_for(sample: np.ndarray, norm: float, k: int, recall: float) -> float:
    """The smallest of SHARES whose candidates hold this part of the true nearest of some of the sample's vectors."""
    if len(sample) <= k + 1:
        return 1.0
    forest, queries = Forest(sample, norm), sample[:: max(1, len(sample) // 200)]
    scores = queries @ sample.T
    true = np.argpartition(-scores, k, axis=1)[:, : k + 1]
    for share in SHARES:
        found = [np.isin(t, c).mean() for t, c in zip(true, forest.candidates(queries, int(share * TREES * len(sample))))]
        if np.mean(found) >= recall:
            return share
    return 1.0


def _packed(rows: DataFrame, group: str) -> DataFrame:
    """One row for each group and dimension: ids and vectors as bytes."""

    def pack(table: pa.Table) -> pa.Table:
        vectors = table["v"].combine_chunks().flatten().to_numpy()
        order = np.argsort(table["id"].to_numpy(), kind="stable")
        vectors = vectors.reshape(len(order), -1)[order]
        ids = table["id"].to_numpy()[order]
        return pa.table(
            {
                "dim": pa.array([vectors.shape[1]], pa.int32()), group: pa.array([table[group][0].as_py()], pa.int32()),
                f"{group}_ids": pa.array([ids.tobytes()]), f"{group}_vectors": pa.array([vectors.tobytes()]),
            }
        )

    schema = f"dim int, {group} int, {group}_ids binary, {group}_vectors binary"
    return rows.groupBy("dim", group).applyInArrow(pack, schema)


def nearest(
    df: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, recall: float = 0.94
) -> DataFrame:
    """The ``k`` nearest rows of ``df`` found for each row of ``queries``: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Largest inner product first, computed in double precision on the vectors as they are, ties to the smaller id; a
    query's own id is left out, and all candidates are returned if there are fewer. Vectors that are null, zero, or hold
    a null or non-finite component take no part, nor do rows without an id; vectors are compared with those of their own
    dimension. Of equal vectors only the ``k`` + 1 smallest ids are kept, as no other can be among the nearest.
    ``recall`` is aimed at on a sample of at most SAMPLE vectors; every vector is indexed.
    """

    def usable(rows: DataFrame) -> DataFrame:
        v = F.col(vector).cast("array<double>")
        rows = rows.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
        return rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))

    rows = usable(df).withColumn("dim", F.size("v"))
    wanted = usable(queries).withColumn("dim", F.size("v"))
    same = Window.partitionBy("dim", "_hash", "v").orderBy("id")
    kept = written(
        rows.withColumn("_hash", F.xxhash64("v")).withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1).drop("_n", "_hash"),
        "vectors",
    )
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x))
    sizes = {r.dim: r for r in kept.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("norm")).orderBy("dim").collect()}
    asked = {r.dim: r.n for r in wanted.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    spark = df.sparkSession
    plan = []
    for dim, r in sizes.items():
        if dim in asked:
            part = F.lit((SAMPLE + 6 * SAMPLE**0.5) / r.n)
            sample = kept.where((F.col("dim") == dim) & hash_share(F.xxhash64("id"), part)).orderBy(F.xxhash64("id")).limit(SAMPLE).select("v").toArrow()
            vectors = sample["v"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
            plan.append((dim, -(-r.n // BLOCK), -(-asked[dim] // QUERIES), float(r.norm), share_for(vectors, float(r.norm), k, recall)))
    plans = spark.createDataFrame(plan, "dim int, blocks int, groups int, norm double, share double")
    hashed = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    blocks = _packed(kept.join(plans, "dim").withColumn("block", hashed("blocks")).select("dim", "block", "id", "v"), "block")
    groups = _packed(wanted.join(plans, "dim").withColumn("grp", hashed("groups")).select("dim", "grp", "id", "v"), "grp")
    blocks = blocks.join(plans, "dim").withColumn("grp", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    groups = groups.join(plans.select("dim", "blocks"), "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vectors = np.frombuffer(row["block_vectors"]).reshape(-1, row["dim"])
                forest = Forest(vectors, row["norm"])
                asked = np.frombuffer(row["grp_ids"], np.int64), np.frombuffer(row["grp_vectors"]).reshape(-1, row["dim"])
                yield from nearest_in(forest, np.frombuffer(row["block_ids"], np.int64), *asked, k, row["share"]).to_batches()

    pairs = blocks.join(groups, ["dim", "block", "grp"])
    found = pairs.mapInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
