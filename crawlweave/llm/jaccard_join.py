"""Documents whose sets of word n-grams are alike: a grouped prefix join with components.

Sets that are equal count as one set. An index over all n-grams tells how many sets hold each; taken from rare to
frequent, the first few n-grams of a set (its prefix) must hold one that a similar set has in its prefix too. N-grams
of a single set come first and find nothing, so a set with enough of them is done. The sets that are left are collapsed
into groups of equal prefix and size, pairs of groups that share a prefix n-gram are filtered by size and position, and
their members are verified on the whole sets.

Pairs matter only for what they connect. Sets are first compared with one central set of each n-gram; the rest of the
pairs is made only between sets that are not yet connected, so a large group of near copies never meets pair by pair.

The index travels packed: one row for each batch of documents and bucket of n-grams. With many buckets a set has hardly
more than one n-gram in each, so what stands beside an entry counts: a set is named there by its digest and one byte,
and its size is sent once, to the bucket of the set. N-grams of more than 1/65,536 of
all entries, of which there can be no more than 65,536, stay in their batch instead of meeting in one bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from crawlweave.llm.components import components
from crawlweave.llm.shared import batches, list_array, mix, shuffle_partitions, texts_of, unused_prefix, word_hashes, word_spans, written
from crawlweave.session import Buckets

HOT_LIMIT = 1 << 16
BUCKET_TOKENS = 4_000_000
NGRAM = 5
REST = 4  # bytes of an n-gram beside its bucket
_ODD = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_PACKED = "bucket int, sets array<long>, ns array<int>, counts binary, toks binary, dfs binary"


def ngram_sets(column: pa.Array, words: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """56-bit hashes of the different word n-grams of each text, ascending, and the n+1 offsets of the texts.

    A text with fewer words has its whole sequence as one; without words or text it has none.
    """
    data, at = texts_of(column)
    start, end, first = word_spans(data, at)
    hashes = word_hashes(data, start, end)
    counts = np.diff(first)
    sizes = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(begin[-1]) - begin[:-1][row] + first[:-1][row]
    grams = np.zeros(len(place), np.uint64)
    for k in range(words):
        inside = place + k < first[1:][row]
        grams[inside] += hashes[place[inside] + k] * _ODD[k]
    grams = mix(grams + np.minimum(counts, words)[row].astype(np.uint64) * _ODD[-1]) >> np.uint64(8)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        grams[a:b].sort()
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    kept = np.concatenate([[0], np.cumsum(new)])
    return grams[new], kept[begin]


def set_digests(grams: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    out = []
    for k in (1, 2):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams * _ODD[k] + _ODD[k + 8]))])
        out.append(mix(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64) * _ODD[k + 16]).view(np.int64))
    return out[0], out[1]


def _bytes_of(values: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]


def _values_of(blobs: list[bytes], width: int) -> np.ndarray:
    if width == 4:
        return np.frombuffer(b"".join(blobs), "<u4")
    flat = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, width)
    out = np.zeros((len(flat), 8), np.uint8)
    out[:, :width] = flat
    return out.view("<u8").ravel()


def _slices(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """The bytes of each run of ``values``; ``at`` has the n+1 offsets of the runs."""
    return pa.array([values[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())


def _pack(bucket: np.ndarray, owner: np.ndarray, sets: np.ndarray, toks: np.ndarray, dfs: np.ndarray | None) -> pa.Table:
    """One row for each bucket; entries are (owner, token, df) with owners ascending inside a bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket, owner, toks = bucket[order], owner[order], toks[order]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    new = np.ones(len(bucket), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (bucket[1:] != bucket[:-1])
    at = np.flatnonzero(new)
    many = np.flatnonzero(np.diff(np.append(at, len(bucket))) > 255)
    if len(many):  # a count is one byte: a set with more entries in the bucket is named again
        ends = np.append(at, len(bucket))[many + 1]
        at = np.sort(np.concatenate([at, *(np.arange(a + 255, b, 255) for a, b in zip(at[many], ends))]))
    counts = np.diff(np.append(at, len(bucket))).astype(np.uint8)
    lists = np.append(np.searchsorted(at, cut), len(at))
    rows = np.append(cut, len(bucket))
    return pa.table(
        {
            "bucket": pa.array(bucket[cut], pa.int32()),
            "sets": list_array(sets[owner[at]], lists, pa.int64()),
            "ns": pa.nulls(len(cut), pa.list_(pa.int32())),
            "counts": _slices(counts, lists),
            "toks": _slices(toks, rows),
            "dfs": pa.nulls(len(cut), pa.binary()) if dfs is None else _slices(dfs[order], rows),
        }
    )


def _pack_sizes(bucket: np.ndarray, sets: np.ndarray, ns: np.ndarray) -> pa.Table:
    """One row for each bucket with its sets and their sizes, without entries."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    rows = np.append(cut, len(bucket))
    nothing = pa.array([b""] * len(cut), pa.binary())
    return pa.table(
        {
            "bucket": pa.array(bucket[cut], pa.int32()), "sets": list_array(sets[order], rows, pa.int64()), "ns": list_array(ns[order], rows, pa.int32()),
            "counts": _slices(np.zeros(len(bucket), np.uint8), rows), "toks": nothing, "dfs": nothing,
        }
    )


def _unpack(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unique sets, owner of each entry as index into them, token of each entry)."""
    sets, owner = np.unique(table["sets"].combine_chunks().flatten().to_numpy(), return_inverse=True)
    counts = np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint8)
    return sets, np.repeat(owner.astype(np.uint32), counts), _values_of(table["toks"].to_pylist(), width)


def document_sets(df: DataFrame, doc: str = "doc_id", text: str = "text", words: int = NGRAM) -> DataFrame:
    """(doc_id, row, n, d1, d2) of each row, ``row`` a hash of its text, and rows without a document that carry each batch's
    frequent n-grams."""
    kind = df.schema[doc].dataType.simpleString()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(rows, "_text"):
            grams, offsets = ngram_sets(table["_text"], words)
            d1, d2 = set_digests(grams, offsets)
            n = np.diff(offsets)
            once = np.zeros(len(n), bool)
            once[np.unique(d1, return_index=True)[1]] = True
            seen, times = np.unique(grams[np.repeat(once, n)], return_counts=True)
            often = times >= max(4, int(times.sum()) // HOT_LIMIT)
            nothing = pa.nulls(1)
            yield from pa.table(
                {
                    "doc_id": table["_doc"], "row": table["_row"], "n": pa.array(n, pa.int64()), "d1": pa.array(d1), "d2": pa.array(d2),
                    "toks": pa.nulls(len(n), pa.list_(pa.int64())), "times": pa.nulls(len(n), pa.list_(pa.int64())),
                }
            ).to_batches()
            yield from pa.table(
                {
                    "doc_id": nothing.cast(table["_doc"].type), "row": nothing.cast(pa.int64()), "n": nothing.cast(pa.int64()), "d1": nothing.cast(pa.int64()),
                    "d2": nothing.cast(pa.int64()),
                    "toks": pa.array([seen[often].astype(np.int64)], pa.list_(pa.int64())),
                    "times": pa.array([times[often].astype(np.int64)], pa.list_(pa.int64())),
                }
            ).to_batches()

    schema = f"doc_id {kind}, row long, n long, d1 long, d2 long, toks array<long>, times array<long>"
    return df.select(F.col(doc).alias("_doc"), F.xxhash64(text).alias("_row"), F.col(text).alias("_text")).mapInArrow(run, schema)


def _postings(df: DataFrame, text: str, words: int, buckets: int, hot: dict[int, int]) -> DataFrame:
    """Packed entries: n-grams by their bucket; frequent ones under -1 - (bucket of their set), with their count, as the sizes of
    all sets."""
    hot_toks = np.array(sorted(hot), np.uint64)
    hot_dfs = np.array([min(hot[int(t)], 65535) for t in hot_toks], "<u2")
    number = np.uint64(buckets)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(rows, "_text"):
            grams, offsets = ngram_sets(table["_text"], words)
            d1, _ = set_digests(grams, offsets)
            n = np.diff(offsets)
            once = np.zeros(len(n), bool)
            once[np.unique(d1, return_index=True)[1]] = True
            owner = np.repeat(np.arange(len(n)), n)
            keep = once[owner]
            owner, grams = owner[keep], grams[keep]
            if not len(grams):
                continue
            named = np.flatnonzero(once & (n > 0))
            yield from _pack_sizes(-1 - (d1[named].view(np.uint64) % number).astype(np.int64), d1[named], n[named]).to_batches()
            at = np.searchsorted(hot_toks, grams)
            at[at == len(hot_toks)] = 0
            often = hot_toks[at] == grams if len(hot_toks) else np.zeros(len(grams), bool)
            home = (grams % number).astype(np.uint16 if buckets < 65536 else np.int64)
            rare = ~often
            if rare.any():
                toks = _bytes_of(grams[rare] // number, REST)
                yield from _pack(home[rare].astype(home.dtype), owner[rare], d1, toks, None).to_batches()
            if often.any():
                back = -1 - (d1.view(np.uint64)[owner[often]] % number).astype(np.int64)
                # the same identity as the index gives: the bucket and 32 bits of the rest
                same = (grams[often] // number & np.uint64((1 << 8 * REST) - 1)) * number + grams[often] % number
                yield from _pack(back, owner[often], d1, _bytes_of(same, whole_width(buckets)), hot_dfs[at[often]]).to_batches()

    return df.select(F.col(text).alias("_text")).mapInArrow(run, _PACKED)


def whole_width(buckets: int) -> int:
    """Bytes of an n-gram's identity: its bucket and REST bytes."""
    return REST + -(-(buckets - 1).bit_length() // 8)


def _count_bucket(table: pa.Table, buckets: int) -> pa.Table:
    """Entries of n-grams that at least two sets have, by the bucket of their set."""
    bucket = table["bucket"][0].as_py()
    if bucket < 0:
        at = table.schema.get_field_index("bucket")
        return table.set_column(at, "bucket", pa.array(np.full(len(table), -1 - bucket), pa.int32()))
    sets, owner, toks = _unpack(table, REST)
    key = toks.astype(np.uint64)
    key <<= np.uint64(24)
    key |= owner
    del owner, toks
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    toks = (key >> np.uint64(24)).astype(np.uint32)
    begin = np.flatnonzero(np.concatenate([[True], toks[1:] != toks[:-1]]))
    df = np.diff(np.append(begin, len(toks)))
    df = np.repeat(np.minimum(df, 65535).astype("<u2"), df)
    keep = df > 1
    if not keep.any():
        return table.slice(0, 0)
    key, df = key[keep], df[keep]
    toks, owner = key >> np.uint64(24), (key & np.uint64((1 << 24) - 1)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    toks, owner, df = toks[order] * np.uint64(buckets) + np.uint64(bucket), owner[order], df[order]
    back = (sets.view(np.uint64)[owner] % np.uint64(buckets)).astype(np.int64)
    return _pack(back, owner, sets, _bytes_of(toks, whole_width(buckets)), df)


def _gather_sets(table: pa.Table, percent: int, width: int) -> pa.Table:
    """Sets that may have a partner: shared n-grams from rare to frequent, and how many of them the prefix holds."""
    sets, owner, toks = _unpack(table, width)
    sized = table.filter(table["ns"].is_valid())  # every set is in one of these rows at least
    flat = lambda name: sized[name].combine_chunks().flatten().to_numpy()
    ns = flat("ns")[np.unique(flat("sets"), return_index=True)[1]]
    df = np.frombuffer(b"".join(table["dfs"].to_pylist()), "<u2")
    order = np.lexsort((toks, df, owner))
    toks, owner = toks[order], owner[order]
    new = np.ones(len(toks), bool)
    new[1:] = (toks[1:] != toks[:-1]) | (owner[1:] != owner[:-1])
    toks, owner = toks[new], owner[new]
    shared = np.bincount(owner, minlength=len(sets))
    need = -(-percent * ns.astype(np.int64) // 100)
    prefix = ns - need + 1 - (ns - shared)  # after the n-grams of no other set
    live = prefix > 0
    take = live[owner]
    return pa.table(
        {
            "sid": pa.array(sets[live]), "n": pa.array(ns[live], pa.int32()), "prefix": pa.array(prefix[live], pa.int32()),
            "shared": list_array(toks[take].astype(np.int64), np.concatenate([[0], np.cumsum(shared[live])]), pa.int64()),
        }
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets whose intersection is ``percent`` of their union; n-grams of one set cannot be in it. ``sets`` lie
    in buckets of ``sid``, so that pairs travel to the sets."""
    left = sets.select(F.col("sid").alias("a"), F.col("n").alias("_na"), F.col("shared").alias("_sa"))
    right = sets.select(F.col("sid").alias("b"), F.col("n").alias("_nb"), F.col("shared").alias("_sb"))
    both = F.size(F.array_intersect("_sa", "_sb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", (F.col("_na") + F.col("_nb")).alias("_sum"), both.alias("_both"))
    return joined.where(100 * F.col("_both") >= percent * (F.col("_sum") - F.col("_both"))).select("a", "b")


def set_links(sets: DataFrame, percent: int) -> DataFrame | None:
    """``node`` and ``label`` of sets connected by links; ``sets`` as :func:`_gather_sets` returns them."""
    lead = F.slice("shared", F.lit(1), F.col("prefix"))
    members = written(
        sets.select("sid", "n", "prefix", (F.col("n") - F.size("shared")).alias("own"), lead.alias("toks"))
        .withColumn("gkey", F.xxhash64("n", "toks")),
        "members",
    )
    groups = members.groupBy("gkey").agg(F.first("n").alias("n"), F.first("own").alias("own"), F.first("toks").alias("toks"))
    index = written(
        groups.select("gkey", "n", "own", F.posexplode("toks").alias("pos", "tok"))
        .unionByName(groups.select("gkey", "n", "own", F.lit(None).cast("int").alias("pos"), F.col("gkey").alias("tok"))),
        "prefix-index",
    )
    slim = members.select("sid", "gkey", "n", "own")
    found: DataFrame | None = None
    labels: DataFrame | None = None
    turn = 0
    while True:
        node = slim if labels is None else slim.join(labels.withColumnRenamed("node", "sid"), "sid", "left")
        label = F.col("sid") if labels is None else F.coalesce("label", "sid")
        # the sets of a group that are connected already stand as one class; its most central set speaks for it
        classes = node.withColumn("label", label).groupBy("gkey", "label").agg(
            F.min(F.struct(F.col("own") if not turn else F.xxhash64(F.lit(turn), "sid"), "sid")).alias("head"),
            F.count(F.lit(1)).alias("size"),
        )
        classes = written(classes, "classes")
        entries = index.join(classes, "gkey")
        mixed = entries.groupBy("tok").agg(
            F.min("label").alias("_low"), F.max("label").alias("_high"),
        ).where("_low < _high").select("tok")
        entries = written(entries.join(mixed, "tok", "left_semi"), "entries")
        per_label = entries.groupBy("tok", "label").agg(F.sum("size").alias("size"))
        left = per_label.groupBy("tok").agg((F.sum("size") * F.sum("size") - F.sum(F.col("size") * F.col("size"))).alias("p"))
        pairs_left, rows = left.agg(F.coalesce(F.sum("p"), F.lit(0)), F.count(F.lit(1))).first()
        if not pairs_left:
            return labels
        if turn and (pairs_left <= 64 * rows or 2 * pairs_left > pairs_before):
            break
        pairs_before = pairs_left
        band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)))
        banded = entries.withColumn("band", band)
        centre = banded.groupBy("tok", "band").agg(F.min(F.struct("head", "label")).alias("centre"))
        star = banded.join(centre, ["tok", "band"]).where(F.col("label") != F.col("centre.label"))
        star = star.select(F.col("head.sid").alias("x"), F.col("centre.head.sid").alias("y"))
        if not turn:  # members of a group with its centre
            of_group = classes.groupBy("gkey").agg(F.min("head").alias("centre"))
            star = star.union(classes.join(of_group, "gkey").select("head.sid", "centre.sid"))
        pairs = star.where("x <> y").selectExpr("least(x, y) AS a", "greatest(x, y) AS b").distinct()
        new = written(_verified(pairs, sets, percent), "links")
        found = new if found is None else found.unionByName(new)
        if not new.isEmpty():
            labels = written(components(found), "labels")
        # the next turn looks at n-grams of unconnected sets, but for those whose only two sets have just been compared
        left = entries.select("gkey", "n", "own", "pos", "tok")
        if not turn:
            compared = banded.groupBy("tok").agg(F.count(F.lit(1)).alias("k"), F.min("band").alias("low"), F.max("band").alias("high"))
            left = left.join(compared.where("k = 2 AND low = high").select("tok"), "tok", "left_anti")
        index = written(left.distinct(), "prefix-index")
        turn += 1
    # pairs of components, by n-gram, as far as the sizes and places of their groups allow; then their groups and members
    after = F.coalesce(F.col("n") - F.col("own") - F.col("pos"), F.col("n"))
    bounds = entries.groupBy("tok", "label").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(after).alias("after"))
    side = lambda x: bounds.select("tok", *[F.col(c).alias(c + x) for c in ("label", "low", "high", "after")])
    possible = F.expr(
        f"labela < labelb AND 100 * least(higha, highb) >= {percent} * greatest(lowa, lowb) "
        f"AND {100 + percent} * least(aftera, afterb) >= {percent} * (lowa + lowb)"
    )
    label_pairs = side("a").alias("a").join(side("b").alias("b"), (F.col("a.tok") == F.col("b.tok")) & possible)
    label_pairs = label_pairs.select(F.col("a.tok").alias("tok"), F.col("labela").alias("la"), F.col("labelb").alias("lb"))
    one = entries.select("tok", F.col("label").alias("la"), F.col("gkey").alias("ga"), F.col("n").alias("na"), (F.col("own") + F.col("pos")).alias("pa"))
    two = entries.select("tok", F.col("label").alias("lb"), F.col("gkey").alias("gb"), F.col("n").alias("nb"), (F.col("own") + F.col("pos")).alias("pb"))
    alike = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (
        F.col("pa").isNull() | F.col("pb").isNull() | ((100 + percent) * F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= percent * (F.col("na") + F.col("nb")))
    )
    first = label_pairs.join(one, ["tok", "la"])
    on = (first["tok"] == two["tok"]) & (first["lb"] == two["lb"]) & alike
    group_pairs = first.join(two, on).select("ga", "la", "gb", first["lb"]).distinct()
    of = node.select("gkey", label.alias("label"), "sid")
    member_pairs = (
        group_pairs.join(of.select(F.col("gkey").alias("ga"), F.col("label").alias("la"), F.col("sid").alias("x")), ["ga", "la"])
        .join(of.select(F.col("gkey").alias("gb"), F.col("label").alias("lb"), F.col("sid").alias("y")), ["gb", "lb"])
        .selectExpr("least(x, y) AS a", "greatest(x, y) AS b")
        .distinct()
    )
    more = written(_verified(member_pairs, sets, percent), "links")
    if more.isEmpty():
        return labels
    return components(more if found is None else found.unionByName(more))


def near_duplicates(
    df: DataFrame, doc: str = "doc_id", text: str = "text", words: int = NGRAM, percent: int = 75
) -> DataFrame:
    """One row for each row of ``df``: ``doc_id``, ``n_shingles``, ``component_id``.

    Words are runs of characters other than blank and tab to carriage return, A-Z as a-z. A document's set holds its
    different ``words``-word sequences, or its whole sequence if it is shorter. Documents are linked if 100 times their
    intersection is at least ``percent`` times their union; ``component_id`` is the smallest id that links lead to.
    Documents without words, and rows without an id, are linked with nothing. Other columns are not read.
    """
    return classified(df, doc, text, words, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def classified(df: DataFrame, doc: str = "doc_id", text: str = "text", words: int = NGRAM, percent: int = 75) -> DataFrame:
    """One row for each row of ``df``: ``doc_id``, ``row`` (hash of the text), ``n``, ``component`` (equal for rows that links
    connect, whatever their ids; null for rows without words or an id) and ``component_id``."""
    spark = df.sparkSession
    rows = written(document_sets(df, doc, text, words), "document-sets")
    docs = rows.where(F.col("n").isNotNull()).drop("toks", "times")
    total = docs.agg(F.sum("n")).first()[0] or 0
    often = (
        rows.where(F.col("toks").isNotNull())
        .select(F.explode(F.arrays_zip("toks", "times")).alias("z"))
        .groupBy(F.col("z.toks").alias("tok"))
        .agg(F.sum("z.times").alias("times"))
        .where(F.col("times") >= max(4, -(-total // HOT_LIMIT)))
    )
    hot = {r.tok: r.times for r in often.collect()}  # no more than HOT_LIMIT by the line above
    buckets = max(shuffle_partitions(spark), -(-total // BUCKET_TOKENS))
    packed = _postings(df.where(F.col(doc).isNotNull()), text, words, buckets, hot)
    counted = packed.groupBy("bucket").applyInArrow(lambda t: _count_bucket(t, buckets), _PACKED)
    gathered = counted.groupBy("bucket").applyInArrow(
        lambda t: _gather_sets(t, percent, whole_width(buckets)), "sid long, n int, prefix int, shared array<long>"
    )
    buckets_of_sets = Buckets(spark, "candidate_sets", ["sid"])
    try:
        buckets_of_sets.append(gathered)
        linked = set_links(buckets_of_sets.rows(), percent)
    finally:
        buckets_of_sets.forget()
    distinct = docs.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"))
    own = F.struct("d1", "d2", "n")
    nothing = F.lit(None).cast("long")
    if linked is None:
        named = distinct.withColumn("label", nothing)
    else:
        named = distinct.join(linked.select(F.col("node").alias("d1"), "label"), "d1", "left")
    least = named.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("rep").alias("_least"))
    classes = named.join(least, "label", "left").select(
        "d1", "d2", "n", F.coalesce("_least", "rep").alias("component_id"),
        F.when(F.col("label").isNull(), own).otherwise(F.struct(F.col("label").alias("d1"), nothing.alias("d2"), nothing.alias("n"))).alias("component"),
    )
    return docs.join(classes, ["d1", "d2", "n"], "left").select(
        "doc_id", "row", "n", F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(df: DataFrame, doc: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """One row of each component: that of the smallest id, among rows of one id that of the smallest text hash.

    Decided for each id and text, so rows that share an id but not their text stand for themselves. Of rows equal in id
    and text one stays, also where the text has no words. Rows without an id stay.
    """
    own = unused_prefix(df)
    found = classified(df, doc, text, **options).where(F.col("doc_id").isNotNull())
    linked = found.where(F.col("component").isNotNull()).groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("first")).select("first.*")
    kept = written(linked.unionByName(found.where(F.col("component").isNull()).select("doc_id", "row").distinct()), "kept-rows")
    names = kept.select(F.col("doc_id").alias(own + "doc"), F.col("row").alias(own + "row"))
    copies = Window.partitionBy(doc, own + "text").orderBy(F.lit(0))
    rows = df.where(F.col(doc).isNotNull()).withColumn(own + "text", F.xxhash64(text))
    rows = rows.withColumn(own + "copy", F.row_number().over(copies)).where(F.col(own + "copy") == 1)
    same = (F.col(doc) == F.col(own + "doc")) & (F.col(own + "text") == F.col(own + "row"))
    return rows.join(names, same, "left_semi").select(df.columns).unionByName(df.where(F.col(doc).isNull()))
