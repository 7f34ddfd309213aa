"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from crawlweave.llm import (
    bpe,
    hash_forest,
    jaccard_join,
    language_id,
    line_dedup,
    lm_score,
    merkle,
    metric_tree,
    mixing,
    prefix_trie,
    quality,
    token_files,
    warc_salvage,
)
from crawlweave.session import fresh_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

#: unsigned crc32 of the decimal text of a column, bit by bit
SQL_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), CAST(range(8) AS BIGINT[])),
                               lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, TOKENIZER)
    back = bpe.decode(coded.drop("text"), TOKENIZER)
    return back.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, TOKENIZER)
    sums = token_files.with_checksum(token_files.read_parts(spark, path))  # before the join, which then moves no ids
    return token_files.with_starts(sums, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_shared_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLES["op4_line_dedup"] = """
    WITH split AS (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS lines FROM documents),
    lines AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split),
    keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines),
    shared AS (
        SELECT key, MAX(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 3),
    marked AS (
        SELECT doc_id, line, pos, keeper IS NOT NULL AND doc_id <> keeper AS gone
        FROM keyed LEFT JOIN shared USING (key))
    SELECT doc_id, COUNT(*) AS n_lines, CAST(SUM(CAST(gone AS BIGINT)) AS BIGINT) AS n_dropped,
           sha256(COALESCE(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id"""


@query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = docs.select("doc_id", "source", mixing.word_count("text").alias("size"))
    taken = mixing.copies(sizes, ["doc_id"])
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op1_jaccard_join"] = r"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    places AS (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM texts WHERE len(w) > 0),
    shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 5], ' ') AS s FROM places),
    sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS n FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    pairs AS (
        SELECT a, b FROM shared JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
        WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
    links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
    reach AS (SELECT doc_id, doc_id AS label FROM sizes UNION SELECT l.b, r.label FROM reach AS r JOIN links AS l ON l.a = r.doc_id WHERE r.label < l.b)
    SELECT t.doc_id, COALESCE(MAX(z.n), 0) AS n_shingles, COALESCE(MIN(r.label), t.doc_id) AS component_id
    FROM texts AS t LEFT JOIN sizes AS z ON z.doc_id = t.doc_id LEFT JOIN reach AS r ON r.doc_id = t.doc_id GROUP BY t.doc_id"""


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.with_quality(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", "score")


@query
def op3_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc_salvage.write_archives(table(spark, sf_dir, "pages"))
    records = warc_salvage.read_archives(files, payload=False).where(F.col("reason").isNull())
    return records.select(
        warc_salvage.row_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc_salvage.row_id("refers_to").alias("refers_to"),
    )


ORACLES["op3_warc_salvage"] = """
    WITH payloads AS (SELECT page_id, COALESCE(html, '') AS html FROM pages),
    digests AS (SELECT *, CAST(CAST(unhex(sha1(html)) AS BIT) AS VARCHAR) AS bits, MIN(page_id) OVER (PARTITION BY html) AS first FROM payloads)
    SELECT page_id, strlen(html) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
               CAST(1 + list_sum(list_transform(range(5), lambda k: CAST(substr(bits, CAST(5 * i + k + 1 AS BIGINT), 1) AS INT) << CAST(4 - k AS INT))) AS BIGINT)]), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
    FROM digests"""


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    named = language_id.with_language(docs)
    return named.select("doc_id", language_id.held_out("doc_id", 5).alias("held_out"), "lang_pred", "score")


@query
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_score.with_scores(table(spark, sf_dir, "documents"))
    counts = ["n_tokens", "n_known", "train_tokens"]
    return scored.select("doc_id", language_id.held_out("doc_id", 10).alias("held_out"), *counts, "base_score", "score")


@query
def op2_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return hash_forest.nearest(rows, rows.where("vec_id % 20 = 0"))


@query
def op11_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.turn_lists(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_shared_heads(own))


ORACLES["op11_burst_trie"] = f"""
    WITH ordered AS (
        SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), sha256(COALESCE(text, ''))) - 1 AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (SELECT conv_id, {SQL_CRC32.format("conv_id")} % 6 AS h FROM ordered GROUP BY conv_id),
    turns AS (
        SELECT c.conv_id, o.pos AS place, o.role, o.text FROM convs AS c JOIN ordered AS o ON o.conv_id = c.conv_id - c.conv_id % 100 AND o.pos < c.h
        UNION ALL SELECT c.conv_id, 10 + o.pos, o.role, o.text FROM convs AS c JOIN ordered AS o ON o.conv_id = c.conv_id AND o.pos >= c.h),
    rebuilt AS (
        SELECT conv_id, COALESCE(list({{'id': sha256(strlen(role) || ':' || role || text), 'n': length(text)}} ORDER BY place) FILTER (WHERE place IS NOT NULL), []) AS turns
        FROM convs LEFT JOIN turns USING (conv_id) GROUP BY conv_id),
    prefixes AS (SELECT conv_id, len(turns) AS size, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt),
    nodes AS (
        SELECT turns[1:depth] AS path, depth, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs,
               (COUNT(*) - 1) * COALESCE(MAX(turns[depth].n), 0) AS saved,
               sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256
        FROM prefixes GROUP BY turns[1:depth], depth),
    children AS (SELECT path[1:depth - 1] AS path, COUNT(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
    counted AS (SELECT nodes.*, COALESCE(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
    above AS (SELECT path[1:up] AS path, n_children, saved FROM (SELECT *, unnest(range(depth + 1)) AS up FROM counted) AS u),
    totals AS (SELECT path, SUM(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, SUM(saved) AS saved_tokens FROM above GROUP BY path)
    SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
           CAST(t.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
    FROM counted AS c JOIN totals AS t ON t.path = c.path LEFT JOIN nodes AS p ON c.depth > 0 AND p.path = c.path[1:c.depth - 1]"""


@query
def op13_octopus_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    changed = [F.try_add("n_chars", F.lit(1)) if c == "n_chars" else F.col(c) for c in docs.columns]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf_hash(changed))
    proven = merkle.with_proofs(docs, docs.columns, "lang", "doc_id", tampered)
    proof = F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256")
    return proven.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof, "folded_root", "verified")


@query
def op12_metric_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return metric_tree.top_products(rows, rows.where("vec_id % 100 = 0"))


ORACLES["op12_metric_tree"] = """
    WITH usable AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    components AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM usable),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(SUM(q.x * c.x) AS BIGINT) AS score
        FROM components AS q JOIN components AS c ON q.i = c.i AND q.vec_id <> c.vec_id
        WHERE q.vec_id % 100 = 0 GROUP BY ALL),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


def _sql_leaf(n_chars: str) -> str:
    parts = [f"COALESCE(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(parts)})"


ORACLES["op13_octopus_manifest"] = f"""
    WITH RECURSIVE leaves AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, COUNT(*) OVER (PARTITION BY lang) AS n
        FROM (SELECT doc_id, lang, {_sql_leaf("n_chars")} AS leaf,
                     CASE WHEN {SQL_CRC32.format("doc_id")} % 7 = 0 THEN {_sql_leaf("(n_chars + 1)")} END AS altered FROM documents) AS d),
    nodes AS (
        SELECT lang, 0 AS level, idx, leaf AS h, n FROM leaves
        UNION ALL
        SELECT lang, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 2, n),
    trees AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, COUNT(*) OVER () AS n FROM nodes WHERE n = 1),
    tops AS (
        SELECT 0 AS level, place AS idx, subroot AS h, n FROM trees
        UNION ALL
        SELECT level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, idx // 2, n),
    placed AS (SELECT l.*, t.subroot, t.place FROM leaves AS l JOIN trees AS t ON l.lang IS NOT DISTINCT FROM t.lang),
    siblings AS (
        SELECT p.lang, p.idx, s.level AS step, s.h FROM placed AS p JOIN nodes AS s ON s.lang IS NOT DISTINCT FROM p.lang AND s.idx = xor(p.idx >> s.level, 1)
        UNION ALL SELECT p.lang, p.idx, 100 + s.level, s.h FROM placed AS p JOIN tops AS s ON s.idx = xor(p.place >> s.level, 1)),
    proofs AS (SELECT lang, idx, sha256(string_agg(h, '' ORDER BY step)) AS proof_sha256 FROM siblings GROUP BY lang, idx),
    folded AS (
        SELECT lang, idx AS leaf_idx, 0 AS level, idx, n, COALESCE(altered, leaf) AS h FROM placed
        UNION ALL
        SELECT f.lang, leaf_idx, f.level + 1, f.idx // 2, (f.n + 1) // 2,
               sha256(CASE WHEN f.idx % 2 = 1 THEN s.h || f.h ELSE f.h || COALESCE(s.h, '') END)
        FROM folded AS f LEFT JOIN nodes AS s ON s.lang IS NOT DISTINCT FROM f.lang AND s.level = f.level AND s.idx = xor(f.idx, 1) WHERE f.n > 1),
    folded_top AS (
        SELECT f.lang, leaf_idx, 0 AS level, t.place AS idx, t.n, h FROM folded AS f JOIN trees AS t ON f.lang IS NOT DISTINCT FROM t.lang WHERE f.n = 1
        UNION ALL
        SELECT f.lang, leaf_idx, f.level + 1, f.idx // 2, (f.n + 1) // 2,
               sha256(CASE WHEN f.idx % 2 = 1 THEN s.h || f.h ELSE f.h || COALESCE(s.h, '') END)
        FROM folded_top AS f LEFT JOIN tops AS s ON s.level = f.level AND s.idx = xor(f.idx, 1) WHERE f.n > 1)
    SELECT p.doc_id, p.leaf, p.subroot, r.h AS root, COALESCE(q.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
    FROM placed AS p JOIN folded_top AS f ON f.n = 1 AND f.leaf_idx = p.idx AND f.lang IS NOT DISTINCT FROM p.lang
    JOIN tops AS r ON r.n = 1 LEFT JOIN proofs AS q ON q.idx = p.idx AND q.lang IS NOT DISTINCT FROM p.lang"""
