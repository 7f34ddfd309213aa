"""Token ids of documents as Parquet files made for selective reads.

The ids of a document are one list column, dictionary-encoded (ids of a vocabulary below 65,536 take two bytes or
less); the integer columns beside it are delta-encoded. Row groups and pages have set sizes, and Parquet's page
indexes let a reader that wants some documents, or only the metadata, skip the rest.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from crawlweave.llm.bpe import PRE_TOKENS, byte_letters
from crawlweave.llm.chunks import Memo, PieceMemo
from crawlweave.llm.shared import batches, list_array


#: visible marks that are neither letters nor digits, nor begin a contraction: behind letters they are one pre-token
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


@lru_cache(maxsize=2)
def _loaded(path: str) -> PieceMemo:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    letters = dict(enumerate(byte_letters()))
    blank = letters[32]
    tokenize = tokenizer.model.tokenize  # of one pre-token, quicker than a call of the whole tokenizer
    id_bytes = [i.to_bytes(4, "little") for i in range(max(tokenizer.get_vocab().values()) + 1)]
    pre_tokens = regex.compile(PRE_TOKENS).findall

    def of_letters(word: str, lead: str = "") -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(letters)
        return b"".join([id_bytes[t.id] for t in tokenize(lead + word)])

    def of_pre_token(word: str) -> bytes:
        return b"".join([id_bytes[t.id] for t in tokenize(word.encode().decode("latin-1").translate(letters))])

    small = Memo(of_pre_token)  # marks and line ends, and words that stand beside them

    def of_word(piece: str, lead: str = "") -> bytes | None:
        """Letters and marks behind them; anything else is left to the pattern."""
        word = piece.rstrip(MARKS)
        if word is piece:
            return of_letters(piece, lead) if piece.isalpha() else None
        return of_letters(word, lead) + small[piece[len(word) :]] if word.isalpha() else None

    def encode(piece: str, lead: str, text: str) -> bytes:
        ids = of_word(piece, lead)
        if ids is not None:
            return ids
        small.forget(100_000)
        before, end, after = piece.partition("\n")
        if end and after:  # the end of a line between two words is a pre-token
            ids, more = of_word(before, lead), of_word(after)
            if ids is not None and more is not None:
                return ids + small["\n"] + more
        return b"".join([small[x] for x in pre_tokens(text)])

    def tail(piece: str) -> bytes:
        return encode(piece, blank, " " + piece)

    def head(piece: str) -> bytes:
        return of_word(piece[1:], blank) or b"".join([small[x] for x in pre_tokens(piece)]) if piece[:1] == " " else encode(piece, "", piece)

    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    return PieceMemo(tail, head, pre_tokens, special, limit=600_000)


def write_token_files(
    df: DataFrame,
    path: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
) -> None:
    """Encode each whole text with the ``tokenizers`` library and write the ids in ascending order of ``key``.

    Rows: ``part`` (the file's place in the order), ``offset`` (ids of the part before the row), the key,
    ``n_tokens`` and ``ids``; ``end_id`` closes each document. A null text is empty. Rows of a null key come first,
    rows of one key follow each other in the order of their texts' hashes. Other columns of ``df`` are not written.
    The texts are dealt out by ranges of the key, so no task depends on how many rows a source has.
    """
    fields = df.schema[key].simpleString().split(":", 1)[1]
    ordered = (
        df.select(F.col(key), F.col(text).alias("_text"))
        .repartitionByRange(F.col(key).asc_nulls_first())
        .sortWithinPartitions(F.col(key).asc_nulls_first(), F.xxhash64("_text"))
    )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _loaded(tokenizer)
        part = TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")
        before = 0
        for table in batches(rows, "_text", 6 << 20):
            coded = [x + end for x in coder.texts([t or "" for t in table.column("_text").to_pylist()])]
            lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
            ends = np.cumsum(lengths)
            yield from pa.table(
                {
                    "part": pa.array(np.full(len(coded), part), pa.int32()),
                    "offset": pa.array(before + ends - lengths, pa.int64()),
                    key: table.column(key),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids": list_array(np.frombuffer(b"".join(coded), "<i4"), np.concatenate([[0], ends]), pa.int32()),
                }
            ).to_batches()
            before += int(ends[-1]) if len(ends) else 0

    rows = ordered.mapInArrow(run, f"part int, offset long, `{key}` {fields}, n_tokens long, ids array<int>")
    writer = rows.write.option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
    writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
    writer = writer.option("parquet.dictionary.page.size", 1 << 20)
    for column in ("part", "offset", key, "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path)


def read_parts(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The rows of token files as written, or some of their columns; the rest is not read."""
    rows = spark.read.parquet(path)
    return rows.select(*columns) if columns else rows


def with_starts(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Replace ``part`` and ``offset`` by ``start``, the number of ids of all documents before.

    The totals of the parts, one row for each file, are summed up in order; rows find theirs by the part's number.
    """
    totals = read_parts(spark, path, ["part", "n_tokens"]).groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    return rows.join(bases, "part").withColumn("start", F.col("_base") + F.col("offset")).drop("_base", "offset", "part")


def read_token_files(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """The rows of token files with ``start``; without ``ids`` only metadata."""
    rows = read_parts(spark, path)
    return with_starts(rows if ids else rows.drop("ids"), spark, path)


def with_checksum(df: DataFrame, ids: str = "ids", name: str = "ids_crc32") -> DataFrame:
    """Replace a list of ids by the unsigned CRC-32 of its values as little-endian 32-bit integers; null counts as empty."""
    schema = df.drop(ids, name).schema.add(name, "long")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            column = batch.column(ids)
            values = column.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            at = column.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b]) if ok else 0 for a, b, ok in zip(at[:-1], at[1:], column.is_valid().to_pylist())]
            table = pa.Table.from_batches([batch]).drop_columns([c for c in (ids, name) if c in batch.schema.names])
            yield from table.append_column(name, pa.array(sums, pa.int64())).to_batches()

    return df.mapInArrow(run, schema)
