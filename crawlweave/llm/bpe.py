"""Byte-pair encoding by an index from each pair to its positions, and decoding.

The pieces of a batch of texts lie behind each other in one array of symbols. An index holds, for every pair that
occurs, all its positions; the pairs that occur are taken in ascending order of their merge rank, each merged at all
its positions at once, and the lists of the pairs that this makes or ends are updated. A merge makes only pairs of
later rank, so one ascending pass gives what merging each piece on its own gives.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from crawlweave.llm.chunks import PieceCache
from crawlweave.llm.shared import batches

#: fixed value of the public byte-level format: how texts are cut into pre-tokens
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.uint16(65535)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: itself if printable, else the next from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    later = iter(range(256, 512))
    return [chr(b if b in plain else next(later)) for b in range(256)]


class PairIndexBpe:
    """A vocabulary file of the ``tokenizers`` library with byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        value = {c: b for b, c in enumerate(letters)}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(value[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        self.first = np.array([vocab[c] for c in letters], np.int32)
        self.size = len(self.bytes_of)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = self.left * self.size + self.right
        order = np.argsort(keys, kind="stable")
        if len(merges) >= NONE:
            raise ValueError("the vocabulary has too many merges")
        self.keys, self.ranks = keys[order], order.astype(np.uint16)
        self.byte_ranks = self.rank_of(np.repeat(self.first, 256), np.tile(self.first, 256)).reshape(256, 256)
        self.pattern = regex.compile(PRE_TOKENS)
        self.cache = PieceCache(self.encode_pieces, self.pattern.findall, self.special)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        tokens: dict[str, int] = {}  # each different pre-token and its number
        number = tokens.setdefault
        used: list[int] = []
        counts: list[int] = []
        for piece in pieces:
            word = piece[1:] if piece[:1] == " " else piece
            if word.isalpha():
                used.append(number(piece, len(tokens)))
                counts.append(1)
            elif word[-1:] in (",", ".") and word[:-1].isalpha():
                used.append(number(piece[:-1], len(tokens)))
                used.append(number(piece[-1], len(tokens)))
                counts.append(2)
            else:
                cut = self.pattern.findall(piece)
                used += [number(t, len(tokens)) for t in cut]
                counts.append(len(cut))
        found = self._encode_tokens([t.encode() for t in tokens])
        flat = [found[k] for k in used]
        if len(flat) == len(pieces):
            return flat
        out = []
        at = 0
        for n in counts:
            out.append(flat[at] if n == 1 else b"".join(flat[at : at + n]))
            at += n
        return out

    def _encode_tokens(self, tokens: list[bytes]) -> list[bytes]:
        if not tokens:
            return []
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
        data = np.frombuffer(b"".join(tokens), np.uint8)
        ids = self.first[data]
        n = len(ids)
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        after[ends - 1] = -1
        before[ends[:-1]] = -1
        rank = np.full(n, NONE, self.ranks.dtype)
        rank[:-1] = self.byte_ranks[data[:-1], data[1:]]
        rank[ends - 1] = NONE
        self._merge(ids, after, before, rank)
        alive = ids >= 0
        upto = np.concatenate([[0], np.cumsum(alive)[ends - 1]]) * 4
        flat = ids[alive].astype("<u4").tobytes()
        return [flat[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]

    def _merge(self, ids: np.ndarray, after: np.ndarray, before: np.ndarray, rank: np.ndarray) -> None:
        """Merge in place; ``rank`` is that of the pair that begins at each position, NONE without one."""
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []
        turn = np.full(len(ids), -1, np.int32)  # the merge that last changed a position

        def enter(at: np.ndarray, rank: np.ndarray) -> None:
            """Put the pairs that begin at these positions into the index."""
            some = rank < NONE
            at, rank = at[some], rank[some]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            begin = [0, *cuts.tolist()]
            for r, x, y in zip(rank[begin].tolist(), begin, [*begin[1:], len(at)]):
                if r in index:
                    index[r].append(at[x:y])
                else:
                    index[r] = [at[x:y]]
                    heapq.heappush(active, r)

        enter(np.arange(len(ids), dtype=np.int32), rank)
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b = self.left[r], self.right[r]
            nxt = after[at]
            at = at[(ids[at] == a) & (nxt >= 0) & (ids[nxt] == b)]
            if a == b and len(at) > 1:  # in a run of one symbol, every second position from its start
                at.sort()
                new_run = np.concatenate([[True], at[1:] != after[at[:-1]]])
                start = np.flatnonzero(new_run)
                place = np.arange(len(at)) - start[np.cumsum(new_run) - 1]
                at = at[place % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            nxt = after[gone]
            ids[at] = self.made[r]
            ids[gone] = -1
            after[at] = nxt
            some = nxt >= 0
            before[nxt[some]] = at[some]
            turn[at] = r
            left = before[at]
            left = left[left >= 0]
            changed = np.concatenate([at[some], left[turn[left] != r]])
            enter(changed, self.rank_of(ids[changed], ids[after[changed]]))

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.cache.texts(texts)

    def decode(self, ids: bytes) -> str:
        try:
            data = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        except IndexError as error:
            raise ValueError("an id is outside the vocabulary") from error
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _loaded(path: str) -> PairIndexBpe:
    return PairIndexBpe(path)


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind)])


def _append(batch: pa.RecordBatch | pa.Table, name: str, values: pa.Array) -> list[pa.RecordBatch]:
    table = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
    if name in table.column_names:
        table = table.drop_columns([name])
    return table.append_column(name, values).to_batches()


def encode(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of a text column as binary, little-endian unsigned 32-bit integers.

    Every text is encoded whole; a null text gives no ids, like an empty one. An existing column of the output's name
    is replaced, all others are kept, and rows are neither merged nor reordered. ``tokenizer`` is the path of a
    vocabulary file that the executors reach.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(tokenizer)
        for table in batches(rows, text, 4 << 20):
            texts = [t or "" for t in table.column(text).to_pylist()]
            yield from _append(table, ids, pa.array(bpe.encode(texts), pa.binary()))

    return df.mapInArrow(run, _with(df.schema, ids, T.BinaryType()))


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that the ids of :func:`encode` stand for; invalid UTF-8 becomes U+FFFD, null ids an empty text.

    An id outside the vocabulary raises.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(tokenizer)
        for table in batches(rows, ids, 4 << 20):
            values = [bpe.decode(x or b"") for x in table.column(ids).to_pylist()]
            yield from _append(table, text, pa.array(values, pa.string()))

    return df.mapInArrow(run, _with(df.schema, text, T.StringType()))
