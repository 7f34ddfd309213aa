"""Language of documents by a bidirectional gated recurrent network over bytes.

The network reads a text's UTF-8 bytes forwards and backwards and gives every position a probability for each
language; a document's are the means over its positions. Texts are cut into windows of a fixed number of bytes that
begin with an empty state, so a batch holds windows of many documents, and a long text takes no more steps than a
short one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from crawlweave.llm.gru import F32, Adam, Gru, softmax
from crawlweave.llm.shared import batches, hash_share, texts_of, unused_prefix

UNKNOWN = "und"
PAD = 256


class BytesTagger:
    """Probabilities of languages for every byte of a window."""

    def __init__(self, languages: list[str], hidden: int = 12, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.forward, self.backward = Gru(257, hidden, rng), Gru(257, hidden, rng)
        self.out = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(F32)
        self.bias = np.zeros(len(languages), F32)

    def fit(self, windows: np.ndarray, labels: np.ndarray, rounds: int = 240, batch: int = 192, rate: float = 0.02, seed: int = 6) -> None:
        """Learn from windows (N, T) of bytes, PAD after their end, by backpropagation through time."""
        rng = np.random.default_rng(seed)
        optimizer = Adam([self.forward.inputs, self.forward.state, self.backward.inputs, self.backward.state, self.out, self.bias], rate)
        groups = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        groups = [g for g in groups if len(g)]
        for turn in range(rounds):
            if turn == rounds * 2 // 3:
                optimizer.rate = rate / 4
            pick = np.concatenate([rng.choice(g, max(1, batch // len(groups))) for g in groups])
            x, y = windows[pick], labels[pick]
            empty = np.zeros((len(x), self.forward.hidden), F32)
            f, f_kept = self.forward.run(x, empty)
            b, b_kept = self.backward.run(x[:, ::-1], empty)
            states = np.concatenate([f, b[::-1]], axis=2)
            p = softmax(states @ self.out + self.bias)
            p[:, np.arange(len(y)), y] -= 1
            mask = (x != PAD).T[:, :, None]
            d = p * mask / F32(max(1, mask.sum()))
            flat, d_flat = states.reshape(-1, states.shape[2]), d.reshape(-1, d.shape[2])
            d_states = d @ self.out.T
            n = self.forward.hidden
            f_grad = self.forward.gradient(x, f_kept, d_states[:, :, :n])
            b_grad = self.backward.gradient(x[:, ::-1], b_kept, d_states[::-1, :, n:])
            optimizer.update([*f_grad, *b_grad, flat.T @ d_flat, d_flat.sum(0)])

    def window_sums(self, windows: np.ndarray) -> np.ndarray:
        """Sums of the probabilities over the positions of each window."""
        count, width = windows.shape
        n = self.forward.hidden
        states = np.empty((width, count, 2 * n), F32)
        columns = np.ascontiguousarray(windows.T)
        for gru, order, part in ((self.forward, range(width), slice(0, n)), (self.backward, range(width - 1, -1, -1), slice(n, 2 * n))):
            h = np.zeros((count, n), F32)
            for t in order:
                h = gru.step(columns[t], h)
                states[t, :, part] = h
        logits = states.reshape(-1, 2 * n) @ self.out + self.bias
        np.exp(logits - logits.max(axis=1, keepdims=True), out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        p = logits.reshape(width, count, -1)
        p *= (columns != PAD)[:, :, None]
        return p.sum(0)

    def document_means(self, data: np.ndarray, at: np.ndarray, width: int = 128, block: int = 4096) -> np.ndarray:
        """Mean probabilities of each text; 0 for an empty one. ``data`` are the bytes, ``at`` the n+1 offsets."""
        lengths = np.diff(at)
        counts = -(-lengths // width)
        row = np.repeat(np.arange(len(lengths)), counts)
        first = np.cumsum(counts) - counts
        begin = at[:-1][row] + (np.arange(len(row)) - first[row]) * width
        sums = np.zeros((len(lengths), len(self.languages)))
        padded = np.concatenate([data, np.zeros(width, np.uint8)])
        for k in range(0, len(row), block):
            s, r = begin[k : k + block], row[k : k + block]
            windows = padded[s[:, None] + np.arange(width)].astype(np.int16)
            windows[s[:, None] + np.arange(width) >= at[1:][r][:, None]] = PAD
            np.add.at(sums, r, self.window_sums(windows))
        return sums / np.maximum(lengths, 1)[:, None]


def held_out(doc: str, folds: int) -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text divides by ``folds``; no id counts as empty."""
    return F.crc32(F.coalesce(F.col(doc).cast("string"), F.lit(""))) % folds == 0


def training_windows(
    rows: DataFrame, text: str, label: str, doc: str, per_language: int, most: int, width: int
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, windows, labels) of a bounded sample: so many documents of each language, by hash.

    All languages are learned; where there are very many, each gives fewer documents, so that all together give about
    ``most``, but one at least. Each document gives a piece of up to 4 windows from a place that its hash picks.
    """
    known = rows.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = known.groupBy(F.col(label).alias("l")).agg(F.count(F.lit(1)).alias("c"))
    names = [r[0] for r in counts.select("l").collect()]
    each = max(1, min(per_language, most // max(len(names), 1)))
    start = F.pmod(F.xxhash64(F.lit(1), doc), F.greatest(F.char_length(text) - 2 * width, F.lit(1))).cast("int") + 1
    pieces = known.select(F.col(label).alias("l"), F.xxhash64(F.col(doc), F.col(text)).alias("o"), F.substr(F.col(text), start, F.lit(4 * width)).alias("t"))
    # few more than wanted pass by their hash before the shuffle, so that a bounded number of short pieces is ranked; the
    # counts are one row for each language that the model has
    some = pieces.join(F.broadcast(counts), "l").where(hash_share(F.col("o"), (each + 6 * each**0.5 + 12) / F.col("c"))).distinct()
    sample = some.withColumn("_n", F.row_number().over(Window.partitionBy("l").orderBy("o", "t"))).where(F.col("_n") <= each)
    names.sort()
    windows, labels = [], []
    for row in sorted(sample.collect(), key=lambda r: (r.l, r.o, r.t)):
        data = row.t.encode()[: 4 * width]
        for k in range(0, len(data), width):
            piece = np.full(width, PAD, np.int16)
            part = np.frombuffer(data[k : k + width], np.uint8)
            piece[: len(part)] = part
            windows.append(piece)
            labels.append(names.index(row.l))
    return names, np.array(windows).reshape(-1, width), np.array(labels, np.int64)


def with_language(
    df: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    folds: int = 5,
    per_language: int = 400,
    most: int = 25_600,
    predicted: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """Add the predicted language and its probability.

    Learned from documents with a label whose id's CRC-32 does not divide by ``folds``: a sample of ``per_language`` of
    each language, fewer where all together would be more than ``most``. A text that is null or has no letter is ``und`` with probability 0, and
    so is everything if there is nothing to learn from. Whole texts are read; the label is not. Columns of the added
    names are replaced, all others are kept.
    """
    names, windows, labels = training_windows(df.select(doc, text, label).where(~held_out(doc, folds)), text, label, doc, per_language, most, 96)
    letters = unused_prefix(df) + "letters"
    marked = df.drop(predicted, score).withColumn(letters, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    if not names:
        return marked.drop(letters).withColumns({predicted: F.lit(UNKNOWN), score: F.lit(0.0)})
    model = BytesTagger(names)
    model.fit(windows, labels)
    schema = marked.drop(letters).schema.add(predicted, "string").add(score, "double")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(rows, text, 4 << 20):
            data, at = texts_of(table[text])
            means = model.document_means(data, at)
            best = means.argmax(axis=1)
            some = table[letters].to_pylist()
            found = [names[k] if ok else UNKNOWN for k, ok in zip(best, some)]
            p = np.where(some, means[np.arange(len(best)), best], 0.0)
            out = table.drop_columns([letters]).append_column(predicted, pa.array(found, pa.string()))
            yield from out.append_column(score, pa.array(np.clip(p, 0, 1), pa.float64())).to_batches()

    return marked.mapInArrow(run, schema)
