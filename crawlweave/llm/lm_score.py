"""Log-likelihood of whole documents under a gated recurrent language model with a class-factored output.

Words fall into classes by how often the training documents hold them: the most frequent words into small classes whose
members the network tells apart, all others into one class for each power of two of their count, inside which a word
has its share of the class's count. A word's probability is that of its class given the state times that of the word in
its class, so the model is a distribution over all training words, the end of the document, and one unknown word. The
state runs through the windows of a document from its first word to its end.

Counts come from all training documents and stay in a table that the documents are joined with; the documents meet them
once and are written as symbols. The network begins with weights from a few excerpts, then every partition learns from
all of its training documents by truncated backpropagation, and the weights are averaged by a tree after each pass. The
number of words that the network tells apart grows with the square root of the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from crawlweave.llm.gru import F32, Adam, ColumnGru
from crawlweave.llm.language_id import held_out
from crawlweave.llm.shared import batches, hash_share, shuffle_partitions, texts_of, word_hashes, word_spans, written

END = np.uint64(0x454E44)
CLASS_WORDS = 32
TOP_CLASSES = 32
OCTAVES = 48
SMOOTH = 0.1
TEXT_BYTES = 12 << 20
LEARN_TOKENS = 1 << 19
SCORE_TOKENS = 1 << 21  # long texts leave few columns at their end, so many texts go side by side
PLACES = 1 << 14  # tokens whose classes are worked out at once
FAN = 32
SYMBOL = np.dtype("<u4")


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words, A-Z as a-z, with END behind each text, and the n+1 offsets of the texts."""
    data, at = texts_of(column)
    start, end, first = word_spans(data, at)
    n = len(at) - 1
    offsets = first + np.arange(n + 1)
    out = np.full(offsets[-1], END, np.uint64)
    words = np.ones(len(out), bool)
    words[offsets[1:] - 1] = False
    out[words] = word_hashes(data, start, end)
    return out.view(np.int64), offsets


def token_counts(df: DataFrame, text: str) -> DataFrame:
    """(h, c) over all texts, counted inside batches before Spark adds them up."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(rows, text):
            h, c = np.unique(tokens_of(table[text])[0], return_counts=True)
            yield from pa.table({"h": h, "c": c.astype(np.int64)}).to_batches()

    return df.select(text).mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


class ClassFactored:
    """Symbols are the top words by rank, then the classes of the other words."""

    def __init__(self, top: np.ndarray, mass: np.ndarray, hidden: int = 16, seed: int = 9):
        """``top``: hashes of the most frequent words; ``mass``: smoothed counts of the other classes, the last unknown."""
        rng = np.random.default_rng(seed)
        self.order = np.argsort(top)
        self.top = top[self.order]
        self.log_mass = np.log(np.maximum(mass, SMOOTH))
        self.octaves = len(mass) - 1  # the class behind them is the unknown word
        self.tops = -(-len(top) // CLASS_WORDS)
        self.words = len(top)
        self.classes = self.tops + len(mass)
        self.gru = ColumnGru(self.words + len(mass) + 1, hidden, rng)  # the last symbol stands before the first word
        self.start = self.words + len(mass)
        self.to_class = rng.normal(0, 0.1, (hidden, self.classes)).astype(F32)
        self.class_bias = np.zeros(self.classes, F32)
        self.to_word = rng.normal(0, 0.1, (max(1, self.tops), hidden, CLASS_WORDS)).astype(F32)
        self.word_bias = np.zeros((max(1, self.tops), CLASS_WORDS), F32)
        self.word_bias.reshape(-1)[self.words :] = -30  # places of the last class without a word

    @property
    def values(self) -> list[np.ndarray]:
        return [self.gru.inputs, self.gru.state, self.to_class, self.class_bias, self.to_word, self.word_bias]

    def weights(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.values])

    def set_weights(self, flat: np.ndarray) -> None:
        for value in self.values:
            value[...] = flat[: value.size].reshape(value.shape)
            flat = flat[value.size :]

    def groups(self, symbol: np.ndarray) -> np.ndarray:
        """Class of each symbol."""
        return np.where(symbol < self.words, symbol // CLASS_WORDS, symbol - self.words + self.tops)

    def symbols(self, h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbol, class, log of the share in the class) of tokens with their counts."""
        at = np.searchsorted(self.top, h)
        at[at == len(self.top)] = 0
        known = self.top[at] == h if len(self.top) else np.zeros(len(h), bool)
        octave = np.where(c > 0, np.minimum(np.log2(np.maximum(c, 1)).astype(np.int64), self.octaves - 1), self.octaves)
        rank = self.order[at] if len(self.top) else np.zeros(len(h), np.int64)
        symbol = np.where(known, rank, self.words + octave)
        group = np.where(known, rank // CLASS_WORDS, self.tops + octave)
        return symbol, group, np.where(known, 0.0, np.log(c + SMOOTH) - self.log_mass[octave])

    def fit(self, texts: list[tuple[np.ndarray, np.ndarray]], rounds: int = 2, batch: int = 96, width: int = 16, rate: float = 0.01) -> None:
        """Truncated backpropagation through windows of ``width`` tokens; a batch of texts keeps its state over them."""
        optimizer = Adam(self.values, rate)
        texts = sorted(texts, key=lambda t: -len(t[0]))
        for turn in range(rounds):
            for k in range(0, len(texts), batch):
                part = texts[k : k + batch]
                longest = -(-len(part[0][0]) // width) * width
                x = np.full((len(part), longest + 1), self.start)
                y = np.full((len(part), longest), -1)
                for i, (symbol, group) in enumerate(part):
                    x[i, 1 : len(symbol) + 1] = symbol
                    y[i, : len(group)] = group
                h = np.zeros((self.gru.hidden, len(part)), F32)
                optimizer.rate = rate * (1 if turn < rounds - 1 else 0.3)
                for t in range(0, longest, width):
                    h = self._learn(x[:, t : t + width], x[:, t + 1 : t + width + 1], y[:, t : t + width], h, optimizer)

    def learn(self, symbol: np.ndarray, at: np.ndarray, optimizer: Adam, batch: int = 384, width: int = 24, least: int = 64) -> None:
        """Truncated backpropagation through whole texts; ``at`` are the n+1 offsets of the texts.

        Texts of like length go side by side, ``batch`` of many and ``least`` of few, and keep their state from window to
        window; windows are wider where few are left. Every second word that the training documents hold once stands for the unknown word, which else would
        never be seen: as much of the text is unknown later as is new here.
        """
        once = symbol == self.words  # the class of words with count 1
        once[::2] = False
        symbol = np.where(once, self.words + self.octaves, symbol)
        order = np.argsort(-np.diff(at), kind="stable")
        batch = min(batch, max(least, len(order) // 4))
        for k in range(0, len(order), batch):
            begin, lengths = at[order[k : k + batch]], np.diff(at)[order[k : k + batch]]
            h = np.zeros((self.gru.hidden, len(begin)), F32)
            t = 0
            while t < lengths[0]:
                n = int(np.searchsorted(-lengths, -t, "left"))  # texts with a token at place t
                place = t + np.arange(min(max(width, batch * width // n), 8 * width, int(lengths[0]) - t))
                live = place < lengths[:n, None]
                target = np.where(live, symbol[np.minimum(begin[:n, None] + place, len(symbol) - 1)], self.start)
                first = symbol[begin[:n] + t - 1] if t else np.full(n, self.start)
                x = np.column_stack([first, target[:, :-1]])
                h = self._learn(x, target, np.where(live, self.groups(target), -1), h[:, :n], optimizer)
                t += len(place)

    def _learn(self, x: np.ndarray, target: np.ndarray, group: np.ndarray, h: np.ndarray, optimizer: Adam) -> np.ndarray:
        states, kept = self.gru.run(x, h)
        target, group = target.T.ravel(), group.T.ravel()
        steps, hidden, rows = states.shape
        # places in the order of their class, those without a token first
        order = np.argsort(group.astype(np.int16), kind="stable")
        cuts = np.searchsorted(group[order], np.arange(self.tops + 1))
        live = order[cuts[0] if self.tops else np.searchsorted(group[order], 0) :]
        scale = F32(1 / max(1, len(live)))
        held = states.transpose(0, 2, 1).reshape(-1, hidden)[live].T.copy()
        p = self._softmax(self.to_class.T @ held + self.class_bias[:, None], scale)
        p[group[live], np.arange(len(live))] -= scale
        d_held = self.to_class @ p
        d_class, d_class_bias = held @ p.T, p.sum(1)
        d_word, d_word_bias = np.zeros_like(self.to_word), np.zeros_like(self.word_bias)
        words = target[live] % CLASS_WORDS
        cuts = cuts - cuts[0]
        for k in range(self.tops):
            a, b = cuts[k], cuts[k + 1]
            if a < b:
                own = np.ascontiguousarray(held[:, a:b])
                q = self._softmax(self.to_word[k].T @ own + self.word_bias[k][:, None], scale)
                q[words[a:b], np.arange(b - a)] -= scale
                d_word[k], d_word_bias[k] = own @ q.T, q.sum(1)
                d_held[:, a:b] += self.to_word[k] @ q
        d_flat = np.zeros((steps * rows, hidden), F32)
        d_flat[live] = d_held.T
        d_states = np.ascontiguousarray(d_flat.reshape(steps, rows, hidden).transpose(0, 2, 1))
        d_inputs, d_state = self.gru.gradient(x, kept, d_states)
        optimizer.update([d_inputs, d_state, d_class, d_class_bias, d_word, d_word_bias])
        return states[-1]

    @staticmethod
    def _softmax(x: np.ndarray, scale: np.ndarray) -> np.ndarray:
        """Shares of each column of ``x``, which is overwritten, times ``scale``."""
        x -= x.max(axis=0)
        np.exp(x, out=x)
        x *= scale / x.sum(axis=0)
        return x

    def score(self, symbol: np.ndarray, group: np.ndarray, share: np.ndarray, at: np.ndarray, width: int = 256) -> np.ndarray:
        """log10 probability of each text; ``at`` are the n+1 offsets of the texts in the token arrays.

        Classes are worked out for ``width`` steps at once, or as many as hold PLACES tokens.
        """
        lengths = np.diff(at)
        order = np.argsort(-lengths, kind="stable")
        sorted_lengths, begin = lengths[order], at[:-1][order]
        total = np.add.reduceat(np.append(share, 0.0), at[:-1]) if len(lengths) else np.zeros(0)
        longest = int(sorted_lengths[0]) if len(order) else 0
        live = np.searchsorted(-sorted_lengths, -np.arange(longest), "left")  # texts with a token at each place
        h = np.zeros((self.gru.hidden, len(order)), F32)
        last = np.full(len(order), self.start)
        states, places, rows, size = [], [], [], 0
        for s, n in enumerate(live.tolist()):
            h = self.gru.column_step(last[:n], h[:, :n])
            now = begin[:n] + s
            last = symbol[now]
            states.append(h)
            places.append(now)
            rows.append(order[:n])
            size += n
            if size >= PLACES or len(states) == width or s == longest - 1:
                now = np.concatenate(places)
                logp = self._log_probabilities(np.concatenate(states, axis=1), group[now], symbol[now])
                total += np.bincount(np.concatenate(rows), logp, minlength=len(total))
                states, places, rows, size = [], [], [], 0
        return total / np.log(10)

    def _log_probabilities(self, states: np.ndarray, group: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        order = np.argsort(group.astype(np.int16), kind="stable")
        group, symbol = group[order], symbol[order]
        held = states.T[order].T.copy()
        logp = self._log_shares(self.to_class.T @ held + self.class_bias[:, None], group)
        cuts = np.searchsorted(group, np.arange(self.tops + 1))
        for k in range(self.tops):
            a, b = cuts[k], cuts[k + 1]
            if a < b:
                own = np.ascontiguousarray(held[:, a:b])
                logp[a:b] += self._log_shares(self.to_word[k].T @ own + self.word_bias[k][:, None], symbol[a:b] % CLASS_WORDS)
        out = np.empty_like(logp)
        out[order] = logp
        return out

    @staticmethod
    def _log_shares(x: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Log of the share that one row has of each column of exp(``x``); ``x`` is overwritten."""
        own = x[row, np.arange(len(row))].astype(float)
        high = x.max(axis=0)
        x -= high
        np.exp(x, out=x)
        return own - high - np.log(x.sum(axis=0))


def told_apart(vocabulary: int) -> int:
    """How many words the network tells apart: 1,024, and more with the square root of the number of different words."""
    return CLASS_WORDS * max(TOP_CLASSES, int(np.ceil(np.sqrt(vocabulary) / 64)))


def _begun(
    train: DataFrame, counts: DataFrame, vocabulary: int, doc: str, text: str, excerpts: int, chars: int
) -> ClassFactored:
    """The model before it has seen all documents, with weights from ``excerpts`` pieces of ``chars`` characters, picked by hash."""
    end = int(END.view(np.int64))
    spark = train.sparkSession
    top = counts.orderBy(F.desc("c"), "h").limit(told_apart(vocabulary)).select("h").collect()
    top_hashes = np.array([r.h for r in top], np.int64)
    if end not in top_hashes and len(top_hashes):
        top_hashes[-1] = end  # the end of a text is always told apart
    octave = F.least(F.floor(F.log2("c")), F.lit(OCTAVES - 1)).cast("int")
    rest = counts.join(spark.createDataFrame(pa.table({"h": top_hashes})), "h", "left_anti") if len(top_hashes) else counts
    mass = np.zeros(OCTAVES + 1)
    for row in rest.groupBy(octave.alias("k")).agg(F.sum(F.col("c") + SMOOTH).alias("m")).collect():  # OCTAVES rows at most
        mass[row.k] = row.m
    # no class beyond the largest count that is left, so that the class layer stays small
    mass = np.append(mass[: max(1, np.flatnonzero(mass).max(initial=0) + 1)], SMOOTH)
    order = F.xxhash64(F.lit(3), doc, text)
    start = F.pmod(F.xxhash64(F.lit(4), doc), F.greatest(F.char_length(text) - chars // 2, F.lit(1))).cast("int") + 1
    sample = train.where(F.col(text).isNotNull()).select(
        F.substr(F.col(text), start, F.lit(chars)).alias("t"), order.alias("o"), (F.char_length(text) < start + chars).alias("ended")
    )
    # equal rows give one excerpt; the hash lets about ``excerpts`` through, wherever they lie
    total = max(train.where(F.col(text).isNotNull()).count(), 1)
    chosen = sample.where(hash_share(F.col("o"), F.lit((excerpts + 6 * excerpts**0.5) / total))).distinct().collect()
    sample = [(r.t, r.ended) for r in sorted(chosen, key=lambda r: (r.o, r.t))[:excerpts]]
    h, at = tokens_of(pa.array([t for t, _ in sample], pa.string()))
    needed = spark.createDataFrame(pa.table({"h": np.unique(h)})) if len(h) else spark.createDataFrame([], "h long")
    found = {r.h: r.c for r in needed.join(counts, "h").collect()}  # no more than the sample's words
    model = ClassFactored(top_hashes, mass)
    c = np.array([found.get(int(x), 0) for x in h], np.int64)
    symbol, group, _ = model.symbols(h, c)
    texts = []
    for (_, ended), a, b in zip(sample, at[:-1], at[1:]):
        b = b if ended else b - 1  # an excerpt from the middle has no end
        if b > a:
            texts.append((symbol[a:b], group[a:b]))
    if texts:
        model.fit(texts)
    return model


def _merged(table: pa.Table) -> pa.Table:
    """Means of weights, by the tokens that they were learned from."""
    table = table.sort_by("part")
    tokens = table["tokens"].to_numpy()
    mean = sum(np.frombuffer(w.as_py(), F32) * (n / tokens.sum()) for w, n in zip(table["weights"], tokens))
    return pa.table({"part": table["part"][:1], "tokens": [tokens.sum()], "weights": [mean.astype(F32).tobytes()]})


def _learn_all(model: ClassFactored, train: DataFrame, rate: float) -> None:
    """One pass over the symbols of all rows; each partition learns from its own, the weights are averaged by a tree."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        optimizer, total = Adam(model.values, rate), 0
        held: list[np.ndarray] = []
        size = 0

        def learn() -> None:
            model.learn(np.concatenate(held).astype(np.int32), np.cumsum([0, *map(len, held)]), optimizer)

        for batch in rows:
            for text in batch.column("symbols"):
                held.append(np.frombuffer(text.as_buffer(), SYMBOL))
                size += len(held[-1])
                if size >= LEARN_TOKENS:
                    learn()
                    held, total, size = [], total + size, 0
        if held:
            learn()
            total += size
        if total:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "tokens": [total], "weights": [model.weights().tobytes()]})

    schema = "part long, tokens long, weights binary"
    parts = written(train.select("symbols").mapInArrow(run, schema), "weights")
    n = parts.count()
    while n > FAN:
        n = -(-n // FAN)
        parts = parts.groupBy((F.col("part") % n).alias("branch")).applyInArrow(_merged, schema)
    rows = parts.collect()  # no more than FAN
    if rows:
        found = _merged(pa.table({c: [r[c] for r in rows] for c in ("part", "tokens", "weights")}))
        model.set_weights(np.frombuffer(found["weights"][0].as_py(), F32))


def with_scores(
    df: DataFrame, doc: str = "doc_id", text: str = "text", folds: int = 10, excerpts: int = 1500, chars: int = 1600, passes: int = 1
) -> DataFrame:
    """One row for each row of ``df``: the id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learned from rows whose id's CRC-32 does not divide by ``folds`` (no id counts as empty text). Tokens are words with
    A-Z as a-z and one end; a null text has only the end. ``base_score`` is the log10 probability under single-token
    counts with 0.1 added. Texts meet the counts of their words in groups of about 12 MB of text, made by the hash of id
    and text. ``excerpts`` pieces of ``chars`` characters give the weights that the ``passes`` over all training texts
    begin with. Without training texts every token is unknown.
    """
    spark = df.sparkSession
    slim = df.select(F.col(doc).alias("_doc"), F.col(text).alias("_text")).withColumn("_train", ~held_out("_doc", folds))
    train = slim.where("_train")
    counts = written(token_counts(train, "_text"), "token-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    model = _begun(train, counts, v, "_doc", "_text", excerpts, chars)
    size = slim.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    groups = max(shuffle_partitions(spark), -(-size // TEXT_BYTES))
    grouped = slim.withColumn("_group", F.pmod(F.xxhash64("_doc", "_text"), F.lit(groups)).cast("int"))
    dealt = grouped.repartition(groups, "_group")

    def needed(table: pa.Table) -> pa.Table:
        h = np.unique(tokens_of(table["_text"])[0])
        return pa.table({"_group": pa.array(np.full(len(h), table["_group"][0].as_py()), pa.int32()), "h": h})

    wanted = dealt.groupBy("_group").applyInArrow(needed, "_group int, h long")
    found = wanted.join(counts, "h")
    base = np.log10(n + SMOOTH * (v + 1))
    kind = df.schema[doc].dataType.simpleString()

    def coded(texts: pa.Table, known: pa.Table) -> pa.Table:
        texts = texts.sort_by([("_doc", "ascending"), ("_text", "ascending")])  # the same order of learning in each run
        h, at = tokens_of(texts["_text"])
        known_h, known_c = known["h"].to_numpy(), known["c"].to_numpy()
        order = np.argsort(known_h)
        known_h, known_c = known_h[order], known_c[order]
        c = np.zeros(len(h), np.int64)
        if len(known_h):
            place = np.searchsorted(known_h, h)
            place[place == len(known_h)] = 0
            c = np.where(known_h[place] == h, known_c[place], 0)
        ends = np.cumsum(np.concatenate([[0.0], np.log10(c + SMOOTH) - base]))
        sure = np.concatenate([[0], np.cumsum(c > 0)])
        symbol, _, share = model.symbols(h, c)
        symbol = symbol.astype(SYMBOL)
        return pa.table(
            {
                "doc_id": texts["_doc"], "train": texts["_train"], "n_tokens": np.diff(at), "n_known": sure[at[1:]] - sure[at[:-1]],
                "base_score": ends[at[1:]] - ends[at[:-1]], "share": np.add.reduceat(share, at[:-1]) if len(h) else np.zeros(0),
                "symbols": pa.array([symbol[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()),
            }
        )

    schema = f"doc_id {kind}, train boolean, n_tokens long, n_known long, base_score double, share double, symbols binary"
    texts = written(dealt.groupBy("_group").cogroup(found.groupBy("_group")).applyInArrow(coded, schema), "symbols")
    for _ in range(passes):
        _learn_all(model, texts.where("train"), 0.005)

    def scored(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(rows, "symbols", SYMBOL.itemsize * SCORE_TOKENS):
            parts = [np.frombuffer(x.as_buffer(), SYMBOL) for x in table["symbols"]]
            at = np.cumsum([0, *map(len, parts)])
            symbol = np.concatenate(parts).astype(np.int32)
            # the shares are added to what the network gives
            score = model.score(symbol, model.groups(symbol), np.zeros(len(symbol)), at) + table["share"].to_numpy() / np.log(10)
            out = {c: table[c] for c in ("doc_id", "n_tokens", "n_known")}
            out |= {"train_tokens": pa.array(np.full(len(parts), n)), "base_score": table["base_score"], "score": pa.array(score)}
            yield from pa.table(out).to_batches()

    schema = f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.mapInArrow(scored, schema)
