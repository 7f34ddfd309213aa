"""Operators over documents against their plain versions, on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from crawlweave.llm import bpe, jaccard_join, language_id, line_dedup, lm_score, mixing, quality, token_files
from crawlweave.session import fresh_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, score string, _text int, _doc string, kept int, n_lines int"


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}{rng.choice(['', '', ',', '.'])}" for _ in range(n))


def awkward_texts():
    rng = random.Random(3)
    base = prose(rng, 300)
    line = "This Line stands in very many documents."
    texts = [None, "", " \n\t ", "A b c", "a B c", "a b", "word", "\n\n", "x  y   z\t<|endoftext|> é \U0001f600 'll"]
    texts += [base, base, base.upper()]
    texts += [" ".join(w if rng.random() > 0.02 else "changed" for w in base.split()) for _ in range(12)]
    texts += [f"{prose(rng, 30)}\n {line} \n{prose(rng, 20)}" for _ in range(5)] + [f"{line.lower()}\n{line}\nshort\nshort"]
    texts += [prose(rng, 25) + " " + base[:900] for _ in range(4)]
    texts += [prose(rng, 40) + "\n" + "again and again and again we say it " * 5, "same same " * 40]
    texts += ["long word " + "z" * 70_000, prose(rng, 12_000)]
    return texts


@pytest.fixture(scope="module")
def texts():
    return awkward_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Awkward texts, columns whose names operators use themselves, a row without an id, and a row twice."""
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "c"][i % 4], len(t or ""), "x", "y", i, "z", 1, 2) for i, t in enumerate(texts)]
    rows += [(None, "a text without an id " * 3, "en", "a", 1, None, None, None, None, None, None), rows[9]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def plain(spark, texts):
    """Different ids only."""
    rows = [(i, t, "en", "ab"[i % 2], 0, None, None, None, None, None, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_near_duplicates(spark, docs, texts, empty):
    got = jaccard_join.near_duplicates(docs).collect()
    assert len(got) == len(texts) + 2
    want = brute.near_duplicates(list(enumerate(texts)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert jaccard_join.near_duplicates(empty).collect() == []
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, (_, c) in want.items() if d == c} | {None}


def test_one_row_of_each_component(spark):
    """Ids that stand for several texts, and rows that are there twice."""
    rng = random.Random(3)
    a, b, c = (prose(rng, 80) for _ in range(3))
    near = lambda text: text + " more"
    rows = [(1, a), (2, b), (2, near(a)), (5, near(b)), (5, near(b)), (7, c), (7, c), (8, ""), (8, ""), (8, None), (1, prose(rng, 30)), (None, a), (None, a)]
    frame = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, row string").repartition(4)
    kept = jaccard_join.one_of_each(frame)
    assert kept.columns == frame.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == Counter([(1, a), (2, b), (7, c), (8, ""), (8, None), (1, rows[10][1]), (None, a), (None, a)])


def test_near_duplicates_many_pairs(spark):
    """A large group of near copies, a passage in many documents, and chains of links, against all pairs."""
    rng = random.Random(8)
    base, passage = prose(rng, 120).split(), prose(rng, 60)
    rows = []
    for _ in range(150):
        rows.append(" ".join(w if rng.random() > 0.01 else f"new{rng.random()}" for w in base))
    for _ in range(60):
        rows.append(prose(rng, rng.randrange(4, 30)) + " " + passage)
    chain = prose(rng, 100).split()
    for _ in range(25):
        for k in range(2):
            chain[rng.randrange(len(chain))] = f"step{rng.random()}"
        rows.append(" ".join(chain))
    rng.shuffle(rows)
    got = jaccard_join.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(list(enumerate(rows)))


def test_line_dedup(docs, plain, texts, empty):
    want = {d: rest for d, *rest in brute.line_dedup([*enumerate(texts), (None, "a text without an id " * 3)])}
    got = line_dedup.drop_shared_lines(docs)
    assert set(got.columns) == set(docs.columns) | {"n_dropped"}
    rows = got.collect()
    assert len(rows) == len(texts) + 2
    assert all([r.n_lines, r.n_dropped, r.text or ""] == want[r.doc_id] for r in rows)
    assert sum(r.n_dropped for r in rows) >= 5
    assert line_dedup.drop_shared_lines(empty).collect() == []
    bits = line_dedup.line_keep_bitmaps(plain).collect()
    assert {r["_doc"] for r in bits} == {d for d, (_, n, _) in want.items() if n}


def test_line_of_many_lines(spark):
    """More lines than one word of a bitmap holds."""
    shared = "a line that three documents have in common"
    rows = [(i, "\n".join(shared if k % 70 == 5 else f"document {i} has a line {k} of its own" for k in range(300))) for i in range(4)]
    got = line_dedup.drop_shared_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got} == set(brute.line_dedup(rows))


def test_quality(spark, docs, texts, empty):
    trusted = spark.createDataFrame([(9,), (10,), (25,), (25,), (None,)], "doc_id long")
    rows = quality.with_quality(docs, trusted, features=1 << 12).collect()
    assert len(rows) == len(texts) + 2
    everything = [*enumerate(texts), (None, "a text without an id " * 3), ("again", texts[9])]
    scores = brute.quality_scores(everything, {9, 10, 25, "again"}, 1 << 12, quality.PRIOR)
    for r in rows:
        text = dict(everything)[r.doc_id]
        n, chars, symbols, lines, repeats = brute.base_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert r.score == pytest.approx(scores[r.doc_id], abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= quality.LEAST_SCORE)
    assert any(r.n_repeat_words for r in rows)
    none = quality.with_quality(docs, trusted.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert quality.with_quality(empty, trusted).collect() == []


def test_quality_tells_junk_from_prose(spark):
    rng = random.Random(5)
    word = lambda: f"{rng.choice('aeiou')}{rng.randrange(12)}"
    rows = [(i, " ".join(word() for _ in range(200))) for i in range(200)]
    rows += [(200 + i, " ".join(word() + rng.choice(["$$$", "###"]) for _ in range(200))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.range(0, 150).selectExpr("id AS doc_id")
    kept = {r.doc_id for r in quality.with_quality(docs, trusted).where("kept").collect()}
    assert kept == set(range(200))


def test_mix(spark, docs, texts, empty):
    rows = [(i, s, n) for i, (s, n) in enumerate([("b", 7), ("a", 0), (None, 5)] * 40 + [("z", 900), ("a", 3), ("Q", 0)] + [("é", k % 9) for k in range(300)])]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.copies(frame, ["doc_id"], block_rows=16).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    want = brute.targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r["size"]
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6
    again = mixing.copies(frame.repartition(5), ["doc_id"], block_rows=16).collect()
    assert {(r.doc_id, r.copies) for r in again} == {(r.doc_id, r.copies) for r in got}
    assert mixing.copies(spark.createDataFrame([], frame.schema), ["doc_id"]).collect() == []
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    counts = Counter((r.doc_id, r.text) for r in mix.collect())
    assert max(counts[i, t] for i, t in enumerate(texts) if i != 9) <= 2 and counts[9, texts[9]] <= 4
    assert mixing.mixed(empty).collect() == []


def test_rounding_is_fair():
    """Over many draws a document is taken as often as its probability says."""
    sizes = np.array([50.0, 20, 20, 7, 5, 1])
    for settle, p in ((lambda d: mixing._settle_equal(sizes, 0.3, d), np.full(6, 0.3)), (lambda d: mixing._settle(sizes, q, d), np.array([0.2, 0.9, 0.5, 0.4, 0.7, 0.1]))):
        q = p.copy()
        draws = np.random.default_rng(1).random((20000, 6))
        mean = np.mean([settle(d) for d in draws], axis=0)
        assert np.abs(mean - p).max() < 0.02
        assert max(abs((settle(d) * sizes).sum() - (p * sizes).sum()) for d in draws[:500]) < 1e-6
        assert all(((0 < settle(d)) & (settle(d) < 1)).sum() <= 1 for d in draws[:500])


def test_bpe(spark, docs, texts, empty):
    library = Tokenizer.from_file(TOKENIZER)
    rows = bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want
        assert r.decoded == library.decode(want, skip_special_tokens=False) == (r.text or "")
    assert bpe.encode(empty, TOKENIZER).collect() == []
    assert bpe.PairIndexBpe(TOKENIZER).decode(np.array([255], "<u4").tobytes()) == library.decode([255], skip_special_tokens=False)


def test_bpe_random_texts():
    library, mine = Tokenizer.from_file(TOKENIZER), bpe.PairIndexBpe(TOKENIZER)
    rng = random.Random(1)
    letters = [*"ab  \n\t\r  'stllre1٣é<|>\x1c\x85​　 .,#", "<|endoftext|>", "aaaa", "   ", "\U0001f600"]
    cases = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    mine.cache.limit = 100
    for k in range(0, len(cases), 500):
        for case, ids in zip(cases[k : k + 500], mine.encode(cases[k : k + 500])):
            want = library.encode(case, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, case
            assert mine.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_token_files(spark, docs, texts, empty):
    library = Tokenizer.from_file(TOKENIZER)
    path = fresh_dir(spark, "test-tokens")
    token_files.write_token_files(docs, path, TOKENIZER, row_group_bytes=1 << 16, page_bytes=1 << 12)
    rows = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, *sorted([*range(len(texts)), 9])]
    start = 0
    for r in rows:
        text = "a text without an id " * 3 if r.doc_id is None else texts[r.doc_id]
        assert r.ids == [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        start += len(r.ids)
    sums = token_files.with_checksum(token_files.read_token_files(spark, path)).collect()
    want = {(r.doc_id, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in rows}
    assert {(r.doc_id, r.ids_crc32) for r in sums} == want
    assert "ids" not in token_files.read_token_files(spark, path, ids=False).columns
    nothing = fresh_dir(spark, "test-tokens")
    token_files.write_token_files(empty, nothing, TOKENIZER)
    assert token_files.read_token_files(spark, nothing).collect() == []


def test_token_file_layout(spark, docs):
    """Dictionary for the ids, delta for the numbers, several row groups, page indexes."""
    import glob

    import pyarrow.parquet as pq

    path = fresh_dir(spark, "test-tokens")
    token_files.write_token_files(docs.coalesce(1), path, TOKENIZER, row_group_bytes=1 << 15, page_bytes=1 << 11)
    found = [pq.ParquetFile(f).metadata for f in glob.glob(path.removeprefix("file:") + "/*.parquet")]
    columns = [m.row_group(g).column(c) for m in found for g in range(m.num_row_groups) for c in range(m.num_columns)]
    for c in columns:
        assert c.has_column_index and c.has_offset_index
        if c.path_in_schema.startswith("ids"):
            assert "RLE_DICTIONARY" in c.encodings
        elif c.path_in_schema in ("n_tokens", "offset"):
            assert "DELTA_BINARY_PACKED" in c.encodings


def test_language(spark, docs, empty):
    rng = random.Random(4)
    parts = {"xa": ["the", "ing", "ation", "wh"], "xb": ["ét", "eaux", "que", "oi"]}
    rows = []
    for i in range(300):
        name = rng.choice(["xa", "xb"])
        body = " ".join("".join(rng.choice(parts[name]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 60)))
        rows.append((i, body, name))
    rows += [(1000, None, "xa"), (1001, " 123 ?!", "xa"), (1002, "", None), (None, "thation whing the", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.with_language(frame).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 1000 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 30 and all(r.lang_pred == r.lang for r in held)
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (1000, 1001, 1002)} == {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in got)
    assert [r.lang_pred for r in got if r.doc_id is None] == ["xa"]
    assert {r.lang_pred for r in language_id.with_language(docs).collect()} <= {"en", "de", "und"}
    assert language_id.with_language(empty).collect() == []
    blind = language_id.with_language(frame.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang"))
    assert {r.lang_pred for r in blind.collect()} == {"und"}


def test_many_languages(spark):
    """More languages than any list of the largest would hold; with few rows each gives one."""
    rng = random.Random(9)
    alphabet = [chr(0x4E00 + i) for i in range(140)]
    rows = [(i * 70 + k, "".join(rng.choice(alphabet[2 * k : 2 * k + 2]) for _ in range(40)), f"l{k:02d}") for i in range(12) for k in range(70)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, windows, labels = language_id.training_windows(frame, "text", "lang", "doc_id", 400, 25_600, 96)
    assert len(names) == 70 and set(labels) == set(range(70)) and len(windows) >= len(rows)
    names, _, labels = language_id.training_windows(frame, "text", "lang", "doc_id", 400, 70, 96)
    assert set(labels) == set(range(70)) and len(labels) <= 2 * 70
    assert {r.lang_pred for r in language_id.with_language(frame).collect()} <= set(names)


def test_lm_scores(spark, docs, texts, empty):
    everything = [*enumerate(texts), (None, "a text without an id " * 3), (9, texts[9])]
    tokens = lambda t: [*brute.words((t or "").translate(brute.LOWER)), "<end>"]
    counts = Counter()
    for d, t in everything:
        if zlib.crc32(("" if d is None else str(d)).encode()) % 10:
            counts.update(tokens(t))
    rows = lm_score.with_scores(docs, excerpts=30).collect()
    assert len(rows) == len(everything)
    for r in rows:
        own = tokens(dict(everything)[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[t] > 0 for t in own), sum(counts.values()))
        assert r.base_score == pytest.approx(brute.base_score(own, counts))
        assert r.score < 0
    assert lm_score.with_scores(empty).collect() == []


def test_lm_is_a_distribution():
    """Over all first words, the end and the unknown word, probabilities sum to 1; state runs through windows."""
    rng = np.random.default_rng(2)
    hashes = rng.integers(-(2**62), 2**62, 70)
    counts = np.sort(rng.integers(1, 500, 70))[::-1].copy()
    mass = np.zeros(lm_score.OCTAVES + 1)
    for c in counts[40:]:
        mass[int(np.log2(c))] += c + lm_score.SMOOTH
    mass[-1] = lm_score.SMOOTH
    model = lm_score.ClassFactored(hashes[:40], mass)
    symbol, group, share = model.symbols(np.append(hashes, 7), np.append(counts, 0))
    model.fit([(symbol[:-1], group[:-1])] * 3, rounds=30)
    p = 10 ** model.score(symbol, group, share, np.arange(72))
    empty_classes = [k for k in range(model.tops, model.classes) if k not in set(group)]
    logits = np.zeros((1, model.gru.hidden), np.float32)
    state = model.gru.step(np.array([model.start]), logits)
    classes = np.exp(state @ model.to_class + model.class_bias)[0]
    assert p.sum() + (classes / classes.sum())[empty_classes].sum() == pytest.approx(1, abs=1e-4)
    whole = model.score(symbol, group, share, np.array([0, 71]), width=5)
    assert whole == pytest.approx(model.score(symbol, group, share, np.array([0, 71]), width=64), rel=1e-5)
    both = model.score(np.tile(symbol, 2), np.tile(group, 2), np.tile(share, 2), np.array([0, 71, 142]))
    assert both == pytest.approx(np.repeat(whole, 2), rel=1e-5)


def test_recurrent_gradients(monkeypatch):
    from crawlweave.llm import gru

    monkeypatch.setattr(gru, "F32", np.float64)
    rng = np.random.default_rng(0)
    layer = gru.Gru(5, 3, rng)
    x, w, h = rng.integers(0, 5, (4, 6)), rng.normal(size=(6, 4, 3)), rng.normal(size=(4, 3))
    loss = lambda: (layer.run(x, h)[0] * w).sum()
    _, kept = layer.run(x, h)
    for values, gradient in zip((layer.inputs, layer.state), layer.gradient(x, kept, w)):
        for at in np.ndindex(values.shape):
            old = values[at]
            values[at] = old + 1e-6
            up = loss()
            values[at] = old - 1e-6
            down = loss()
            values[at] = old
            assert gradient[at] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_recurrent_columns():
    """Texts as columns give the states and gradients of texts as rows."""
    from crawlweave.llm import gru

    layers = [kind(70, 5, np.random.default_rng(4)) for kind in (gru.Gru, gru.ColumnGru)]
    rng = np.random.default_rng(1)
    x, h = rng.integers(0, 70, (9, 6)), rng.normal(size=(9, 5)).astype(np.float32)
    w = rng.normal(size=(6, 9, 5)).astype(np.float32)
    (states, kept), (columns, column_kept) = layers[0].run(x, h), layers[1].run(x, h.T)
    assert columns.transpose(0, 2, 1) == pytest.approx(states, abs=1e-5)
    assert layers[1].column_step(x[:, 0], h.T).T == pytest.approx(states[0], abs=1e-5)
    for a, b in zip(layers[0].gradient(x, kept, w), layers[1].gradient(x, column_kept, w.transpose(0, 2, 1))):
        assert b == pytest.approx(a, abs=1e-4)


def test_lm_scores_texts_side_by_side(monkeypatch):
    """Classes are worked out for many tokens at once, and no more than a step beyond PLACES, however long a text is."""
    model = lm_score.ClassFactored(np.arange(40), np.full(3, 5.0))
    rng = np.random.default_rng(6)
    lengths = [900, *rng.integers(1, 60, 200)]
    symbol = rng.integers(0, 42, sum(lengths)).astype(np.int32)
    at = np.cumsum([0, *lengths])
    monkeypatch.setattr(lm_score, "PLACES", 1000)
    sizes, plain = [], model._log_probabilities
    monkeypatch.setattr(model, "_log_probabilities", lambda states, *rest: sizes.append(states.shape[1]) or plain(states, *rest))
    together = model.score(symbol, model.groups(symbol), np.zeros(len(symbol)), at)
    assert max(sizes) < 1000 + len(lengths) and len(sizes) < 15 and sum(sizes) == len(symbol)
    alone = [model.score(symbol[a:b], model.groups(symbol[a:b]), np.zeros(b - a), np.array([0, b - a]))[0] for a, b in zip(at[:-1], at[1:])]
    assert together == pytest.approx(alone, rel=1e-5)


def test_piece_memo_is_the_library():
    """Each piece is worked out in one go over the texts; ids are the library's, also where the memory is full."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    coder = token_files._loaded.__wrapped__(TOKENIZER)
    coder.limit = 50
    rng = random.Random(8)
    parts = [*"abXYZ,.!#%_-'\n\n\r\t  19é²½ß—«ºʰ中\u0301\u00a0\u2009😀\x1c\x85", "'s", "'ll", "<|endoftext|>", "word ", "end.\nNew "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 20))) for _ in range(5000)]
    for part in (texts[:2500], texts[2500:]):
        want = [np.array(x.ids, "<u4").tobytes() for x in tokenizer.encode_batch(part, add_special_tokens=False)]
        assert coder.texts(part) == want
        assert len(coder.known) <= 50 and len(coder.heads) <= 12


def test_pieces_of_words_need_no_pattern(monkeypatch):
    """Words, marks behind them and single line ends between them never reach the pre-token pattern."""
    coder = token_files._loaded.__wrapped__(TOKENIZER)
    text = "Words, and more words% with (no) digits.\nNext line's end?"
    pieces = [p for p in text.split(" ") if p[0] != "(" and "'" not in p]
    asked = []
    monkeypatch.setattr(token_files.Memo, "forget", lambda memo, limit: asked.append(limit))
    for p in pieces:
        coder.known.work(p)
    assert len(asked) == 1  # only the line end takes the longer way


def test_checksums_of_plain_ids(spark):
    rows = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "doc_id long, ids array<int>")
    want = {1: zlib.crc32(np.array([1, 2], "<u4").tobytes()), 2: 0, 3: 0}
    assert {r.doc_id: r.ids_crc32 for r in token_files.with_checksum(rows).collect()} == want


def test_kept_text_hash(plain, texts):
    """The digest that the query derives is that of the kept text."""
    rows = line_dedup.drop_shared_lines(plain).collect()
    want = {d: t for d, _, _, t in brute.line_dedup(list(enumerate(texts)))}
    assert all(hashlib.sha256((r.text or "").encode()).hexdigest() == hashlib.sha256(want[r.doc_id].encode()).hexdigest() for r in rows)


def test_lm_learns_from_all_documents(spark):
    """What no excerpt shows is learned from the documents themselves."""
    rng = random.Random(5)
    follow = {f"w{k}": f"w{(k * 7 + 3) % 40}" for k in range(40)}
    rows = []
    for i in range(300):
        word, text = f"w{rng.randrange(40)}", ["start"]
        for _ in range(200):
            text.append(word)
            word = follow[word]
        rows.append((i, " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    scored = [r for r in lm_score.with_scores(frame, excerpts=1, chars=4, passes=4).collect() if zlib.crc32(str(r.doc_id).encode()) % 10 == 0]
    assert len(scored) > 5
    assert sum(r.score for r in scored) > 0.8 * sum(r.base_score for r in scored)


def test_lm_words_grow_with_vocabulary():
    assert lm_score.told_apart(1000) == 1024
    assert 1024 < lm_score.told_apart(10**7) < lm_score.told_apart(10**8)


def test_jaccard_index_names_a_set_in_few_bytes(spark):
    # with more buckets than n-grams of a document, what stands beside an entry decides the size of the index
    buckets, rng = 256, random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(64))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    packed = jaccard_join._postings(docs, "text", 5, buckets, {}).toArrow()
    entries = 300 * 60
    named = sum(len(s) for b, s in zip(packed["bucket"].to_pylist(), packed["sets"].to_pylist()) if b >= 0)
    assert entries / 2 < named <= entries
    assert sum(packed[c].combine_chunks().flatten().nbytes for c in ("sets", "ns")) + sum(len(c) for c in packed["counts"].to_pylist()) <= 9 * named + 13 * 300


def test_jaccard_sets_with_many_grams_in_a_bucket(spark):
    grams = np.arange(1000, dtype=np.uint64)
    owner = np.repeat(np.arange(3), [700, 1, 299])
    packed = jaccard_join._pack(np.zeros(1000, np.int64), owner, np.array([5, -7, 9], np.int64), jaccard_join._bytes_of(grams, 4), None)
    sets, index, toks = jaccard_join._unpack(packed, 4)
    assert sets[index].tolist() == np.repeat([5, -7, 9], [700, 1, 299]).tolist() and toks.tolist() == grams.tolist()
    long = [f"w{i}" for i in range(9000)]
    texts = [" ".join(long), " ".join(long[:8000]), " ".join(long[:5000]), " ".join(long[3000:] + ["x"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs).collect()}
    assert found == {0: (8996, 0), 1: (7996, 0), 2: (4996, 2), 3: (5997, 3)}
