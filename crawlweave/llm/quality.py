"""Quality rules for documents: counts of the text itself, and a likelihood ratio of hashed n-grams.

Words and pairs of neighbouring words are hashed into a fixed number of features. Two multinomials are counted over
them, one over trusted documents, one over the whole corpus; a document's score is the mean logarithm of their ratio
over its features. The corpus count of a feature leaves out the occurrence that is scored, so that a rare word says
nothing about the document it stands in. Everything is a DataFrame expression; the weights, one number for each
feature, reach the documents as the value of a scalar subquery of fixed size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from crawlweave.llm.shared import SPACES, unused_prefix, written

FEATURES = 1 << 17
PRIOR = 0.5
LEAST_SCORE = -0.25
WINDOW = 8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: str) -> Column:
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")


def feature(features: int, *words: Column) -> Column:
    """Number of a word or of a pair."""
    return F.pmod(F.xxhash64(*words), F.lit(features)).cast("int")


def _next(words: Column) -> Column:
    """The words without the first."""
    return F.slice(words, F.lit(2), F.size(words))


def _repeated(runs: Column) -> Column:
    """Words inside runs that occur at least twice; ``runs`` has the hash of the run from each word on."""

    def covered(places: Column) -> Column:
        nothing = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
        return F.aggregate(
            places,
            nothing,
            lambda acc, p: F.struct(
                (p + WINDOW).alias("upto"), (acc["n"] + p + WINDOW - F.greatest(acc["upto"], p)).alias("n")
            ),
            lambda acc: acc["n"],
        )

    def places(rows: Column) -> Column:
        same = lambda x, i, step: F.coalesce(F.get(rows, i + step)["h"] == x["h"], F.lit(False))
        again = F.filter(rows, lambda x, i: same(x, i, 1) | F.when(i > 0, same(x, i, -1)).otherwise(False))
        return F.transform(again, lambda x: x["i"])

    tagged = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return covered(F.sort_array(_let(tagged, places)))


def _with_repeat_words(df: DataFrame, words: str, name: str) -> DataFrame:
    """Hashes of runs of 1, 2, 4 and WINDOW words, each made from two of half the length, then what repeats.

    Every step is a column of its own that the next one names twice, so that it is computed once for a row.
    """
    run = unused_prefix(df) + "run"
    out = df.withColumn(run, F.transform(words, lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        length = F.greatest(F.size(run) - step, F.lit(0))
        early, later = F.slice(run, F.lit(1), length), F.slice(run, F.lit(1 + step), length)
        out = out.withColumn(run, F.zip_with(early, later, lambda a, b: F.xxhash64(a, b)))
    once = F.size(F.array_distinct(run)) == F.size(run)
    return out.withColumn(name, F.when(once, F.lit(0)).otherwise(_repeated(F.col(run))).cast("long")).drop(run)


def with_counts(df: DataFrame, text: str, words: str) -> DataFrame:
    """The base columns of a text: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``.

    Null counts as empty, all its counts are 0 and it fails. ``words`` names a column with the text's words.
    Columns of these names are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    full = F.filter(F.split(body, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    counted = (
        df.withColumn("n_words", F.size(words).cast("long"))
        .withColumn("word_chars", F.char_length(F.array_join(words, "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long"))
        .withColumn("n_dup_lines", _let(full, lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
    )
    counted = _with_repeat_words(counted, words, "n_repeat_words")
    return counted.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def feature_weights(
    df: DataFrame, trusted: DataFrame, doc: str = "doc_id", text: str = "text", features: int = FEATURES, prior: float = PRIOR
) -> DataFrame:
    """One row, one column: the weight of each feature, an array of ``features`` numbers.

    ``trusted`` has the ids of the trusted documents in its first column. Counts cover all rows of ``df``. Without any
    trusted text all weights are 0.
    """
    ids = trusted.select(F.col(trusted.columns[0]).alias("_trusted")).where(F.col("_trusted").isNotNull()).distinct()
    # one way for every size: a sort-merge join, where a broadcast of the ids would depend on how many there are
    rows = df.select(F.col(doc).alias("_doc"), F.col(text).alias("_text")).join(ids.hint("merge"), F.col("_doc") == F.col("_trusted"), "left")
    words = words_of("_text")
    pairs = F.arrays_zip(words.alias("a"), _next(words).alias("b"))
    exploded = rows.select(F.col("_trusted").isNotNull().cast("long").alias("_good"), F.explode(pairs).alias("_w"))
    both = feature(features, F.col("_w.a")), F.when(F.col("_w.b").isNotNull(), feature(features, F.col("_w.a"), F.col("_w.b")))
    hashed = exploded.select("_good", *[c.alias(f"_f{k}") for k, c in enumerate(both)])
    hashed = hashed.select("_good", F.stack(F.lit(2), "_f0", "_f1").alias("feature")).where(F.col("feature").isNotNull())
    counts = written(hashed.groupBy("feature").agg(F.count(F.lit(1)).alias("raw"), F.sum("_good").alias("good")), "feature-counts")
    all_raw, all_good = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    spark = df.sparkSession
    full = spark.range(features).select(F.col("id").cast("int").alias("feature")).join(counts, "feature", "left")
    good = F.log((F.coalesce("good", F.lit(0)) + prior) / F.lit(all_good + prior * features))
    raw = F.log((F.greatest(F.coalesce("raw", F.lit(0)) - 1, F.lit(0)) + prior) / F.lit(all_raw + prior * features))
    weight = good - raw if all_good else F.lit(0.0)
    ordered = F.sort_array(F.collect_list(F.struct("feature", weight.alias("weight"))))
    return full.agg(F.transform(ordered, lambda x: x["weight"]).alias("weights"))


def with_quality(
    df: DataFrame,
    trusted: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    least: float = LEAST_SCORE,
    features: int = FEATURES,
    prior: float = PRIOR,
) -> DataFrame:
    """Add the base columns, ``score`` and ``kept``: false if the base rules fail, else whether the score reaches ``least``.

    The score is the mean weight of a text's features, 0 for a text without words. Each row is judged on its own, so
    repeated rows and rows without an id are judged too. Columns of the added names are replaced.
    """
    own = unused_prefix(df)
    words, weights = own + "words", own + "weights"
    one = written(feature_weights(df, trusted, doc, text, features, prior), "feature-weights")
    rows = with_counts(df.withColumn(words, words_of(text)), text, words)
    rows = rows.withColumn(weights, one.scalar())  # last, as every step copies a row with all its columns
    of = lambda *parts: F.get(weights, feature(features, *parts))
    word, n = F.col(words), F.size(words)
    parts = F.zip_with(word, _next(word), lambda a, b: of(a) + F.when(b.isNotNull(), of(a, b)).otherwise(0.0))
    mean = F.when(n == 0, F.lit(0.0)).otherwise(F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x) / (2 * n - 1))
    scored = rows.withColumn("score", mean)
    judged = scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    # out of a generator: a filter on these columns would else be moved below and compute every step again for each use
    found = F.inline(F.array(F.struct(*added)))
    return judged.select(*[F.col(f"`{c}`") for c in df.columns if c not in added], found)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled good and not toxic."""
    return labels.where("quality = 1 AND toxic = 0").select("doc_id")
