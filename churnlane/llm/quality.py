"""Quality rules: surface counts, and a hashed n-gram likelihood ratio of trusted against raw text.

Surface rules count words, their characters, symbols, repeated lines and the
words of repeated ``REPEAT``-word windows in every text, inside its row: words and
windows are hashed first, and only a text with equal hashes sorts its windows'
words (so equality is of the words, not of hashes).

The language model half: every text's one- and two-word n-grams are hashed into
``BUCKETS`` buckets, from the same hashes of the words.  The raw multinomial counts
all documents, the trusted one those that the labels call good (``FIT`` in 256
of them by a hash of the id; the others stay unseen).  A bucket's weight is the
logarithm of the trusted over the raw probability, the trusted one smoothed by
the raw one with ``PRIOR`` pseudo-counts, in integers of ``2**-20``, so that
sums don't depend on their order.  A document's score is its weights' sum over
its number of n-grams.  The cut is halfway between the mean scores of the unseen
good and the labelled bad documents; every document below it is dropped, the same way each time
(no sampling).  Weights travel as one row of BUCKETS numbers.

Defined results: null text has no words; texts of fewer words than a rule's
window have no such windows; texts without n-grams score 0; labels of null id or
null value are ignored, several labels of one id count as good if more than half
are; without good or without bad labels there is no cut and only the rules
decide; repeated rows are judged one by one; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlane.llm.common import discard, let, recorded, small, stage, steps

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
REPEAT, MIN_WORDS, MAX_REPEATED = 5, 10, 20       # words of a window, least words, percent of words in repeated windows
BUCKETS, PRIOR, FIT = 1 << 16, 1 << 14, 205       # a power of two
ONE = 1 << 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def repeated_words(w: Column, h: Column, size: int = REPEAT) -> Column:
    """How many of the words ``w`` (hashes ``h``) are in a window of ``size`` words that stands there twice or more."""
    starts = steps(F.size(w) - (size - 1))
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))

    def exactly(starts: Column) -> Column:
        by_words = F.sort_array(F.transform(starts, lambda i: F.struct(
            F.array_join(F.slice(w, i + 1, size), " ").alias("w"), i.alias("i"))))
        same = lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))
        twins = lambda s: F.transform(F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1))), lambda x: x["i"])
        covered = lambda spots: F.aggregate(spots, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda s, i: F.struct(
            (s["n"] + F.least(F.lit(size), i + size - s["end"])).alias("n"), (i + size).alias("end")))["n"]
        return covered(F.sort_array(let(by_words, twins)))

    return let(windows, lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), F.lit(0)).otherwise(let(starts, exactly))).cast("long")


def repeated_lines(text: Column) -> Column:
    """How many lines with a word equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def rules(text: Column, w: Column, h: Column) -> list[Column]:
    """The surface counts of a text, its words and their hashes."""
    full = F.coalesce(text, F.lit(""))
    return [F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(full) - F.length(F.regexp_replace(full, f"[{SYMBOLS}]+", ""))).cast("long").alias("n_symbols"),
            repeated_lines(text).alias("n_dup_lines"), repeated_words(w, h).alias("n_repeat_words")]


def _pair(h: Column, i: Column, buckets: int) -> Column:
    """Bucket of the two words from ``i``; ``buckets`` is a power of two."""
    return F.xxhash64(F.get(h, i), F.get(h, i + 1)).bitwiseAND(buckets - 1).cast("int")


def ngrams(h: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the one- and two-word n-grams of a text, from its words' hashes."""
    return F.concat(F.transform(h, lambda x: x.bitwiseAND(buckets - 1).cast("int")),
                    F.transform(steps(F.size(h) - 1), lambda i: _pair(h, i, buckets)))


def score_sum(h: Column, weights: Column, buckets: int = BUCKETS) -> Column:
    """Sum of the n-grams' weights."""
    zero = F.lit(0).cast("long")
    return (F.aggregate(h, zero, lambda s, x: s + F.get(weights, x.bitwiseAND(buckets - 1).cast("int")))
            + F.aggregate(steps(F.size(h) - 1), zero, lambda s, i: s + F.get(weights, _pair(h, i, buckets))))


def good_labels(labels: DataFrame, id_col: str, good_col: str) -> DataFrame:
    """(key, good, fit): one row a labelled id."""
    return (labels.select(F.col(id_col).alias("key"), F.col(good_col).cast("int").alias("v")).dropna()
            .groupBy("key").agg((2 * F.sum(F.when(F.col("v") > 0, 1).otherwise(0)) > F.count("*")).alias("good"))
            .withColumn("fit", F.col("good") & (F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(256)) < FIT)))


def bucket_weights(grams: DataFrame, buckets: int = BUCKETS, prior: int = PRIOR) -> DataFrame:
    """One row: ``weights``, the integer log-ratio of each bucket, from rows of (grams, fit).  Buckets without n-grams: 0."""
    counts = stage(grams.select(F.explode("grams").alias("b"), F.col("fit").cast("long").alias("t"))
                   .groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("trusted")), "quality-counts")
    totals = counts.agg(F.sum("raw").alias("all_raw"), F.sum("trusted").alias("all_trusted"))
    ratio = (F.col("trusted") * F.col("all_raw") / F.col("raw") + prior) / (F.col("all_trusted") + prior)
    weights = counts.join(F.broadcast(totals)).select("b", F.round(F.log(ratio) * ONE).cast("long").alias("weight"))
    every = grams.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b")).join(weights, "b", "left")
    listed = F.sort_array(F.collect_list(F.struct("b", F.coalesce("weight", F.lit(0).cast("long")).alias("weight"))))
    return every.agg(listed["weight"].alias("weights"))


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
                  good_col: str = "quality", buckets: int = BUCKETS, prior: int = PRIOR) -> DataFrame:
    """One row per row of ``docs``: id, the counts of ``rules``, base_failed, score, cut, kept."""
    with recorded() as used:
        known = stage(good_labels(labels, label_id_col, good_col), "quality-labels")
        rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                .join(small(known, known.count()), F.col("id") == F.col("key"), "left").drop("key"))
        fit = F.coalesce("fit", F.lit(False)).alias("fit")
        grams = rows.select(let(hashes(words(F.col("text"))), lambda h: ngrams(h, buckets)).alias("grams"), fit)
        weights = stage(bucket_weights(grams, buckets, prior), "quality-weights")

        # One row of ``buckets`` numbers beside every document: its n-grams are looked up and added in place.
        of_words = lambda w: let(hashes(w), lambda h: F.struct(
            *rules(F.col("text"), w, h), score_sum(h, F.col("weights"), buckets).alias("sum")))
        found = rows.join(F.broadcast(weights)).select("id", fit, "good", let(words(F.col("text")), of_words).alias("f"))
    judged = stage(found.select("id", "fit", "good", "f.*"), "quality-rows")
    discard(docs.sparkSession, used)
    judged = judged.withColumn("n", F.greatest(2 * F.col("n_words") - 1, F.lit(0)))
    judged = judged.withColumn("score", F.when(F.col("n") > 0, F.col("sum") / (F.col("n") * F.lit(float(ONE))))
                               .otherwise(F.lit(0.0)))
    mean = lambda of: F.try_divide(F.sum(F.when(of, F.round(F.col("score") * ONE).cast("long"))), F.sum(F.when(of, 1)))
    cut = judged.agg((mean(F.col("good") & ~F.col("fit")) + mean(~F.col("good"))).alias("twice")).select(
        (F.col("twice") / (2 * ONE)).alias("cut"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return judged.join(F.broadcast(cut)).withColumn("base_failed", failed).select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "cut",
        (~F.col("base_failed") & F.coalesce(F.col("score") >= F.col("cut"), F.lit(True))).alias("kept"))
