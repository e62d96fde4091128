"""Benchmark decontamination as a prefix-filtered containment join.

Items are cut into windows of ``WINDOW`` words (a shorter item is one window).
The tokens of a window are its shingles of ``SHINGLE`` words (of the whole
window, if it is shorter), ordered by rarity over the whole corpus.
Containment of a window needs every one of its shingles, so its necessary
prefix is its rarest shingle alone.  One pass over the documents lists where
they have a shingle of the benchmark; joined with the prefixes, each such place
fixes where a window would start.  Starts before the document or ends beyond it
fall away (positional and length bounds); the rest, each start and length once,
are verified exactly: the words there are joined with the windows' words.
A document word inside any verified occurrence is hit.

A document has at most WINDOW candidates a word and window length, however few
different words it has, and candidates carry no text before they are verified.

The benchmark is the query set; its tables are broadcast only while their
counted rows are within ``MAX_BROADCAST_ROWS`` and shuffle-joined beyond.

Defined results: null or wordless texts have no words and are never
contaminated; wordless items have no windows; a null item id counts as '';
rows of one item id are one item; repeated documents are judged one by one;
an empty benchmark hits nothing; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlane.llm.common import discard, free_name, let, recorded, small, stage, steps, word_text

WINDOW, SHINGLE = 13, 5
#: A document is contaminated if it has a hit and at least one word in SHARE is hit.
SHARE = 20


def _sha(text_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, text, len): the distinct windows of every item."""
    words = F.split(word_text(F.col(text_col)), " ")
    items = (benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words.alias("w"))
             .filter("w[0] <> ''"))
    starts = items.select("item", "w", F.explode(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1)))).alias("at"))
    cut = F.slice("w", F.col("at"), window)
    return starts.select("item", F.array_join(cut, " ").alias("text"), F.size(cut).alias("len")).distinct()


def shingles(w: Column, n_words: Column, size: int) -> Column:
    """The hash of each run of ``size`` words; equal hashes are candidates only."""
    return F.transform(steps(n_words - (size - 1)), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: rid, id, sha (of the text), n_words, n_hit, items (sorted strings), contaminated."""
    norm = word_text(F.col(text_col))
    n_words = F.when(F.col("norm") == "", F.lit(0)).otherwise(
        F.length("norm") - F.length(F.replace(F.col("norm"), F.lit(" "), F.lit(""))) + 1)
    rows = stage(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), _sha(text_col).alias("sha"),
                             norm.alias("norm"))
                 .withColumn("n_words", n_words.cast("long")), "decon-rows")
    with recorded() as used:
        owned = stage(item_windows(benchmark, item_col, item_text_col, window)
                      .withColumn("class", F.md5("text")), "decon-items")
        classes = stage(owned.select("class", "text", "len").distinct(), "decon-windows")
        sizes = [r[0] for r in classes.select(F.least("len", F.lit(shingle)).alias("size")).distinct().collect()]    # at most ``shingle``

        # Every window's shingles and where they stand, and every place of a document that has one of them.
        def listed(line: Column, n: Column, size: int) -> Column:
            return F.posexplode(let(F.split(line, " "), lambda w: shingles(w, n, size))).alias("pos", "h")
        none = rows.select("rid", "n_words", F.lit(0).alias("size"), F.lit(0).alias("pos"), F.lit(0).cast("long").alias("h")).limit(0)
        at_window, at_doc = None, none
        for size in sizes:
            mine = classes.filter(F.least("len", F.lit(shingle)) == size).select("class", "len", F.lit(size).alias("size"),
                                                                                listed(F.col("text"), F.col("len"), size))
            at_window = mine if at_window is None else at_window.unionByName(mine)
        if at_window is None:
            discard(docs.sparkSession, used)
            return rows.select("rid", "id", "sha", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"),
                               F.lit(False).alias("contaminated"))
        at_window = stage(at_window, "decon-shingles")
        vocabulary = at_window.select("size", "h").distinct()
        known = vocabulary.count()
        for size in sizes:
            words_at = rows.select("rid", "n_words", F.lit(size).alias("size"), listed(F.col("norm"), F.col("n_words"), size))
            at_doc = at_doc.unionByName(words_at.join(small(vocabulary.filter(F.col("size") == size).drop("size"), known), "h", "left_semi"))
        places = stage(at_doc, "decon-places")
        rarity = places.groupBy("size", "h").agg(F.count("*").alias("n"))
        rarest = (at_window.join(rarity, ["size", "h"], "left").groupBy("class", "len", "size")
                  .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "pos")).alias("key")).filter("key.n > 0"))
        prefix = stage(rarest.select("size", F.col("key.h").alias("h"), F.col("key.pos").alias("offset"), "len").distinct(), "decon-prefix")
        start = F.col("pos") - F.col("offset")
        asked = stage(places.join(small(prefix, prefix.count()), ["size", "h"]).filter((start >= 0) & (start + F.col("len") <= F.col("n_words")))
                      .groupBy("rid").agg(F.collect_set(F.struct(start.alias("start"), "len")).alias("asked")), "decon-candidates")

        # Verification: the document's words from each start against the windows' words.
        texts = rows.select("rid", "norm").join(small(asked.select("rid"), asked.count()), "rid", "left_semi").join(asked, "rid")
        cut = texts.select("rid", F.explode(let(F.split("norm", " "), lambda w: F.transform("asked", lambda c: F.struct(
            c["start"].alias("start"), c["len"].alias("len"), F.array_join(F.slice(w, c["start"] + 1, c["len"]), " ").alias("text"))))).alias("c"))
        found = stage(cut.select("rid", "c.*").join(small(classes, classes.count()), ["text", "len"]).select("rid", "start", "len", "class"),
                      "decon-found")
        spans = F.array_sort(F.collect_set(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("len")).alias("b"))))
        covered = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["end"]))).alias("n"),
            F.greatest(s["end"], x["b"]).alias("end")))
        hits = found.groupBy("rid").agg(spans.alias("spans")).select("rid", covered["n"].cast("long").alias("n_hit"))
        items = (found.select("rid", "class").distinct().join(owned.select("class", "item"), "class")
                 .groupBy("rid").agg(F.array_sort(F.collect_set("item")).alias("items")))
    result = stage(hits.join(items, "rid"), "decon-result")
    discard(docs.sparkSession, used)
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.drop("norm").join(result, "rid", "left").select(
        "rid", "id", "sha", "n_words", hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((hit > 0) & (SHARE * hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without its contaminated rows, all columns as they were.

    Contamination depends on the text alone, so the contaminated texts' hashes decide.
    """
    with recorded() as used:
        judged = contamination(docs, benchmark, id_col, text_col, item_col, item_text_col, window)
        bad = judged.filter("contaminated").select("sha").distinct()
    bad = stage(bad, "decon-drop")
    discard(docs.sparkSession, used)
    sha = free_name(docs, "sha")
    return docs.withColumn(sha, _sha(text_col)).join(
        small(bad.withColumnRenamed("sha", sha), bad.count()), sha, "left_anti").select(*docs.columns)
