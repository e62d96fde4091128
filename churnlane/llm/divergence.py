"""Source divergence audit over hash-consed segment trees of term counts.

Each language keeps the terms that at least ``min_docs`` of its documents hold;
a kept term's id is its position among them.  A source's counts over the ids
are a segment tree whose equal subtrees are one node (hash-consing: a node is
known by its children's numbers, a leaf by its count).  Two sources' distance is
found by walking both trees at once, a level at a time; each distinct pair of
nodes that the walk meets is expanded and priced once and its price is shared by
all the places where the pair stands (for sparse counts nearly all of them).

Terms are counted once, in Python dictionaries that are handed on when they hold
``HELD`` terms, with the number of documents that hold each.  The trees are cut below their top levels: a task holds one block of ``LEAVES``
ids of two chunks of ``CHUNK`` sources, whatever the size of a language, a
source or the vocabulary, and prices of blocks are added up afterwards.  Counts
are aggregated before every shuffle.  Prices are integers:
``1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))``.

Defined results: null text, language and source are ''; a group without terms
is still a group; a language without kept terms has pairs of value 0 and no
term rows; repeated rows count each; equal values are ranked by item in byte
order; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlane.llm.common import discard, recorded, ship, stage
from churnlane.operators.ordering import row_position

MIN_DOCS, TOP, SCALE, PRIOR = 30, 50, 10**9, 5
LEAVES, CHUNK = 4096, 32       # ids and sources (of either side) that one task holds
_PAIRS = 64                    # pairs of sources walked at once
HELD = 500_000                 # terms that a task counts before it hands its counts on
#: Byte by byte: A-Z lower-cased, a-z and all bytes of non-ASCII characters kept, the rest blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
VOID = -1                      # leaf beyond the last id


def count_terms(batches):
    """Arrow batches of (lang, source, text) to (lang, source, term, n, n_docs), aggregated within a task as far as ``HELD`` allows."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def counted():
        rows = [(g, s, t, c, docs[t]) for (g, s), (n, docs) in held.items() for t, c in n.items()]
        lang, source, term, n, n_docs = zip(*rows) if rows else ((),) * 5
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()),
                                           pa.array(n, pa.int64()), pa.array(n_docs, pa.int64())], names=["lang", "source", "term", "n", "n_docs"])
    for b in batches:
        texts = b.column("text").cast(pa.binary()).to_pylist()
        for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), texts):
            words = text.translate(LETTERS).split()
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            n.update(words)
            docs.update(set(words))
            size += len(n) - before
            if size >= HELD:
                yield counted()
                held, size = {}, 0
    yield counted()


def shrunk(count: str, total: str, kept: str) -> Column:
    """The integer price of a count of one group, exact at any size."""
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + {PRIOR} AS DECIMAL(20,0))"
                  f" DIV CAST({total} + {PRIOR} * {kept} AS DECIMAL(20,0))")


def leaf_prices(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """``shrunk`` of each distinct leaf of a block; 0 beyond the last id."""
    d = int(total) + PRIOR * int(kept)
    if int(counts.max(initial=0)) + PRIOR < 2**63 // SCALE:
        p = 1 + SCALE * (counts + PRIOR) // d
    else:
        p = np.array([1 + SCALE * (int(c) + PRIOR) // d for c in counts], np.int64)
    return np.where(counts == VOID, 0, p)


def trees(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Hash-consed trees of the rows of ``counts`` (a power of two wide).

    The distinct leaves, for each level above them the (left, right) children
    of its distinct nodes, and each row's root.
    """
    leaves, ids = np.unique(counts, return_inverse=True)
    ids, below, levels = ids.reshape(counts.shape), len(leaves), []
    while ids.shape[1] > 1:
        nodes, at = np.unique(ids[:, 0::2] * below + ids[:, 1::2], return_inverse=True)
        levels.append((nodes // below, nodes % below))
        ids, below = at.reshape(len(ids), -1), len(nodes)
    return leaves, levels, ids[:, 0]


def walk(levels, roots: np.ndarray, prices: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, int]:
    """Sum over all leaves of ``abs(price - price)`` for each pair of rows, and how many node pairs were expanded.

    ``prices``: row by distinct leaf.
    """
    pair, x, y = np.arange(len(a)), roots[a], roots[b]
    seen, met = [], len(a)
    for k in range(len(levels) - 1, -1, -1):
        left, right = levels[k]
        below = len(levels[k - 1][0]) if k else prices.shape[1]
        wanted = ((np.concatenate([pair, pair]) * below + np.concatenate([left[x], right[x]])) * below
                  + np.concatenate([left[y], right[y]]))
        once, at = np.unique(wanted, return_inverse=True)
        seen.append(at)
        met += len(once)
        pair, x, y = once // (below * below), once // below % below, once % below
    value = np.abs(prices[a[pair], x] - prices[b[pair], y])
    for at in reversed(seen):
        both = value[at]
        value = both[: len(at) // 2] + both[len(at) // 2:]
    return value, met


def _price_block(leaves: int):
    def price(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, block, i, j = key
        rows = rows.sort_values("idx", ignore_index=True)
        kept = int(rows["kept"][0])
        width = min(leaves, kept - int(block) * leaves)
        counts = np.full((len(rows), 1 << max(0, width - 1).bit_length()), VOID, np.int64)
        counts[:, :width] = 0
        for r, (ids, ns) in enumerate(zip(rows["ids"], rows["ns"])):
            counts[r, np.asarray(ids, np.int64)] = np.asarray(ns, np.int64)
        distinct, levels, roots = trees(counts)
        prices = np.stack([leaf_prices(distinct, t, kept) for t in rows["total"]])
        chunk, idx = rows["chunk"].to_numpy(), rows["idx"].to_numpy()
        a, b = np.nonzero((chunk == i)[:, None] & (chunk == j)[None, :] & (idx[:, None] < idx[None, :]))
        value = [walk(levels, roots, prices, a[at: at + _PAIRS], b[at: at + _PAIRS])[0] for at in range(0, len(a), _PAIRS)]
        return pd.DataFrame({"lang": lang, "a": idx[a], "b": idx[b],
                             "value": np.concatenate(value) if value else np.empty(0, np.int64)})
    return price


def _numbered(df: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` numbered from 0 within their lang, in the order of ``key``: ``idx``; ``n_lang`` rows in the lang."""
    at = row_position(df, "lang", "position", (key,))
    langs = at.groupBy("lang").agg(F.min("position").alias("first"), F.count("*").alias("n_lang"))
    return at.join(langs, "lang").withColumn("idx", F.col("position") - F.col("first")).drop("position", "first")


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = MIN_DOCS, top: int = TOP, leaves: int = LEAVES, chunk: int = CHUNK) -> DataFrame:
    """Rows of lang, source, part (``pair`` or ``term``), item, value, rank."""
    ship()
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), empty(text_col).alias("text"))

    with recorded() as used:
        every = stage(rows.mapInArrow(count_terms, "lang string, source string, term string, n long, n_docs long")
                      .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")), "divergence-all")
    kept = (every.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"))
            .filter(F.col("n_docs") >= min_docs).select("lang", "term"))
    kept = stage(_numbered(kept, "term").select("lang", "term", F.col("idx").alias("id")), "divergence-terms")
    counts = stage(every.drop("n_docs").join(kept, ["lang", "term"]), "divergence-counts")
    discard(docs.sparkSession, used)
    langs = stage(counts.groupBy("lang").agg(F.sum("n").alias("lang_total"))
                  .join(kept.groupBy("lang").agg(F.count("*").alias("kept")), "lang"), "divergence-langs")
    groups = _numbered(rows.select("lang", "source").distinct(), "source").withColumnRenamed("n_lang", "sources")
    groups = stage(groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
                   .join(langs, "lang", "left").na.fill(0, ["total", "lang_total", "kept"])
                   .withColumn("chunk", F.expr(f"idx DIV {chunk}")), "divergence-groups")

    # A row for each source and block; each goes to the chunk pairs that its chunk is in.
    packed = (counts.groupBy("lang", "source", F.expr(f"id DIV {leaves}").alias("block"))
              .agg(F.collect_list(F.struct((F.col("id") % leaves).alias("id"), "n")).alias("e")))
    grid = groups.filter("kept > 0").withColumn("block", F.explode(F.expr(f"sequence(0L, (kept - 1) DIV {leaves})")))
    none = F.array().cast("array<bigint>")
    dealt = grid.join(packed, ["lang", "source", "block"], "left").select(
        "lang", "block", "idx", "chunk", "kept", "total", F.coalesce("e.id", none).alias("ids"), F.coalesce("e.n", none).alias("ns"),
        F.explode(F.expr(f"transform(sequence(0L, (sources - 1) DIV {chunk}), x -> struct(least(chunk, x) AS i, greatest(chunk, x) AS j))")).alias("to"))
    priced = (dealt.select("*", "to.i", "to.j").drop("to").groupBy("lang", "block", "i", "j")
              .applyInPandas(_price_block(leaves), "lang string, a long, b long, value long")
              .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))

    one, two = (groups.select("lang", F.col("source").alias(s), F.col("idx").alias(i)) for s, i in (("source", "x"), ("item", "y")))
    pairs = (one.join(two, "lang").filter("x <> y").withColumn("a", F.least("x", "y")).withColumn("b", F.greatest("x", "y"))
             .join(priced, ["lang", "a", "b"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")))
    by_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    above = (counts.select("lang", "source", "term", "n").join(by_lang, ["lang", "term"])
             .join(groups.select("lang", "source", "total", "lang_total", "kept"), ["lang", "source"])
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     (shrunk("n", "total", "kept") - shrunk("lang_n", "lang_total", "kept")).alias("value")).filter("value > 0"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return pairs.select("*", rank).unionByName(above.select("*", rank).filter(F.col("rank") <= top))


def oracle(min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    price = lambda n, total: f"1 + {SCALE}::HUGEINT * ({n} + {PRIOR}) // ({total} + {PRIOR} * v)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= {min_docs}),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
lc AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
ln AS (SELECT lang, sum(n) AS total FROM lc GROUP BY lang),
g AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, {price('coalesce(c.n, 0)', 'g.total')} AS p
    FROM g JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
q AS (SELECT lc.lang, lc.term, {price('lc.n', 'ln.total')} AS q FROM lc JOIN ln USING (lang) JOIN sizes USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (SELECT x.lang, x.source AS s1, y.source AS s2, sum(abs(x.p - y.p)) AS value
        FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s1 = a.source AND s2 = b.source),
above AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM above) WHERE rank <= {top}"""
