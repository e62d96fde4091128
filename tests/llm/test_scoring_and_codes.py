"""Quality ratio, vector codes and source divergence against brute force, on hand-made rows and whole tables."""

import hashlib
import math
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from churnlane.llm import divergence, quality, vector_codes
from churnlane.llm.common import read
from tests.conftest import SF_SMALL

R = random.Random(11)
BIG = 2**53 + 1


# ---- quality ------------------------------------------------------------------------------------------------------------

def slow_rules(text):
    text = text or ""
    w = re.findall("[^\x20\t-\r]+", text)
    windows = defaultdict(list)
    for i in range(len(w) - 4):
        windows[tuple(w[i:i + 5])].append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\t-\r]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


def slow_grams(text, buckets):
    one = [xxhash.xxh64_intdigest(x.encode(), 42) for x in re.findall("[^\x20\t-\r]+", text or "")]
    def two(a, b):
        return xxhash.xxh64_intdigest(struct.pack("<Q", b), xxhash.xxh64_intdigest(struct.pack("<Q", a), 42))
    return [h % buckets for h in one + [two(a, b) for a, b in zip(one, one[1:])]]


def slow_quality(docs, labels, buckets, prior):
    votes = defaultdict(list)
    for i, v in labels:
        if i is not None and v is not None:
            votes[i].append(v > 0)
    good = {i: 2 * sum(v) > len(v) for i, v in votes.items()}
    def signed(h):
        return h - 2**64 if h >> 63 else h
    fit = {i for i, g in good.items() if g and signed(xxhash.xxh64_intdigest(str(i).encode(), 42)) % 256 < quality.FIT}
    raw, trusted = Counter(), Counter()
    for i, t in docs:
        raw.update(slow_grams(t, buckets))
        if i in fit:
            trusted.update(slow_grams(t, buckets))
    n, m = sum(raw.values()), sum(trusted.values())
    weight = {b: round(math.log((trusted[b] * n / raw[b] + prior) / (m + prior)) * quality.ONE) for b in raw}
    scores = []
    for i, t in docs:
        g = slow_grams(t, buckets)
        scores.append(sum(weight[b] for b in g) / (len(g) * quality.ONE) if g else 0.0)
    unseen = [s for (i, _), s in zip(docs, scores) if good.get(i) and i not in fit]
    bad = [s for (i, _), s in zip(docs, scores) if good.get(i) is False]
    cut = (sum(unseen) / len(unseen) + sum(bad) / len(bad)) / 2 if unseen and bad else None
    out = []
    for (i, t), s in zip(docs, scores):
        r = slow_rules(t)
        failed = r[0] < 10 or 100 * r[4] > 20 * r[0]
        out.append((i, *r, failed, s, cut, not failed and (cut is None or s >= cut)))
    return out


def quality_rows():
    words = ["the", "of", "And", "straße", "naïve", "𝒳y", "x#y", "|", "in,", "on."]
    texts = [None, "", " \n\t", "one", "a b c d e a b c d e", "a a a a a a a", "\n\n", "x\nx\n x\nx\r\nx\n",
             " ".join(f"w{i}" for i in range(3000)) + " w1 w2 w3 w4 w5", "ab " * 4000, "a b c d e f a b c d e g b c d e f",
             "İ ı ẞ     \x0b z" * 4, "z" * 30000]
    texts += [" ".join(R.choice(words) for _ in range(R.randrange(1, 60))) for _ in range(60)]
    texts += ["\n".join(R.choice(["u v", "u", "", "v w"]) for _ in range(R.randrange(12))) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (None, "null id"), (BIG, texts[15]), (BIG, texts[15]), (3, "again")]
    labels = [(i, R.choice([0, 1, 1, None])) for i in range(0, 90, 1)] + [(None, 1), (BIG, 0), (20, 1), (20, 1), (999, 1)]
    return rows, labels


@pytest.mark.parametrize("labelled", [True, False])
def test_quality_brute_force(spark, labelled):
    rows, labels = quality_rows()
    labels = labels if labelled else []
    docs = spark.createDataFrame([(i, t, "l", 1, "k") for i, t in rows], "doc_id long, text string, line string, good int, key string").repartition(4)
    got = quality.judge_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"), buckets=256, prior=300).collect()
    want = slow_quality(rows, labels, 256, 300)
    key = lambda r: (repr(r[0]), r[1:7], r[7])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:7] for g in got] == [w[:7] for w in want]
    assert [g[9] for g in got] == [w[9] for w in want]
    for g, w in zip(got, want):
        assert g[7] == pytest.approx(w[7], abs=1e-5)
        assert (g[8] is None) == (w[8] is None) and (w[8] is None or g[8] == pytest.approx(w[8], abs=1e-5))


def test_quality_query_against_brute_force(spark):
    from churnlane.llm import queries
    docs = [(r.doc_id, r.text) for r in read(spark, SF_SMALL, "documents").collect()]
    labels = [(r.doc_id, r.quality) for r in read(spark, SF_SMALL, "labels").collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op11_quality_ratio"](spark, SF_SMALL).collect()}
    want = slow_quality(docs, labels, quality.BUCKETS, quality.PRIOR)
    assert len(got) == len(want)
    for i, n, chars, symbols, lines, repeats, failed, score, cut, kept in want:
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == (n, chars, symbols, lines, repeats, failed)
        assert g.score == pytest.approx(score, abs=1e-5) and (g.kept == kept or abs(score - cut) < 1e-5)


def test_quality_tells_unseen_labels_apart(spark):
    """Documents whose labels were not fitted on: bad ones go, good ones stay."""
    sf = SF_SMALL.replace("sf0.001", "sf0.1")
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    fit = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    judged = quality.judge_quality(docs, labels.filter(fit)).join(labels.filter(~fit), F.col("id") == F.col("doc_id"))
    share = {r.quality: r for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.avg(
        F.expr("CAST(NOT base_failed AND NOT kept AS int)")).alias("by_score")).collect()}
    assert share[0].kept < 0.06 and share[1].kept > 0.97 and share[1].by_score < 0.002, share


def test_quality_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality.judge_quality(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == 0


# ---- vector codes -------------------------------------------------------------------------------------------------------

def slow_codes(rows, parts, entries, rounds):
    """rows: (id, label, vector) of one length, kept ones only, in starting order.  Codes, errors, codebooks."""
    x = [[math.floor(1024 * v) if abs(v) < 2**50 else int(v) * 1024 for v in r[2]] for r in rows]
    d = len(x[0])
    cut = [(p * d // parts, (p + 1) * d // parts) for p in range(parts)]
    books = [[v[a:b] for v in x[:entries]] for a, b in cut]
    for r in range(rounds + 1):
        near = [[min((sum((s - t) ** 2 for s, t in zip(v[a:b], e)), j) for j, e in enumerate(books[p])) for p, (a, b) in enumerate(cut)] for v in x]
        if r == rounds:
            break
        for p, (a, b) in enumerate(cut):
            for j in range(len(books[p])):
                mine = [v[a:b] for v, n in zip(x, near) if n[p][1] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    return ["".join(f"{j:02x}" for _, j in n) for n in near], [min(sum(e for e, _ in n), 2**63 - 1) for n in near], books


def vectors(kind, n=300, d=10):
    r = np.random.default_rng(3)
    if kind == "clusters":
        v = r.normal(0, 0.02, (n, d)) + r.normal(0, 1, (12, d))[r.integers(0, 12, n)]
    elif kind == "ties":
        v = r.integers(-2, 3, (n, d)) / 1024
    else:
        v = r.normal(0, 0.3, (n, d))
        v[5, 2], v[40, 7], v[41, 7], v[77, 0] = 1e30, -3e38, 3e38, 2.0**24
    return v.astype(np.float32)


@pytest.mark.parametrize("kind", ["clusters", "ties", "wide"])
def test_codes_brute_force(spark, kind):
    v = vectors(kind)
    rows = [(i, [3, None, i % 7][i % 3], list(map(float, x))) for i, x in enumerate(v)]
    rows += [rows[4], (None, 3, list(map(float, v[9]))), (BIG, None, list(map(float, v[3])))]
    odd = [(500, 1, None), (501, 1, [1.0] * 9 + [None]), (502, 1, [float("nan")] * 10), (503, 1, [float("-inf")] * 10)]
    df = spark.createDataFrame(rows + odd, "vec_id long, label int, embedding array<float>").withColumn("v", F.lit(1)).withColumn(
        "best", F.lit(2)).repartition(5)
    coded, books = vector_codes.compress(df, entries=20)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    codes, errors, want_books = slow_codes(order, 4, 20, 4)
    assert books == want_books
    got = vector_codes.with_label_errors(coded).collect()
    total = Counter()
    for r, e in zip(order, errors):
        total[r[1]] += e
    want = [(r[0], r[1], c, e, min(total[r[1]], 2**63 - 1)) for r, c, e in zip(order, codes, errors)]
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], r[1], r[2], r[3], r[4]) for r in want), key=repr)


def test_codes_of_odd_tables(spark):
    schema = "vec_id long, label int, embedding array<float>"
    coded, books = vector_codes.compress(spark.createDataFrame([], schema))
    assert coded.count() == 0 and books == [[]] * 4
    coded, _ = vector_codes.compress(spark.createDataFrame([(None, 1, [0.5] * 8), (None, 1, None)], schema))
    assert [(r.id, r.code, r.error) for r in coded.collect()] == [(None, "00000000", 0)]
    coded, _ = vector_codes.compress(spark.createDataFrame([(1, 1, [0.5] * 8), (2, 1, [0.5] * 7), (3, 1, [])], schema))
    assert sorted((r.id, r.code, r.error) for r in coded.collect()) == [(1, "00000000", 0), (2, None, None), (3, None, None)]


def test_net_displacement_saves_scans():
    """Bounds hold (results equal a full scan) and skip scans; net moves are never above accumulated ones."""
    x = vector_codes.integers(vectors("clusters", 2000, 4))
    books = [vector_codes.Book([[int(c) for c in v] for v in x[:64]])]
    best, bound, stamp = np.full(len(x), -1), np.zeros((len(x), 8)), np.zeros((len(x), 8), np.int64)
    scans = []
    for _ in range(5):
        error, n = vector_codes.assign(x, best, bound, stamp, books, 8)
        full = ((x[:, None, :] - books[-1].c[None]) ** 2).sum(axis=2)
        assert (best == full.argmin(axis=1)).all() and error == full.min(axis=1).astype(int).tolist()
        others = np.sqrt(full)
        others[np.arange(len(x)), best] = np.inf
        now = stamp == len(books) - 1
        assert (bound[now] <= others.reshape(len(x), 8, 8).min(axis=2)[now]).all()
        scans.append(n)
        sums = [[math.floor(c) for c in x[best == j].mean(axis=0)] if (best == j).any() else list(map(int, books[-1].exact[j])) for j in range(64)]
        books.append(vector_codes.Book(sums))
    assert scans[0] == 2000 * 8 and scans[-1] < scans[0] / 2
    net = np.sqrt(((books[-1].c - books[0].c) ** 2).sum(axis=1))
    added = sum(np.sqrt(((b.c - a.c) ** 2).sum(axis=1)) for a, b in zip(books, books[1:]))
    assert (net <= added + 1e-6).all() and (net < added - 1).any()


# ---- divergence ---------------------------------------------------------------------------------------------------------

def slow_divergence(rows, min_docs, top):
    counts, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang or "", source or ""].update(w)
        df[lang or ""].update(set(w))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)
        def price(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}
        q, p = price(whole), {s: price(c) for s, c in groups.items()}
        for s, c in groups.items():
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            terms = [(-(p[s][t] - q[t]), t.encode()) for t in kept if c[t] > 0 and p[s][t] > q[t]]
            out += [(lang, s, "pair", o.decode(), -v, k) for k, (v, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t.decode(), -v, k) for k, (v, t) in enumerate(sorted(terms)[:top], 1)]
    return out


@pytest.mark.parametrize("leaves,chunk", [(4096, 32), (8, 2), (4, 1)])
def test_divergence_brute_force(spark, leaves, chunk):
    vocab = [a + b for a in "abcdé" for b in "xyzß𝒳"] + ["I", "ı", "ﬀ"]
    rows = [(" ".join(R.choice(vocab[: 5 + 4 * (i % 6)]) for _ in range(R.randrange(0, 25))).title(), ["en", "de", None][i % 3], f"s{i % 7}")
            for i in range(240)]
    rows += [(None, "en", "silent"), ("", "fr", None), ("rare words only", "fr", "one"), (None, None, None), rows[0], rows[0],
             ("ax " * 5000, "en", "s1"), ("a-x_A.X 7É", "en", "s2")]
    docs = spark.createDataFrame([(i, *r, 9, 9, "k") for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, idx int, n int, term string").repartition(4)
    got = divergence.source_divergence(docs, min_docs=9, top=6, leaves=leaves, chunk=chunk).collect()
    assert sorted(map(tuple, got)) == sorted(slow_divergence(rows, 9, 6))


def test_divergence_empty(spark):
    assert divergence.source_divergence(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_equal_subtrees_are_priced_once():
    counts = np.zeros((3, 1024), np.int64)
    counts[0, 5], counts[1, 900], counts[2, ::2] = 3, 1, 7
    leaves, levels, roots = divergence.trees(counts)
    assert len(leaves) == 4 and sum(len(left) for left, _ in levels) < 40
    prices = np.stack([divergence.leaf_prices(leaves, t, 1024) for t in (3, 1, 3584)])
    a, b = np.array([0, 0, 1]), np.array([1, 2, 2])
    value, met = divergence.walk(levels, roots, prices, a, b)
    for k, (i, j) in enumerate(zip(a, b)):
        p, q = (np.array([1 + 10**9 * (int(c) + 5) // (int(counts[s].sum()) + 5 * 1024) for c in counts[s]]) for s in (i, j))
        assert value[k] == np.abs(p - q).sum()
    assert met < 150                                   # of 3 * 2047 places in the trees


def test_prices_of_huge_counts():
    c = np.array([-1, 0, 10**15], np.int64)
    assert divergence.leaf_prices(c, 3 * 10**15, 7).tolist() == [0, 1 + 5 * 10**9 // (3 * 10**15 + 35), 1 + 10**9 * (10**15 + 5) // (3 * 10**15 + 35)]


def test_codebook_digest():
    assert vector_codes.codebooks_sha256([[[1, -2], [3, 4]], [[5], [6]]]) == hashlib.sha256(b"1,-2,3,4,5,6").hexdigest()
