"""Inputs that used to give wrong answers or no end: ids beside nulls, mixed scripts, few words, malformed pages."""

import random
import re
import string
import time
from datetime import datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlane.llm import decontaminate, exact_dedup, language, licenses, pseudonyms, quality, simhash, vector_codes, wrappers
from churnlane.llm.common import read
from tests.conftest import SF_SMALL

R = random.Random(23)
BIG = [2**53 + 1, None, 2**53 + 3, 2**63 - 1, -(2**63), None, 7]


def texts(n):
    return [" ".join(R.choice(["the", "mit", "license", "of", "a", "4539 1488 0343 6467", "word"]) for _ in range(20)) for _ in range(n)]


def results(docs, key):
    """The ids that each Python operator gives back."""
    pages = docs.select(F.col(key).alias("page_id"), F.lit("http://a.org/x").alias("url"), F.col("text").alias("html"))
    labels = docs.select(F.col(key), F.lit(1).alias("quality"))
    yield "wrappers", wrappers.extract(pages)
    yield "pseudonyms", pseudonyms.pseudonymise(docs, "k", id_col=key)
    yield "simhash", simhash.near_groups(docs, id_col=key)
    yield "licenses", licenses.scan_licenses(docs, id_col=key)
    yield "exact", exact_dedup.exact_groups(docs, id_col=key)
    yield "language", language.predict_languages(docs, id_col=key)
    yield "quality", quality.judge_quality(docs, labels, id_col=key, label_id_col=key)
    vectors = docs.select(key, F.array(F.length("text").cast("float"), F.lit(1.0).cast("float")).alias("embedding"), F.lit(1).alias("label"))
    yield "codes", vector_codes.compress(vectors, id_col=key)[0]


def test_ids_come_back_unchanged(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in zip(BIG, texts(len(BIG)))], "doc_id long, text string, lang string").coalesce(1)
    for name, out in results(docs, "doc_id"):
        assert sorted((r.id for r in out.collect()), key=repr) == sorted(BIG, key=repr), name
    other = [(str(i), Decimal(10**30 + i), datetime(2000, 1, 1 + i, 3, 4, 5, 6), bytes([i])) for i in range(5)] + [(None, None, None, None)]
    rows = [(*o, t, "en") for o, t in zip(other, texts(6))]
    docs = spark.createDataFrame(rows, "s string, d decimal(38,0), t timestamp, b binary, text string, lang string").coalesce(1)
    for k, key in enumerate("sdtb"):
        for name, out in [("wrappers", wrappers.extract(docs.select(F.col(key).alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html")))),
                          ("pseudonyms", pseudonyms.pseudonymise(docs, "k", id_col=key)), ("licenses", licenses.scan_licenses(docs, id_col=key)),
                          ("simhash", simhash.near_groups(docs, id_col=key))]:
            plain = [bytes(r.id) if key == "b" and r.id is not None else r.id for r in out.collect()]
            assert sorted(map(repr, plain)) == sorted(repr(o[k]) for o in other), (name, key)


def test_near_copies_keep_the_smallest_large_id(spark):
    t = texts(1)[0]
    docs = spark.createDataFrame([(2**53 + 3, t, 1), (None, t, 2), (2**53 + 2, t, 3), (2**53 + 1, t, 4)], "doc_id long, text string, rid int").coalesce(1)
    assert [(r.doc_id, r.rid) for r in simhash.drop_near_copies(docs).collect()] == [(2**53 + 1, 4)]
    assert {r.component_id for r in simhash.near_groups(docs).collect()} == {2**53 + 1}


# ---- language -----------------------------------------------------------------------------------------------------------

def test_long_runs_and_other_scripts_do_not_decide(spark):
    d = read(spark, SF_SMALL.replace("sf0.001", "sf0.01"), "documents")
    base = d.filter("lang <> 'de' AND length(text) > 3000").select(F.col("lang").alias("true"), F.substring("text", 1, 5000).alias("text")).limit(30).collect()
    ends = ["", " " + "漢字" * 60, " " + "qzxj" * 40, " " + "x" * 3000, " нельзя" * 12, " " + "日本" * 2000]
    rows = [(i * 100 + k, r.text + e, None, r.true) for i, r in enumerate(base) for k, e in enumerate(ends)]
    asked = spark.createDataFrame(rows, "doc_id long, text string, lang string, true string")
    model = language.fit(spark, language.learnable(d), F.col("text"), F.col("lang"), F.col("doc_id"))
    got = language.identify(asked, model, "text").collect()
    plain = {r.doc_id // 100: r.lang_pred for r in got if r.doc_id % 100 == 0}
    assert np.mean([plain[r.doc_id // 100] == r.true for r in got]) > 0.95
    assert all(r.lang_pred == plain[r.doc_id // 100] and 0 < r.score <= 1 for r in got)
    alone = language.predict_texts(["日" * 80, "日" * 5000, "qzxj" * 900], {"langs": model.langs, "pieces": model.pieces, "prob": model.prob})
    assert all(0 < s <= 1 and not np.isnan(s) for s in alone[1]) and max(alone[1][:2]) < 0.999


def test_a_tie_of_languages_and_whole_words():
    pieces = sorted(["▁", "a", "b", "ab"])
    prob = language.piece_shares(np.ones((5, 3)))
    pred, score = language.predict_texts(["ab ba " * 500, "é" * 4000], {"langs": ["x", "y", "z"], "pieces": pieces, "prob": prob})
    assert pred == ["x", "x"] and score == pytest.approx([1 / 3, 1 / 3])
    trie = language.Trie(pieces)
    long = language.word_scores(["ab" * 3000], trie, prob)[0, 0]
    slow = [0.0]                                      # the same sum in exact logarithms, over positions of "▁abab.."
    word = "▁" + "ab" * 3000
    for j in range(1, len(word) + 1):
        ways = [slow[j - n] + np.log(prob[pieces.index(word[j - n:j]), 0]) for n in (1, 2) if n <= j and word[j - n:j] in pieces]
        slow.append(float(np.logaddexp.reduce(ways)))
    assert long == pytest.approx(slow[-1], rel=1e-9)


def test_languages_are_bounded(spark):
    rows = [(i, "alpha beta gamma", f"l{i % 40:02d}") for i in range(400)] + [(1000 + i, "delta epsilon", "zz") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(spark, docs, F.col("text"), F.col("lang"), F.col("doc_id"), max_langs=3)
    assert model.langs == ["l00", "l01", "zz"] and model.prob.shape[1] == 3


# ---- decontamination ----------------------------------------------------------------------------------------------------

def slow_contamination(docs, items, window=13):
    def words(t):
        return re.sub("[^0-9a-z\x80-\U0010ffff]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")).split()
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        at = {}
        for n in {min(window, len(words(x))) for _, x in items} - {0}:
            for s in range(len(w) - n + 1):
                at.setdefault(tuple(w[s:s + n]), []).append(s)
        for item, x in items:
            v = words(x)
            n = min(window, len(v))
            for s in range(len(v) - n + 1 if n else 0):
                for p in at.get(tuple(v[s:s + n]), ()):
                    hit.update(range(p, p + n))
                    found.add(str(item))
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def test_few_words_and_short_items(spark):
    items = [(k, " ".join(R.choice("abc") for _ in range(n))) for k, n in enumerate([3, 1, 13, 14, 40, 7, 4, 5, 300])] + [(9, "zz"), (10, ""), (11, None)]
    docs = [(i, " ".join(R.choice("abcd"[: 2 + i % 3]) for _ in range(n))) for i, n in enumerate([0, 1, 2, 5, 12, 13, 14, 60, 200, 800])]
    docs += [(20, items[8][1]), (21, items[8][1].upper() + "!"), (22, None), (22, None), (23, "a, zz b")]
    for window in (13, 4):
        got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                          spark.createDataFrame(items, "item_id long, text string"), window=window).collect()
        assert sorted(((r.id, r.n_words, r.n_hit, r["items"]) for r in got), key=repr) == sorted(slow_contamination(docs, items, window), key=repr)


def test_candidates_stay_linear(spark):
    """20,000 words over a vocabulary of three against an item of 2,000 such words."""
    words = lambda n: " ".join(R.choice(["ab", "cd", "ef"]) for _ in range(n))
    item = words(2000)
    docs = spark.createDataFrame([(1, words(20000)), (2, item + " " + words(18000))], "doc_id long, text string")
    t = time.time()
    got = {r.id: r.n_hit for r in decontaminate.contamination(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got[2] >= 2000 and time.time() - t < 60


# ---- pages --------------------------------------------------------------------------------------------------------------

def slow_parse_time(page):
    t = time.process_time()
    root, _ = wrappers.parse(page)
    root.children = wrappers.fold(root.children, {})
    shape, _ = wrappers.flatten(root)
    wrappers.read_tree(shape)
    return time.process_time() - t


@pytest.mark.parametrize("make", [
    lambda n: "<a " * n, lambda n: "<a " * n + ">", lambda n: '<a "' * n + ">x", lambda n: "<b>" * n + "</i>" * n,
    lambda n: "<b>" * n + "<p>x</p>" * n, lambda n: "<i><article>" + "<b>" * n + "</i>" * n, lambda n: "<b>" * n + "t<hr>" * n,
    lambda n: "<div x=1 " + "a" * (20 * n) + ">", lambda n: "<div>" * n + "x", lambda n: "<ul>" + "<li>x<b>" * n, lambda n: "<!--" * n,
    lambda n: "<![CDATA[" * n, lambda n: "".join(f"<div class={'ab'[i % 2]}><ul><li>x</ul></div>" for i in range(n))])
def test_parsing_is_linear(make):
    slow_parse_time(make(100))
    assert slow_parse_time(make(40000)) < 12 * max(slow_parse_time(make(8000)), 0.05)


def test_alignment_is_linear_and_knows_equal_trees():
    def tree(n, kids, step):
        return "html(" + " ".join(f"div.{'ab'[i * step % 2 if step % 2 else (i * 7 + i // 3) % 2]}({kids})" for i in range(n)) + ")"
    a, b = tree(8000, "ul", 1), tree(8000, "ul p", 2)
    t = time.process_time()
    assert wrappers.align(a, a) == tuple(range(16001))
    assert sum(i >= 0 for i in wrappers.align(a, b)) > 12000 and time.process_time() - t < 20


def test_pages_of_any_bytes(spark):
    tags = ["b))", "em!", "p~", "x.y", "div", "a(", "li", "article", "main", "td", "custom-el", "h1", "1", "ß", "span"]
    odd = string.punctuation + " \n\t\0é𝒳"
    def junk(n):
        out = []
        for _ in range(n):
            k = R.randrange(6)
            tag = R.choice(tags)
            value = "".join(R.choice(odd + "adshare") for _ in range(R.randrange(8)))
            out.append([f"<{tag}>", f"</{tag}>", f"<{tag} class=\"{value}\">", f"<{tag} id={value}", value, f"<!--{value}"][k] if k < 5 or R.random() < .1 else "word ")
        return "".join(out)
    pages = [(i, f"http://h{i % 4}.org/", junk(R.randrange(1, 120))) for i in range(300)]
    pages += [(300, "http://h.org/", '<b)) class="ad">x</b))>'), (301, "http://z.org/", "<p>an <em!>important</em!> word</p>")]
    got = {r.id: r.text for r in wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert len(got) == 302 and got[301] == "an important word"


def test_titles_and_inline_words_stay(spark):
    body = [" ".join(R.choice(["kab", "lost", "mund", "rest"]) + str(R.randrange(99)) for _ in range(30)) for _ in range(4)]
    kinds = [lambda b, i: f"<main><h1>T{i}</h1><article><p>{b}</p></article><p>end {i}</p></main>",
             lambda b, i: f"<body><nav>n</nav><h1>T{i}</h1><article><p>{b}</p></article></body>",
             lambda b, i: f'<article><p>so <b class="share">bold{i}</b> and <span class="note related">word{i}</span> {b}</p></article>']
    pages = [(10 * k + i, f"http://k{k}.org/{i}", f(b, i)) for k, f in enumerate(kinds) for i, b in enumerate(body)]
    got = {r.id: r.text for r in wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i, b in enumerate(body):
        assert got[i] == f"T{i} {b} end {i}" and got[10 + i] == f"T{i} {b}" and got[20 + i] == f"so bold{i} and word{i} {b}"
