"""Language ID by segmentation-marginalised unigrams.

A fixed public vocabulary gives the pieces; each language has a probability
for every piece.  A word's probability is the sum over all ways to cut it into
pieces (the forward algorithm); a text's is the product over its words.  Words
are runs of letters, lower-cased, with the vocabulary's word-start mark before
them; letters without a piece use one shared unknown piece.

The unknown piece is as likely in every language, and in a text any word may be
noise (even letters, with probability ``NOISE``), so letters of other scripts and
runs that no language explains tell nothing.  Sums run in logarithms, position by position: words of any length
are scored whole, and no product gets too small for a double.

Fitting is expectation maximisation on word counts from a bounded sample of
labelled rows: the ``MAX_LANGS`` languages with most labelled rows, and at most
``SAMPLE_PER_LANG`` documents a language, chosen by a hash of their id and read
whole.  The expectation step is a Spark job; the driver sees one number per
language and piece.  The vocabulary's path is a parameter, or the session's
``churnlane.vocabulary``.  Prediction reads every whole
text; each Python worker keeps scores of words it has met (a bounded memo).

Defined results: null texts and texts without a letter are ``und`` with score
0, and so is every text if no labelled row can be learned from; ties go to
the alphabetically first language (a tie of all n has score 1/n); rows with a null language or id are not
learned from; repeated rows are judged one by one; extra columns stay as they
are; empty tables give empty tables.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from churnlane.llm.common import discard, recorded, ship, stage

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLE_PER_LANG = 600
ROUNDS = 3
SMOOTHING = 0.01
MARK = "▁"
WORD = re.compile(r"[^\W\d_]+")
MAX_LANGS = 256
NOISE, ALPHABET = 0.01, 32 # share of words that are no words, and how many letters these draw from evenly
MEMO_WORDS = 200_000       # words a worker remembers
STEP_WORDS = 8_000         # words whose lattices are built at once


def load_pieces(path: str = VOCABULARY) -> list[str]:
    """Lower-case letter pieces of a SentencePiece vocabulary, with or without the word-start mark."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    return sorted(p for p in pieces if p == p.lower() and (p == MARK or p.lstrip(MARK).isalpha()) and MARK not in p[1:])


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Trie:
    """The pieces as arrays: ``first[letter]`` and ``after[node, letter]`` give the next node, 0 if there is none."""

    def __init__(self, pieces: list[str]):
        nodes: dict[str, int] = {}
        for p in pieces:
            for n in range(1, len(p) + 1):
                nodes.setdefault(p[:n], len(nodes) + 1)
        later = sorted({c for p in pieces for c in p[1:]})
        self.code = np.zeros(0x110000, np.int16)               # of letters that follow others, from 1
        self.code[[ord(c) for c in later]] = np.arange(1, len(later) + 1)
        self.first = np.zeros(0x110000, np.int32)
        inner = sorted({q[:-1] for q in nodes if len(q) > 1})
        self.row = np.zeros(len(nodes) + 1, np.int32)          # of ``after``; 0 has no successor
        self.row[[nodes[q] for q in inner]] = np.arange(1, len(inner) + 1)
        self.after = np.zeros((len(inner) + 1, len(later) + 1), np.int32)
        for q, n in nodes.items():
            if len(q) == 1:
                self.first[ord(q)] = n
            else:
                self.after[self.row[nodes[q[:-1]]], self.code[ord(q[-1])]] = n
        self.piece = np.full(len(nodes) + 1, -1, np.int32)
        self.piece[[nodes[p] for p in pieces]] = np.arange(len(pieces))


def lattice(words: list[str], trie: Trie, unknown: int) -> tuple[np.ndarray, ...]:
    """Every piece that fits anywhere in every word: word, start, end, piece; by length, then by place."""
    flat = np.frombuffer((MARK + MARK.join(words)).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = trie.code[flat]
    begins = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
    word_at = np.repeat(np.arange(len(words)), np.diff(begins, append=len(flat)))
    at, node = np.arange(len(flat)), trie.first[flat]
    starts, lengths, pieces = [], [], []
    length = 1
    while len(at):
        piece = trie.piece[node]
        fits = piece >= 0
        if length == 1:                                        # a letter without a piece
            piece, fits = np.where(fits, piece, unknown), np.ones(len(at), bool)
        starts.append(at[fits])
        pieces.append(piece[fits])
        lengths.append(np.full(int(fits.sum()), length, np.int32))
        row = trie.row[node]
        more = (row > 0) & (at + length < len(flat))           # the mark of the next word follows no letter
        at, row = at[more], row[more]
        node = trie.after[row, code[at + length]]
        at, node = at[node > 0], node[node > 0]
        length += 1
    at, lengths = np.concatenate(starts), np.concatenate(lengths)
    word = word_at[at]
    start = at - begins[word]
    return word, start, start + lengths, np.concatenate(pieces)


def _blocks(by: np.ndarray, arcs: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Order of the arcs by ``by``, then length, and the borders of blocks in which no word occurs twice."""
    order = np.argsort(by.astype(np.int16) if np.abs(by).max() < 1 << 15 else by, kind="stable")    # short keys sort by radix
    length = (arcs[2] - arcs[1])[order]
    key = by[order].astype(np.int64) * 100_000 + length
    return order, np.flatnonzero(np.diff(key, prepend=key[0] - 1, append=key[-1] + 1))


def forward(n_words: int, longest: int, arcs: tuple, log_prob: np.ndarray) -> np.ndarray:
    """Log probability of every prefix of every word, summed over its segmentations: [word, end, language]."""
    word, start, end, piece = arcs
    order, cuts = _blocks(end, arcs)
    alpha = np.full((n_words, longest + 2, log_prob.shape[1]), -np.inf)
    alpha[:, 0] = 0
    word, start, end, piece = word[order], start[order], end[order], piece[order]
    for a, b in zip(cuts[:-1], cuts[1:]):
        i, j, w = start[a], end[a], word[a:b]
        if j - i == 1:                     # every place has an arc of one letter, and it comes first
            alpha[w, j] = alpha[w, i] + log_prob[piece[a:b]]
        else:
            alpha[w, j] = np.logaddexp(alpha[w, j], alpha[w, i] + log_prob[piece[a:b]])
    return alpha


def word_scores(words: list[str], trie: Trie, prob: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language (``prob``: pieces and the unknown one, by language)."""
    scores, log_prob = np.empty((len(words), prob.shape[1])), np.log(prob)
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    at = 0
    while at < len(order):
        longest = len(words[order[min(at + STEP_WORDS, len(order)) - 1]])
        step = max(1, STEP_WORDS * 24 // max(24, longest))
        some = order[at: at + step]
        at += step
        chosen = [words[k] for k in some]
        lengths = np.array([len(w) for w in chosen])
        alpha = forward(len(chosen), int(lengths.max()), lattice(chosen, trie, len(prob) - 1), log_prob)
        scores[some] = alpha[np.arange(len(chosen)), lengths + 1]
    return scores


def with_noise(scores: np.ndarray, words: list[str]) -> np.ndarray:
    """``scores`` where any word may be noise, the same in all languages: long runs that no language explains tell nothing."""
    length = np.fromiter(map(len, words), np.int64, len(words))[:, None] + 1
    return np.logaddexp(scores, np.log(NOISE) - length * np.log(ALPHABET))


def expected_counts(words: list[str], counts: np.ndarray, trie: Trie, prob: np.ndarray) -> np.ndarray:
    """Expected uses of every piece (rows as in ``prob``) in ``counts`` copies of the words; one language."""
    total, log_prob = np.zeros(len(prob)), np.log(prob)
    for at in range(0, len(words), STEP_WORDS):
        chosen = words[at: at + STEP_WORDS]
        lengths = np.array([len(w) for w in chosen])
        longest = int(lengths.max())
        arcs = lattice(chosen, trie, len(prob) - 1)
        word, start, end, piece = arcs
        alpha = forward(len(chosen), longest, arcs, log_prob)[:, :, 0]
        beta = np.full((len(chosen), longest + 2), -np.inf)
        beta[np.arange(len(chosen)), lengths + 1] = 0
        gain = log_prob[piece, 0]
        order, cuts = _blocks(-start, arcs)
        for a, b in zip(cuts[:-1], cuts[1:]):
            arc = order[a:b]
            to = word[arc], start[arc[0]]
            beta[to] = np.logaddexp(beta[to], gain[arc] + beta[word[arc], end[arc]])
        share = np.exp(alpha[word, start] + gain + beta[word, end] - alpha[np.arange(len(chosen)), lengths + 1][word])
        total += np.bincount(piece, weights=share * counts[at: at + STEP_WORDS][word], minlength=len(prob))
    return total


class LanguageModel:
    """Languages, pieces and the piece probabilities of each language (last row: the unknown piece)."""

    def __init__(self, langs: list[str], pieces: list[str], prob: np.ndarray):
        self.langs, self.pieces, self.prob = langs, pieces, prob


def piece_shares(counts: np.ndarray) -> np.ndarray:
    """Smoothed shares of each language's pieces; the unknown piece (last row) has one share for all languages."""
    smooth = counts + SMOOTHING
    unknown = smooth[-1].sum() / smooth.sum()
    return np.vstack([smooth[:-1] / smooth[:-1].sum(axis=0) * (1 - unknown), np.full(counts.shape[1], unknown)])


def fit(spark: SparkSession, labelled: DataFrame, text: Column, lang: Column, key: Column,
        vocabulary: str | None = None, per_lang: int = SAMPLE_PER_LANG, rounds: int = ROUNDS, max_langs: int = MAX_LANGS) -> LanguageModel:
    """Fit on ``labelled``'s rows with a language, ``per_lang`` of each of at most ``max_langs`` languages (smallest hash of ``key``)."""
    ship()
    place = (F.xxhash64(key).bitwiseAND((1 << 62) - 1) / float(1 << 62)).alias("place")      # uniform in [0, 1)
    rows = labelled.select(lang.alias("lang"), place, text.alias("text")).filter("lang is not null and text is not null")
    with recorded() as used:
        totals = stage(rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs)
                       .select("lang", (F.lit(1.5 * per_lang) / F.col("n")).alias("share")), "lid-langs")
        first = Window.partitionBy("lang").orderBy("place")          # over some 1.5 samples a language
        sample = (rows.join(F.broadcast(totals), "lang").filter("place < share")
                  .withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_lang).select("lang", "text"))

        def count(batches):
            for pdf in batches:
                c: Counter = Counter()
                for g, t in zip(pdf["lang"], pdf["text"]):
                    c.update((g, w) for w in words_of(t))
                yield pd.DataFrame([(g, w, n) for (g, w), n in c.items()], columns=["lang", "word", "n"])

        words = stage(sample.mapInPandas(count, "lang string, word string, n long")
                      .groupBy("lang", "word").agg(F.sum("n").alias("n")), "lid-words")
        langs = sorted(r[0] for r in words.select("lang").distinct().collect())
        pieces = load_pieces(vocabulary or spark.conf.get("churnlane.vocabulary", VOCABULARY))
        prob = np.full((len(pieces) + 1, len(langs)), 1.0 / (len(pieces) + 1))
        for _ in range(rounds if langs else 0):
            now = spark.sparkContext.broadcast({"pieces": pieces, "prob": prob, "langs": langs})

            def expect(batches, now=now):
                m = now.value
                trie = m["trie"] = m.get("trie") or Trie(m["pieces"])
                for pdf in batches:
                    for g, part in pdf.groupby("lang"):
                        p = m["prob"][:, [m["langs"].index(g)]]
                        e = expected_counts(part["word"].tolist(), part["n"].to_numpy(float), trie, p)
                        used = np.flatnonzero(e)
                        yield pd.DataFrame({"lang": g, "piece": used, "e": e[used]})

            totals = words.mapInPandas(expect, "lang string, piece long, e double").groupBy("lang", "piece").agg(
                F.sum("e").alias("e")).toPandas()          # languages x pieces rows at most
            counts = np.zeros_like(prob)
            counts[totals["piece"], [langs.index(g) for g in totals["lang"]]] = totals["e"]
            prob = piece_shares(counts)
    discard(spark, used)
    return LanguageModel(langs, pieces, prob)


def predict_texts(texts, m: dict) -> tuple[list[str], list[float]]:
    """Language and score of each text; ``m`` holds the model and keeps the trie and the word memo."""
    langs = m["langs"]
    if "trie" not in m:
        m["trie"] = Trie(m["pieces"])
        m["memo"], m["scores"] = {}, np.empty((0, len(langs)))
    memo, pred, score = m["memo"], ["und"] * len(texts), [0.0] * len(texts)
    for at in range(0, len(texts), 500):
        owned, flat = [], []
        for k in range(at, min(at + 500, len(texts))):
            t = texts[k]
            w = words_of(t) if t and langs else ()
            if w and (w[0].isalpha() or any(map(str.isalpha, t))):
                owned.append((k, len(w)))
                flat.extend(w)
        if not flat:
            continue
        new = [w for w in dict.fromkeys(flat) if w not in memo]
        if new:
            if len(memo) + len(new) > MEMO_WORDS:
                memo.clear()
                m["scores"], new = m["scores"][:0], list(dict.fromkeys(flat))
            memo.update(zip(new, range(len(memo), len(memo) + len(new))))
            m["scores"] = np.concatenate([m["scores"], with_noise(word_scores(new, m["trie"], m["prob"]), new)])
        each = m["scores"][np.fromiter(map(memo.__getitem__, flat), np.int64, len(flat))]
        lengths = np.array([n for _, n in owned])
        total = np.add.reduceat(each, np.concatenate(([0], np.cumsum(lengths)[:-1])), axis=0)
        best = total.argmax(axis=1)
        posterior = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        for (k, _), b, p in zip(owned, best, posterior):
            pred[k], score[k] = langs[b], min(1.0, float(p))
    return pred, score


def identify(rows: DataFrame, model: LanguageModel, text_col: str, in_row: bool = False) -> DataFrame:
    """``rows`` with lang_pred and score; ``in_row``: the text is the field ``text_col`` of the struct ``row``."""
    ship()
    m = rows.sparkSession.sparkContext.broadcast({"langs": model.langs, "pieces": model.pieces, "prob": model.prob})

    def judge(batches):
        for b in batches:
            texts = b.column("row").field(text_col) if in_row else b.column(text_col)
            pred, score = predict_texts(texts.to_pylist(), m.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             [*b.schema.names, "lang_pred", "score"])
    schema = StructType([*rows.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(judge, schema)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def learnable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learned from: a known id whose checksum is not the held-out remainder."""
    return docs.filter(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      **fit_options) -> DataFrame:
    """id, held_out, lang_pred, score for every row; learned from the rows that are not held out."""
    model = fit(docs.sparkSession, learnable(docs, id_col), F.col(text_col), F.col(lang_col), F.col(id_col), **fit_options)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return identify(rows, model, "text").select("id", held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def drop_unidentified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      **fit_options) -> DataFrame:
    """``docs`` without the rows whose language cannot be told (``und``), all columns as they were."""
    model = fit(docs.sparkSession, learnable(docs, id_col), F.col(text_col), F.col(lang_col), F.col(id_col), **fit_options)
    rows = docs.select(F.struct("*").alias("row"))
    return identify(rows, model, text_col, in_row=True).filter("lang_pred <> 'und'").select("row.*")
