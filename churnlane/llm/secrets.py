"""Secret scan with a randomness test battery.

Base patterns (assignments, access keys, long hex runs) give base spans.  The
method adds runs of 20 or more characters of an encoding alphabet that are too
random for ordinary text.  The encoding is inferred from the characters used
(hex, base32, base62, base64).  Three statistics are taken over that alphabet:
chi-squared against uniform use, runs (changes of character class, or of the
alphabet's halves where there is but one class) and lag-1 serial correlation.

Each is compared with what ordinary strings of that *length* give: identifiers
and words use few characters, change class seldom and are serially tied.  The
three standard scores are summed.  What that sum is for ordinary strings, the
corpus itself tells: its *wordy* candidates (most of whose letters stand in
word-like pieces: paths, slugs, compound names) give mean and spread of the sum,
which has the scores' dependence in it, for each class of length and encoding; a class
with fewer than ``MIN_WORDY`` of them takes its encoding's, else fixed ones.  The p-value is how
likely an ordinary string of this class looks this random.  Benjamini-Hochberg then
controls the share of false findings at ``FDR`` within each class, over all
candidates of the corpus, with the share of wordy candidates beyond a
threshold in place of its p-value where that is larger (so tails heavier than
the normal one count).  P-values are counted in bins: the control is
a small aggregate that grows with nothing.  Wordy candidates are never findings;
``false_share`` says how many passed a threshold.

Native: one pass over the texts; candidates are staged without them.

Defined results: a null text counts as empty and has no spans; positions are
code points; repeated rows are scanned one by one; empty tables give empty
tables; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlane.llm.common import stage

#: Base kinds in the order in which ties at one start are listed (fixed values).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
CANDIDATE = "[A-Za-z0-9+/_-]{20,}={0,2}"
FDR = 0.01
BINS = 60          # bins of -log2(p)
MIN_WORDY, WORDY = 30, 0.6     # wordy candidates that tell of their class; share of a candidate's characters in word-like pieces
_UNIT = 1000       # scores are added up in thousandths, so that sums don't depend on their order
#: encoding: alphabet pattern, size, and how far ordinary strings are from uniform use (k * sum of squared shares - 1)
ENCODINGS = (("hex", "[0-9a-f]+|[0-9A-F]+", "0123456789abcdef", 0.6),
             ("base32", "[A-Z2-7]+=*", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 1.1),
             ("base62", "[A-Za-z0-9]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 3.0),
             ("base64", ".*", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 3.2))
TEXT_CHANGES = {"hex": 0.35, "base32": 0.3, "base62": 0.4, "base64": 0.4}      # share of class changes in ordinary strings
TEXT_SERIAL = 0.35                                                            # their serial correlation


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, also where lambdas in ``use`` read it often."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _positions(found: Column, text: Column, pattern: str) -> Column:
    """Array of (start, end) of ``found``, the matches of ``pattern``: running sums over gaps and matches.

    A fold copies the list that it has for each new entry, so n matches are
    taken in blocks of the square root of n, each from where its block starts.
    """
    gaps = F.split(text, pattern, -1)
    sizes = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m")))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def fold(part: Column, at: Column) -> Column:
        return F.aggregate(part, F.struct(at.alias("at"), none.alias("out")), lambda s, x: F.struct(
            (s["at"] + x["g"] + x["m"]).alias("at"), F.concat(s["out"], F.array(F.struct(
                (s["at"] + x["g"]).alias("start"), (s["at"] + x["g"] + x["m"]).alias("end")))).alias("out")))["out"]

    def in_blocks(z: Column) -> Column:
        step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(z).cast("double"))).cast("int"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(z) - 1) / step).cast("int"))
        block = lambda b: F.slice(z, b * step + 1, step)
        lengths = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0), lambda t, x: t + x["g"] + x["m"]))
        return _bind(lengths, lambda le: F.flatten(F.transform(
            blocks, lambda b: fold(block(b), F.aggregate(F.slice(le, F.lit(1), b), F.lit(0), lambda t, x: t + x)))))
    return F.when(F.size(found) > 0, _bind(sizes, in_blocks)).otherwise(none)


def _normal_tail(z: Column) -> Column:
    """P(Z > z) by a rational approximation (absolute error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def encoding_of(token: Column) -> Column:
    e = F.lit(ENCODINGS[-1][0])
    for name, pattern, _, _ in reversed(ENCODINGS[:-1]):
        e = F.when(token.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(e)
    return e


def randomness(tokens: DataFrame) -> DataFrame:
    """Adds encoding, n, z_chi, z_runs, z_serial and p (under the fixed null of independent scores) to rows with a ``token``."""
    pick = lambda values: F.coalesce(*[F.when(F.col("encoding") == k, F.lit(v)) for k, v in values.items()])
    plain = F.when(F.col("encoding") == "hex", F.lower("token")).otherwise(F.translate("token", "-_=", "+/"))
    t = tokens.withColumn("encoding", encoding_of(F.col("token"))).withColumn("plain", plain)
    t = t.withColumn("alphabet", pick({e[0]: e[2] for e in ENCODINGS})).withColumn("delta", pick({e[0]: e[3] for e in ENCODINGS}))
    t = t.withColumn("changes0", pick(TEXT_CHANGES)).withColumn("n", F.length("plain")).withColumn("k", F.length("alphabet"))
    squares = F.aggregate(F.array_distinct(F.split("plain", "(?<=.)(?=.)")), F.lit(0.0), lambda a, c: a + F.pow(
        (F.col("n") - F.length(F.replace(F.col("plain"), c, F.lit("")))).cast("double"), F.lit(2.0)))
    chi = F.col("k") * squares / F.col("n") - F.col("n")
    mean = (F.col("k") - 1) + (F.col("n") - 1) * F.col("delta")
    z_chi = (mean - F.col("chi")) / F.sqrt(2 * (F.col("k") - 1) + 4 * (F.col("n") - 1) * F.col("delta"))
    classes = F.translate("plain", ENCODINGS[-1][2], "U" * 26 + "l" * 26 + "d" * 10 + "ss")
    changes = F.regexp_count(classes, F.lit("U(?=[lds])|l(?=[Uds])|d(?=[Uls])|s(?=[Uld])"))
    moves = F.col("n") - 1
    z_runs = (F.col("changes") - moves * F.col("changes0")) / F.sqrt(moves * F.col("changes0") * (1 - F.col("changes0")))
    places = F.transform(F.split("plain", "(?<=.)(?=.)"), lambda c: F.instr(F.col("alphabet"), c).cast("double"))
    mu = F.aggregate("x", F.lit(0.0), lambda a, v: a + v) / F.col("n")
    pairs = F.zip_with(F.slice("x", 1, F.col("n") - 1), F.slice("x", F.lit(2), F.col("n") - 1),
                       lambda a, b: (a - F.col("mu")) * (b - F.col("mu")))
    var = F.aggregate("x", F.lit(0.0), lambda a, v: a + (v - F.col("mu")) * (v - F.col("mu")))
    serial = F.coalesce(F.aggregate("pairs", F.lit(0.0), lambda a, v: a + v) / F.nullif(var, F.lit(0.0)), F.lit(1.0))
    z_serial = (TEXT_SERIAL - F.abs("serial")) * F.sqrt("n")
    t = t.withColumn("chi", chi).withColumn("changes", changes).withColumn("x", places).withColumn("mu", mu)
    t = t.withColumn("pairs", pairs).withColumn("serial", serial)
    t = t.withColumn("z_chi", z_chi).withColumn("z_runs", z_runs).withColumn("z_serial", z_serial)
    p = _normal_tail((F.col("z_chi") + F.col("z_runs") + F.col("z_serial")) / math.sqrt(3))
    return t.withColumn("p", p).drop("plain", "alphabet", "delta", "changes0", "k", "chi", "changes", "x", "mu", "pairs", "serial")


def wordy(token: Column) -> Column:
    """Whether most of a token stands in pieces that look like words: a capital at most, then lower-case letters, with a vowel."""
    pieces = F.filter(F.regexp_extract_all(token, F.lit("[A-Z]?[a-z]{2,}|[A-Z]{3,}(?![a-z])"), F.lit(0)), lambda w: w.rlike("(?i)[aeiouy]"))
    return F.aggregate(pieces, F.lit(0), lambda n, w: n + F.length(w)) >= WORDY * F.length(token)


def ordinary(scored: DataFrame) -> DataFrame:
    """(encoding, size, mean, spread) of the scores' sum among wordy candidates, for every class; a few dozen rows."""
    q = F.round(F.col("score") * _UNIT).cast("decimal(20,0)")
    sums = [F.count("*").alias("n"), F.sum(q).alias("a"), F.sum(q * q).alias("b")]
    by_class = scored.groupBy("encoding", "size").agg(F.count("*").alias("all"), *[
        f.alias(n) for f, n in ((F.count_if("wordy"), "n"), (F.sum(F.when(F.col("wordy"), q)), "a"), (F.sum(F.when(F.col("wordy"), q * q)), "b"))])
    by_encoding = scored.filter("wordy").groupBy("encoding").agg(*sums).select("encoding", *[F.col(c).alias(f"e{c}") for c in "nab"])
    t = by_class.join(by_encoding, "encoding", "left")
    enough, some = F.col("n") >= MIN_WORDY, F.col("en") >= MIN_WORDY
    pick = lambda c: F.when(enough, F.col(c)).when(some, F.col(f"e{c}")).cast("double")
    mean = pick("a") / pick("n")
    variance = pick("b") / pick("n") - mean * mean                # NULL where there are too few
    spread = F.sqrt(F.when(variance < 0, 0.0).otherwise(variance)) / _UNIT
    return t.select("encoding", "size", F.coalesce(mean / _UNIT, F.lit(0.0)).alias("mean"),
                    F.greatest(F.lit(1.0), F.coalesce(spread, F.lit(math.sqrt(3)))).alias("spread"))


def with_p_values(scored: DataFrame) -> DataFrame:
    """``scored`` with the p-value of each candidate in its class, and its bin."""
    p = _normal_tail((F.col("score") - F.col("mean")) / F.col("spread"))
    return (scored.join(F.broadcast(ordinary(scored)), ["encoding", "size"]).withColumn("p", p).drop("mean", "spread")      # a row per class
            .withColumn("bin", F.floor(F.least(F.lit(float(BINS)), -F.log2(F.greatest("p", F.lit(1e-300))))).cast("int")))


def length_class(n: Column) -> Column:
    return F.least(F.lit(6), F.floor(F.log2(n.cast("double") / 20) * 2)).cast("int")


def accepted_bins(scored: DataFrame, fdr: float = FDR) -> DataFrame:
    """(encoding, size, bin): for each class the smallest bin of -log2(p) that Benjamini-Hochberg accepts."""
    bins = scored.groupBy("encoding", "size", "bin").agg(F.count("*").alias("n"), F.count_if("wordy").alias("w"))
    cls = ["encoding", "size"]
    more = Window.partitionBy(*cls).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = Window.partitionBy(*cls)
    tested = bins.select(*cls, "bin", F.sum("n").over(more).alias("found"), F.sum("n").over(total).alias("all"),
                         F.sum("w").over(more).alias("false"), F.sum("w").over(total).alias("wordy"))
    # every p in a bin is at most 2 ** -bin
    p = F.greatest(F.pow(F.lit(2.0), -F.col("bin")), F.coalesce(F.col("false") / F.nullif(F.col("wordy"), F.lit(0)), F.lit(0.0)))
    return (tested.filter(p * F.col("all") <= fdr * F.col("found"))
            .groupBy(*cls).agg(F.min("bin").alias("least")))


def false_share(scored: DataFrame, accepted: DataFrame) -> DataFrame:
    """Per class: candidates beyond its threshold, and how many of them are wordy: findings that would have been false."""
    return (scored.join(F.broadcast(accepted), ["encoding", "size"]).filter("bin >= least").groupBy("encoding", "size")
            .agg(F.count("*").alias("found"), F.count_if("wordy").alias("false")))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per row of ``docs``: rid, id, base and added spans as arrays of (start, rank, end, kind)."""
    d = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("run", CANDIDATE)):
        d = d.withColumn(name, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    d = d.withColumn("value", F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(1)))

    def spans(name: str, pattern: str, rank: int, ok=None) -> Column:
        at = F.zip_with(_positions(F.col(name), F.col("text"), pattern), F.col("value" if name == "assign" else name),
                        lambda s, m: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
                                              F.lit("random" if name == "run" else name).alias("kind"), m.alias("match")))
        return F.filter(at, ok) if ok is not None else at

    long_value = lambda s: F.length(s["match"]) >= 6
    bare = "array<struct<start:int,rank:int,end:int,kind:string>>"
    strip = lambda a: F.transform(a, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])).cast(bare)
    rows = stage(d.select("rid", "id", F.array_sort(F.concat(strip(spans("assign", ASSIGN, 0, long_value)),
                                                             strip(spans("access", ACCESS, 1)), strip(spans("hex", HEX, 2)))).alias("base"),
                          spans("run", CANDIDATE, 3).alias("runs")), "secret-rows")
    # a run within a base span adds nothing: the furthest end of the base spans that start no later tells
    span = "array<struct<start:int,rank:int,end:int,kind:string,match:string>>"
    bases = F.transform("base", lambda b: F.struct(b["start"], b["rank"], b["end"], b["kind"], F.lit(None).cast("string").alias("match")))
    reach = F.max(F.when(F.col("s.match").isNull(), F.col("s.end"))).over(
        Window.partitionBy("rid").orderBy("s.start", F.col("s.match").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = (rows.filter("size(runs) > 0").select("rid", F.explode(F.concat(bases.cast(span), F.col("runs").cast(span))).alias("s"))
            .withColumn("reach", reach).filter("s.match IS NOT NULL AND (reach IS NULL OR reach < s.end)")
            .select("rid", "s", F.col("s.match").alias("token")))
    scores = stage(randomness(runs.withColumn("wordy", wordy(F.col("token")))).select(
        "rid", "s", "encoding", length_class(F.col("n")).alias("size"), "wordy",
        (F.col("z_chi") + F.col("z_runs") + F.col("z_serial")).alias("score")), "secret-scores")
    scored = with_p_values(scores)
    accepted = accepted_bins(scored, fdr)
    added = (scored.join(F.broadcast(accepted), ["encoding", "size"]).filter("bin >= least AND NOT wordy")      # a row per class at most
             .groupBy("rid").agg(F.collect_list("s").alias("added")))
    added = stage(added, "secret-added")
    none = F.array().cast(bare)
    return rows.select("rid", "id", "base").join(added, "rid", "left").select(
        "rid", "id", "base", F.coalesce(strip(F.col("added")), none).alias("added"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
