"""Vector compression by product codes, fitted with exact k-means under norm-of-sum bounds.

A vector's components become integers (``floor(SCALE * x)``) and are cut into
``PARTS`` parts; each part position has a codebook of at most ``ENTRIES``
entries.  Every round assigns all parts to their nearest entries and moves the
entries to their parts' mean.  All arithmetic that decides is exact.

A row keeps, for each part and each group of ``GROUP`` entries, a lower bound of
its distance to the group's entries (its own entry aside) and the round in
which that bound was measured (its stamp).  All codebooks so far are retained,
so in a later round a bound shrinks only by how far the group's entries lie
*now* from where they were at the stamp (the norm of the summed moves), not by
the moves added up one by one.  Only groups whose bound does not exceed the
exact distance to the row's entry are scanned again.

A round is one map over the rows' state, written to the shared folder, and one
partial aggregation of sums (one row an entry and task).  The driver holds
codebooks alone: at most ``ENTRIES`` entries a part and round.

Distances are computed in doubles, which is exact while squares stay below
``EXACT``; entries that lie beyond are held off by their norms, and rows that
are beyond it, or near such an entry, are scanned in Python integers.

Defined results: rows with a null vector, or a null or non-finite component, are
left out; null ids come last among the starting entries, rows of one id are
ordered by vector; with fewer than ``ENTRIES`` rows the codebooks are smaller;
a vector whose length differs from the first starting entry's has null code and
error and moves nothing; lengths that ``parts`` does not divide are cut at
``i * length // parts``; errors beyond a long are its largest value; repeated
rows count each; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.llm.common import discard, recorded, ship, small, stage

PARTS, ENTRIES, ROUNDS, SCALE, GROUP = 4, 256, 4, 1024, 32
EXACT = 2.0**49            # squared norms up to here give exact distances in doubles
MAX_LONG = 2**63 - 1
_LIMB = 40                 # bits of a piece of a sum too large for a long
_UP, _DOWN = 1 + 2.0**-40, 1 - 2.0**-40

Codebooks = list[list[list[int]]]      # part, entry, component


def integers(values: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` as doubles: exact, since SCALE is a power of two."""
    return np.floor(values.astype(np.float64) * SCALE)


class Book:
    """One part's codebook of one round, as doubles."""

    def __init__(self, entries: list[list[int]]):
        self.exact = entries
        self.c = np.array(entries, np.float64).reshape(len(entries), -1)
        with np.errstate(over="ignore"):
            self.cc = (self.c * self.c).sum(axis=1)
        self.far = ~(self.cc < EXACT)
        self.reach = np.sqrt(self.cc[self.far].min()) if self.far.any() else np.inf

    def slow(self, x: np.ndarray) -> tuple[int, int]:
        """(squared distance, entry) nearest to one row, in Python integers."""
        row = [int(v) for v in x]
        return min((sum((a - b) ** 2 for a, b in zip(row, entry)), j) for j, entry in enumerate(self.exact))


def assign(x: np.ndarray, best: np.ndarray, bound: np.ndarray, stamp: np.ndarray, books: list[Book],
           group: int = GROUP) -> tuple[list[int], int]:
    """Moves ``best`` (in place, -1 before the first round) to the nearest entries of ``books[-1]``.

    ``bound`` and ``stamp`` (row by group) are brought up to date in place.
    Returns the exact squared distances and how many (row, group) scans were made.
    """
    with np.errstate(all="ignore"):        # infinities and their differences lead to the slow scan
        return _assign(x, best, bound, stamp, books, group)


def _assign(x, best, bound, stamp, books, group):
    now, book = len(books) - 1, books[-1]
    starts = range(0, len(book.c), group)
    xx = (x * x).sum(axis=1)
    first = best < 0
    at = np.where(first, 0, best)
    slow = ~(xx < EXACT) | (~first & book.far[at])
    square = ((x - book.c[at]) ** 2).sum(axis=1)
    square[first] = np.inf
    u = np.sqrt(square)
    # how far each group's entries lie from where they were at each stamp
    moved = [np.sqrt(((book.c - b.c) ** 2).sum(axis=1)) * _UP for b in books]
    drift = np.array([[m[s: s + group].max() for s in starts] for m in moved])
    left = bound * _DOWN - drift[stamp, np.arange(len(starts))]
    scan = (left <= (u * _UP)[:, None]) & ~slow[:, None]

    d, j = square.copy(), at.copy()
    rescanned = []
    for g, s in enumerate(starts):
        r = np.flatnonzero(scan[:, g])
        if not len(r):
            continue
        c, cc, far = book.c[s: s + group], book.cc[s: s + group], book.far[s: s + group]
        near = xx[r, None] - 2 * (x[r] @ np.where(far[:, None], 0, c).T) + np.where(far, 0, cc)
        if far.any():          # a lower bound by the norms
            near[:, far] = np.maximum(np.sqrt(cc[far]) - np.sqrt(xx[r])[:, None], 0) ** 2 * _DOWN
        k = near.argmin(axis=1)
        one = near[np.arange(len(r)), k]
        near[np.arange(len(r)), k] = np.inf
        rescanned.append((g, r, s + k, one, near.min(axis=1)))
        closer = (one < d[r]) | ((one == d[r]) & (s + k < j[r]))
        d[r[closer]], j[r[closer]] = one[closer], s + k[closer]
    slow |= ~((book.reach - np.sqrt(xx)) * _DOWN > np.sqrt(d))

    # bounds: scanned groups anew, the group that a row left gets its old entry back
    for g, r, k, one, two in rescanned:
        bound[r, g] = np.sqrt(np.where(j[r] == k, two, one)) * _DOWN
        stamp[r, g] = now
    gone = np.flatnonzero(~first & (j != at) & ~slow)
    g = at[gone] // group
    kept = ~scan[gone, g]
    gone, g = gone[kept], g[kept]
    bound[gone, g] = np.minimum(left[gone, g], u[gone] * _DOWN)
    stamp[gone, g] = now
    best[:] = j
    out = [0] * len(x)
    quick = np.flatnonzero(~slow)
    for i, v in zip(quick.tolist(), d[quick].astype(np.int64).tolist()):
        out[i] = v
    for i in np.flatnonzero(slow).tolist():
        out[i], best[i] = book.slow(x[i])
        bound[i], stamp[i] = 0, now
    return out, int(scan.sum())


def _floats(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _cuts(width: int, parts: int) -> list[tuple[int, int]]:
    return list(pairwise(i * width // parts for i in range(parts + 1)))


def _assigner(history: list[Codebooks], width: int, parts: int, schema: T.StructType, last: bool, group: int = GROUP):
    """Arrow batches of (.., v[, best, bound, stamp]) to the state of this round, or to (.., code, error) in the last one."""
    groups = -(-len(history[0][0]) // group)

    def each(batches):
        books = [[Book(one[p]) for one in history] for p in range(parts)]
        for batch in batches:
            n = len(batch)
            x = integers(_floats(batch.column("v"), width)) if width else np.zeros((n, 0))
            if len(history) > 1:
                best = _floats(batch.column("best"), parts).astype(np.int64)
                bound = _floats(batch.column("bound"), parts * groups).astype(np.float64).reshape(n, parts, groups)
                stamp = _floats(batch.column("stamp"), parts * groups).astype(np.int64).reshape(n, parts, groups)
            else:
                best, bound, stamp = np.full((n, parts), -1), np.zeros((n, parts, groups)), np.zeros((n, parts, groups), np.int64)
            error = [0] * n
            for p, (a, b) in enumerate(_cuts(width, parts)):
                found, _ = assign(x[:, a:b], best[:, p], bound[:, p], stamp[:, p], books[p], group)
                error = [e + f for e, f in zip(error, found)]
            keep = {c: batch.column(c) for c in batch.schema.names if c not in ("best", "bound", "stamp")}
            if last:
                del keep["v"]
                keep["code"] = pa.array([bytes(r).hex() for r in best.astype(np.uint8)], pa.string())
                keep["error"] = pa.array([min(e, MAX_LONG) for e in error], pa.int64())
            else:
                lists = lambda m, t: pa.ListArray.from_arrays(
                    np.arange(n + 1, dtype=np.int32) * (m.size // max(n, 1)), pa.array(m.ravel(), t))
                keep["best"] = lists(best.astype(np.int32), pa.int32())
                low = np.nextafter(bound.astype(np.float32), np.float32(0))
                keep["bound"], keep["stamp"] = lists(low, pa.float32()), lists(stamp.astype(np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([keep[f.name] for f in schema], names=schema.names)
    return each


def _summer(width: int, parts: int, entries: int, limbs: int):
    """Arrow batches of (v, best) to one row a (part, entry) of the task: count and sums, in pieces where they are large."""
    def each(batches):
        total = np.zeros((width, entries), np.int64 if limbs == 1 else object)
        count = np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = integers(_floats(batch.column("v"), width)) if width else np.zeros((len(batch), 0))
            best = _floats(batch.column("best"), parts).astype(np.int64)
            whole = x.astype(np.int64) if limbs == 1 else np.frompyfunc(int, 1, 1)(x)
            for p, (a, b) in enumerate(_cuts(width, parts)):
                count[p] += np.bincount(best[:, p], minlength=entries)
                for i in range(a, b):
                    np.add.at(total[i], best[:, p], whole[:, i])
        part, entry = np.nonzero(count)
        cuts, sums = _cuts(width, parts), []
        for p, e in zip(part.tolist(), entry.tolist()):
            values = [int(total[i][e]) for i in range(*cuts[p])]
            sums.append([(v >> _LIMB * k) & ((1 << _LIMB) - 1) if k < limbs - 1 else v >> _LIMB * k for v in values for k in range(limbs)])
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry], pa.int64()),
                                          pa.array(sums, pa.list_(pa.int64()))], names=["part", "entry", "n", "s"])
    return each


def _moved(state: DataFrame, books: Codebooks, width: int, limbs: int) -> Codebooks:
    """The next round's codebooks: floor of the mean of each entry's parts; unused entries stay."""
    parts, entries = len(books), len(books[0])
    widest = max(b - a for a, b in _cuts(width, parts)) * limbs
    sums = (state.select("v", "best").mapInArrow(_summer(width, parts, entries, limbs), "part int, entry int, n long, s array<long>")
            .groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(widest)]))
    out = [[list(e) for e in book] for book in books]
    for row in sums.collect():                       # at most parts * entries rows
        whole = [sum(row[f"s{i * limbs + k}"] << _LIMB * k for k in range(limbs)) for i in range(len(books[row.part][row.entry]))]
        out[row.part][row.entry] = [s // row.n for s in whole]
    return out


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(id, label, code, error) for each kept row of ``vectors``, and the final codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    ship()
    spark = vectors.sparkSession
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    kept = (vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
            .filter(F.col("v").isNotNull() & ~F.exists("v", bad)))
    head = T.StructType(kept.schema.fields[:2])
    coded = T.StructType([*head, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    order = [F.col("id").asc_nulls_last(), F.col("v")]
    first = kept.orderBy(*order).select(F.size("v").alias("n")).limit(1).collect()
    if not first:
        return spark.createDataFrame([], coded), [[] for _ in range(parts)]
    width = first[0].n
    same = kept.filter(F.size("v") == width)
    seeds = [r.v for r in same.orderBy(*order).select("v").limit(entries).collect()]
    start = integers(np.array(seeds, np.float64).reshape(len(seeds), width))
    books = [[[int(v) for v in row[a:b]] for row in start] for a, b in _cuts(width, parts)]
    size = same.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("m"), F.count("*").alias("n")).first()
    bits = (int((size.m or 0) * SCALE + 1) * size.n).bit_length()
    limbs = 1 if bits < 62 else -(-(bits + 2) // _LIMB)

    history, state, paths = [books], same, []
    schema = T.StructType([*same.schema.fields, T.StructField("best", T.ArrayType(T.IntegerType())),
                           T.StructField("bound", T.ArrayType(T.FloatType())), T.StructField("stamp", T.ArrayType(T.IntegerType()))])
    for _ in range(rounds):
        with recorded() as written:
            state = stage(state.mapInArrow(_assigner(history, width, parts, schema, False), schema), "codes-state")
        discard(spark, paths)                        # the state before it: nothing reads it any more
        paths = written
        history.append(_moved(state, history[-1], width, limbs))
    out = stage(state.mapInArrow(_assigner(history, width, parts, coded, True), coded), "codes")
    discard(spark, paths)
    odd = kept.filter(F.size("v") != width).select("id", "label", F.lit(None).cast("string").alias("code"),
                                                   F.lit(None).cast("long").alias("error"))
    return out.unionByName(odd), history[-1]


def codebooks_sha256(books: Codebooks) -> str:
    """Of all components by part, entry and position, in decimal, comma-joined."""
    return hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` and ``label_error``: its errors added up over equal labels, null labels together."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MAX_LONG).cast("decimal(38,0)")).cast("long")
    sums = stage(coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), "codes-labels")
    return coded.join(small(sums, sums.count()), coded["label"].eqNullSafe(sums["of"])).drop("of")


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL of the registered query: every round scans every entry."""
    sql = f"""
WITH x AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda v: v IS NOT NULL AND isfinite(v)))),
parts AS MATERIALIZED (SELECT rid, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v FROM x, range({parts}) r(p)),
b0 AS MATERIALIZED (SELECT p, e, v FROM parts JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM x) USING (rid) WHERE e < {entries})"""
    for r in range(rounds + 1):
        sql += f""",
a{r} AS MATERIALIZED (SELECT rid, p, arg_min(e, d * {entries} + e) AS e, min(d) AS d FROM (SELECT rid, a.p, e,
    list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM parts a JOIN b{r} b USING (p)) GROUP BY rid, p)"""
        if r < rounds:
            sql += f""",
s{r} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (SELECT p, e, i, sum(c)::BIGINT AS s, count(*) AS n
    FROM (SELECT p, e, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM a{r} JOIN parts USING (rid, p)) GROUP BY p, e, i) GROUP BY p, e),
b{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(s.v, b.v) AS v FROM b{r} b LEFT JOIN s{r} s USING (p, e))"""
    return sql + f""",
coded AS (SELECT rid, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM x JOIN coded USING (rid)"""
