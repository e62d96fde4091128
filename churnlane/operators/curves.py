"""Layouts along a Hilbert curve over several columns (LAY-1, LAY-4).

Sorting by (a, b) makes files tight in ``a`` only; a Z-order is tight in both
but jumps; along a Hilbert curve neighbours on the curve are neighbours in every
column, so a file's range is narrow in all of them.

Ranks of all columns come from one quantile pass.  The curve index is one
expression: a fold over the bits, high to low, that reads digit and next state
from a state table.  The table is made from the curve's rule (Gray code corners,
entry points and directions of the sub-cubes), not written out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlane.functions.columns import array_literal
from churnlane.operators.layout import with_tie_breaks, without_tie_breaks
from churnlane.operators.tree import unused_name
from churnlane.session import pin

MAX_DIMENSIONS = 5


def _turn(value: int, by: int, n: int) -> int:
    """``value``'s n bits rotated left."""
    by %= n
    return ((value << by) | (value >> (n - by))) & ((1 << n) - 1)


def _gray(i: int) -> int:
    return i ^ (i >> 1)


@lru_cache
def state_table(n: int) -> tuple[list[int], list[int]]:
    """(digit, next state) by ``state * 2**n + corner`` for a curve in ``n`` dimensions; state 0 is the start.

    A state is an entry corner and a direction.  The corner a point lies in,
    turned into the state's frame, is the Gray code of the digit; sub-cube ``w`` is
    entered at ``gray(2 * ((w - 1) // 2))`` and runs along the axis in which the next corner differs.
    """
    corners = 1 << n
    inverse = {_gray(w): w for w in range(corners)}
    ones = lambda w: next(k for k in range(n + 1) if not w >> k & 1)  # noqa: E731  trailing set bits
    numbers, queue = {(0, 0): 0}, [(0, 0)]
    digit: list[int] = []
    after: list[int] = []
    for entry, axis in queue:                           # grows with the states that are reached
        for corner in range(corners):
            w = inverse[_turn(corner ^ entry, -(axis + 1), n)]
            start = _gray(2 * ((w - 1) // 2)) if w else 0
            along = (0 if not w else ones(w - 1) if w % 2 == 0 else ones(w)) % n
            state = (entry ^ _turn(start, axis + 1, n), (axis + along + 1) % n)
            if state not in numbers:
                numbers[state] = len(numbers)
                queue.append(state)
            digit.append(w)
            after.append(numbers[state])
    return digit, after


def hilbert_index(ranks: Sequence[Column], bits: int) -> Column:
    """Place along the curve of small non-negative integers of ``bits`` bits."""
    n = len(ranks)
    if not 1 <= n <= MAX_DIMENSIONS or n * bits > 62:
        raise ValueError(f"one to {MAX_DIMENSIONS} columns and at most 62 bits in all")
    digit, after = (array_literal(t, "int") for t in state_table(n))

    def place(x: Column) -> Column:
        def step(acc: Column, b: Column) -> Column:
            corner = F.aggregate(x, F.struct(F.lit(0).alias("c"), F.lit(0).alias("j")), lambda s, v: F.struct(
                (s["c"] + F.call_function("shiftleft", F.call_function("shiftright", v, b) % 2, s["j"])).alias("c"),
                (s["j"] + 1).alias("j")))["c"]
            at = acc["state"] * (1 << n) + corner
            return F.struct((acc["h"] * (1 << n) + F.get(digit, at)).alias("h"), F.get(after, at).alias("state"))
        start = F.struct(F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("state"))
        return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step)["h"]
    return F.transform(F.array(F.array(*[r.cast("int") for r in ranks])), place)[0]


def quantile_ranks(df: DataFrame, cols: Sequence[str], names: Sequence[str], bits: int) -> DataFrame:
    """``df`` with each column's quantile bucket (``2**bits`` of them; NULL and NaN in the last), from one pass over ``df``."""
    q = QuantileDiscretizer(inputCols=list(cols), outputCols=list(names), numBuckets=2 ** bits, handleInvalid="keep", relativeError=0.25 / 2 ** bits)
    out = q.fit(df).transform(df)
    last = 2 ** bits - 1
    return out.withColumns({n: F.least(F.coalesce(F.col(n), F.lit(float(last))), F.lit(float(last))).cast("int") for n in names})


def hilbert(df: DataFrame, cols: Sequence[str], files: int, bits: int = 8, pin_input: bool = True) -> DataFrame:
    """``df`` in ``files`` range partitions along a Hilbert curve over the numeric columns ``cols``, sorted along it.

    The input is read for the quantiles, the range sample and the write: it is pinned first unless it comes straight from files.
    """
    df = pin(df) if pin_input else df
    names = [unused_name(df, f"_rank{i}") for i in range(len(cols))]
    h = unused_name(df, "_hilbert")
    keyed = with_tie_breaks(quantile_ranks(df, cols, names, bits).withColumn(h, hilbert_index([F.col(n) for n in names], bits)).drop(*names))
    ties = ["_rh", "_cp"]
    return without_tie_breaks(keyed.repartitionByRange(files, h, *ties).sortWithinPartitions(h, *ties)).drop(h)
