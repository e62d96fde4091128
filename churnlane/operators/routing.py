"""Traffic split over model versions, champion/challenger scoring (SPL-3, SCO-5, SCO-6, SET-1).

A request is routed by a hash of ``'route:' || key`` into 0..99 and the
cumulative route percentages — deterministic per key (the same customer always
meets the same version), independent of the train/test hash (different salt),
and a pure per-row expression: no shuffle.  Every version is a native
expression: a routed row evaluates its own version's only, and scoring all
versions of a row is one projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlane.functions.columns import hash_bucket, route_name
from churnlane.operators.tree import TreeSpec, label_column, predict, unused_name

ROUTE_SALT = "route:"


@dataclass(frozen=True)
class Route:
    served_model_name: str
    traffic_percentage: int


def check_routes(routes: Sequence[Route]) -> None:
    if sum(r.traffic_percentage for r in routes) != 100:
        raise ValueError("traffic percentages must add up to 100")


def variant_column(key: Column | str, routes: Sequence[Route], salt: str = ROUTE_SALT) -> Column:
    """Route name for each row from cumulative percentage ranges."""
    check_routes(routes)
    b = hash_bucket(key, salt)
    expr, upper = None, 0
    for r in routes[:-1]:
        upper += r.traffic_percentage
        expr = F.when(b < upper, r.served_model_name) if expr is None else expr.when(b < upper, r.served_model_name)
    last = F.lit(routes[-1].served_model_name)
    return last if expr is None else expr.otherwise(last)


def assign(df: DataFrame, key: str, routes: Sequence[Route], out: str = "variant") -> DataFrame:
    return df.withColumn(out, variant_column(key, routes))


def score_routed(df: DataFrame, key: str, routes: Sequence[Route], models: Mapping[str, TreeSpec],
                 out: str = "prediction") -> DataFrame:
    """Each row scored by the version its key is routed to, and by no other (SCO-5)."""
    v = unused_name(df, "_variant")
    columns = [c for c in df.columns if c.lower() not in ("variant", out.lower())]
    chosen = reduce(lambda cases, m: cases.when(F.col(v) == m[0], label_column(m[1])), models.items(), F)
    return df.withColumn(v, variant_column(key, routes)).select(*columns, F.col(v).alias("variant"), chosen.alias(out))


def score_both(df: DataFrame, key: str, models: Mapping[str, TreeSpec]) -> DataFrame:
    """Every row under every version, long format (SET-1).

    One scan: both predictions are computed in the same projection and
    ``explode`` emits one row per version — the result of a ``unionByName``
    of per-version scored frames without scanning the input twice.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("variant"), label_column(tree).alias("prediction")) for name, tree in models.items()])
    return df.withColumn("_v", F.explode(pairs)).select(*df.columns, "_v.variant", "_v.prediction")


def agreement(df: DataFrame, models: Mapping[str, TreeSpec]) -> DataFrame:
    """One pass, both versions as columns: rows, scorable rows, agreements (SCO-6)."""
    (a, ta), (b, tb) = list(models.items())[:2]
    s = predict(predict(df.select(*dict.fromkeys([*ta.features, *tb.features])), ta, "_a"), tb, "_b")
    c = s.agg(F.count(F.lit(1)).alias("n"),
              F.sum(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1).otherwise(0))
               .cast("bigint").alias("scored"),
              F.sum(F.when(F.col("_a") == F.col("_b"), 1).otherwise(0)).cast("bigint").alias("agree"))
    return c.select("n", "scored", "agree",
                    F.when(F.col("scored") > 0,
                           F.floor((F.col("scored") - F.col("agree")).cast("double")
                                   / F.col("scored").cast("double") * 1000000) / 1000000)
                     .alias("disagreement_rate"))


def version_routes(name: str, versions: Sequence[int], pcts: Sequence[int]) -> list[Route]:
    """``f"{name}-{version}"`` route names (FN-4) for a traffic config."""
    return [Route(f"{name}-{v}", p) for v, p in zip(versions, pcts)]


__all__ = ["Route", "assign", "score_routed", "score_both", "agreement", "variant_column",
           "version_routes", "route_name"]
