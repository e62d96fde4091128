"""Keyed feature tables and lookups (SNK-3, SNK-4, KEY-1, FLT-3, JN-1..JN-4).

A feature table is a Parquet table plus its declared primary key kept in
TBLPROPERTIES.  Parquet cannot enforce a key, so ``create_feature_table``
writes a staging table, runs the key check on it and swaps it in only if no
key is NULL or repeated.  Tables can be bucketed and sorted by the key.

Lookup joins: the feature side is key-unique, the request side (labels,
keys to score) may repeat a key many times.  We declare a plain equi-join and
let Spark choose: AQE turns it into a broadcast join when the *measured*
feature side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and
otherwise runs a sort-merge join whose skewed request partitions AQE splits
(``spark.sql.adaptive.skewJoin.enabled``), so a key holding a third of all
requests does not end up in one task.  That needs both sides shuffled: over a
*bucketed* feature table only the request side moves and AQE splits nothing,
so hot keys want ``join_hot_split`` there: hot request keys (found by a
frequent-items sketch, at most ``1/fraction`` of them) join a bounded broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlane.session import pin, scratch_path, unique_name


class KeyViolation(ValueError):
    pass


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that are NULL or occur more than once, with their count (KEY-1).

    One aggregation with map-side partial counts: a hot key is pre-counted in
    every task before the shuffle, so no task sees all of its rows.
    """
    keys = list(keys)
    null_key = None
    for k in keys:
        c = F.col(k).isNull()
        null_key = c if null_key is None else (null_key | c)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) | null_key))


def assert_unique_key(df: DataFrame, keys: Sequence[str]) -> None:
    bad = key_violations(df, keys).limit(5).collect()  # at most 5 rows to the driver
    if bad:
        raise KeyViolation(f"primary key {list(keys)} violated, e.g. {[r.asDict() for r in bad]}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it exists; never fails (SNK-3)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _quote(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def create_feature_table(spark: SparkSession, name: str, df: DataFrame,
                         primary_keys: Sequence[str], description: str = "",
                         path: str | None = None, check_keys: bool = True,
                         buckets: int | None = None) -> DataFrame:
    """Write ``df`` as a keyed feature table and return it read back by name (SNK-4).

    The rows go to a staging table in a new directory; the key check runs on
    those *written* files (a scan of the key columns only), so the upstream
    plan — often a large aggregation — runs once.  Only a table that passed
    the check replaces ``name`` (drop + rename, no data moves): a key
    violation or a failed job leaves any previous table untouched.
    ``buckets``: bucket (and sort) the table by its key, one file per
    bucket, so every later lookup on the key reads the feature side without
    an exchange — only the request side is shuffled.
    """
    from churnlane.sources.sinks import swap_in
    staging = unique_name(f"{name}_staging")
    path = path or scratch_path(spark, f"ft-{name}")
    if buckets:
        # same hash as the buckets: each task writes exactly one bucket file
        df = df.repartition(buckets, *primary_keys)
    w = df.write.mode("overwrite").format("parquet").option("path", path)
    if buckets:
        w = w.bucketBy(buckets, *primary_keys).sortBy(*primary_keys)
    w.saveAsTable(staging)
    if check_keys:
        try:
            assert_unique_key(spark.read.table(staging), primary_keys)
        except KeyViolation:
            drop_table(spark, staging)
            raise
    props = {"primary_keys": ",".join(primary_keys), "kind": "feature_table"}
    if description:
        props["comment"] = description
    prop_sql = ", ".join(f"'{k}' = '{_quote(v)}'" for k, v in props.items())
    spark.sql(f"ALTER TABLE {staging} SET TBLPROPERTIES ({prop_sql})")
    swap_in(spark, staging, name)
    return spark.read.table(name)


def primary_keys_of(spark: SparkSession, name: str) -> list[str]:
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    pk = props.get("primary_keys", "")
    return [k for k in pk.split(",") if k]


@dataclass(frozen=True)
class FeatureLookup:
    """Which table to read and on which key (JN-1)."""
    table_name: str
    lookup_key: tuple[str, ...]
    feature_names: tuple[str, ...] | None = None   # None: every non-key column

    @staticmethod
    def of(table_name: str, lookup_key: str | Sequence[str],
           feature_names: Sequence[str] | None = None) -> "FeatureLookup":
        keys = (lookup_key,) if isinstance(lookup_key, str) else tuple(lookup_key)
        return FeatureLookup(table_name, keys, tuple(feature_names) if feature_names else None)

    def frame(self, spark: SparkSession) -> DataFrame:
        t = spark.read.table(self.table_name)
        cols = self.feature_names or tuple(c for c in t.columns if c not in self.lookup_key)
        return t.select(*self.lookup_key, *cols)

    def to_dict(self) -> dict:
        return {"table_name": self.table_name, "lookup_key": list(self.lookup_key),
                "feature_names": list(self.feature_names) if self.feature_names else None}

    @staticmethod
    def from_dict(d: dict) -> "FeatureLookup":
        return FeatureLookup.of(d["table_name"], d["lookup_key"], d.get("feature_names"))


def check_lookup_key(spark: SparkSession, fl: FeatureLookup) -> None:
    """An error where a table declares a key and the lookup does not name all of it: the join would multiply rows."""
    declared = {k.lower() for k in primary_keys_of(spark, fl.table_name)}
    if not declared <= {k.lower() for k in fl.lookup_key}:
        raise KeyViolation(f"lookup in {fl.table_name} by {list(fl.lookup_key)}, but its rows are unique by {sorted(declared)} only")


def lookup(spark: SparkSession, df: DataFrame, lookups: Sequence[FeatureLookup],
           how: str = "left", skew_fraction: float | None = None) -> DataFrame:
    """Join each lookup's features onto ``df`` by its key (chained equi-joins).

    A lookup key that lacks a part of the table's declared key is an error.
    ``skew_fraction``: split off request keys holding more than this share of
    the rows and serve them from a bounded broadcast (``lookup_skew_safe``).
    """
    out = df
    for fl in lookups:
        check_lookup_key(spark, fl)
        if skew_fraction:
            out = lookup_skew_safe(spark, out, fl, skew_fraction, how)
        else:
            out = out.join(fl.frame(spark), list(fl.lookup_key), how)
    return out


@dataclass(frozen=True)
class TrainingSet:
    """Lazy training-set spec: labels + lookups - excluded columns (JN-1)."""
    df: DataFrame
    label: str | None
    feature_lookups: tuple[FeatureLookup, ...]
    exclude_columns: tuple[str, ...] = field(default_factory=tuple)

    def load_df(self, spark: SparkSession, skew_fraction: float | None = None) -> DataFrame:
        out = lookup(spark, self.df, self.feature_lookups, "left", skew_fraction)
        return out.drop(*self.exclude_columns)


def create_training_set(df: DataFrame, label: str | None, feature_lookups: Sequence[FeatureLookup],
                        exclude_columns: Sequence[str] = ()) -> TrainingSet:
    return TrainingSet(df, label, tuple(feature_lookups), tuple(exclude_columns))


def missing_features(spark: SparkSession, keys: DataFrame, lookups: Sequence[FeatureLookup]) -> DataFrame:
    """Request rows that some lookup cannot serve (JN-4).

    One lookup: a ``left_anti`` join.  Several: left joins of each lookup's
    key set with a hit flag, keeping rows where any flag is missing (request
    duplicates are kept, as they would be scored).
    """
    if len(lookups) == 1:
        fl = lookups[0]
        return keys.join(fl.frame(spark).select(*fl.lookup_key), list(fl.lookup_key), "left_anti")
    out, cond, marks = keys, None, []
    for i, fl in enumerate(lookups):
        m = f"_hit{i}"
        marks.append(m)
        hits = fl.frame(spark).select(*fl.lookup_key).withColumn(m, F.lit(True))
        out = out.join(hits, list(fl.lookup_key), "left")
        c = F.col(m).isNull()
        cond = c if cond is None else (cond | c)
    return out.where(cond).drop(*marks)


def key_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def coerce_key(df: DataFrame, key: str | Sequence[str], like: DataFrame) -> DataFrame:
    """Request keys arrive as text (``"123"``); ``try_cast`` to the key types of ``like``.

    Under ANSI a plain comparison of ``'x'`` with a bigint raises; ``try_cast``
    makes it NULL, so it simply matches nothing.
    """
    return df.withColumns({k: F.col(k).try_cast(like.schema[k].dataType) for k in key_list(key)})


def point_lookup(features: DataFrame, requests: DataFrame, key: str | Sequence[str], push: int = 0) -> DataFrame:
    """Feature rows of the requested keys (FLT-3), keys sent as text (G11).

    Request keys are coerced to the table's key type (``"x"`` matches
    nothing) and de-duplicated *before* the join — a partial aggregation, so
    a key requested a billion times is one row per map task — then a
    ``left_semi`` join returns each matching feature row once.  Neither side
    of the join can carry a hot key.

    At most ``push`` distinct keys of one column go into the scan itself as a
    filter: files and row groups are skipped by their statistics,
    dictionaries and Bloom filters before they are read.  Beyond it the join decides.
    """
    keys = key_list(key)
    wanted = coerce_key(requests.select(*keys), keys, features).na.drop().distinct()
    if push and len(keys) == 1:
        wanted = pin(wanted)
        few = keys_in_scan(features, wanted, keys, push)
        if few is not None:
            return few
    return features.join(wanted, keys, "left_semi")


def keys_in_scan(features: DataFrame, requests: DataFrame, key: str | Sequence[str], push: int) -> DataFrame | None:
    """``features`` filtered to the keys of ``requests`` (of its type) by a filter that reaches the scan; None beyond ``push`` distinct keys."""
    keys = key_list(key)
    if len(keys) != 1:
        return None
    few = [r[0] for r in requests.select(*keys).na.drop().distinct().limit(push + 1).collect()]      # bounded by ``push``
    return features.where(_among(F.col(keys[0]), sorted(few))) if len(few) <= push else None


#: Values that one pushed IN may list; longer lists reach the scan as a range only.
_IN_PUSHED = 10


def _among(c: Column, values: list) -> Column:
    """``c IN (values)`` as an OR of lists that are short enough to reach the scan."""
    parts = [c.isin(values[i: i + _IN_PUSHED]) for i in range(0, len(values), _IN_PUSHED)] or [F.lit(False)]
    while len(parts) > 1:                                                # a balanced OR: its depth is the logarithm
        parts = [a | b for a, b in zip(parts[::2], parts[1::2])] + (parts[-1:] if len(parts) % 2 else [])
    return parts[0]


def hot_keys(df: DataFrame, key: str, fraction: float = 0.01) -> list:
    """Keys holding more than ``fraction`` of ``df``'s rows.

    Two passes, neither shuffles key-level data: Spark's frequent-items
    sketch (``stat.freqItems``, one pass with map-side partial counters)
    names at most ~``2/fraction`` candidates — every key above the fraction
    among them — then ONE global aggregate counts the rows and each
    candidate exactly.  At most ``1/fraction`` keys can qualify, so the list
    returned to the driver is bounded by the parameter, not by the data.
    """
    # half the fraction: a margin on the sketch's guarantee (its counters find
    # every key above ~support x rows); candidates stay bounded by 2/fraction
    support = fraction / 2
    if support < 1e-4:
        raise ValueError("hot keys below a share of 2e-4 are beyond the sketch; such keys need no split")
    row = df.select(key).stat.freqItems([key], support=support).first()
    cands = [k for k in (row[0] if row else None) or [] if k is not None]
    if not cands:
        return []
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count(F.when(F.col(key) == F.lit(c), 1)).alias(f"_c{i}")
                      for i, c in enumerate(cands)]).first()
    threshold = max(1, int(counts["_total"] * fraction))
    return [c for i, c in enumerate(cands) if counts[f"_c{i}"] > threshold]


def join_hot_split(df: DataFrame, feats: DataFrame, key: str | Sequence[str], fraction: float = 0.01,
                   how: str = "left") -> DataFrame:
    """Equi-join of a request frame onto a key-unique feature frame, with the
    hot request keys split off explicitly.

    Hot keys (each > ``fraction`` of the requests; at most ``1/fraction`` of
    them) are joined against their feature rows broadcast — a side bounded by
    ``1/fraction`` rows because ``feats`` is key-unique.  All other rows take
    the ordinary shuffle join, where no key can dominate a task.  Works with
    AQE off as well; with AQE on it makes skew handling independent of
    partition-size heuristics.  A key of several columns is compared as one text.
    """
    keys = key_list(key)
    if len(keys) > 1:
        name = "_key"
        while name in {c.lower() for c in [*df.columns, *feats.columns]}:
            name = f"_{name}"
        packed = F.when(F.greatest(*[F.col(k).isNull() for k in keys]), None).otherwise(F.to_json(F.struct(*keys)))
        out = join_hot_split(df.withColumn(name, packed), feats.withColumn(name, packed).drop(*keys), name, fraction, how)
        return out.drop(name)
    key = keys[0]
    df = pin(df)                # read by the sketch, the counts and both joins; what made it runs once
    hot = hot_keys(df, key, fraction)
    if not hot:
        return df.join(feats, key, how)
    is_hot = F.col(key).isin(hot)
    cold = df.where(~is_hot | F.col(key).isNull()).join(feats, key, how)
    hot_rows = df.where(is_hot).join(F.broadcast(feats.where(is_hot)), key, how)
    return cold.unionByName(hot_rows)


def lookup_skew_safe(spark: SparkSession, df: DataFrame, fl: FeatureLookup,
                     fraction: float = 0.01, how: str = "left") -> DataFrame:
    """Feature-table lookup with hot request keys split off (``join_hot_split``)."""
    return join_hot_split(df, fl.frame(spark), fl.lookup_key, fraction, how)
