"""Queries: column statistics and frame summary (AGG-3, AGG-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlane.operators.metrics import column_stats, frame_info
from churnlane.operators.sketches import LG_K, SketchLog, merge_sketches, read_sketches, sketch_columns
from churnlane.plans import common
from churnlane.plans.oracle_sql import BASE, BPZ, P, with_ctes
from churnlane.plans.registry import query
from churnlane.session import pin, scratch_path
from churnlane.sources.sinks import analyze_table, write_table
from churnlane.sources.tables import KEY


def _stats_sql(cols_numeric, cols_text, src, integral=("customer_id",)):
    parts = []
    for c in cols_numeric:
        exact = [f"CAST({f}({c}) AS varchar)" if c in integral else "CAST(NULL AS varchar)" for f in ("min", "max")]
        parts.append(f"""SELECT '{c}' AS col_name, CAST(min({c}) AS double) AS min_num, CAST(max({c}) AS double) AS max_num,
  {exact[0]} AS min_exact, {exact[1]} AS max_exact,
  CAST(NULL AS varchar) AS min_text, CAST(NULL AS varchar) AS max_text, count({c}) AS non_null,
  count(*) - count({c}) AS num_nulls, count(DISTINCT {c}) AS distinct_count FROM {src}""")
    for c in cols_text:
        parts.append(f"""SELECT '{c}' AS col_name, CAST(NULL AS double) AS min_num, CAST(NULL AS double) AS max_num,
  CAST(NULL AS varchar) AS min_exact, CAST(NULL AS varchar) AS max_exact,
  min({c}) AS min_text, max({c}) AS max_text, count({c}) AS non_null,
  count(*) - count({c}) AS num_nulls, count(DISTINCT {c}) AS distinct_count FROM {src}""")
    return "\nUNION ALL\n".join(parts)


@query("column_stats", f"""{with_ctes(BASE, P)}
{_stats_sql(['customer_id', 'senior', 'tenure', 'monthly', 'total'], ['churn'], 'p')}""", "AGG-3")
def q_column_stats(spark, sf):
    """Exact statistics for all columns of the prepared (cast, not yet filtered) rows."""
    return column_stats(common.p(spark, sf))


def _catalog_sql(types):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS col_name, '{t}' AS data_type, "
        + ("CAST(NULL AS double) AS min_num, CAST(NULL AS double) AS max_num" if t == "string"
           else f"CAST(min({c}) AS double) AS min_num, CAST(max({c}) AS double) AS max_num")
        + f", count(*) - count({c}) AS num_nulls FROM z" for c, t in types.items())


@query("analyze_stats", f"""{BPZ}
{_catalog_sql({'customer_id': 'bigint', 'senior': 'double', 'tenure': 'double', 'monthly': 'double',
               'total': 'double', 'churn': 'string'})}""", "AGG-3")
def q_analyze_stats(spark, sf):
    """``ANALYZE TABLE ... COMPUTE STATISTICS FOR ALL COLUMNS`` + ``DESCRIBE EXTENDED``: the exact fields.

    The catalog's distinct counts are approximate (HyperLogLog) and left out
    here; ``column_stats`` has exact ones.
    """
    name = write_table(spark, common.z(spark, sf), "inference_stats")
    of = lambda name: F.max(F.when(F.col("info_name") == name, F.col("info_value")))
    return analyze_table(spark, name).groupBy(F.col("column").alias("col_name")).agg(
        of("data_type").alias("data_type"), of("min").try_cast("double").alias("min_num"),
        of("max").try_cast("double").alias("max_num"), of("num_nulls").cast("bigint").alias("num_nulls"))


@query("frame_info", f"""{BPZ}
SELECT 0 AS position, 'customer_id' AS col_name, 'bigint' AS data_type, count(customer_id) AS non_null FROM z
UNION ALL SELECT 1, 'senior', 'double', count(senior) FROM z
UNION ALL SELECT 2, 'tenure', 'double', count(tenure) FROM z
UNION ALL SELECT 3, 'monthly', 'double', count(monthly) FROM z
UNION ALL SELECT 4, 'total', 'double', count(total) FROM z
UNION ALL SELECT 5, 'churn', 'string', count(churn) FROM z""", "AGG-4")
def q_frame_info(spark, sf):
    return frame_info(common.z(spark, sf))


_SKETCHED = {"customer_id": "bigint", "senior": "double", "tenure": "double", "monthly": "double", "total": "double", "churn": "string"}


def _sketch_sql():
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS col_name, '{t}' AS data_type, count(*) AS n, count(*) - count({c}) AS nulls, "
        + (f"min({c}) AS min_text, max({c}) AS max_text, CAST(NULL AS double) AS min_num, CAST(NULL AS double) AS max_num" if t == "string"
           else f"CAST(NULL AS varchar) AS min_text, CAST(NULL AS varchar) AS max_text, CAST(min({c}) AS double) AS min_num, CAST(max({c}) AS double) AS max_num")
        + f", true AS near_one_pass, count(DISTINCT {c}) AS distinct_count, true AS distinct_within, true AS median_within FROM p" for c, t in _SKETCHED.items())


@query("sketched_stats", f"""{with_ctes(BASE, P)}
{_sketch_sql()}""", "AGG-3")
def q_sketched_stats(spark, sf):
    """Three appends, each sketched alone; merged they are the table's statistics.  The merged HLL estimate lies within four
    standard errors of that of one pass and of the exact count, and the estimated median within 3 % of the rows of its rank."""
    rows = pin(common.p(spark, sf))
    log = SketchLog(spark, scratch_path(spark, "sketches"))
    third = F.pmod(F.xxhash64(KEY), F.lit(3))
    for k in range(3):
        log.add(rows.where(third == k), k)
    whole = read_sketches(merge_sketches(sketch_columns(rows))).select("col_name", F.col("distinct_estimate").alias("_one"))
    exact = column_stats(rows).select("col_name", "distinct_count")
    found = pin(log.stats().join(whole, "col_name").join(exact, "col_name"))
    medians = {r.col_name: r.quantiles[1] for r in found.where("quantiles IS NOT NULL").select("col_name", "quantiles").collect()}    # one a column
    below = rows.agg(*[F.struct(F.avg((F.col(c) < m).cast("int")).alias("lt"), F.avg((F.col(c) <= m).cast("int")).alias("le")).alias(c)
                       for c, m in medians.items()])
    ranks = below.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col_name"), ((F.col(c)["lt"] <= 0.53) & (F.col(c)["le"] >= 0.47)).alias("ok"))
                                             for c in medians])).alias("r")).select("r.*")
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= F.greatest(F.lit(1.0), 4 * 1.04 / 2 ** (LG_K / 2) * F.col("distinct_count"))
    return found.join(ranks, "col_name", "left").select(
        "col_name", "data_type", "n", "nulls", "min_text", "max_text", "min_num", "max_num",
        (F.abs(F.col("distinct_estimate") - F.col("_one")) <= F.greatest(F.lit(1.0), 4 * 1.04 / 2 ** (LG_K / 2) * F.col("_one"))).alias("near_one_pass"), "distinct_count", near.alias("distinct_within"),
        F.coalesce("ok", F.lit(True)).alias("median_within"))
