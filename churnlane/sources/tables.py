"""Input tables and the churn-shaped ``base`` view.

``base`` re-expresses the reference's churn CSV on the driver's TPC-H-ish
tables (customer + orders): features from orders before a cutoff, the label
from orders on/after it, so there is no leakage.  ``total`` stays *text*
with a blank when there is no fulfilled order before the cutoff — the same
trap as the reference's ``TotalCharges`` column.

Plan at scale: orders is aggregated by ``o_custkey`` first (partial
aggregation before the shuffle, so a customer holding a third of all orders
collapses map-side to one row per task), then joined to customer on a unique
key; AQE picks broadcast or sort-merge from runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values that define the fixture (must equal the oracle SQL).
CUTOFF = "2000-07-01"
KEY = "customer_id"
LABEL = "churn"
FEATURES = ["senior", "tenure", "monthly", "total"]
CLASS_LABELS = ["No", "Yes"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _order_aggregates(orders: DataFrame) -> DataFrame:
    cutoff = F.lit(CUTOFF).cast("timestamp_ntz")
    before = F.col("o_orderdate") < cutoff
    price = F.col("o_totalprice").cast("decimal(18,2)")
    fulfilled = before & (F.col("o_orderstatus") == "F")
    return (orders
            .select("o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
            .groupBy("o_custkey")
            .agg(F.min(F.when(before, F.col("o_orderdate"))).alias("first_ts"),
                 F.sum(F.when(before, price)).alias("s_all"),
                 F.sum(F.when(before, 1).otherwise(0)).alias("n_all"),
                 F.sum(F.when(fulfilled, price)).alias("tot"),
                 F.sum(F.when(fulfilled, 1).otherwise(0)).alias("n_f"),
                 F.sum(F.when(F.col("o_orderdate") >= cutoff, 1).otherwise(0)).alias("n_after")))


def base_from(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Churn-shaped rows: customer_id, senior, tenure, monthly, total (text), churn."""
    o = _order_aggregates(orders)
    c = customer.select("c_custkey", "c_mktsegment")
    j = c.join(o, c["c_custkey"] == o["o_custkey"], "left")
    monthly = F.when(
        F.col("n_all") > 0,
        F.floor((F.col("s_all") * 100).cast("double") / F.col("n_all")) / 100)
    total: Column = F.when(F.coalesce(F.col("n_f"), F.lit(0)) == 0, F.lit(" ")) \
        .otherwise(F.col("tot").cast("string"))
    return j.select(
        F.col("c_custkey").alias(KEY),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", 1).otherwise(0).alias("senior"),
        F.datediff(F.lit(CUTOFF).cast("timestamp_ntz"), F.col("first_ts")).alias("tenure"),
        monthly.cast("double").alias("monthly"),
        total.alias("total"),
        F.when(F.col("n_after") > 0, "No").otherwise("Yes").alias(LABEL),
    )


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_from(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
