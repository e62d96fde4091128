"""Queries: the bronze/silver/gold flow (PIPE-1, SNK-5, SRC-2, FLT-2, SCO-1)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.functions.columns import hash_bucket
from churnlane.operators.contract import Contract, ModelStore
from churnlane.operators.prepare import prepare
from churnlane.operators.score import score_columns
from churnlane.operators.tree import fixed_tree
from churnlane.plans import common
from churnlane.plans.layers import CONF_MODEL, CONF_PATH, churn_layers, run_layers
from churnlane.plans.oracle_sql import BASE, P, bucket, tree_case, with_ctes
from churnlane.plans.refresh import Dataset, Refresher
from churnlane.plans.registry import query
from churnlane.session import scratch_path, unique_name
from churnlane.sources.files import scan_csv, write_csv
from churnlane.sources.tables import FEATURES, KEY

_SILVER = f"""{with_ctes(BASE, P)},
s AS (SELECT customer_id, senior, tenure, monthly, total FROM p
      WHERE customer_id IS NOT NULL AND senior IS NOT NULL AND tenure IS NOT NULL
        AND monthly IS NOT NULL AND total IS NOT NULL)"""


def _run(spark, sf, until):
    path = scratch_path(spark, "bronze-csv")
    raw = common.b(spark, sf)
    write_csv(raw, path)          # the raw file the flow starts from
    spark.conf.set(CONF_PATH, path)
    store = ModelStore(spark, scratch_path(spark, "models"))
    schema = T.StructType([T.StructField(f, T.DoubleType()) for f in FEATURES])
    store.log_model("churn_model", Contract(schema, tree=fixed_tree()), aliases=["layered"])
    spark.conf.set(CONF_MODEL, "churn_model@layered")
    names = run_layers(spark, churn_layers(store, raw.schema), unique_name("flow"), until)
    return spark.read.table(names[until])


@query("layered_bronze", f"""{with_ctes(BASE)}
SELECT customer_id, senior, tenure, monthly, total, churn FROM base""",
       "PIPE-1 SNK-5 SRC-1 SRC-2")
def q_layered_bronze(spark, sf):
    return _run(spark, sf, "bronze")


@query("layered_silver", f"{_SILVER} SELECT * FROM s", "PIPE-1 FLT-2 PRJ-2")
def q_layered_silver(spark, sf):
    return _run(spark, sf, "silver")


@query("layered_gold", f"{_SILVER} SELECT *, {tree_case()} AS prediction FROM s", "PIPE-1 SCO-1 SNK-5")
def q_layered_gold(spark, sf):
    return _run(spark, sf, "gold")


_PART = bucket("customer_id", "part:")


@query("refreshed_gold", f"""{_SILVER}
SELECT *, CASE WHEN {_PART} < 70 THEN 1 ELSE 2 END AS run, {tree_case()} AS prediction,
       'rebuilt,rebuilt,rebuilt appended,appended,appended kept,kept,kept' AS history FROM s""", "PIPE-1 SCO-1")
def q_refreshed_gold(spark, sf):
    """The three layers brought up to date three times: files of 70 % of the customers, then the rest, then nothing new.
    A row is written in the run that first saw its file."""
    raw, path = common.b(spark, sf), scratch_path(spark, "bronze-csv")
    part = hash_bucket(KEY, "part:")
    sel = [KEY, *FEATURES]
    layers = [
        Dataset("bronze", path=f"{path}/*", read=lambda s, files: scan_csv(s, files, raw.schema)),
        Dataset("silver", ("bronze",), lambda s, up: prepare(s.read.table(up["bronze"]).select(*sel), ["senior", "tenure", "total"], subset=sel), row_wise=True),
        Dataset("gold", ("silver",), lambda s, up: score_columns(s.read.table(up["silver"]), fixed_tree()), row_wise=True, definition="fixed tree, 1800")]
    flow = Refresher(spark, scratch_path(spark, "refreshed"), layers)
    history = []
    for k, rows in enumerate((raw.where(part < 70), raw.where(part >= 70), None)):
        if rows is not None:
            write_csv(rows, f"{path}/part-{k}")
        history.append(",".join(flow.refresh().values()))
    return flow.read("gold").withColumn("history", F.lit(" ".join(history)))
