"""Three-layer table flow, triggered once (PIPE-1, SNK-5, SRC-2).

raw CSV (bronze) -> selected, typed, complete features (silver) -> predictions (gold).
Each layer is a plain function returning a DataFrame; ``run_layers`` writes
them in dependency order as named tables with a comment and a ``quality``
property.  A stored table between layers cuts the plan, as in the reference.
The input path and model come from session conf keys (SRC-2).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from churnlane.operators.contract import ModelStore
from churnlane.operators.prepare import prepare
from churnlane.operators.score import score_stored
from churnlane.sources.files import scan_csv
from churnlane.sources.sinks import materialize
from churnlane.sources.tables import FEATURES, KEY

CONF_PATH = "churnlane.bronze_dataset_path"
CONF_MODEL = "churnlane.model_name"


@dataclass(frozen=True)
class Layer:
    name: str
    build: Callable[[SparkSession, dict[str, str]], DataFrame]  # (spark, upstream names) -> df
    inputs: tuple[str, ...]
    comment: str
    quality: str


def churn_layers(store: ModelStore, schema: StructType | str, names: tuple[str, str, str] = ("bronze", "silver", "gold"),
                 comments: tuple[str, str, str] = ("", "", "")) -> list[Layer]:
    """The flow's layers: bronze reads files of the declared ``schema``, so types do not follow the data; gold scores with the model that ``CONF_MODEL`` names in ``store``."""
    raw_name, feature_name, scored_name = names

    def bronze(spark, up):
        return scan_csv(spark, spark.conf.get(CONF_PATH), schema)

    def silver(spark, up):
        raw = spark.read.table(up[raw_name])
        sel = [KEY, *FEATURES]
        # completeness only over the selected columns (G3)
        return prepare(raw.select(*sel), ["senior", "tenure", "total"], subset=sel)

    def gold(spark, up):
        return score_stored(spark, store, spark.conf.get(CONF_MODEL), spark.read.table(up[feature_name]))

    return [Layer(raw_name, bronze, (), comments[0], "bronze"),
            Layer(feature_name, silver, (raw_name,), comments[1], "silver"),
            Layer(scored_name, gold, (feature_name,), comments[2], "gold")]


def run_layers(spark: SparkSession, layers: list[Layer], prefix: str,
               until: str | None = None) -> dict[str, str]:
    """Materialise layers in dependency order; returns logical -> table name."""
    done: dict[str, str] = {}
    pending = list(layers)
    while pending:
        ready = [l for l in pending if all(i in done for i in l.inputs)]
        if not ready:
            raise ValueError(f"cycle or missing input among {[l.name for l in pending]}")
        for layer in ready:
            name = f"{prefix}_{layer.name}"
            materialize(spark, name, layer.build(spark, done), layer.comment,
                        {"quality": layer.quality})
            done[layer.name] = name
            pending.remove(layer)
            if layer.name == until:
                return done
    return done
