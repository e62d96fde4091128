"""Model contract and a file-based model store (CTR-1..3, SNK-9, AGG-1 on versions).

A stored model version is a directory holding
  ``contract.json`` – input schema (ordered features and types), label,
                      classes, result type, the feature lookups the model was
                      trained with, and the tree spec (for native scoring);
  ``model/``        – the saved ``pyspark.ml`` PipelineModel, when there is one;
  ``user_model``    – a pickled object with ``predict(pdf)``, when there is one
                      (loading it runs its code: load only from a trusted store).

The registry itself (names, integer versions, lower-cased aliases) is a
list of small JSON events next to the versions: control-plane data, never row data.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, IntegralType, NumericType, StructType

from churnlane.operators.features import FeatureLookup
from churnlane.session import ship
from churnlane.sources import control
from churnlane.operators.tree import TreeSpec


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Contract:
    input_schema: StructType                  # ordered features with types
    label: str | None = None
    classes: tuple[str, ...] = ()
    result_type: str = "string"
    lookups: tuple[FeatureLookup, ...] = ()
    key: str | None = None
    tree: TreeSpec | None = None
    outputs: StructType | None = None         # output signature; of a user model the columns it returns
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def features(self) -> list[str]:
        return [f.name for f in self.input_schema.fields]

    def to_json(self) -> str:
        return json.dumps({
            "input_schema": json.loads(self.input_schema.json()),
            "label": self.label, "classes": list(self.classes),
            "result_type": self.result_type,
            "lookups": [fl.to_dict() for fl in self.lookups], "key": self.key,
            "tree": json.loads(self.tree.to_json()) if self.tree else None,
            "outputs": json.loads(self.outputs.json()) if self.outputs else None,
            "extra": self.extra})

    @staticmethod
    def from_json(text: str) -> "Contract":
        d = json.loads(text)
        return Contract(
            StructType.fromJson(d["input_schema"]), d.get("label"), tuple(d.get("classes") or ()),
            d.get("result_type", "string"),
            tuple(FeatureLookup.from_dict(x) for x in d.get("lookups") or ()), d.get("key"),
            TreeSpec.from_json(json.dumps(d["tree"])) if d.get("tree") else None,
            StructType.fromJson(d["outputs"]) if d.get("outputs") else None, d.get("extra") or {})


def capture_schema(df: DataFrame, features: Sequence[str]) -> StructType:
    """Input signature of a model: the feature columns' schema (CTR-1)."""
    return df.select(*features).schema


def _loses(given: Column, value: Column, source: DataType, target: DataType) -> Column:
    """Whether ``value``, ``given`` cast to ``target``, is no longer the value that was sent."""
    gone = given.isNotNull() & value.isNull()
    if not (isinstance(source, NumericType) and isinstance(target, NumericType)):
        return gone
    if isinstance(target, FractionalType) and not isinstance(target, DecimalType) and not isinstance(source, IntegralType):
        wide = lambda c: F.abs(c.cast("double")) == float("inf")  # noqa: E731  a narrower fraction is rounded, but not to infinity
        return gone | (wide(value) & ~wide(given))
    return gone | (given.isNotNull() & ~value.try_cast(source).eqNullSafe(given))


def conform(df: DataFrame, contract: Contract, keep: Sequence[str] = (),
            strict: bool = True) -> DataFrame:
    """Make scoring input match the contract, by name (CTR-2).

    Missing required feature -> error; numbers are cast to the declared
    type (ints sent for double features).  A value that does not survive the
    cast (text in a number column, a fraction or too large a number for an
    integer) is an error, or NULL unless ``strict``; extra columns are dropped
    except ``keep`` (e.g. the key).
    """
    have = {c.lower(): c for c in df.columns}
    missing = [f.name for f in contract.input_schema.fields if f.name.lower() not in have]
    if missing:
        raise ContractError(f"input lacks required columns {missing}")
    cols = [F.col(k) for k in keep if k.lower() in have]
    for f in contract.input_schema.fields:
        given = F.col(have[f.name.lower()])
        value, source = given.try_cast(f.dataType), df.schema[have[f.name.lower()]].dataType
        if source != f.dataType:
            lost = F.lit(None).cast(f.dataType)
            if strict:
                lost = F.raise_error(F.concat(F.lit(f"{f.name} is not {f.dataType.simpleString()}: "), given.cast("string"))).cast(f.dataType)
            value = F.when(_loses(given, value, source, f.dataType), lost).otherwise(value)
        cols.append(value.alias(f.name))
    return df.select(*cols)


# -- store -------------------------------------------------------------------

class ModelStore:
    """Versions under ``root/<name>/<version>/``; registry events in ``root/<name>/event-<n>``.

    Control files go through the session's Hadoop file system
    (``sources.control``), so ``root`` may be any cluster file system (the
    shared ``spark.checkpoint.dir``), never a machine-local folder.  Each
    registry update is a new event file; its number and a version's number are
    taken by creating a file that must not exist yet, so writers at the same
    time neither share a version nor undo each other's aliases.
    """

    def __init__(self, spark, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _write_text(self, path: str, text: str) -> None:
        control.write_text(self.spark, path, text)

    def _read_text(self, path: str) -> str | None:
        return control.read_text(self.spark, path)

    def _registry(self, name: str) -> dict:
        """Versions and aliases: the registry's events in order."""
        reg: dict = {"versions": [], "aliases": {}}
        for text in control.read_numbered(self.spark, f"{self.root}/{name}", "event"):
            event = json.loads(text)
            if "version" in event:
                reg["versions"].append(event["version"])
            reg["aliases"].update(event["aliases"])
        return reg

    def _take(self, name: str, series: str) -> int:
        """The next number of a series; of several writers each gets its own."""
        taken = control.list_numbered(self.spark, f"{self.root}/{name}", rf"{series}-(\d+)") or [0]
        n = taken[-1] + 1
        while not control.create_text(self.spark, f"{self.root}/{name}/{series}-{n}", "taken"):
            n += 1
        return n

    def _record(self, name: str, event: dict) -> None:
        self._write_text(f"{self.root}/{name}/event-{self._take(name, 'turn')}", json.dumps(event))

    def log_model(self, name: str, contract: Contract, pipeline_model=None,
                  aliases: Sequence[str] = (), user_model=None) -> int:
        """Store a new version (integer, one above the highest) and point ``aliases`` at it.

        A ``user_model`` needs ``contract.outputs``, the columns it returns.
        """
        if user_model is not None and contract.outputs is None:
            raise ContractError("a user model needs its output signature")
        version = self._take(name, "claim")
        d = f"{self.root}/{name}/{version}"
        if pipeline_model is not None:
            pipeline_model.write().overwrite().save(f"{d}/model")
        if user_model is not None:
            ship()
            self._write_text(f"{d}/user_model", base64.b64encode(cloudpickle.dumps(user_model)).decode())
        self._write_text(f"{d}/contract", contract.to_json())
        self._record(name, {"version": str(version), "aliases": {a.lower(): str(version) for a in aliases}})
        return version

    def latest_version(self, name: str) -> int:
        """Highest version compared as an integer, so 10 > 9 (G6)."""
        vs = [int(v) for v in self._registry(name)["versions"]]
        return max(vs) if vs else 0

    def set_alias(self, name: str, alias: str, version: int) -> None:
        self._record(name, {"aliases": {alias.lower(): str(version)}})  # aliases are case-insensitive (G5)

    def resolve(self, uri: str) -> str:
        """``name@alias`` or ``name/version`` -> version directory."""
        if "@" in uri:
            name, alias = uri.split("@", 1)
            version = self._registry(name)["aliases"][alias.lower()]
        else:
            name, version = uri.rsplit("/", 1)
        return f"{self.root}/{name}/{version}"

    def load_contract(self, uri: str) -> Contract:
        return Contract.from_json(self._read_text(f"{self.resolve(uri)}/contract"))

    def load_pipeline(self, uri: str):
        from pyspark.ml import PipelineModel
        return PipelineModel.load(f"{self.resolve(uri)}/model")

    def load_user_model(self, uri: str):
        return cloudpickle.loads(base64.b64decode(self._read_text(f"{self.resolve(uri)}/user_model")))
