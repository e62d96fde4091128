"""Layers refreshed only where their inputs changed (PIPE-1).

``run_layers`` rewrites every dataset.  Here a layer's rows are written once, in
the folder of the run that first saw their input:

* a source layer's state is its files (size and time of each); files not seen
  before are the run's input;
* a row-wise layer (each output row from one input row: cast, filter, score)
  builds the run's rows from its input's rows of the same run;
* any other layer is built anew from all of its input, and replaces its own older runs;
* a file that changed or vanished, or a layer whose definition changed (its
  ``definition`` text, such as a model version), rebuilds what depends on it.

What belongs to a dataset is the list of its runs in the newest manifest, a small
numbered file written after the data.  A failed run leaves the old
manifest; its folders are overwritten by the next run, which has the same number.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from churnlane.session import unique_name
from churnlane.sources import control


@dataclass(frozen=True)
class Dataset:
    """``read(spark, paths)`` for a source (``path`` names its files), else ``build(spark, {input: name of a view})``."""
    name: str
    inputs: tuple[str, ...] = ()
    build: Callable[[SparkSession, dict[str, str]], DataFrame] | None = None
    path: str | None = None
    read: Callable[[SparkSession, list[str]], DataFrame] | None = None
    row_wise: bool = False
    definition: str = ""


class Refresher:
    def __init__(self, spark: SparkSession, root: str, datasets: list[Dataset]):
        self.spark, self.root, self.datasets = spark, root, datasets
        names = [d.name for d in datasets]
        for k, d in enumerate(datasets):
            if (d.path is None) == (not d.inputs) or not set(d.inputs) <= set(names[:k]):
                raise ValueError(f"{d.name}: files or inputs, and inputs first")
            if d.row_wise and len(d.inputs) != 1:
                raise ValueError(f"{d.name}: row by row from one input")

    def _manifest(self) -> dict:
        n = control.list_numbered(self.spark, self.root, r"manifest-(\d+)") or [0]
        text = control.read_text(self.spark, f"{self.root}/manifest-{n[-1]}")
        return json.loads(text) if text else {"number": 0, "datasets": {}}

    def _folder(self, name: str, run: int) -> str:
        return f"{self.root}/{name}/run={run}"

    def read(self, name: str) -> DataFrame:
        """A dataset as of its newest manifest, with its column ``run``."""
        return self._runs(name, self._manifest()["datasets"][name]["runs"])

    def _runs(self, name: str, runs: list[int]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.root}/{name}").parquet(*[self._folder(name, r) for r in runs])

    def refresh(self) -> dict[str, str]:
        """Brings all datasets up to date: what was done to each, ``kept``, ``appended`` or ``rebuilt``."""
        old = self._manifest()
        run = old["number"] + 1
        new: dict = {"number": run, "datasets": {}}
        done: dict[str, str] = {}
        for d in self.datasets:
            was = old["datasets"].get(d.name)
            same = was is not None and was["definition"] == d.definition
            states = control.file_states(self.spark, d.path) if d.path else {}
            if d.path:
                same = same and all(states.get(p) == s for p, s in was["files"].items())
                fresh = sorted(p for p in states if not same or p not in was["files"])
                todo = "rebuilt" if not same else "appended" if fresh else "kept"
            else:
                ups = {done[i] for i in d.inputs}
                todo = ("rebuilt" if not same or "rebuilt" in ups else "kept" if ups == {"kept"}
                        else "appended" if d.row_wise else "rebuilt")
            if todo == "kept":
                runs = was["runs"]
            else:
                if d.path:
                    df = d.read(self.spark, fresh)
                else:
                    only = [run] if todo == "appended" else None
                    df = d.build(self.spark, {i: self._view(i, only or new["datasets"][i]["runs"]) for i in d.inputs})
                df.write.mode("overwrite").parquet(self._folder(d.name, run))
                runs = [*(was["runs"] if todo == "appended" else ()), run]
            new["datasets"][d.name] = {"runs": runs, "definition": d.definition, "files": states}
            done[d.name] = todo
        if set(done.values()) != {"kept"}:
            control.write_text(self.spark, f"{self.root}/manifest-{run}", json.dumps(new))
            self._expire(old, new)
        return done

    def _view(self, name: str, runs: list[int]) -> str:
        view = unique_name(f"refresh_{name}")
        self._runs(name, runs).drop("run").createOrReplaceTempView(view)
        return view

    def _expire(self, old: dict, new: dict) -> None:
        """Removes runs that neither the new manifest nor the one before it has: readers of the old one may still run."""
        for d in self.datasets:
            held = {r for m in (old, new) for r in m["datasets"].get(d.name, {"runs": []})["runs"]}
            for r in control.list_numbered(self.spark, f"{self.root}/{d.name}", r"run=(\d+)") or []:
                if r not in held:
                    control.delete(self.spark, self._folder(d.name, r))
