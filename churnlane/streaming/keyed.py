"""The newest row per key as stream state: changed rows out, nothing else (STR-2).

``snapshot.maintain_latest`` writes each micro-batch's newest rows and merges
them when read.  Here the stream itself holds one row a key in its state store
and puts out only keys whose newest row changed, so late and repeated rows cost a
state read and write nothing.  State is keyed and partitioned like the shuffle,
kept outside the heap (RocksDB), versioned with the checkpoint, and expires
``expire_after`` a key's last change (then a late row of that key counts as new).

Rows are reduced before the shuffle, to the newest of a key in each Arrow batch, so a
key with a third of all rows sends one in some ten thousand of them to its task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from churnlane.operators.latest import latest_per_key
from churnlane.session import ship
from churnlane.sources import control

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Rows travel as JSON with all digits of their timestamps.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class Newest(StatefulProcessor):
    """Keeps a key's row of greatest (ts, tie); rows are JSON texts beside an order text that sorts as (ts, tie) does."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        schema = T.StructType().add("rank", "string").add("row", "string")
        self.newest = handle.getValueState("newest", schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.newest.get() if self.newest.exists() else None
        best = held
        for pdf in rows:
            for rank, row in zip(pdf["rank"], pdf["row"]):
                if best is None or rank > best[0]:
                    best = (rank, row)
        if best is not held:
            self.newest.update(best)
            yield pd.DataFrame({"row": [best[1]]})

    def close(self) -> None:
        pass


def order_text(columns: Sequence[str], schema: T.StructType) -> F.Column:
    """A text that sorts by bytes as the columns do in order, NULL first: for integers, timestamps, dates and text."""
    def one(c: str):
        t, v = schema[c].dataType, F.col(c)
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            number = F.unix_micros(v.cast("timestamp"))
        elif isinstance(t, T.DateType):
            number = F.datediff(v, F.lit("1970-01-01").cast("date")).cast("long")
        elif isinstance(t, T.IntegralType):
            number = v.cast("long")
        elif isinstance(t, T.StringType):
            return F.coalesce(F.concat(F.lit("1"), F.hex(v), F.lit(" ")), F.lit("0 "))       # a blank sorts before any digit
        else:
            raise ValueError(f"{c}: {t.simpleString()} has no order text")
        # offset by 2^63: sixteen hexadecimal digits in order
        return F.coalesce(F.concat(F.lit("1"), F.lpad(F.hex(number.bitwiseXOR(F.lit(-(2 ** 63)).cast("long"))), 16, "0")), F.lit("0"))
    return F.concat(*[one(c) for c in columns])


def _newest_of_batches(keys: list[str]):
    def reduce(batches):
        for b in batches:
            ordered = pa.Table.from_batches([b]).sort_by("rank")
            last = pa.TableGroupBy(ordered, keys, use_threads=False).aggregate([("rank", "last"), ("row", "last")])
            yield from last.rename_columns([c.removesuffix("_last") for c in last.column_names]).select(b.schema.names).to_batches()
    return reduce


def newest_changes(spark: SparkSession, events_path: str, schema: T.StructType, out_path: str, checkpoint: str, key: Sequence[str] | str, ts: str,
                   tie: Sequence[str] | str = (), expire_after: int | None = None, max_files_per_trigger: int | None = None,
                   trigger: dict | None = None, wait: bool = True):
    """Start the stream: each micro-batch's changed newest rows go to ``out_path/batch=<id>``.  ``expire_after``: seconds."""
    ship()
    keys = [key] if isinstance(key, str) else list(key)
    ties = [tie] if isinstance(tie, str) else list(tie)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        rows = reader.parquet(events_path).select(
            *keys, order_text([ts, *ties], schema).alias("rank"), F.to_json(F.struct(*schema.names), JSON | {"ignoreNullFields": "false"}).alias("row"))
        rows = rows.mapInArrow(_newest_of_batches(keys), rows.schema)
        changed = rows.groupBy(*keys).transformWithStateInPandas(
            Newest(expire_after * 1000 if expire_after else None), T.StructType().add("row", "string"), "Update",
            "ProcessingTime" if expire_after else "None")

        def sink(batch: DataFrame, batch_id: int) -> None:
            (batch.select(F.from_json("row", schema, JSON).alias("r")).select("r.*")
                  .write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}"))

        q = (changed.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"availableNow": True})).start())
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
    if wait:
        q.awaitTermination()
    return q


def merged_changes(spark: SparkSession, out_path: str, key: Sequence[str] | str, ts: str, tie: Sequence[str] | str = ()) -> DataFrame:
    """The newest row per key from the changes of all committed batches."""
    done = control.list_numbered(spark, out_path, r"batch=(\d+)", "_SUCCESS") or []
    return latest_per_key(spark.read.parquet(*[f"{out_path}/batch={b}" for b in done]), key, ts, tie)
