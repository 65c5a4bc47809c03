"""Silver kept as stream state (S-1, W-1, M-1): the latest row of each key lives in the state store, changes come out.

The batch pipeline reads the target to tell matched keys from new ones.  Here the query's own state holds each key's
current row, so a micro-batch reads its own rows and its keys' state and nothing else; what it emits are the rows that
the MERGE would have written.  State is partitioned by key and checkpointed with the query, so a restart goes on where
the last run ended.  Rows are reduced to one a key and Arrow batch before the shuffle, so a hot key sends few.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OP = "_op"
#: What transformWithState needs; the session that runs the stream must have it set.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def state_store(spark: SparkSession):
    """The session with :data:`STATE_STORE`, as it was afterwards."""
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _place(row: Row, order: list) -> list:
    """The row's place in the order, unknown values first."""
    return [(row[c] is not None, row[c] if row[c] is not None else 0) for c in order]


class LatestRow(StatefulProcessor):
    """Keeps how often a key was updated; emits each batch's latest row as INSERT or UPDATE."""

    def __init__(self, key: list, order: list):
        self.key, self.order = key, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("updates", T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        best = max(rows, key=lambda r: _place(r, self.order))
        if any(best[k] is None for k in self.key):  # a null key never matches (Q3): new each time, and never kept
            op, n = "INSERT", 0
        elif self.state.exists():
            op, n = "UPDATE", self.state.get()[0] + 1
            self.state.update((n,))
        else:
            op, n = "INSERT", 0
            self.state.update((n,))
        yield Row(**best.asDict(), **{OP: op, "_updates": n})

    def close(self) -> None:
        pass


def upsert_changes(rows: DataFrame, key, order_by: str, tie_break) -> DataFrame:
    """The change stream of a keyed table: for each key of a micro-batch its latest row, with ``_op`` and ``_updates`` (how often it was
    updated before).  A later batch wins over an earlier one, as in the MERGE of loads; within one the latest by (order, tie-break).

    The package must be importable on the executors, as for any Python code that Spark runs there.
    """
    key, order = [key] if isinstance(key, str) else list(key), [order_by, *tie_break]
    schema = rows.schema

    def reduced(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in order], null_placement="at_start"))
            last = t.append_column("__i", pa.array(range(t.num_rows), pa.int64())).group_by(key).aggregate([("__i", "max")])["__i_max"]
            yield from t.take(last).to_batches()

    out = T.StructType(schema.fields + [T.StructField(OP, T.StringType()), T.StructField("_updates", T.LongType())])
    return rows.mapInArrow(reduced, schema).groupBy(*key).transformWithState(
        statefulProcessor=LatestRow(key, order), outputStructType=out, outputMode="Update", timeMode="None")


def upsert_stream(rows: DataFrame, key, order_by: str, tie_break, path: str, checkpoint: str, stamp) -> None:
    """Runs the change stream over what has arrived and appends its changes under ``path``, a folder a micro-batch (replays
    overwrite their own).  ``stamp(batch_id)`` gives the ``_last_updated`` of the batch."""
    def sink(df: DataFrame, batch_id: int) -> None:
        df.withColumn("_last_updated", stamp(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    q = (upsert_changes(rows, key, order_by, tie_break).writeStream.foreachBatch(sink).outputMode("update")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def current_rows(changes: DataFrame, key) -> DataFrame:
    """The table that the changes add up to: the last change of each key; a null key's rows are all there."""
    key = [key] if isinstance(key, str) else list(key)
    null = F.lit(False)
    for k in key:
        null = null | F.col(k).isNull()
    last = changes.filter(~null).groupBy(*key).agg(F.max_by(F.struct(*[c for c in changes.columns if c not in key]), F.struct("_updates", "batch")).alias("__r"))
    return last.select(*key, "__r.*").select(*changes.columns).unionByName(changes.filter(null))
