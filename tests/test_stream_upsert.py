"""Keyed stream state against the batch MERGE of the same loads, across restarts."""

from conftest import rows
from strata.operators.latest import latest_per_key
from strata.operators.merge import merge
from strata.streaming.upsert import current_rows, state_store, upsert_stream
from pyspark.sql import functions as F

SCHEMA = "k bigint, ts int, id bigint, v string"
BIG = 2 ** 60 + 1  # a float would lose its last digit
LOADS = [
    [(1, 5, 1, "a"), (1, 5, 2, "b"), (1, None, 9, "x"), (2, 1, BIG, "c"), (None, 1, 4, "n"), (None, 2, 5, "m")],
    [(1, 1, 6, "later load wins"), (3, 1, BIG, None), (None, 1, 8, "again")],
    [(3, 2, 9, "d"), (3, 2, 9, "d"), (BIG, 0, 10, "e")]]


def test_equals_the_merge_of_loads(spark, tmp_path):
    landing, ckpt, path = (str(tmp_path / n) for n in ("in", "ckpt", "out"))
    target = spark.createDataFrame([], SCHEMA + ", _last_updated int")
    with state_store(spark):
        for i, load in enumerate(LOADS):
            df = spark.createDataFrame(load, SCHEMA)
            df.repartition(2).write.mode("append").parquet(landing)
            for _ in range(2):  # the second run finds nothing new
                upsert_stream(spark.readStream.schema(df.schema).parquet(landing), "k", "ts", ["id"], path, ckpt, lambda b: F.lit(b))
            last = latest_per_key(df, "k", "ts", ["id"])
            target = merge(target, last, "k", set_on_update={"_last_updated": F.lit(i)}, set_on_insert={"_last_updated": F.lit(i)}).drop("_op").checkpoint()
            now = current_rows(spark.read.parquet(path), "k")
            assert rows(now, "k", "ts", "id", "v", "_last_updated") == rows(target)
    ops = {(r["k"], r["batch"]): r["_op"] for r in spark.read.parquet(path).collect()}
    assert ops == {(1, 0): "INSERT", (2, 0): "INSERT", (None, 0): "INSERT", (1, 1): "UPDATE", (3, 1): "INSERT", (None, 1): "INSERT", (3, 2): "UPDATE", (BIG, 2): "INSERT"}
