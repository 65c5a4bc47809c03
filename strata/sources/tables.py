"""Written tables: the sink every batch ends in, and the way lineage is cut.

A table is a Parquet directory in the shared folder.  Writing it and reading
it back (instead of ``localCheckpoint``) keeps the result when an executor is
lost and gives the planner real file-size statistics for later joins.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Full-table read (A-11)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> DataFrame:
    """Write ``df`` as Parquet and return the written table."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def run_concurrently(tasks: dict, max_workers: int = 8) -> dict:
    """Run independent driver-side steps (each launching its own Spark jobs) in
    parallel threads; Spark schedules their jobs side by side."""
    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as ex:
        futs = {k: ex.submit(f) for k, f in tasks.items()}
        return {k: f.result() for k, f in futs.items()}


def write_all(tables: dict, root: str) -> dict:
    """Write several tables concurrently under ``root``/<name>."""
    return run_concurrently({k: (lambda k=k, v=v: write_table(v, f"{root}/{k}")) for k, v in tables.items()})
