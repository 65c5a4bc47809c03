"""Auto-ingest (A-7, A-8) and the end-to-end incremental run (S-1).

A file source with a checkpoint loads each new file exactly once; the first
run also loads the files already present (backfill).  ``availableNow`` runs
whatever has arrived and stops, which is what an arrival notification should
trigger.  ``foreachBatch`` hands every micro-batch to the pipeline with a
batch id taken from the query checkpoint, so a replayed batch is a no-op.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.csv import csv_options, csv_schema, read_raw, shape_raw


def raw_stream(spark: SparkSession, landing: str, columns, multi_line: bool = True,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of the landing folder under the bronze file contract."""
    opts = csv_options(multi_line, recursive=True)
    r = spark.readStream.schema(csv_schema(columns)).options(**opts)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(landing)


def new_contents(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the files whose content no file had before: ``path`` and ``digest``.

    The digests seen are the query's state (state store, partitioned by digest); a file's bytes are hashed by the
    task that reads it and go no further.  Of equal files that arrive together one passes.
    """
    r = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    r = r.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(landing).select("path", F.sha2("content", 256).alias("digest")).dropDuplicates(["digest"])


def run_available(spark: SparkSession, landing: str, checkpoint: str, columns, on_batch,
                  multi_line: bool = True, name: str | None = None, max_files_per_trigger: int | None = None,
                  by_content: bool = False):
    """Process every file that arrived since the last run, then stop.

    ``on_batch(df, batch_id)`` receives the shaped raw rows (data columns,
    ``_corrupt_record``, ``_file``); a backlog comes in batches of ``max_files_per_trigger`` files.
    A file is known by its name, so one delivered again under a new name loads again; with ``by_content`` it is known by
    its bytes and does not.  Each choice has its own checkpoint.  (Files beyond 2 GB can't be told by content.)
    """
    if by_content:
        shaped = new_contents(spark, landing, max_files_per_trigger)
    else:
        shaped = shape_raw(raw_stream(spark, landing, columns, multi_line, max_files_per_trigger), columns)

    def handle(df, batch_id):
        if by_content:
            paths = sorted(r["path"] for r in df.select("path").collect())  # names of a batch's files, as the source itself lists them
            if not paths:
                return
            df = read_raw(spark, paths, columns, multi_line)
        on_batch(df, int(batch_id))

    w = shaped.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    return q


def stream_to_bronze(spark, landing, checkpoint, columns, bronze_path, run_ts, widths=None, multi_line: bool = True,
                     by_content: bool = False):
    """Load-once ingest into a bronze Parquet table partitioned by batch id.

    Each micro-batch overwrites only its own ``batch=N`` directory, so a replay
    rewrites the same rows instead of appending them twice.  Without line breaks
    in cells, ``multi_line=False`` lets a large file be read by many tasks.
    """
    from ..sources.csv import classify, stamp

    def sink(df, batch_id):
        out = stamp(classify(df, widths), F.lit(run_ts).cast("timestamp_ntz"))
        out.write.mode("overwrite").parquet(f"{bronze_path}/batch={batch_id}")

    return run_available(spark, landing, checkpoint, columns, sink, multi_line, by_content=by_content)
