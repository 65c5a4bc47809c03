"""Delimited-file source with a format contract (A-1 ... A-6, A-10).

Contract: comma separated, one header line per file (skipped, never read:
columns bind by position), optional ``"`` enclosure with doubled quotes,
whitespace trimmed, ``''`` and ``NULL`` read as null, and a row with the wrong
number of fields set aside (with its raw text) while the load goes on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import DEFAULT_NULL_MARKERS, clean_strings

CORRUPT = "_corrupt_record"
REASON = "_reject_reason"
FILE = "_file"


def csv_schema(columns, corrupt_col: str = CORRUPT) -> str:
    return ", ".join([f"`{c}` string" for c in columns] + [f"`{corrupt_col}` string"])


def csv_options(multi_line: bool = True, recursive: bool = True, corrupt_col: str = CORRUPT) -> dict:
    """Reader options of the contract.  ``multiLine`` reads a file in one task
    (cells may hold line breaks); turn it off for large files without them so
    a file splits across tasks."""
    return {"header": "true", "sep": ",", "quote": '"', "escape": '"', "multiLine": str(multi_line).lower(),
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col,
            "recursiveFileLookup": str(recursive).lower(), "enforceSchema": "true"}


def read_raw(spark: SparkSession, path, columns, multi_line: bool = True, recursive: bool = True,
             null_markers=DEFAULT_NULL_MARKERS, with_file: bool = True) -> DataFrame:
    """Positional projection of every file under ``path`` into ``columns`` (all strings),
    trimmed, null markers applied; ``_corrupt_record`` holds the raw text of a
    row with the wrong field count (A-1, A-2, A-3, A-4)."""
    df = spark.read.schema(csv_schema(columns)).options(**csv_options(multi_line, recursive)).csv(path)
    return shape_raw(df, columns, null_markers, with_file)


def shape_raw(df: DataFrame, columns, null_markers=DEFAULT_NULL_MARKERS, with_file: bool = True) -> DataFrame:
    """Trim + null markers on the data columns; keep the raw text and the file name."""
    extra = [F.col("_metadata.file_path").alias(FILE)] if with_file else []
    out = df.select(*columns, CORRUPT, *extra)
    return clean_strings(out, list(columns), null_markers)


def width_violations(widths: dict) -> Column:
    """First column over its declared width (VARCHAR(n)) as ``'width:<col>'``, else null (A-5)."""
    e = F.lit(None).cast("string")
    for c, n in reversed(list(widths.items())):
        e = F.when(F.char_length(F.col(c)) > n, F.lit(f"width:{c}")).otherwise(e)
    return e


def classify(df: DataFrame, widths: dict | None = None) -> DataFrame:
    """Add ``_reject_reason``: 'column_count' for a malformed row, 'width:<col>' for
    an over-width value, null for a good row.  One pass, no extra read."""
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("column_count"))
    if widths:
        reason = reason.otherwise(width_violations(widths))
    return df.withColumn(REASON, reason)


def good_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REASON).isNull()).drop(CORRUPT, REASON)


def reject_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REASON).isNotNull())


def split_rejects(classified: DataFrame):
    """(good, rejects) of a classified read; persist the input first when both are written."""
    return good_rows(classified), reject_rows(classified)


def stamp(df: DataFrame, ts, col: str = "_ingested_at") -> DataFrame:
    """Ingest timestamp (A-6); an argument, so a re-run stamps the same value."""
    t = ts if isinstance(ts, Column) else F.lit(ts).cast("timestamp_ntz")
    return df.withColumn(col, t)


def load_report(classified: DataFrame, file_col: str = FILE) -> DataFrame:
    """Per file: rows read, loaded, rejected and the first (smallest) raw rejected record (A-10).

    A grouping by file with map-side partial aggregation: one row per file.
    """
    rej = F.col(REASON).isNotNull()
    return classified.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~rej).alias("rows_loaded"),
        F.count_if(rej).alias("rows_rejected"),
        F.min(F.col(CORRUPT)).alias("first_error"))
