"""String cleaning for raw loads (A-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cell contents that mean "no value" after trimming.
DEFAULT_NULL_MARKERS = ("", "NULL")


def clean_strings(df: DataFrame, columns=None, null_markers=DEFAULT_NULL_MARKERS) -> DataFrame:
    """Trim whitespace; a trimmed cell equal to a null marker becomes null."""
    cols = columns if columns is not None else [
        f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    out = []
    for f in df.columns:
        if f in cols:
            t = F.trim(F.col(f))
            out.append(F.when(~t.isin(*null_markers), t).alias(f))
        else:
            out.append(F.col(f))
    return df.select(*out)
