"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only for a plain local master (tests)."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-llm-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: lineage ends there and a lost
    executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/strata-llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python once per application (it need not be installed there)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.basename(root)
    path = os.path.join(tempfile.mkdtemp(prefix="strata-"), f"{top}_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.write(os.path.join(root, "__init__.py"), f"{top}/__init__.py")
        here = os.path.join(root, "llm")
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                z.write(os.path.join(here, name), f"{top}/llm/{name}")
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names) -> list[str]:
    """The columns of ``df`` that don't clash (case-insensitively) with ``names``."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 4 is 2; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def map_text(df: DataFrame, text: str, fields: list[T.StructField],
             make: Callable[[], Callable[[pa.Array], list]], carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` (default all; those named like a new field go) plus ``fields`` computed per Arrow batch.

    ``make()`` runs once per task and gives the function from a string array (nulls as empty
    texts) to one array per field.
    """
    ship(df.sparkSession)
    names = [f.name for f in fields]
    kept = [c for c in without(df, names) if carry is None or c in carry]
    src = df.select(*[col(c) for c in kept], col(text).cast("string").alias("__text"))
    schema = T.StructType([src.schema[c] for c in kept] + fields)
    types = [pa_type(f.dataType) for f in fields]

    def run(batches):
        compute = make()
        for b in batches:
            texts = b.column(b.num_columns - 1)
            if b.num_rows == 0:
                continue
            out = [x if isinstance(x, pa.Array) else pa.array(x, t)
                   for x, t in zip(compute(pc.fill_null(texts, "")), types, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *out], names=kept + names)

    return src.mapInArrow(run, schema)


def pa_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(pa_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, pa_type(f.dataType)) for f in kind.fields])
    return {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(),
            "float": pa.float32(), "boolean": pa.bool_(), "binary": pa.binary()}[kind.simpleString()]


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, _array(kind) if kind.startswith("array<") else {
        "string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
        "boolean": T.BooleanType(), "binary": T.BinaryType()}[kind])


def _array(kind: str) -> T.ArrayType:
    return T.ArrayType(field("e", kind[6:-1]).dataType)
