"""Small literal frames and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    T.LongType(): pa.int64(),
    T.IntegerType(): pa.int32(),
    T.DoubleType(): pa.float64(),
    T.StringType(): pa.string(),
    T.BooleanType(): pa.bool_(),
    T.DateType(): pa.date32(),
    T.TimestampNTZType(): pa.timestamp("us"),
    T.TimestampType(): pa.timestamp("us", "UTC"),
    T.ArrayType(T.StringType()): pa.list_(pa.string()),
    T.DecimalType(38, 0): pa.decimal128(38, 0),
}


def fields(**types: T.DataType) -> T.StructType:
    """A schema by names, without a session."""
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def small_frame(spark: SparkSession, rows: Iterable[Mapping], schema: T.StructType) -> DataFrame:
    """A literal frame for a handful of driver-side rows.

    Going through Arrow gives a LocalRelation, so Catalyst knows the exact size and can
    choose a broadcast by its own threshold; a Python list would give an RDD scan of unknown size.
    """
    arrow = pa.schema([pa.field(f.name, _ARROW[f.dataType]) for f in schema.fields])
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), schema=arrow), schema=schema)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for written tables, under the folder the cluster names for checkpoints.

    Executors write there, so it must be shared. A session that names none gets a folder beside
    its warehouse tables, which every executor reaches too; never a temporary folder of one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for made in _scratches:
        made.append(path)
    return path


_scratches: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the shared folders that are made inside, also by other threads, at the end.

    For a job that writes its result inside: frames that were built there can't be read afterwards.
    """
    from dayferry.sources.hadoop import Files

    made: list[str] = []
    _scratches.append(made)
    try:
        yield
    finally:
        _scratches[:] = [s for s in _scratches if s is not made]
        for path in made:
            Files(spark, path).delete(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame written to a shared folder and read back, so that later jobs don't compute it again.

    Unlike a cached frame it survives lost executors.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
