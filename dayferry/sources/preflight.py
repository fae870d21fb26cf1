"""Is each source and target readable, and does it have what the mapping needs?"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayferry.frames import small_frame
from dayferry.operators.project import column
from dayferry.operators.window import time_type
from dayferry.registry import TableSpec

REPORT_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("message", T.StringType()),
    T.StructField("records", T.LongType()),
    T.StructField("first_day", T.DateType()),
    T.StructField("last_day", T.DateType()),
    T.StructField("missing_columns", T.StringType()),
])


@dataclass(frozen=True)
class Probe:
    """A table to check. ``summarize`` gives one row of count, first and last time for a source
    that can work it out by itself; otherwise Spark aggregates the time column."""

    name: str
    kind: str  # "source" or "target"
    open: Callable[[SparkSession], DataFrame]
    time_column: str
    spec: TableSpec | None = None
    summarize: Callable[[SparkSession], DataFrame] | None = None


def preflight(spark: SparkSession, probes: Sequence[Probe], scope: str = "all") -> DataFrame:
    """One row per probe of the scope: ``source``, ``target`` or ``all``.

    Each probe is run on its own, so that one unreadable table is reported and the others are
    still checked; they run at the same time.
    """
    chosen = [p for p in probes if scope == "all" or p.kind == scope]
    with ThreadPoolExecutor(max(1, len(chosen))) as pool:
        run = inheritable_thread_target(spark)(_run)
        rows = [r.result() for r in [pool.submit(run, spark, p) for p in chosen]]
    return small_frame(spark, rows, REPORT_SCHEMA)


def _run(spark: SparkSession, probe: Probe) -> dict:
    report = dict.fromkeys(REPORT_SCHEMA.names) | {"name": probe.name, "kind": probe.kind, "success": False}
    try:
        df = probe.open(spark)
        missing = probe.spec.missing_columns(df.columns) if probe.spec else []
        report["missing_columns"] = ",".join(missing)
        found = probe.summarize(spark) if probe.summarize else _summary(df, probe.time_column)
        records, first, last = (F.col(f"`{c}`") for c in found.columns)
        report |= found.select(
            records.cast("bigint").alias("records"),
            first.try_cast("date").alias("first_day"),
            last.try_cast("date").alias("last_day"),
        ).first().asDict()
        if missing:
            report["message"] = f"{probe.name} lacks mapped columns"
        else:
            report |= {"success": True, "message": f"{probe.name} connection successful"}
    except Exception as e:
        report["message"] = f"{probe.name} connection failed: {e}"
    return report


def _summary(df: DataFrame, time_column: str) -> DataFrame:
    t = column(time_column)
    t = t.try_cast("date") if time_type(df, time_column) == "string" else t
    return df.agg(F.count(F.lit(1)).alias("records"), F.min(t).alias("first"), F.max(t).alias("last"))
