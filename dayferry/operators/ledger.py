"""The append-only run ledger."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayferry.frames import small_frame
from dayferry.functions import (
    count_or_zero,
    duration_text,
    local_text,
    names_label,
    run_status_class,
    seconds_between,
    status_label,
    text_or_dash,
)

DEFAULT_LIMIT = 50
MAX_LIMIT = 2**31 - 1

LEDGER_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("tables_migrated", T.StringType()),
    T.StructField("total_records", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
])

_RECORD_SCHEMA = T.StructType([
    *[f for f in LEDGER_SCHEMA.fields if f.name not in ("tables_migrated", "duration_seconds")],
    T.StructField("tables", T.ArrayType(T.StringType())),
])


def run_record(
    spark: SparkSession,
    id: int,
    start_time: dt.datetime,
    end_time: dt.datetime | None,
    status: str,
    tables: Sequence[str] | None,
    total_records: int,
    error_message: str | None = None,
) -> DataFrame:
    """One ledger row; the duration and the table label follow from the arguments."""
    row = {
        "id": id,
        "start_time": start_time,
        "end_time": end_time,
        "status": status,
        "tables": None if tables is None else list(tables),
        "total_records": total_records,
        "error_message": error_message,
    }
    return with_duration(
        small_frame(spark, [row], _RECORD_SCHEMA)
        .withColumn("tables_migrated", names_label(F.col("tables")))
    ).select(*LEDGER_SCHEMA.names)


def stop_record(
    spark: SparkSession, id: int, start_time: dt.datetime, end_time: dt.datetime, total_records: int
) -> DataFrame:
    """The ledger row of a run ended by its user. It names no tables."""
    row = run_record(
        spark, id, start_time, end_time, "stopped", None, total_records, "Migration stopped by user"
    )
    return row.withColumn("tables_migrated", F.lit(""))


def with_duration(runs: DataFrame) -> DataFrame:
    return runs.withColumn("duration_seconds", seconds_between(F.col("start_time"), F.col("end_time")))


def append_runs(ledger: DataFrame, records: DataFrame) -> DataFrame:
    return ledger.unionByName(records)


def latest_run_state(ledger: DataFrame) -> DataFrame:
    """One row per run, the last one written. Rows of one run share their start time.

    max_by() instead of row_number() over a window: it combines within each task before the
    shuffle, so a run with very many rows never lands whole in one task.
    """
    row = F.struct(*[F.col(c) for c in ledger.columns])
    return ledger.groupBy("start_time").agg(F.max_by(row, "id").alias("last")).select("last.*")


def history_limit(limit=None) -> int:
    """The limit of a history request: 50 when it is missing or no integer; -1, no limit, beyond Spark's integers."""
    try:
        n = int(limit)
    except (TypeError, ValueError, OverflowError):
        return DEFAULT_LIMIT
    return n if n <= MAX_LIMIT else -1


def run_history(ledger: DataFrame, limit=None) -> DataFrame:
    """The newest ledger rows by start time, ties by id. A negative limit means all rows."""
    n = history_limit(limit)
    newest_first = ledger.orderBy(F.desc_nulls_last("start_time"), F.desc("id"))
    return newest_first if n < 0 else newest_first.limit(n)


def history_display(runs: DataFrame) -> DataFrame:
    """Ledger rows as text for people."""
    return runs.select(
        "id",
        text_or_dash(local_text(F.col("start_time"))).alias("start_text"),
        text_or_dash(local_text(F.col("end_time"))).alias("end_text"),
        status_label(F.col("status")).alias("status_text"),
        run_status_class(F.col("status")).alias("status_class"),
        text_or_dash(F.col("tables_migrated")).alias("tables_text"),
        count_or_zero(F.col("total_records")).alias("records_text"),
        duration_text(F.col("duration_seconds")).alias("duration_text"),
        text_or_dash(F.col("error_message")).alias("error_text"),
    )
