"""The status of each table, and of the newest run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayferry.functions import (
    count_or_zero,
    local_text,
    status_label,
    table_status_class,
    text_or_dash,
)
from dayferry.operators.counts import run_totals

STATUS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("last_sync_time", T.TimestampNTZType()),
    T.StructField("records_count", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("last_error", T.StringType()),
])


def current_status(log: DataFrame, keep_version: bool = False) -> DataFrame:
    """One row per table from a log of status rows with a ``version``; the highest version wins.

    The whole row is taken from it, so a null there clears an older value; only the id of a
    table stays the one it was first given. An aggregate rather than a join or a window: the
    newer row wins inside each task, so a table with many rows never lands whole in one task.
    """
    values = F.struct("last_sync_time", "records_count", "status", "last_error")
    # Within a version the newest sync wins, then the higher id.
    order = F.struct("version", "last_sync_time", "id")
    return (
        log.groupBy("table_name")
        .agg(
            F.min(F.struct("version", "id")).getField("id").alias("id"),
            F.max_by(values, order).alias("v"),
            F.max("version").alias("version"),
        )
        .select("id", "table_name", "v.*", *(["version"] if keep_version else []))
    )


def upsert_status(current: DataFrame, updates: DataFrame) -> DataFrame:
    """The status after the updates: a known table gets the new row, a new table is added."""
    versions = [
        rows.select(*STATUS_SCHEMA.names, F.lit(i).alias("version")) for i, rows in enumerate((current, updates))
    ]
    return current_status(versions[0].unionByName(versions[1]))


def status_of(status: DataFrame, table_name: str) -> DataFrame:
    return status.where(F.col("table_name") == table_name)


def table_status(status: DataFrame) -> DataFrame:
    return status.orderBy(F.asc_nulls_first("table_name"))


def status_display(status: DataFrame) -> DataFrame:
    """Status rows as text for people."""
    return status.select(
        "table_name",
        text_or_dash(local_text(F.col("last_sync_time"))).alias("last_sync_text"),
        count_or_zero(F.col("records_count")).alias("records_text"),
        status_label(F.col("status")).alias("status_text"),
        table_status_class(F.col("status")).alias("status_class"),
        text_or_dash(F.col("last_error")).alias("error_text"),
    )


def status_document(
    ledger: DataFrame, results: DataFrame, settings: Mapping[str, str] | None = None
) -> DataFrame:
    """One row about the newest run: its state and error, and the totals of its task results.

    ``results`` are those of the newest run. The id is that of the newest row that says ``running``, also
    once the run has ended; only a failure leaves an error, a stop does not. All inputs shrink to
    one row in their own aggregate; the ledger's enter as scalar subqueries, so nothing is joined.
    """
    order = F.struct("start_time", "id")
    newest = ledger.agg(F.max_by(F.struct("start_time", "status", "error_message"), order)).scalar()
    opened = ledger.where(F.col("status") == "running").agg(F.max_by("id", order)).scalar()
    pairs = [F.lit(x) for pair in (settings or {}).items() for x in pair]
    return (
        run_totals(results)
        .withColumn("newest", newest)
        .withColumn("opened", opened)
        .select(
            F.coalesce(F.col("newest.status") == "running", F.lit(False)).alias("is_running"),
            F.col("opened").alias("current_migration_id"),
            F.col("newest.start_time").alias("migration_start_time"),
            F.when(F.col("newest.status") == "failed", F.col("newest.error_message")).alias("last_error"),
            "total_records",
            "completed_tasks",
            "failed_tasks",
            F.create_map().cast("map<string,string>").alias("progress_info"),
            F.create_map(*pairs).cast("map<string,string>").alias("config"),
        )
    )
