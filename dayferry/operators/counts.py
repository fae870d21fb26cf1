"""Counts and rollups. All are partial aggregates: a hot day or table shuffles one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayferry.operators.project import column


def day_counts(df: DataFrame, time_column: str, *keys: str | Column) -> DataFrame:
    """Records per day, and per key if any are given."""
    day = F.to_date(column(time_column)).alias("day")
    return df.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("records"))


def table_rollup(df: DataFrame, table_name: Column, time_column: str) -> DataFrame:
    """Records and newest time per table."""
    return df.groupBy(table_name.alias("table_name")).agg(
        F.max(column(time_column)).alias("last_sync_time"),
        F.count(F.lit(1)).alias("records_count"),
    )


def run_totals(results: DataFrame, records: str = "records") -> DataFrame:
    """Totals over task results or collapsed runs: records, successful, failed and all."""
    return results.agg(
        F.coalesce(F.sum(records), F.lit(0)).cast("bigint").alias("total_records"),
        F.count_if(F.col("status") == "success").alias("completed_tasks"),
        F.count_if(F.col("status") == "failed").alias("failed_tasks"),
        F.count(F.lit(1)).alias("all_tasks"),
    )
