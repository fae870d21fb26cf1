"""The given tables in the role of report tables, and ledger and status tables derived from them."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayferry.operators.ledger import LEDGER_SCHEMA, with_duration
from dayferry.operators.window import newest_day
from dayferry.registry import TableSpec, mapping
from dayferry.sources.files import ParquetSource

EVENTS = TableSpec(
    "events",
    "ods_query",
    mapping(
        ["ts", "event_id", "user_id", "event_type", "value", "props"],
        ["time", "event_id", "user_id", "activity_type", "sales14d", "query"],
        [None, None, None, None, "decimal(18,4)", None],
    ),
    time_column="ts",
    default_days=24,
)
ORDERS = TableSpec(
    "orders",
    "ods_campain",
    mapping(
        ["o_orderdate", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"],
        ["time", "campaign_id", "profile_id", "status", "spend"],
        ["date", None, None, None, "decimal(18,4)"],
    ),
    time_column="o_orderdate",
)
LINEITEM = TableSpec(
    "lineitem",
    "ods_campaign_dsp",
    mapping(
        ["l_shipdate", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"],
        ["time_column", "order_id", "line_item_id", "position", "units_sold", "total_cost"],
        ["date", None, None, "bigint", "bigint", "decimal(18,4)"],
    ),
    time_column="l_shipdate",
)
REGISTRY = (EVENTS, ORDERS, LINEITEM)


# Declared, because inferring a schema starts a job for each read.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def source(sf_dir: str) -> ParquetSource:
    return ParquetSource({t: f"{sf_dir}/{t}.parquet" for t in SCHEMAS}, SCHEMAS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return source(sf_dir).table(spark, name)


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def newest_days(spark: SparkSession, sf_dir: str, specs=REGISTRY) -> dict[str, Column]:
    """The newest day of each stand-in, left to the plan."""
    return {
        s.target_table: newest_day(table(spark, sf_dir, s.source_table), s.time_column) for s in specs
    }


def as_of(spark: SparkSession, sf_dir: str, specs=REGISTRY) -> dict[str, dt.date]:
    """The newest day of each stand-in as a value, as a production run would be given it.

    One job, one row per table. Filters on the values prune and push down in any plan, which
    a subquery that is shared between parts of a plan does not.
    """
    found = stack([
        table(spark, sf_dir, s.source_table)
        .agg(F.to_date(F.max(s.time_column)).alias("as_of"))
        .withColumn("target_table", F.lit(s.target_table))
        for s in specs
    ])
    return {r.target_table: r.as_of for r in found.collect()}


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per day and event type, numbered by its lowest event id."""
    kind = F.col("event_type")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("day"), kind)
        .agg(
            F.min("event_id").alias("k"),
            F.min("ts").alias("start_time"),
            F.max("ts").alias("last_time"),
            F.count(F.lit(1)).alias("total_records"),
        )
        .select(
            "k",
            "start_time",
            F.when(kind != "signup", F.col("last_time")).alias("end_time"),
            F.when(kind == "error", "failed")
            .when(kind == "signup", "running")
            .when(kind == "view", "stopped")
            .otherwise("success")
            .alias("status"),
            F.when(kind == "view", "").otherwise(kind).alias("tables_migrated"),
            "total_records",
            F.when(kind == "error", F.concat(F.lit("timeout after "), F.col("total_records").cast("string")))
            .when(kind == "view", "Migration stopped by user")
            .alias("error_message"),
        )
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows per finished run, one per open run, exploded from one aggregate."""
    none = F.lit(None)
    started = F.struct(
        (F.col("k") * 2).alias("id"),
        none.cast("timestamp_ntz").alias("end_time"),
        F.lit("running").alias("status"),
        F.col("tables_migrated"),
        F.lit(0).cast("bigint").alias("total_records"),
        none.cast("string").alias("error_message"),
    )
    final = F.struct(
        (F.col("k") * 2 + 1).alias("id"),
        F.col("end_time"),
        F.col("status"),
        F.col("tables_migrated"),
        F.col("total_records"),
        F.col("error_message"),
    )
    rows = F.when(F.col("status") == "running", F.array(started)).otherwise(F.array(started, final))
    written = runs(spark, sf_dir).select("start_time", F.inline(rows))
    return with_duration(written).select(*LEDGER_SCHEMA.names)


def status_change(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The status before 2024-01-15 and the updates since, by event type."""
    events = table(spark, sf_dir, "events")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")

    def status(rows: DataFrame, state: str, error) -> DataFrame:
        return rows.groupBy(F.col("event_type").alias("table_name")).agg(
            F.min("event_id").alias("id"),
            F.max("ts").alias("last_sync_time"),
            F.count(F.lit(1)).alias("records_count"),
            F.lit(state).alias("status"),
            error.alias("last_error"),
        )

    old = events.where((F.col("ts") < cut) & (F.col("event_type") != "purchase"))
    new = events.where((F.col("ts") >= cut) & (F.col("event_type") != "error"))
    return (
        status(old, "failed", F.lit("connection lost")),
        status(new, "success", F.lit(None).cast("string")),
    )
