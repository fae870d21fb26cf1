"""One row of work per table and day.

A plan has at most 365 rows per registered table, however large the tables are. Only the
counts it is compared with come from a scan, and those are aggregated first.
"""

from __future__ import annotations

import datetime as dt
import heapq
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayferry.frames import fields, small_frame
from dayferry.functions import task_text
from dayferry.registry import TableSpec, window_days

_WINDOW_SCHEMA = T.StructType([
    T.StructField("source_table", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("table_index", T.LongType()),
    T.StructField("days", T.LongType()),
    T.StructField("first_task_id", T.LongType()),
])


def table_windows(
    spark: SparkSession,
    registry: Sequence[TableSpec],
    as_of: dt.date | Mapping[str, dt.date | Column],
    days: int | None = None,
) -> DataFrame:
    """One row per table with its window.

    ``as_of`` is one date, or a date or scalar subquery per target table; tables without one
    drop out. Task ids are numbered here, from the window lengths, so no global sort or
    unpartitioned window is needed later.
    """
    rows, next_id = [], 1
    for i, spec in enumerate(registry):
        n = window_days(spec, days)
        rows.append({
            "source_table": spec.source_table,
            "target_table": spec.target_table,
            "table_index": i,
            "days": n,
            "first_task_id": next_id,
        })
        next_id += n
    if isinstance(as_of, Mapping):
        each = [F.when(F.col("target_table") == t, _day(d)) for t, d in as_of.items()]
        newest = F.coalesce(*each, F.lit(None).cast("date"))
    else:
        newest = _day(as_of)
    windows = small_frame(spark, rows, _WINDOW_SCHEMA).withColumn("as_of", newest)
    return windows.where(F.col("as_of").isNotNull())


def _day(d: dt.date | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(d)


def day_tasks(windows: DataFrame, priority: Column | None = None) -> DataFrame:
    """One row per table and day of its window, oldest day first."""
    first = F.date_sub("as_of", (F.col("days") - 1).cast("int"))
    return (
        windows.select(
            "source_table",
            "target_table",
            "table_index",
            "first_task_id",
            F.posexplode(F.sequence(first, F.col("as_of"))).alias("offset", "day"),
        )
        .select(
            "source_table",
            "target_table",
            "day",
            F.col("day").cast("string").alias("date_str"),
            "table_index",
            (F.lit(0) if priority is None else priority).cast("bigint").alias("priority"),
            (F.col("first_task_id") + F.col("offset")).alias("task_id"),
        )
    )


def with_columns(tasks: DataFrame, mapping: DataFrame) -> DataFrame:
    """Each task with the columns of its table as (name, type), in mapping order.

    ``mapping`` is a ``mapping_frame``; its groups are as long as a table is wide.
    """
    entry = F.struct(
        "position", F.col("target_column").alias("name"), F.col("proposed_type").alias("type")
    )
    ordered = F.transform(F.sort_array(F.collect_list(entry)), lambda c: F.struct(c["name"], c["type"]))
    columns = mapping.groupBy("target_table").agg(ordered.alias("columns"))
    return tasks.join(columns, "target_table", "left").select(*tasks.columns, "columns")


def order_tasks(tasks: DataFrame, limit: int | None = None) -> DataFrame:
    """Lowest priority number first; task ids only break ties."""
    ordered = tasks.orderBy("priority", "task_id")
    return ordered if limit is None else ordered.limit(limit)


def describe_tasks(tasks: DataFrame) -> DataFrame:
    text = task_text(F.col("task_id"), F.col("priority"), F.col("date_str"), F.col("target_table"))
    return tasks.withColumn("description", text)


def lane_depth(tasks: DataFrame) -> DataFrame:
    """Number of tasks per source and target pair."""
    lane = F.concat_ws("_", "source_table", "target_table").alias("lane")
    return tasks.groupBy(lane).agg(F.count(F.lit(1)).alias("depth"))


_LONG = T.LongType()
_LANE_SCHEMA = fields(target_table=T.StringType(), weight=_LONG, lane=_LONG, place=_LONG, lane_total=_LONG)


def place_in_lanes(weights: Mapping[str, int], lanes: int) -> list[dict]:
    """Tables in the order they are started, each in the lane with the least weight so far.

    Heaviest first, ties by name, and by number for lanes: no lane then ends later than 4/3 of the best plan's end.
    """
    if lanes < 1:
        raise ValueError(f"lanes must be at least 1, got {lanes!r}")
    held, rows = [(0, i) for i in range(lanes)], []
    for table, weight in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
        total, lane = heapq.heappop(held)
        heapq.heappush(held, (total + weight, lane))
        rows.append({"target_table": table, "weight": weight, "lane": lane, "place": len(rows) + 1})
    totals = {lane: total for total, lane in held}
    return [r | {"lane_total": totals[r["lane"]]} for r in rows]


def lane_schedule(spark: SparkSession, weights: Mapping[str, int], lanes: int) -> DataFrame:
    """One row per table: its lane, its place in the order of starts, and the weight of the whole lane."""
    return small_frame(spark, place_in_lanes(weights, lanes), _LANE_SCHEMA)


def day_coverage(tasks: DataFrame, counts: DataFrame) -> DataFrame:
    """Each task with the records of its day, 0 when there are none.

    ``counts`` is (target_table, day, records), already aggregated.
    """
    return tasks.join(counts, ["target_table", "day"], "left").select(
        *[F.col(c) for c in tasks.columns],
        F.coalesce("records", F.lit(0)).cast("bigint").alias("records"),
    )


def missing_days(tasks: DataFrame, counts: DataFrame) -> DataFrame:
    """Tasks whose day has no source rows."""
    return tasks.join(counts, ["target_table", "day"], "left_anti").select(*tasks.columns)
