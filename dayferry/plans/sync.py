"""A sync run: copy the rolling window of each table, and record what happened."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from queue import Queue

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayferry.frames import small_frame
from dayferry.operators.digest import DIGEST_SCHEMA, changed_days, day_digests
from dayferry.operators.ledger import run_record
from dayferry.operators.project import cast_losses, lost_values, map_typed
from dayferry.operators.status import STATUS_SCHEMA
from dayferry.operators.window import between_days, day_of, in_days, window_bounds
from dayferry.plans.tasks import day_coverage, day_tasks, place_in_lanes, table_windows
from dayferry.registry import DAY, ColumnSpec, TableSpec, check_days, select_tables, window_days
from dayferry.sources.store import RunStore

_OUTCOME_SCHEMA = T.StructType([
    T.StructField("target_table", T.StringType()),
    T.StructField("written", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("kept", T.LongType()),
    T.StructField("loaded_days", T.ArrayType(T.StringType())),
])

_SOURCE_DAY = "__source_day"


def sync(
    spark: SparkSession,
    registry: Sequence[TableSpec],
    read: Callable[[SparkSession, TableSpec, dt.date, dt.date], DataFrame],
    target,
    store: RunStore,
    as_of: dt.date,
    tables: Sequence[str] | None = None,
    days: int | None = None,
    clock: Callable[[], dt.datetime] = dt.datetime.now,
    concurrent_tables: int = 4,
    lost_values_allowed: int = 0,
    undated_rows_allowed: int = 0,
    changed_only: bool = False,
) -> DataFrame:
    """Run the sync and return one row per table and day with its records and status.

    ``days`` replaces the default window of every selected table. Up to ``concurrent_tables``
    tables are copied at once, the heaviest of the last run first, so that the last tasks of one overlap
    with the next; with Spark's FAIR scheduler each of these lanes has a pool of its own, unless the caller has
    set one. A table that fails is reported and does not stop the others. Data is written first, then the table
    status, then the final ledger row. Days are replaced whole and the rest is appended, so a
    run that died is simply run again. While a run is open another one is refused with ``Busy`` and leaves no
    trace (see ``RunStore``).

    With ``changed_only`` the window is read once more for a digest of each day, and only days whose digest is
    another one than at their last load, or of which the target does not hold as many records, are replaced; the
    column ``loaded`` tells which. It pays where writing costs more than reading.

    A table fails, with the counts in its error, if its load lost or changed more values by their types
    than ``lost_values_allowed``, or if its source has more rows without a readable day than
    ``undated_rows_allowed``. The rows that could be read are in the target all the same; a larger
    number allows for what is known. Undated rows are counted by sources that can; file by file where
    they remember which files they have looked into. Decimals are compared to ten places, and a number that becomes
    a double counts as unchanged.
    """
    chosen = select_tables(registry, tables)
    if days is not None:
        check_days(days)
    store.create(spark)
    started = clock()
    with store.hold(spark, f"sync started {started}") as lease:
        return _run(
            spark, chosen, read, target, store, lease, as_of, tables, days, started, clock, concurrent_tables,
            (lost_values_allowed, undated_rows_allowed), changed_only,
        )


def _run(
    spark, chosen, read, target, store, lease, as_of, tables, days, started, clock, concurrent_tables, allowed, changed_only
) -> DataFrame:
    run_id = store.claim(spark)
    store.append(run_record(spark, run_id, started, None, "running", tables, 0))

    total, error = 0, None
    try:
        specs = {s.target_table: s for s in chosen}
        order = place_in_lanes(_weights(store.status(spark), chosen), concurrent_tables)
        lanes = Queue()
        for lane in range(concurrent_tables):
            lanes.put(lane)
        with ThreadPoolExecutor(concurrent_tables) as pool:

            def copy_in_lane(spec: TableSpec) -> dict:
                lane = lanes.get()  # one for each thread
                try:
                    _enter_pool(spark, lane)
                    return _copy_table(spark, spec, read, target, store, run_id, as_of, days, *allowed, changed_only)
                finally:
                    lanes.put(lane)

            # The caller's job group and pool hold in these threads too.
            copy = inheritable_thread_target(spark)(copy_in_lane)
            copies = {r["target_table"]: pool.submit(copy, specs[r["target_table"]]) for r in order}
            outcomes = [copies[s.target_table].result() for s in chosen]
        results = _task_results(spark, chosen, target, as_of, days, outcomes)
        results = store.write_results(results, run_id)
        named = F.concat("target_table", F.lit(": "), "error")
        totals = results.agg(
            F.sum("records").alias("total"),
            F.array_join(F.sort_array(F.collect_set(named)), "; ").alias("error"),  # one for each table at most
            F.count_if(F.col("status") == "failed").alias("failed"),
        ).first()
        total, error = totals["total"] or 0, totals["error"] or None
        if lease:
            lease.check()  # a driver that slept too long does not write over its successor's status
        ended = clock()
        store.update_status(_status_updates(results, store.status(spark), chosen, ended), run_id)
        status = "failed" if totals["failed"] else "success"
    except Exception as e:
        store.append(run_record(spark, store.claim(spark), started, clock(), "failed", tables, total, str(e)))
        raise
    store.append(run_record(spark, store.claim(spark), started, ended, status, tables, total, error))
    return results


def _weights(status: DataFrame, chosen: Sequence[TableSpec]) -> dict[str, int]:
    """Records of the last run per table; a table without one may be the heaviest."""
    known = {r["table_name"]: r["records_count"] or 0 for r in status.select("table_name", "records_count").collect()}
    most = max(known.values(), default=0) + 1
    return {s.target_table: known.get(s.target_table, most) for s in chosen}


def _enter_pool(spark: SparkSession, lane: int) -> None:
    context = spark.sparkContext
    fair = spark.conf.get("spark.scheduler.mode", "FIFO").upper() == "FAIR"
    pool = context.getLocalProperty("spark.scheduler.pool")
    if fair and (pool is None or pool.startswith("sync-lane-")):
        context.setLocalProperty("spark.scheduler.pool", f"sync-lane-{lane}")


def _copy_table(spark, spec, read, target, store, run_id, as_of, days, lost_allowed, undated_allowed, changed_only) -> dict:
    first, last = window_bounds(as_of, window_days(spec, days))
    outcome = {"target_table": spec.target_table, "written": None, "error": None, "kept": 0, "loaded_days": None}
    try:
        rows = read(spark, spec, first, last)
        missing = spec.missing_columns(rows.columns)
        if missing:
            raise ValueError(f"{spec.source_table} lacks mapped columns: {', '.join(missing)}")
        # A reader may return more than it was asked for; no other day may be replaced.
        rows = between_days(rows, spec.time_column, first, last, spec.zone)
        only, digests = (), None
        if changed_only:
            kept, todo, digests = _changes(spark, rows, spec, target, store, first, last)
            rows = in_days(rows, spec.time_column, todo, spec.zone)
            outcome |= {"kept": sum(kept.values()), "loaded_days": [str(d) for d in todo]}
            only = (todo,)
        seen = Observation()  # counts on the way; a repeated task may count twice, but none is missed
        counted = rows.observe(seen, F.expr(lost_values(spec.columns)).alias("lost"))
        outcome["written"] = target.replace_days(with_day(counted, spec), spec, first, last, *only) if not only or todo else 0
        faults = []
        if (not only or todo) and (seen.get.get("lost") or 0) > lost_allowed:
            faults += _losses(rows, spec, lost_allowed)
        unread = _undated(spark, spec, read, store, run_id)
        if unread > undated_allowed:
            faults.append(f"{unread} rows of {spec.source_table} have no readable {spec.time_column}")
        if digests is not None and not faults:  # a faulty load is done again
            store.update_digests(digests, run_id)
        return outcome | {"error": "; ".join(faults) or None}
    except Exception as e:
        return outcome | {"error": str(e) or type(e).__name__}


def _changes(spark, rows, spec, target, store, first, last) -> tuple[dict[dt.date, int], list[dt.date], DataFrame]:
    """The days to keep with their records, the days to load, and these days' digests. All are at most 365 rows."""
    typed = with_day(rows, spec)
    found = day_digests(typed, F.col(DAY), typed.columns).collect()
    now = small_frame(spark, [r.asDict() for r in found], DIGEST_SCHEMA)
    known = store.digests(spark).where(F.col("target_table") == spec.target_table).where(F.col(DAY).between(first, last))
    todo = {r[DAY] for r in changed_days(known.drop("target_table"), now).collect()}
    records = {r[DAY]: r["records"] for r in found}
    held = {r[DAY]: r["records"] for r in target.day_counts(spark, spec, first, last).collect()}
    todo |= {d for d in records.keys() | held.keys() if records.get(d, 0) != held.get(d, 0)}
    gone = [{"day": d, "records": 0} for d in todo - records.keys()]
    digests = now.where(F.col(DAY).isin(sorted(todo))).unionByName(small_frame(spark, gone, DIGEST_SCHEMA))
    return {d: n for d, n in records.items() if d not in todo}, sorted(todo), digests.withColumn("target_table", F.lit(spec.target_table))


def _undated(spark, spec, read, store, run_id) -> int:
    """Rows of the source without a readable day: of new files only, if the source can tell its files apart."""
    if not hasattr(read, "undated_in_new_files"):
        return read.undated(spark, spec) if hasattr(read, "undated") else 0
    name = f"{spec.source_table}.{spec.time_column}"
    found = read.undated_in_new_files(spark, spec, store.files(spark, name))
    if found is not None:
        store.update_files(found, name, run_id)
    present = read.present_files(spark, spec)
    known = present.join(store.files(spark, name), ["file", "bytes", "modified"])
    return known.agg(F.sum("undated")).first()[0] or 0


def _losses(rows: DataFrame, spec: TableSpec, allowed: int) -> list[str]:
    """What the types lost, column by column, counted anew: only a table with losses pays for this."""
    found = cast_losses(rows, spec.columns).where("failed + changed > 0").orderBy("target_column").collect()
    if sum(r["failed"] + r["changed"] for r in found) <= allowed:
        return []
    return [f"{r['target_column']} as {r['type']}: {r['failed']} values lost, {r['changed']} changed" for r in found]


def with_day(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The typed target rows with their day, taken from the time as the source has it."""
    rows = rows.withColumn(_SOURCE_DAY, day_of(rows, spec.time_column, spec.zone))
    return map_typed(rows, [*spec.columns, ColumnSpec(_SOURCE_DAY, DAY)])


def _task_results(spark, chosen, target, as_of, days, outcomes) -> DataFrame:
    """The plan with the records the target really holds, checked against what was written."""
    tasks = day_tasks(table_windows(spark, chosen, as_of, days))
    counts = small_frame(spark, [], T.StructType.fromDDL("target_table string, day date, records bigint"))
    for spec, outcome in zip(chosen, outcomes):
        if outcome["written"] is not None:
            held = target.day_counts(spark, spec, *window_bounds(as_of, window_days(spec, days)))
            counts = counts.unionByName(held.withColumn("target_table", F.lit(spec.target_table)))
    held = F.sum("records").over(Window.partitionBy("target_table"))  # at most 365 rows each
    wrote = F.when(F.col("kept") > 0, F.format_string("kept %d and wrote %d records, target holds %d", "kept", "written", "held"))
    off = F.coalesce(wrote, F.format_string("wrote %d records, target holds %d", "written", "held"))
    return (
        day_coverage(tasks, counts)
        .withColumn("held", held)
        .join(small_frame(spark, outcomes, _OUTCOME_SCHEMA), "target_table")
        .withColumn("error", F.coalesce("error", F.when(F.col("held") != F.col("written") + F.col("kept"), off)))
        .select(
            "source_table",
            "target_table",
            "day",
            "records",
            F.when(F.col("error").isNull(), "success").otherwise("failed").alias("status"),
            "error",
            (F.col("written").isNotNull() & F.coalesce(F.array_contains("loaded_days", F.col("date_str")), F.lit(True))).alias("loaded"),
        )
    )


def _status_updates(results, known, chosen, ended) -> DataFrame:
    """One status row per table of the run. The ids only count for tables not known before."""
    next_id = (known.agg(F.max("id")).first()[0] or 0) + 1
    rows = [
        {"id": next_id + i, "table_name": s.target_table, "last_sync_time": ended}
        for i, s in enumerate(chosen)
    ]
    stamps = small_frame(results.sparkSession, rows, T.StructType(STATUS_SCHEMA.fields[:3]))
    per_table = results.groupBy(F.col("target_table").alias("table_name")).agg(
        F.sum("records").alias("records_count"),
        F.max("status").alias("status"),  # the same on all rows of a table
        F.max("error").alias("last_error"),
    )
    return per_table.join(stamps, "table_name")
