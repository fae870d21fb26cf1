"""One query per operator over the given tables. Each takes (spark, sf_dir)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayferry import functions as X
from dayferry.frames import shared_dir, small_frame
from dayferry.operators import counts, digest, ledger, project, status, window
from dayferry.plans import tasks
from dayferry.plans.sync import sync, with_day
from dayferry.registry import (
    REPORT_TABLES,
    TableSpec,
    mapping,
    mapping_frame,
    registry_frame,
    select_tables,
    window_days,
)
from dayferry.sources.files import ParquetSource, ParquetTarget
from dayferry.sources.jdbc import day_predicates, quantile_bounds, range_clauses
from dayferry.sources.lease import Busy
from dayferry.sources.preflight import preflight
from dayferry.sources.store import RunStore
from dayferry.workload import standins
from dayferry.workload.standins import EVENTS, LINEITEM, ORDERS, REGISTRY, table

# --- windows and counts ---------------------------------------------------------------------


def _window_counts(spark, sf_dir, spec: TableSpec, days: int | None = None, as_of=None) -> DataFrame:
    rows = table(spark, sf_dir, spec.source_table)
    rows = window.rolling_window(rows, spec.time_column, window_days(spec, days), as_of)
    return counts.day_counts(project.map_columns(rows, spec.columns), spec.target_time_column)


def _all_window_counts(spark, sf_dir, specs=REGISTRY, days=None, as_of=None) -> DataFrame:
    return standins.stack([
        _window_counts(spark, sf_dir, s, days, as_of and as_of[s.target_table]).select(
            F.lit(s.target_table).alias("target_table"), "day", "records"
        )
        for s in specs
    ])


def _newest_window(spark, sf_dir, spec: TableSpec) -> DataFrame:
    """The window that ends with the newest day, given as a date as in production, so that it prunes."""
    newest = standins.as_of(spark, sf_dir, [spec])
    return _window_counts(spark, sf_dir, spec, as_of=newest[spec.target_table])


def window_sync(spark, sf_dir):
    """Records per day that tonight's sync would carry."""
    return _newest_window(spark, sf_dir, EVENTS)


def window_sync_orders(spark, sf_dir):
    return _newest_window(spark, sf_dir, ORDERS)


def window_sync_lineitem(spark, sf_dir):
    return _newest_window(spark, sf_dir, LINEITEM)


def window_days_override(spark, sf_dir):
    return _all_window_counts(spark, sf_dir, days=7, as_of=standins.as_of(spark, sf_dir))


def table_subset(spark, sf_dir):
    chosen = select_tables(REGISTRY, ["ods_query", "ods_campaign_dsp"])
    return _all_window_counts(spark, sf_dir, chosen, as_of=standins.as_of(spark, sf_dir, chosen))


def table_subset_all(spark, sf_dir):
    chosen = select_tables(REGISTRY, [])
    return _all_window_counts(spark, sf_dir, chosen, as_of=standins.as_of(spark, sf_dir, chosen))


def day_counts(spark, sf_dir):
    return counts.day_counts(table(spark, sf_dir, "events"), "ts", "event_type")


def table_registry(spark, sf_dir):
    """The shipped registry with the newest day and window size of each stand-in."""
    newest = standins.as_of(spark, sf_dir)
    found = standins.stack([
        window.rolling_window(
            table(spark, sf_dir, s.source_table), s.time_column, s.default_days, newest[s.target_table]
        )
        .agg(F.to_date(F.max(s.time_column)).alias("as_of"), F.count(F.lit(1)).alias("records"))
        .withColumn("target_table", F.lit(s.target_table))
        for s in REGISTRY
    ])
    return registry_frame(spark, REPORT_TABLES).join(found, "target_table", "left")


# --- projections ----------------------------------------------------------------------------

_AWKWARD = mapping(
    ["Event.id", "Time", "Event Type", "活动Id", "T-Pixel"],
    ["event_id", "time", "event_type", "campaign_id", "tpixel"],
)


def mapped_projection(spark, sf_dir):
    """Events under awkward source names, mapped back."""
    names = dict(zip(["event_id", "ts", "event_type", "user_id", "value"], _AWKWARD))
    awkward = table(spark, sf_dir, "events").withColumnsRenamed({k: c.source for k, c in names.items()})
    return project.map_columns(awkward, _AWKWARD)


_MAPPING_INPUTS = {
    "ods_query": ("events", "event_id"),
    "ods_campain": ("orders", "o_orderkey"),
    "ods_campaign_dsp": ("lineitem", "l_orderkey"),
    "ods_aws_asin_philips": ("part", "p_partkey"),
}


def mapping_catalog(spark, sf_dir):
    """Each shipped mapping carried out on a wide source, with the filled values per target column.

    The source column at position p is empty where the key is a multiple of p + 2, so a value
    that ended up under a wrong name shows in the counts.
    """
    reports = []
    for spec in REPORT_TABLES:
        name, key = _MAPPING_INPUTS[spec.target_table]
        wide = table(spark, sf_dir, name).selectExpr(*[
            f"CASE WHEN {key} % {i + 2} <> 0 THEN {key} END AS {project.quoted(c)}"
            for i, c in enumerate(spec.source_columns)
        ])
        filled = [
            f"""struct({project.text(spec.target_table)} AS target_table, {project.text(c)} AS target_column,
                count({project.quoted(c)}) AS filled)"""
            for c in spec.target_columns
        ]
        reports.append(project.column_report(project.map_columns(wide, spec.columns), filled))
    return mapping_frame(spark, REPORT_TABLES).join(
        standins.stack(reports), ["target_table", "target_column"]
    )


def _text_events(spark, sf_dir) -> tuple[DataFrame, tuple]:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 10 == 0, "n/a").otherwise(F.col("event_id").cast("string")).alias("No."),
        F.get_json_object("props", "$.k").alias("props.k"),
        F.col("ts").cast("string").alias("Time"),
        F.when(F.col("event_type") == "view", F.concat(F.col("value").cast("string"), F.lit(" EUR")))
        .otherwise(F.col("value").cast("string"))
        .alias("Sales 14d"),
    )
    columns = mapping(
        ["event_id", "No.", "props.k", "Time", "Sales 14d"],
        ["event_id", "number", "k", "day", "sales14d"],
        [None, "bigint", "bigint", "date", "decimal(18,4)"],
    )
    return events, columns


def typed_projection(spark, sf_dir):
    events, columns = _text_events(spark, sf_dir)
    return project.map_typed(events, columns)


def typed_projection_failures(spark, sf_dir):
    events, columns = _text_events(spark, sf_dir)
    return project.failed_casts(events, columns)


# --- the table-by-day plan ------------------------------------------------------------------


def day_task_plan(spark, sf_dir):
    """All tasks, with the number of columns each one carries."""
    newest = standins.as_of(spark, sf_dir)
    planned = tasks.day_tasks(tasks.table_windows(spark, REGISTRY, newest))
    planned = tasks.with_columns(planned, mapping_frame(spark, REGISTRY))
    return planned.withColumn("column_count", F.size("columns").cast("bigint")).drop("columns")


def _covered(spark, sf_dir, days=None) -> DataFrame:
    newest = standins.as_of(spark, sf_dir)
    planned = tasks.day_tasks(tasks.table_windows(spark, REGISTRY, newest, days))
    return tasks.day_coverage(planned, _all_window_counts(spark, sf_dir, days=days, as_of=newest))


def task_order_topk(spark, sf_dir):
    """The 20 heaviest days first."""
    planned = _covered(spark, sf_dir).withColumn("priority", -F.col("records"))
    first = tasks.order_tasks(tasks.describe_tasks(planned), 20)
    return first.select("task_id", "priority", "target_table", "day", "description")


def lane_depth(spark, sf_dir):
    """Tasks per lane, counting days that have records."""
    return tasks.lane_depth(_covered(spark, sf_dir).where("records > 0"))


def day_coverage(spark, sf_dir):
    return _covered(spark, sf_dir, days=90).select("target_table", "day", "records")


def missing_days(spark, sf_dir):
    """Days without an order in the year that ends 30 days after the newest one, as a plan made ahead has them."""
    newest = standins.as_of(spark, sf_dir, [ORDERS])
    ahead = {t: day + dt.timedelta(days=30) for t, day in newest.items()}
    orders = window.rolling_window(table(spark, sf_dir, "orders"), "o_orderdate", 365, ahead[ORDERS.target_table])
    found = counts.day_counts(orders, "o_orderdate", F.lit(ORDERS.target_table).alias("target_table"))
    planned = tasks.day_tasks(tasks.table_windows(spark, [ORDERS], ahead, 365))
    return tasks.missing_days(planned, found).select("target_table", "day", "task_id")


# --- ledger -----------------------------------------------------------------------------------


def run_ledger_append(spark, sf_dir):
    record = ledger.run_record(
        spark,
        id=10**15,
        start_time=dt.datetime(2024, 2, 1, 9, 0),
        end_time=dt.datetime(2024, 2, 1, 9, 2, 5, 250000),
        status="success",
        tables=["ods_query", "ods_campain"],
        total_records=12345,
    )
    return ledger.append_runs(standins.ledger(spark, sf_dir), record)


def latest_run_state(spark, sf_dir):
    return ledger.latest_run_state(standins.ledger(spark, sf_dir))


def run_history_topk(spark, sf_dir):
    return ledger.run_history(standins.ledger(spark, sf_dir), 10)


def run_history_default(spark, sf_dir):
    return ledger.run_history(standins.ledger(spark, sf_dir))


def run_totals(spark, sf_dir):
    return counts.run_totals(latest_run_state(spark, sf_dir), "total_records")


def run_duration(spark, sf_dir):
    return standins.ledger(spark, sf_dir).select("id", "duration_seconds")


def history_display(spark, sf_dir):
    return ledger.history_display(standins.ledger(spark, sf_dir))


def run_messages(spark, sf_dir):
    raised = F.col("id") % 4 == 1
    message = X.result_message(F.col("status"), F.col("total_records"), F.col("error_message"), raised)
    return latest_run_state(spark, sf_dir).select("id", message.alias("message"))


def rows_to_json(spark, sf_dir):
    rows = standins.ledger(spark, sf_dir)
    return rows.select("id", X.row_json(*ledger.LEDGER_SCHEMA.names).alias("json"))


def status_document(spark, sf_dir):
    runs = latest_run_state(spark, sf_dir)
    newest = runs.where(F.col("start_time") == runs.agg(F.max("start_time")).scalar())
    results = newest.select(F.col("total_records").alias("records"), "status")
    settings = {"ods_query_days": "24", "other_tables_days": "60"}
    document = status.status_document(standins.ledger(spark, sf_dir), results, settings)
    return document.withColumns({c: F.to_json(c) for c in ("progress_info", "config")})


# --- expressions over events ------------------------------------------------------------------


def run_duration_text(spark, sf_dir):
    kind = F.col("event_id") % 5
    seconds = (
        F.when(kind == 1, 0.0)
        .when(kind == 2, F.col("value"))
        .when(kind == 3, F.col("value") * 100)
        .when(kind == 4, F.col("value") * 1000)
    )
    return table(spark, sf_dir, "events").select("event_id", X.duration_text(seconds).alias("duration_text"))


def run_elapsed_text(spark, sf_dir):
    elapsed = X.elapsed_text(F.col("ts"), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    return table(spark, sf_dir, "events").select("event_id", elapsed.alias("elapsed_text"))


def _event_status():
    known = ["success", "failed", "stopped", "running", "syncing", "idle", "paused", ""]
    return F.element_at(F.array(*map(F.lit, known)), (F.col("event_id") % 9 + 1).cast("int"))


def _with_event_status(spark, sf_dir) -> DataFrame:
    state = F.when(F.col("event_id") % 9 < 8, _event_status())
    return table(spark, sf_dir, "events").select("event_id", state.alias("status"))


def status_labels(spark, sf_dir):
    return _with_event_status(spark, sf_dir).withColumn("label", X.status_label(F.col("status")))


def status_class(spark, sf_dir):
    return _with_event_status(spark, sf_dir).select(
        "event_id",
        X.run_status_class(F.col("status")).alias("run_class"),
        X.table_status_class(F.col("status")).alias("table_class"),
    )


def tables_label(spark, sf_dir):
    """Per user: the event types with a value above 50, as a table selection."""
    types = ["click", "error", "purchase", "signup", "view"]
    high = F.col("value") > 50
    seen = [F.when(F.count_if(high & (F.col("event_type") == t)) > 0, t) for t in types]
    some = F.count_if(high) > 0
    names = F.when(some | (F.col("user_id") % 2 == 0), F.array_compact(F.array(*seen)))
    return (
        table(spark, sf_dir, "events").groupBy("user_id").agg(X.names_label(names).alias("tables_label"))
    )


def valid_schedule_time(spark, sf_dir):
    n = F.col("event_id")
    hour, minute = (n % 27).cast("string"), (n % 67).cast("string")
    text = (
        F.when(n % 8 == 0, F.concat(F.lpad(hour, 2, "0"), F.lpad(minute, 2, "0")))
        .when(n % 8 == 1, F.concat(hour, F.lit(":"), minute, F.lit(" ")))
        .when(n % 8 == 2, F.concat(hour, F.lit(":"), minute, F.lit("\n")))
        .when(n % 8 < 5, F.concat(F.lpad(hour, 2, "0"), F.lit(":"), F.lpad(minute, 2, "0")))
        .when(n % 8 < 7, F.concat(hour, F.lit(":"), minute))
    )
    return table(spark, sf_dir, "events").select("event_id", X.valid_time_of_day(text).alias("valid"))


def beijing_time(spark, sf_dir):
    local = X.in_time_zone(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", local.alias("beijing"), X.local_text(local).alias("beijing_text")
    )


# --- table status -------------------------------------------------------------------------------


def table_status_rollup(spark, sf_dir):
    return counts.table_rollup(table(spark, sf_dir, "events"), F.col("event_type"), "ts")


def table_status_upsert(spark, sf_dir):
    return status.upsert_status(*standins.status_change(spark, sf_dir))


def table_status_lookup(spark, sf_dir):
    return status.status_of(table_status_upsert(spark, sf_dir), "click")


def table_status_listing(spark, sf_dir):
    return status.table_status(table_status_upsert(spark, sf_dir))


def table_status_display(spark, sf_dir):
    return status.status_display(table_status_upsert(spark, sf_dir))


# --- sources, sinks and the whole run -----------------------------------------------------------


def _newest(spark, sf_dir, spec: TableSpec) -> dt.date:
    return standins.as_of(spark, sf_dir, [spec])[spec.target_table]


def day_sliced_scan(spark, sf_dir):
    """Records per slice, for the clauses that a sliced read of the window would send."""
    first, last = window.window_bounds(_newest(spark, sf_dir, EVENTS), EVENTS.default_days)
    clauses = day_predicates(EVENTS.time_column, first, last)
    number = F.coalesce(*[F.when(F.expr(c), i) for i, c in enumerate(clauses)])
    rows = standins.source(sf_dir)(spark, EVENTS, first, last)
    return rows.groupBy(number.cast("bigint").alias("slice")).agg(F.count(F.lit(1)).alias("records"))


def source_preflight(spark, sf_dir):
    wanted = TableSpec(
        "orders", "ods_campain", mapping(["o_orderdate", "o_clerk"], ["time", "clerk"]), "o_orderdate"
    )
    probes = [standins.source(sf_dir).probe(s) for s in (EVENTS, wanted, LINEITEM)]
    return preflight(spark, probes)


def _load(rows: DataFrame, target: ParquetTarget, first, last) -> None:
    target.replace_days(with_day(rows, EVENTS), EVENTS, first, last)


def partitioned_sink_roundtrip(spark, sf_dir):
    """The typed window, written by day and read back."""
    first, last = window.window_bounds(_newest(spark, sf_dir, EVENTS), EVENTS.default_days)
    target = ParquetTarget(shared_dir(spark, "roundtrip"))
    _load(standins.source(sf_dir)(spark, EVENTS, first, last), target, first, last)
    return target.table(spark, EVENTS)


def window_reload_idempotent(spark, sf_dir):
    """A first load before the purchases arrived, then the full window twice."""
    first, last = window.window_bounds(_newest(spark, sf_dir, EVENTS), EVENTS.default_days)
    target = ParquetTarget(shared_dir(spark, "reload"))
    rows = standins.source(sf_dir)(spark, EVENTS, first, last)
    for load in (rows.where("event_type <> 'purchase'"), rows, rows):
        _load(load, target, first, last)
    return target.day_counts(spark, EVENTS, first, last)


def window_reload_stale_days(spark, sf_dir):
    """The full 24 days, then 10 days from a source that has lost its weekends."""
    newest = _newest(spark, sf_dir, EVENTS)
    target = ParquetTarget(shared_dir(spark, "stale"))
    rows = standins.source(sf_dir)
    for days, kept in ((24, "true"), (10, "dayofweek(ts) not in (1, 7)")):
        first, last = window.window_bounds(newest, days)
        _load(rows(spark, EVENTS, first, last).where(kept), target, first, last)
    return target.day_counts(spark, EVENTS, *window.window_bounds(newest, 24))


def sync_run(spark, sf_dir):
    """The whole run over two tables: one row per table and day."""
    base = shared_dir(spark, "sync")
    results = sync(
        spark,
        REGISTRY,
        standins.source(sf_dir),
        ParquetTarget(f"{base}/data"),
        RunStore(f"{base}/store"),
        as_of=_newest(spark, sf_dir, ORDERS),
        tables=["ods_campain", "ods_campaign_dsp"],
    )
    return results.select("source_table", "target_table", "day", "records", "status")


def sync_ledger(spark, sf_dir):
    """The ledger after a run with all defaults and a second one for the last 7 days."""
    base = shared_dir(spark, "ledger")
    store = RunStore(f"{base}/store")
    for tables, days in ((None, None), (["ods_query"], 7)):
        sync(
            spark,
            [EVENTS],
            standins.source(sf_dir),
            ParquetTarget(f"{base}/data"),
            store,
            as_of=_newest(spark, sf_dir, EVENTS),
            tables=tables,
            days=days,
        )
    return store.ledger(spark).select("id", "status", "tables_migrated", "total_records", "error_message")


_LOSSY = TableSpec(
    "events_text",
    "ods_query",
    mapping(
        ["Time", "event_id", "No.", "Sales 14d"],
        ["time", "event_id", "number", "sales14d"],
        ["timestamp_ntz", None, "bigint", "decimal(18,1)"],
    ),
    time_column="Time",
    default_days=24,
)


def sync_losses(spark, sf_dir):
    """A sync of two tables, one of them with bad numbers, rounded amounts and unreadable times: what it reports."""
    base, k = shared_dir(spark, "losses"), F.col("event_id")
    padded = F.col("ts").cast("string")
    table(spark, sf_dir, "events").select(
        F.when(k % 7 == 0, None).when(k % 11 == 0, F.regexp_replace(padded, "-0", "-")).otherwise(padded).alias("Time"),
        "event_id",
        F.when(k % 10 == 0, "n/a").otherwise(k.cast("string")).alias("No."),
        F.col("value").cast("string").alias("Sales 14d"),
    ).write.parquet(f"{base}/in")
    source = ParquetSource({"events_text": f"{base}/in", "orders": f"{sf_dir}/orders.parquet"})
    results = sync(
        spark,
        [_LOSSY, ORDERS],
        source,
        ParquetTarget(f"{base}/data"),
        RunStore(f"{base}/store"),
        as_of=_newest(spark, sf_dir, EVENTS),
        concurrent_tables=2,
    )
    return results.groupBy("target_table", "status", "error").agg(F.sum("records").alias("records"))


# --- overlapping runs, changed days, new files -------------------------------------------------


def sync_overlap(spark, sf_dir):
    """The ledger of two runs that overlap in a store that allows it: each has ids and results of its own."""
    base = shared_dir(spark, "overlap")
    store, target = RunStore(f"{base}/store", exclusive=False).create(spark), ParquetTarget(f"{base}/data")

    def run(spec: TableSpec) -> DataFrame:
        newest = _newest(spark, sf_dir, spec)
        return sync(spark, [spec], standins.source(sf_dir), target, store, as_of=newest, tables=[spec.target_table])

    with ThreadPoolExecutor(2) as pool:
        results = standins.stack([r.result() for r in [pool.submit(inheritable_thread_target(spark)(run), s) for s in (EVENTS, ORDERS)]])
    found = results.groupBy("target_table").agg(F.sum("records").alias("result_records"))
    rows = store.ledger(spark)
    ids = rows.agg(F.count_distinct("id")).scalar()
    return rows.join(found, F.col("tables_migrated") == F.col("target_table")).select(
        "tables_migrated", "status", "total_records", "result_records", ids.alias("distinct_ids")
    )


def sync_refused(spark, sf_dir):
    """The ledger after a run was refused because another one was open, and then let in."""
    base = shared_dir(spark, "refused")
    store, refused = RunStore(f"{base}/store").create(spark), 0
    newest = _newest(spark, sf_dir, EVENTS)
    args = (spark, [EVENTS], standins.source(sf_dir), ParquetTarget(f"{base}/data"), RunStore(f"{base}/store"), newest)
    with store.hold(spark, "somebody else"):
        try:
            sync(*args)
        except Busy:
            refused = 1
    sync(*args)
    return store.ledger(spark).select("id", "status", "total_records", F.lit(refused).cast("bigint").alias("refused"))


def _orders_before_and_after(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders at two times: rows and days that came late, changed or went between them."""
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").withColumn("day", day)
    before = orders.where("day not between '1996-07-01' and '1996-07-03'")
    price = F.when(k % 991 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    after = orders.where("day not between '1995-03-01' and '1995-03-05'").where(k % 997 != 0)
    late = orders.where(k % 983 == 0).withColumn("o_orderkey", -k)
    return before, after.withColumn("o_totalprice", price).unionByName(late)


def changed_days(spark, sf_dir):
    """Days of orders whose rows are others than before, found by digests alone."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    was, now = (digest.day_digests(rows, F.col("day"), columns) for rows in _orders_before_and_after(spark, sf_dir))
    return digest.changed_days(was, now)


def _changed_events(spark, sf_dir) -> DataFrame:
    """Events later on: some have gone, some have another value, some have come late."""
    k, day = F.col("event_id"), F.dayofmonth("ts")
    events = table(spark, sf_dir, "events")
    kept = events.where(~((k % 50 == 0) & day.isin(10, 20)))
    value = F.when((k % 30 == 0) & (day == 15), F.col("value") + 1).otherwise(F.col("value"))
    return kept.withColumn("value", value).unionByName(events.where((k % 40 == 0) & (day == 25)).withColumn("event_id", -k))


def sync_changed_days(spark, sf_dir):
    """The second of two runs that load changed days only: what each day holds, and which were loaded."""
    base, newest = shared_dir(spark, "changed"), _newest(spark, sf_dir, EVENTS)
    store, target = RunStore(f"{base}/store"), ParquetTarget(f"{base}/data")

    def later(spark, spec, first, last):
        return window.between_days(_changed_events(spark, sf_dir), spec.time_column, first, last)

    for read in (standins.source(sf_dir), later):
        results = sync(spark, [EVENTS], read, target, store, as_of=newest, changed_only=True)
    return results.select("day", "records", "status", "loaded")


def late_arrivals(spark, sf_dir):
    """How far back the days lie that late orders have changed."""
    newest = _newest(spark, sf_dir, ORDERS)
    k, age = F.col("o_orderkey"), F.date_diff(F.lit(newest), "day")
    after = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    before = after.where(~((k % 5 == 0) & (age <= F.floor(k / 5) % 30)))
    was, now = (digest.day_digests(rows, F.col("day")) for rows in (before, after))
    return digest.lateness(digest.changed_days(was, now), F.lit(newest))


def late_arrival_window(spark, sf_dir):
    """The shortest window that would have carried four of five of the changed days."""
    return digest.covering_window(late_arrivals(spark, sf_dir), 0.8)


def undated_new_files(spark, sf_dir):
    """Undated rows of a source that grows by files, as each run counts them: only new files are opened."""
    base, k = shared_dir(spark, "files"), F.col("event_id")
    spec = TableSpec("texts", "ods_query", mapping(["Time", "event_id"], ["time", "event_id"]), "Time")
    source, store = ParquetSource({"texts": f"{base}/in"}, {"texts": "Time string, event_id bigint"}), RunStore(f"{base}/store").create(spark)
    time = F.when(k % 7 == 0, None).when(k % 11 == 0, "soon").otherwise(F.col("ts").cast("string"))
    rows = table(spark, sf_dir, "events").select(time.alias("Time"), "event_id")
    reports = []
    for run, part in enumerate(("event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 2"), 1):
        rows.where(part).write.mode("append").parquet(f"{base}/in")
        found = source.undated_in_new_files(spark, spec, store.files(spark, "texts"))
        store.update_files(found, "texts", run)
        known = store.files(spark, "texts")
        reports.append(known.agg(F.lit(run).cast("bigint").alias("run"), F.sum("undated").alias("undated")))
        reports[-1] = small_frame(spark, [r.asDict() for r in reports[-1].collect()], reports[-1].schema)
    return standins.stack(reports)


def window_sync_zone(spark, sf_dir):
    """Records per day that a sync by Beijing's clock would carry; times are stored in UTC."""
    zone = "Asia/Shanghai"
    rows = table(spark, sf_dir, "events")
    newest = rows.agg(F.max("ts")).first()[0].replace(tzinfo=dt.UTC)
    inside = window.rolling_window(rows, "ts", EVENTS.default_days, window.today(zone, newest), zone)
    return inside.groupBy(window.day_of(inside, "ts", zone).alias("day")).agg(F.count(F.lit(1)).alias("records"))


def lane_schedule(spark, sf_dir):
    """Loads of unequal weight in three lanes: events by type, orders by status, lineitems by flag."""
    kinds = (("events", "event_type"), ("orders", "o_orderstatus"), ("lineitem", "l_returnflag"))
    counted = standins.stack([
        table(spark, sf_dir, t).groupBy(F.concat(F.lit(f"{t}."), F.col(c)).alias("target_table")).agg(F.count(F.lit(1)).alias("weight"))
        for t, c in kinds
    ])
    weights = {r["target_table"]: r["weight"] for r in counted.collect()}  # a row per load
    return tasks.lane_schedule(spark, weights, 3)


def ledger_compaction(spark, sf_dir):
    """The collapsed runs of a ledger that was appended to in parts and folded twice in between."""
    store = RunStore(f"{shared_dir(spark, 'compaction')}/store").create(spark)
    rows = standins.ledger(spark, sf_dir)
    for part in range(5):
        store.append(rows.where(F.col("id") % 5 == part))
        if part in (1, 3):
            store.compact(spark)
    return ledger.latest_run_state(store.ledger(spark))


def hot_day_quantiles(spark, sf_dir):
    """Whether ranges between quantiles of the order key cut lineitem into eight parts: each row in one, none too large."""
    rows = table(spark, sf_dir, "lineitem")
    clauses = range_clauses("l_orderkey", quantile_bounds(rows, "l_orderkey", 8))
    hits = [F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in clauses]
    part = F.coalesce(*[F.when(F.expr(c), i) for i, c in enumerate(clauses)])
    parts = rows.groupBy(part.alias("part"), reduce(Column.__add__, hits).alias("hits")).agg(F.count(F.lit(1)).alias("n"))
    return parts.agg(
        F.count_distinct("part").alias("parts"),
        F.sum(F.when(F.col("hits") == 1, F.col("n")).otherwise(0)).alias("records"),
        (F.max("n") <= 2 * F.sum("n") / len(clauses)).alias("balanced"),
    )


_REPORT_INPUTS = {
    "ods_Query": ("events", "event_id"),
    "ods_campain": ("orders", "o_orderkey"),
    "ods_campaign_dsp": ("part", "p_partkey"),
    "ods_aws_asin_philips": ("supplier", "s_suppkey"),
}
_REPORT_TEXTS = {
    "string": "concat('v', k % {n})",
    "bigint": "cast(k % {n} AS string)",
    "decimal(18,4)": "cast(cast((k % 1000) / 8 AS decimal(18,4)) AS string)",
    "double": "cast((k % 16) / 16D AS string)",
    "date": "cast(d AS string)",
    "timestamp_ntz": "concat(d, ' 12:30:00')",
}


def _report_source(spark, sf_dir):
    """Reads a wide report source: all columns as text, those that the shipped mapping names, over 90 days."""

    def read(spark, spec, first, last):
        name, key = _REPORT_INPUTS[spec.source_table]
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(
            f"cast({key} AS bigint) AS k", f"date_sub(date '2024-01-30', cast({key} % 90 AS int)) AS d"
        )
        wide = []
        for i, c in enumerate(spec.columns):
            value = _REPORT_TEXTS[c.type].format(n=i + 2)
            value = value if c.source == spec.time_column else f"CASE WHEN k % {i + 2} <> 0 THEN {value} END"
            wide.append(f"{value} AS {project.quoted(c.source)}")
        return window.between_days(rows.selectExpr(*wide), spec.time_column, first, last)

    return read


def sync_report_tables(spark, sf_dir):
    """A sync of the four shipped report tables with their types: what each target column holds afterwards."""
    base = shared_dir(spark, "reports")
    target, as_of = ParquetTarget(f"{base}/data"), dt.date(2024, 1, 30)
    results = sync(spark, REPORT_TABLES, _report_source(spark, sf_dir), target, RunStore(f"{base}/store"), as_of=as_of)
    status = results.groupBy("target_table").agg(F.sum("records").alias("records"), F.max("status").alias("status"))
    reports = []
    for spec in REPORT_TABLES:
        held = target.table(spark, spec)
        entries = []
        for name, kind in held.drop("day").dtypes:
            c = project.quoted(name)
            numbers = f"sum(cast({c} AS decimal(28,4)))" if kind in ("bigint", "double", "decimal(18,4)") else "NULL"
            entries.append(
                f"struct({project.text(spec.target_table)} AS of_table, {project.text(name)} AS target_column, "
                f"{project.text(kind)} AS type, count({c}) AS filled, cast({numbers} AS decimal(18,4)) AS total)"
            )
        reports.append(project.column_report(held, entries))
    return standins.stack(reports).join(status, F.col("of_table") == F.col("target_table")).drop("of_table")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        window_sync,
        window_sync_orders,
        window_sync_lineitem,
        window_days_override,
        table_subset,
        table_subset_all,
        day_counts,
        table_registry,
        mapped_projection,
        mapping_catalog,
        typed_projection,
        typed_projection_failures,
        day_task_plan,
        task_order_topk,
        lane_depth,
        day_coverage,
        missing_days,
        run_ledger_append,
        latest_run_state,
        run_history_topk,
        run_history_default,
        run_totals,
        run_duration,
        history_display,
        run_messages,
        rows_to_json,
        status_document,
        run_duration_text,
        run_elapsed_text,
        status_labels,
        status_class,
        tables_label,
        valid_schedule_time,
        beijing_time,
        table_status_rollup,
        table_status_upsert,
        table_status_lookup,
        table_status_listing,
        table_status_display,
        day_sliced_scan,
        source_preflight,
        partitioned_sink_roundtrip,
        window_reload_idempotent,
        window_reload_stale_days,
        sync_run,
        sync_ledger,
        sync_losses,
        sync_overlap,
        sync_refused,
        changed_days,
        sync_changed_days,
        late_arrivals,
        late_arrival_window,
        undated_new_files,
        window_sync_zone,
        lane_schedule,
        ledger_compaction,
        hot_day_quantiles,
        sync_report_tables,
    )
}
