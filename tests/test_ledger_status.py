import datetime as dt
import random

import pytest

from dayferry.frames import small_frame
from dayferry.operators.counts import run_totals
from dayferry.operators.ledger import (
    LEDGER_SCHEMA,
    append_runs,
    latest_run_state,
    run_history,
    run_record,
    stop_record,
)
from dayferry.operators.status import (
    STATUS_SCHEMA,
    status_document,
    status_of,
    table_status,
    upsert_status,
)

T0 = dt.datetime(2024, 1, 1, 9)


def ledger_row(id, start=T0, status="success", total=1, **more):
    return dict.fromkeys(LEDGER_SCHEMA.names) | {
        "id": id, "start_time": start, "status": status, "total_records": total, **more
    }


def ledger(spark, *rows):
    return small_frame(spark, rows, LEDGER_SCHEMA)


def status_row(name, id=1, time=T0, n=1, status="success", error=None):
    return {"id": id, "table_name": name, "last_sync_time": time, "records_count": n, "status": status,
            "last_error": error}


def test_run_record(spark):
    end = T0 + dt.timedelta(minutes=2, microseconds=250)
    row = run_record(spark, 7, T0, end, "failed", ["a", "b"], 5, "boom")
    assert row.schema.fieldNames() == LEDGER_SCHEMA.names
    assert tuple(row.first()) == (7, T0, end, "failed", "a,b", 5, "boom", 120.00025)
    assert run_record(spark, 1, T0, None, "running", None, 0).first()[4:] == ("all", 0, None, 0.0)
    stopped = stop_record(spark, 8, T0, end, 5).first()
    assert (stopped.status, stopped.tables_migrated, stopped.error_message) == (
        "stopped", "", "Migration stopped by user"
    )


def test_append_keeps_all_rows(spark):
    old = ledger(spark, ledger_row(1), ledger_row(2))
    both = append_runs(old, run_record(spark, 3, T0, None, "running", None, 0))
    assert sorted(r.id for r in both.collect()) == [1, 2, 3]


def test_history_limits_and_ties(spark):
    rows = [ledger_row(i, T0 + dt.timedelta(days=i // 2)) for i in range(60)] + [ledger_row(99, None)]
    log = ledger(spark, *rows)
    assert [r.id for r in run_history(log, 3).collect()] == [59, 58, 57]
    assert run_history(log).count() == run_history(log, "x").count() == 50
    assert run_history(log, 0).count() == 0
    everything = [r.id for r in run_history(log, -1).collect()]
    assert len(everything) == 61 and everything[-1] == 99
    assert "TakeOrderedAndProject" in run_history(log, 3)._jdf.queryExecution().executedPlan().toString()


def test_latest_state_against_brute_force_with_a_hot_run(spark):
    rng = random.Random(1)
    ids = rng.sample(range(10_000), 900)
    # One run holds a third of all rows.
    starts = [T0 if i % 3 == 0 else T0 + dt.timedelta(seconds=rng.randrange(40)) for i in range(900)]
    rows = [
        ledger_row(i, s, rng.choice(["running", "success", "failed"]), rng.randrange(9),
                   error_message=rng.choice([None, "x"]))
        for i, s in zip(ids, starts)
    ]
    expected = {}
    for r in sorted(rows, key=lambda r: r["id"]):
        expected[r["start_time"]] = tuple(r[c] for c in LEDGER_SCHEMA.names)
    found = latest_run_state(ledger(spark, *rows).repartition(7))
    assert sorted(map(tuple, found.collect()), key=lambda r: r[0]) == sorted(
        expected.values(), key=lambda r: r[0]
    )
    assert found.columns == LEDGER_SCHEMA.names


def test_totals(spark):
    rows = spark.createDataFrame(
        [("success", 3), ("success", 4), ("failed", 0), ("running", None)], "status string, records bigint"
    )
    assert tuple(run_totals(rows).first()) == (7, 2, 1, 4)
    assert tuple(run_totals(rows.limit(0)).first()) == (0, 0, 0, 0)


def brute_upsert(old, new):
    table = {r["table_name"]: dict(r) for r in old}
    for r in new:
        kept = table.get(r["table_name"])
        table[r["table_name"]] = {**r, "id": kept["id"] if kept else r["id"]}
    return sorted(tuple(r[c] for c in STATUS_SCHEMA.names) for r in table.values())


def test_upsert_against_brute_force(spark):
    old = [status_row(f"t{i}", i, n=i, status="failed", error="old") for i in range(6)]
    new = [status_row(f"t{i}", 100 + i, T0 + dt.timedelta(days=1), n=i * 10) for i in range(3, 9)]
    found = upsert_status(small_frame(spark, old, STATUS_SCHEMA), small_frame(spark, new, STATUS_SCHEMA))
    key = lambda r: r[1]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute_upsert(old, new), key=key)


def test_upsert_replaces_the_whole_row(spark):
    old = [status_row("t", 1, T0, 5, "failed", "boom")]
    new = [{**dict.fromkeys(STATUS_SCHEMA.names), "id": 2, "table_name": "t"}]
    found = upsert_status(small_frame(spark, old, STATUS_SCHEMA), small_frame(spark, new, STATUS_SCHEMA))
    assert [tuple(r) for r in found.collect()] == [(1, "t", None, None, None, None)]


def test_upsert_into_a_table_with_a_hot_key(spark):
    old = [status_row("hot", i, T0 + dt.timedelta(seconds=i)) for i in range(500)]
    old += [status_row(f"t{i}", 1000 + i) for i in range(1000)]
    new = [status_row("t1", 9, n=77)]
    found = upsert_status(small_frame(spark, old, STATUS_SCHEMA), small_frame(spark, new, STATUS_SCHEMA))
    rows = {r.table_name: r for r in found.collect()}
    assert len(rows) == 1001
    assert rows["hot"].last_sync_time == T0 + dt.timedelta(seconds=499) and rows["hot"].id == 0
    assert (rows["t1"].records_count, rows["t1"].id) == (77, 1001)


def test_lookup_and_listing(spark):
    rows = small_frame(spark, [status_row("b"), status_row(None), status_row("a")], STATUS_SCHEMA)
    assert [r.table_name for r in table_status(rows).collect()] == [None, "a", "b"]
    assert status_of(rows, "a").count() == 1 and status_of(rows, "z").count() == 0


@pytest.mark.parametrize("running", [True, False])
def test_status_document(spark, running):
    rows = [ledger_row(1, status="running"), ledger_row(3, T0 + dt.timedelta(days=1), "running")]
    if not running:
        rows.append(ledger_row(4, T0 + dt.timedelta(days=1), "failed", error_message="boom"))
    results = spark.createDataFrame([("success", 3), ("failed", 0)], "status string, records bigint")
    doc = status_document(ledger(spark, *rows), results, {"workers": "4"}).first()
    assert doc.is_running is running
    assert doc.current_migration_id == 3  # the row that opened the run, also once it has ended
    assert doc.last_error == (None if running else "boom")
    assert (doc.total_records, doc.completed_tasks, doc.failed_tasks) == (3, 1, 1)
    assert (doc.progress_info, doc.config) == ({}, {"workers": "4"})
    assert len(doc) == 9


def test_status_document_of_a_stopped_run(spark):
    rows = [ledger_row(1, status="running"), ledger_row(2, status="stopped", error_message="Migration stopped by user")]
    none = spark.createDataFrame([], "status string, records bigint")
    doc = status_document(ledger(spark, *rows), none).first()
    assert (doc.is_running, doc.current_migration_id, doc.last_error) == (False, 1, None)


def test_status_document_before_the_first_run(spark):
    none = spark.createDataFrame([], "status string, records bigint")
    doc = status_document(ledger(spark), none).first()
    assert doc.is_running is False and doc.current_migration_id is None and doc.total_records == 0
