import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import dayferry
from dayferry.operators.ledger import latest_run_state, stop_record
from dayferry.registry import TableSpec, mapping
from dayferry.sources.preflight import Probe, preflight

AS_OF = dt.date(2024, 1, 30)
EVENTS = TableSpec(
    "events", "ods_query", mapping(["ts", "event_id", "value"], ["time", "id", "sales"], [None, None, "decimal(18,4)"]),
    "ts", 24,
)
CLICKS = TableSpec("clicks", "ods_clicks", mapping(["ts", "event_id"], ["time", "id"], ["date", None]), "ts", 60)
BROKEN = TableSpec("broken", "ods_broken", mapping(["ts", "No.Such"], ["time", "x"]), "ts", 3)


@pytest.fixture
def setup(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = str(tmp_path / "clicks")
    events.where("event_type = 'click' and dayofmonth(ts) <> 20").write.parquet(path)
    source = dayferry.ParquetSource(
        {"events": f"{sf_dir}/events.parquet", "clicks": path, "broken": path, "gone": path + "-gone"}
    )
    ticks = itertools.count()
    return {
        "spark": spark,
        "read": source,
        "target": dayferry.ParquetTarget(str(tmp_path / "data")),
        "store": dayferry.RunStore(str(tmp_path / "store")),
        "as_of": AS_OF,
        "clock": lambda: dt.datetime(2024, 2, 1, 9) + dt.timedelta(seconds=30 * next(ticks)),
    }


def ledger(s):
    rows = dayferry.run_history(s["store"].ledger(s["spark"])).collect()
    return [(r.id, r.status, r.tables_migrated, r.total_records, r.duration_seconds) for r in rows]


def status(s):
    rows = dayferry.table_status(s["store"].status(s["spark"])).collect()
    return [(r.id, r.table_name, r.records_count, r.status, r.last_error) for r in rows]


def test_whole_run(setup, sf_dir):
    spark = setup["spark"]
    results = dayferry.sync(registry=[EVENTS, CLICKS], **setup)
    rows = {(r.target_table, r.day): r for r in results.collect()}
    assert len(rows) == 24 + 60 and {r.status for r in rows.values()} == {"success"}
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    expected = {r.d: r["count"] for r in events.groupBy(F.to_date("ts").alias("d")).count().collect()}
    for (table, day), r in rows.items():
        if table == "ods_query":
            assert r.records == expected[day]
    assert rows["ods_clicks", dt.date(2024, 1, 20)].records == 0
    n_events = sum(r.records for r in rows.values() if r.target_table == "ods_query")
    n_clicks = sum(r.records for r in rows.values() if r.target_table == "ods_clicks")
    assert n_events == 7954
    assert ledger(setup) == [(2, "success", "all", n_events + n_clicks, 30.0), (1, "running", "all", 0, 0.0)]
    assert status(setup) == [(2, "ods_clicks", n_clicks, "success", None), (1, "ods_query", n_events, "success", None)]
    held = setup["target"].table(spark, EVENTS)
    assert dict(held.dtypes) == {"time": "timestamp_ntz", "id": "bigint", "sales": "decimal(18,4)", "day": "date"}
    assert held.exceptAll(
        events.where("ts >= '2024-01-07'").selectExpr(
            "ts time", "event_id id", "cast(value as decimal(18,4)) sales", "to_date(ts) day"
        )
    ).count() == 0


def test_reader_that_returns_more_than_the_window(setup, sf_dir):
    setup["read"] = lambda spark, spec, first, last: spark.read.parquet(f"{sf_dir}/events.parquet")
    results = dayferry.sync(registry=[EVENTS], **setup)
    assert results.agg(F.sum("records")).first()[0] == 7954
    assert setup["target"].table(setup["spark"], EVENTS).agg(F.min("day")).first()[0] == dt.date(2024, 1, 7)


def test_store_before_the_first_run(setup):
    for _ in range(2):
        setup["store"].create(setup["spark"])
        assert ledger(setup) == [] and status(setup) == []
    assert [setup["store"].claim(setup["spark"]) for _ in range(3)] == [1, 2, 3]


def test_rerun_subset_and_days(setup):
    dayferry.sync(registry=[EVENTS, CLICKS], **setup)
    again = dayferry.sync(registry=[EVENTS, CLICKS], tables=["ods_query"], days=3, **setup)
    assert again.count() == 3
    assert [x[:3] for x in ledger(setup)] == [
        (4, "success", "ods_query"), (3, "running", "ods_query"), (2, "success", "all"), (1, "running", "all"),
    ]
    assert latest_run_state(setup["store"].ledger(setup["spark"])).count() == 2
    assert [(x[0], x[1]) for x in status(setup)] == [(2, "ods_clicks"), (1, "ods_query")]
    assert status(setup)[1][2] == again.agg(F.sum("records")).first()[0]
    assert setup["target"].table(setup["spark"], EVENTS).count() == 7954


@pytest.mark.parametrize("bad", [{"days": 0}, {"days": 366}, {"tables": ["nope"]}])
def test_bad_arguments_leave_no_run(setup, bad):
    with pytest.raises(ValueError):
        dayferry.sync(registry=[EVENTS], **setup, **bad)
    setup["store"].create(setup["spark"])
    assert ledger(setup) == []


def test_one_bad_table_does_not_stop_the_others(setup):
    results = dayferry.sync(registry=[BROKEN, EVENTS], **setup)
    by_table = {r.target_table: r for r in results.collect()}
    assert by_table["ods_broken"].status == "failed" and by_table["ods_broken"].records == 0
    assert "No.Such" in by_table["ods_broken"].error
    assert by_table["ods_query"].status == "success"
    (_, last_status, _, total, _), _ = ledger(setup)
    assert (last_status, total) == ("failed", 7954)
    broken, query = status(setup)
    assert broken[1:4] == ("ods_broken", 0, "failed") and "No.Such" in broken[4]
    assert query[1:] == ("ods_query", 7954, "success", None)
    # Once the source is repaired the error goes away.
    mended = TableSpec("broken", "ods_broken", CLICKS.columns, "ts", 3)
    dayferry.sync(registry=[mended, EVENTS], **setup)
    assert status(setup)[0][3:] == ("success", None)


def test_target_that_holds_other_rows_is_a_failure(setup):
    class Lossy(dayferry.ParquetTarget):
        def replace_days(self, *args):
            return super().replace_days(*args) + 1

    setup["target"] = Lossy(setup["target"].base)
    results = dayferry.sync(registry=[EVENTS], **setup).collect()
    assert {r.status for r in results} == {"failed"}
    assert {r.error for r in results} == {"wrote 7955 records, target holds 7954"}


def test_run_that_dies_keeps_the_earlier_status(setup):
    dayferry.sync(registry=[CLICKS], **setup)
    before = status(setup)

    class Dying(dayferry.RunStore):
        def update_status(self, updates, version):
            raise KeyboardInterrupt

    store = setup["store"]
    setup["store"] = Dying(store.ledger_path.removesuffix("/ledger"))
    with pytest.raises(KeyboardInterrupt):
        dayferry.sync(registry=[CLICKS, EVENTS], **setup)
    setup["store"] = store
    assert status(setup) == before
    assert ledger(setup)[0][:2] == (3, "running")
    dayferry.sync(registry=[CLICKS, EVENTS], **setup)
    assert [x[:2] for x in status(setup)] == [(1, "ods_clicks"), (3, "ods_query")]
    assert [x[:2] for x in ledger(setup)[:2]] == [(5, "success"), (4, "running")]


def test_store_that_fails_is_recorded(setup):
    dayferry.sync(registry=[EVENTS], **setup)
    before = status(setup)

    class Failing(dayferry.RunStore):
        def write_results(self, results, run_id):
            raise OSError("disk full")

    setup["store"] = Failing(setup["store"].ledger_path.removesuffix("/ledger"))
    with pytest.raises(OSError):
        dayferry.sync(registry=[CLICKS], **setup)
    last = dayferry.run_history(setup["store"].ledger(setup["spark"]), 1).first()
    assert (last.id, last.status, last.error_message) == (4, "failed", "disk full")
    assert status(setup) == before


def test_run_stopped_by_its_user(setup):
    spark, store = setup["spark"], setup["store"]

    class Stopping(dayferry.ParquetTarget):
        def replace_days(self, *args):
            started = dayferry.run_history(store.ledger(spark), 1).first().start_time
            store.append(stop_record(spark, store.claim(spark), started, started, 0))
            return super().replace_days(*args)

    setup["target"] = Stopping(setup["target"].base)
    dayferry.sync(registry=[EVENTS], **setup)
    assert [x[:3] for x in ledger(setup)] == [(3, "success", "all"), (2, "stopped", ""), (1, "running", "all")]


def test_copies_belong_to_the_callers_job_group(setup):
    groups = []

    class Noting(dayferry.ParquetTarget):
        def replace_days(self, rows, *args):
            groups.append(rows.sparkSession.sparkContext.getLocalProperty("spark.jobGroup.id"))
            return super().replace_days(rows, *args)

    setup["target"] = Noting(setup["target"].base)
    context = setup["spark"].sparkContext
    context.setJobGroup("nightly", "sync")
    try:
        dayferry.sync(registry=[EVENTS, CLICKS], **setup)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert groups == ["nightly", "nightly"]


def test_status_document_after_a_run(setup):
    results = dayferry.sync(registry=[EVENTS], **setup)
    doc = dayferry.status_document(setup["store"].ledger(setup["spark"]), results).first()
    assert (doc.is_running, doc.total_records, doc.completed_tasks, doc.failed_tasks) == (False, 7954, 24, 0)


def test_shipped_report_tables(spark, tmp_path):
    """All four report tables with their own column names, every value as text."""
    samples = {
        "date": "2024-01-30", "timestamp_ntz": "2024-01-30 01:02:03", "string": "x", "bigint": "7",
        "decimal(18,4)": "1.5", "double": "0.25",
    }
    paths = {}
    for spec in dayferry.REPORT_TABLES:
        values = [samples[c.type] for c in spec.columns]
        late = ["2023-11-30" if c.source == spec.time_column else v for c, v in zip(spec.columns, values)]
        bad = ["n/a" if c.type == "bigint" else v for c, v in zip(spec.columns, values)]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in ["Other", *spec.source_columns]])
        paths[spec.source_table] = str(tmp_path / "in" / spec.source_table)
        rows = [["o", *v] for v in (values, values, bad, late)]
        spark.createDataFrame(rows, schema).write.parquet(paths[spec.source_table])
    target = dayferry.ParquetTarget(str(tmp_path / "data"))
    store = dayferry.RunStore(str(tmp_path / "store"))
    args = (spark, dayferry.REPORT_TABLES, dayferry.ParquetSource(paths), target, store)
    failed = {r.target_table: (r.status, r.error) for r in dayferry.sync(*args, as_of=AS_OF).collect()}
    assert {s for s, _ in failed.values()} == {"failed"}
    assert "click as bigint: 1 values lost, 0 changed" in failed["ods_query"][1]
    # What is known to be lost can be allowed for: the "n/a" of each table.
    results = dayferry.sync(*args, as_of=AS_OF, lost_values_allowed=100)
    assert {r.status for r in results.collect()} == {"success"}
    assert results.count() == 24 + 3 * 60
    # 2023-11-30 lies 61 days back.
    assert {r.table_name: r.records_count for r in store.status(spark).collect()} == {
        s.target_table: 3 for s in dayferry.REPORT_TABLES
    }
    for spec in dayferry.REPORT_TABLES:
        held = target.table(spark, spec)
        assert held.dtypes == [(c.target, c.type) for c in spec.columns] + [("day", "date")]
        [n] = {c.target for c in spec.columns if c.type == "bigint"} & {"click", "click_throughs"}
        assert sorted((r[n] is None, r[n]) for r in held.collect()) == [(False, 7), (False, 7), (True, None)]


def test_preflight(setup):
    spark, read = setup["spark"], setup["read"]
    probes = [
        read.probe(EVENTS),
        read.probe(BROKEN),
        Probe("gone", "target", lambda s: read.table(s, "gone"), "ts"),
    ]
    rows = {r.name: r for r in preflight(spark, probes).collect()}
    assert rows["events"].success and rows["events"].message == "events connection successful"
    assert (rows["events"].records, rows["events"].first_day, rows["events"].last_day) == (
        10_000, dt.date(2024, 1, 1), AS_OF,
    )
    assert not rows["broken"].success and rows["broken"].missing_columns == "No.Such"
    assert not rows["gone"].success and rows["gone"].message.startswith("gone connection failed: [PATH_NOT_FOUND]")
    assert [r.name for r in preflight(spark, probes, "target").collect()] == ["gone"]
    assert preflight(spark, probes, "source").count() == 2
    assert preflight(spark, probes, "neither").count() == 0
    dayferry.sync(registry=[EVENTS], **setup)
    held = preflight(spark, [setup["target"].probe(EVENTS)]).first()
    assert (held.kind, held.success, held.records, held.first_day, held.last_day) == (
        "target", True, 7954, dt.date(2024, 1, 7), AS_OF,
    )


def test_text_times_never_touch_days_outside_the_window(spark, tmp_path):
    spec = TableSpec("t", "t", mapping(["Time", "n"], ["time", "n"], ["timestamp_ntz", "bigint"]), "Time", 200)
    path = str(tmp_path / "in")

    def put(*times):
        df = spark.createDataFrame([(t, str(i)) for i, t in enumerate(times)], "Time string, n string")
        df.write.mode("overwrite").parquet(path)

    target = dayferry.ParquetTarget(str(tmp_path / "data"))
    args = (dayferry.ParquetSource({"t": path}), target, dayferry.RunStore(str(tmp_path / "store")))
    put("2024-01-05", "2024-01-05 10:00:00")
    dayferry.sync(spark, [spec], *args, as_of=dt.date(2024, 1, 5))
    # Unpadded January sorts as text between the bounds of a window that ends in December.
    put("2024-1-5", "2024-12-30", "2024-12-30 99:00:00")
    results = dayferry.sync(spark, [spec], *args, as_of=dt.date(2024, 12, 31))
    assert {(r.status, r.error) for r in results.collect()} == {
        ("failed", "time as timestamp_ntz: 1 values lost, 0 changed; 1 rows of t have no readable Time")
    }
    allowed = {"lost_values_allowed": 1, "undated_rows_allowed": 1}
    results = dayferry.sync(spark, [spec], *args, as_of=dt.date(2024, 12, 31), **allowed)
    assert {r.status for r in results.collect()} == {"success"}
    held = {(str(r.day), r.n): r.time for r in target.table(spark, spec).collect()}
    assert held == {
        ("2024-01-05", 0): dt.datetime(2024, 1, 5), ("2024-01-05", 1): dt.datetime(2024, 1, 5, 10),
        ("2024-12-30", 1): dt.datetime(2024, 12, 30), ("2024-12-30", 2): None,
    }


def test_rounded_values_and_null_times_fail_a_table(spark, tmp_path):
    spec = TableSpec("t", "t", mapping(["Time", "a", "b", "c"], ["time", "a", "b", "c"], ["date", "decimal(18,4)", "bigint", "bigint"]), "Time", 5)
    path = str(tmp_path / "in")
    rows = [("2024-01-30", "0.123456", "7.9", "n/a"), ("2024-01-30", "1.50", "7.0", "7"), (None, "1", "1", "1")]
    spark.createDataFrame(rows, "Time string, a string, b string, c string").write.parquet(path)
    target, store = dayferry.ParquetTarget(str(tmp_path / "data")), dayferry.RunStore(str(tmp_path / "store"))
    args = (spark, [spec], dayferry.ParquetSource({"t": path}), target, store)
    [error] = {r.error for r in dayferry.sync(*args, as_of=AS_OF).collect()}
    assert error == (
        "a as decimal(18,4): 0 values lost, 1 changed; b as bigint: 2 values lost, 0 changed; "
        "c as bigint: 1 values lost, 0 changed; 1 rows of t have no readable Time"
    )
    last = store.ledger(spark).orderBy("id").collect()[-1]
    assert last.status == "failed" and last.error_message == f"t: {error}"
    assert store.status(spark).first().status == "failed"
    plain = [spec.untyped()]
    [status] = {r.status for r in dayferry.sync(spark, plain, *args[2:], as_of=AS_OF, undated_rows_allowed=1).collect()}
    assert status == "success"


def test_old_days_of_a_target_are_not_listed(spark, tmp_path, setup):
    target = dayferry.ParquetTarget(str(tmp_path / "data"))
    dayferry.sync(registry=[EVENTS], **{**setup, "target": target})
    folder = tmp_path / "data" / EVENTS.target_table / "day=2020-01-01"
    folder.mkdir()
    (folder / "part-0.parquet").write_text("no parquet: reading or listing this day would fail")
    days = target.day_counts(spark, EVENTS, dt.date(2024, 1, 7), AS_OF)
    assert days.count() == 24 and "2020-01-01" not in str(days.inputFiles())
