import datetime as dt

from pyspark.sql import functions as F

from dayferry.plans.tasks import (
    day_coverage,
    day_tasks,
    describe_tasks,
    lane_depth,
    missing_days,
    order_tasks,
    table_windows,
    with_columns,
)
from dayferry.operators.window import window_bounds
from dayferry.registry import REPORT_TABLES, mapping_frame

AS_OF = dt.date(2024, 3, 1)


def plan(spark, days=None, as_of=AS_OF):
    return day_tasks(table_windows(spark, REPORT_TABLES, as_of, days))


def test_plan_has_one_task_per_table_and_day(spark):
    rows = plan(spark).collect()
    assert len(rows) == 24 + 3 * 60
    assert sorted(r.task_id for r in rows) == list(range(1, 205))
    for spec in REPORT_TABLES:
        mine = sorted((r for r in rows if r.target_table == spec.target_table), key=lambda r: r.task_id)
        first, last = window_bounds(AS_OF, spec.default_days)
        assert [r.day for r in mine] == [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
        assert all(r.date_str == r.day.isoformat() and r.priority == 0 for r in mine)
        assert {r.source_table for r in mine} == {spec.source_table}


def test_days_override_and_dates_per_table(spark):
    assert plan(spark, 1).count() == 4
    assert plan(spark, 365).count() == 4 * 365
    some = {"ods_query": dt.date(2024, 1, 2), "ods_campain": F.lit(dt.date(2024, 1, 3))}
    rows = plan(spark, 2, some).collect()
    assert [(r.target_table, r.date_str) for r in sorted(rows, key=lambda r: r.task_id)] == [
        ("ods_query", "2024-01-01"), ("ods_query", "2024-01-02"),
        ("ods_campain", "2024-01-02"), ("ods_campain", "2024-01-03"),
    ]


def test_tasks_carry_the_columns_of_their_table(spark):
    rows = with_columns(plan(spark, 2), mapping_frame(spark, REPORT_TABLES)).collect()
    assert len(rows) == 8
    for spec in REPORT_TABLES:
        for r in (r for r in rows if r.target_table == spec.target_table):
            assert [(c.name, c.type) for c in r.columns] == [(c.target, c.type) for c in spec.columns]


def test_order_is_by_priority_then_id(spark):
    tasks = plan(spark, 3).withColumn("priority", -F.col("table_index"))
    assert [r.task_id for r in order_tasks(tasks, 4).collect()] == [10, 11, 12, 7]
    assert order_tasks(tasks).count() == 12
    assert describe_tasks(order_tasks(tasks, 1)).first().description == (
        "MigrationTask(id=10, priority=-3, date=2024-02-28, table=ods_aws_asin_philips)"
    )


def test_lanes(spark):
    depth = {r.lane: r.depth for r in lane_depth(plan(spark)).collect()}
    assert depth == {s.lane: s.default_days for s in REPORT_TABLES}


def test_coverage_and_missing(spark):
    counts = spark.createDataFrame(
        [("ods_query", AS_OF, 5), ("ods_query", dt.date(2000, 1, 1), 9)],
        "target_table string, day date, records bigint",
    )
    tasks = plan(spark, 2)
    covered = {(r.target_table, r.day): r.records for r in day_coverage(tasks, counts).collect()}
    assert len(covered) == 8 and sum(covered.values()) == covered["ods_query", AS_OF] == 5
    missing = {(r.target_table, r.day) for r in missing_days(tasks, counts).collect()}
    assert missing == {k for k, n in covered.items() if n == 0}
