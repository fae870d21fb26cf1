import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dayferry.operators.counts import day_counts
from dayferry.operators.project import column_report, failed_casts, map_columns, map_typed
from dayferry.operators.window import between_days, newest_day, rolling_window, window_bounds
from dayferry.registry import mapping


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_awkward_names(spark):
    names = ["Impression.rank", "DPV 14天", "T-Pixel", "back`tick", "quo'te"]
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "a int, b int, c int, d int, e int").toDF(*names)
    targets = ["e'", "d.d", "c c", "b`", "a"]
    out = map_columns(df, mapping(names[::-1], targets))
    assert out.columns == targets
    assert tuple(out.first()) == (5, 4, 3, 2, 1)
    typed = mapping(names[::-1], targets, ["string"] * 5)
    assert map_typed(df, typed).columns == targets
    assert sorted(r.target_column for r in failed_casts(df, typed).collect()) == sorted(targets)


def test_typed_projection_counts_what_it_loses(spark):
    df = spark.createDataFrame([("1", "x"), ("abc", None), (None, "2024-01-05")], "`n.o` string, d string")
    columns = mapping(["n.o", "d"], ["n", "d"], ["bigint", "date"])
    assert [tuple(r) for r in map_typed(df, columns).collect()] == [
        (1, None), (None, None), (None, dt.date(2024, 1, 5)),
    ]
    report = {r.target_column: (r.records, r.present, r.failed) for r in failed_casts(df, columns).collect()}
    assert report == {"n": (3, 2, 1), "d": (3, 2, 1)}
    with pytest.raises(ValueError):
        failed_casts(df, mapping(["d"], ["d"]))


def test_column_report_in_chunks(spark):
    df = spark.range(10).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(7)])
    entries = [f"struct('{c}' AS c, sum({c}) AS s)" for c in df.columns]
    one, many = column_report(df, entries), column_report(df, entries, chunk=3)
    assert Counter(one.collect()) == Counter(many.collect())
    assert {r.c: r.s for r in many.collect()} == {f"c{i}": 45 + 10 * i for i in range(7)}


def test_window_bounds():
    day = dt.date(2024, 3, 1)
    assert window_bounds(day, 1) == (day, day)
    assert window_bounds(day, 2) == (dt.date(2024, 2, 29), day)
    assert window_bounds(day, 365)[0] == dt.date(2023, 3, 3)
    for days in (0, 366):
        with pytest.raises(ValueError):
            window_bounds(day, days)


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("days", [1, 7, 30])
def test_window_against_brute_force(spark, kind, days):
    rng = random.Random(days)
    base = dt.datetime(2024, 3, 5)
    times = [base + dt.timedelta(minutes=rng.randrange(-60 * 24 * 45, 60 * 24 * 5)) for _ in range(400)]
    times += [base, base - dt.timedelta(days=days), base + dt.timedelta(hours=23, minutes=59)]
    df = spark.createDataFrame([(str(t),) for t in times], "s string")
    df = df.select(F.col("s").cast(kind).alias("The.Time"))
    as_of = dt.date(2024, 3, 5)
    expected = Counter(t.date() for t in times if as_of - dt.timedelta(days=days) < t.date() <= as_of)
    found = day_counts(rolling_window(df, "The.Time", days, as_of), "The.Time")
    assert {r.day: r.records for r in found.collect()} == expected

    newest = max(t.date() for t in times)
    expected = Counter(t.date() for t in times if newest - dt.timedelta(days=days) < t.date())
    found = day_counts(rolling_window(df, "The.Time", days), "The.Time")
    assert {r.day: r.records for r in found.collect()} == expected
    assert spark.range(1).select(newest_day(df, "The.Time")).first()[0] == newest


@pytest.mark.parametrize("as_of", [dt.date(2024, 3, 5), None])
def test_window_over_text(spark, as_of):
    texts = ["2024-03-05", "2024-03-05 23:59:59", "2024-03-04T00:00:00", "2024-03-03 23:59:59.999", "2024-03-03",
             "n/a", "", None, "2024-03-0x", "-", "2024-3-5", " 2024-03-05", "2024-03-05x"]
    df = spark.createDataFrame([(t,) for t in texts], "`t.t` string")
    found = {r[0] for r in rolling_window(df, "t.t", 2, as_of).collect()}
    assert found == set(texts[:3])
    assert spark.range(1).select(newest_day(df, "t.t")).first()[0] == dt.date(2024, 3, 5)


def test_window_needs_a_time(spark):
    with pytest.raises(ValueError, match="not a date"):
        rolling_window(spark.range(3), "id", 3)
    with pytest.raises(ValueError, match="no time column"):
        rolling_window(spark.range(3), "ts", 3)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "ts timestamp_ntz")
    assert rolling_window(empty, "ts", 5).count() == 0


def test_window_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = physical(day_counts(rolling_window(events, "ts", 24, dt.date(2024, 1, 30)), "ts"))
    assert "GreaterThanOrEqual(ts,2024-01-07T00:00)" in plan and "LessThan(ts,2024-01-31T00:00)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in physical(rolling_window(events, "ts", 24))


def test_window_prunes_day_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(60).select("id", F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("day"))
    days.write.partitionBy("day").parquet(path)
    df = between_days(spark.read.parquet(path), "day", dt.date(2024, 1, 30), dt.date(2024, 2, 1))
    assert sorted(r.id for r in df.collect()) == [29, 30, 31]
    scan = next(line for line in physical(df).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(day" in scan and "PushedFilters: []" in scan
