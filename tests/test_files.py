import datetime as dt
import glob
from collections import Counter

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from dayferry.operators.window import between_days, window_bounds
from dayferry.plans.sync import with_day
from dayferry.registry import TableSpec, mapping
from dayferry.sources.files import ParquetSource, ParquetTarget

SPEC = TableSpec("src", "dst", mapping(["The.Time", "id"], ["time", "id"]), "The.Time")
LAST = dt.date(2024, 1, 10)


def rows(spark, per_day, parts=4):
    """A source with the given number of rows for each day of January."""
    days = [(d, n) for d, n in per_day.items()]
    df = spark.createDataFrame(days, "d int, n int").repartition(parts)
    df = df.select("d", F.explode(F.sequence(F.lit(1), "n")).alias("id"))
    start = F.make_date(F.lit(2024), F.lit(1), F.col("d")).cast("timestamp_ntz")
    return df.select((start + F.expr("make_dt_interval(0, 12, 0, 0)")).alias("The.Time"), "id")


def load(target, source, days):
    first, last = window_bounds(LAST, days)
    window = between_days(source, "The.Time", first, last)
    return target.replace_days(with_day(window, SPEC), SPEC, first, last)


def held(spark, target, days=31):
    counts = target.day_counts(spark, SPEC, *window_bounds(LAST, days))
    return {r.day.day: r.records for r in counts.collect()}


def test_reload_replaces_whole_days(spark, tmp_path):
    target = ParquetTarget(str(tmp_path))
    assert load(target, rows(spark, {d: d for d in range(1, 11)}), 10) == 55
    once = held(spark, target)
    assert once == {d: d for d in range(1, 11)}
    load(target, rows(spark, {d: d for d in range(1, 11)}), 10)
    assert held(spark, target) == once
    # Late rows arrive for day 9; days before the window keep what they had.
    load(target, rows(spark, {8: 1, 9: 20, 10: 10}), 2)
    assert held(spark, target) == once | {9: 20}
    assert target.table(spark, SPEC).columns == ["time", "id", "day"]
    assert dict(target.table(spark, SPEC).dtypes)["day"] == "date"


def test_load_without_a_shuffle(spark, tmp_path):
    target = ParquetTarget(str(tmp_path), gather=False)
    for _ in range(2):
        assert load(target, rows(spark, {d: d for d in range(1, 11)}), 10) == 55
    assert held(spark, target) == {d: d for d in range(1, 11)}


def test_days_that_became_empty_are_cleared(spark, tmp_path):
    target = ParquetTarget(str(tmp_path))
    load(target, rows(spark, {d: 3 for d in range(1, 11)}), 10)
    assert load(target, rows(spark, {7: 5, 10: 1}), 4) == 6
    assert held(spark, target) == {d: 3 for d in range(1, 7)} | {7: 5, 10: 1}
    # A source that has lost the whole window.
    assert load(target, rows(spark, {1: 1}), 4) == 0
    assert held(spark, target) == {d: 3 for d in range(1, 7)}
    load(target, rows(spark, {10: 2}), 4)
    assert held(spark, target) == {d: 3 for d in range(1, 7)} | {10: 2}


def test_first_load_of_an_empty_window(spark, tmp_path):
    target = ParquetTarget(str(tmp_path))
    assert load(target, rows(spark, {1: 1}), 3) == 0
    assert load(target, rows(spark, {1: 1}).where("false"), 3) == 0
    assert held(spark, target) == {}


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_day_is_written_by_many_tasks(spark, tmp_path, adaptive):
    settings = {
        "spark.sql.adaptive.enabled": adaptive,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        target = ParquetTarget(str(tmp_path))
        hot = spark.range(300_000, numPartitions=12).select(
            F.expr("timestamp_ntz'2024-01-10 00:00:00'").alias("The.Time"), F.col("id")
        )
        cold = rows(spark, {d: 500 for d in range(1, 10)})
        assert load(target, hot.unionByName(cold), 10) == 300_000 + 9 * 500
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert held(spark, target) == {d: 500 for d in range(1, 10)} | {10: 300_000}
    files = Counter(p.split("/day=")[1][:10] for p in glob.glob(f"{tmp_path}/dst/day=*/*.parquet"))
    assert files["2024-01-10"] > 4
    assert max(n for d, n in files.items() if d != "2024-01-10") <= 2


@pytest.mark.parametrize("gather", [True, False])
def test_counts_are_exact_when_tasks_are_repeated(spark, tmp_path, gather):
    def fail_once(batches):
        for batch in batches:
            yield batch
        context = TaskContext.get()
        if context.attemptNumber() == 0 and context.partitionId() % 2:
            raise OSError("lost")

    # Each row has been handed on when its task fails.
    source = rows(spark, {d: 100 * d for d in range(1, 11)}, parts=10).toDF("t", "id")
    flaky = source.mapInPandas(fail_once, source.schema).toDF("The.Time", "id")
    target = ParquetTarget(str(tmp_path), gather=gather)
    assert load(target, flaky, 10) == 5500
    assert held(spark, target) == {d: 100 * d for d in range(1, 11)}


def test_source_reads_the_window(spark, tmp_path):
    path = str(tmp_path / "src")
    rows(spark, {d: d for d in range(1, 21)}).write.parquet(path)
    read = ParquetSource({"src": path})
    assert read(spark, SPEC, *window_bounds(LAST, 2)).count() == 19


def test_source_with_day_partitions(spark, tmp_path):
    path = str(tmp_path / "src")
    source = rows(spark, {d: d for d in range(1, 21)})
    source.withColumn("dt", F.to_date("`The.Time`")).write.partitionBy("dt").parquet(path)
    schema = "`The.Time` timestamp_ntz, id int, dt date"
    read = ParquetSource({"src": path}, {"src": schema}, {"src": "dt"})
    window = read(spark, SPEC, *window_bounds(LAST, 2))
    assert window.count() == 19
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "GreaterThanOrEqual(The.Time" in plan.replace("`", "")
    target = ParquetTarget(str(tmp_path / "out"), gather=False)
    assert load(target, window, 2) == 19
