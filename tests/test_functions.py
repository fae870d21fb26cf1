import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from dayferry import functions as X
from dayferry.frames import small_frame
from dayferry.operators.ledger import history_limit
from pyspark.sql import types as T


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "seconds, text",
    [(None, "-"), (0.0, "-"), (float("nan"), "-"), (0.5, "0秒"), (5.9, "5秒"), (65.0, "1分 5秒"),
     (3600.0, "1时 0分 0秒"), (3725.2, "1时 2分 5秒"), (86400.0, "24时 0分 0秒"), (-5.0, "-5秒")],
)
def test_duration_text(spark, seconds, text):
    assert one(spark, X.duration_text(F.lit(seconds).cast("double"))) == text


@pytest.mark.parametrize(
    "start, end, seconds",
    [("2024-01-01 00:00:00.5", "2024-03-01 10:11:12.123456", 5220671.623456),
     ("2024-01-02 00:00:00", "2024-01-01 23:59:59.25", -0.75),
     ("2024-01-02 00:00:00", None, 0.0), ("2024-01-02", "2024-01-02", 0.0)],
)
def test_seconds_between(spark, start, end, seconds):
    assert one(spark, X.seconds_between(ntz(start), ntz(end))) == seconds


def test_elapsed_text(spark):
    start = ntz("2024-01-01 08:00:00.9")
    assert one(spark, X.elapsed_text(start, ntz("2024-01-01 08:00:05.8"))) == "0时 0分 4秒"
    assert one(spark, X.elapsed_text(start, ntz("2024-01-02 09:01:01"))) == "25时 1分 0秒"
    assert one(spark, X.elapsed_text(start, start)) == "0时 0分 0秒"


@pytest.mark.parametrize(
    "text, valid",
    [("09:00", True), ("9:5", True), ("23:59", True), ("0:0", True), ("24:00", False), ("09:60", False),
     ("0900", False), ("23:59 ", False), (" 9:00", False), ("9:00\n", False), ("009:00", False),
     ("9:000", False), ("", False), (":", False), (None, None)],
)
def test_valid_time_of_day(spark, text, valid):
    assert one(spark, X.valid_time_of_day(F.lit(text).cast("string"))) is valid


def test_valid_time_of_day_agrees_with_strptime(spark):
    texts = [f"{h}{sep}{m}" for h in [*range(0, 30, 3), "00", "09", "1 "] for m in [*range(0, 70, 7), "05"]
             for sep in (":", "", " :")]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", X.valid_time_of_day(F.col("t")).alias("v")
    )
    for t, v in rows.collect():
        try:
            dt.datetime.strptime(t, "%H:%M")
            expected = True
        except ValueError:
            expected = False
        assert v is expected, t


def test_beijing_time(spark):
    local = X.in_time_zone(ntz("2024-01-30 23:57:12"))
    assert one(spark, local) == dt.datetime(2024, 1, 31, 7, 57, 12)
    assert one(spark, X.local_text(local)) == "2024/1/31 07:57:12"
    assert one(spark, X.local_text(ntz(None))) is None


def test_session_time_zone_does_not_matter(spark):
    # 02:30 does not exist on this day in New York.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = ntz("2024-03-10 02:30:00")
        assert one(spark, X.local_text(gap)) == "2024/3/10 02:30:00"
        assert one(spark, X.seconds_between(ntz("2024-03-10 01:30:00"), ntz("2024-03-10 03:30:00"))) == 7200
        assert json.loads(one(spark, X.row_json(gap.alias("t"))))["t"] == "2024-03-10 02:30:00.000000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "status, label, run_class, table_class",
    [("success", "成功", "status-success", "status-success"),
     ("failed", "失败", "status-failed", "status-failed"),
     ("stopped", "已停止", "status-stopped", "status-idle"),
     ("running", "运行中", "status-running", "status-idle"),
     ("syncing", "同步中", "status-idle", "status-running"),
     ("idle", "空闲", "status-idle", "status-idle"),
     ("odd", "odd", "status-idle", "status-idle"),
     (None, None, "status-idle", "status-idle")],
)
def test_status(spark, status, label, run_class, table_class):
    s = F.lit(status).cast("string")
    assert one(spark, X.status_label(s)) == label
    assert one(spark, X.run_status_class(s)) == run_class
    assert one(spark, X.table_status_class(s)) == table_class


def test_display_defaults(spark):
    text = lambda x: one(spark, X.text_or_dash(F.lit(x).cast("string")))
    assert [text(None), text(""), text("x"), text(" ")] == ["-", "-", "x", " "]
    number = lambda x: one(spark, X.count_or_zero(F.lit(x).cast("bigint")))
    assert [number(None), number(0), number(12345), number(-1234567)] == ["0", "0", "12,345", "-1,234,567"]


def test_names_label(spark):
    schema = T.StructType([T.StructField("a", T.ArrayType(T.StringType()))])
    rows = [{"a": None}, {"a": []}, {"a": ["a", "b"]}, {"a": ["a"]}]
    labels = small_frame(spark, rows, schema).select(X.names_label(F.col("a")).alias("x")).collect()
    assert [r.x for r in labels] == ["all", "all", "a,b", "a"]


@pytest.mark.parametrize(
    "status, total, error, raised, message",
    [("success", 7, None, False, "Migration completed successfully. Migrated 7 records."),
     ("success", None, None, False, "Migration completed successfully. Migrated 0 records."),
     ("failed", 7, "boom", False, "Migration failed: boom"),
     ("failed", 7, None, False, "Migration failed: None"),
     ("failed", 7, "boom", True, "Migration error: boom"),
     ("stopped", 7, "x", False, "Migration stopped"),
     ("running", 0, None, False, "Migration started"),
     ("odd", 0, None, False, None)],
)
def test_result_message(spark, status, total, error, raised, message):
    got = X.result_message(
        F.lit(status), F.lit(total).cast("bigint"), F.lit(error).cast("string"), F.lit(raised)
    )
    assert one(spark, got) == message


def test_row_json_keeps_nulls(spark):
    row = X.row_json(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))
    assert one(spark, row) == '{"a":1,"b":null}'


@pytest.mark.parametrize("limit, n", [(None, 50), ("ten", 50), ("1.5", 50), ("10", 10), (0, 0), (-1, -1), (float("inf"), 50), (2**31, -1)])
def test_history_limit(limit, n):
    assert history_limit(limit) == n
