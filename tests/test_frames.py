import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import types as T

from dayferry.frames import shared_dir, small_frame


def session(folder=None):
    settings = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "hdfs://fs/warehouse"}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings[key] or default))


def test_shared_dir_is_new_each_time_and_where_the_cluster_says():
    spark = session("hdfs://fs/checkpoints/")
    one, two = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one != two and one.startswith("hdfs://fs/checkpoints/x-")


def test_shared_dir_is_beside_the_warehouse_if_none_is_named():
    assert shared_dir(session(), "x").startswith("hdfs://fs/warehouse/_shared/x-")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_small_frame_keeps_values(spark, zone):
    schema = T.StructType.fromDDL("t timestamp_ntz, d date, a array<string>, n bigint, x double, b boolean")
    row = (dt.datetime(2024, 3, 10, 2, 30, 0, 5), dt.date(2024, 3, 10), ["a", "b"], 7, 0.5, True)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = small_frame(spark, [dict(zip(schema.names, row)), {}], schema)
        assert df.schema == schema
        assert [tuple(r) for r in df.collect()] == [row, (None,) * 6]
        assert small_frame(spark, [], schema).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
