"""Digests of days, runs that load changed days only, new files, days of a zone, lanes, quantile ranges."""

import datetime as dt
import itertools
import random
import shutil
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import dayferry
from dayferry.operators import digest
from dayferry.operators.window import between_days, day_of, in_days, today, zone_midnight
from dayferry.plans.sync import with_day
from dayferry.plans.tasks import place_in_lanes
from dayferry.registry import TableSpec, mapping
from dayferry.sources.jdbc import JdbcSource, JdbcTarget, day_predicates, quantile_bounds, range_clauses
from dayferry.sources.preflight import preflight

AS_OF = dt.date(2024, 1, 30)
SPEC = TableSpec("t", "t", mapping(["ts", "k", "v"], ["time", "k", "v"], [None, "bigint", "decimal(18,2)"]), "ts", 10)


def plan(df):
    return df._jdf.queryExecution().toString()


# --- digests ------------------------------------------------------------------------------------


def digests_of(spark, rows, columns="d date, a string, b string, x double"):
    df = spark.createDataFrame(rows, columns)
    return digest.day_digests(df, F.col("d"), ["a", "b", "x"])


D = dt.date(2024, 1, 5)
ROWS = [(D, "p", "q", 1.0), (D, "p", "q", 1.0), (D, None, "q", 2.0), (D, "r", None, None), (dt.date(2024, 1, 6), "p", "q", 1.0), (None, "a", "b", 0.5)]


def test_digest_is_free_of_order_and_adds_up(spark):
    whole = sorted(map(str, digests_of(spark, ROWS).collect()))
    shuffled = random.Random(1).sample(ROWS, len(ROWS))
    assert sorted(map(str, digests_of(spark, shuffled).repartition(3).collect())) == whole
    parts = digests_of(spark, ROWS[:2]).unionByName(digests_of(spark, ROWS[2:]))
    assert sorted(map(str, digest.merge_digests(parts).collect())) == whole


@pytest.mark.parametrize("at, other", [
    (0, (D, "p", "q", 1.5)), (0, (D, "q", "p", 1.0)), (2, (D, "q", None, 2.0)), (2, (D, "", "q", 2.0)),
    (3, (D, None, "r", None)), (3, (D, "r", None, 0.0)), (0, None), (5, (None, "a", "b", 0.25)),
])
def test_digest_sees_every_change(spark, at, other):
    rows = [other if i == at else r for i, r in enumerate(ROWS) if i != at or other is not None]
    found = digest.changed_days(digests_of(spark, ROWS), digests_of(spark, rows)).collect()
    assert [(r.day, r.change) for r in found] == [(ROWS[at][0], "changed")]
    assert found[0].records_before - found[0].records_after == (1 if other is None else 0)


def test_kinds_of_change_and_further_keys(spark):
    def side(*rows):
        rows = [(*r[:3], Decimal(r[3]), r[4]) for r in rows]
        return spark.createDataFrame(rows, "t string, day date, records bigint, hash_sum decimal(38,0), hash_xor bigint")

    d = [dt.date(2024, 1, i) for i in range(1, 6)]
    was = side(("a", d[0], 1, 5, 5), ("a", d[1], 2, 5, 5), ("a", d[2], 1, 1, 1), ("b", d[0], 1, 7, 7), ("a", d[4], 0, 0, 0))
    now = side(("a", d[0], 1, 5, 5), ("a", d[1], 2, 6, 5), ("a", d[3], 4, 1, 1), ("b", d[0], 1, 7, 8), ("b", d[4], 0, 0, 0))
    found = {(r.t, r.day.day): (r.records_before, r.records_after, r.change) for r in digest.changed_days(was, now, "t").collect()}
    assert found == {("a", 2): (2, 2, "changed"), ("a", 3): (1, 0, "removed"), ("a", 4): (0, 4, "added"), ("b", 1): (1, 1, "changed")}


@pytest.mark.parametrize("share", [0.1, 0.5, 0.8, 1.0])
def test_covering_window_matches_brute_force(spark, share):
    ages = {0: 3, 1: 10, 4: 1, 9: 5, 40: 1, -2: 100}  # changes ahead of the day lie in no window
    df = spark.createDataFrame(list(ages.items()), "days_back bigint, days bigint")
    total = sum(n for a, n in ages.items() if a >= 0)
    best = min(w for w in range(1, 60) if sum(n for a, n in ages.items() if 0 <= a < w) >= share * total)
    assert tuple(digest.covering_window(df, share).first()) == (best, total)
    assert digest.covering_window(df.limit(0), share).first().window_days is None
    with pytest.raises(ValueError):
        digest.covering_window(df, 0)


# --- loads of changed days ------------------------------------------------------------------------


@pytest.fixture
def changing(spark, tmp_path):
    state = {"rows": [(dt.datetime(2024, 1, d, h), str(d * 10 + h), "1.25") for d in range(20, 31) for h in range(3)], "reads": 0}

    def read(spark, spec, first, last):
        return between_days(spark.createDataFrame(state["rows"], "ts timestamp_ntz, k string, v string"), "ts", first, last)

    target, store = dayferry.ParquetTarget(str(tmp_path / "d")), dayferry.RunStore(str(tmp_path / "s"))

    def run(spec=SPEC, **more):
        results = dayferry.sync(spark, [spec], read, target, store, AS_OF, changed_only=True, **more).collect()
        held = target.table(spark, spec).groupBy("day").count()
        return {r.day.day for r in results if r.loaded}, {r.status for r in results}, {r["day"].day: r["count"] for r in held.collect()}

    return state, run, target, store


def test_only_changed_days_are_loaded(changing):
    state, run, target, _ = changing
    all_days = set(range(21, 31))
    assert run() == (all_days, {"success"}, dict.fromkeys(all_days, 3))
    files = {p for p in (target.base,) for p in _files(p)}
    assert run() == (set(), {"success"}, dict.fromkeys(all_days, 3))
    assert _files(target.base) == files  # nothing was written anew
    rows = state["rows"]
    rows.append((dt.datetime(2024, 1, 22, 9), "7", "1.25"))  # late
    rows.remove((dt.datetime(2024, 1, 25, 1), "251", "1.25"))  # gone
    rows[rows.index((dt.datetime(2024, 1, 27, 0), "270", "1.25"))] = (dt.datetime(2024, 1, 27, 0), "270", "1.50")
    state["rows"] = [r for r in rows if r[0].day != 29]  # a whole day
    held = dict.fromkeys(all_days - {29}, 3) | {22: 4, 25: 2}
    assert run() == ({22, 25, 27, 29}, {"success"}, held)
    assert run() == (set(), {"success"}, held)


def _files(folder):
    import os

    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet") and "day=" in d}


def test_days_that_the_target_lost_are_loaded_again(changing):
    _, run, target, _ = changing
    run()
    shutil.rmtree(f"{target.base}/t/day=2024-01-24")
    loaded, status, held = run()
    assert (loaded, status, held[24]) == ({24}, {"success"}, 3)


def test_a_faulty_load_is_done_again(changing):
    state, run, *_ = changing
    run()
    state["rows"].append((dt.datetime(2024, 1, 23, 5), "n/a", "1"))
    assert run()[:2] == ({23}, {"failed"})
    assert run()[:2] == ({23}, {"failed"})  # not forgotten
    assert run(lost_values_allowed=1)[:2] == ({23}, {"success"})
    assert run()[:2] == (set(), {"success"})


def test_another_mapping_loads_all_days(changing, spark):
    _, run, target, _ = changing
    run()
    wider = TableSpec("t", "t", mapping(["ts", "k", "v"], ["time", "k", "v"], [None, "bigint", "decimal(18,1)"]), "ts", 10)
    assert run(wider, lost_values_allowed=1000)[0] == set(range(21, 31))
    renamed = TableSpec("t", "t", mapping(["ts", "v", "k"], ["time", "k", "v"]), "ts", 10)
    assert run(renamed)[0] == set(range(21, 31))


def test_jdbc_target_swaps_the_named_days(spark, monkeypatch):
    swapped = []
    target = JdbcTarget("jdbc:none", {}, lambda statements: swapped.append(statements[0]))
    monkeypatch.setattr(target, "_load", lambda rows, table: rows.collect())
    monkeypatch.setattr(target, "_query", lambda spark, sql: spark.createDataFrame([(2,)], "n bigint"))
    rows = spark.createDataFrame([(dt.datetime(2024, 1, d), "1", "1") for d in (5, 7)], "ts timestamp_ntz, k string, v string")
    days = [dt.date(2024, 1, 5), dt.date(2024, 1, 7)]
    assert target.replace_days(with_day(rows, SPEC), SPEC, dt.date(2024, 1, 1), dt.date(2024, 1, 9), days) == 2
    assert len(swapped) == 2 and "2024-01-05" in swapped[0] and "2024-01-07" in swapped[1]


# --- new files --------------------------------------------------------------------------------------


def test_only_new_files_are_opened(spark, tmp_path):
    path = str(tmp_path / "in")
    spec = TableSpec("t", "t", mapping(["Time", "n"], ["time", "n"]), "Time")
    source, store = dayferry.ParquetSource({"t": path}), dayferry.RunStore(str(tmp_path / "s")).create(spark)

    def put(*times, day):
        df = spark.createDataFrame([(t, i) for i, t in enumerate(times)], "Time string, n int").withColumn("p", F.lit(day))
        df.repartition(2).write.mode("append").partitionBy("p").parquet(path)

    def look(run):
        found = source.undated_in_new_files(spark, spec, store.files(spark, "t.Time"))
        opened = 0 if found is None else found.count()
        if found is not None:
            store.update_files(found, "t.Time", run)
        known = source.present_files(spark, spec).join(store.files(spark, "t.Time"), ["file", "bytes", "modified"])
        return opened, known.agg(F.sum("undated")).first()[0]

    put("2024-01-01", None, "soon", day="a")
    first = set(source.present_files(spark, spec).toPandas()["path"])
    assert look(1) == (len(first), 2)
    assert look(2) == (0, 2)
    put("2024-1-1", "2024-01-02 10:00:00", "2024-01-03", day="b c")
    seen = source.undated_in_new_files(spark, spec, store.files(spark, "t.Time"))
    assert not any(f.split("/")[-1] in plan(seen) for f in first)
    assert look(3)[1] == 3
    shutil.rmtree(f"{path}/p=a")
    assert look(4) == (0, 1)
    # A file that was replaced is another one.
    spark.createDataFrame([(None, 1)] * 4, "Time string, n int").coalesce(1).write.mode("overwrite").parquet(f"{path}/p=b c")
    assert look(5) == (1, 4)


def test_sync_counts_undated_rows_of_new_files(spark, tmp_path):
    path, spec = str(tmp_path / "in"), TableSpec("t", "t", mapping(["Time", "n"], ["time", "n"]), "Time", 5)
    args = (dayferry.ParquetSource({"t": path}), dayferry.ParquetTarget(str(tmp_path / "d")), dayferry.RunStore(str(tmp_path / "s")), AS_OF)
    errors = []
    for rows in ([("2024-01-30", 1)], [(None, 2), ("2024-01-29", 3)], [("2024-01-28", 4)]):
        spark.createDataFrame(rows, "Time string, n int").write.mode("append").parquet(path)
        errors += {r.error for r in dayferry.sync(spark, [spec], *args).collect()}
    assert errors == [None, "1 rows of t have no readable Time", "1 rows of t have no readable Time"]


# --- days of a zone -----------------------------------------------------------------------------------


@pytest.mark.parametrize("zone", ["Asia/Shanghai", "America/New_York", "UTC"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_days_of_a_zone(spark, zone, kind):
    hours = [dt.datetime(2024, 3, 8) + dt.timedelta(minutes=30 * i) for i in range(24 * 2 * 6)]  # clocks change on the 10th
    df = spark.createDataFrame([(h.isoformat(" "),) for h in hours], "t string").select(F.col("t").cast("timestamp_ntz").cast(kind).alias("t"))
    first, last = dt.date(2024, 3, 9), dt.date(2024, 3, 11)
    from zoneinfo import ZoneInfo

    local = [h.replace(tzinfo=dt.UTC).astimezone(ZoneInfo(zone)).date() for h in hours]
    inside = between_days(df, "t", first, last, zone)
    assert inside.count() == sum(first <= d <= last for d in local)
    days = {r.d: r.n for r in inside.groupBy(day_of(inside, "t", zone).alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert days == {d: local.count(d) for d in (first, dt.date(2024, 3, 10), last)}


def test_bounds_of_a_zone_push_down(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(between_days(events, "ts", dt.date(2024, 1, 10), dt.date(2024, 1, 12), "Asia/Shanghai"))
    assert "GreaterThanOrEqual(ts,2024-01-09T16:00)" in text and "LessThan(ts,2024-01-12T16:00)" in text
    text = plan(in_days(events, "ts", [dt.date(2024, 1, d) for d in (3, 4, 9)]))
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(ts,2024-01-03T00:00),LessThan(ts,2024-01-05T00:00)),And(" in text


def test_a_zone_needs_times_in_utc(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "2024-01-01")], "d date, s string")
    for c in "ds":
        with pytest.raises(ValueError, match="zone"):
            between_days(df, c, AS_OF, AS_OF, "Asia/Shanghai")
    with pytest.raises(ValueError):
        day_predicates("d", AS_OF, AS_OF, "date", zone="Asia/Shanghai")
    assert today("Asia/Shanghai", dt.datetime(2024, 1, 30, 17, tzinfo=dt.UTC)) == dt.date(2024, 1, 31)
    assert zone_midnight(AS_OF, "Asia/Shanghai") == dt.datetime(2024, 1, 29, 16)


def test_sync_by_a_zones_days(spark, sf_dir, tmp_path):
    spec = TableSpec("events", "e", mapping(["ts", "event_id"], ["time", "id"]), "ts", 4, zone="Asia/Shanghai")
    source, target = dayferry.ParquetSource({"events": f"{sf_dir}/events.parquet"}), dayferry.ParquetTarget(str(tmp_path / "d"))
    results = dayferry.sync(spark, [spec], source, target, dayferry.RunStore(str(tmp_path / "s")), dt.date(2024, 1, 20))
    local = F.to_date(F.col("ts") + F.expr("interval 8 hours"))
    expected = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(local.alias("d")).count().collect()
    expected = {r.d: r["count"] for r in expected if dt.date(2024, 1, 17) <= r.d <= dt.date(2024, 1, 20)}
    assert {r.day: r.records for r in results.collect()} == expected and {r.status for r in results.collect()} == {"success"}


def test_jdbc_clauses_of_a_zone(spark, sf_dir):
    clauses = day_predicates("ts", dt.date(2024, 1, 9), dt.date(2024, 1, 11), zone="Asia/Shanghai")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    local = F.to_date(F.col("ts") + F.expr("interval 8 hours"))
    for i, c in enumerate(clauses):
        assert events.where(c).count() == events.where(local == F.lit(dt.date(2024, 1, 9 + i))).count() > 0


# --- lanes ----------------------------------------------------------------------------------------------


@given(st.lists(st.integers(0, 50), min_size=1, max_size=7), st.integers(1, 3))
@settings(deadline=None, max_examples=60)
def test_lanes_end_within_four_thirds_of_the_best(weights, lanes):
    named = {f"t{i}": w for i, w in enumerate(weights)}
    rows = place_in_lanes(named, lanes)
    totals = {}
    for r in rows:
        totals[r["lane"]] = totals.get(r["lane"], 0) + r["weight"]
    assert {r["target_table"] for r in rows} == set(named) and [r["place"] for r in rows] == list(range(1, len(rows) + 1))
    assert all(r["lane_total"] == totals[r["lane"]] for r in rows) and [r["weight"] for r in rows] == sorted(weights, reverse=True)
    best = min(
        max(sum(w for w, p in zip(weights, places) if p == lane) for lane in range(lanes))
        for places in itertools.product(range(lanes), repeat=len(weights))
    )
    assert max(totals.values()) <= 4 / 3 * best + 1e-9


def test_heaviest_tables_of_the_last_run_start_first(spark, sf_dir, tmp_path):
    specs = [TableSpec("events", f"t{i}", mapping(["ts", "event_id"], ["time", "id"]), "ts", days) for i, days in enumerate((2, 9, 5))]
    source, store, started = dayferry.ParquetSource({"events": f"{sf_dir}/events.parquet"}), dayferry.RunStore(str(tmp_path / "s")), []

    class Noting(dayferry.ParquetTarget):
        def replace_days(self, rows, spec, *args):
            started.append(spec.target_table)
            return super().replace_days(rows, spec, *args)

    args = (spark, specs, source, Noting(str(tmp_path / "d")), store, AS_OF)
    dayferry.sync(*args, concurrent_tables=1)
    dayferry.sync(*args, concurrent_tables=1)
    assert started == ["t0", "t1", "t2", "t1", "t2", "t0"]
    with pytest.raises(ValueError):
        place_in_lanes({"a": 1}, 0)


# --- quantile ranges ----------------------------------------------------------------------------------------


def test_ranges_between_quantiles_cut_a_hot_day(spark):
    keys = spark.range(20_000).select(
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 3 == 0, 77).otherwise((F.col("id") * F.col("id")) % 100_003 - 500).alias("k"),
        F.lit(dt.date(2024, 1, 20)).cast("timestamp_ntz").alias("ts"),
    )
    bounds = {dt.date(2024, 1, 20): quantile_bounds(keys, "k", 16)}
    clauses = day_predicates("ts", dt.date(2024, 1, 19), dt.date(2024, 1, 21), "date", {dt.date(2024, 1, 20): 16}, "k", bounds=bounds)
    hits = [F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in clauses]
    counts = keys.agg(*[F.sum(h).alias(str(i)) for i, h in enumerate(hits)]).first()
    assert keys.where(sum(hits[1:], hits[0]) != 1).count() == 0
    # A third of the rows has one value, which no range can split; the rest is even.
    rest = sorted(n for n in counts if n)[:-1]
    assert max(rest) <= 2 * 20_000 / 16 and "MOD" not in " ".join(clauses)


@pytest.mark.parametrize("value", [5, -2.5, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 6)])
def test_ranges_of_any_key(spark, value):
    df = spark.createDataFrame([(value,), (value,), (None,)], "k " + {int: "bigint", float: "double", dt.date: "date", dt.datetime: "timestamp_ntz"}[type(value)])
    clauses = range_clauses("k", quantile_bounds(df, "k", 4))
    assert sorted(df.where(c).count() for c in clauses) == [1, 2]
    assert range_clauses("k", []) == ["1 = 1"] and quantile_bounds(df.limit(0), "k", 4) == []


def test_jdbc_source_reads_hot_days_by_quantiles(spark, monkeypatch):
    source = JdbcSource("jdbc:none", {}, rows_per_partition=100, split_on="k", quantiles=True)
    day, asked = dt.date(2024, 1, 20), []
    monkeypatch.setattr(source, "_table", lambda spark, name: spark.createDataFrame([], "ts timestamp_ntz, k bigint"))
    monkeypatch.setattr(source, "_day_counts", lambda spark, *a: spark.createDataFrame([(day, 1000, 5)], "d date, n bigint, t bigint"))

    def query(spark, sql):
        asked.append(sql)
        return spark.range(1000).select(F.col("id").alias("k"))

    monkeypatch.setattr(source, "_query", query)
    clauses = source.predicates(spark, TableSpec("s", "t", mapping(["ts", "k"], ["time", "k"]), "ts"), day, day)
    assert len(clauses) == 10 and len(asked) == 1 and asked[0].startswith("SELECT `k` AS k FROM s WHERE")
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("2024-01-20 05:00:00").cast("timestamp_ntz").alias("ts"))
    counts = [rows.where(c).count() for c in clauses]
    assert sum(counts) == 1000 and max(counts) <= 200
    with pytest.raises(ValueError):
        JdbcSource("jdbc:none", {}, quantiles=True)


# --- preflight ------------------------------------------------------------------------------------------------


def test_preflight_of_a_window_reads_no_history(spark, sf_dir):
    spec = TableSpec("events", "e", mapping(["ts", "event_id"], ["time", "id"]), "ts")
    source = dayferry.ParquetSource({"events": f"{sf_dir}/events.parquet"})
    first, last = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
    probe = source.probe(spec, first, last)
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in plan(probe.open(spark))
    found = preflight(spark, [probe]).first()
    assert found.success and (found.first_day, found.last_day) == (first, last)
    assert found.records == between_days(source.table(spark, "events"), "ts", first, last).count()
