"""Claims, the lease on a store, and logs that are folded while others read and write."""

import datetime as dt
import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

import dayferry
from dayferry.frames import fields, scratch, shared_dir, small_frame, written
from dayferry.operators.ledger import latest_run_state, run_record
from dayferry.registry import TableSpec, mapping
from dayferry.sources.hadoop import Files
from dayferry.sources.lease import Busy, held
from dayferry.sources.log import AppendLog
from dayferry.sources.store import RunStore

AS_OF = dt.date(2024, 1, 30)
EVENTS = TableSpec("events", "ods_query", mapping(["ts", "event_id"], ["time", "id"]), "ts", 24)


def source(sf_dir):
    return dayferry.ParquetSource({"events": f"{sf_dir}/events.parquet"})


# --- claims and leases ------------------------------------------------------------------------


def test_a_file_is_created_once(spark, tmp_path):
    files = Files(spark, str(tmp_path))
    with ThreadPoolExecutor(16) as pool:
        made = list(pool.map(lambda i: files.create(f"{tmp_path}/one", str(i)), range(64)))
    assert sum(made) == 1 and files.read(f"{tmp_path}/one") == str(made.index(True))
    assert files.create("file:" + str(tmp_path / "deep" / "er"), "x") and not files.create(str(tmp_path / "deep" / "er"), "x")


def test_ids_are_claimed_once_each(spark, tmp_path):
    store = RunStore(str(tmp_path / "s")).create(spark)
    with ThreadPoolExecutor(8) as pool:
        ids = list(pool.map(lambda _: store.claim(spark), range(40)))
    assert sorted(ids) == list(range(1, 41))
    store.compact(spark)
    assert store.claim(spark) == 41


def test_ids_go_on_after_those_of_an_older_store(spark, tmp_path):
    store = RunStore(str(tmp_path / "s"))
    run_record(spark, 7, dt.datetime(2024, 1, 1), None, "running", None, 0).write.parquet(store.ledger_path)
    assert store.claim(spark) == 8 and store.ledger(spark).count() == 1


def test_lease_has_one_holder_and_is_given_back(spark, tmp_path):
    folder = str(tmp_path)
    with held(spark, folder, "lease", "first", 600) as lease:
        lease.check()
        with pytest.raises(Busy, match="first"), held(spark, folder, "lease", "second", 600):
            pass
        with held(spark, folder, "another", "second", 600):
            pass
    assert os.listdir(folder) == []
    with pytest.raises(KeyError), held(spark, folder, "lease", "third", 600):
        raise KeyError
    assert os.listdir(folder) == []


def test_lease_of_many_goes_to_one(spark, tmp_path):
    inside, most = [], []

    def take(i):
        try:
            with held(spark, str(tmp_path), "lease", str(i), 600):
                inside.append(i)
                most.append(len(inside))
                time.sleep(0.2)
                inside.remove(i)
                return 1
        except Busy:
            return 0

    with ThreadPoolExecutor(12) as pool:
        assert sum(pool.map(take, range(12))) >= 1
    assert max(most) == 1


def test_lease_left_behind_is_taken_over_by_one(spark, tmp_path):
    left = tmp_path / "lease"
    left.write_text("a driver that died")
    os.utime(left, (time.time() - 1000,) * 2)
    with pytest.raises(Busy), held(spark, str(tmp_path), "lease", "early", 2000):
        pass
    taken = []

    def take(i):
        try:
            with held(spark, str(tmp_path), "lease", str(i), 100):
                taken.append(i)
                time.sleep(0.5)
        except Busy:
            pass

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(take, range(8)))
    assert len(taken) == 1 and os.listdir(tmp_path) == []


def test_lease_is_kept_fresh_and_its_loss_noticed(spark, tmp_path):
    with held(spark, str(tmp_path), "lease", "one", 2) as lease:
        first = os.stat(tmp_path / "lease").st_mtime_ns
        time.sleep(1.5)
        assert os.stat(tmp_path / "lease").st_mtime_ns > first
        (tmp_path / ".lease.crc").unlink(missing_ok=True)
        (tmp_path / "lease").write_text("somebody else")
        with pytest.raises(Busy, match="taken over"):
            lease.check()
    assert (tmp_path / "lease").read_text() == "somebody else"  # not ours to delete


def test_second_sync_is_refused_and_leaves_no_trace(spark, sf_dir, tmp_path):
    started, go = threading.Event(), threading.Event()

    class Slow(dayferry.ParquetTarget):
        def replace_days(self, *args):
            started.set()
            assert go.wait(60)
            return super().replace_days(*args)

    args = (spark, [EVENTS], source(sf_dir))
    with ThreadPoolExecutor(1) as pool:
        first = pool.submit(dayferry.sync, *args, Slow(str(tmp_path / "d")), RunStore(str(tmp_path / "s")), AS_OF)
        assert started.wait(60)
        with pytest.raises(Busy):
            dayferry.sync(*args, dayferry.ParquetTarget(str(tmp_path / "d")), RunStore(str(tmp_path / "s")), AS_OF)
        go.set()
        assert {r.status for r in first.result().collect()} == {"success"}
    store = RunStore(str(tmp_path / "s"))
    assert [(r.id, r.status) for r in store.ledger(spark).orderBy("id").collect()] == [(1, "running"), (2, "success")]
    dayferry.sync(*args, dayferry.ParquetTarget(str(tmp_path / "d")), store, AS_OF)
    assert store.ledger(spark).count() == 4


def test_overlapping_syncs_keep_their_results_where_they_are_allowed(spark, sf_dir, tmp_path):
    stores = [RunStore(str(tmp_path / "s"), exclusive=False) for _ in range(2)]
    both = threading.Barrier(2)

    class Meeting(dayferry.ParquetTarget):
        def replace_days(self, *args):
            both.wait(60)
            return super().replace_days(*args)

    def run(i):
        return dayferry.sync(spark, [EVENTS], source(sf_dir), Meeting(str(tmp_path / f"d{i}")), stores[i], AS_OF, days=3 + i).collect()

    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(run, range(2)))
    assert [len(r) for r in results] == [3, 4]
    rows = stores[0].ledger(spark).collect()
    assert sorted(r.id for r in rows) == [1, 2, 3, 4] and sorted(r.status for r in rows) == ["running", "running", "success", "success"]
    kept = [spark.read.parquet(f"{stores[0].results_path}/run_id={r.id}").count() for r in rows if r.status == "running"]
    assert sorted(kept) == [3, 4]


def test_a_run_that_was_taken_over_does_not_write_the_status(spark, sf_dir, tmp_path):
    store = RunStore(str(tmp_path / "s"))

    class Robbed(dayferry.ParquetTarget):
        def replace_days(self, *args):
            Files(spark, store.base).write(f"{store.base}/_running", "the next run")
            return super().replace_days(*args)

    with pytest.raises(Busy):
        dayferry.sync(spark, [EVENTS], source(sf_dir), Robbed(str(tmp_path / "d")), store, AS_OF)
    assert store.status(spark).count() == 0
    assert latest_run_state(store.ledger(spark)).first().status == "failed"


# --- folding ----------------------------------------------------------------------------------


def log_of(tmp_path, fold=None):
    from pyspark.sql import types as T

    return AppendLog(str(tmp_path / "log"), fields(k=T.LongType(), v=T.StringType()), fold)


def rows_of(spark, log, *pairs):
    return small_frame(spark, [dict(zip("kv", p)) for p in pairs], log.schema)


def held_rows(df):
    return sorted(map(tuple, df.collect()))


def test_reads_before_during_and_after_a_compaction(spark, tmp_path, monkeypatch):
    log = log_of(tmp_path)
    log.create(spark)
    assert held_rows(log.read(spark)) == [] and log.compact(spark) == 0
    for i in range(5):
        log.append(rows_of(spark, log, (i, "a")))
    before = log.read(spark)
    # While it publishes, a reader opens the table and a writer appends.
    during, rename = [], Files.rename

    def meanwhile(self, path, to):
        if "_manifest-" in to:
            during.append(log.read(spark))
            monkeypatch.setattr(Files, "rename", rename)
            log.append(rows_of(spark, log, (5, "late")))
            during.append(log.read(spark))
        return rename(self, path, to)

    monkeypatch.setattr(Files, "rename", meanwhile)
    assert log.compact(spark) == 5
    five = [(i, "a") for i in range(5)]
    assert [held_rows(d) for d in (before, *during)] == [five, five, [*five, (5, "late")]]
    assert held_rows(log.read(spark)) == [*five, (5, "late")] and log.batches(spark) == 1
    after = log.read(spark)
    log.append(rows_of(spark, log, (6, "b")))
    assert log.compact(spark) == 2 and log.compact(spark) == 0
    assert held_rows(after) == [*five, (5, "late")]  # a frame opened before the second one
    assert held_rows(log.read(spark)) == [*five, (5, "late"), (6, "b")]
    for i in range(7, 10):
        log.append(rows_of(spark, log, (i, "c")))
        log.compact(spark)
    assert len(held_rows(log.read(spark))) == 10 and len(log.read(spark).inputFiles()) <= 2
    assert len(os.listdir(log.path)) < 10


def test_appends_do_not_meet(spark, tmp_path):
    log = log_of(tmp_path)
    log.create(spark)
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: log.append(rows_of(spark, log, (i, "x"))), range(16)))
    assert held_rows(log.read(spark)) == [(i, "x") for i in range(16)]


def test_unfinished_writes_are_not_read(spark, tmp_path):
    log = log_of(tmp_path)
    log.create(spark)
    log.append(rows_of(spark, log, (1, "whole")))
    rows_of(spark, log, (2, "half")).write.parquet(f"{log.path}/_adding-x/rows")
    rows_of(spark, log, (3, "half")).write.parquet(f"{log.path}/_folded-x/part")
    (tmp_path / "log" / "_writing-x").write_text("{")
    assert held_rows(log.read(spark)) == [(1, "whole")]
    assert log.compact(spark) == 1 and held_rows(log.read(spark)) == [(1, "whole")]


def test_flat_files_of_an_older_store_are_read_and_folded(spark, tmp_path):
    log = log_of(tmp_path)
    rows_of(spark, log, (1, "old")).write.parquet(log.path)
    log.append(rows_of(spark, log, (2, "new")))
    assert held_rows(log.read(spark)) == [(1, "old"), (2, "new")]
    log.compact(spark)
    assert held_rows(log.read(spark)) == [(1, "old"), (2, "new")]


def test_compaction_keeps_what_a_store_says(spark, sf_dir, tmp_path):
    store, target = RunStore(str(tmp_path / "s")), dayferry.ParquetTarget(str(tmp_path / "d"))
    args = (spark, [EVENTS], source(sf_dir), target, store)

    def said():
        return [
            sorted(map(str, df.collect()))
            for df in (latest_run_state(store.ledger(spark)), store.status(spark), store.digests(spark), store.files(spark, "events.ts"))
        ]

    for days in (5, 3):
        dayferry.sync(*args, as_of=AS_OF, days=days, changed_only=True)
    before = said()
    assert all(before) and store.compact(spark) > 5 and said() == before
    results = dayferry.sync(*args, as_of=AS_OF, days=5, changed_only=True)
    assert results.where("loaded").count() == 0
    assert store.compact(spark) > 0 and store.ledger(spark).count() == 6


# --- scratch ----------------------------------------------------------------------------------


def test_scratch_is_removed_once_the_result_is_written(spark, tmp_path):
    before = shared_dir(spark, "kept")
    spark.range(3).write.parquet(before)
    with scratch(spark):
        df = written(spark.range(10).withColumn("x", F.col("id") * 2), "test")
        [inside] = {os.path.dirname(f.removeprefix("file://")) for f in df.inputFiles()[:1]}
        df.write.parquet(str(tmp_path / "out"))
        assert os.path.exists(inside)
    assert not os.path.exists(inside) and os.path.exists(before)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    with pytest.raises(KeyError), scratch(spark):
        inside = shared_dir(spark, "failed")
        spark.range(1).write.parquet(inside)
        raise KeyError
    assert not os.path.exists(inside)
