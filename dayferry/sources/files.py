"""Parquet tables as source, and as a target partitioned by day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dayferry.operators.window import between_days, undated
from dayferry.registry import DAY, TableSpec
from dayferry.sources.hadoop import Files
from dayferry.sources.preflight import Probe


_STATE = ["file", "bytes", "modified"]  # a file, and by what it shows that it is another one now


def _file_state() -> list[Column]:
    names = ("file_path", "file_size", "file_modification_time")
    return [F.col(f"_metadata.{n}").alias(a) for n, a in zip(names, _STATE)]


class ParquetSource:
    """Source tables by name.

    A declared schema saves the job that would infer it. ``day_partitions`` names the partition
    column that holds the day of the time column, for tables laid out that way; the window is
    then also put on it, so files of other days are not opened.
    """

    def __init__(
        self,
        paths: Mapping[str, str],
        schemas: Mapping[str, str | StructType] | None = None,
        day_partitions: Mapping[str, str] | None = None,
    ):
        self.paths = dict(paths)
        self.schemas = dict(schemas or {})
        self.day_partitions = dict(day_partitions or {})

    def _reader(self, spark: SparkSession, source_table: str):
        schema = self.schemas.get(source_table)
        return spark.read if schema is None else spark.read.schema(schema)

    def table(self, spark: SparkSession, source_table: str) -> DataFrame:
        return self._reader(spark, source_table).parquet(self.paths[source_table])

    def _files(self, spark: SparkSession, source_table: str, paths: list[str]) -> DataFrame:
        """Some files of a table, with the partition columns that their folders give them."""
        reader, base = self._reader(spark, source_table), self.paths[source_table]
        return (reader.option("basePath", base) if Files(spark, base).is_folder(base) else reader).parquet(*paths)

    def __call__(self, spark: SparkSession, spec: TableSpec, first: dt.date, last: dt.date) -> DataFrame:
        rows = self.table(spark, spec.source_table)
        if spec.source_table in self.day_partitions:
            # Partitions hold days as they are stored; a zone's days reach into the ones before and after.
            more = dt.timedelta(days=0 if spec.zone is None else 1)
            rows = between_days(rows, self.day_partitions[spec.source_table], first - more, last + more)
        return between_days(rows, spec.time_column, first, last, spec.zone)

    def undated(self, spark: SparkSession, spec: TableSpec) -> int:
        """How many rows of the source have no readable day. Only the time column is read, but of all files."""
        return undated(self.table(spark, spec.source_table), spec.time_column).count()

    def present_files(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        """file, bytes and modified of each file of a source, and its path, by listing alone."""
        listed = spark.read.format("binaryFile").load(self.paths[spec.source_table])
        return listed.select(*_file_state(), "path")

    def undated_in_new_files(self, spark: SparkSession, spec: TableSpec, known: DataFrame) -> DataFrame | None:
        """Undated rows of each file that is not ``known`` in this state (file, bytes, modified); None if there is none.

        Of the files only the new ones are opened, so a nightly run reads what came since the last one. Their
        paths come to the driver, which hands them to the reader, except in a first run: that reads the table as it is.
        """
        present = self.present_files(spark, spec)
        first_run = known.isEmpty()
        new = present.join(known, _STATE, "left_anti")
        if first_run:
            rows = self.table(spark, spec.source_table)
        else:
            paths = [r["path"] for r in new.select("path").collect()]  # what came since the last run
            if not paths:
                return None
            rows = self._files(spark, spec.source_table, paths)
        counts = undated(rows, spec.time_column).groupBy(*_file_state()).agg(F.count(F.lit(1)).alias("n"))
        return new.join(counts, _STATE, "left").select(*_STATE, F.coalesce("n", F.lit(0)).alias("undated"))

    def probe(self, spec: TableSpec, first: dt.date | None = None, last: dt.date | None = None) -> Probe:
        """A check of the source; with days, only of these, which does not read the history."""
        name = spec.source_table

        def rows(spark: SparkSession) -> DataFrame:
            return self.table(spark, name) if first is None else self(spark, spec, first, last)

        return Probe(name, "source", rows, spec.time_column, spec)


class ParquetTarget:
    """One folder per target table, one partition per day.

    A load replaces whole days, so running a window again leaves the same rows. ``gather``
    shuffles rows by day before the write, which a source in no particular order needs to
    avoid a file per task and day. Turn it off when each read partition already holds few
    days (a source partitioned by day, or a JDBC read cut by day): the load then has no shuffle.
    """

    def __init__(self, base: str, gather: bool = True):
        self.base = base.rstrip("/")
        self.gather = gather

    def path(self, spec: TableSpec) -> str:
        return f"{self.base}/{spec.target_table}"

    def replace_days(
        self, rows: DataFrame, spec: TableSpec, first: dt.date, last: dt.date, days: Collection[dt.date] | None = None
    ) -> int:
        """Write the rows of the days first..last and return how many were written.

        With ``days``, rows are of these days of the window alone, and no other day is touched. Rebalancing
        gathers a day into few files, and the adaptive planner splits a hot day
        over many tasks by its size. The count is observed behind that shuffle, in the writing
        stage, where a recomputed task is not counted twice.
        """
        written = Observation()
        placed = rows.hint("rebalance", DAY) if self.gather else rows
        seen_days = F.collect_set(DAY).alias("days")
        (
            placed.observe(written, F.count(F.lit(1)).alias("records"), seen_days)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY)
            .parquet(self.path(spec))
        )
        seen = written.get  # empty when the optimizer finds that there are no rows
        self._clear_stale(rows.sparkSession, spec, first, last, seen.get("days", []), days)
        return seen.get("records", 0)

    def _clear_stale(self, spark, spec, first, last, written_days, days) -> None:
        """Drop the days of the window that have become empty at the source; a dynamic overwrite leaves them."""
        kept = set(written_days)
        for day, folder in self._folders(spark, spec, first, last):
            if day not in kept and (days is None or day in days):
                Files(spark, folder).delete(folder)

    def _folders(self, spark: SparkSession, spec: TableSpec, first: dt.date, last: dt.date):
        """The window's days that have a folder. Each is asked for by name: older days are never listed."""
        days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
        found = [(d, f"{self.path(spec)}/{DAY}={d}") for d in days]
        files = Files(spark, self.path(spec))
        return [(d, folder) for d, folder in found if files.exists(folder)]

    def table(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        return spark.read.parquet(self.path(spec)).withColumn(DAY, F.col(DAY).cast("date"))

    def day_counts(self, spark: SparkSession, spec: TableSpec, first: dt.date, last: dt.date) -> DataFrame:
        """Records per day, from the folders' names and the row counts in the file footers."""
        folders = [folder for _, folder in self._folders(spark, spec, first, last)]
        if not folders:
            return spark.createDataFrame([], f"{DAY} date, records bigint")
        held = spark.read.schema(f"{DAY} date").option("basePath", self.path(spec)).parquet(*folders)
        return held.groupBy(DAY).agg(F.count(F.lit(1)).alias("records"))

    def probe(self, spec: TableSpec, first: dt.date | None = None, last: dt.date | None = None) -> Probe:
        """A check of the target; with days, only of these."""

        def rows(spark: SparkSession) -> DataFrame:
            held = self.table(spark, spec)
            return held if first is None else held.where(F.col(DAY).between(first, last))

        return Probe(spec.target_table, "target", rows, DAY)
