"""Where a sync keeps its ledger, table status, task results, and what it knows of days and files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayferry.frames import fields
from dayferry.operators.digest import DIGEST_SCHEMA, current_digests
from dayferry.operators.ledger import LEDGER_SCHEMA
from dayferry.operators.status import STATUS_SCHEMA, current_status
from dayferry.sources.hadoop import Files
from dayferry.sources.lease import Lease, held
from dayferry.sources.log import AppendLog

_VERSION = T.StructField("version", T.LongType())
_STATUS_LOG_SCHEMA = T.StructType([*STATUS_SCHEMA.fields, _VERSION])
_DIGEST_LOG_SCHEMA = T.StructType([T.StructField("target_table", T.StringType()), *DIGEST_SCHEMA.fields, _VERSION])
FILE_SCHEMA = fields(file=T.StringType(), bytes=T.LongType(), modified=T.TimestampType(), undated=T.LongType())
_FILE_LOG_SCHEMA = T.StructType([T.StructField("source_table", T.StringType()), *FILE_SCHEMA.fields, _VERSION])


class RunStore:
    """Parquet tables under one shared folder. One sync at a time holds it, over all drivers.

    Ledger, status and the rest are only ever appended to, so no write reads the path it replaces,
    and a run that dies leaves nothing half overwritten. Task results have a folder per run.
    ``stale_after`` is how many seconds a driver may be silent before its run counts as dead. With
    ``exclusive=False`` runs may overlap; ids are claimed, so each keeps its ledger rows and results.
    """

    def __init__(self, base: str, exclusive: bool = True, stale_after: float = 600):
        self.base = base.rstrip("/")
        self.exclusive, self.stale_after = exclusive, stale_after
        self.ledger_path = f"{self.base}/ledger"
        self.status_path = f"{self.base}/status"
        self.results_path = f"{self.base}/results"
        self._ledger = AppendLog(self.ledger_path, LEDGER_SCHEMA)
        self._status = AppendLog(self.status_path, _STATUS_LOG_SCHEMA, lambda log: current_status(log, keep_version=True))
        self._digests = AppendLog(f"{self.base}/digests", _DIGEST_LOG_SCHEMA, lambda log: current_digests(log, keep_version=True))
        self._files = AppendLog(f"{self.base}/files", _FILE_LOG_SCHEMA, _current_files)

    @property
    def _logs(self) -> list[AppendLog]:
        return [self._ledger, self._status, self._digests, self._files]

    def create(self, spark: SparkSession) -> RunStore:
        """Make the empty tables unless there are some."""
        for log in self._logs:
            log.create(spark)
        return self

    @contextmanager
    def hold(self, spark: SparkSession, holder: str) -> Iterator[Lease | None]:
        """Hold the store for a run, or raise Busy while another one is open."""
        if self.exclusive:
            with held(spark, self.base, "_running", holder, self.stale_after) as lease:
                yield lease
        else:
            yield None

    def claim(self, spark: SparkSession) -> int:
        """An id that no other run has or gets: its file is made once, by whoever comes first."""
        files, folder = Files(spark, self.base), f"{self.base}/ids"
        taken = files.names(folder)
        if not taken:  # a store from before ids were claimed
            last = self.ledger(spark).agg(F.max("id")).first()[0] if files.exists(self.ledger_path) else None
            taken = [str(last or 0)]
        number = max(int(n) for n in taken if n.isdigit()) + 1
        while not files.create(f"{folder}/{number}", str(number)):
            number += 1
        return number

    def ledger(self, spark: SparkSession) -> DataFrame:
        return self._ledger.read(spark)

    def append(self, record: DataFrame) -> None:
        self._ledger.append(record)

    def status(self, spark: SparkSession) -> DataFrame:
        """One row per table."""
        return current_status(self._status.read(spark))

    def update_status(self, updates: DataFrame, version: int) -> None:
        """Log new status rows. The version is the id of their run; higher ones replace lower."""
        self._status.append(updates.select(*STATUS_SCHEMA.names, _version(version)))

    def digests(self, spark: SparkSession) -> DataFrame:
        """One row per target table and day, as last loaded."""
        return current_digests(self._digests.read(spark))

    def update_digests(self, digests: DataFrame, version: int) -> None:
        self._digests.append(digests.select("target_table", *DIGEST_SCHEMA.names, _version(version)))

    def files(self, spark: SparkSession, source_table: str) -> DataFrame:
        """The source's files that have been looked into, with their undated rows."""
        log = self._files.read(spark).where(F.col("source_table") == source_table)
        return _current_files(log).select(*FILE_SCHEMA.names)

    def update_files(self, files: DataFrame, source_table: str, version: int) -> None:
        self._files.append(files.select(F.lit(source_table).alias("source_table"), *FILE_SCHEMA.names, _version(version)))

    def write_results(self, results: DataFrame, run_id: int) -> DataFrame:
        path = f"{self.results_path}/run_id={run_id}"
        results.write.mode("overwrite").parquet(path)
        return results.sparkSession.read.schema(results.schema).parquet(path)

    def compact(self, spark: SparkSession) -> int:
        """Fold the many small files of the tables into few; readers and writers go on. Returns how many were folded."""
        with held(spark, self.base, "_compacting", "compaction", self.stale_after):
            ids = Files(spark, f"{self.base}/ids")
            numbers = sorted(int(n) for n in ids.names(f"{self.base}/ids") if n.isdigit())
            for number in numbers[:-100]:  # the last ones keep two claims apart
                ids.delete(f"{self.base}/ids/{number}")
            return sum(log.compact(spark) for log in self._logs)


def _version(version: int):
    return F.lit(version).cast("bigint").alias("version")


def _current_files(log: DataFrame) -> DataFrame:
    """One row per file and state of it, as last logged."""
    keys = ["source_table", "file", "bytes", "modified"]
    return log.groupBy(*keys).agg(F.max_by("undated", "version").alias("undated"), F.max("version").alias("version"))
