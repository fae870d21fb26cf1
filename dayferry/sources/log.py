"""Small tables that many runs append to, read while one of them folds the files into few."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dayferry.sources.hadoop import Files


class AppendLog:
    """A Parquet table of appended batches, with manifests that say which of them are folded.

    An append writes a folder of its own, hidden until it is whole, so writers never meet; two of Spark's writers
    in one folder would delete each other's unfinished files. ``compact`` writes what the batches hold into
    a new folder and then publishes a manifest, one file that appears at once: it names that folder and the batches
    it stands for. A reader takes the newest manifest, its folder, and the batches that it does not name; what
    is appended meanwhile is among these. Folded batches stay until the next compaction, so a frame that
    was opened before can still be read. ``fold`` turns the rows into fewer with the same meaning.
    """

    def __init__(self, path: str, schema: T.StructType, fold: Callable[[DataFrame], DataFrame] | None = None):
        self.path, self.schema, self.fold = path, schema, fold

    def create(self, spark: SparkSession) -> None:
        Files(spark, self.path).make_folder(self.path)

    def append(self, rows: DataFrame) -> None:
        name = uuid.uuid4().hex
        rows.select(*self.schema.names).write.parquet(f"{self.path}/_adding-{name}/rows")
        if not Files(rows.sparkSession, self.path).rename(f"{self.path}/_adding-{name}", f"{self.path}/batch-{name}"):
            raise RuntimeError(f"{self.path}: the appended rows could not be published")

    def read(self, spark: SparkSession) -> DataFrame:
        _, manifest, batches = self._state(spark)
        return self._rows(spark, manifest, batches)

    def _rows(self, spark: SparkSession, manifest: dict, batches: list[str]) -> DataFrame:
        names = [*([manifest["folder"]] if manifest else []), *batches]
        reader = spark.read.schema(self.schema).option("recursiveFileLookup", "true")
        return reader.parquet(*([f"{self.path}/{n}" for n in names] or [self.path]))

    def batches(self, spark: SparkSession) -> int:
        """Appended batches that are not folded yet."""
        return len(self._state(spark)[2])

    def compact(self, spark: SparkSession) -> int:
        """Fold the appended batches; returns how many. One compaction at a time, appends and reads at any time."""
        at = Files(spark, self.path)
        number, manifest, batches = self._state(spark)
        if not batches:
            return 0
        folder = f"_folded-{uuid.uuid4().hex}/part"  # hidden from a plain listing of the table
        rows = self._rows(spark, manifest, batches)  # these and no later ones
        (self.fold(rows) if self.fold else rows).select(*self.schema.names).hint("rebalance").write.parquet(f"{self.path}/{folder}")
        before = [manifest["folder"].split("/")[0]] if number else []
        temporary, published = f"{self.path}/_writing-{uuid.uuid4().hex}", f"{self.path}/_manifest-{number + 1:010d}"
        at.write(temporary, json.dumps({"folder": folder, "batches": sorted(batches), "before": before}))
        if at.exists(published) or not at.rename(temporary, published):
            raise RuntimeError(f"{self.path}: another compaction was first")
        # What the manifest before has put aside was in use by frames opened before it; by now they are done.
        for name in [*manifest.get("batches", []), *manifest.get("before", []), f"_manifest-{number - 1:010d}"]:
            at.delete(f"{self.path}/{name}")
        return len(batches)

    def _state(self, spark: SparkSession) -> tuple[int, dict, list[str]]:
        """The newest manifest's number, or 0, what it says, and the batches it does not stand for."""
        at = Files(spark, self.path)
        while True:
            names = at.names(self.path)
            number = max([int(n.removeprefix("_manifest-")) for n in names if n.startswith("_manifest-")], default=0)
            text = at.read(f"{self.path}/_manifest-{number:010d}") if number else "{}"
            if text is not None:  # else it has been replaced since it was listed
                break
        manifest = json.loads(text)
        folded = set(manifest.get("batches", []))
        return number, manifest, [n for n in names if not n.startswith(("_", ".")) and n not in folded]
