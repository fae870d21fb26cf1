"""A lease on a folder: one holder at a time, over all drivers."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from dayferry.sources.hadoop import Files


class Busy(RuntimeError):
    """Somebody else holds the lease."""


class Lease:
    """A file that one holder has made and keeps writing anew; one that is not written any more has been left behind."""

    def __init__(self, spark: SparkSession, path: str, token: str):
        self._files, self._path, self._token = Files(spark, path), path, token
        self._done = threading.Event()
        self.lost = False

    def check(self) -> None:
        """Raise if somebody took the lease over, as a holder that slept too long has to expect."""
        if self.lost or self._files.read(self._path) != self._token:
            self.lost = True
            raise Busy(f"{self._path} was taken over")

    def _beat(self, every: float) -> None:
        while not self._done.wait(every):
            try:
                self.check()
                self._files.write(self._path, self._token)
            except Busy:
                return
            except Exception:  # a file system that stutters: the next beat may come through, else the lease is left behind
                continue


@contextmanager
def held(spark: SparkSession, folder: str, name: str, holder: str, stale_after: float) -> Iterator[Lease]:
    """Hold the lease ``name`` of a folder, or raise Busy.

    A lease that was not written for ``stale_after`` seconds by the file system's clock belonged to a driver that
    died. It is taken over behind a door that one can pass at a time, who looks again: else a slow one would take
    the lease from the one that has just taken it over.
    """
    files, path = Files(spark, folder), f"{folder}/{name}"
    door = f"{path}-takeover"
    token = json.dumps({"holder": holder, "token": uuid.uuid4().hex})

    def stale(file: str) -> bool:
        written = files.modified(file)
        return written is not None and files.now(folder) - written > stale_after

    mine = files.create(path, token)
    if not mine and stale(path):
        if files.create(door, token):
            try:
                if stale(path):
                    files.delete(path)
                    mine = files.create(path, token)
            finally:
                files.delete(door)
        elif stale(door):
            files.delete(door)  # for the next one
    if not mine:
        raise Busy(f"{path} is held: {files.read(path)}")
    lease = Lease(spark, path, token)
    beats = threading.Thread(target=lease._beat, args=(stale_after / 4,), daemon=True)
    beats.start()
    try:
        yield lease
    finally:
        lease._done.set()
        beats.join()
        if files.read(path) == token:
            files.delete(path)
