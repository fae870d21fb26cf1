"""Python workers that find this package."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa

_HELD: dict[str, Callable[[], None]] = {}


def takes_over(owner: str, forget: Callable[[], None]) -> None:
    """Let go what other operators' tasks remember in this worker, which outlives their stages.

    ``forget`` lets go what this one will remember, when another one takes over.
    """
    others = [name for name in _HELD if name != owner]
    for name in others:
        _HELD.pop(name)()
    if others:
        _hand_back()
    _HELD[owner] = forget


def leaves_nothing() -> None:
    """Let go what any operator's tasks remember in this worker, for tasks that remember nothing themselves.

    An idle worker lives on beside stages without Python, and holds what it was left with.
    """
    while _HELD:
        _HELD.popitem()[1]()
    _hand_back()


def _hand_back() -> None:
    """Hand freed memory back to the system, where its allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def reaching_workers(query: Callable) -> Callable:
    """A query, its session first, whose Python workers import this package from where the driver did.

    A driver may have the package on its own path only. Where executors have it elsewhere, as
    with ``--py-files``, that still holds: a folder they lack does no harm.
    """

    @functools.wraps(query)
    def run(spark, *args, **kwargs):
        root = str(Path(__file__).resolve().parents[2])
        env = spark.sparkContext.environment
        paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            env["PYTHONPATH"] = os.pathsep.join([*paths, root])
        return query(spark, *args, **kwargs)

    return run
