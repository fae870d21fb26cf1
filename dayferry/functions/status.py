"""Labels and display classes of run and table states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# State labels.
STATUS_LABELS = {
    "success": "成功",
    "failed": "失败",
    "stopped": "已停止",
    "running": "运行中",
    "syncing": "同步中",
    "idle": "空闲",
}

# Display classes; any other state is idle.
RUN_CLASSES = {
    "success": "status-success",
    "failed": "status-failed",
    "stopped": "status-stopped",
    "running": "status-running",
}
TABLE_CLASSES = {
    "success": "status-success",
    "failed": "status-failed",
    "syncing": "status-running",
}
IDLE_CLASS = "status-idle"


def _lookup(key: Column, table: dict[str, str], default: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.element_at(pairs, key), default)


def status_label(status: Column) -> Column:
    """The label of a known state; other values pass through."""
    return _lookup(status, STATUS_LABELS, status)


def run_status_class(status: Column) -> Column:
    return _lookup(status, RUN_CLASSES, F.lit(IDLE_CLASS))


def table_status_class(status: Column) -> Column:
    return _lookup(status, TABLE_CLASSES, F.lit(IDLE_CLASS))
