"""Rolling-window table sync on Spark."""

from dayferry.operators.ledger import run_history
from dayferry.operators.status import status_document, table_status
from dayferry.plans.sync import sync
from dayferry.registry import REPORT_TABLES, ColumnSpec, TableSpec
from dayferry.sources.files import ParquetSource, ParquetTarget
from dayferry.sources.jdbc import JdbcSource, JdbcTarget
from dayferry.sources.preflight import Probe, preflight
from dayferry.sources.store import RunStore

__all__ = [
    "REPORT_TABLES",
    "ColumnSpec",
    "JdbcSource",
    "JdbcTarget",
    "ParquetSource",
    "ParquetTarget",
    "Probe",
    "RunStore",
    "TableSpec",
    "preflight",
    "run_history",
    "status_document",
    "sync",
    "table_status",
]
