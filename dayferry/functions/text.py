"""Display defaults, name lists, messages and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_or_dash(text: Column) -> Column:
    """``-`` for null or empty text."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("-"))


def count_or_zero(n: Column) -> Column:
    """A count with thousands separators; 0 for null."""
    return F.format_number(F.coalesce(n, F.lit(0)), 0)


def names_label(names: Column) -> Column:
    """Names joined by commas; ``all`` when none are selected."""
    return F.when(names.isNull() | (F.size(names) == 0), F.lit("all")).otherwise(F.concat_ws(",", names))


# The texts of a run's result and of a task.
_COMPLETED = ("Migration completed successfully. Migrated ", " records.")
_FAILED = "Migration failed: "
_ERROR = "Migration error: "
_STOPPED = "Migration stopped"
_STARTED = "Migration started"
_TASK = "MigrationTask(id=%d, priority=%d, date=%s, table=%s)"


def result_message(status: Column, total_records: Column, error: Column, raised: Column | None = None) -> Column:
    """What a caller is told about a run. ``raised`` marks a run ended by an exception."""
    raised = F.lit(False) if raised is None else raised
    error = F.coalesce(error, F.lit("None"))
    total = F.coalesce(total_records, F.lit(0)).cast("string")
    before, after = _COMPLETED
    return (
        F.when(status == "success", F.concat(F.lit(before), total, F.lit(after)))
        .when((status == "failed") & raised, F.concat(F.lit(_ERROR), error))
        .when(status == "failed", F.concat(F.lit(_FAILED), error))
        .when(status == "stopped", F.lit(_STOPPED))
        .when(status == "running", F.lit(_STARTED))
    )


def task_text(task_id: Column, priority: Column, date_str: Column, target_table: Column) -> Column:
    return F.format_string(_TASK, task_id, priority, date_str, target_table)


# Nulls are kept, and times keep their microseconds.
_JSON_OPTIONS = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def row_json(*columns: str | Column) -> Column:
    """All given columns as one JSON object."""
    return F.to_json(F.struct(*columns), _JSON_OPTIONS)
