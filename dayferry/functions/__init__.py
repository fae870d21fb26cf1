"""Column expressions: built-in functions only, no UDF, independent of the session time zone."""

from dayferry.functions.status import run_status_class, status_label, table_status_class
from dayferry.functions.text import (
    count_or_zero,
    names_label,
    result_message,
    row_json,
    task_text,
    text_or_dash,
)
from dayferry.functions.timing import (
    duration_text,
    elapsed_text,
    in_time_zone,
    local_text,
    seconds_between,
    valid_time_of_day,
)

__all__ = [
    "count_or_zero",
    "duration_text",
    "elapsed_text",
    "in_time_zone",
    "local_text",
    "names_label",
    "result_message",
    "row_json",
    "run_status_class",
    "seconds_between",
    "status_label",
    "table_status_class",
    "task_text",
    "text_or_dash",
    "valid_time_of_day",
]
