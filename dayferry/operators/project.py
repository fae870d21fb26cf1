"""Renaming and typing by a column mapping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayferry.registry import ColumnSpec


def quoted(name: str) -> str:
    """A column name as a SQL identifier; it may hold dots, spaces or backticks."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column(name: str) -> Column:
    """A top-level column by its literal name."""
    return F.col(quoted(name))


# The wide projections below are given as SQL text: a table has up to 137 columns, and building
# Column objects one call at a time would take longer than planning the query.


def map_columns(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Keep the mapped columns under their target names, in mapping order."""
    return df.selectExpr(*[f"{quoted(c.source)} AS {quoted(c.target)}" for c in columns])


def map_typed(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """As map_columns, each column cast to its declared type. A value that does not cast becomes null."""
    return df.selectExpr(*[f"{_typed(c)} AS {quoted(c.target)}" for c in columns])


def _typed(c: ColumnSpec) -> str:
    return quoted(c.source) if c.type is None else f"try_cast({quoted(c.source)} AS {c.type})"


def failed_casts(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Per typed column: rows, values present, values lost by the cast."""
    typed = [c for c in columns if c.type is not None]
    if not typed:
        raise ValueError("no typed columns to check")
    return column_report(df, [
        f"""struct({text(c.target)} AS target_column, {text(c.type)} AS type, count(1) AS records,
            count({quoted(c.source)}) AS present,
            count_if({quoted(c.source)} IS NOT NULL AND {_typed(c)} IS NULL) AS failed)"""
        for c in typed
    ])


_NUMBERS = ("bigint", "int", "smallint", "tinyint", "decimal", "float")


def _changed(c: ColumnSpec) -> str:
    """SQL that tells whether a value that did cast is another one than before.

    Numbers are compared by value, so ``1.50`` as ``1.5000`` is the same. A date is the day of a time, as asked
    for; text holds any value, and a double is as near as doubles are.
    """
    raw, cast, kind = quoted(c.source), _typed(c), c.type.lower()
    if kind.startswith(_NUMBERS):
        wide = "decimal(38,10)"
        return f"NOT coalesce(try_cast({raw} AS {wide}) = try_cast({cast} AS {wide}), false)"
    if kind.startswith("timestamp"):
        return f"NOT coalesce(try_cast({raw} AS timestamp_ntz) = try_cast({cast} AS timestamp_ntz), false)"
    return "false"


def _lost(c: ColumnSpec) -> str:
    raw = quoted(c.source)
    return f"({raw} IS NOT NULL AND ({_typed(c)} IS NULL OR {_changed(c)}))"


def lost_values(columns: Sequence[ColumnSpec]) -> str:
    """SQL for the number of values over all rows that a load as these types would lose or change."""
    flags = [f"if({_lost(c)}, 1, 0)" for c in columns if c.type is not None]
    return f"coalesce(sum({' + '.join(flags)}), 0)" if flags else "0L * count(1)"


def cast_losses(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Per typed column: values present, values that did not cast, and values that the cast changed."""
    return column_report(df, [
        f"""struct({text(c.target)} AS target_column, {text(c.type)} AS type, count({quoted(c.source)}) AS present,
            count_if({quoted(c.source)} IS NOT NULL AND {_typed(c)} IS NULL) AS failed,
            count_if({_lost(c)} AND {_typed(c)} IS NOT NULL) AS changed)"""
        for c in columns
        if c.type is not None
    ])


def column_report(df: DataFrame, entries: Sequence[str], chunk: int = 32) -> DataFrame:
    """One row per entry, each the SQL text of a struct of aggregates over the whole input.

    A wide table is aggregated a few columns at a time: one aggregate over 100 columns becomes
    a method too large for the JIT, and on a columnar source the passes together read each
    column once.
    """
    passes = [
        df.agg(F.expr(f"array({', '.join(entries[i : i + chunk])})").alias("report")).selectExpr("inline(report)")
        for i in range(0, len(entries), chunk)
    ]
    return reduce(DataFrame.unionAll, passes)
