"""Readers and writers. A reader is any callable ``read(spark, spec, first, last)``.

A target has ``replace_days(rows, spec, first, last) -> int`` and
``day_counts(spark, spec, first, last) -> DataFrame``.
"""
