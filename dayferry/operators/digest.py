"""Digests of days: which days of a table hold other rows than before, without comparing rows.

A digest counts a day's rows and sums and xors a hash of each. All three are free of order and can be merged, so
they combine before the shuffle, and digests of parts add up to the digest of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayferry.frames import fields
from dayferry.operators.project import column

DIGEST_SCHEMA = fields(day=T.DateType(), records=T.LongType(), hash_sum=T.DecimalType(38, 0), hash_xor=T.LongType())


def row_hash(columns: Sequence[str]) -> Column:
    """A hash of a row's values, which columns they are in, and which of them are null; xxhash64 alone passes over nulls."""
    values = [column(c) for c in columns]
    return F.xxhash64(F.lit("\x1f".join(columns)), F.array(*[v.isNull() for v in values]), *values)


def day_digests(df: DataFrame, day: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per day with its digest over the columns, all by default."""
    hashed = df.select(day.alias("day"), row_hash(columns or df.columns).alias("h"))
    return hashed.groupBy("day").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.col("h").cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("h").alias("hash_xor"),
    )


def merge_digests(parts: DataFrame, *keys: str) -> DataFrame:
    """Digests of parts of days put together, per day and further keys."""
    return parts.groupBy(*keys, "day").agg(
        F.sum("records").alias("records"),
        F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("hash_xor").alias("hash_xor"),
    )


def changed_days(before: DataFrame, after: DataFrame, *keys: str) -> DataFrame:
    """Days whose digests differ, with the records before and after and the kind of change.

    ``added`` and ``removed`` days have records on one side only; a day without records is none. An aggregate
    over both sides, in which a day's two rows combine before the shuffle, takes the place of a full join.
    """
    sides = [
        rows.select(
            *keys, "day", *[F.when(F.lit(i == side), F.struct("records", "hash_sum", "hash_xor")).alias(f"side{i}") for i in (0, 1)]
        )
        for side, rows in enumerate((before.where("records > 0"), after.where("records > 0")))
    ]
    both = sides[0].unionByName(sides[1]).groupBy(*keys, "day").agg(F.max("side0").alias("was"), F.max("side1").alias("now"))
    kind = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").otherwise("changed")
    return both.where(~F.col("was").eqNullSafe(F.col("now"))).select(
        *keys,
        "day",
        F.coalesce(F.col("was.records"), F.lit(0)).cast("bigint").alias("records_before"),
        F.coalesce(F.col("now.records"), F.lit(0)).cast("bigint").alias("records_after"),
        kind.alias("change"),
    )


def current_digests(log: DataFrame, keep_version: bool = False) -> DataFrame:
    """One row per target table and day from a log with a ``version``; the highest version wins."""
    found = log.groupBy("target_table", "day").agg(
        F.max_by(F.struct("records", "hash_sum", "hash_xor"), "version").alias("d"), F.max("version").alias("version")
    )
    return found.select("target_table", "day", "d.*", *(["version"] if keep_version else []))


def lateness(changes: DataFrame, as_of: Column) -> DataFrame:
    """How many changed days lie how many days back, and how many records they have gained or lost."""
    age = F.date_diff(as_of, F.col("day")).cast("bigint").alias("days_back")
    return changes.groupBy(age).agg(
        F.count(F.lit(1)).alias("days"), F.sum(F.abs(F.col("records_after") - F.col("records_before"))).alias("moved_records")
    )


def covering_window(ages: DataFrame, share: float, weight: str = "days") -> DataFrame:
    """The shortest window that holds the given share of changes, by number of days or of records, in one row.

    ``ages`` is a histogram by whole days back, as ``lateness`` gives it, so it is small. The window counts its
    last day, so a change of the same day needs a window of 1.
    """
    if not 0 < share <= 1:
        raise ValueError(f"share must lie over 0 and up to 1, got {share!r}")
    bins = F.sort_array(F.collect_list(F.struct("days_back", F.col(weight).cast("double").alias("n"))))
    inside = ages.where("days_back >= 0").agg(bins.alias("bins"), F.sum(weight).cast("double").alias("total"))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("bigint").alias("window"))

    def step(acc: Column, b: Column) -> Column:
        total = acc["sum"] + b["n"]
        enough = acc["window"].isNull() & (total >= F.col("total") * share - 1e-9)
        return F.struct(total.alias("sum"), F.when(enough, b["days_back"] + 1).otherwise(acc["window"]).alias("window"))

    return inside.select(F.aggregate("bins", start, step)["window"].alias("window_days"), F.col("total").cast("bigint").alias("changes"))
