"""Relational sources and targets over JDBC. Connection settings come from the caller."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dayferry.operators.project import column, quoted
from dayferry.operators.window import time_type, zone_midnight
from dayferry.registry import DAY, TableSpec
from dayferry.sources.preflight import Probe


def _literal(moment: dt.datetime, kind: str) -> str:
    text = moment.date().isoformat() if kind == "date" else moment.isoformat(" ", timespec="microseconds")
    return f"'{text}'"


def day_predicates(
    time_column: str,
    first: dt.date,
    last: dt.date,
    kind: str = "timestamp",
    parts_per_day: int | Mapping[dt.date, int] = 1,
    split_on: str | None = None,
    max_partitions: int | None = None,
    zone: str | None = None,
    bounds: Mapping[dt.date, Sequence] | None = None,
) -> list[str]:
    """WHERE clauses that cover the days first..last, each row by exactly one of them.

    Days are those of a ``zone``, for times in UTC, if one is named. A day with ``bounds``, see
    ``quantile_bounds``, is cut at these values of ``split_on``.

    Each clause becomes one read partition. A day is cut into ``parts_per_day`` parts, given for
    all days or day by day: by time of day for a timestamp, or by the remainder of an integer
    column ``split_on`` with evenly spread values, such as an id. ``max_partitions`` caps the
    partitions, and with them the connections: light days share one and heavy days get fewer
    parts; no row is left out.
    """
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    parts = [parts_per_day.get(d, 1) if isinstance(parts_per_day, Mapping) else parts_per_day for d in days]
    if min(parts) < 1 or (max_partitions is not None and max_partitions < 1):
        raise ValueError("parts_per_day and max_partitions must be at least 1")
    if kind == "date" and max(parts) > 1 and split_on is None:
        raise ValueError("a date column needs split_on to cut a day into parts")

    if zone is not None and kind == "date":
        raise ValueError("days of a zone need a timestamp column")
    load = 1.0 if max_partitions is None else max(1.0, sum(parts) / max_partitions)
    spans = _pack(days, parts, load, zone)
    while max_partitions is not None and sum(n for _, _, n in spans) > max_partitions:
        load *= 1.25
        spans = _pack(days, parts, load, zone)
    starts = {_midnight(d, zone): d for d in days}

    clauses = []
    for start, end, n in spans:
        if split_on is None:
            edges = [start + (end - start) * i / n for i in range(n + 1)]
            clauses += [_between(time_column, x, y, kind) for x, y in zip(edges, edges[1:])]
        else:
            span = _between(time_column, start, end, kind)
            cuts = (bounds or {}).get(starts.get(start))
            inside = _remainders(split_on, n) if cuts is None else range_clauses(split_on, _thinned(cuts, n))
            clauses += [f"{span} AND {r}" for r in inside] if n > 1 else [span]
    return clauses


def quantile_bounds(keys: DataFrame, key: str, parts: int, accuracy: int = 10_000) -> list:
    """Values that cut the rows into about equal parts by a key: fewer than ``parts`` if single values are too frequent.

    One pass, in which tasks keep sketches of bounded size; a part is off by 1/accuracy of all rows at most,
    and by the rows of one value. The key is a number, a date or a timestamp.
    """
    if parts < 1:
        raise ValueError(f"parts must be at least 1, got {parts!r}")
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = keys.agg(F.percentile_approx(column(key), shares, accuracy).alias("bounds")).first()["bounds"]
    return sorted(set(found or []))


def range_clauses(key: str, bounds: Sequence) -> list[str]:
    """WHERE clauses by ranges of a key, which an index on it can serve; each row, also without a key, meets one."""
    k = quoted(key)
    edges = [_key_literal(b) for b in bounds]
    if not edges:
        return ["1 = 1"]
    inner = [f"{k} >= {a} AND {k} < {b}" for a, b in zip(edges, edges[1:])]
    return [f"({k} < {edges[0]} OR {k} IS NULL)", *inner, f"{k} >= {edges[-1]}"]


def _key_literal(value) -> str:
    if isinstance(value, dt.datetime):
        return _literal(value, "timestamp")
    return _literal(_midnight(value), "date") if isinstance(value, dt.date) else repr(value) if isinstance(value, float) else str(value)


def _thinned(bounds: Sequence, parts: int) -> list:
    """Bounds for fewer parts, evenly among those given."""
    if len(bounds) < parts:
        return list(bounds)
    return [bounds[len(bounds) * i // parts] for i in range(1, parts)]


def _pack(days, parts, load, zone=None) -> list[tuple[dt.datetime, dt.datetime, int]]:
    """Spans of days with their number of partitions, each of at most about ``load`` parts."""
    spans, held, start = [], 0, None
    for day, n in zip(days, parts):
        if start is not None and (n >= load or held + n > load):
            spans.append((start, day, 1))
            start = None
        if n >= load:
            spans.append((day, day + dt.timedelta(days=1), int(n // load)))
        elif start is None:
            start, held = day, n
        else:
            held += n
    if start is not None:
        spans.append((start, days[-1] + dt.timedelta(days=1), 1))
    return [(_midnight(a, zone), _midnight(b, zone), n) for a, b, n in spans]


def _midnight(day: dt.date, zone: str | None = None) -> dt.datetime:
    return dt.datetime.combine(day, dt.time()) if zone is None else zone_midnight(day, zone)


def _between(time_column: str, start: dt.datetime, end: dt.datetime, kind: str) -> str:
    t = quoted(time_column)
    return f"{t} >= {_literal(start, kind)} AND {t} < {_literal(end, kind)}"


def _remainders(split_on: str, n: int) -> list[str]:
    key = quoted(split_on)
    clauses = [f"ABS(MOD({key}, {n})) = {i}" for i in range(n)]
    clauses[0] = f"({clauses[0]} OR {key} IS NULL)"
    return clauses


class _Jdbc:
    """Connection settings. ``properties`` is passed to the driver (user, password, driver class,
    timeouts, fetchsize)."""

    def __init__(self, url: str, properties: Mapping[str, str]):
        self.url = url
        self.properties = dict(properties)

    def _query(self, spark: SparkSession, sql: str) -> DataFrame:
        """The result of a query that the database runs."""
        reader = spark.read.format("jdbc").option("url", self.url).options(**self.properties)
        return reader.option("query", sql).load()

    def _table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.jdbc(self.url, name, properties=self.properties)

    def _day_counts(self, spark, table: str, time_column: str, first: dt.date, last: dt.date) -> DataFrame:
        """At most one row per day, counted by the database."""
        [inside] = day_predicates(time_column, first, last, "date", max_partitions=1)
        day = f"CAST({quoted(time_column)} AS DATE)"
        times = f"COUNT(DISTINCT {quoted(time_column)})"
        sql = f"SELECT {day} AS d, COUNT(*) AS n, {times} AS t FROM {table} WHERE {inside} GROUP BY {day}"
        counts = self._query(spark, sql).toDF(DAY, "records", "times")
        return counts.select(F.col(DAY).cast("date"), *[F.col(c).cast("bigint") for c in ("records", "times")])

    def _probe(self, kind: str, table: str, time_column: str, spec: TableSpec | None, first=None, last=None) -> Probe:
        # Spark would fetch the whole time column to aggregate it.
        t = quoted(time_column)
        where = "" if first is None else " WHERE " + day_predicates(time_column, first, last, "date", max_partitions=1)[0]
        sql = f"SELECT COUNT(*) AS n, MIN({t}) AS first_time, MAX({t}) AS last_time FROM {table}{where}"
        return Probe(
            table,
            kind,
            lambda spark: self._table(spark, table),
            time_column,
            spec,
            lambda spark: self._query(spark, sql),
        )


class JdbcSource(_Jdbc):
    """Reads a window of a source table, one partition per predicate.

    With ``rows_per_partition`` the database first counts the rows of each day, and a day with
    more is cut into as many parts as it needs. A date column needs ``split_on`` for that. With ``quantiles`` such
    a day's values of ``split_on`` are read once, that column alone, and the day is cut into ranges of them
    with about equal rows, which the database can find by an index; else by remainders.
    """

    def __init__(
        self,
        url: str,
        properties: Mapping[str, str],
        rows_per_partition: int | None = None,
        split_on: str | None = None,
        max_partitions: int | None = None,
        quantiles: bool = False,
    ):
        super().__init__(url, properties)
        if quantiles and split_on is None:
            raise ValueError("quantiles need the column to split on")
        self.quantiles = quantiles
        self.rows_per_partition = rows_per_partition
        self.split_on = split_on
        self.max_partitions = max_partitions

    def __call__(self, spark: SparkSession, spec: TableSpec, first: dt.date, last: dt.date) -> DataFrame:
        clauses = self.predicates(spark, spec, first, last)
        return spark.read.jdbc(self.url, spec.source_table, predicates=clauses, properties=self.properties)

    def predicates(self, spark: SparkSession, spec: TableSpec, first: dt.date, last: dt.date) -> list[str]:
        kind = time_type(self._table(spark, spec.source_table), spec.time_column)
        kind = "date" if kind in ("date", "string") else "timestamp"
        parts, bounds = 1, None
        if spec.zone is not None and self.rows_per_partition:
            raise ValueError("the database counts days as it stores them; days of a zone can't be cut by their counts")
        if self.rows_per_partition:
            counts = self._day_counts(spark, spec.source_table, spec.time_column, first, last)
            parts = {}
            for d, n, times in counts.collect():  # one row per day
                parts[d] = -(-n // self.rows_per_partition)
                if parts[d] > 1 and self.split_on is None and times == 1:
                    raise ValueError(f"{d} has {n} rows of one time, which no time of day can split: name split_on")
            if self.quantiles:
                bounds = {d: self._bounds(spark, spec, kind, d, n) for d, n in parts.items() if n > 1}
        return day_predicates(
            spec.time_column, first, last, kind, parts, self.split_on, self.max_partitions, spec.zone, bounds
        )

    def _bounds(self, spark: SparkSession, spec: TableSpec, kind: str, day: dt.date, parts: int) -> list:
        [inside] = day_predicates(spec.time_column, day, day, kind)
        keys = self._query(spark, f"SELECT {quoted(self.split_on)} AS k FROM {spec.source_table} WHERE {inside}")
        return quantile_bounds(keys.toDF("k"), "k", parts)

    def undated(self, spark: SparkSession, spec: TableSpec) -> int:
        """How many rows of the source have no day, counted by the database."""
        t = quoted(spec.time_column)
        text = time_type(self._table(spark, spec.source_table), spec.time_column) == "string"
        day = f"CAST({t} AS DATE)" if text else t  # an index can serve a plain null check
        sql = f"SELECT COUNT(*) AS n FROM {spec.source_table} WHERE {day} IS NULL"
        return int(self._query(spark, sql).first()[0])

    def probe(self, spec: TableSpec, first: dt.date | None = None, last: dt.date | None = None) -> Probe:
        """A check of the source; with days, only of these."""
        return self._probe("source", spec.source_table, spec.time_column, spec, first, last)


def swap_statements(
    target: str, staging: str, columns: Sequence[str], time_column: str, first: dt.date, last: dt.date
) -> list[str]:
    """Statements that put the staged rows of the days in place of the target's. Run them in one transaction."""
    names = ", ".join(quoted(c) for c in columns)
    [inside] = day_predicates(time_column, first, last, "date", max_partitions=1)
    return [
        f"DELETE FROM {target} WHERE {inside}",
        f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging} WHERE {inside}",
    ]


class JdbcTarget(_Jdbc):
    """Loads a staging table with Spark, then swaps whole days in the target.

    Spark's JDBC writer commits task by task, so a task that is repeated after a lost executor
    can load its rows twice. The staging table is therefore counted before the swap and the
    load fails when the count is off, or when a row's time does not fit the target's type: the swap could
    not find such a row again. The target is untouched until then, and the next run starts the
    staging table afresh. Days are swapped one by one: ``run_transaction`` runs the statements of a
    day on the driver in one transaction of the target database.
    """

    def __init__(
        self,
        url: str,
        properties: Mapping[str, str],
        run_transaction: Callable[[list[str]], None],
        staging_suffix: str = "_staging",
        max_connections: int = 16,
    ):
        super().__init__(url, properties)
        self.run_transaction = run_transaction
        self.staging_suffix = staging_suffix
        self.max_connections = max_connections

    def _load(self, rows: DataFrame, table: str) -> None:
        # truncate keeps the staging table's own column types; numPartitions caps connections.
        writer = rows.write.mode("overwrite").option("truncate", "true")
        writer.option("numPartitions", self.max_connections).jdbc(self.url, table, properties=self.properties)

    def replace_days(
        self, rows: DataFrame, spec: TableSpec, first: dt.date, last: dt.date, days: Collection[dt.date] | None = None
    ) -> int:
        """Load the rows of the days first..last, or of these ``days`` of them, and swap those days."""
        if spec.zone is not None:
            raise ValueError("a JDBC target swaps days as the times are stored; days of a zone need a day column there")
        staging = spec.target_table + self.staging_suffix
        read = Observation()
        timeless = F.count_if(F.col(quoted(spec.target_time_column)).isNull()).alias("timeless")
        self._load(rows.drop(DAY).observe(read, F.count(F.lit(1)).alias("records"), timeless), staging)
        expected = read.get.get("records", 0)
        if read.get.get("timeless", 0):
            raise RuntimeError(f"{read.get['timeless']} rows have a time that does not cast; target left as it was")
        held = int(self._query(rows.sparkSession, f"SELECT COUNT(*) AS n FROM {staging}").first()[0])
        if held != expected:
            raise RuntimeError(f"{staging} holds {held} rows after loading {expected}; target left as it was")
        time = spec.target_time_column
        for i in range((last - first).days + 1):
            day = first + dt.timedelta(days=i)
            if days is not None and day not in days:
                continue
            self.run_transaction(swap_statements(spec.target_table, staging, spec.target_columns, time, day, day))
        return expected

    def day_counts(self, spark: SparkSession, spec: TableSpec, first: dt.date, last: dt.date) -> DataFrame:
        """Records per day, counted by the target database."""
        return self._day_counts(spark, spec.target_table, spec.target_time_column, first, last).drop("times")

    def probe(self, spec: TableSpec) -> Probe:
        return self._probe("target", spec.target_table, spec.target_time_column, None)
