"""DuckDB SQL for each registered query, over views of the given tables."""

from __future__ import annotations

from dayferry.workload.expected_columns import EXPECTED

# --- shared pieces ------------------------------------------------------------------------------

_TABLES = [  # view, time column, target table, default days
    ("events", "ts", "ods_query", 24),
    ("orders", "o_orderdate", "ods_campain", 60),
    ("lineitem", "l_shipdate", "ods_campaign_dsp", 60),
]

_LEDGER = """
runs as (
  select min(event_id) as k, min(ts) as start_time,
         case when event_type = 'signup' then null else max(ts) end as end_time,
         case event_type when 'error' then 'failed' when 'signup' then 'running'
                         when 'view' then 'stopped' else 'success' end as status,
         case event_type when 'view' then '' else event_type end as tables_migrated,
         count(*) as total_records,
         case event_type when 'error' then 'timeout after ' || count(*)
                         when 'view' then 'Migration stopped by user' end as error_message
  from events group by cast(ts as date), event_type
),
ledger as (
  select 2 * k as id, start_time, cast(null as timestamp) as end_time, 'running' as status,
         tables_migrated, cast(0 as bigint) as total_records,
         cast(null as varchar) as error_message, cast(0 as double) as duration_seconds
  from runs
  union all
  select 2 * k + 1, start_time, end_time, status, tables_migrated, total_records, error_message,
         date_diff('microsecond', start_time, end_time) / 1e6
  from runs where status <> 'running'
),
collapsed as (
  select * from ledger qualify row_number() over (partition by start_time order by id desc) = 1
)
"""

_STATUS = """
old as (
  select event_type as table_name, min(event_id) as id, max(ts) as last_sync_time,
         count(*) as records_count, 'failed' as status, 'connection lost' as last_error
  from events where ts < timestamp '2024-01-15' and event_type <> 'purchase' group by 1
),
new as (
  select event_type as table_name, min(event_id) as id, max(ts) as last_sync_time,
         count(*) as records_count, 'success' as status, cast(null as varchar) as last_error
  from events where ts >= timestamp '2024-01-15' and event_type <> 'error' group by 1
),
merged as (
  select coalesce(old.id, new.id) as id, table_name,
         case when new.id is null then old.last_sync_time else new.last_sync_time end as last_sync_time,
         case when new.id is null then old.records_count else new.records_count end as records_count,
         case when new.id is null then old.status else new.status end as status,
         case when new.id is null then old.last_error else new.last_error end as last_error
  from old full join new using (table_name)
)
"""


def _window(view: str, time: str, days: int) -> str:
    return f"from {view} where cast({time} as date) > (select cast(max({time}) as date) from {view}) - {days}"


def _window_counts(view: str, time: str, days: int) -> str:
    return f"select cast({time} as date) as day, count(*) as records {_window(view, time, days)} group by 1"


def _all_counts(days: int | None = None, only: tuple[str, ...] = ()) -> str:
    return " union all ".join(
        f"select '{target}' as target_table, day, records from ({_window_counts(view, time, days or default)})"
        for view, time, target, default in _TABLES
        if not only or target in only
    )


def _plan(days: int | None = None) -> str:
    """The work plan as a subquery; task ids run on from table to table."""
    parts, offset = [], 0
    for i, (view, time, target, default) in enumerate(_TABLES):
        n = days or default
        parts.append(
            f"""select '{view}' as source_table, '{target}' as target_table,
                cast(as_of - {n - 1} + cast(i as integer) as date) as day,
                cast(cast(as_of - {n - 1} + cast(i as integer) as date) as varchar) as date_str,
                cast({i} as bigint) as table_index, cast(0 as bigint) as priority,
                cast({offset + 1} + i as bigint) as task_id
            from (select cast(max({time}) as date) as as_of from {view}), range({n}) r(i)"""
        )
        offset += n
    return " union all ".join(parts)


def _covered(days: int | None = None) -> str:
    return f"""
      select p.*, coalesce(c.records, 0) as records
      from ({_plan(days)}) p left join ({_all_counts(days)}) c using (target_table, day)"""


def _text(x: str) -> str:
    return f"year({x}) || '/' || month({x}) || '/' || day({x}) || ' ' || strftime({x}, '%H:%M:%S')"


def _parts(s: str) -> tuple[str, str, str]:
    return (
        f"cast(floor({s} / 3600) as bigint)",
        f"cast(floor(({s} % 3600) / 60) as bigint)",
        f"cast(floor({s} % 60) as bigint)",
    )


def _duration(s: str) -> str:
    h, m, sec = _parts(s)
    return f"""case when {s} is null or {s} = 0 then '-'
        when {h} > 0 then {h} || '时 ' || {m} || '分 ' || {sec} || '秒'
        when {m} > 0 then {m} || '分 ' || {sec} || '秒' else {sec} || '秒' end"""


def _elapsed(s: str) -> str:
    h, m, sec = _parts(s)
    return f"{h} || '时 ' || {m} || '分 ' || {sec} || '秒'"


def _label(x: str) -> str:
    return f"""case {x} when 'success' then '成功' when 'failed' then '失败' when 'stopped' then '已停止'
        when 'running' then '运行中' when 'syncing' then '同步中' when 'idle' then '空闲' else {x} end"""


def _run_class(x: str) -> str:
    return f"""case when {x} in ('success', 'failed', 'stopped', 'running')
        then 'status-' || {x} else 'status-idle' end"""


def _table_class(x: str) -> str:
    return f"""case {x} when 'success' then 'status-success' when 'failed' then 'status-failed'
        when 'syncing' then 'status-running' else 'status-idle' end"""


def _thousands(n: str) -> str:
    return f"format('{{:,}}', coalesce({n}, 0))"


def _dash(x: str) -> str:
    return f"coalesce(nullif({x}, ''), '-')"


_EVENT_STATUS = """
  select event_id, case event_id % 9 when 0 then 'success' when 1 then 'failed' when 2 then 'stopped'
    when 3 then 'running' when 4 then 'syncing' when 5 then 'idle' when 6 then 'paused'
    when 7 then '' end as status
  from events"""

_TYPED = """
  select event_id,
         case when event_id % 10 = 0 then 'n/a' else cast(event_id as varchar) end as number,
         regexp_extract(props, '"k": *([0-9]+)', 1) as k, cast(ts as date) as day,
         case when event_type = 'view' then value || ' EUR' else cast(value as varchar) end as sales14d
  from events"""


def _mapping_catalog() -> str:
    inputs = {
        "ods_query": "select event_id as key from events",
        "ods_campain": "select o_orderkey as key from orders",
        "ods_campaign_dsp": "select l_orderkey as key from lineitem",
        "ods_aws_asin_philips": "select p_partkey as key from part",
    }
    expected: dict[str, list[list[str]]] = {}
    for line in EXPECTED.split("\n"):
        if line:
            expected.setdefault(line.split("|")[0], []).append(line.split("|")[1:])
    parts = []
    for table, columns in expected.items():
        names = ", ".join(f"({i}, '{s}', '{t}', '{k}')" for i, (s, t, k) in enumerate(columns))
        parts.append(f"""
          select '{table}' as target_table, target_column, cast(position as bigint) as position,
                 source_column, proposed_type,
                 (select count(*) from ({inputs[table]}) t where t.key % (position + 2) <> 0)
                   as filled
          from (values {names}) v(position, source_column, target_column, proposed_type)""")
    return " union all ".join(parts)


# --- one statement per query -----------------------------------------------------------------------

ORACLES: dict[str, str] = {
    "window_sync": """
        select cast(ts as date) as day, count(*) as records from events
        where cast(ts as date) > (select cast(max(ts) as date) from events) - 24 group by 1""",
    "window_sync_orders": """
        select cast(o_orderdate as date) as day, count(*) as records from orders
        where cast(o_orderdate as date) > (select cast(max(o_orderdate) as date) from orders) - 60
        group by 1""",
    "window_sync_lineitem": """
        select cast(l_shipdate as date) as day, count(*) as records from lineitem
        where cast(l_shipdate as date) > (select cast(max(l_shipdate) as date) from lineitem) - 60
        group by 1""",
    "window_days_override": _all_counts(days=7),
    "table_subset": _all_counts(only=("ods_query", "ods_campaign_dsp")),
    "table_subset_all": _all_counts(),
    "day_counts": """
        select event_type, cast(ts as date) as day, count(*) as records from events group by all""",
    "table_registry": f"""
        select r.*, w.as_of, w.records
        from (values ('ods_Query', 'ods_query', 0::bigint, 24::bigint, 'ods_Query_ods_query'),
                     ('ods_campain', 'ods_campain', 1, 60, 'ods_campain_ods_campain'),
                     ('ods_campaign_dsp', 'ods_campaign_dsp', 2, 60, 'ods_campaign_dsp_ods_campaign_dsp'),
                     ('ods_aws_asin_philips', 'ods_aws_asin_philips', 3, 60,
                      'ods_aws_asin_philips_ods_aws_asin_philips'))
             r(source_table, target_table, table_index, default_days, lane)
        left join (select target_table, max(day) as as_of, cast(sum(records) as bigint) as records
                   from ({_all_counts()}) group by 1) w using (target_table)""",
    "mapped_projection": """
        select event_id, ts as time, event_type, user_id as campaign_id, value as tpixel from events""",
    "mapping_catalog": _mapping_catalog(),
    "typed_projection": f"""
        select event_id, try_cast(number as bigint) as number, try_cast(k as bigint) as k, day,
               try_cast(sales14d as decimal(18, 4)) as sales14d
        from ({_TYPED})""",
    "typed_projection_failures": f"""
        with t as ({_TYPED})
        select 'number' as target_column, 'bigint' as type, count(*) as records, count(number) as present,
               count(number) - count(try_cast(number as bigint)) as failed from t
        union all select 'k', 'bigint', count(*), count(k), count(k) - count(try_cast(k as bigint)) from t
        union all select 'day', 'date', count(*), count(day), 0 from t
        union all select 'sales14d', 'decimal(18,4)', count(*), count(sales14d),
          count(sales14d) - count(try_cast(sales14d as decimal(18, 4))) from t""",
    "day_task_plan": f"""
        select *, cast(case target_table when 'ods_campain' then 5 else 6 end as bigint) as column_count
        from ({_plan()})""",
    "task_order_topk": f"""
        select task_id, -records as priority, target_table, day,
               'MigrationTask(id=' || task_id || ', priority=' || -records || ', date=' || date_str
               || ', table=' || target_table || ')' as description
        from (select * exclude (priority) from ({_covered()})) order by 2, 1 limit 20""",
    "lane_depth": f"""
        select source_table || '_' || target_table as lane, count(*) as depth
        from ({_covered()}) where records > 0 group by 1""",
    "day_coverage": f"select target_table, day, records from ({_covered(90)})",
    "missing_days": """
        select 'ods_campain' as target_table, cast(as_of - 364 + cast(i as integer) as date) as day,
               i + 1 as task_id
        from (select cast(max(o_orderdate) as date) + 30 as as_of from orders), range(365) r(i)
        where not exists (select 1 from orders where cast(o_orderdate as date) = as_of - 364 + cast(i as integer))""",
    "run_ledger_append": f"""
        with {_LEDGER} select * from ledger
        union all select 1000000000000000, timestamp '2024-02-01 09:00:00',
          timestamp '2024-02-01 09:02:05.25', 'success', 'ods_query,ods_campain', 12345, null, 125.25""",
    "latest_run_state": f"with {_LEDGER} select * from collapsed",
    "run_history_topk": f"with {_LEDGER} select * from ledger order by start_time desc, id desc limit 10",
    "run_history_default": f"with {_LEDGER} select * from ledger order by start_time desc, id desc limit 50",
    "run_totals": f"""
        with {_LEDGER}
        select cast(sum(total_records) as bigint) as total_records,
               count(*) filter (status = 'success') as completed_tasks,
               count(*) filter (status = 'failed') as failed_tasks, count(*) as all_tasks
        from collapsed""",
    "run_duration": f"with {_LEDGER} select id, duration_seconds from ledger",
    "history_display": f"""
        with {_LEDGER}
        select id, {_text("start_time")} as start_text, coalesce({_text("end_time")}, '-') as end_text,
               {_label("status")} as status_text, {_run_class("status")} as status_class,
               {_dash("tables_migrated")} as tables_text, {_thousands("total_records")} as records_text,
               {_duration("duration_seconds")} as duration_text, {_dash("error_message")} as error_text
        from ledger""",
    "run_messages": f"""
        with {_LEDGER}
        select id, case status
          when 'success' then 'Migration completed successfully. Migrated ' || total_records || ' records.'
          when 'failed' then case when id % 4 = 1 then 'Migration error: ' else 'Migration failed: ' end
                             || error_message
          when 'stopped' then 'Migration stopped' when 'running' then 'Migration started' end as message
        from collapsed""",
    "rows_to_json": f"""
        with {_LEDGER}
        select id, '{{"id":' || id || ',"start_time":"' || strftime(start_time, '%Y-%m-%d %H:%M:%S.%f')
          || '","end_time":'
          || coalesce('"' || strftime(end_time, '%Y-%m-%d %H:%M:%S.%f') || '"', 'null')
          || ',"status":"' || status || '","tables_migrated":"' || tables_migrated
          || '","total_records":' || total_records
          || ',"error_message":' || coalesce('"' || error_message || '"', 'null')
          || ',"duration_seconds":' || duration_seconds || '}}' as json
        from ledger""",
    "status_document": f"""
        with {_LEDGER}, newest as (select * from collapsed order by start_time desc, id desc limit 1),
        opened as (select id from ledger where status = 'running' order by start_time desc, id desc limit 1)
        select n.status = 'running' as is_running, (select id from opened) as current_migration_id,
               n.start_time as migration_start_time,
               case when n.status = 'failed' then n.error_message end as last_error,
               t.*, '{{}}' as progress_info,
               '{{"ods_query_days":"24","other_tables_days":"60"}}' as config
        from newest n, (
          select cast(sum(total_records) as bigint) as total_records,
                 count(*) filter (status = 'success') as completed_tasks,
                 count(*) filter (status = 'failed') as failed_tasks
          from collapsed where start_time = (select start_time from newest)) t""",
    "sync_losses": """
        with t as (
          select *, cast(ts as date) as day, event_id % 7 = 0 or (event_id % 11 = 0 and strftime(ts, '%Y-%m-%d') like '%-0%')
                    as undated from events
        ), w as (select * from t where not undated and day > (select cast(max(ts) as date) from events) - 24),
        o as (select count(*) as n from orders
              where cast(o_orderdate as date) between (select cast(max(ts) as date) from events) - 59
                                                  and (select cast(max(ts) as date) from events))
        select 'ods_query' as target_table, 'failed' as status,
               'number as bigint: ' || count(*) filter (event_id % 10 = 0) || ' values lost, 0 changed; '
               || 'sales14d as decimal(18,1): 0 values lost, '
               || count(*) filter (cast(round(value * 100) as bigint) % 10 <> 0) || ' changed; '
               || (select count(*) from t where undated) || ' rows of events_text have no readable Time' as error,
               count(*) as records
        from w
        union all select 'ods_campain', 'success', null, n from o""",
    "run_duration_text": f"""
        select event_id, {_duration("s")} as duration_text from (
          select event_id, case event_id % 5 when 1 then 0.0::double when 2 then value
            when 3 then value * 100 when 4 then value * 1000 end as s from events)""",
    "run_elapsed_text": f"""
        select event_id, {_elapsed("s")} as elapsed_text from (
          select event_id, floor(date_diff('microsecond', ts, timestamp '2024-02-01') / 1e6) as s
          from events)""",
    "status_labels": f"select event_id, status, {_label('status')} as label from ({_EVENT_STATUS})",
    "status_class": f"""
        select event_id, {_run_class("status")} as run_class, {_table_class("status")} as table_class
        from ({_EVENT_STATUS})""",
    "tables_label": """
        select user_id, case when n = 0 then 'all' else names end as tables_label from (
          select user_id, count(distinct event_type) filter (value > 50) as n,
                 string_agg(distinct event_type, ',' order by event_type) filter (value > 50) as names
          from events group by 1)""",
    "valid_schedule_time": """
        with t as (
          select event_id, event_id % 8 as f, event_id % 27 as h, event_id % 67 as m from events)
        select event_id, case when f = 7 then null
          when f in (0, 1, 2) then false else h <= 23 and m <= 59 end as valid
        from t""",
    "beijing_time": f"""
        select event_id, beijing, {_text("beijing")} as beijing_text
        from (select event_id, ts + interval 8 hours as beijing from events)""",
    "table_status_rollup": """
        select event_type as table_name, max(ts) as last_sync_time, count(*) as records_count
        from events group by 1""",
    "table_status_upsert": f"with {_STATUS} select * from merged",
    "table_status_lookup": f"with {_STATUS} select * from merged where table_name = 'click'",
    "table_status_listing": f"with {_STATUS} select * from merged order by table_name nulls first",
    "table_status_display": f"""
        with {_STATUS}
        select table_name, {_text("last_sync_time")} as last_sync_text,
               {_thousands("records_count")} as records_text, {_label("status")} as status_text,
               {_table_class("status")} as status_class, {_dash("last_error")} as error_text
        from merged""",
    "day_sliced_scan": """
        select cast(date_diff('day', (select cast(max(ts) as date) from events) - 23, cast(ts as date))
                    as bigint) as slice, count(*) as records
        from events where cast(ts as date) > (select cast(max(ts) as date) from events) - 24 group by 1""",
    "source_preflight": " union all ".join(
        f"""select '{view}' as name, 'source' as kind, {view != "orders"} as success,
            '{view} {"lacks mapped columns" if view == "orders" else "connection successful"}' as message,
            count(*) as records, cast(min({time}) as date) as first_day,
            cast(max({time}) as date) as last_day,
            '{"o_clerk" if view == "orders" else ""}' as missing_columns from {view}"""
        for view, time, _, _ in _TABLES
    ),
    "partitioned_sink_roundtrip": f"""
        select ts as time, event_id, user_id, event_type as activity_type,
               cast(value as decimal(18, 4)) as sales14d, props as query, cast(ts as date) as day
        {_window("events", "ts", 24)}""",
    "window_reload_idempotent": _window_counts("events", "ts", 24),
    "window_reload_stale_days": f"""
        select * from ({_window_counts("events", "ts", 24)})
        where day <= (select cast(max(ts) as date) from events) - 10 or dayofweek(day) not in (0, 6)""",
}
ORACLES["sync_run"] = " union all ".join(
    f"""select '{view}' as source_table, '{target}' as target_table, day,
               coalesce(records, 0) as records, 'success' as status
        from (select as_of - 59 + cast(i as integer) as day
              from (select cast(max(o_orderdate) as date) as as_of from orders), range(60) r(i)) d
        left join (select cast({time} as date) as day, count(*) as records
                   from {view} group by 1) c using (day)"""
    for view, time, target, _ in _TABLES[1:]
)
ORACLES["sync_ledger"] = f"""
    select cast(id as bigint) as id, status, tables_migrated, total_records,
           cast(null as varchar) as error_message
    from (select 1 as id, 'running' as status, 'all' as tables_migrated, cast(0 as bigint) as total_records
          union all select 2, 'success', 'all', count(*) {_window("events", "ts", 24)}
          union all select 3, 'running', 'ods_query', 0
          union all select 4, 'success', 'ods_query', count(*) {_window("events", "ts", 7)})"""
ORACLES["sync_overlap"] = " union all ".join(
    f"""select '{target}' as tables_migrated, status, case status when 'success' then n else 0 end as total_records,
               n as result_records, cast(4 as bigint) as distinct_ids
        from (select count(*) as n {_window(view, time, days)}), (values ('running'), ('success')) s(status)"""
    for view, time, target, days in _TABLES[:2]
)
ORACLES["sync_refused"] = f"""
    select cast(1 as bigint) as id, 'running' as status, cast(0 as bigint) as total_records, cast(1 as bigint) as refused
    union all select 2, 'success', count(*), 1 {_window("events", "ts", 24)}"""
ORACLES["changed_days"] = """
    with o as (select *, cast(o_orderdate as date) as day from orders),
    was as (select * from o where day not between date '1996-07-01' and date '1996-07-03'),
    now as (
      select * replace (case when o_orderkey % 991 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice) from o
      where day not between date '1995-03-01' and date '1995-03-05' and o_orderkey % 997 <> 0
      union all select * replace (-o_orderkey as o_orderkey) from o where o_orderkey % 983 = 0
    ), days as (
      select day from (select * from was except all select * from now)
      union select day from (select * from now except all select * from was)
    ), n as (
      select day, (select count(*) from was w where w.day = d.day) as records_before,
             (select count(*) from now w where w.day = d.day) as records_after
      from days d
    )
    select *, case when records_before = 0 then 'added' when records_after = 0 then 'removed' else 'changed' end as change from n"""
ORACLES["sync_changed_days"] = """
    with d as (select cast(max(ts) as date) - 23 + cast(i as integer) as day from events, range(24) r(i) group by i),
    now as (
      select cast(ts as date) as day from events where not (event_id % 50 = 0 and day(ts) in (10, 20))
      union all select cast(ts as date) from events where event_id % 40 = 0 and day(ts) = 25
    ), touched as (
      select cast(ts as date) as day from events
      where (event_id % 50 = 0 and day(ts) in (10, 20)) or (event_id % 30 = 0 and day(ts) = 15)
         or (event_id % 40 = 0 and day(ts) = 25)
    )
    select day, (select count(*) from now n where n.day = d.day) as records, 'success' as status,
           day in (select day from touched) as loaded
    from d"""
_LATE = """
    late as (
      select as_of - cast(o_orderdate as date) as days_back
      from orders, (select cast(max(o_orderdate) as date) as as_of from orders)
      where o_orderkey % 5 = 0 and as_of - cast(o_orderdate as date) <= (o_orderkey // 5) % 30
    ), ages as (select cast(days_back as bigint) as days_back, count(*) as moved_records from late group by 1)"""
ORACLES["late_arrivals"] = f"with {_LATE} select days_back, cast(1 as bigint) as days, moved_records from ages"
ORACLES["late_arrival_window"] = f"""
    with {_LATE}, sums as (
      select days_back, count(*) over (order by days_back) as upto, count(*) over () as changes from ages
    )
    select min(days_back) + 1 as window_days, any_value(changes) as changes from sums where upto >= 0.8 * changes - 1e-9"""
ORACLES["undated_new_files"] = """
    select cast(run as bigint) as run,
           (select count(*) from events where event_id % 3 < run and (event_id % 7 = 0 or event_id % 11 = 0)) as undated
    from (values (1), (2), (3)) r(run)"""
ORACLES["window_sync_zone"] = """
    with t as (select cast(ts + interval 8 hour as date) as day from events)
    select day, count(*) as records from t where day > (select max(day) from t) - 24 group by 1"""
ORACLES["lane_schedule"] = """
    with recursive w as (
      select 'events.' || event_type as target_table, count(*) as weight from events group by 1
      union all select 'orders.' || o_orderstatus, count(*) from orders group by 1
      union all select 'lineitem.' || l_returnflag, count(*) from lineitem group by 1
    ), o as (select *, row_number() over (order by weight desc, target_table) as place from w),
    placed as (
      select cast(0 as bigint) as place, cast([0, 0, 0] as bigint[]) as totals, cast(-1 as bigint) as lane
      union all
      select o.place, list_transform(range(3), lambda i: totals[i + 1] + case
               when i + 1 = list_position(totals, list_min(totals)) then o.weight else 0 end),
             cast(list_position(totals, list_min(totals)) - 1 as bigint)
      from placed p join o on o.place = p.place + 1
    ), ends as (select totals from placed order by place desc limit 1)
    select target_table, weight, lane, place, (select totals from ends)[lane + 1] as lane_total
    from placed join o using (place)"""
ORACLES["ledger_compaction"] = ORACLES["latest_run_state"]
ORACLES["hot_day_quantiles"] = "select cast(8 as bigint) as parts, count(*) as records, true as balanced from lineitem"


def _report_tables() -> str:
    inputs = {
        "ods_query": ("event_id from events", 24), "ods_campain": ("o_orderkey from orders", 60),
        "ods_campaign_dsp": ("p_partkey from part", 60), "ods_aws_asin_philips": ("s_suppkey from supplier", 60),
    }
    totals = {"bigint": "k % {n}", "decimal(18,4)": "cast((k % 1000) / 8 as decimal(18, 4))", "double": "cast((k % 16) / 16 as decimal(18, 4))"}
    places: dict[str, int] = {}
    parts = []
    for line in filter(None, EXPECTED.split("\n")):
        table, source, target, kind = line.split("|")
        i = places[table] = places.get(table, -1) + 1
        key, days = inputs[table]
        filled = "true" if source in ("Time", "TimeColumn") else f"k % {i + 2} <> 0"
        total = f"sum({totals[kind].format(n=i + 2)}) filter ({filled})" if kind in totals else "null"
        parts.append(f"""
          select '{target}' as target_column, '{kind}' as type, count(*) filter ({filled}) as filled,
                 cast({total} as decimal(18, 4)) as total, '{table}' as target_table, count(*) as records, 'success' as status
          from (select {key.split()[0]} as k from {key.split()[2]}) where k % 90 < {days}""")
    return " union all ".join(parts)


ORACLES["sync_report_tables"] = _report_tables()
