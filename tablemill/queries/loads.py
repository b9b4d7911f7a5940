"""Load windows and run-log statistics over the test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.operators.loads import (
    close_load,
    current_load,
    load_parameters,
    next_load_window,
    window_filter,
)
from tablemill.operators.runlog import latest_run_report, runtime_stats_app, runtime_stats_job
from tablemill.queries.base import Tables, query

NOW = datetime(2002, 1, 1, 6, 0, 0)

HISTORY_COLUMNS = """
    o_orderkey as lid, o_custkey as wid, case o_orderstatus when 'F' then 'OK' when 'O' then 'Eingeplant'
        else case o_orderpriority when '1-URGENT' then 'in Arbeit' when '2-HIGH' then 'NOK' else 'OK' end end as sta,
    o_orderdate as ltv, o_orderdate + interval 1 day as ltb, o_orderdate as ttv,
    o_orderdate + interval 1 day as ttb, concat('run ', o_orderkey) as kom
"""
HISTORY = f"h as (select {HISTORY_COLUMNS} from orders)"


def history(t: Tables) -> DataFrame:
    return t.spark.sql(f"select {HISTORY_COLUMNS} from {{o}}", o=t.orders)


def _stamps(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as text."""
    return df.withColumns(
        {n: F.coalesce(F.date_format(n, "yyyy-MM-dd HH:mm:ss"), F.lit("-")) for n in names}
    )


def _stamp(name: str) -> str:
    return f"coalesce(strftime({name}, '%Y-%m-%d %H:%M:%S'), '-') as {name}"


@query(
    "current_load",
    f"""
    with {HISTORY},
    r as (select *, rank() over (partition by wid order by lid desc) as rank from h where sta = 'OK'
        union select *, rank() over (partition by wid order by lid) from h where sta = 'Eingeplant'
        union select *, 1 from h where sta in ('in Arbeit', 'NOK'))
    select lid, wid, sta, {_stamp('ltv')}, {_stamp('ltb')}, {_stamp('ttv')}, {_stamp('ttb')}, cast(rank as int) as rank
    from r where rank = 1
    """,
)
def current(t: Tables) -> DataFrame:
    return _stamps(current_load(history(t)), "ltv", "ltb", "ttv", "ttb")


NEXT = f"""
    {HISTORY},
    s as (select wid, min(lid) filter (sta in ('in Arbeit', 'NOK')) as o, min(lid) filter (sta = 'Eingeplant') as p,
        max(lid) filter (sta = 'OK') as d from h group by wid),
    w as (select c_custkey as wid, o, p, d from customer left join s on wid = c_custkey),
    n as (select w.wid, coalesce(o, p) as lid, case when o is not null then 'resume' when p is not null then 'start'
            when d is not null then 'follow' else 'initial' end as action,
        a.ltb, case when a.lid is not null then a.ttv else coalesce(b.ttb, timestamp '1900-01-01 00:00:00') end as ttv,
        case when a.lid is not null then a.ttb else timestamp '{NOW}' end as ttb,
        coalesce(a.kom, 'Automatisch generiert am: {NOW}') as kom
        from w left join h a on a.lid = coalesce(o, p) left join h b on b.lid = d)
"""


@query(
    "next_load_window",
    f"""
    with {NEXT}
    select wid, coalesce(lid, -1) as lid, 'in Arbeit' as sta, '{NOW}' as ltv, {_stamp('ltb')}, {_stamp('ttv')},
        {_stamp('ttb')}, kom, action from n
    """,
)
def next_window(t: Tables) -> DataFrame:
    workflows = t.customer.selectExpr("c_custkey as wid")
    runs = next_load_window(history(t), workflows, NOW).na.fill(-1, ["lid"])
    return _stamps(runs, "ltv", "ltb", "ttv", "ttb")


@query(
    "load_parameters",
    f"""
    with {NEXT},
    m as (select wid, coalesce(lid, 900000000 - 1 + row_number() over (partition by lid is null order by wid)) as lid
        from n)
    select wid, 'GLOBAL' as session_name, 'LTV' as parameter_name, '{NOW}.000000' as parameter_wert from m
    union all select wid, 'GLOBAL', 'LID', cast(lid as varchar) from m
    """,
)
def parameters(t: Tables) -> DataFrame:
    workflows = t.customer.selectExpr("c_custkey as wid")
    return load_parameters(next_load_window(history(t), workflows, NOW, first_id=900_000_000))


@query(
    "close_load",
    f"""
    with {HISTORY}
    select lid, wid, case sta when 'in Arbeit' then 'OK' else sta end as sta, {_stamp('ltv')},
        strftime(case sta when 'in Arbeit' then timestamp '{NOW}' else ltb end, '%Y-%m-%d %H:%M:%S') as ltb, kom
    from h
    """,
)
def closed(t: Tables) -> DataFrame:
    return _stamps(close_load(history(t), NOW), "ltv", "ltb").drop("ttv", "ttb")


@query(
    "window_filter",
    """
    select * from lineitem where l_shipdate >= timestamp '1997-01-01' and l_shipdate < timestamp '1997-02-01'
    """,
)
def in_window(t: Tables) -> DataFrame:
    return window_filter(t.lineitem, "l_shipdate", datetime(1997, 1, 1), datetime(1997, 2, 1))


AS_OF = datetime(2024, 2, 12, 8, 0, 0)

LOG_COLUMNS = """
    event_type as app_name, concat('J', user_id % 50) as job_name, 'SHELL' as job_type,
    case when user_id % 50 = 7 then null else concat(event_type, '.sh') end as prog_name,
    concat('-m ', user_id % 3) as prog_args,
    case when value > 15 then 3 else 2 end as status, ts as ts_ins, cast(floor(value * 9) as bigint) as seconds_taken
"""
LOG = f"l as (select {LOG_COLUMNS} from events)"


def run_log(t: Tables) -> DataFrame:
    return t.spark.sql(f"select {LOG_COLUMNS} from {{e}}", e=t.events)


def _minutes_sql(short: str) -> str:
    return f"""case when s is null or s < n * 60 then '{short}' else
        lpad(((200 * s + 60 * n) // (120 * n) // 100) || '.' || lpad(cast((200 * s + 60 * n) // (120 * n) % 100
        as varchar), 2, '0'), 9, ' ') || ' Minuten' end as laufzeit_letzter_monat"""


@query(
    "runtime_stats_app",
    f"""
    with {LOG},
    p as (select distinct app_name, 'P1' as project, 'S' || length(app_name) as subproject from l
        union select distinct c_mktsegment, 'P2', 'S' from customer),
    a as (select app_name, sum(seconds_taken) as s, count(seconds_taken) as n from l
        where status = 2 and ts_ins >= timestamp '{AS_OF}' - interval 1 month group by 1)
    select app_name, project, subproject, {_minutes_sql('< 1 minute')} from p left join a using (app_name)
    """,
)
def app_stats(t: Tables) -> DataFrame:
    log = run_log(t)
    plan = log.selectExpr("app_name", "'P1' as project", "concat('S', length(app_name)) as subproject").union(
        t.customer.selectExpr("c_mktsegment", "'P2'", "'S'")
    )
    return runtime_stats_app(plan, log, AS_OF)


@query(
    "runtime_stats_job",
    f"""
    with {LOG},
    p as (select distinct app_name, job_name, 'P' as project, 'S' as subproject, job_type, prog_name, prog_args,
        case when job_name like '%5' then 0 else 1 end as active from l),
    a as (select app_name, job_name, job_type, prog_name, prog_args, sum(seconds_taken) as s, count(seconds_taken) as n from l
        where status = 2 and ts_ins >= timestamp '{AS_OF}' - interval 1 month group by all)
    select p.app_name, p.job_name, project, subproject, p.job_type, p.prog_name, p.prog_args, active,
        {_minutes_sql('< 1 Minute')}
    from p left join a on a.job_name = p.job_name and a.prog_name = p.prog_name where active = 1
    """,
)
def job_stats(t: Tables) -> DataFrame:
    log = run_log(t)
    plan = log.selectExpr(
        "app_name", "job_name", "'P' as project", "'S' as subproject", "job_type", "prog_name", "prog_args",
        "case when job_name like '%5' then 0 else 1 end as active",
    ).distinct()
    return runtime_stats_job(plan, log, AS_OF)


RUNS = """
    o_orderpriority as subject_area, concat('wf_', o_custkey % 100) as workflow_name,
    cast(o_custkey as bigint) as workflow_run_id, o_orderdate as session_timestamp,
    concat('s_', o_orderkey) as session_name, o_orderkey * 2 as successful_rows, o_orderkey % 3 as failed_rows,
    concat('/log/', o_orderkey) as session_log_file, cast(1 + o_orderkey % 15 as int) as run_status_code
"""


@query(
    "latest_run_report",
    f"""
    with r as (select {RUNS} from orders)
    select subject_area, workflow_name, workflow_run_id, strftime(session_timestamp, '%Y-%m-%d') as session_timestamp,
        session_name, successful_rows, failed_rows, session_log_file,
        ['Succeeded', 'Disabled', 'Failed', 'Stopped', 'Aborted', 'Running', 'Suspending', 'Suspended', 'Stopping',
         'Aborting', 'Waiting', 'Scheduled', 'Unscheduled', 'Unknown', 'Terminated'][run_status_code] as run_status_code
    from r where workflow_run_id = (select max(workflow_run_id) from r x
        where x.subject_area = r.subject_area and x.workflow_name = r.workflow_name)
    """,
)
def latest_runs(t: Tables) -> DataFrame:
    runs = t.spark.sql(f"select {RUNS} from {{o}}", o=t.orders)
    return latest_run_report(runs).withColumn(
        "session_timestamp", F.date_format("session_timestamp", "yyyy-MM-dd")
    )
