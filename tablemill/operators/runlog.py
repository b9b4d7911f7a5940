"""Statistics of application, job and session logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.spec import col

# Fixed value: status of a run that ended well.
FINISHED = 2

# Status codes of a session run, 1 to 15.
RUN_STATES = (
    "Succeeded", "Disabled", "Failed", "Stopped", "Aborted", "Running", "Suspending", "Suspended",
    "Stopping", "Aborting", "Waiting", "Scheduled", "Unscheduled", "Unknown", "Terminated",
)


def _last_month(log: DataFrame, as_of: datetime | Column) -> DataFrame:
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    since = now.cast("timestamp_ntz") - F.expr("interval 1 month")
    return log.where((col("status") == FINISHED) & (col("ts_ins") >= since))


def _totals() -> list[Column]:
    """Seconds and runs as whole numbers: the order of adding does not show."""
    return [F.sum("seconds_taken").alias("seconds"), F.count("seconds_taken").alias("runs")]


def _minutes_text(short: str) -> Column:
    """Average minutes, rounded half up to two decimals, or the short text below one."""
    seconds, runs = col("seconds"), col("runs")
    hundredths = F.expr("(200 * seconds + 60 * runs) div (120 * runs)")
    number = F.concat(
        F.floor(hundredths / 100).cast("string"),
        F.lit("."),
        F.lpad((hundredths % 100).cast("string"), 2, "0"),
    )
    short_run = seconds.isNull() | (seconds < runs * 60)
    return F.when(short_run, F.lit(short)).otherwise(
        F.concat(F.lpad(number, 9, " "), F.lit(" Minuten"))
    )


def runtime_stats_app(plan: DataFrame, log: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Average run time per application in the month before ``as_of``."""
    minutes = (
        _last_month(log, as_of)
        .groupBy("app_name")
        .agg(*_totals())
    )
    return (
        plan.select("app_name", "project", "subproject")
        .distinct()
        .join(minutes, "app_name", "left")
        .select(
            "app_name",
            "project",
            "subproject",
            _minutes_text("< 1 minute").alias("laufzeit_letzter_monat"),
        )
    )


def runtime_stats_job(plan: DataFrame, log: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Average run time of active jobs, sorted by application and job.

    Averages are per application, job, type, program and arguments but join on job
    and program only: several sets of arguments give several rows, and a job
    without program has no average.
    """
    group = ["app_name", "job_name", "job_type", "prog_name", "prog_args"]
    minutes = (
        _last_month(log, as_of)
        .groupBy(*group)
        .agg(*_totals())
        .select("job_name", "prog_name", "seconds", "runs")
    )
    return (
        plan.where(col("active") == 1)
        .join(minutes, ["job_name", "prog_name"], "left")
        .select(
            "app_name",
            "job_name",
            "project",
            "subproject",
            "job_type",
            "prog_name",
            "prog_args",
            "active",
            _minutes_text("< 1 Minute").alias("laufzeit_letzter_monat"),
        )
        .orderBy("app_name", "job_name")
    )


def latest_run_report(
    runs: DataFrame, folder: str | None = None, workflow: str | None = None, run_id: int | None = None
) -> DataFrame:
    """Sessions of the latest run of each workflow, their status as text.

    The greatest run id is found by an aggregate and joined back, so that a
    workflow with very many sessions stays spread over tasks. ``run_id`` asks for a
    given run instead.
    """
    if folder is not None:
        runs = runs.where(col("subject_area") == folder)
    if workflow is not None:
        runs = runs.where(col("workflow_name") == workflow)
    if run_id is not None:
        latest = runs.where(col("workflow_run_id") == run_id)
    else:
        keys = ["subject_area", "workflow_name"]
        newest = runs.groupBy(*keys).agg(F.max("workflow_run_id").alias("workflow_run_id"))
        latest = runs.join(newest, [*keys, "workflow_run_id"])
    code = col("run_status_code")
    state = F.get(F.array(*[F.lit(s) for s in RUN_STATES]), code - 1)
    return latest.select(
        "subject_area",
        "workflow_name",
        "workflow_run_id",
        "session_timestamp",
        "session_name",
        "successful_rows",
        "failed_rows",
        "session_log_file",
        state.alias("run_status_code"),
    )
