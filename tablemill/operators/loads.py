"""Load windows of incremental extraction.

Runs of a workflow are rows of a history: ``lid`` run, ``wid`` workflow, ``sta``
status, ``ttv``/``ttb`` bounds of the data, ``ltv``/``ltb`` start and end of the run.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemill.operators.numbering import global_row_number
from tablemill.spec import col

# States of a run, and where the first window starts.
DONE, PLANNED, RUNNING, FAILED = "OK", "Eingeplant", "in Arbeit", "NOK"
FIRST_BOUND = datetime(1900, 1, 1)
NOTE = "Automatisch generiert am: "

COLUMNS = ["lid", "ltv", "ltb", "wid", "sta", "ttv", "ttb"]


def current_load(history: DataFrame) -> DataFrame:
    """Per workflow the newest finished, the oldest planned and every open run.

    Finished and planned runs are ranked in one window, whose tasks keep one row per
    workflow and status before the shuffle. Open runs are ranked 1 by definition and
    stay out of it, as there may be many of them.
    """
    runs = history.select(COLUMNS)
    newest_first = F.when(col("sta") == DONE, -col("lid")).otherwise(col("lid"))
    place = F.rank().over(Window.partitionBy("wid", "sta").orderBy(newest_first))
    closed = runs.where(col("sta").isin(DONE, PLANNED)).withColumn("rank", place)
    is_open = runs.where(col("sta").isin(RUNNING, FAILED)).withColumn("rank", F.lit(1))
    return closed.where(col("rank") == 1).union(is_open).distinct()


def next_load_window(
    history: DataFrame, workflows: DataFrame, now: datetime, first_id: int | None = None
) -> DataFrame:
    """The run each workflow has to work on now, as the changed or new history row.

    An open run is taken up again, else the oldest planned one is started, else a
    window from the end of the last finished run up to now is opened, else the
    initial one. ``action`` says which. New runs have no ``lid`` unless ``first_id``
    is given to number them from.
    """
    lid, ts = col("lid"), F.lit(now).cast("timestamp_ntz")
    row = F.struct("ltb", "ttv", "ttb", "kom")
    is_open = col("sta").isin(RUNNING, FAILED)
    state = history.groupBy("wid").agg(
        F.min(F.when(is_open, lid)).alias("open_lid"),
        F.min_by(row, F.when(is_open, lid)).alias("open_row"),
        F.min(F.when(col("sta") == PLANNED, lid)).alias("plan_lid"),
        F.min_by(row, F.when(col("sta") == PLANNED, lid)).alias("plan_row"),
        F.max_by("ttb", F.when(col("sta") == DONE, lid)).alias("done_ttb"),
        F.max(F.when(col("sta") == DONE, lid)).alias("done_lid"),
    )
    joined = workflows.select("wid").distinct().join(state, "wid", "left")
    note = F.concat(F.lit(NOTE), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    start = F.coalesce(col("done_ttb"), F.lit(FIRST_BOUND).cast("timestamp_ntz"))
    fresh = F.struct(
        F.lit(None).cast("timestamp_ntz").alias("ltb"),
        start.alias("ttv"),
        ts.alias("ttb"),
        note.alias("kom"),
    )
    action = (
        F.when(col("open_lid").isNotNull(), F.lit("resume"))
        .when(col("plan_lid").isNotNull(), F.lit("start"))
        .when(col("done_lid").isNotNull(), F.lit("follow"))
        .otherwise(F.lit("initial"))
    )
    picked = (
        F.when(col("open_lid").isNotNull(), col("open_row"))
        .when(col("plan_lid").isNotNull(), col("plan_row"))
        .otherwise(fresh)
    )
    runs = joined.select(
        F.coalesce("open_lid", "plan_lid").alias("lid"),
        "wid",
        F.lit(RUNNING).alias("sta"),
        ts.alias("ltv"),
        picked.alias("picked"),
        action.alias("action"),
    ).select("lid", "wid", "sta", "ltv", "picked.*", "action")
    if first_id is None:
        return runs
    new = global_row_number(runs.where(lid.isNull()).drop("lid"), "wid", "lid", first_id)
    return runs.where(lid.isNotNull()).unionByName(new)


def load_parameters(runs: DataFrame) -> DataFrame:
    """Parameter rows the extracting jobs read: start time and run of each workflow."""
    values = F.array(
        F.struct(
            F.lit("LTV").alias("name"),
            F.date_format("ltv", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("value"),
        ),
        F.struct(F.lit("LID").alias("name"), col("lid").cast("string").alias("value")),
    )
    return runs.select("wid", F.explode(values).alias("p")).select(
        "wid",
        F.lit("GLOBAL").alias("session_name"),
        F.col("p.name").alias("parameter_name"),
        F.col("p.value").alias("parameter_wert"),
    )


def close_load(history: DataFrame, now: datetime, workflow: int | None = None) -> DataFrame:
    """History with the running run (of one workflow, or of all) finished now."""
    running = col("sta") == RUNNING
    if workflow is not None:
        running = running & (col("wid") == workflow)
    return history.withColumns(
        {
            "ltb": F.when(running, F.lit(now).cast("timestamp_ntz")).otherwise(col("ltb")),
            "sta": F.when(running, F.lit(DONE)).otherwise(col("sta")),
        }
    )


def window_filter(df: DataFrame, ts: str, begin: datetime | Column, end: datetime | Column) -> DataFrame:
    """Rows of a load window, lower bound included; a range on the bare column, so
    that it reaches the scan and prunes partitions."""
    low, high = (
        b if isinstance(b, Column) else F.lit(b).cast(df.schema[ts].dataType) for b in (begin, end)
    )
    return df.where((col(ts) >= low) & (col(ts) < high))
