"""Tables of other databases as targets."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablemill.sinks.files import observed_write

BATCH_ROWS = 5_000


def check_columns(df: DataFrame, table_columns) -> None:
    """A frame may not bring columns the table lacks."""
    known = {c.upper() for c in table_columns}
    extra = [c for c in df.columns if c.upper() not in known]
    if extra:
        raise ValueError(f"columns {extra} are not in the target table")


def write_jdbc(
    df: DataFrame, url: str, table: str, replace: bool = False, batch_rows: int = BATCH_ROWS, **options
) -> int:
    """Append to a table, or empty it first; the schema is checked before."""
    spark = df.sparkSession
    target = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    check_columns(df, target.columns)
    settings = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **options}
    if replace:
        settings["truncate"] = "true"
    mode = "overwrite" if replace else "append"
    return observed_write(
        df, lambda d: d.write.format("jdbc").mode(mode).options(**settings).save()
    )
