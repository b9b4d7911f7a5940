"""Tables of other databases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tablemill.spec import TableSpec

# Memory of a fetch, and the most rows fetched at once, plain and with
# XML columns.
FETCH_BYTES = 104_857_600
FETCH_ROWS = 100_000
FETCH_ROWS_XML = 1_000


@dataclass(frozen=True)
class Bounds:
    """Column, range and number of the slices a table is read in."""

    column: str
    low: int | str
    high: int | str
    slices: int


def fetch_size(row_bytes: int, memory: int = FETCH_BYTES, has_xml: bool = False) -> int:
    """Rows per fetch that fit the memory."""
    if has_xml:
        return FETCH_ROWS_XML
    return max(1, min(memory // max(row_bytes, 1), FETCH_ROWS))


def jdbc_options(
    url: str,
    spec: TableSpec,
    query: str | None = None,
    bounds: Bounds | None = None,
    row_bytes: int = 1000,
    has_xml: bool = False,
) -> dict[str, str]:
    """Reader options; without bounds everything comes through one task."""
    table = f"({query.rstrip().rstrip(';')}) q" if query else spec.name
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size(row_bytes, has_xml=has_xml))}
    if bounds is not None:
        options |= {
            "partitionColumn": bounds.column,
            "lowerBound": str(bounds.low),
            "upperBound": str(bounds.high),
            "numPartitions": str(bounds.slices),
        }
    return options


def scan_jdbc(
    spark: SparkSession,
    url: str,
    spec: TableSpec,
    query: str | None = None,
    bounds: Bounds | None = None,
    single_task: bool = False,
    **options,
) -> DataFrame:
    """A table or query of a database, in slices of its bounds.

    Without bounds one task reads everything, which must be asked for by ``single_task``.

    Filters and columns of later steps are pushed into the database by Spark.
    """
    if bounds is None and not single_task:
        raise ValueError(f"{spec.name}: give bounds, or single_task=True for a small table")
    return spark.read.format("jdbc").options(**jdbc_options(url, spec, query, bounds, **options)).load()
