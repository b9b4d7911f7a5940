"""Registered queries over the test tables, each with the SQL it is checked against."""

from tablemill.queries import calendar, cleansing, config, joins, loads, masking, storage  # noqa: F401
from tablemill.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
