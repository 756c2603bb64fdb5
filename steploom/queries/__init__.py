"""Every operator as a query on the given tables, with the SQL it is checked by."""

from . import cleaning, jobs, results, scoring, series, streams, tables  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
