"""Every operator as a named query over the given tables, with its SQL equivalent where there is one."""

from rondo.queries import checks, columns, groups, joins, scans, sinks, tables, times
from rondo.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "checks", "columns", "groups", "joins", "scans", "sinks", "tables", "times"]
