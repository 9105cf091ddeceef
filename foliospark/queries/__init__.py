"""All registered queries."""

from ..registry import ORACLE_SQL, QUERIES
from . import aggregates, functions, joins, library, payloads, reports, rules, runs, stores, windows

__all__ = ["ORACLE_SQL", "QUERIES", "aggregates", "functions", "joins", "library", "payloads", "reports", "rules", "runs", "stores", "windows"]
