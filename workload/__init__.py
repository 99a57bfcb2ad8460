"""Registered queries: every operator of the library over the given tables, with the SQL it must equal.

Reports are rendered from the tables inside each query (a report line per table row, plus headers and
subtotals), so every query's work grows with the tables.
"""

from workload import arrivals, casts, checks, contracts, files, ladder, loads, periods, sheets
from workload.base import REGISTRY

MODULES = (ladder, files, sheets, periods, casts, contracts, loads, arrivals, checks)


def queries():
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
