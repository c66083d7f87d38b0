"""Registered queries: named end-to-end plans over the driver tables, and
the independent SQL oracle for each."""

from netcap.plans.oracle import ORACLE_SQL
from netcap.plans.queries import QUERIES as _BATCH
from netcap.plans.queries import present
from netcap.plans.stored_queries import STORED_QUERIES

QUERIES = {**_BATCH, **STORED_QUERIES}

__all__ = ["ORACLE_SQL", "QUERIES", "present"]
