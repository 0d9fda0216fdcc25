"""Registered queries (kept as an import path; the queries live in
``lakeops.plans.queries``, one module per area)."""

from .queries import ORACLE_SQL, QUERIES, register  # noqa: F401
