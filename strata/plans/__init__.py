"""Query plans: the named catalog over the driver tables and its DuckDB oracle."""

from strata.plans.catalog import QUERIES
from strata.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL"]
