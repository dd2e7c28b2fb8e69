"""Every operator as a query over the driver's tables, with the SQL that must give the same rows."""

from __future__ import annotations

from rillflow.plans import grids, records, rules, series  # noqa: F401  they register their queries
from rillflow.plans.adapters import ORACLE_SQL, QUERIES  # noqa: F401

FLAGSHIP = "a1_resample_hourly"
