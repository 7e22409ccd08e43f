"""All oracles by query name."""

from __future__ import annotations

from oracles.report_sql import REPORTS
from oracles.table_sql import TABLES

ORACLES: dict[str, str] = TABLES | REPORTS
