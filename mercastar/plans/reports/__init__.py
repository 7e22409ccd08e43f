"""The report catalogue: every report takes a warehouse and parameters."""

from mercastar.plans.reports.catalogue import REPORTS

__all__ = ["REPORTS"]
