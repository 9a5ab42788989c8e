"""All energy tables: jobs, tests and the dictionary iterate these."""

from terrace.plans.energy.clean import CLEAN_TABLES
from terrace.plans.energy.metrics import METRIC_TABLES

ALL_TABLES = (*CLEAN_TABLES, *METRIC_TABLES)

__all__ = ["ALL_TABLES", "CLEAN_TABLES", "METRIC_TABLES"]
