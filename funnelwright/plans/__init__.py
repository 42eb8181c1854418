"""The batch jobs. Each reads stored tables, and writes tables that the next one reads."""

from funnelwright.plans.history import build_history
from funnelwright.plans.jobs import (
    build_model,
    conform_leads,
    conform_reports,
    ingest_leads,
    ingest_reports,
    kpi_level_report,
    kpi_reports,
    register_views,
)

__all__ = [
    "build_history",
    "build_model",
    "conform_leads",
    "conform_reports",
    "ingest_leads",
    "ingest_reports",
    "kpi_level_report",
    "kpi_reports",
    "register_views",
]
