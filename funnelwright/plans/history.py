"""What became of the leads: their latest reports, changes of status, and who has no counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from funnelwright.operators.history import latest_state, status_changes
from funnelwright.operators.joins import heavy_keys, unmatched
from funnelwright.operators.model import HASHES, LEAD_KEY
from funnelwright.plans.jobs import PARQUET_EXPANSION
from funnelwright.plans.sizing import sized_for
from funnelwright.sources.tables import read_table, write_table

# Columns of tables that grow by increments: when a row's file came, and which file it is.
_ARRIVAL = ("source_time", "source_file")


def build_history(spark: SparkSession, conformed: str, out: str) -> dict[str, DataFrame]:
    """Tables ``leads`` and ``reports`` -> ``latest_state``, ``status_changes``, ``unmatched_leads``, ``unmatched_reports``.

    States follow each other by the time of the files they came in, where the tables have grown by increments, and then by entry date.
    A state is that of a report number with its hashes. Of several rows in one file with one date, all columns from left to right
    decide. The heavy keys of leads and reports stay next to the tables.
    """
    with sized_for(spark, conformed, expansion=PARQUET_EXPANSION):
        leads, reports = read_table(spark, conformed, "leads"), read_table(spark, conformed, "reports")
        order = [*(name for name in _ARRIVAL if name in reports.columns), "entry_date"]
        states = reports.drop("invalid_values")
        found = {"latest_state": write_table(latest_state(states, LEAD_KEY, order), out, "latest_state")}
        seen = states.select(*LEAD_KEY, *order, "job_status").distinct()
        changes = status_changes(seen, LEAD_KEY, order[0], [*order[1:], "job_status"], "job_status")
        found["status_changes"] = write_table(changes, out, "status_changes")
        for name, one, other in (("unmatched_leads", leads, reports), ("unmatched_reports", states, leads)):
            heavy = write_table(heavy_keys(one, other, HASHES), out, f"heavy_{name}")
            found[name] = write_table(unmatched(one, other, HASHES, heavy), out, name)
    return found
